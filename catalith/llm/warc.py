"""Dictionary-compressed WARC archives.

Each file starts with a skippable Zstandard frame that holds a dictionary,
itself compressed. The dictionary is trained on the file's own records. Every
record follows as a frame of its own, compressed with that dictionary, so a
reader can start at any record.

Of rows with equal payloads, the one with the largest id becomes a ``response``
record and the others become ``revisit`` records that name it and carry the HTTP
headers only, with the full length and digest. Only digests are grouped; a table
of the digests that repeat is joined to the pages, as a broadcast while its
written size is small and otherwise with skewed keys split, since equal pages
may be a third of all.

A task writes files of at most ``SEGMENT`` bytes of raw records (one longer
record has a file to itself) under names of its own, and yields one row per
file. These rows, once written by Spark, are the manifest: files of tasks that
failed or ran twice are in no manifest and are not read.

Defined cases: a null payload is the empty payload. Rows that tie for the
largest id of a payload are all responses, and so are payloads whose rows have
no id. A null URL is written as the empty one. An empty table gives an empty
manifest. Only id, URL and payload are read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.session import materialize, shared_folder

SEGMENT = 16 << 20
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
# Fixed value: the magic number of the skippable frame that holds a dictionary.
DICTIONARY_MAGIC = 0x184D2A5D
DATE = "1970-01-01T00:00:00Z"
MANIFEST = "path string, records long, raw_bytes long, file_bytes long"
RECORDS = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
    "refers_to long, payload binary"
)


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [f"{name}: {value}" for name, value in [*headers, ("Content-Length", str(len(block)))]]
    return "\r\n".join(["WARC/1.1", *lines, "", ""]).encode() + block + b"\r\n\r\n"


def _name(value: str | None) -> str:
    return "" if value is None else value.replace("\r", "%0D").replace("\n", "%0A")


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, is_response: bool) -> bytes:
    """One record; a revisit has the HTTP headers of the payload but not the payload."""
    kind = "response" if is_response else "revisit"
    target = _name(url)
    digest = _digest(payload)
    identity = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}|{target}|{digest}")
    headers = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:uuid:{identity}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if page_id is not None:
        headers.append(("Page-Id", str(page_id)))
    if not is_response:
        headers.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        headers.append(("Refers-To-Page-Id", str(refers_to)))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return _record(headers, http.encode() + (payload if is_response else b""))


def train(records: list[bytes]) -> bytes:
    """A dictionary from all records of a file; empty where there is too little to learn from."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


def compress_file(records: list[bytes]) -> Iterator[bytes]:
    """The parts of one archive file: the dictionary frame, then one frame per record."""
    dictionary = train(records)
    if dictionary:
        packed = zstandard.ZstdCompressor(level=19, write_checksum=True).compress(dictionary)
        yield struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed
        compressor = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary), write_checksum=True
        )
    else:
        compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
    for record in records:
        yield compressor.compress(record)


def _store(folder: str, records: list[bytes]) -> tuple[str, int, int, int]:
    system, base = fs.FileSystem.from_uri(folder)
    system.create_dir(base, recursive=True)
    name = f"{uuid.uuid4().hex}.warc.zst"
    size = 0
    with system.open_output_stream(f"{base}/{name}", compression=None) as out:
        for part in compress_file(records):
            out.write(part)
            size += len(part)
    return f"{folder}/{name}", len(records), sum(map(len, records)), size


def _writer(folder: str, segment: int):
    info = _record(
        [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, folder)}>"),
         ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")],
        b"format: WARC File Format 1.1\r\n",
    )

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records, size, files = [info], 0, []
        for batch in batches:
            for row in _rows(batch):
                page_id, url, payload, refers_to, is_response = row
                record = page_record(page_id, url, payload, refers_to, is_response)
                if size and size + len(record) > segment:
                    files.append(_store(folder, records))
                    records, size = [info], 0
                records.append(record)
                size += len(record)
        if size:
            files.append(_store(folder, records))
        columns = list(zip(*files, strict=True)) or [()] * 4
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), type=k) for c, k in zip(columns, kinds, strict=True)],
            ["path", "records", "raw_bytes", "file_bytes"],
        )

    return write


def _rows(batch: pa.RecordBatch, step: int = 64) -> Iterator[tuple]:
    for start in range(0, batch.num_rows, step):
        yield from zip(*(c.to_pylist() for c in batch.slice(start, step).columns), strict=True)


def write_archives(
    df: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", folder: str | None = None,
    segment: int = SEGMENT, least_bytes: int = 0,
) -> DataFrame:
    """Write ``df`` as archives under ``folder`` and return the manifest.

    Equal payloads below ``least_bytes`` are all written as responses. Without a
    folder, the archives go to a new one in the shared folder of the session.
    """
    spark = df.sparkSession
    folder = folder or f"{shared_folder(spark).rstrip('/')}/archives-{uuid.uuid4().hex}"
    pages = df.select(
        F.col(key).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.encode(F.col(payload).cast("string"), "utf-8"), F.lit(b"")).alias("payload"),
    ).withColumn("sha1", F.unhex(F.sha1("payload")))
    repeated = materialize(
        pages.where(F.octet_length("payload") >= least_bytes)
        .groupBy("sha1")
        .agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
        .where("n > 1 AND refers_to IS NOT NULL")
        .drop("n")
    )
    is_response = F.col("refers_to").isNull() | F.col("page_id").eqNullSafe(F.col("refers_to"))
    rows = pages.join(repeated, "sha1", "left").select(
        "page_id", "url", "payload", "refers_to", is_response.alias("is_response")
    )
    return materialize(rows.mapInArrow(_writer(folder, segment), MANIFEST))


def _headers(text: bytes) -> dict[str, str]:
    lines = text.decode().split("\r\n")[1:]
    return dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)


def read_file(source) -> Iterator[dict]:
    """The page records of one archive file, record by record.

    A response whose payload does not have the stated length and digest is an error.
    """
    head = source.read(8)
    dictionary = None
    rest = head
    if len(head) == 8:
        magic, size = struct.unpack("<II", head)
        if magic == DICTIONARY_MAGIC:
            dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(source.read(size)))
            rest = b""
    unpacker = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    frame, out = unpacker.decompressobj(), []
    data, inside = rest, False
    while True:
        if not data:
            data = source.read(1 << 20)
            if not data:
                break
        out.append(frame.decompress(data))
        data, inside = b"", True
        if frame.eof:
            record = _parse(b"".join(out))
            if record:
                yield record
            data, out, frame, inside = frame.unused_data, [], unpacker.decompressobj(), False
    if inside:
        raise ValueError("the archive ends inside a record")


def _parse(record: bytes) -> dict | None:
    head, _, block = record.partition(b"\r\n\r\n")
    headers = _headers(head)
    kind = headers["WARC-Type"]
    if kind == "warcinfo":
        return None
    http, _, payload = block[: int(headers["Content-Length"])].partition(b"\r\n\r\n")
    length = int(_headers(http)["Content-Length"])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != length or _digest(payload) != digest):
        raise ValueError(f"damaged payload of page {headers.get('Page-Id')}")
    page_id, refers_to = headers.get("Page-Id"), headers.get("Refers-To-Page-Id")
    return {
        "page_id": None if page_id is None else int(page_id),
        "url": headers["WARC-Target-URI"],
        "record_type": kind,
        "payload_bytes": length,
        "payload_digest": digest,
        "refers_to": None if refers_to is None else int(refers_to),
        "payload": payload if kind == "response" else None,
    }


def _reader(with_payload: bool, rows: int = 1000):
    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
             ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
        )
        for batch in batches:
            for path, records in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist(), strict=True):
                system, name = fs.FileSystem.from_uri(path)
                with system.open_input_stream(name, compression=None) as source:
                    found = []
                    # The first record of a file tells of the file and is no page.
                    size, left = 0, records - 1
                    for record in read_file(source):
                        left -= 1
                        size += len(record["payload"] or b"")
                        found.append(record if with_payload else {**record, "payload": None})
                        if len(found) == rows or size > SEGMENT:
                            yield pa.RecordBatch.from_pylist(found, schema)
                            found, size = [], 0
                    if found:
                        yield pa.RecordBatch.from_pylist(found, schema)
                    if left:
                        raise ValueError(f"{path} has {records - left} records, its manifest says {records}")

    return read


def read_archives(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """The page records of the archives that ``manifest`` lists.

    A file with more or fewer records than its manifest says, such as one that was cut
    between two frames, is an error.
    """
    cores = manifest.sparkSession.sparkContext.defaultParallelism
    tasks = max(cores, manifest.count() // 4)
    return manifest.select("path", "records").repartition(tasks).mapInArrow(_reader(with_payload), RECORDS)


def restore_payloads(records: DataFrame) -> DataFrame:
    """Give revisit records the payload of the response they refer to."""
    found = records.where("record_type = 'response'").select(
        F.col("page_id").alias("of"), F.col("payload_digest").alias("of_digest"), F.col("payload").alias("of_payload")
    )
    same = (F.col("refers_to") == F.col("of")) & (F.col("payload_digest") == F.col("of_digest"))
    return records.join(found.dropDuplicates(["of", "of_digest"]), same, "left").select(
        *(c for c in records.columns if c != "payload"), F.coalesce("payload", "of_payload").alias("payload")
    )
