"""Archives, vectors, pieces, components and the pipeline."""

from __future__ import annotations

import base64
import hashlib
import math
import os
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from catalith.llm import graph, near_vectors, pieces, queries, warc

FOLDER = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string"
VECTORS = "vec_id long, embedding array<float>, label int"


def pages():
    rng = random.Random(1)
    bodies = [f"<html><title>{i}</title><p>{'text ' * rng.randrange(400)}</p></html>" for i in range(40)]
    rows = [(i, f"http://example.org/{i}", rng.choice(bodies)) for i in range(300)]
    return rows + [(300, None, None), (301, "u", ""), (None, "u", bodies[0]), (None, "v", "only without an id"),
                   (302, "a\r\nb", "é" * 500_000), (7, "again", rows[7][2]), (303, "u", "😀")]


@pytest.mark.parametrize("segment", [1 << 14, 1 << 22])
def test_archives_give_back_what_was_written(spark, segment):
    rows = pages()
    df = spark.createDataFrame(rows, PAGES).withColumn("sha1", F.lit("x")).repartition(3)
    manifest = warc.write_archives(df, segment=segment)
    assert manifest.agg(F.sum("records")).first()[0] == len(rows) + manifest.count()
    found = warc.restore_payloads(warc.read_archives(manifest)).collect()
    top = {}
    for page_id, _, html in rows:
        if page_id is not None:
            top[html or ""] = max(page_id, top.get(html or "", -1))
    count = Counter(html or "" for _, _, html in rows)
    wanted = []
    for page_id, _, html in rows:
        body = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        response = page_id == top.get(html or "") or html not in (None, "") and top.get(html) is None or count[html or ""] == 1
        refers = None if response else top[html or ""]
        wanted.append((page_id, len(body), digest, "response" if response else "revisit", refers, body))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, bytes(r.payload)) for r in found]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)


def test_small_payloads_are_not_revisited(spark):
    df = spark.createDataFrame([(1, "u", "aa"), (2, "u", "aa"), (3, "u", "long enough"), (4, "u", "long enough")], PAGES)
    found = warc.read_archives(warc.write_archives(df, least_bytes=5)).collect()
    assert {r.page_id: r.record_type for r in found} == {1: "response", 2: "response", 3: "revisit", 4: "response"}
    assert warc.read_archives(warc.write_archives(df.limit(0))).count() == 0


def test_a_file_starts_with_its_dictionary_and_has_a_frame_per_record(tmp_path):
    records = [warc.page_record(i, f"http://e/{i}", b"<p>some text</p>" * (i % 17 + 3), None, True) for i in range(200)]
    raw = b"".join(warc.compress_file(records))
    magic, size = int.from_bytes(raw[:4], "little"), int.from_bytes(raw[4:8], "little")
    assert magic == warc.DICTIONARY_MAGIC
    dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(raw[8 : 8 + size]))
    rest, frames = raw[8 + size :], []
    while rest:
        unpacker = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
        frames.append(unpacker.decompress(rest))
        rest = unpacker.unused_data
    assert frames == records
    path = tmp_path / "x"
    path.write_bytes(raw)
    with path.open("rb") as source:
        assert [r["page_id"] for r in warc.read_file(source)] == list(range(200))
    path.write_bytes(raw[:-5])
    with path.open("rb") as source, pytest.raises(ValueError):
        list(warc.read_file(source))


def test_files_cut_between_frames_are_noticed(spark):
    df = spark.createDataFrame([(i, f"http://e/{i}", f"<p>{i} some text</p>" * 9) for i in range(20)], PAGES).coalesce(1)
    manifest = warc.write_archives(df)
    path = manifest.first()["path"].removeprefix("file:")
    with open(path, "rb") as source:
        raw = source.read()
    last = raw.rfind((0xFD2FB528).to_bytes(4, "little"))
    assert warc.read_archives(manifest).count() == 20
    with open(path, "wb") as target:
        target.write(raw[:last])
    with pytest.raises(Exception, match="its manifest says 21"):
        warc.read_archives(manifest).count()


def brute_vectors(rows, cosine=0.98):
    unit = []
    for _, v, label in rows:
        good = v and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
        x = np.array(v, dtype=np.float32).astype(float) if good else None
        unit.append(x / np.linalg.norm(x) if good else None)
    links = [0] * len(rows)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = unit[i], unit[j]
            if a is not None and b is not None and len(a) == len(b) and rows[i][2] == rows[j][2] and a @ b >= cosine:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(r[0], least.get(find(i), r[0]))
    return sorted(((r[0], links[i], least.get(find(i))) for i, r in enumerate(rows)), key=repr)


def vector_rows(seed=0, n=250, dims=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(40, dims))
    rows = []
    for i in range(n):
        x = centres[rng.integers(40)] + rng.normal(size=dims) * rng.choice((0.0, 0.05, 0.2, 1.0))
        rows.append((i, [float(v) for v in np.float32(x * rng.uniform(0.1, 9))], int(rng.integers(3))))
    rows += [(300, None, 1), (301, [0.0] * dims, 1), (302, [float("nan")] * dims, 1), (303, [None] * dims, 1), (304, [], 1),
             (305, rows[0][1], None), (None, rows[1][1], rows[1][2]), (1, rows[1][1], rows[1][2]), (306, [1.0, 0.0], 1),
             (307, [2.0, 0.01], 1), (308, [float("inf")] * dims, 0), (309, [1e-30] * dims, 2), (310, [3e30] * dims, 2)]
    return rows


@pytest.mark.parametrize("list_rows, block", [(4096, 1024), (8, 1024), (8, 7)])
def test_vectors_agree_with_all_pairs(spark, monkeypatch, list_rows, block):
    monkeypatch.setattr(near_vectors, "LIST_ROWS", list_rows)
    monkeypatch.setattr(near_vectors, "BLOCK", block)
    rows = vector_rows()
    df = spark.createDataFrame(rows, VECTORS).withColumns({"class": F.lit(1), "list": F.lit(2), "same": F.lit(3)})
    found = near_vectors.near_vectors(df.repartition(3)).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=repr) == brute_vectors(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_vectors_are_not_copied_for_the_lists_they_probe(spark, monkeypatch):
    """What is written grows with the vectors, also where each probes most lists and labels have many blocks."""
    monkeypatch.setattr(near_vectors, "LIST_ROWS", 8)
    monkeypatch.setattr(near_vectors, "BLOCK", 50)
    written, write = [], near_vectors.write_shared

    def count(df, partition_by=None):
        path = write(df, partition_by)
        written.append(spark.read.parquet(path))
        return path

    monkeypatch.setattr(near_vectors, "write_shared", count)
    monkeypatch.setattr(near_vectors, "materialize", lambda df: spark.read.schema(df.schema).parquet(count(df)))
    rows = [(i, [float(v) for v in x], i % 2) for i, x in enumerate(np.random.default_rng(5).normal(size=(400, 6)))]
    df = spark.createDataFrame(rows, VECTORS)
    found = near_vectors.near_vectors(df, cosine=0.9).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=repr) == brute_vectors(rows, 0.9)
    held = [t for t in written if {"vector", "raw"} & set(t.columns)]
    assert held and all(t.count() <= len(rows) for t in held)


def test_no_vectors(spark):
    assert near_vectors.near_vectors(spark.createDataFrame([], VECTORS)).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(0, 64)] + [(200, i) for i in range(100, 180)] + [(300, 300), (None, 5)]
    links += [(rng.randrange(400, 600), rng.randrange(400, 600)) for _ in range(150)]
    rng.shuffle(links)
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    found = graph.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {(r.node, r.root) for r in found} == {(x, find(x)) for x in root} and len(found) == len(root)


VOCABULARY = pieces.Vocabulary(
    ["▁", "a", "b", "ab", "▁ab", "ba", "aba", "▁▁", "bab▁a", *(f"<0x{i:02X}>" for i in range(256))],
    [-5.0, -3.0, -3.0, -4.0, -6.0, -4.0, -5.5, -7.0, -4.0, *[0.0] * 256],
    [True] * 9 + [False] * 256,
    list(range(9, 265)),
)


def brute_pieces(v, text):
    """The plain search over the whole text at once."""
    best = [(0.0, None, ())]
    for end in range(1, len(text) + 1):
        found = None
        for start in range(max(0, end - v.longest), end):
            known = v.ids.get(text[start:end])
            if known is not None:
                score = best[start][0] + v.scores[known]
                if found is None or score >= found[0]:
                    found = (score, start, (known,))
        c = text[end - 1]
        if c not in v.ids:
            score = best[end - 1][0] + v.unknown
            if found is None or score > found[0]:
                raw = ("▁" if c == pieces.LITERAL else c).encode()
                found = (score, end - 1, tuple(v.bytes_[b] for b in raw))
        best.append(found)
    out, at = [], len(text)
    while at:
        out = [*best[at][2], *out]
        at = best[at][1]
    return out


@pytest.mark.parametrize("breaks", [False, True])
def test_streaming_gives_the_best_pieces(breaks):
    v = VOCABULARY
    if breaks:
        v = pieces.Vocabulary([p if p != "bab▁a" else "bab" for p in v.pieces], v.scores, v.plain, v.bytes_)
    assert v.breaks == breaks
    encoder, rng = pieces.Encoder(v), random.Random(5)
    for _ in range(400):
        text = "".join(rng.choice("abab  ▁é😀\n") for _ in range(rng.randrange(0, 80)))
        marked = "▁" + text.replace("▁", pieces.LITERAL).replace(" ", "▁") if text else ""
        ids = encoder.encode(text).tolist()
        assert ids == brute_pieces(v, marked) and encoder.decode(ids) == text
        stream = pieces.Stream(v, check=rng.randrange(1, 9))
        assert [*stream.push(marked), *stream.close()] == ids


def test_the_window_stays_small():
    stream, rng, out, widest = pieces.Stream(VOCABULARY), random.Random(1), [], 0
    text = "".join(rng.choice("ab") for _ in range(20_000))
    for i in range(0, len(text), 100):
        out += stream.push(text[i : i + 100])
        widest = max(widest, len(stream.scores))
    assert [*out, *stream.close()] == brute_pieces(VOCABULARY, text) and widest < 200


def test_encoding_of_odd_rows(spark):
    texts = ["", None, "a b", "a b", " ▁ \t\n😀", "ab" * 50_000, "\u0000x"]
    df = spark.createDataFrame([(i if i else None, t) for i, t in enumerate(texts)], "doc_id long, text string")
    coded = pieces.encode(df.withColumn("ids", F.lit(1)), VOCABULARY, check=True)
    rows = {r.doc_id: r for r in coded.collect()}
    assert rows[None].ids == [] and rows[1].ids is None and rows[1].n_ids is None and rows[2].ids == rows[3].ids
    assert all(r.round_trip for k, r in rows.items() if k != 1)
    back = {r.doc_id: r.text for r in pieces.decode(coded, VOCABULARY).collect()}
    assert back == {i if i else None: t for i, t in enumerate(texts)}
    assert pieces.encode(df.limit(0), VOCABULARY).count() == 0


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in os.listdir(FOLDER):
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{name}'")
    return connection


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_agree_with_sql(spark, database, name):
    df = queries.QUERIES[name](spark, FOLDER)
    result = database.execute(queries.ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(repr, map(tuple, df.select(*columns).collect()))) == sorted(map(repr, result.fetchall()))


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, seen = docs.columns, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        seen.append(docs)
        assert i == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
    language, copies, clean, mixed, coded = seen
    first = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert {r.doc_id for r in language.collect()} == set(first)
    kept = [r.doc_id for r in copies.collect()]
    assert len(kept) == len(set(kept)) and len({first[k] for k in kept}) == len(kept)
    assert {r.doc_id for r in clean.collect()} == set(kept)
    times = Counter(r.doc_id for r in mixed.collect())
    assert set(times) <= set(kept) and max(times.values()) <= 3
    texts = {r.doc_id: r.text for r in clean.collect()}
    encoder = pieces.Encoder(pieces.load_vocabulary())
    assert all(encoder.decode(r.ids) == texts[r.doc_id] for r in coded.collect())
    assert Counter(r.doc_id for r in coded.collect()) == times


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
def test_run_writes_between_stages(spark, monkeypatch):
    seen = []

    def stage(spark, docs, folder):
        seen.append([os.path.basename(os.path.dirname(f)) for f in docs.inputFiles()])
        return docs.where("doc_id % 2 = 0").withColumn("drawn", F.rand())

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(name, stage) for name in "abc"])
    found = corpus_pipeline.run(spark, FOLDER)
    assert seen[0] == [os.path.basename(FOLDER)]
    for files in seen[1:]:
        assert files and all(f.startswith("catalith-") for f in files)
    wanted = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id % 2 = 0").count()
    assert found.count() == wanted and set(seen[1]).isdisjoint(seen[2])


def test_ids_are_no_longer_than_those_of_the_merges():
    """Ranks of merges become probabilities; a vocabulary with probabilities keeps its own."""
    import pyarrow.parquet as pq
    import sentencepiece

    texts = pq.read_table(f"{FOLDER}/documents.parquet")["text"].to_pylist()
    encoder = pieces.Encoder(pieces.load_vocabulary())
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    own, theirs, equal = 0, 0, 0
    for text in texts:
        ids, other = encoder.encode(text).tolist(), model.encode(text)
        assert encoder.decode(ids) == text
        own, theirs, equal = own + len(ids), theirs + len(other), equal + (ids == other)
    assert own <= 1.02 * theirs, (own, theirs, equal)
    assert pieces.log_probabilities([-1.5, -2.0], [True, True]) == [-1.5, -2.0]
    assert sum(math.exp(s) for s in pieces.log_probabilities([-3.0, -1.0, 0.0], [True] * 3)) == pytest.approx(1.0)


def test_a_vocabulary_needs_all_bytes_or_none():
    with pytest.raises(ValueError):
        pieces.Vocabulary(["a"], [-1.0], [True], [0] + [-1] * 255)
