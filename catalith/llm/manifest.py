"""A Merkle manifest of a dataset, built and proved by time-forward processing.

Every row is a leaf. Per group (source), leaves in order form a tree in which runs
of ``WAY`` consecutive nodes become one parent; the groups' roots form the upper
tree in the same way. A node's label is ``(level, index)``. Time-forward
processing evaluates nodes by ascending label: a digest is sent to its parent as a
message in a priority queue ordered by the parent's label, and the least label's
messages are taken from the queue together. The reversed sweep takes labels in
descending order and sends each child its proof: its siblings, then its parent's
proof.

The queue is external. A chunk of ``WAY ** LEVELS`` consecutive nodes of a tree is
one group of rows, whose messages pass through a heap in one task; the message
that leaves a chunk is a row of a written table, and Spark's sorted shuffle brings
it to the chunk of its parent. Each round removes ``LEVELS`` levels, so the number
of rounds grows with the logarithm of the rows, no group has more than a chunk of
digests, and a hot source is only more chunks. Texts are hashed where they are
read and never shuffled.

Digests are lower-case hex SHA-256 over the hex text of their inputs. A leaf's
inputs are its columns, each ``-`` if null, else the byte count, ``:`` and the value.

Defined cases: rows without an id come first, and equal ids are ordered by their
leaves, so rows that repeat are neighbours with equal leaves and proofs of their
own. A null source is a group of its own, before all others. An empty table has no
rows, one row has its own leaf as root and the digest of nothing as proof. Other
columns are not read; clashing names do not matter.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catalith.session import materialize

WAY = 3
LEVELS = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PROOF = "array<struct<left:string,right:string>>"


def digest(*parts: str) -> str:
    """Lower-case hex SHA-256 of the parts, one after the other."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*columns: Column) -> Column:
    """The digest of a row: each value with its byte count, ``-`` for null."""

    def shown(c: Column) -> Column:
        text = c.cast("string")
        return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.sha2(F.concat(*map(shown, columns)), 256)


def folded(start: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(proof, start, lambda own, step: F.sha2(F.concat(step["left"], own, step["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """The digest of all siblings of a proof, from the leaf to the root."""
    return F.sha2(F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def _levels(n: int) -> int:
    """How many levels lie above ``n`` leaves."""
    found = 0
    while n > 1:
        n = -(-n // WAY)
        found += 1
    return found


def forward(leaves: Sequence[str], levels: int) -> tuple[str, list[tuple[tuple[int, int], list[str]]]]:
    """The digest ``levels`` above the leaves, and the children of each node by ascending label.

    The heap holds messages ``(label of the receiver, place among its children, digest)``.
    """
    if not levels:
        return leaves[0], []
    queue = [((1, i // WAY), i % WAY, own) for i, own in enumerate(leaves)]  # sorted, so a heap
    nodes = []
    while True:
        label = queue[0][0]
        children = []
        while queue and queue[0][0] == label:
            children.append(heapq.heappop(queue)[2])
        nodes.append((label, children))
        own = digest(*children)
        level, index = label
        if level == levels:
            return own, nodes
        heapq.heappush(queue, ((level + 1, index // WAY), index % WAY, own))


def backward(nodes: Sequence[tuple[tuple[int, int], list[str]]], top: tuple, n: int) -> list[tuple]:
    """The proof of each of ``n`` leaves, by descending label; ``top`` is the proof of the last node."""
    if not nodes:
        return [top]
    level, index = nodes[-1][0]
    queue = [((-level, -index), top)]
    proofs: list[tuple] = [()] * n
    for (level, index), children in reversed(nodes):
        label, suffix = heapq.heappop(queue)
        assert label == (-level, -index)
        for place, _ in enumerate(children):
            step = ("".join(children[:place]), "".join(children[place + 1 :]))
            child = index * WAY + place
            if level == 1:
                proofs[child] = (step, *suffix)
            else:
                heapq.heappush(queue, ((1 - level, -child), (step, *suffix)))
    return proofs


def _chunked(nodes: DataFrame, extra: Sequence[str]) -> DataFrame:
    """One row per chunk of ``nodes(tree, n, place, digest, *extra)``: its nodes in order and its top.

    ``n`` is the number of nodes of the tree. ``extra`` columns travel with the nodes.
    """
    size = WAY**LEVELS
    kinds = {f.name: f.dataType.simpleString() for f in nodes.schema.fields}
    held = ["digest", *extra]
    names = ["tree", "n", "place", "top", *held]

    def climb(group: pa.Table) -> pa.Table:
        group = group.take(pa.array(np.argsort(group.column("place").to_numpy())))
        n, chunk = group.column("n")[0].as_py(), group.column("chunk")[0].as_py()
        top, _ = forward(group.column("digest").to_pylist(), LEVELS if n > size else _levels(n))
        whole = [pa.ListArray.from_arrays(pa.array([0, len(group)], pa.int32()), group.column(c).combine_chunks()) for c in held]
        first = [group.column("tree").combine_chunks()[:1], pa.array([-(-n // size)], pa.int64()), pa.array([chunk], pa.int64())]
        return pa.Table.from_arrays([*first, pa.array([top]), *whole], names)

    placed = nodes.withColumn("chunk", F.floor(F.col("place") / size))
    schema = f"tree {kinds['tree']}, n long, place long, top string, " + ", ".join(
        f"{c} array<{kinds[c]}>" for c in held
    )
    return materialize(placed.groupBy("tree", "chunk").applyInArrow(climb, schema))


def _proved(chunks: DataFrame, tops: DataFrame, extra: Sequence[str], known: Sequence[str]) -> DataFrame:
    """One row per node: its tree, place, digest, proof, ``extra``, and the ``known`` columns of the chunk's top."""
    kinds = {f.name: f.dataType.simpleString() for f in [*chunks.schema.fields, *tops.schema.fields]}
    size = WAY**LEVELS
    per_node = {c: kinds[c][len("array<") : -1] for c in ("digest", *extra)}
    names = ["tree", "place", *per_node, "proof", *known]

    def steps(proofs: list[tuple]) -> pa.ListArray:
        flat = [step for proof in proofs for step in proof]
        sides = [pa.array([s[0] for s in flat], pa.string()), pa.array([s[1] for s in flat], pa.string())]
        ends = np.cumsum([0, *map(len, proofs)])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(sides, ["left", "right"]))

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                own = row["digest"].as_py()
                # A chunk that is a whole tree has fewer levels than the others.
                levels = LEVELS if row["n"].as_py() > 1 else _levels(len(own))
                top = tuple((s["left"], s["right"]) for s in row["proof"].as_py())
                proofs = backward(forward(own, levels)[1], top, len(own))
                at = pa.array(np.zeros(len(own), dtype=np.int64))
                one = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        one.column("tree").take(at),
                        pa.array(row["place"].as_py() * size + np.arange(len(own))),
                        *(row[c].values for c in per_node),
                        steps(proofs),
                        *(one.column(c).take(at) for c in known),
                    ],
                    names,
                )

    schema = ", ".join(
        [f"tree {kinds['tree']}", "place long", *(f"{c} {k}" for c, k in per_node.items()), f"proof {PROOF}"]
        + [f"{c} {kinds[c]}" for c in known]
    )
    both = chunks.join(tops.drop("n", "digest"), ["tree", "place"])
    return both.select("tree", "n", "place", *per_node, "proof", *known).mapInArrow(sweep, schema)


def build(nodes: DataFrame, extra: Sequence[str] = ()) -> tuple[DataFrame, list[DataFrame]]:
    """Climb ``nodes(tree, n, place, digest, *extra)`` to one node per tree.

    Returns the roots ``(tree, digest)`` and the written chunks of each round,
    which ``prove`` reads in reverse.
    """
    rounds = [_chunked(nodes, extra)]
    while True:
        tops = rounds[-1].select("tree", "n", "place", F.col("top").alias("digest"))
        upper = tops.where("n > 1")
        if not upper.limit(1).count():
            break
        rounds.append(_chunked(upper, ()))
    roots = rounds[0].where("n = 1")
    for chunks in rounds[1:]:
        roots = roots.select("tree", "top").union(chunks.where("n = 1").select("tree", "top"))
    return roots.select("tree", F.col("top").alias("digest")), rounds


def prove(rounds: Sequence[DataFrame], tops: DataFrame, extra: Sequence[str], known: Sequence[str]) -> DataFrame:
    """Deliver proofs from the roots to the nodes that ``build`` began with.

    ``tops(tree, proof, *known)`` holds what each root has to pass on.
    """
    start = tops.withColumn("place", F.lit(0).cast("long"))
    found = None
    for r in range(len(rounds) - 1, -1, -1):
        # Trees that end in this round start here; the others were reached in the round above.
        ends = start.join(rounds[r].where("n = 1").select("tree"), "tree", "left_semi") if len(rounds) > 1 else start
        columns = ["tree", "place", "proof", *known]
        above = ends.select(columns) if found is None else ends.select(columns).unionByName(found.select(columns))
        found = _proved(rounds[r], above, extra if r == 0 else (), known)
        if r:
            found = materialize(found)
    return found


def placed(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``place`` (from 0, by ``order`` within ``tree``) and ``n`` (rows of the tree).

    Rows are sorted by ranges, so a hot tree lies in many tasks; each task numbers
    its rows, and the counts per task and tree, a small table, tell where it begins.
    """
    schema = rows.schema
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, used = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            trees = batch.column(tree).fill_null("").to_numpy(zero_copy_only=False).astype(object)
            isnull = batch.column(tree).is_null().to_numpy(zero_copy_only=False)
            first = np.ones(len(trees), dtype=bool)
            first[1:] = (trees[1:] != trees[:-1]) | (isnull[1:] != isnull[:-1])
            starts = np.flatnonzero(first)
            local = np.arange(len(trees)) - np.repeat(starts, np.diff(np.append(starts, len(trees))))
            head = (trees[0], isnull[0])
            if head == last:
                local[: starts[1] if len(starts) > 1 else len(trees)] += used
            last, used = (trees[-1], isnull[-1]), int(local[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(trees), part, dtype=np.int32)), pa.array(local.astype(np.int64))],
                [*batch.schema.names, "part", "local"],
            )

    by = [F.col(c).asc_nulls_first() for c in (tree, *order)]
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    numbered = materialize(ranged.mapInArrow(number, f"{kinds}, part int, local long"))
    ahead = Window.partitionBy(tree).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = numbered.groupBy(tree, "part").agg(F.count("*").alias("rows"))
    begins = counts.select(
        F.col(tree).alias("of"),
        F.col("part").alias("of_part"),
        F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("begin"),
        F.sum("rows").over(Window.partitionBy(tree)).alias("n"),
    )
    same = F.col(tree).eqNullSafe(F.col("of")) & (F.col("part") == F.col("of_part"))
    return numbered.join(begins, same).select(
        *schema.names, "n", (F.col("begin") + F.col("local")).alias("place")
    )


def manifest(df: DataFrame, fields: Sequence[str] = FIELDS, key: str = "doc_id", group: str = "source") -> DataFrame:
    """Each row's ``leaf``, ``subroot``, ``root`` and ``proof``, an array of its siblings left and right of it.

    Rows are told by ``key``; a column ``claimed`` of ``df``, if there is one, is
    passed on as ``claimed``, so that a digest to be verified travels with its row.
    """
    own = leaf(*(F.col(c) for c in fields))
    told = F.col("claimed") if "claimed" in df.columns and "claimed" not in fields else own
    # A row number settles the order of rows that are equal; it is written before it is used.
    leaves = materialize(
        df.select(
            F.col(group).cast("string").alias("tree"),
            F.col(key).alias("row_key"),
            own.alias("digest"),
            told.alias("claimed"),
        )
    ).withColumn("row", F.monotonically_increasing_id())
    extra = ("row_key", "claimed")
    ordered = placed(leaves, "tree", ("row_key", "digest", "row")).drop("row")
    # A null tree cannot be joined on; "=" stands before each name instead.
    named = F.coalesce(F.concat(F.lit("="), F.col("tree")), F.lit(""))
    subroots, lower = build(ordered.withColumn("tree", named), extra)
    subroots = materialize(subroots)
    upper_leaves = subroots.select(F.lit("all").alias("tree"), F.col("tree").alias("name"), "digest")
    roots, upper = build(placed(upper_leaves, "tree", ("name",)), ("name",))
    top = roots.select("tree", F.col("digest").alias("root"), F.array().cast(PROOF).alias("proof"))
    groups = materialize(prove(upper, top, ("name",), ("root",)))
    tops = groups.select(F.col("name").alias("tree"), F.col("digest").alias("subroot"), "root", "proof")
    return prove(lower, tops, extra, ("subroot", "root")).select(
        F.col("row_key").alias(key), F.col("digest").alias("leaf"), "claimed", "subroot", "root", "proof"
    )


def tamper_report(df: DataFrame) -> DataFrame:
    """The manifest of ``documents``, and whether each row still verifies after its text was tampered with.

    Where 2 divides the CRC-32 of the decimal id, the line breaks of the text are
    deleted; the leaf of that text is folded with the siblings of the original.
    """
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    text = F.col("text").cast("string")
    claimed = F.when(F.coalesce(tampered, F.lit(False)), F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)
    columns = [claimed if c == "text" else F.col(c) for c in FIELDS]
    found = manifest(df.select(*FIELDS, leaf(*columns).alias("claimed")))
    again = folded(F.col("claimed"), F.col("proof"))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("proof")).alias("proof_sha256"),
        again.alias("folded_root"),
        (again == F.col("root")).alias("verified"),
    )
