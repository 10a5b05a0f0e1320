"""The manifest against a plain tree."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from catalith.llm import manifest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(doc_id, text, lang, source, n_chars):
    values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return sha("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def plain_tree(leaves):
    """The levels of a tree, from the leaves to the root."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i : i + 3])) for i in range(0, len(last), 3)])
    return levels


def plain_proof(levels, place):
    steps = []
    for level in levels[:-1]:
        run = place // 3 * 3
        steps.append(("".join(level[run:place]), "".join(level[place + 1 : run + 3])))
        place //= 3
    return steps


def plain_report(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, plain_leaf(*r), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([g[2] for g in sorted(groups[s], key=lambda g: g[:3])]) for s in names}
    upper = plain_tree([trees[s][-1][0] for s in names])
    root = upper[-1][0]
    found = []
    for i, s in enumerate(names):
        for place, (_, _, leaf, r) in enumerate(sorted(groups[s], key=lambda g: g[:3])):
            proof = plain_proof(trees[s], place) + plain_proof(upper, i)
            text = r[1]
            if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            own = plain_leaf(r[0], text, *r[2:])
            for left, right in proof:
                own = sha(left + own + right)
            digest = sha("".join(a + b for a, b in proof))
            found.append((r[0], leaf, trees[s][-1][0], root, digest, own, own == root))
    return sorted(found, key=repr)


def some_rows(n, seed=0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = "hot" if rng.random() < 0.4 else rng.choice([None, "", "é", "a", "z", "Z", "=x"])
        text = rng.choice([None, "", "one\ntwo", "\n", "süß 😀", "x" * rng.randrange(50)])
        rows.append((i, text, rng.choice([None, "en"]), source, rng.choice([None, rng.randrange(99)])))
    rows += [rows[3]] * 4 + [(None, "a\nb", None, "hot", 1), (None, None, None, None, None), (None, None, None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_manifest_is_the_plain_tree(spark, monkeypatch, levels):
    """Chunks of 3, 9 and 729 nodes: several rounds in both trees, and one."""
    monkeypatch.setattr(manifest, "LEVELS", levels)
    rows = some_rows(120, levels)
    df = spark.createDataFrame(rows, DOCS).selectExpr("*", "'x' AS tree", "1 AS place", "2 AS digest").repartition(5)
    found = sorted((tuple(r) for r in manifest.tamper_report(df).collect()), key=repr)
    wanted = plain_report(rows)
    assert found == wanted
    assert {r[-1] for r in found} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28, 30])
def test_sizes_around_whole_runs(spark, monkeypatch, n):
    monkeypatch.setattr(manifest, "LEVELS", 2)
    rows = [(i, f"t{i}\n", "en", "s", i) for i in range(n)]
    found = sorted((tuple(r) for r in manifest.tamper_report(spark.createDataFrame(rows, DOCS)).collect()), key=repr)
    assert found == plain_report(rows)


def test_many_sources_of_one_row(spark, monkeypatch):
    monkeypatch.setattr(manifest, "LEVELS", 1)
    rows = [(i, "t", "en", f"s{i}", 1) for i in range(40)]
    found = sorted((tuple(r) for r in manifest.tamper_report(spark.createDataFrame(rows, DOCS)).collect()), key=repr)
    assert found == plain_report(rows)


def test_empty_table(spark):
    assert manifest.tamper_report(spark.createDataFrame([], DOCS)).count() == 0


def test_queue_delivers_by_label():
    leaves = [sha(str(i)) for i in range(20)]
    top, nodes = manifest.forward(leaves, 3)
    assert [label for label, _ in nodes] == sorted(label for label, _ in nodes)
    levels = plain_tree(leaves)
    assert top == levels[-1][0]
    assert manifest.backward(nodes, (), 20) == [tuple(plain_proof(levels, i)) for i in range(20)]
