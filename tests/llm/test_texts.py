"""Near copies, secrets, mixing, fingerprints, shards and language on odd and planted texts."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from catalith.llm import language_id, licenses, merkle, mixing, near_text, secrets, sharding, words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def odd_rows():
    """Nulls in every column, empty and very long texts, repeats, ties."""
    long_text = " ".join(f"word{i % 977} filler{i % 13}" for i in range(40_000))
    rows = [
        (1, "one two three four five six seven", "en", "a"),
        (2, "ONE two three four five six seven", "en", "a"),
        (3, "", "en", "b"),
        (4, None, "en", "b"),
        (5, "alone", "de", None),
        (6, long_text, None, "c"),
        (7, long_text + " end", "en", "c"),
        (8, "ça va\n\nbien 😀\n", "fr", "c"),
        (None, "one two three four five six seven", "en", "a"),
        (None, "nothing like the others at all here", None, None),
        (9, "same row", "en", "a"),
        (9, "same row", "en", "a"),
        (9, "same id, other text", "en", "a"),
        (10, " \t\n ", "en", "d"),
    ]
    return [(k, t, lang, source, None if t is None else len(t)) for k, t, lang, source in rows]


@pytest.fixture(scope="module")
def odd(spark):
    # Names that the operators use inside, as columns of the table.
    clashing = ("size", "class", "node", "root", "body", "row_key", "text_hash", "shard", "part", "spans", "language")
    df = spark.createDataFrame(odd_rows(), SCHEMA)
    return df.select("*", *(F.lit("x").alias(c) for c in clashing)).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def planted(seed=3, groups=60):
    """Documents with near and exact copies of many degrees, by a fixed seed."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice((1, 3, 20, 60, 150)))]
        for _ in range(rng.choice((1, 1, 2, 5, 12))):
            copy = list(base)
            for _ in range(int(len(copy) * rng.choice((0, 0, 0.02, 0.05, 0.08)))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append(" ".join(copy))
    rng.shuffle(rows)
    return [(i, t, "en", f"s{i % 5}", len(t)) for i, t in enumerate(rows)]


def brute_components(rows, width, percent):
    sets = {}
    for key, text in rows:
        found = [w.lower() if w.isascii() else w for w in WORD.findall(text or "")]
        n = min(width, len(found))
        sets[key] = {tuple(found[i : i + n]) for i in range(len(found) - n + 1)} if found else set()
    least = {k: k for k in sets}

    def find(k):
        while least[k] != k:
            k = least[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= percent * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                least[high] = low
    return {k: (len(sets[k]), find(k)) for k in keys}


@pytest.mark.parametrize("width, broadcast_rows", [(2, 1000), (2, 0), (5, 1000)])
def test_near_copies_agree_with_all_pairs(spark, width, broadcast_rows):
    rows = planted()
    df = spark.createDataFrame(rows, SCHEMA)
    found = near_text.near_duplicates(df, width=width, broadcast_rows=broadcast_rows).collect()
    wanted = brute_components([r[:2] for r in rows], width, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == wanted
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_a_large_group_of_near_copies_is_compared_in_blocks(spark, monkeypatch):
    rng = random.Random(1)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(90):
        copy = list(base)
        copy[rng.randrange(60)] = f"x{i}"
        rows.append((i, " ".join(copy), "en", "a", 0))
    df = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(near_text, "NODE", 16)
    monkeypatch.setattr(near_text, "BLOCK", 16)
    found = near_text.near_duplicates(df, width=2).collect()
    wanted = brute_components([r[:2] for r in rows], 2, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == wanted


def test_near_copies_of_odd_rows(odd, none):
    found = near_text.near_duplicates(odd, width=2).collect()
    assert len(found) == 14
    by_key = {r.doc_id: r for r in found if r.doc_id is not None and r.doc_id != 9}
    assert by_key[1].component_id == by_key[2].component_id == 1
    assert by_key[7].component_id == 6 and not by_key[7].kept
    assert by_key[3].n_shingles == by_key[4].n_shingles == by_key[10].n_shingles == 0
    assert by_key[3].kept and by_key[4].kept and by_key[5].n_shingles == 1
    assert sorted((r.component_id or -1) for r in found if r.doc_id is None) == [-1, 1]
    kept = near_text.one_of_each(odd, width=2)
    assert kept.columns == odd.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter({1: 1, 3: 1, 4: 1, 5: 1, 6: 1, 8: 1, 9: 2, 10: 1, None: 1})
    assert near_text.near_duplicates(none).count() == 0


def test_one_of_each_whatever_the_ids(spark):
    base = [f"w{i}" for i in range(60)]

    def near(name, at=None):
        return " ".join(f"{name}{w}" if i != at else f"{name}other" for i, w in enumerate(base))

    rows = [(None, near("a")), (None, near("a", 0)), (None, near("a", 59)), (None, near("a"))]
    rows += [(5, near("b")), (5, near("b", 0)), (5, near("b").upper()), (7, near("b", 59))]
    rows += [(None, near("c")), (8, near("c", 0)), (8, near("c", 0)), (9, near("c"))]
    rows += [(None, near("d")), (None, near("d").upper()), (6, None), (6, None), (6, ""), (None, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = Counter((r.doc_id, (r.text or "")[:1].lower()) for r in near_text.one_of_each(df, width=2).collect())
    assert found == Counter({(None, "a"): 1, (5, "b"): 1, (8, "c"): 1, (None, "d"): 1, (6, ""): 2, (None, " "): 1})


def test_shingles_of_a_text_in_blocks(monkeypatch):
    text = " ".join(f"Word{i % 91} é{i % 7}" for i in range(3000)).encode()
    import numpy as np

    data = np.frombuffer(text, dtype=np.uint8)
    whole = words.shingle_set(data, 3)
    monkeypatch.setattr(words, "BLOCK", 64)
    assert (words.shingle_set(data, 3) == whole).all()
    assert len(whole) == len({tuple(text.split()[i : i + 3]) for i in range(5998)})


@pytest.mark.parametrize("percent", [0, 55, 79, 101])
def test_similarities_that_would_lose_links_are_refused(none, percent):
    with pytest.raises(ValueError):
        near_text.near_duplicates(none, percent=percent)
    with pytest.raises(ValueError):
        near_text.one_of_each(none, percent=percent)


def brute_spans(text):
    found = []
    for m in re.finditer(secrets.ASSIGN.replace(r"(?i)", ""), text, re.I | re.A):
        if len(m[2]) >= 12:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def brute_peak(run, width):
    best = 0.0
    for i in range(len(run) - width + 1):
        counts = Counter(run[i : i + width]).values()
        best = max(best, -sum(c / width * math.log2(c / width) for c in counts))
    return round(best, 9)


def brute_segments(text):
    """Segments of the runs between blanks, by plain loops over all windows."""
    found = set()
    for letters, width, bits, fold in (("A-Za-z0-9+/_-", 20, 3.8, False), ("0-9A-F", 16, 3.0, True)):
        for run in re.finditer(f"[{letters}]{{20,}}", text):
            shown = run[0].lower() if fold else run[0]
            blank = [False] * len(shown)
            uuid = "[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
            for pattern in (uuid, "example", "sample", "placeholder", "dummy", "changeme", "x{8}", "0{8}", "12345678"):
                now = "".join(" " if b else c for c, b in zip(shown, blank, strict=True))
                for m in re.finditer(pattern, now, re.I):
                    blank[m.start() : m.end()] = [True] * len(m[0])
            now = "".join(" " if b else c for c, b in zip(shown, blank, strict=True))
            for m in re.finditer("[A-Za-z0-9]+", now):
                if m[0].isalpha() or m[0].isdigit():
                    blank[m.start() : m.end()] = [True] * len(m[0])
            now = "".join(" " if b else c for c, b in zip(shown, blank, strict=True))
            at = 0
            for piece in now.split(" "):
                core = piece.strip("+/_-")
                start = run.start() + at + piece.find(core) if core else 0
                if len(core) >= width and brute_peak(core, width) >= bits:
                    found.add((start, start + len(core)))
                at += len(piece) + 1
    return found


def test_secrets_agree_with_a_plain_scan(spark):
    rng = random.Random(5)
    bits = ["password=", "Token : '", 'api_key="', "secret", " ", "AKIA", "ABCDEFGH01234567", "deadbeef", "0123456789abcdef",
            "token: token: abcdefghijklmnop", "é😀", "\n", "zZ9-_x", "passwd=short ", "sample-app/keys/", "550e8400-e29b-41d4-a716-446655440000",
            "2023-01-02-some-title", "k3J9x12345678Qw", "A1B2C3D4E5F60718", "hF8kQ2zR7mW4tY9c", "/", "EXAMPLE", "qT7vX2mK9pL4wR8sN3bY6", "AKIAAKIA", "=", "."]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(0, 120))) for _ in range(150)]
    texts += ["token=abcdefghijkl " * 300, "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in secrets.secret_report(df).collect():
        text = texts[r.doc_id] or ""
        base = brute_spans(text)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[1] == k for s in base) for k in range(3))
        shown = [f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in base]
        assert r.base_sha256 == hashlib.sha256(",".join(shown).encode()).hexdigest()
        extra = [s for s in r.spans.split(",") if s.startswith("entropy")]
        wanted = {f"entropy:{a}:{b}" for a, b in brute_segments(text) if not any(c <= a and b <= d for c, _, d in base)}
        assert set(extra) == wanted
        assert [s for s in r.spans.split(",") if s and not s.startswith("entropy")] == shown


KEY = "wJalrXUtn5FEMI3K7MDENG2bPxRfiCYzQ8vT4hLs"


def test_keys_behind_allowed_words_are_found(spark):
    half = "q" + KEY[::-1][:25] + "12345678" + KEY
    slug = "how-to-grow-tomatoes-2023"
    texts = [f"see sample-app/keys/{KEY} here", half, slug, "550e8400-e29b-41d4-a716-446655440000", "Ab1" + KEY[3:] + "99",
             "abcdefghijklmnopqrstuvwx" + "1234", "a/path/to/some/file/name/2023/12/report"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.spans for r in secrets.secret_report(df).collect()}
    assert found == {0: "entropy:20:60", 1: "entropy:0:26,entropy:34:74", 2: "", 3: "", 4: "entropy:0:42", 5: "entropy:0:28", 6: ""}


def test_very_long_runs_are_scanned_in_linear_time(spark):
    rng = random.Random(8)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    texts = ["ab-" * 400_000 + "x9", "".join(rng.choice(letters) for _ in range(1_000_000)), "z1" * 500_000, "a1-" * 300_000 + KEY,
             ("/" + KEY + " ") * 2_000, ("token=" + KEY + " ") * 5_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    found = {r.doc_id: r.spans for r in secrets.secret_report(df).collect()}
    # Lengths and counts only: a failed comparison of such texts would take longer than the scan.
    assert (len(found[0]), len(found[2]), found[3][:40]) == (0, 0, f"entropy:0:{len(texts[3])}")
    covered = sum(int(s.split(":")[2]) - int(s.split(":")[1]) for s in found[1].split(","))
    assert covered > 0.9 * len(texts[1])
    assert (found[4].count("entropy"), found[5].count("assign"), found[5].count("entropy")) == (2_000, 5_000, 0)


def test_redaction_leaves_the_rest(spark, odd, none):
    text = "a token=0123456789abcdef0123 b qT7vX2mK9pL4wR8sN3bY6 c"
    df = spark.createDataFrame([(1, text), (2, "clean"), (3, None)], "doc_id long, text string")
    found = {r.doc_id: r.text for r in secrets.redact_secrets(df).collect()}
    assert found == {1: "a [SECRET] b [SECRET] c", 2: "clean", 3: None}
    same = secrets.redact_secrets(odd)
    assert same.columns == odd.columns
    assert sorted(map(str, same.collect())) == sorted(map(str, odd.collect()))
    assert secrets.secret_report(none).count() == 0


def plain_targets(sizes):
    names = sorted((n for n in sizes if n is not None)) + [n for n in sizes if n is None]
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    target, left, open_ = {n: 0.0 for n in names}, float(sum(sizes.values())), set(names)
    while left > 1e-9 and open_:
        total = sum(weight[n] for n in open_)
        share = {n: left * weight[n] / total for n in open_}
        left = 0.0
        for n in list(open_):
            target[n] += share[n]
            if target[n] >= 3 * sizes[n]:
                left += target[n] - 3 * sizes[n]
                target[n] = float(3 * sizes[n])
                open_.discard(n)
    return target


def test_mixture_meets_its_targets(spark):
    rng = random.Random(2)
    names = [f"s{i}" for i in range(6)] + [None]
    rows = [(i, "w " * int(rng.paretovariate(1.2) * 20 % 3000), "en", names[min(int(rng.expovariate(0.7)), 6)], 0) for i in range(1500)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = mixing.mix_report(df).collect()
    assert sorted(map(str, mixing.mix_report(df.repartition(5)).collect())) == sorted(map(str, found))
    source, sizes, taken = {r[0]: r[3] for r in rows}, defaultdict(int), defaultdict(int)
    for r in found:
        assert r.size == len(WORD.findall(rows[r.doc_id][1])) and r.taken == r.copies * r.size and r.taken <= 3 * r.size
        sizes[source[r.doc_id]] += r.size
        taken[source[r.doc_id]] += r.taken
    wanted = plain_targets(sizes)
    for r in found:
        assert r.source_size == sizes[source[r.doc_id]] and r.target == pytest.approx(wanted[source[r.doc_id]])
    for name, target in wanted.items():
        assert taken[name] == pytest.approx(target, rel=0.02)
    assert mixing.mix(df).groupBy().agg(F.sum(mixing.word_count(F.col("text")))).first()[0] == sum(taken.values())


def test_rates_solve_the_dual(spark):
    rng = random.Random(4)
    counts = [("=a", rng.randrange(1, 500), rng.randrange(1, 9)) for _ in range(200)]
    counts = spark.createDataFrame(list({c[1]: c for c in counts}.values()), "source_key string, size long, n long")
    rows = counts.collect()
    size = sum(r.n * r.size for r in rows)
    for share in (0.05, 0.6, 1.0, 2.2, 2.98, 3.0):
        targets = spark.createDataFrame(
            [("=a", size, size / sum(r.n for r in rows), min(r.size for r in rows), share * size)],
            "source_key string, source_size long, mean double, least long, target double",
        )
        state = mixing.balance(counts, targets).first()
        words_taken = sum(r.n * r.size * min(3, math.exp(min(2, state.tilt * r.size / state.mean))) for r in rows)
        assert words_taken == pytest.approx(share * size, rel=1e-6)


def test_mixture_of_odd_rows(odd, none):
    found = mixing.mix_report(odd).collect()
    assert len(found) == 14
    assert all(r.copies == 1 and r.taken == 0 for r in found if r.size == 0)
    again = mixing.mix(odd)
    assert again.columns == odd.columns and again.count() == sum(r.copies for r in found)
    assert mixing.mix_report(none).count() == 0 and mixing.mix(none).count() == 0


def test_fingerprints_of_odd_rows(odd, none, spark):
    found = merkle.edited_fingerprints(odd).collect()
    assert len(found) == 14
    order = sorted({(k is None, -(k or 0), t or "") for k, t, *_ in odd_rows()}, key=lambda x: x[:2])
    roots = {}
    for r in found:
        roots.setdefault(r.fingerprint, set()).add(r.n_chars)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    texts = {t or "" for _, t, *_ in odd_rows()}
    assert len(roots) == len(texts)
    # Key 8 comes before 7, so half of it is replaced by the start of 7's text.
    by_key = {r.doc_id: r for r in found}
    text, other = (dict((k, t) for k, t, *_ in odd_rows())[k] for k in (8, 7))
    half = len(text) // 2
    assert by_key[8].edited_sha256 == hashlib.sha256((text[: len(text) - half] + other[:half]).encode()).hexdigest()
    # The first comes after the last, a null key.
    assert len(order) == 13 and merkle.edited_fingerprints(none).count() == 0
    single = merkle.edited_fingerprints(spark.createDataFrame([(1, "abcd")], "doc_id long, text string")).first()
    assert single.near_next == 1.0 and single.edited_sha256 == hashlib.sha256(b"abab").hexdigest()


def plain_tree(text):
    """Sections as tuples of paragraphs, those as tuples of spans."""
    cut = re.compile("(?:[^\\n]{0,126}?[ds] |[^\\n]{1,128})")
    return [tuple(tuple(cut.findall(p)) for p in s.split("\n")) for s in text.split("\n\n")]


def plain_likeness(a, b):
    """Equal leaves by plain sets of branches, from the top."""

    def below(branch):
        return 1 if isinstance(branch, str) else sum(map(below, branch))

    left, right, equal = set(plain_tree(a)), set(plain_tree(b)), 0
    for _ in range(2):
        equal += sum(map(below, left & right))
        left, right = ({c for x in one - other for c in x if c} for one, other in ((left, right), (right, left)))
    equal, apart = equal + len(left & right), len(left ^ right)
    return 2 * equal / (2 * equal + apart) if equal + apart else float(plain_tree(a) == plain_tree(b))


def test_likeness_walks_the_differing_branches(spark):
    rng = random.Random(6)
    words_ = ["roads", "and", "bridges", "of", "the", "old", "town", "é😀s", "x" * 300, "end"]
    text = "".join(rng.choice(words_) + rng.choice((" ", " ", " ", "\n", "\n\n")) for _ in range(600))
    pairs = [(text, text), (text, "x" + text), (text, text[:1500] + "!" + text[1500:]), (text, text[::-1]), ("", ""), ("", "\n"),
             (text, "\n\n".join(reversed(text.split("\n\n")))), ("", text), ("a", "b"), ("s s", "s s\ns s"), (text[:900], text[300:])]
    line = "".join(rng.choice(words_[:7]) + " " for _ in range(500))[:3000]
    pairs.append((line, "x" + line))
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    trees = df.select("i", merkle.tree(F.col("a")).alias("a"), merkle.tree(F.col("b")).alias("b"))
    found = trees.select("i", merkle.likeness(F.col("a"), F.col("b")).alias("near")).collect()
    assert {r.i: r.near for r in found} == pytest.approx({i: plain_likeness(a, b) for i, (a, b) in enumerate(pairs)})
    near = {r.i: r.near for r in found}
    # One inserted character, in front or within, changes what is around it only; moved sections stay equal.
    assert near[0] == near[4] == near[6] == 1.0 and min(near[1], near[2], near[len(pairs) - 1]) > 0.9
    assert near[5] == near[7] == near[8] == 0.0


def test_trees_of_long_texts_are_walked_in_linear_time(spark):
    a = "\n".join(f"line {i} of words" for i in range(60_000))
    b = "\n\n".join(f"part {i}s of words" for i in range(60_000))
    df = spark.createDataFrame([(1, a), (2, b), (3, "ab" * 500_000)], "doc_id long, text string")
    found = {r.doc_id: r for r in merkle.edited_fingerprints(df).collect()}
    assert found[1].near_next == 0.0 and found[2].near_next == 0.0 and found[2].near_edited > 0.5


def test_differing_paragraphs(spark):
    a, b = "one\ntwo\n\nthree\nfour\n\nfive", "one\ntwo\n\nthree\nFOUR\nnew\n\nfive"
    row = spark.createDataFrame([(a, b)], "a string, b string").select(
        merkle.differing(merkle.tree(F.col("a")), merkle.tree(F.col("b"))).alias("d"),
        merkle.differing(merkle.tree(F.col("a")), merkle.tree(F.col("a"))).alias("same"),
    ).first()
    assert [tuple(x) for x in row.d] == [(1, 1), (1, 2)] and row.same == []


def plain_schedule(groups, shards):
    loads = [0] * shards
    for size in sorted(groups, reverse=True):
        loads[loads.index(min(loads))] += size
    return sorted(loads)


def test_shards_follow_the_schedule(spark, odd, none):
    rows = planted()
    found = sharding.assign_shards(spark.createDataFrame(rows, SCHEMA).repartition(4), shards=7).collect()
    text = {r[0]: r[1] for r in rows}
    groups, shard_of, loads, slots = Counter(), defaultdict(set), Counter(), defaultdict(list)
    for r in found:
        assert r.size == len(text[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode())
        groups[text[r.doc_id]] += r.size
        shard_of[text[r.doc_id]].add(r.shard)
        loads[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in shard_of.values())
    assert sorted(loads.values()) == plain_schedule(groups.values(), 7)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    strange = sharding.assign_shards(odd, shards=3).collect()
    assert len(strange) == 14 and {r.size for r in strange if r.doc_id in (3, 4)} == {1}
    assert sharding.assign_shards(none).count() == 0


def test_small_groups_travel_in_bundles(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(sharding, "SINGLE", 16)
    monkeypatch.setattr(sharding, "BUNDLES", 64)
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 4000).alias("text"))
    found = sharding.assign_shards(df, shards=4).collect()
    loads = Counter()
    for r in found:
        loads[r.shard] += r.size
    assert len(found) == 5000 and max(loads.values()) - min(loads.values()) < 0.02 * sum(loads.values())
    sharding.write_shards(df, str(tmp_path / "out"), shards=4)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5000


WORDS = {
    "en": "the of and to in that was his with for this have from they which were would there their been".split(),
    "de": "der die und den von das nicht ein eine auch sich werden wird auf für ist mit dem zur über schön".split(),
    "fr": "le la les des une est dans pour que qui sur pas avec sont plus été très même où français".split(),
}


def language_rows(n=300):
    rng = random.Random(8)
    rows = []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        rows.append((i, " ".join(rng.choice(WORDS[lang]) for _ in range(rng.choice((8, 30, 200)))), lang, "a", 0))
    return rows


def test_language_of_held_out_texts(spark):
    rows = language_rows()
    found = language_id.language_report(spark.createDataFrame(rows, SCHEMA)).collect()
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0}
    assert all(r.lang_pred == rows[r.doc_id][2] for r in held)
    assert all(0 <= r.score <= 1 and not r.rejected for r in found)


def test_language_of_odd_rows(spark, odd, none):
    df = odd.select("doc_id", "text", "lang", "source", "n_chars", "language", "body")
    learned = spark.createDataFrame([(100 + k, *r) for k, *r in language_rows()], SCHEMA)
    both = df.unionByName(learned.withColumns({"language": F.lit("x"), "body": F.lit("x")}))
    found = [r for r in language_id.language_report(both).collect() if r.doc_id is None or r.doc_id < 100]
    unknown = {r.doc_id for r in found if r.lang_pred == "und"}
    assert len(found) == 14 and unknown == {3, 4, 10}
    assert all(r.score == 0 and r.rejected for r in found if r.lang_pred == "und")
    kept = language_id.keep_known(both)
    assert kept.columns == both.columns
    gone = {r.doc_id for r in both.select("doc_id").collect()} - {r.doc_id for r in kept.select("doc_id").collect()}
    assert {3, 4, 10} <= gone
    assert language_id.language_report(none).count() == 0
    assert {r.lang_pred for r in language_id.language_report(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_copies_do_not_change_what_is_learned(spark):
    rows = [r[:3] for r in language_rows()]
    own = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    copies = spark.createDataFrame([(0, rows[i][1], rows[i][2]) for i in range(3) for _ in range(400)], own.schema)
    one, more = (language_id.train(df, docs=60) for df in (own, own.unionByName(copies)))
    assert one.languages == more.languages == sorted(WORDS)
    assert all((a[0] == b[0]).all() and (a[1] == b[1]).all() for a, b in zip(one.grams, more.grams, strict=True))
    assert one.mean.tolist() == pytest.approx(more.mean.tolist()) and one.limit == pytest.approx(more.limit)


def test_unlearned_languages_and_noise_are_rejected(spark):
    rng = random.Random(4)
    finnish = "ja on ei se että hän oli mutta niin kun tämä mitä sitten vain koko myös jälkeen työtä yhdessä kyllä".split()
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = language_rows(600)
    unlearned = [" ".join(rng.choice(finnish) for _ in range(n)) for n in (12, 40, 200) for _ in range(10)]
    noise = ["".join(rng.choice(letters) for _ in range(n)) for n in (30, 64, 400) for _ in range(10)]
    noise += [" ".join("".join(rng.choice(letters) for _ in range(6)) for _ in range(12)) for _ in range(10)]
    clean = [" ".join(rng.choice(WORDS[lang]) for _ in range(n)) for lang in WORDS for n in (1, 2, 4, 12) for _ in range(10)]
    texts = [*unlearned, *noise, *clean]
    extra = [(1000 + i, t, None, "a", 0) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows + extra, SCHEMA)
    rejected = {r.doc_id for r in language_id.language_report(df).collect() if r.rejected}
    assert rejected == {1000 + i for i in range(len(unlearned) + len(noise))}
    kept = {r.doc_id for r in language_id.keep_known(df).select("doc_id").collect()}
    assert kept == {r[0] for r in rows + extra} - rejected


def test_models_sum_to_one():
    counts = Counter()
    text = "   the cat sat on the mat and the rat sat on the cat "
    counts.update(text[i : i + 4] for i in range(len(text) - 3))
    model = language_id.KneserNey(dict(counts))
    letters = sorted({g[0] for g in model.counts[1]})
    for context in ("the", " ca", "zzz", "at "):
        seen = sum(model.probability(context + c) for c in letters)
        unseen = model.probability(context + "#") * (model.alphabet - len(letters))
        assert seen + unseen == pytest.approx(1)
    models = language_id.Models({"xx": dict(counts)})
    line = "   the dog sat "
    codes = language_id.np.frombuffer(line.encode("utf-32-le"), dtype="uint32")
    wanted = [math.log(model.probability(line[i : i + 4])) for i in range(len(line) - 3)]
    assert models.log_probabilities(codes)[:, 0].tolist() == pytest.approx(wanted, rel=1e-5)


def plain_dice(a, b):
    x, y = licenses.bigrams(licenses.words(a)), licenses.bigrams(licenses.words(b))
    return 2 * (x & y).total() / (x.total() + y.total())


def test_license_scan(spark, odd, none):
    mit = licenses.TEMPLATES["MIT-text"]
    rows = [
        (1, "Some page.\n" + mit.replace("persons", "people") + "\nThe end of the page."),
        (2, "Intro\nReleased under the MIT license\nLicensed under CC BY-NC 4.0."),
        (3, "released to the public of the city in the year"),
        (4, mit),
        (5, "x " * 50_000 + ". Licensed under the Apache License, Version 2.0. " + "y " * 50_000),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = defaultdict(list)
    for r in licenses.scan_licenses(df).collect():
        found[r.doc_id].append((r.license, round(r.dice, 6), r.first_line, r.last_line))
    assert found[1] == [("MIT-text", round(plain_dice(mit, mit.replace("persons", "people")), 6), 1, 1)]
    assert found[2] == [("MIT", 1.0, 1, 1), ("CC-BY-NC-4.0", 1.0, 2, 2)]
    assert 3 not in found and found[4] == [("MIT-text", 1.0, 0, 0)] and found[5] == [("Apache-2.0", 1.0, 0, 0)]
    assert licenses.scan_licenses(odd).count() == 0 and licenses.scan_licenses(none).count() == 0


def test_license_pruning_loses_nothing():
    rng = random.Random(6)
    templates = {f"t{i}": " ".join(rng.choice("abcdefgh") for _ in range(rng.choice((2, 5, 12, 40)))) for i in range(12)}
    scanner = licenses.Templates(templates, licenses.LEAST)
    for _ in range(300):
        words_ = templates[rng.choice(list(templates))].split()
        for _ in range(rng.randrange(0, 4)):
            words_[rng.randrange(len(words_))] = rng.choice("abcdefghxyz")
        line = " ".join(words_)
        dices = sorted(((-plain_dice(line, t), n) for n, t in templates.items()))
        best = [(n, -d) for d, n in dices if -d >= licenses.LEAST][:1]
        got = [(name, dice) for name, dice, _, _ in scanner.scan(line)]
        assert [g[0] for g in got] == [b[0] for b in best]
        assert [g[1] for g in got] == pytest.approx([b[1] for b in best])


def test_licenses_within_lines(spark):
    filler = " ".join(f"word{i}" for i in range(3000))
    header, gpl = licenses.TEMPLATES["Apache-2.0-header"], licenses.TEMPLATES["GPL-3.0-header"]
    plain = " ".join(licenses.words(header))
    texts = [
        "All documentation in this file is released under the MIT License",
        "Home | About, Released under the MIT License - Licensed under CC BY-NC 4.0 Contact",
        f"{filler} {plain} {filler}",
        f"first line\n{filler} {header.replace('permissions', 'rights')} {filler}",
        f"{filler} {gpl} Released under the MIT License, {filler}",
        "Released under the MIT License " * 3,
        "released to the public under a license of the city",
        "İ İ\nreleased\nunder the MIT License of today",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = defaultdict(list)
    for r in licenses.scan_licenses(df).collect():
        found[r.doc_id].append((r.license, r.dice == 1.0, r.first_line, r.last_line))
    assert found[0] == [("MIT", True, 0, 0)]
    assert found[1] == [("MIT", True, 0, 0), ("CC-BY-NC-4.0", True, 0, 0)]
    assert found[2] == [("Apache-2.0-header", True, 0, 0)]
    assert found[3] == [("Apache-2.0-header", False, 1, 1)]
    assert found[4] == [("GPL-3.0-header", True, 0, 0), ("MIT", True, 0, 0)]
    assert found[5] == [("MIT", True, 0, 0)] * 3
    assert 6 not in found and found[7] == [("MIT", True, 1, 2)]


def test_runs_of_words_agree_with_all_runs():
    rng = random.Random(9)
    templates = {f"t{i}": " ".join(rng.choice("abcdefgh") for _ in range(rng.choice((1, 2, 5, 12, 20)))) for i in range(9)}
    scanner = licenses.Templates(templates, licenses.LEAST)
    for _ in range(60):
        text = " ".join(rng.choice("abxyz") for _ in range(rng.randrange(12)))
        for _ in range(rng.randrange(1, 4)):
            part = templates[rng.choice(list(templates))].split()
            part[rng.randrange(len(part))] = rng.choice("abx")
            text += " " + " ".join(part)
        found, runs = text.split(), []
        for i in range(len(found)):
            for j in range(i + 1, len(found) + 1):
                grams = licenses.bigrams(found[i:j])
                for t, (_, own, n) in enumerate(scanner.known):
                    common = (grams & own).total()
                    dice = 2 * common / (grams.total() + n)
                    if dice >= licenses.LEAST:
                        runs.append((licenses.LEAST * (grams.total() + n) - 2 * common, j - i, i, t, j - 1, dice))
        chosen = []
        for run in sorted(runs):
            if all(run[4] < c[2] or run[2] > c[4] for c in chosen):
                chosen.append(run)
        wanted = [(scanner.known[t][0], dice) for _, _, _, t, _, dice in sorted(chosen, key=lambda c: c[2])]
        assert [f[:2] for f in scanner.find(text)] == wanted


@pytest.mark.parametrize("place", range(5))
def test_stages_take_odd_and_no_rows(spark, odd, none, place):
    import corpus_pipeline

    _, stage = corpus_pipeline.STAGES[place]
    found = stage(spark, odd, "")
    assert found.count() > 0 and (place == 4 or found.columns == odd.columns)
    assert stage(spark, none, "").count() == 0
