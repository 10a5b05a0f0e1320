"""URL rules and the learned verdict against a plain model."""

from __future__ import annotations

import hashlib
import math

import pytest

from catalith.llm import url_filter

PAGES = "page_id long, url string, html string"
ODD = [
    (1, None, None), (2, "", ""), (3, "no scheme", ""), (4, "http://", ""), (5, "http://Com", ""), (6, "http://com/", ""),
    (7, "https://A.EXAMPLE.com/en/x?y=/z#t", ""), (8, "http://www.example.com/en/", ""), (9, "http://x.www.example.com/en/1", ""),
    (10, "http://notexample.com/en/1", ""), (11, "http://a.net/es/1", ""), (12, "http://a.net/es", ""), (13, "http://net/fr/#", ""),
    (14, "http://a.net?x/fr/", ""), (15, "http://a.net#/fr/", ""), (16, "x://http://b.com/c", ""), (17, "http://É.com/ß😀/a\nb", ""),
    (18, "http://a.org:80/p", ""), (19, "http://com./", ""), (20, "http://.com/", ""), (20, "http://.com/", ""), (None, "http://a.org/x", ""),
    (21, "http://" + "a." * 50_000 + "org/" + "é" * 300_000 + "?" + "q" * 100_000, ""),
]


def plain_parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    stop = next((i for i, c in enumerate(rest) if c in "?#" and i >= end), len(rest))
    return host, rest[end:stop]


def plain_features(url):
    host, path = plain_parse(url)
    found = set()
    for mark, text in (("h", f"^{host}$"), ("p", f"{path}$")):
        for i in range(len(text) - url_filter.GRAM + 1):
            found.add(int(hashlib.md5((mark + text[i : i + url_filter.GRAM]).encode()).hexdigest()[:3], 16))
    return sorted(found)


def plain_odds(weights, features):
    total = sum(weights[b] for b in features)
    return (total / math.sqrt(len(features)) if features else 0.0) + weights[-1]


def plain_train(labelled):
    weights = [0.0] * (url_filter.BUCKETS + 1)
    rows = [(plain_features(u), float(y)) for u, y in labelled if y is not None]
    for _ in range(url_filter.STEPS if rows else 0):
        gradient = [0.0] * len(weights)
        for features, y in rows:
            error = y - 1 / (1 + math.exp(-plain_odds(weights, features)))
            gradient[-1] += error
            for b in features:
                gradient[b] += error / math.sqrt(len(features))
        shrink = 1 - url_filter.RATE * url_filter.PENALTY
        weights = [
            w * (shrink if b < url_filter.BUCKETS else 1) + url_filter.RATE * g / len(rows)
            for b, (w, g) in enumerate(zip(weights, gradient, strict=True))
        ]
    return weights


def plain_rule(host, path, rules=url_filter.RULES):
    fit = [
        (len(h + p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fit)[2:] if fit else (None, None)


BUILT_IN = [*((u, False) for u in url_filter.ALLOWED_URLS), *((u, True) for u in url_filter.BLOCKED_URLS)]


def test_report_is_the_plain_model(spark):
    rows = ODD + [(100 + i, u, "") for i, (u, _) in enumerate(BUILT_IN)]
    df = spark.createDataFrame(rows, PAGES).selectExpr("*", "'x' AS host", "'y' AS verdict", "1 AS __fit").repartition(4)
    weights = plain_train(BUILT_IN)
    wanted = []
    for page_id, url, _ in rows:
        host, path = plain_parse(url)
        odds = plain_odds(weights, plain_features(url))
        rule, verdict = plain_rule(host, path)
        wanted.append((page_id, host, path, rule, verdict or ("block" if odds > 0 else "allow"), 1 / (1 + math.exp(-odds))))
    found = sorted((tuple(r) for r in url_filter.url_report(df).collect()), key=repr)
    wanted = sorted(wanted, key=repr)
    wrong = [(a, b) for a, b in zip(found, wanted, strict=True) if a[:5] != b[:5] or not abs(a[5] - b[5]) < 2e-6]
    assert [(a[0], a[5], b[0], b[5]) for a, b in wrong] == []


def test_learned_verdicts_hold_on_urls_left_out(spark):
    """Every third labelled URL is left out of the fit."""
    fit = [r for i, r in enumerate(BUILT_IN) if i % 3]
    left_out = [(i, u, str(y)) for i, (u, y) in enumerate(BUILT_IN) if not i % 3]
    model = url_filter.train(spark.createDataFrame(fit, "url string, blocked boolean")).first()["weights"]
    judged = url_filter.judge(spark.createDataFrame(left_out, PAGES), model, rules=()).collect()
    right = sum((r.verdict == "block") == (r.html == "True") for r in judged)
    assert right >= 0.85 * len(left_out), right


def test_rules_in_general(spark):
    rules = (("block", "a", ""), ("allow", "b.a", ""), ("block", "a", "/longer/path"), ("allow", "c.b.a", "/x"))
    urls = ["s://a", "s://b.a/longer/path", "s://c.b.a/x", "s://d.c.b.a/xy", "s://ba/", "s://b.a", "s://z.a/longer/path/1"]
    df = spark.createDataFrame([(i, u, "") for i, u in enumerate(urls)], PAGES)
    zero = [0.0] * (url_filter.BUCKETS + 1)
    found = [(r.rule, r.verdict) for r in url_filter.judge(df, zero, rules=rules).orderBy("page_id").collect()]
    plain = [plain_rule(*plain_parse(u), rules) for u in urls]
    assert found == [(rule, verdict or "allow") for rule, verdict in plain]


def test_bounds_and_empty_tables(spark):
    none = spark.createDataFrame([], "url string, blocked boolean")
    assert set(url_filter.train(none).first()["weights"]) == {0.0}
    unlabelled = spark.createDataFrame([("http://a.b/c", None), (None, True), (None, True)], "url string, blocked boolean")
    assert url_filter.train(unlabelled).first()["weights"][-1] > 0
    assert url_filter.url_report(spark.createDataFrame([], PAGES), none).count() == 0
    many = spark.range(url_filter.MAX_LABELLED + 1).selectExpr("'u' AS url", "true AS blocked")
    with pytest.raises(ValueError):
        url_filter.train(many)
    with pytest.raises(ValueError):
        url_filter.judge(spark.createDataFrame([], PAGES), [0.0], rules=[("allow", str(i), "") for i in range(url_filter.MAX_RULES + 1)])


def test_no_python_on_the_main_path(spark):
    df = spark.createDataFrame([(1, "http://a.b/c", "")], PAGES)
    weights = url_filter.train(url_filter.labelled_urls(spark))
    plans = weights._jdf.queryExecution().toString() + url_filter.judge(df, [0.0] * 4097)._jdf.queryExecution().toString()
    assert not any(word in plans for word in ("Python", "InArrow", "InPandas"))
