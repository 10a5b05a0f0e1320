"""One query per operator over its whole table, with SQL where SQL can tell."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.llm import (
    language_id,
    licenses,
    manifest,
    merkle,
    mixing,
    near_text,
    near_vectors,
    pieces,
    secrets,
    sharding,
    url_filter,
    warc,
    whitening,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_warc_archives(spark: SparkSession, folder: str) -> DataFrame:
    manifest = warc.write_archives(_table(spark, folder, "pages"))
    return warc.read_archives(manifest, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op2_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_report(_table(spark, folder, "documents"))


def op3_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors.near_vectors(_table(spark, folder, "embeddings"))


def op4_near_texts(spark: SparkSession, folder: str) -> DataFrame:
    found = near_text.near_duplicates(_table(spark, folder, "documents"), width=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op5_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encode(_table(spark, folder, "documents"), pieces.load_vocabulary(), check=True)


def op6_merkle_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.edited_fingerprints(_table(spark, folder, "documents"))


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.language_report(_table(spark, folder, "documents"))


def op8_shard_documents(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.assign_shards(_table(spark, folder, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, folder, "documents"))


def op10_find_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secret_report(_table(spark, folder, "documents"))


def op11_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.tamper_report(_table(spark, folder, "documents"))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitening_report(_table(spark, folder, "embeddings"))


def op13_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.url_report(_table(spark, folder, "pages"))


QUERIES = {
    "op1_warc_archives": op1_warc_archives,
    "op2_mix_sources": op2_mix_sources,
    "op3_near_vectors": op3_near_vectors,
    "op4_near_texts": op4_near_texts,
    "op5_pieces": op5_pieces,
    "op6_merkle_fingerprints": op6_merkle_fingerprints,
    "op7_language": op7_language,
    "op8_shard_documents": op8_shard_documents,
    "op9_license_scan": op9_license_scan,
    "op10_find_secrets": op10_find_secrets,
    "op11_manifest": op11_manifest,
    "op12_whitening": op12_whitening,
    "op13_url_filter": op13_url_filter,
}

# Fixed value, written apart from the operator's: spans end after a word in d or s, or after 128 code points.
_SPAN = r"[^\n]{0,126}?[ds] |[^\n]{1,128}"


def _tree_sql(text: str) -> str:
    """One text per section: leaves parted by commas, paragraphs by semicolons."""
    leaves = f"array_to_string(list_transform(regexp_extract_all(p, '{_SPAN}'), lambda x: left(md5(x), 16)), ',')"
    paragraphs = f"array_to_string(list_transform(string_split(s, chr(10)), lambda p: {leaves}), ';')"
    return f"list_transform(string_split({text}, chr(10) || chr(10)), lambda s: {paragraphs})"


def _root_sql(tree: str) -> str:
    section = "md5(array_to_string(list_transform(string_split(b, ';'), lambda p: md5(p)), ','))"
    return f"sha256(array_to_string(list_transform({tree}, lambda b: {section}), ','))"


def _without_sql(a: str, b: str) -> str:
    return f"list_filter(list_distinct({a}), lambda x: NOT list_contains({b}, x))"


def _children_sql(branches: str, mark: str) -> str:
    return f"list_filter(list_distinct(flatten(list_transform({branches}, lambda b: string_split(b, '{mark}')))), lambda x: x <> '')"


def _count_sql(branches: str) -> str:
    return f"coalesce(list_sum(list_transform({branches}, lambda b: length(translate(b, ',;', '')) / 16)), 0)"


def _likeness_sql(name: str, source: str, a: str, b: str) -> str:
    """CTEs that end in ``name(doc_id, near)``: equal sections, paragraphs, leaves, from the top."""
    return f"""
{name}_1 AS (
  SELECT doc_id, {a} = {b} AS same, {_count_sql(f"list_intersect({a}, {b})")} AS equal,
         {_children_sql(_without_sql(a, b), ";")} AS l, {_children_sql(_without_sql(b, a), ";")} AS r FROM {source}),
{name}_2 AS (
  SELECT doc_id, same, equal + {_count_sql("list_intersect(l, r)")} AS equal,
         {_children_sql(_without_sql("l", "r"), ",")} AS l, {_children_sql(_without_sql("r", "l"), ",")} AS r FROM {name}_1),
{name}_3 AS (
  SELECT doc_id, same, equal + len(list_intersect(l, r)) AS equal,
         len({_without_sql("l", "r")}) + len({_without_sql("r", "l")}) AS apart FROM {name}_2),
{name} AS (
  SELECT doc_id, CASE WHEN equal + apart > 0 THEN 2.0::DOUBLE * equal / (2 * equal + apart) ELSE same::INT::DOUBLE END AS near
  FROM {name}_3)"""


MERKLE_SQL = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
ring AS (
  SELECT doc_id, body, length(body) AS n_chars,
         coalesce(lead(body) OVER (ORDER BY doc_id DESC), first_value(body) OVER (ORDER BY doc_id DESC)) AS next_body
  FROM texts),
edits AS (
  SELECT *, left(body, n_chars - n_chars // 2) || left(next_body, n_chars // 2) AS edited FROM ring),
parts AS (
  SELECT *, {_tree_sql("body")} AS own, {_tree_sql("edited")} AS changed, {_tree_sql("next_body")} AS follows
  FROM edits),
{_likeness_sql("by_edit", "parts", "own", "changed")},
{_likeness_sql("by_next", "parts", "own", "follows")}
SELECT doc_id, n_chars::BIGINT AS n_chars, sha256(edited) AS edited_sha256,
       {_root_sql("own")} AS fingerprint, {_root_sql("changed")} AS edited_fingerprint,
       by_edit.near AS near_edited, by_next.near AS near_next
FROM parts JOIN by_edit USING (doc_id) JOIN by_next USING (doc_id)
"""

_FIVE_BITS = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(hex, 5 * i + 1, 5))::BIGINT >> {}) & 31)::INT + 1, 1)"
WARC_SQL = f"""
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
ranked AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS top FROM payloads)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(8), lambda i: {" || ".join(_FIVE_BITS.format(n) for n in (15, 10, 5, 0))}), '')
         AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM ranked
"""

# Labels have few vectors here, so all pairs of a label are compared.
VECTORS_SQL = """
WITH RECURSIVE whole AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v, sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS norm
  FROM embeddings),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM whole a JOIN whole b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.norm > 0 AND b.norm > 0 AND isfinite(a.norm) AND isfinite(b.norm)
    AND list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.98),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT reach.a, pairs.b FROM reach JOIN pairs ON reach.b = pairs.a)
SELECT e.vec_id, (SELECT count(*) FROM pairs WHERE pairs.a = e.vec_id)::BIGINT AS n_links,
       min(reach.b) AS component_id, e.vec_id = min(reach.b) AS kept
FROM embeddings e JOIN reach ON reach.a = e.vec_id GROUP BY e.vec_id
"""

TEXTS_SQL = r"""
WITH RECURSIVE listed AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN w
                 ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM listed),
classes AS (SELECT min(doc_id) AS doc_id, s, len(s) AS n FROM (SELECT doc_id, list_sort(s) AS s FROM sets) WHERE len(s) > 0 GROUP BY s),
tokens AS (SELECT doc_id, n, unnest(s) AS t FROM classes),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM tokens a JOIN tokens b
    ON a.t = b.t AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM classes
  UNION SELECT reach.a, pairs.b FROM reach JOIN pairs ON reach.b = pairs.a),
roots AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT sets.doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, coalesce(roots.component_id, sets.doc_id) AS component_id,
       sets.doc_id = coalesce(roots.component_id, sets.doc_id) AS kept
FROM sets LEFT JOIN classes ON len(sets.s) > 0 AND list_sort(sets.s) = classes.s LEFT JOIN roots ON roots.doc_id = classes.doc_id
"""


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _matches_sql(pattern: str, columns: str) -> str:
    """The matches of a pattern in order, with the pieces of text between them."""
    p = _quoted(pattern)
    return (
        f"SELECT doc_id, {columns}, regexp_extract_all(body, {p}) AS f, string_split_regex(body, {p}) AS gaps "
        f"FROM texts WHERE regexp_matches(body, {p})"
    )


def _placed_sql(source: str) -> str:
    """One row per match, with its place in code points."""
    return f"""
  SELECT * EXCLUDE (f, gaps, i), f[i] AS part,
         CAST(list_sum(list_transform(gaps[1:i], lambda g: len(g)))
           + coalesce(list_sum(list_transform(f[1:i - 1], lambda g: len(g))), 0) AS BIGINT) AS start
  FROM (SELECT *, unnest(range(1, len(f) + 1)) AS i FROM {source})"""


# Fixed values, written apart from the operator's: what is blanked, and the classes with width and threshold.
_HARMLESS = (
    ("[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}", 36),
    *((f"(?i:{w})", n) for w, n in (("example", 7), ("sample", 6), ("placeholder", 11), ("dummy", 5), ("changeme", 8))),
    *((w, 8) for w in ("(?i:x{8})", "0{8}", "12345678")),
)
_CLASSES = (("[-+/_0-9A-Za-z]{20,}", 20, 3.8, "false"), ("[0-9A-F]{20,}", 16, 3.0, "true"))


def _blanked_sql(part: str) -> str:
    """``part`` with blanks for harmless matches, and for stretches of letters or of digits between separators."""
    for pattern, size in _HARMLESS:
        part = f"regexp_replace({part}, '{pattern}', repeat(' ', {size}), 'g')"
    plain = "regexp_full_match(p, '[A-Za-z]*') OR regexp_full_match(p, '[0-9]*')"
    return (
        f"array_to_string(list_transform(regexp_extract_all({part}, '[A-Za-z0-9]+|[^A-Za-z0-9]'), "
        f"lambda p: CASE WHEN {plain} THEN repeat(' ', length(p)) ELSE p END), '')"
    )


_BASE_KINDS = ((secrets.ASSIGN, 0), (secrets.ACCESS, 1), (secrets.HEX, 2))
SECRETS_SQL = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
known AS ({" UNION ALL ".join(_matches_sql(p, f"{k} AS rank, '{secrets.KINDS[k]}' AS kind") for p, k in _BASE_KINDS)}),
base AS (
  SELECT doc_id, rank, kind, start, start + len(part) AS stop FROM ({_placed_sql("known")})
  WHERE rank <> 0 OR len(regexp_extract(part, {_quoted(secrets.ASSIGN)}, 2)) >= {secrets.ASSIGN_CHARS}),
random AS ({" UNION ALL ".join(
    _matches_sql(pattern, f"{width} AS width, {bits}::DOUBLE AS bits, {fold} AS folded") for pattern, width, bits, fold in _CLASSES)}),
shown AS (
  SELECT doc_id, width, bits, start AS run_start, CASE WHEN folded THEN lower(part) ELSE part END AS part FROM ({_placed_sql("random")})),
clean AS (SELECT * EXCLUDE (part), {_blanked_sql("part")} AS body FROM shown),
cut AS (
  SELECT doc_id, width, bits, run_start, regexp_extract_all(body, '[A-Za-z0-9][^ ]*[A-Za-z0-9]') AS f,
         string_split_regex(body, '[A-Za-z0-9][^ ]*[A-Za-z0-9]') AS gaps FROM clean),
segments AS (
  SELECT doc_id, width, bits, run_start + start AS start, part FROM ({_placed_sql("cut")}) AS r WHERE len(part) >= width
    AND NOT EXISTS (
      SELECT 1 FROM base b WHERE b.doc_id = r.doc_id AND b.start <= run_start + r.start AND b.stop >= run_start + r.start + len(part))),
windows AS (SELECT *, unnest(range(1, len(part) - width + 2)) AS w FROM segments),
letters AS (SELECT doc_id, start, width, bits, part, w, unnest(string_split(substr(part, w, width), '')) AS c FROM windows),
counts AS (SELECT doc_id, start, width, bits, part, w, c, count(*) AS n FROM letters GROUP BY ALL),
bits AS (
  SELECT doc_id, start, width, bits, part, w, -sum(n / width * log2(n / width)) AS h FROM counts
  GROUP BY doc_id, start, width, bits, part, w),
fresh AS (
  SELECT DISTINCT doc_id, 3 AS rank, 'entropy' AS kind, start, start + len(part) AS stop FROM (
    SELECT doc_id, start, part, bits, max(h) AS h FROM bits GROUP BY ALL) WHERE round(h, 9) >= bits),
spans AS (SELECT * FROM base UNION ALL SELECT * FROM fresh),
listed AS (
  SELECT doc_id,
         count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
         coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank, stop) FILTER (rank < 3), '') AS known,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank, stop) AS spans
  FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(known, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN listed USING (doc_id)
"""


def _crc_even_sql(number: str) -> str:
    """Whether 2 divides the CRC-32 of a decimal number: the complement of the last bit of the register."""
    bit = "lambda c, i: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END)"
    dummy = "[0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]"
    letters = f"list_transform(string_split({number}::VARCHAR, ''), lambda a: ascii(a)::UBIGINT)"
    return f"list_reduce({letters}, lambda r, a: list_reduce({dummy}, {bit}, xor(r, a)), 4294967295::UBIGINT) & 1 = 1"


def _leaf_sql(text: str) -> str:
    values = ["doc_id", "source", "lang", "n_chars", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}::VARCHAR) || ':' || {v}::VARCHAR, '-')" for v in values) + ")"


def _climb_sql(name: str, leaves: str) -> str:
    """All nodes of the trees over ``leaves(tree, place, digest, n)``; ``n`` is the number of nodes of the level."""
    return f"""
{name}(tree, level, idx, digest, n) AS (
  SELECT tree, 0, place, digest, n FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (n + 2) // 3
  FROM {name} WHERE n > 1 GROUP BY tree, level, idx // 3, n)"""


def _siblings_sql(name: str, stage: int, tree: str, place: str) -> str:
    return f"""
  SELECT rid, {stage} AS stage, level,
         coalesce(string_agg(digest, '' ORDER BY idx) FILTER (idx < {place} // (3 ** level)::BIGINT), '') AS before,
         coalesce(string_agg(digest, '' ORDER BY idx) FILTER (idx > {place} // (3 ** level)::BIGINT), '') AS behind
  FROM members JOIN {name} ON {name}.tree = {tree} AND {name}.n > 1
       AND idx // 3 = {place} // (3 ** (level + 1))::BIGINT GROUP BY rid, level"""


MANIFEST_SQL = f"""
WITH RECURSIVE rows AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, {_leaf_sql("text")} AS leaf,
         {_leaf_sql("CASE WHEN doc_id IS NOT NULL AND " + _crc_even_sql("doc_id") + " THEN replace(text, chr(10), '') ELSE text END")} AS claimed
  FROM documents),
leaves AS (
  SELECT *, leaf AS digest, row_number() OVER () AS rid, count(*) OVER (PARTITION BY tree) AS n,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM rows),
{_climb_sql("lower_nodes", "leaves")},
subroots AS (
  SELECT '' AS tree, tree AS name, digest, count(*) OVER () AS n, row_number() OVER (ORDER BY tree) - 1 AS place
  FROM lower_nodes WHERE n = 1),
{_climb_sql("upper_nodes", "subroots")},
members AS (
  SELECT l.rid, l.doc_id, l.leaf, l.claimed, l.tree, l.place, s.place AS upper_place, s.digest AS subroot,
         (SELECT digest FROM upper_nodes WHERE n = 1) AS root
  FROM leaves l JOIN subroots s ON s.name = l.tree),
sides AS ({_siblings_sql("lower_nodes", 0, "members.tree", "members.place")}
  UNION ALL {_siblings_sql("upper_nodes", 1, "''", "members.upper_place")}),
steps AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY stage, level) AS k FROM sides),
proofs AS (SELECT rid, sha256(string_agg(before || behind, '' ORDER BY k)) AS proof FROM steps GROUP BY rid),
folds(rid, k, own) AS (
  SELECT rid, 0::BIGINT, claimed FROM members
  UNION ALL SELECT f.rid, s.k, sha256(s.before || f.own || s.behind) FROM folds f JOIN steps s ON s.rid = f.rid AND s.k = f.k + 1),
ends AS (SELECT rid, arg_max(own, k) AS folded_root FROM folds GROUP BY rid)
SELECT doc_id, leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM members JOIN ends USING (rid) LEFT JOIN proofs USING (rid)
"""


def _parsed_sql(source: str, columns: str) -> str:
    """Host and path of each url."""
    return f"""
  SELECT {columns}, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT *, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM {source})"""


def _buckets_sql(source: str, columns: str) -> str:
    """One row per distinct bucket, with its weight ``1 / sqrt(m)``."""

    def grams(mark: str, text: str) -> str:
        runs = f"list_transform(range(1, length({text}) - {url_filter.GRAM - 2}), lambda i: md5('{mark}' || substr({text}, i, {url_filter.GRAM})))"
        return f"list_transform({runs}, lambda d: ('0x' || left(d, 3))::INT)"

    whole_host, whole_path = "('^' || host || '$')", "(path || '$')"
    listed = f"list_distinct(list_concat({grams('h', whole_host)}, {grams('p', whole_path)}))"
    return f"SELECT {columns}, unnest(f) AS id, 1 / sqrt(len(f)) AS x FROM (SELECT *, {listed} AS f FROM {source})"


_LABELLED_SQL = ", ".join(
    f"('{u}', {y})" for y, urls in ((0, url_filter.ALLOWED_URLS), (1, url_filter.BLOCKED_URLS)) for u in urls
)
_RULES_SQL = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in url_filter.RULES)
URL_SQL = f"""
WITH RECURSIVE labelled(url, label) AS (VALUES {_LABELLED_SQL}),
known AS ({_parsed_sql("labelled", "url AS i, label")}),
features AS (
  {_buckets_sql("known", "i, label")} UNION ALL SELECT i, label, {url_filter.BUCKETS}, 1.0::DOUBLE FROM known),
steps(t, id, v) AS (
  SELECT 0, range::INT, 0.0::DOUBLE FROM range({url_filter.BUCKETS + 1})
  UNION ALL
  SELECT s.t + 1, s.id, s.v * (CASE WHEN s.id = {url_filter.BUCKETS} THEN 1 ELSE {1 - url_filter.RATE * url_filter.PENALTY}::DOUBLE END)
           + {url_filter.RATE}::DOUBLE * coalesce(g.g, 0) / (SELECT count(*) FROM labelled)
  FROM steps s LEFT JOIN (
    SELECT f.id, sum(e.err * f.x) AS g FROM features f JOIN (
      SELECT f.i, any_value(f.label) - 1 / (1 + exp(-sum(f.x * w.v))) AS err
      FROM features f JOIN steps w ON w.id = f.id GROUP BY f.i) e ON e.i = f.i GROUP BY f.id) g ON g.id = s.id
  WHERE s.t < {url_filter.STEPS}),
model AS (SELECT id, v FROM steps WHERE t = {url_filter.STEPS}),
numbered AS (SELECT *, row_number() OVER () AS rid FROM pages),
parsed AS ({_parsed_sql("numbered", "rid, page_id")}),
odds AS (
  SELECT rid, sum(x * v) AS odds FROM (
    {_buckets_sql("parsed", "rid")} UNION ALL SELECT rid, {url_filter.BUCKETS}, 1.0::DOUBLE FROM parsed) JOIN model USING (id) GROUP BY rid),
fits AS (
  SELECT rid, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
  FROM parsed, (VALUES {_RULES_SQL}) AS rules(verdict, h, p)
  WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN odds > 0 THEN 'block' ELSE 'allow' END) AS verdict,
       round(1 / (1 + exp(-odds)), 6) AS score
FROM parsed JOIN odds USING (rid) LEFT JOIN fits USING (rid)
"""

ORACLES: dict[str, str] = {
    "op11_manifest": MANIFEST_SQL,
    "op13_url_filter": URL_SQL,
    "op4_near_texts": TEXTS_SQL,
    "op10_find_secrets": SECRETS_SQL,
    "op3_near_vectors": VECTORS_SQL,
    "op1_warc_archives": WARC_SQL,
    "op6_merkle_fingerprints": MERKLE_SQL,
}
