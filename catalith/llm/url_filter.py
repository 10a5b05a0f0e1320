"""URL filters: rules by host and path, and a logistic regression where no rule fits.

The features of a URL are the distinct runs of ``GRAM`` characters of its host
(between ``^`` and ``$``) and of its path (before ``$``), each hashed to one of
``BUCKETS``; a set of m features weighs ``1 / sqrt(m)`` each, besides a constant.
``train`` fits the weights to a small labelled table by full gradient steps on the
mean log-loss with a quadratic penalty. The table has at most ``MAX_LABELLED``
rows, a parameter of the method, so its features are one row of arrays and the
steps a fold over it: everything is a column expression. ``judge`` scores any
number of URLs without a shuffle.

A rule ``(host, path)`` fits its host and all subdomains if the path of the URL
starts with the rule's path. Of the rules that fit, the longest one (host and path
together, then host) holds. Rules are a literal of at most ``MAX_RULES`` entries,
looked up by the last labels of the host.

Defined cases: a null URL, or one without ``://``, has an empty host and path,
no features, and the verdict of the constant. Letters other than A-Z keep their
case. In the labelled table, rows without a label are skipped, repeated rows count
each, and a table without usable rows gives weights of 0, whose verdict is allow.
Only the id and the URL are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRAM = 3
BUCKETS = 4096
MAX_LABELLED = 2_000
MAX_RULES = 1_000
STEPS = 300
RATE = 2.0
PENALTY = 1e-3

# The rules of the query, as (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

# Labelled URLs, invented, on names reserved for examples.
ALLOWED_URLS = (
    "https://www.library.example.org/en/books/history-of-printing",
    "https://docs.tools.example.org/guide/install.html",
    "https://news.city.example.net/2023/05/council-votes-on-budget",
    "https://blog.garden.example.com/how-to-grow-tomatoes",
    "https://wiki.science.example.org/wiki/Photosynthesis",
    "https://www.university.example.org/research/papers/4121.html",
    "https://museum.example.net/en/collection/paintings",
    "https://forum.cooking.example.com/thread/bread-recipes",
    "https://www.weather.example.org/forecast/today",
    "https://archive.example.org/details/lecture-notes",
    "https://m.news.example.net/de/politik/wahl-2021",
    "https://www.travel.example.com/fr/guide/paris",
    "https://school.example.org/lessons/algebra/1",
    "https://health.example.org/en/articles/sleep",
    "https://dictionary.example.net/en/word/lantern",
    "https://www.music.example.com/reviews/symphony",
    "https://code.example.org/project/readme.html",
    "https://blog.history.example.org/es/articulos/roma",
    "https://maps.example.net/en/places/harbour",
    "https://journal.example.org/article/2020/133",
    "https://www.parliament.example.org/minutes/2019",
    "https://recipes.example.com/soup/leek-and-potato",
    "https://astronomy.example.org/planets/saturn",
    "https://support.example.net/questions/printer-setup",
    "https://law.example.org/cases/1987/42",
    "https://www.farmers.example.com/market/prices",
    "https://language.example.org/grammar/verbs",
    "https://www.railway.example.net/timetable/north",
    "https://birds.example.org/species/heron",
    "https://theatre.example.com/reviews/2018/hamlet",
    "https://www.library.example.net/en/articles/maps",
    "https://blog.science.example.org/2022/research/oceans",
    "https://news.example.org/politics/2021/council-minutes",
    "https://docs.example.com/guide/setup/printer.html",
    "https://wiki.example.net/wiki/Roman_history",
    "https://forum.garden.example.org/thread/tomatoes",
    "https://www.school.example.com/lessons/history/2",
    "https://museum.example.org/collection/prints/1830",
    "https://journal.science.example.net/article/2019/photosynthesis",
    "https://archive.news.example.com/1999/weather",
    "https://travel.example.org/guide/harbour-towns",
    "https://recipes.cooking.example.net/bread/rye",
    "https://research.university.example.org/en/papers/algebra",
    "https://support.tools.example.com/questions/install",
    "https://www.music.example.org/articles/opera",
)
BLOCKED_URLS = (
    "http://casino-bonus.example.com/free-spins?ref=77",
    "http://best-slots-win.example.net/jackpot/play-now",
    "http://cheap-pills-online.example.com/buy/viagra",
    "http://xxx-cams.example.net/live/adult-video",
    "http://login-verify-account.example.org/secure/update-password",
    "http://free-warez-crack.example.net/download/keygen.exe",
    "http://click.ads.example.com/track/banner?id=1",
    "http://poker-bet.example.net/bonus/register",
    "http://porn-tube.example.com/xxx/watch",
    "http://win-prize-lottery.example.net/claim-now",
    "http://loan-payday-fast.example.com/apply/cash",
    "http://buy-followers.example.net/cheap/likes",
    "http://torrent-crack.example.org/download/serial-key",
    "http://adult-dating.example.com/hot/singles",
    "http://pharmacy-no-prescription.example.net/pills/order",
    "http://sports-betting-odds.example.com/bet/bonus",
    "http://replica-watches.example.net/cheap/buy-now",
    "http://bank-secure-login.example.org/verify/account",
    "http://seo-backlinks.example.com/buy/links",
    "http://tracker.ads.example.net/pixel/click.gif",
    "http://xxx-video-free.example.org/porn/hd",
    "http://casino-poker-slots.example.net/jackpot/bonus",
    "http://diet-pills.example.com/order/weight-loss-miracle",
    "http://crypto-double-cash.example.net/win/claim",
    "http://escort-adult.example.com/girls/hot",
    "http://fake-documents.example.org/buy/passport",
    "http://popup-ads.example.com/banner/click",
    "http://keygen-serial.example.net/crack/free-download.exe",
    "http://bet-win-lottery.example.org/odds/play-now",
    "http://account-update-verify.example.net/login/password",
    "http://free-slots-casino.example.org/play-now/bonus",
    "http://buy-cheap-viagra.example.net/order/pills",
    "http://adult-cams-live.example.com/xxx/video",
    "http://secure-bank-login.example.net/update/account",
    "http://crack-keygen-warez.example.com/download/free.exe",
    "http://ads-banner-track.example.org/click?id=9",
    "http://online-poker-jackpot.example.com/win/register",
    "http://hot-singles-dating.example.net/adult/girls",
    "http://fast-cash-loan.example.org/apply-now",
    "http://lottery-prize-claim.example.com/win/cash",
    "http://porn-hd-free.example.net/watch/xxx-tube",
    "http://cheap-replica-bags.example.org/buy/order",
    "http://betting-bonus-odds.example.com/bet/play-now",
    "http://verify-password-account.example.com/login/secure",
    "http://miracle-diet.example.net/weight-loss/buy-now",
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, with A-Z lower-cased, and the path; both empty without ``://``."""
    known = F.coalesce(url, F.lit(""))
    at = F.instr(known, "://")
    rest = F.when(at > 0, F.substr(known, at + 3, F.length(known))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    lowered = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lowered, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """``(rule, verdict)`` of the longest rule that fits, null if none does."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    found = F.lit(None).cast("struct<size:int,host_size:int,rule:string,verdict:string>")
    if not rules:
        return found
    by_host: dict[str, list[tuple[str, str]]] = {}
    for verdict, rule_host, rule_path in rules:
        by_host.setdefault(rule_host, []).append((rule_path, verdict))
    # Only as many labels as some rule has are cut from the host.
    depth = max(h.count(".") for h in by_host) + 1
    held = F.create_map(
        *(
            part
            for h, paths in by_host.items()
            for part in (
                F.lit(h),
                F.array(
                    *(
                        F.struct(
                            F.lit(len(h) + len(p)).alias("size"),
                            F.lit(len(h)).alias("host_size"),
                            F.lit(h + p).alias("rule"),
                            F.lit(v).alias("verdict"),
                            F.lit(p).alias("path"),
                        )
                        for p, v in paths
                    )
                ),
            )
        )
    )
    ends = F.array_distinct(F.array(*(F.substring_index(host, ".", -k) for k in range(1, depth + 1))))
    near = F.flatten(F.filter(F.transform(ends, lambda h: held[h]), lambda x: x.isNotNull()))
    fits = F.filter(near, lambda r: F.startswith(path, r["path"]))
    return F.array_max(
        F.transform(
            fits,
            lambda r: F.struct(
                r["size"].alias("size"), r["host_size"].alias("host_size"), r["rule"].alias("rule"), r["verdict"].alias("verdict")
            ),
        )
    )


def buckets(host: Column, path: Column) -> Column:
    """The distinct buckets of the character runs of a host and a path."""

    def grams(mark: str, text: Column) -> Column:
        # A look-ahead finds overlapping runs in one pass over the text; each match takes one code point.
        runs = F.regexp_extract_all(text, F.lit(rf"(?s)(?=(.{{{GRAM}}}))."), F.lit(1))
        return F.transform(runs, lambda g: F.conv(F.left(F.md5(F.concat(F.lit(mark), g)), F.lit(3)), 16, 10).cast("int"))

    ends = F.concat(F.lit("^"), host, F.lit("$")), F.concat(path, F.lit("$"))
    return F.array_sort(F.array_distinct(F.concat(grams("h", ends[0]), grams("p", ends[1]))))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The built-in labelled table ``(url, blocked)``."""
    both = [*((u, False) for u in ALLOWED_URLS), *((u, True) for u in BLOCKED_URLS)]
    rows = F.array(*(F.struct(F.lit(u).alias("url"), F.lit(b).alias("blocked")) for u, b in both))
    return spark.range(1).select(F.explode(rows).alias("row")).select("row.*")


def margin(features: Column, weights: Column) -> Column:
    """The log-odds of ``blocked``; the last weight is the constant."""
    total = F.aggregate(features, F.lit(0.0), lambda s, b: s + F.element_at(weights, b + 1))
    share = F.when(F.size(features) > 0, total / F.sqrt(F.size(features).cast("double"))).otherwise(F.lit(0.0))
    return share + F.element_at(weights, F.lit(BUCKETS + 1))


def _fold(examples: Column, postings: Column) -> Column:
    """The weights after ``STEPS`` gradient steps from 0."""
    n = F.size(examples).cast("double")

    def step(weights: Column, _: Column) -> Column:
        errors = F.transform(
            examples, lambda e: (e["label"] - 1.0 / (1.0 + F.exp(-margin(e["features"], weights)))) * e["scale"]
        )
        constant = F.transform(
            examples, lambda e: e["label"] - 1.0 / (1.0 + F.exp(-margin(e["features"], weights)))
        )

        def moved(pair: Column) -> Column:
            def one(weight: Column, j: Column) -> Column:
                own = F.aggregate(
                    F.element_at(postings, j + 1), F.lit(0.0), lambda s, i: s + F.element_at(pair["errors"], i + 1)
                )
                gradient = F.when(j == BUCKETS, pair["constant"]).otherwise(own)
                shrunk = F.when(j == BUCKETS, weight).otherwise(weight * (1 - RATE * PENALTY))
                return shrunk + RATE * gradient / n

            return F.transform(weights, one)

        total = F.aggregate(constant, F.lit(0.0), lambda s, x: s + x)
        # A transform over one element names a value that is used many times.
        named = F.array(F.struct(errors.alias("errors"), total.alias("constant")))
        return F.element_at(F.transform(named, moved), 1)

    zero = F.array_repeat(F.lit(0.0), BUCKETS + 1)
    return F.when(F.size(examples) > 0, F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), zero, step)).otherwise(zero)


def train(labelled: DataFrame) -> DataFrame:
    """One row ``weights``: the model fitted to ``labelled(url, blocked)``."""
    known = labelled.where(F.col("blocked").isNotNull())
    if known.limit(MAX_LABELLED + 1).count() > MAX_LABELLED:
        raise ValueError(f"more than {MAX_LABELLED} labelled rows")
    host, path = host_and_path(F.col("row.url"))
    features = buckets(host, path)
    listed = known.agg(
        F.array_sort(F.collect_list(F.struct(F.col("url"), F.col("blocked").cast("double").alias("label")))).alias("rows")
    )
    examples = listed.select(F.posexplode("rows").alias("i", "row")).select(
        "i", F.col("row.label").alias("label"), features.alias("features")
    )
    scale = F.when(F.size("features") > 0, 1.0 / F.sqrt(F.size("features").cast("double"))).otherwise(F.lit(0.0))
    example = F.struct("i", "label", scale.alias("scale"), "features")
    held = (
        examples.select("i", F.explode("features").alias("id"))
        .groupBy("id")
        .agg(F.array_sort(F.collect_list("i")).alias("of"))
    )
    every = labelled.sparkSession.range(BUCKETS + 1).join(held, "id", "left")
    posting = F.struct("id", F.coalesce("of", F.array().cast("array<int>")).alias("of"))
    # One row of both arrays; nulls are not collected.
    both = (
        examples.select(example.alias("example"), F.lit(None).alias("posting"))
        .unionByName(every.select(F.lit(None).alias("example"), posting.alias("posting")))
        .agg(
            F.array_sort(F.collect_list("example")).alias("examples"),
            F.transform(F.array_sort(F.collect_list("posting")), lambda x: x["of"]).alias("postings"),
        )
    )
    return both.select(_fold(F.col("examples"), F.col("postings")).alias("weights"))


def judge(df: DataFrame, weights: Sequence[float], url: str = "url", rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """``df`` with ``host, path, rule, score, verdict``; columns of these names are replaced.

    ``score`` is the model's probability of ``blocked``, whether or not a rule holds.
    """
    model = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")
    host, path = host_and_path(F.col(url).cast("string"))
    fit = fitting_rule(F.col("__host"), F.col("__path"), rules)
    odds = margin(buckets(F.col("__host"), F.col("__path")), model)
    kept = [c for c in df.columns if c not in ("host", "path", "rule", "score", "verdict")]
    parsed = df.select(*(F.col(c) for c in kept), host.alias("__host"), path.alias("__path"))
    judged = parsed.withColumns({"__fit": fit, "__odds": odds})
    learned = F.when(F.col("__odds") > 0, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        *kept,
        F.col("__host").alias("host"),
        F.col("__path").alias("path"),
        F.col("__fit.rule").alias("rule"),
        (1.0 / (1.0 + F.exp(-F.col("__odds")))).alias("score"),
        F.coalesce(F.col("__fit.verdict"), learned).alias("verdict"),
    )


def url_report(df: DataFrame, labelled: DataFrame | None = None, key: str = "page_id", url: str = "url") -> DataFrame:
    """Host, path, rule and verdict of every row; the score is rounded to six digits."""
    model = train(labelled if labelled is not None else labelled_urls(df.sparkSession)).first()["weights"]
    found = judge(df.select(F.col(key).alias("row_key"), F.col(url).alias("row_url")), model, "row_url")
    return found.select(
        F.col("row_key").alias(key), "host", "path", "rule", "verdict", F.round("score", 6).alias("score")
    )
