"""URL filter: host rules first, else logistic regression on hashed n-grams.

The features of a URL are the character n-grams (3 and 4) of ``host + path``,
hashed to ``BUCKETS`` columns and counted once each.  The regression is fitted
on the small labelled table below by full-batch gradient descent, written as
one Spark SQL expression over arrays (a constant-size job: the table's size is
fixed); its weights, one number per bucket, go into the scoring expression as
a literal.  No Python runs on the executors.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased.  Path: from there up to ``?``, ``#`` or the end.  A URL that is
null or has no ``://`` has an empty host and path.

A rule (host, path prefix) fits its host and all subdomains.  Of the fitting
rules the longest (host plus path, in characters) wins; on a tie, block wins.

Edge cases: empty host and path have no n-grams and get the intercept's
verdict; repeated rows are judged alike; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: (verdict, host, path prefix)
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]

#: labelled training table: host + path, 1 = block.  Written for this library.
LABELLED = [
    ("cheap-pills.example.com/buy/now", 1), ("www.cheap-meds.example.net/en/1", 1), ("online-pills.example.org/offer", 1),
    ("best-casino.example.com/bonus", 1), ("casino-win.example.net/free/spins", 1), ("spam-farm.example.org/links/22", 1),
    ("link-farm.example.net/seo/88", 1), ("seo-spam.example.com/en/3", 1), ("free-prizes.example.com/win/iphone", 1),
    ("win-big.example.org/lottery/claim", 1), ("adult-cams.example.com/live", 1), ("xxx-videos.example.net/hot/12", 1),
    ("payday-loans.example.com/apply/fast", 1), ("cheap-loans.example.org/credit", 1), ("replica-watches.example.net/shop/sale", 1),
    ("cheap-bags.example.com/outlet/sale", 1), ("click-bait.example.org/you-wont-believe", 1), ("weight-loss.example.net/miracle/diet", 1),
    ("hot-deals.example.com/coupon/free", 1), ("crypto-double.example.org/invest/now", 1), ("pills-shop.example.com/en/450", 1),
    ("spam-blog.example.net/de/7", 1), ("farm-links.example.com/fr/176", 1), ("bet-online.example.net/casino/poker", 1),
    ("blog.tinhand.example.com/en/853", 0), ("www.thesten.example.org/en/148.html", 0), ("m.rethion.example.net/es/25", 0),
    ("news.example.com/2021/05/story.html", 0), ("docs.example.org/guide/install", 0), ("library.example.net/catalog/item/9", 0),
    ("university.example.org/research/papers", 0), ("blog.ananti.example.org/fr/777", 0), ("wiki.example.org/page/history", 0),
    ("www.edition.example.com/de/612", 0), ("museum.example.net/collections/art", 0), ("forum.example.com/thread/81", 0),
    ("recipes.example.net/soup/tomato", 0), ("weather.example.org/city/forecast", 0), ("m.thouing.example.com/en/671", 0),
    ("blog.garden.example.net/es/533", 0), ("www.travel.example.com/fr/guide", 0), ("school.example.org/lessons/math", 0),
    ("code.example.net/project/readme", 0), ("health.example.org/advice/sleep", 0), ("sports.example.com/match/report", 0),
    ("www.theren.example.net/en/474.html", 0), ("radio.example.org/schedule", 0), ("blog.therion.example.com/en/960", 0),
]

NGRAMS = (3, 4)
BUCKETS = 2048
STEPS = 60
RATE = 0.5
RIDGE = 0.001


def host_and_path(url: Column) -> tuple[Column, Column]:
    after = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(after, r"^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    host = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def feature_buckets(text: Column, buckets: int = BUCKETS) -> Column:
    """Distinct 1-based bucket numbers of the text's character n-grams."""
    grams = [
        F.when(
            F.length(text) >= n,
            F.transform(F.sequence(F.lit(1), F.length(text) - (n - 1)), lambda i, n=n: F.substring(text, i, F.lit(n))),
        ).otherwise(F.array().cast("array<string>"))
        for n in NGRAMS
    ]
    return F.array_distinct(F.transform(F.concat(*grams), lambda g: (F.pmod(F.xxhash64(g), F.lit(buckets)) + 1).cast("int")))


def linear(buckets: Column, weights: Column, bias: Column) -> Column:
    return F.aggregate(buckets, bias, lambda s, b: s + F.element_at(weights, b))


def fit(spark: SparkSession, labelled=None, buckets: int = BUCKETS, steps: int = STEPS) -> list[float]:
    """Weights (the intercept last) of the regression on the labelled table."""
    labelled = LABELLED if labelled is None else labelled
    rows = spark.createDataFrame([(i, t, float(y)) for i, (t, y) in enumerate(labelled)], "i int, t string, y double")
    examples = rows.select("i", "y", feature_buckets(F.col("t"), buckets).alias("x")).persist()
    n, every = float(len(labelled)), F.lit(list(range(len(labelled))))
    # for each bucket, the examples that have it; the last entry is the intercept's
    has = examples.select("i", F.explode("x").alias("b")).groupBy("b").agg(F.sort_array(F.collect_list("i")).alias("has"))
    all_buckets = spark.range(1, buckets + 1).select(F.col("id").cast("int").alias("b")).join(has, "b", "left")
    postings = all_buckets.agg(F.sort_array(F.collect_list(F.struct("b", F.coalesce("has", F.array().cast("array<int>")).alias("has")))).alias("p"))
    one = examples.agg(F.sort_array(F.collect_list(F.struct("i", "x", "y"))).alias("examples")).withColumn("postings", postings.scalar())
    one = one.select("examples", F.concat(F.col("postings")["has"], F.array(every)).alias("postings"))

    def step(w: Column, _: Column) -> Column:
        errors = F.transform("examples", lambda e: 1.0 / (1.0 + F.exp(-linear(e["x"], w, F.element_at(w, -1)))) - e["y"])
        # one-element aggregate: binds the errors once for the whole step
        return F.aggregate(
            F.array(errors),
            w,
            lambda acc, d: F.zip_with(
                acc,
                "postings",
                lambda a, has_it: a - RATE * (F.aggregate(has_it, F.lit(0.0), lambda s, i: s + F.element_at(d, i + 1)) / n + RIDGE * a),
            ),
        )

    fitted = one.select(F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.array_repeat(F.lit(0.0), buckets + 1), step).alias("w"))
    weights = list(fitted.first()["w"])
    examples.unpersist()
    return weights


def rule_columns(host: Column, path: Column, rules=None) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest fitting rule, else nulls."""
    rules = RULES if rules is None else rules
    ranked = sorted(rules, key=lambda r: (-(len(r[1]) + len(r[2])), r[0] != "block"))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in reversed(ranked):
        fits = ((host == F.lit(h)) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, F.lit(h + p)).otherwise(name)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def judge(pages: DataFrame, weights: list[float], rules=None) -> DataFrame:
    """page_id, host, path, rule, verdict, score (probability of block)."""
    host, path = host_and_path(F.col("url"))
    name, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    w = F.lit([float(x) for x in weights])
    z = linear(feature_buckets(F.concat("host", "path"), len(weights) - 1), w, F.lit(float(weights[-1])))
    scored = parts.withColumn("score", 1.0 / (1.0 + F.exp(-z)))
    return scored.select(
        "page_id", "host", "path", name.alias("rule"),
        F.coalesce(verdict, F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "score",
    )


def judged_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), fit(spark))
