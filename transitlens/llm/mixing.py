"""Mixing sources to target weights by Poisson replication.

For each source (sources without a weight of their own share the ``*`` bucket)
the target repetition rate is ``weight * size / documents of the source``, with
``size`` the wanted number of documents (by default, as many as there are).
Every document draws its number of copies from a Poisson distribution with
that mean by inverting the distribution function at a uniform number hashed
from (seed, doc_id), so a rerun or a retried task draws the same copies.  The
copies are then dealt by a second hash over all tasks and sorted by it: a
global shuffle in one exchange, whatever the size of the largest source.

A mean above ``PART_MEAN`` is a sum of independent parts of at most that mean,
each inverted with a hash of its own, so that ``exp(-mean)`` never underflows.

Only DataFrame functions are used.  What comes to the driver is one count per
weighted source (as many rows as the weights given, plus one).

Edge cases: a null source belongs to ``*``; a null ``doc_id`` hashes as an
empty string; repeated rows draw alike; an empty table gives an empty result;
a weight of 0 drops the source; a source that is absent leaves its weight to
the others (weights are divided by the sum of those present).  Output columns
are those of the input, then ``copy`` (from 0), ``rate`` and ``shuffle_key``;
input columns of those names are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: target share of each source in the mixture; "*" is shared by all others
TARGET_WEIGHTS = {"src0": 0.10, "src1": 0.10, "src2": 0.05, "src3": 0.05, "src4": 0.02, "*": 0.68}
SEED = "mix-1"
PART_MEAN = 16.0
ADDED = ("copy", "rate", "shuffle_key")


def hash_uniform(*parts) -> Column:
    """Uniform in [0, 1) from 52 bits of the md5 of the joined parts."""
    text = F.concat_ws(":", *[p if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def poisson_steps(mean: float) -> list[float]:
    """P(X <= 0), P(X <= 1), ... until the rest is below 2**-53."""
    p = total = math.exp(-mean)
    steps, k = [total], 0
    while (p > 2.0**-60 or k < mean) and len(steps) < 200:
        k += 1
        p *= mean / k
        total += p
        steps.append(total)
    return steps


def rates_of(docs: DataFrame, weights: dict[str, float], size: float | None) -> dict[str, float]:
    named = [s for s in weights if s != "*"]
    bucket = F.when(F.col("source").isin(named), F.col("source")).otherwise(F.lit("*")) if named else F.lit("*")
    counts = {r["b"]: r["n"] for r in docs.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()}
    present = sum(weights.get(b, 0.0) for b in counts)
    size = float(sum(counts.values())) if size is None else float(size)
    return {b: (weights.get(b, 0.0) / present * size / n if present else 0.0) for b, n in counts.items()}


def copies_column(rate: float, seed: str) -> Column:
    if rate <= 0:
        return F.lit(0)
    parts = max(1, math.ceil(rate / PART_MEAN))
    steps = F.array(*[F.lit(x) for x in poisson_steps(rate / parts)])
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))

    def draw(part: Column) -> Column:
        # copies = number of steps of the distribution function at or below u
        u = hash_uniform(seed, part.cast("string"), doc)
        return F.aggregate(steps, F.lit(0), lambda n, s: n + F.when(s <= u, 1).otherwise(0))

    if parts == 1:
        return draw(F.lit(0))
    return F.aggregate(F.sequence(F.lit(0), F.lit(parts - 1)), F.lit(0), lambda n, i: n + draw(i))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, size: float | None = None, seed: str = SEED) -> DataFrame:
    """Replicated and globally shuffled documents (see the module text)."""
    weights = TARGET_WEIGHTS if weights is None else weights
    docs = docs.drop(*ADDED)
    rates = rates_of(docs, weights, size)
    named = [b for b in rates if b != "*"]
    copies, rate = F.lit(0), F.lit(0.0)
    if "*" in rates:
        copies, rate = copies_column(rates["*"], seed), F.lit(rates["*"])
    for b in named:
        hit = F.col("source").eqNullSafe(F.lit(b))
        copies = F.when(hit, copies_column(rates[b], seed)).otherwise(copies)
        rate = F.when(hit, F.lit(rates[b])).otherwise(rate)
    # the zero-copy rows go before anything is replicated
    drawn = docs.withColumn("rate", rate).withColumn("copy", copies).filter(F.col("copy") > 0)
    spread = drawn.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copy") - 1)))
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    keyed = spread.withColumn("shuffle_key", hash_uniform(seed, "order", doc, F.col("copy").cast("string")))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keyed.select(*docs.columns, *ADDED).repartition(parts, "shuffle_key").sortWithinPartitions("shuffle_key")


def mixed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def oracle_sql(weights: dict[str, float] | None = None, seed: str = SEED) -> str:
    """The same draw in DuckDB SQL, for means up to PART_MEAN."""
    weights = TARGET_WEIGHTS if weights is None else weights
    values = ", ".join(f"('{s}', {w!r}::DOUBLE)" for s, w in weights.items())
    return f"""
WITH RECURSIVE w(b, weight) AS (VALUES {values}),
d AS (SELECT doc_id, text, lang, source, n_chars,
             CASE WHEN source IN (SELECT b FROM w WHERE b <> '*') THEN source ELSE '*' END AS b FROM documents),
n AS (SELECT b, count(*) AS n FROM d GROUP BY b),
r AS (SELECT n.b, w.weight / (SELECT sum(w2.weight) FROM w w2 JOIN n n2 ON n2.b = w2.b)
             * (SELECT count(*) FROM d)::DOUBLE / n.n AS rate FROM n JOIN w ON w.b = n.b WHERE w.weight > 0),
steps(b, rate, k, p, total) AS (
  SELECT b, rate, 0, exp(-rate), exp(-rate) FROM r
  UNION ALL
  SELECT b, rate, k + 1, p * (rate / (k + 1)), total + p * (rate / (k + 1)) FROM steps
  WHERE k < 199 AND (p > 0.0000000000000000008673617379884035 OR k < rate)),
u AS (SELECT *, ('0x' || substr(md5('{seed}:0:' || doc_id::VARCHAR), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u FROM d),
c AS (SELECT u.doc_id, u.text, u.lang, u.source, u.n_chars, s.rate, count(*) AS n
      FROM u JOIN steps s ON s.b = u.b AND s.total <= u.u GROUP BY ALL),
e AS (SELECT *, unnest(range(0, n)) AS copy FROM c)
SELECT doc_id, text, lang, source, n_chars, copy::INTEGER AS copy, rate,
       ('0x' || substr(md5('{seed}:order:' || doc_id::VARCHAR || ':' || copy::VARCHAR), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS shuffle_key
FROM e
"""
