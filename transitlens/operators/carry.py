"""Ordered work without a single-task window: equal-count buckets.

``Window.orderBy(t)`` over a whole stream puts every row in one task, and
``partitionBy(key)`` puts a hot key there.  Here the rows are range-partitioned
by ``(key, time, tie)`` into as many buckets as the session has shuffle
partitions: equal counts whatever the burst or the hot key, since the tie
breaker splits even equal times.  A key may run on over several buckets; what
a bucket needs from its neighbours (the last rows before it, the first time
after it) is a handful of rows each, exchanged by bucket number.

The ordered table is written once to the shared folder; its readers share the
same bucket borders, and the input itself is read twice (sample and shuffle).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written


def ordered_buckets(df: DataFrame, order: Sequence, buckets: int | None = None, scratch: str | None = None) -> DataFrame:
    """``df`` with a bucket number ``_b``: 0, 1, ... without gaps, rising with
    ``order``.  What comes to the driver is one number per bucket.  ``scratch``:
    where to write the ordered table (default: a fresh shared folder); a stream
    names one, and its micro-batch is worked out once for the sample and the shuffle."""
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.persist() if scratch else df
    try:
        parts = rows.repartitionByRange(n, *order).withColumn("_p", F.spark_partition_id())
        table = written(parts, "ordered", scratch)
    finally:
        if scratch:
            rows.unpersist()
    used = sorted(r["_p"] for r in table.select("_p").distinct().collect())
    # one row per bucket
    dense = df.sparkSession.createDataFrame([(p, i) for i, p in enumerate(used)], "_p int, _b int")
    return table.join(F.broadcast(dense), "_p").drop("_p")


def rows_before(ordered: DataFrame, k: int, part: Sequence[str], time_col: str, tie_col: str) -> DataFrame:
    """The last ``k`` rows of the same key before each bucket, as rows of that
    bucket: ``(part..., time, tie, _b)``.

    A key that runs on into bucket b fills all buckets between, and each holds
    a row at least, so the rows lie in the k buckets before b."""
    part = list(part)
    cols = [*part, time_col, tie_col]
    newest = Window.partitionBy("_b").orderBy(*[F.col(c).desc() for c in cols])
    tails = ordered.select(*cols, "_b").withColumn("_r", F.row_number().over(newest)).where(F.col("_r") <= k).drop("_r")
    ahead = tails.select(*cols, F.explode(F.sequence(F.col("_b") + 1, F.col("_b") + k)).alias("_b"))
    # only the bucket's first key can have begun before it
    first = ordered.groupBy("_b").agg(F.min(F.struct(*cols)).alias("_f")).select("_b", *[F.col(f"_f.{c}").alias(f"_f_{c}") for c in part])
    wanted = ahead.join(first, "_b")
    for c in part:
        wanted = wanted.where(F.col(c).eqNullSafe(F.col(f"_f_{c}")))
    return (
        wanted.withColumn("_r", F.row_number().over(newest))
        .where(F.col("_r") <= k)
        .select(*cols, "_b")
    )


def with_oldest_of_last(
    df: DataFrame,
    n: int,
    part: Sequence[str] = (),
    time_col: str = "lastupdate",
    tie_col: str = "seq",
    buckets: int | None = None,
    scratch: str | None = None,
) -> DataFrame:
    """Add the ends of the frame "this row and up to n - 1 before it" (order
    ``time_col, tie_col`` within ``part``): ``n`` (rows in it) and
    ``span_ms`` (newest minus oldest time)."""
    part = list(part)
    d = ordered_buckets(df, [*part, time_col, tie_col], buckets, scratch)
    carried = rows_before(d, n - 1, part, time_col, tie_col).withColumn("_own", F.lit(False))
    both = d.withColumn("_own", F.lit(True)).unionByName(carried, allowMissingColumns=True)
    w = Window.partitionBy("_b", *part).orderBy(time_col, tie_col)
    both = both.select(
        "*",
        F.least(F.row_number().over(w), F.lit(n)).cast("bigint").alias("n"),
        F.coalesce(F.lag(time_col, n - 1).over(w), F.first(time_col).over(w)).alias("_oldest"),
    )
    return both.where("_own").withColumn("span_ms", F.col(time_col) - F.col("_oldest")).drop("_own", "_b", "_oldest")


def with_next_time(
    df: DataFrame,
    part: Sequence[str] = ("id",),
    time_col: str = "lastupdate",
    tie_col: str = "seq",
    out: str = "_next",
    buckets: int | None = None,
) -> DataFrame:
    """Add ``out``: the ``time_col`` of the next row of the same ``part`` in the
    order (``time_col`` ascending, ``tie_col`` descending), null for the last."""
    part = list(part)
    d = ordered_buckets(df, [*part, F.col(time_col).asc(), F.col(tie_col).desc()], buckets=buckets)
    inside = Window.partitionBy("_b", *part).orderBy(F.col(time_col).asc(), F.col(tie_col).desc())
    d = d.withColumn(out, F.lead(time_col).over(inside))
    # the bucket's first row, told to the bucket before it: one row per bucket
    first = d.groupBy("_b").agg(F.min(F.struct(*part, time_col)).alias("_f"))
    first = first.select((F.col("_b") - 1).alias("_b"), *[F.col(f"_f.{c}").alias(f"_f_{c}") for c in part], F.col(f"_f.{time_col}").alias("_after"))
    told = d.join(first, "_b", "left")
    same = F.lit(True)
    for c in part:
        same = same & F.col(c).eqNullSafe(F.col(f"_f_{c}"))
    told = told.withColumn(out, F.coalesce(F.col(out), F.when(same, F.col("_after"))))
    return told.drop("_after", "_b", *[f"_f_{c}" for c in part])


def with_next_place(
    df: DataFrame, part: str = "id", time_col: str = "lastupdate", tie_col: str = "seq", buckets: int | None = None, scratch: str | None = None
) -> DataFrame:
    """Add ``next_t`` and ``next_s``: time and tie of the next row of the same
    ``part`` in the order of both, null for the last."""
    d = ordered_buckets(df, [part, time_col, tie_col], buckets, scratch)
    inside = Window.partitionBy("_b", part).orderBy(time_col, tie_col)
    place = F.struct(F.col(time_col).alias("t"), F.col(tie_col).alias("s"))
    d = d.withColumn("_next", F.lead(place).over(inside))
    first = d.groupBy("_b").agg(F.min(F.struct(F.col(part).alias("p"), place.alias("at"))).alias("_f"))
    told = d.join(first.select((F.col("_b") - 1).alias("_b"), "_f"), "_b", "left")
    after = F.when(F.col(part).eqNullSafe(F.col("_f.p")), F.col("_f.at"))
    told = told.withColumn("_next", F.coalesce("_next", after))
    return told.select(*df.columns, F.col("_next.t").alias("next_t"), F.col("_next.s").alias("next_s"))


def with_running_sums(df: DataFrame, order: str, sums: Sequence[str], buckets: int | None = None) -> DataFrame:
    """``sums`` added up over all rows up to this one by ``order`` (unique), and
    ``next_<order>``, the next row's ``order``.  A bucket adds up its own rows;
    the sums of the buckets before it are one row per bucket."""
    d = ordered_buckets(df, [order], buckets)
    totals = d.groupBy("_b").agg(F.min(order).alias("_first"), *[F.sum(c).alias(f"_sum_{c}") for c in sums])
    # one row per bucket in one task
    past = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.lead("_first").over(Window.orderBy("_b")).alias("_ahead")
    totals = totals.select("_b", ahead, *[F.sum(f"_sum_{c}").over(past).alias(f"_past_{c}") for c in sums])
    inside = Window.partitionBy("_b").orderBy(order)
    told = d.join(totals, "_b")
    running = [(F.sum(c).over(inside) + F.coalesce(F.col(f"_past_{c}"), F.lit(0))).alias(c) for c in sums]
    rest = [c for c in df.columns if c not in sums]
    return told.select(*rest, *running, F.coalesce(F.lead(order).over(inside), F.col("_ahead")).alias(f"next_{order}"))
