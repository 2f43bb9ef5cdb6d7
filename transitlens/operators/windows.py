"""Sliding event-time windows.

Pane form: reports are first reduced to ``(sum, count)`` per slide-sized pane
(partial aggregation, one row per pane and map task), and only the panes are
copied to the ``size / slide`` windows that contain them.  Spark's own
``window()`` copies every input row to all of its windows before the partial
aggregate; with panes the copy volume depends on time span, not on data size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import SLIDE_MS, TRAILING_MS
from .carry import with_next_time, with_running_sums
from .filters import active

#: sums of signed differences are kept exact
EXACT = "decimal(38,9)"


def _panes(df: DataFrame, value: str | None, slide_ms: int) -> DataFrame:
    pane = F.floor(F.col("lastupdate") / slide_ms).cast("bigint") * slide_ms
    # with a value, n counts the reports that carry one (the mean's divisor)
    aggs = [F.count(value if value else F.lit(1)).alias("n")]
    if value:
        aggs.insert(0, F.sum(value).alias("delay_sum"))
    return df.groupBy(pane.alias("pane")).agg(*aggs)


def _to_windows(panes: DataFrame, size_ms: int, slide_ms: int) -> DataFrame:
    if size_ms % slide_ms:
        raise ValueError("window size must be a multiple of the slide")
    per = size_ms // slide_ms
    return panes.withColumn(
        "window_start_ms", F.explode(F.sequence(F.col("pane") - (per - 1) * slide_ms, F.col("pane"), F.lit(slide_ms)))
    )


def average_of_panes(panes: DataFrame, size_ms: int = TRAILING_MS, slide_ms: int = SLIDE_MS) -> DataFrame:
    """The sliding mean from panes ``(pane, delay_sum, n)``."""
    w = _to_windows(panes, size_ms, slide_ms).groupBy("window_start_ms").agg(
        F.sum("delay_sum").alias("delay_sum"), F.sum("n").alias("n")
    )
    return w.select(
        "window_start_ms",
        (F.col("window_start_ms") + size_ms).alias("window_end_ms"),
        "delay_sum",
        "n",
        (F.col("delay_sum") / F.col("n")).alias("avg_delay"),
    )


def sliding_average(
    reports: DataFrame, value: str = "delay", size_ms: int = TRAILING_MS, slide_ms: int = SLIDE_MS
) -> DataFrame:
    """Mean of ``value`` over every non-empty window ``[start, start + size)``,
    ``start`` a multiple of ``slide``: ``(window_start_ms, window_end_ms,
    delay_sum, n, avg_delay)``.  Reports without a value are not counted."""
    return average_of_panes(_panes(active(reports), value, slide_ms), size_ms, slide_ms)


def store_panes(reports: DataFrame, path: str, part: str, value: str = "delay", slide_ms: int = SLIDE_MS) -> None:
    """Keep the panes of one input (a day, a delivery) as ``path/part=<part>``:
    partial sums that never need the reports again.  Storing the same part once
    more replaces it."""
    _panes(active(reports), value, slide_ms).write.mode("overwrite").parquet(f"{path}/part={part}")


def stored_panes(spark: SparkSession, path: str) -> DataFrame:
    """All stored parts merged by pane."""
    parts = spark.read.option("basePath", path).parquet(path)
    return parts.groupBy("pane").agg(F.sum("delay_sum").alias("delay_sum"), F.sum("n").alias("n"))


def sliding_vehicle_average(
    reports: DataFrame, size_ms: int = TRAILING_MS, slide_ms: int = SLIDE_MS, buckets: int | None = None
) -> DataFrame:
    """Mean delay over the *vehicles* reported in every window ``[start, start +
    size)``, each with its newest report in it: ``(window_start_ms,
    window_end_ms, delay_sum, n, avg_delay)``.

    A report counts in the windows that end after it and neither after the
    vehicle's next report nor ``size`` beyond its own time: a run of window ends,
    since a later report takes its place.  So it adds its delay at the run's
    first end and takes it off behind the last one; the differences are added up
    per window end before the shuffle, and their running sums over all ends
    (carried over buckets of equal counts) are the answers, whatever the number
    of vehicles and windows.  A vehicle whose newest report has no delay is not
    counted; of reports with one time the first arrival counts."""
    if size_ms % slide_ms:
        raise ValueError("window size must be a multiple of the slide")
    a = active(reports).select("id", "seq", "delay", "lastupdate")
    states = with_next_time(a, part=["id"], buckets=buckets)
    first = F.floor(F.col("lastupdate") / slide_ms).cast("bigint") + 1
    gone = F.least(F.coalesce("_next", F.col("lastupdate") + size_ms), F.col("lastupdate") + size_ms)
    last = F.floor(gone / slide_ms).cast("bigint")
    runs = states.select(first.alias("first"), last.alias("last"), F.col("delay").cast(EXACT).alias("d")).where("first <= last AND d IS NOT NULL")
    steps = F.array(
        F.struct(F.col("first").alias("end"), F.col("d"), F.lit(1).cast("bigint").alias("n")),
        F.struct((F.col("last") + 1).alias("end"), (-F.col("d")).alias("d"), F.lit(-1).cast("bigint").alias("n")),
    )
    steps = runs.select(F.inline(steps)).groupBy("end").agg(F.sum("d").cast(EXACT).alias("d"), F.sum("n").alias("n"))
    sums = with_running_sums(steps, "end", ["d", "n"], buckets).where("n > 0")
    # the sums stand until the next difference, at most size / slide ends on
    ends = sums.select("d", "n", F.explode(F.sequence(F.col("end"), F.col("next_end") - 1)).alias("end"))
    total = F.col("d").cast("double")
    return ends.select(
        (F.col("end") * slide_ms - size_ms).alias("window_start_ms"),
        (F.col("end") * slide_ms).alias("window_end_ms"),
        total.alias("delay_sum"),
        "n",
        (total / F.col("n")).alias("avg_delay"),
    )


def window_counts(reports: DataFrame, size_ms: int = TRAILING_MS, slide_ms: int = SLIDE_MS) -> DataFrame:
    """Number of reports in every non-empty sliding window."""
    panes = _panes(active(reports), None, slide_ms)
    w = _to_windows(panes, size_ms, slide_ms).groupBy("window_start_ms").agg(F.sum("n").alias("n"))
    return w.select("window_start_ms", (F.col("window_start_ms") + size_ms).alias("window_end_ms"), "n")


def total_average(reports: DataFrame, value: str = "delay") -> DataFrame:
    """Mean over all active reports, kept as ``(delay_sum, n)`` so partial
    results can be merged: ``(delay_sum, n, avg_delay)``."""
    return active(reports).agg(
        F.sum(value).alias("delay_sum"), F.count(value).alias("n")
    ).select("delay_sum", "n", (F.col("delay_sum") / F.col("n")).alias("avg_delay"))
