"""Streaming sources and stateless / windowed transformations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.filters import active, north
from ..schema import SLIDE_MS, TRAILING_MS, WATERMARK
from ..sources.events import reports_from_events
from ..sources.landing import report_source
from ..sources.replay import stream_events


def with_event_time(reports: DataFrame) -> DataFrame:
    """Add ``ts`` (TIMESTAMP) from ``lastupdate`` for watermarks and windows."""
    return reports.withColumn("ts", F.timestamp_millis("lastupdate"))


def report_stream_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table of ``sf_dir`` as a stream of reports that land in
    several files, a little out of order (see ``sources.replay``)."""
    return reports_from_events(stream_events(spark, sf_dir))


def report_stream_from_text(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Reports parsed from JSON lines landing in ``landing_dir`` (a watched
    directory).  ``seq`` is not an arrival order across micro-batches here;
    event-time operators order by ``lastupdate``."""
    return report_source(spark, landing_dir, mode="stream", max_files_per_trigger=max_files_per_trigger)


def north_stream(reports: DataFrame) -> DataFrame:
    return north(active(reports))


def sliding_average_stream(
    reports: DataFrame,
    size_ms: int = TRAILING_MS,
    slide_ms: int = SLIDE_MS,
    watermark: str = WATERMARK,
    panes: bool = True,
) -> DataFrame:
    """Event-time sliding average; in append mode a window is emitted once
    the watermark (newest event time minus ``watermark``) passes its end.
    Spark drops a report that is behind the previous micro-batch's watermark.

    ``panes``: reports are first summed per slide-sized pane (one state update
    per report), and the panes feed the sliding windows through a chained
    aggregation on ``window_time``.  Without panes every report updates all
    ``size / slide`` windows (36 state updates for 3 min / 5 s).  Both give
    the same windows; the panes pay off when many reports share a pane.
    ``watermark="0 seconds"`` gives a strictly ordered source."""
    r = with_event_time(active(reports)).withWatermark("ts", watermark)
    size, slide = f"{size_ms // 1000} seconds", f"{slide_ms // 1000} seconds"
    if panes and size_ms % slide_ms == 0:
        p = r.groupBy(F.window("ts", slide).alias("pane")).agg(
            F.sum("delay").alias("pane_sum"), F.count("delay").alias("pane_n")
        )
        w = p.groupBy(F.window(F.window_time("pane"), size, slide)).agg(
            F.sum("pane_sum").alias("delay_sum"), F.sum("pane_n").alias("n")
        )
    else:
        w = r.groupBy(F.window("ts", size, slide)).agg(F.sum("delay").alias("delay_sum"), F.count("delay").alias("n"))
    return w.select(
        F.unix_millis(F.col("window.start")).alias("window_start_ms"),
        F.unix_millis(F.col("window.end")).alias("window_end_ms"),
        "delay_sum",
        "n",
        (F.col("delay_sum") / F.col("n")).alias("avg_delay"),
    )


def sliding_average_processing_time(
    reports: DataFrame, size_ms: int = TRAILING_MS, slide_ms: int = SLIDE_MS
) -> DataFrame:
    """The same over processing time (arrival clock); only for update/complete
    output, results depend on when data arrives."""
    r = active(reports).withColumn("pt", F.current_timestamp())
    w = r.groupBy(F.window("pt", f"{size_ms // 1000} seconds", f"{slide_ms // 1000} seconds")).agg(
        F.count("delay").alias("n"), F.avg("delay").alias("avg_delay")
    )
    return w.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "n", "avg_delay")
