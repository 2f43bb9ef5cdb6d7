"""Adapter from the ``events`` table to vehicle reports.

The test tables hold no vehicle feed, so each event stands for one report:

    seq         event_id                      (arrival order)
    id          user_id as text               (the vehicle)
    bearing     (k mod 25) * 15, k = props.k  (0, 15, ..., 360)
    isinactive  "true" for event_type 'error', else "false"
    ltype       user_id mod 6                 (5 = train)
    delay       round(value * 100) - 3000     (integer hundredths, exact sums)
    lastupdate  epoch milliseconds of ts
    laststopid  event_id mod 97 as text

Everything is a column expression, so the adapter works on batch and
streaming DataFrames alike and keeps Parquet column pruning intact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def epoch_millis(ts_col: str) -> Column:
    """Epoch milliseconds of a TIMESTAMP_NTZ column, independent of the
    session time zone."""
    return F.expr(f"timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts_col})")


def _integral_fields(events: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("bigint")
    return events.select(
        *[F.col(c).alias(f"_src_{c}") for c in carry],
        F.col("event_id").alias("seq"),
        F.col("user_id").cast("string").alias("id"),
        ((k % 25) * 15).alias("bearing"),
        F.when(F.col("event_type") == "error", F.lit("true")).otherwise(F.lit("false")).alias("isinactive"),
        (F.col("user_id") % 6).cast("int").alias("ltype"),
        (F.round(F.col("value") * 100).cast("bigint") - 3000).alias("delay"),
        epoch_millis("ts").alias("lastupdate"),
        (F.col("event_id") % 97).cast("string").alias("laststopid"),
    )


def reports_from_events(events: DataFrame, active_only: bool = False) -> DataFrame:
    """Flat report columns (see ``schema.REPORT_COLUMNS``).  ``active_only``
    leaves inactive reports out by a test on the raw column, which reaches the
    Parquet scan."""
    r = _integral_fields(events.where(F.col("event_type") != "error") if active_only else events)
    return r.select(
        "seq",
        "id",
        F.col("bearing").cast("double").alias("bearing"),
        "isinactive",
        "ltype",
        F.col("delay").cast("double").alias("delay"),
        "lastupdate",
        "laststopid",
    )


def report_lines_from_events(events: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """One compact JSON document per report, as a landing file would hold it:
    ``(seq, value)`` with ``value`` like
    ``{"attributes":{"id":"8","bearing":285,...}}``.  Columns named in
    ``carry`` are passed through as ``_src_<name>``."""
    r = _integral_fields(events, carry)
    attrs = F.struct("id", "bearing", "isinactive", "ltype", "delay", "lastupdate", "laststopid")
    return r.select(
        "seq", F.to_json(F.struct(attrs.alias("attributes"))).alias("value"), *[f"_src_{c}" for c in carry]
    )
