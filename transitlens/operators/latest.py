"""Last known state per key (A1, A3).

``max_by`` is a decomposable aggregate: every map task keeps one row per key
before the shuffle, so a key that holds a third of all reports still sends one
row per map task, and the state is one row per key.  Order and values are
fixed-width, which lets Spark aggregate by hash without sorting its input (a
text value, such as a train's stop, still needs the sort).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .carry import ordered_buckets
from .filters import active, trains


def _order(tie: str) -> Column:
    """``(lastupdate, ±seq)`` packed into one fixed-width number, so that the
    aggregate's buffer can be updated in place (hash, not sort, aggregation)."""
    if tie not in ("first", "last"):
        raise ValueError("tie must be 'first' or 'last'")
    # 'first': among equal lastupdate the earliest arrival (smallest seq) wins
    seq = -F.col("seq") if tie == "first" else F.col("seq")
    return F.col("lastupdate").cast("decimal(19,0)") * F.lit(f"1{'0' * 19}").cast("decimal(20,0)") + seq.cast("decimal(19,0)")


def latest_per_key(
    df: DataFrame,
    key: str | Sequence[str] = "id",
    cols: Sequence[str] = ("delay", "lastupdate"),
    tie: str = "first",
) -> DataFrame:
    """The newest report per ``key`` by ``lastupdate``; ``tie`` picks the first
    or the last arrival among reports with the same ``lastupdate``."""
    keys = [key] if isinstance(key, str) else list(key)
    order = _order(tie)
    return df.groupBy(*keys).agg(*[F.max_by(c, order).alias(c) for c in cols])


#: what is kept of a train's newest report
LAST_STOP = ("laststopid", "lastupdate")


def as_last_stop(newest: DataFrame) -> DataFrame:
    return newest.select("id", F.col("laststopid").alias("last_stop"), F.col("lastupdate").alias("last_update"))


def train_last_stop(reports: DataFrame) -> DataFrame:
    """``(id, last_stop, last_update)`` for every train reported so far; a report
    replaces the known one only when strictly newer."""
    t = trains(active(reports))
    return as_last_stop(latest_per_key(t, "id", LAST_STOP, tie="first"))


def last_stop_changes(reports: DataFrame, buckets: int | None = None, known: DataFrame | None = None, scratch: str | None = None) -> DataFrame:
    """Every report that replaced what was known of its train, in the order of
    arrival (``seq``): ``(seq, id, last_stop, last_update)``.  A report does so
    when it is strictly newer than all of the train that arrived before it.

    ``known``: the newest report per train ``(id, lastupdate)`` from before.  The
    running maximum of a train goes over buckets of equal counts; a train that
    runs on over several buckets hands on one maximum each."""
    t = trains(active(reports)).select("seq", "id", "laststopid", "lastupdate", F.lit(True).alias("_emit"))
    if known is not None:
        old = known.select(F.lit(-1).cast("bigint").alias("seq"), "id", F.lit(None).cast("string").alias("laststopid"), "lastupdate", F.lit(False).alias("_emit"))
        t = t.unionByName(old)
    d = ordered_buckets(t, ["id", "seq"], buckets, scratch)
    before = Window.partitionBy("_b", "id").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_before", F.max("lastupdate").over(before))
    earlier = Window.partitionBy("id").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = d.groupBy("_b", "id").agg(F.max("lastupdate").alias("_m")).withColumn("_carried", F.max("_m").over(earlier))
    carried = carried.where("_carried IS NOT NULL").select(F.col("_b").alias("_cb"), F.col("id").alias("_cid"), "_carried")
    d = d.join(carried, (F.col("_b") == F.col("_cb")) & F.col("id").eqNullSafe(F.col("_cid")), "left")
    newest = F.greatest("_before", "_carried")
    new = d.where(F.col("_emit") & (newest.isNull() | (F.col("lastupdate") > newest)))
    return new.select("seq", "id", F.col("laststopid").alias("last_stop"), F.col("lastupdate").alias("last_update"))


def train_snapshot_lines(last_stop: DataFrame, header: str) -> DataFrame:
    """The snapshot file as ``(ord, line)``: the header (ord 0), then one
    ``'id','stop','ms'`` line per train (ord 1)."""
    body = last_stop.select(
        F.lit(1).alias("ord"),
        F.format_string("'%s','%s','%s'", "id", "last_stop", F.col("last_update").cast("string")).alias("line"),
    )
    head = last_stop.sparkSession.range(1).select(F.lit(0).alias("ord"), F.lit(header).alias("line"))
    return head.unionByName(body)
