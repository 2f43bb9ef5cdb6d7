"""Top-k lists.

``row_number() <= k`` over an ordering is planned by Spark as a partial
per-partition limit (WindowGroupLimit) before the exchange, so at most k rows
per map task reach the final ranking, whatever the input size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import json_string, number_text
from ..schema import TOP_N
from .filters import active, delayed
from .latest import latest_per_key


def top_k(df: DataFrame, k: int, order: Sequence[Column], by: Sequence[str] = (), rank_col: str = "rank") -> DataFrame:
    """Rows ranked 1..k by ``order`` (per group ``by`` when given)."""
    w = Window.partitionBy(*by).orderBy(*order) if by else Window.orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def delay_order() -> tuple[Column, Column]:
    """Largest delay first, ties by vehicle id."""
    return (F.col("delay").desc(), F.col("id").asc())


def latest_delay_per_vehicle(reports: DataFrame) -> DataFrame:
    """``(id, delay, lastupdate)`` of each active vehicle's newest report."""
    return latest_per_key(active(reports), "id", ["delay", "lastupdate"], tie="first")


def top_delayed(reports: DataFrame, k: int = TOP_N, filter_first: bool = False) -> DataFrame:
    """At most ``k`` delayed vehicles by their last reported delay, largest
    first (ties by id).  By default a vehicle counts with its newest report,
    so one that is on time again drops out; ``filter_first`` keeps the newest
    *delayed* report instead."""
    a = active(reports)
    if filter_first:
        latest = latest_per_key(delayed(a), "id", ["delay", "lastupdate"], tie="first")
    else:
        latest = delayed(latest_per_key(a, "id", ["delay", "lastupdate"], tie="first"))
    return top_k(latest, k, delay_order()).select("rank", "id", "delay", "lastupdate")


def top_list_json(top: DataFrame) -> DataFrame:
    """The ranked list as one JSON line ``[["id", delay, lastupdate], ...]``."""
    item = F.concat(
        F.lit("["), json_string("id"), F.lit(", "), number_text("delay"), F.lit(", "),
        F.col("lastupdate").cast("string"), F.lit("]"),
    )
    items = F.sort_array(F.collect_list(F.struct(F.col("rank"), item.alias("item"))))
    return top.agg(
        F.concat(F.lit("["), F.array_join(F.transform(items, lambda x: x["item"]), ", "), F.lit("]")).alias("line")
    )


def top_delayed_timeline(
    reports: DataFrame, tick_ms: int, k: int = TOP_N, buckets: int | None = None
) -> DataFrame:
    """The top-``k`` delayed list as it stood at every tick (multiples of
    ``tick_ms`` between the first and the last report): ``(tick_ms, rank, id,
    delay)``.  A report is a vehicle's state from its ``lastupdate`` until the
    vehicle's next report (see ``rolling``)."""
    from . import rolling

    a = active(reports).select("id", "seq", "delay", "lastupdate", "isinactive")
    lo, hi = a.agg(F.min("lastupdate"), F.max("lastupdate")).first()
    first, last = (0, -1) if lo is None else (-(-lo // tick_ms) * tick_ms, hi // tick_ms * tick_ms)
    marks = rolling.tick_marks(reports.sparkSession, first, last, tick_ms)
    lists = rolling.lists_at(rolling.states(a, buckets), marks, k, buckets)
    return lists.select(F.col("t").alias("tick_ms"), "rank", "id", "delay")
