"""Mean time between reports over the last N reports.

The mean of the N-1 gaps between N sorted times telescopes to
``(newest - oldest) / (N - 1)``, so only the frame's ends and size matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import adjacent_deltas, duration_text
from ..schema import LAST_N
from .carry import with_oldest_of_last
from .filters import active
from .topk import top_k

def _newest_first() -> tuple[Column, Column]:
    return (F.col("lastupdate").desc(), F.col("seq").desc())


def last_n_buffer(reports: DataFrame, n: int = LAST_N) -> DataFrame:
    """The ``n`` newest active reports: ``(rank, seq, lastupdate)``, rank 1 newest."""
    a = active(reports).select("seq", "lastupdate")
    return top_k(a, n, _newest_first()).select("rank", "seq", "lastupdate")


def gap_final(reports: DataFrame, n: int = LAST_N) -> DataFrame:
    """``(n, span_ms, gap_ms)`` of the final buffer; no row with fewer than 2."""
    b = last_n_buffer(reports, n)
    g = b.agg(F.count(F.lit(1)).alias("n"), (F.max("lastupdate") - F.min("lastupdate")).alias("span_ms"))
    return g.where("n > 1").select("n", "span_ms", (F.col("span_ms") / (F.col("n") - 1)).alias("gap_ms"))


def buffer_deltas(reports: DataFrame, n: int = LAST_N) -> DataFrame:
    """Gaps between neighbouring times of the final buffer, oldest first:
    ``(pos, delta_ms)`` with pos 1..n-1."""
    b = last_n_buffer(reports, n)
    times = b.agg(F.sort_array(F.collect_list(F.struct("lastupdate", "seq"))).alias("l"))
    times = times.select(F.transform("l", lambda x: x["lastupdate"]).alias("l"))
    return times.select(F.posexplode(adjacent_deltas("l")).alias("pos", "delta_ms")).select(
        (F.col("pos") + 1).alias("pos"), "delta_ms"
    )


def _gap() -> Column:
    return (F.col("span_ms") / (F.col("n") - 1)).alias("gap_ms")


def gap_timeline(reports: DataFrame, n: int = LAST_N, buckets: int | None = None) -> DataFrame:
    """After every active report (fleet-wide, in event-time order), the mean
    gap over the last ``n`` reports: ``(seq, lastupdate, n, span_ms, gap_ms)``.
    The first report has no gap and gives no row."""
    f = with_oldest_of_last(active(reports).select("seq", "lastupdate"), n, buckets=buckets)
    return f.where("n > 1").select("seq", "lastupdate", "n", "span_ms", _gap())


def gap_per_vehicle(reports: DataFrame, n: int = LAST_N, buckets: int | None = None) -> DataFrame:
    """The same per vehicle: ``(id, seq, lastupdate, n, span_ms, gap_ms)``."""
    f = with_oldest_of_last(active(reports).select("id", "seq", "lastupdate"), n, part=["id"], buckets=buckets)
    return f.where("n > 1").select("id", "seq", "lastupdate", "n", "span_ms", _gap())


def rounded_gap_micros(span_ms: Column, n: Column) -> Column:
    """``span / (n - 1)`` in whole microseconds, halves to even (the rounding
    of a duration divided by an integer)."""
    us = span_ms * 1000
    m = n - 1
    q = F.floor(us / m).cast("bigint")
    r2 = (us - q * m) * 2
    return F.when(r2 > m, q + 1).when((r2 == m) & (q % 2 == 1), q + 1).otherwise(q)


def gap_text_timeline(reports: DataFrame, n: int = LAST_N, buckets: int | None = None) -> DataFrame:
    """``(seq, gap_text)``: each mean gap as duration text (``H:MM:SS[.ffffff]``)."""
    return gap_text(gap_timeline(reports, n, buckets))


def gap_text(frames: DataFrame, *keep: str) -> DataFrame:
    """``(seq, gap_text)`` of rows ``(seq, n, span_ms)`` with a gap; ``keep``
    names further columns to pass on."""
    text = duration_text(rounded_gap_micros(F.col("span_ms"), F.col("n")))
    return frames.where("n > 1").select("seq", *keep, text.alias("gap_text"))


__all__ = [
    "gap_text",
    "last_n_buffer",
    "gap_final",
    "buffer_deltas",
    "gap_timeline",
    "gap_per_vehicle",
    "gap_text_timeline",
    "rounded_gap_micros",
]
