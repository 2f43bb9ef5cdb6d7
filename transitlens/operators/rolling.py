"""The top-k delayed vehicles as they stand at given marks (T1, T1b): at every
tick, or after every report.

A vehicle's report is its state from its place ``(lastupdate, seq)`` until the
place of its next strictly newer report; the list at a mark holds the k largest
positive delays among the states that stand there (ties by id).

Scale-out: states (by where they begin) and marks are range-partitioned by place
into buckets of equal counts.  A state that outlives its bucket is split into

* the bucket it ends in, which gets it as a row of its own (one per state), and
* the buckets it stands in throughout: aligned blocks of 1, 2, 4, ... buckets, of
  which a run of buckets needs two a size at most.  Of what stands throughout a
  block only the k largest delays can ever be listed, so a block keeps k rows,
  limited before the shuffle, and hands them to its buckets.

A bucket thus gets its own states and marks, the states that end in it, and k
rows a block size, never the whole fleet, and walks them in order with a heap; a
state that has ended leaves the heap when it comes up.  The work follows the
states and the marks, not vehicles times ticks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import TOP_N
from .carry import ordered_buckets, with_next_place
from .filters import active
from .topk import delay_order, top_k

NEVER = (1 << 63) - 1
STANDS, BEGINS, MARK = 0, 1, 2
ROWS = "id string, delay double, t long, s long, until_t long, until_s long, kind int, emit boolean"
PLACED = f"{ROWS}, _b int, node long"
LISTS = "t long, s long, rank int, id string, delay double, lastupdate long, changed boolean"
_FIELDS = [f.split()[0] for f in ROWS.split(", ")]


def states(reports: DataFrame, buckets: int | None = None, scratch: str | None = None) -> DataFrame:
    """``(id, delay, t, s, until_t, until_s)``: every positive delay from the
    report that gave it until the vehicle's next strictly newer one."""
    # of a vehicle's reports of one time the first arrival counts
    first = active(reports).groupBy("id", "lastupdate").agg(F.min(F.struct("seq", "delay")).alias("r"))
    rows = with_next_place(first.select("id", "lastupdate", F.col("r.seq").alias("seq"), F.col("r.delay").alias("delay")), buckets=buckets, scratch=scratch)
    ends = [F.coalesce(c, F.lit(NEVER)).alias(f"until_{c[-1]}") for c in ("next_t", "next_s")]
    return rows.where("delay > 0").select("id", "delay", F.col("lastupdate").alias("t"), F.col("seq").alias("s"), *ends)


def blocks_between(first: np.ndarray, end: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The aligned blocks that cover buckets ``first`` to ``end - 1`` of ``size``
    (a power of two): (which of the runs, block) per round.  Block 1 is all
    buckets, blocks 2 i and 2 i + 1 are the halves of block i."""
    left, right, out = first + size, end + size, []
    while (left < right).any():
        for odd, block in (((left < right) & (left & 1 == 1), left), ((left < right) & (right & 1 == 1), right - 1)):
            at = np.flatnonzero(odd)
            out.append((at, block[at]))
        left, right = (left + 1) >> 1, right >> 1
    return out


def _carried(begins: list[tuple[int, int]]):
    """States that outlive their bucket -> a row for the bucket they end in, and
    a row per block of buckets that they stand in throughout."""
    low_t = np.array([t for t, _ in begins], np.int64)
    low_s = np.array([s for _, s in begins], np.int64)
    n, size = len(begins), 1 << max(len(begins) - 1, 0).bit_length()

    def bucket_of(t: np.ndarray, s: np.ndarray) -> np.ndarray:
        """The last bucket that begins at or before a place."""
        lo, hi = np.searchsorted(low_t, t, "left"), np.searchsorted(low_t, t, "right")
        # buckets that begin at the same time are told apart by the tie
        for i in np.flatnonzero(lo < hi):
            hi[i] = lo[i] + np.searchsorted(low_s[lo[i] : hi[i]], s[i], "right")
        return hi - 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t, s, b = (batch.column(c).to_numpy() for c in ("until_t", "until_s", "_b"))
            never = t == NEVER
            end = np.where(never, n, bucket_of(t, s))
            parts = [(np.flatnonzero(~never & (end > b)), None)]
            parts += blocks_between(b.astype(np.int64) + 1, np.maximum(end, b + 1).astype(np.int64), size)
            for at, block in parts:
                if len(at):
                    rows = batch.take(pa.array(at))
                    columns = {c: rows.column(c) for c in _FIELDS}
                    columns["kind"] = pa.array(np.full(len(at), STANDS), pa.int32())
                    columns["_b"] = pa.array(end[at] if block is None else np.full(len(at), -1), pa.int32())
                    columns["node"] = pa.array(np.zeros(len(at)) if block is None else block, pa.int64())
                    yield pa.RecordBatch.from_pydict(columns)

    return work


def buckets_of_block(block: str, n: int):
    """The buckets below a block, of ``n`` in all."""
    size = 1 << max(n - 1, 0).bit_length()
    depth = F.floor(F.log2(F.col(block).cast("double")))
    wide = (F.lit(size) / F.pow(F.lit(2.0), depth)).cast("bigint")
    first = F.col(block) * wide - size
    return F.sequence(first, F.least(first + wide - 1, F.lit(n - 1).cast("bigint"))).cast("array<int>")


def _walk(k: int, only_changes: bool = False):
    """Lists at the marks of rows sorted by (bucket, stands first, place, kind);
    ``only_changes``: only those that differ from the list at the mark before."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bucket, heap, shown = None, [], []
        started = stale = False

        def top(t: int, s: int) -> list[tuple]:
            """The k first states of the heap that have not ended at (t, s)."""
            kept = []
            while heap and len(kept) < k:
                x = heapq.heappop(heap)
                if (x[2], x[3]) > (t, s):
                    kept.append(x)
            for x in kept:
                heapq.heappush(heap, x)
            return kept

        for pdf in batches:
            out = []
            for b, id_, delay, t, s, until_t, until_s, kind, emit in zip(*[pdf[c].tolist() for c in ("_b", *_FIELDS)], strict=True):
                if b != bucket:
                    bucket, heap, shown, started, stale = b, [], [], False, False
                if kind != STANDS and not started:
                    # what stood before the bucket's first place
                    started, whole = True, list(heap)
                    shown = top(t, s - 1) if whole else []
                    heap = whole
                if kind != MARK:
                    x = (-delay, id_, until_t, until_s, t)
                    heapq.heappush(heap, x)
                    stale = stale or len(shown) < k or x < shown[-1]
                    continue
                # the list stands until a state comes into it or one of its own ends
                changed = False
                if stale or any((x[2], x[3]) <= (t, s) for x in shown):
                    now, stale = top(t, s), False
                    changed = [x[:2] for x in now] != [x[:2] for x in shown]
                    shown = now
                if emit and (changed or not only_changes):
                    out += [(t, s, i + 1, x[1], -x[0], x[4], changed) for i, x in enumerate(shown)]
            if out:
                yield pd.DataFrame(out, columns=[f.split()[0] for f in LISTS.split(", ")])

    return run


def lists_at(
    states_: DataFrame, marks: DataFrame, k: int = TOP_N, buckets: int | None = None, scratch: str | None = None, only_changes: bool = False
) -> DataFrame:
    """The list at every mark ``(t, s, emit)``: ``(t, s, rank, id, delay,
    lastupdate, changed)``; ``changed`` compares with the mark before.  A mark
    with an empty list has no rows; one without ``emit`` is only compared with.
    ``only_changes``: the lists with ``changed`` only."""
    none = [F.lit(None).cast(t).alias(c) for c, t in (("id", "string"), ("delay", "double"), ("until_t", "long"), ("until_s", "long"))]
    rows = states_.withColumn("kind", F.lit(BEGINS)).withColumn("emit", F.lit(False)).select(_FIELDS)
    rows = rows.unionByName(marks.select("t", "s", *none, F.lit(MARK).alias("kind"), "emit"))
    d = ordered_buckets(rows, ["t", "s"], buckets, scratch).select(*_FIELDS, "_b")
    # one place per bucket
    low = d.groupBy("_b").agg(F.min(F.struct("t", "s")).alias("low")).orderBy("_b").collect()
    begins = [(r["low"]["t"], r["low"]["s"]) for r in low]
    if len(begins) > 1:
        carried = d.where(F.col("kind") == BEGINS).mapInArrow(_carried(begins), PLACED)
        # of a block, and then of a bucket, k states can be listed
        in_block = top_k(carried.where("node > 0"), k, delay_order(), by=["node"], rank_col="_r").drop("_r")
        in_bucket = in_block.withColumn("_b", F.explode(buckets_of_block("node", len(begins))))
        in_bucket = top_k(in_bucket, k, delay_order(), by=["_b"], rank_col="_r").drop("_r")
        d = d.unionByName(carried.where("node = 0").drop("node")).unionByName(in_bucket.drop("node"))
    order = ["_b", F.col("kind") != STANDS, "t", "s", "kind"]
    # a bucket per task
    return d.repartitionById(max(len(begins), 1), F.col("_b")).sortWithinPartitions(*order).mapInPandas(_walk(k, only_changes), LISTS)


def tick_marks(spark: SparkSession, first: int, last: int, tick_ms: int) -> DataFrame:
    """A mark behind all reports of each tick's time."""
    ticks = spark.range(first, last + 1, tick_ms)
    return ticks.select(F.col("id").alias("t"), F.lit(NEVER).alias("s"), F.lit(True).alias("emit"))


def top_after_each(
    reports: DataFrame,
    k: int = TOP_N,
    buckets: int | None = None,
    context: DataFrame | None = None,
    scratch: str | None = None,
    only_changes: bool = False,
) -> DataFrame:
    """The list after every active report, in the order ``(lastupdate, seq)``:
    ``(seq, rank, id, delay, lastupdate, changed)``, ``lastupdate`` being that of
    the listed vehicle.  ``context``: the newest earlier reports, which shape the
    lists but get none of their own.  ``only_changes``: the lists with ``changed`` only."""
    a = active(reports).select("id", "seq", "delay", "lastupdate", "isinactive", F.lit(True).alias("emit"))
    if context is not None:
        a = a.unionByName(active(context).select("id", "seq", "delay", "lastupdate", "isinactive", F.lit(False).alias("emit")))
    marks = a.select(F.col("lastupdate").alias("t"), F.col("seq").alias("s"), "emit")
    lists = lists_at(states(a, buckets, scratch and f"{scratch}/states"), marks, k, buckets, scratch and f"{scratch}/lists", only_changes)
    return lists.select(F.col("s").alias("seq"), "rank", "id", "delay", "lastupdate", "changed")
