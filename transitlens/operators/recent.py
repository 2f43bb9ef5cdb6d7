"""The most recently updated delayed vehicles in a trailing window.

After every delayed report r (event-time order ``lastupdate, seq``) the list
holds the newest report of each vehicle among the delayed reports q with
``r.lastupdate - W <= q.lastupdate`` and q not after r, sorted newest first,
cut to 5.  A list counts as changed unless it and the previous one both hold
5 entries with the same ``(id, delay)`` at every position.

Scale-out: the reports are range-partitioned by time into buckets of equal
counts (``carry.ordered_buckets``).  All a bucket needs from the past is the 5
newest distinct vehicles of each earlier bucket that reaches into the last 2W
before it (the newest 5 distinct vehicles of a union are among the newest 5 of
each part); with these seeds it also knows the list that stood before its
first row.  Within a bucket the lists are array arithmetic: with ``next[p]`` the
place of the same vehicle's next report, the list at i is the 5 largest places
p <= i with ``next[p] > i``, found for all rows at once by descending a table of
block maxima of ``next``.  A bucket is worked off in chunks, each handing its 5
newest distinct vehicles to the next, so memory does not follow its size.
"""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from ..functions import iso_text, json_string, number_text
from ..schema import TOP_N, TRAILING_MS
from .carry import ordered_buckets
from .filters import active, delayed
from .latest import latest_per_key
from .topk import top_k

LIST_SCHEMA = StructType(
    [
        StructField("seq", LongType()),
        StructField("rank", IntegerType()),
        StructField("id", StringType()),
        StructField("delay", DoubleType()),
        StructField("lastupdate", LongType()),
        StructField("changed", BooleanType()),
    ]
)


_DTYPES = {"seq": "int64", "rank": "int32", "id": "object", "delay": "float64", "lastupdate": "int64", "changed": "bool"}
CHUNK_ROWS = 100_000


def next_places(code: np.ndarray) -> np.ndarray:
    """Place of the next equal code, ``len(code)`` where there is none."""
    order = np.argsort(code, kind="stable")
    out = np.full(len(code), len(code), np.int64)
    same = code[order[1:]] == code[order[:-1]]
    out[order[:-1][same]] = order[1:][same]
    return out


def block_maxima(values: np.ndarray) -> list[np.ndarray]:
    """Maxima of aligned blocks of 1, 2, 4, ... values."""
    levels = [values]
    while len(levels[-1]) > 1:
        v = levels[-1]
        levels.append(np.maximum(v[0::2], np.append(v[1::2], -1)[: len(v[0::2])]))
    return levels


def last_above(levels: list[np.ndarray], before: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Largest place ``p < before`` with a value above ``least``, else -1; for
    all queries at once, in steps of blocks of doubling size."""
    pos, block, level = before.copy(), np.full(len(before), -1), np.full(len(before), -1)
    open_ = np.flatnonzero(pos > 0)
    for depth, maxima in enumerate(levels):
        here = open_[(pos[open_] >> depth) & 1 == 1]
        left = (pos[here] >> depth) - 1
        hit = maxima[left] > least[here]
        block[here[hit]], level[here[hit]] = left[hit], depth
        pos[here[~hit]] -= 1 << depth
        open_ = open_[(level[open_] < 0) & (pos[open_] > 0)]
        if not len(open_):
            break
    for depth in range(len(levels) - 1, 0, -1):
        here = np.flatnonzero(level == depth)
        right = 2 * block[here] + 1
        inside = right < len(levels[depth - 1])
        high = np.zeros(len(here), bool)
        high[inside] = levels[depth - 1][right[inside]] > least[here[inside]]
        block[here], level[here] = np.where(high, right, right - 1), depth - 1
    return block


def newest_places(code: np.ndarray, k: int) -> np.ndarray:
    """Row i: the places of the k newest distinct codes up to i, -1 for none."""
    n = len(code)
    levels, i = block_maxima(next_places(code)), np.arange(n)
    out = np.full((n, k), -1, np.int64)
    out[:, 0] = i
    for r in range(1, k):
        more = np.flatnonzero(out[:, r - 1] > 0)
        out[more, r] = last_above(levels, out[more, r - 1], i[more])
    return out


def _scan(window_ms: int, k: int):
    """Lists of rows sorted by (bucket, kind, lastupdate, seq); kind 0 = seed
    from earlier buckets, 1 = the bucket's own report."""

    def lists(rows: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
        """(output of the emitting rows, rows to hand on)."""
        code = pd.factorize(rows["id"])[0]
        t, delay = rows["lastupdate"].to_numpy(np.int64), rows["delay"].to_numpy(np.float64)
        places = newest_places(code, k)
        shown = (places >= 0) & (t[places] >= (t - window_ms)[:, None])
        ids, delays = np.where(shown, code[places], -1), np.where(shown, delay[places], 0.0)
        same = (ids[1:] == ids[:-1]).all(axis=1) & (delays[1:] == delays[:-1]).all(axis=1) & shown[1:].all(axis=1)
        changed = ~np.concatenate([[False], same])
        emit = rows["_emit"].to_numpy(bool) & (rows["_kind"].to_numpy() == 1)
        row, rank = np.nonzero(shown & emit[:, None])
        at = places[row, rank]
        out = pd.DataFrame(
            {
                "seq": rows["seq"].to_numpy(np.int64)[row],
                "rank": (rank + 1).astype(np.int32),
                "id": rows["id"].to_numpy(object)[at],
                "delay": delay[at],
                "lastupdate": t[at],
                "changed": changed[row],
            }
        ).astype(_DTYPES)
        last = places[-1][places[-1] >= 0][::-1]
        return out, rows.iloc[last].assign(_kind=0)

    def newest_of(seeds: pd.DataFrame) -> pd.DataFrame:
        """The k newest distinct vehicles among the seeds, oldest first."""
        return seeds.drop_duplicates("id", keep="last").tail(k)

    def run(batches):
        bucket, held = None, None
        for pdf in batches:
            for b, part in pdf.groupby("_b", sort=False):
                if b != bucket:
                    bucket, held = b, part.iloc[:0]
                for lo in range(0, len(part), CHUNK_ROWS):
                    rows = pd.concat([held, part.iloc[lo : lo + CHUNK_ROWS]], ignore_index=True)
                    own = rows["_kind"].to_numpy() == 1
                    if not own.any():
                        held = newest_of(rows)
                        continue
                    first = int(np.argmax(own))
                    rows = pd.concat([newest_of(rows.iloc[:first]), rows.iloc[first:]], ignore_index=True)
                    out, held = lists(rows)
                    yield out

    return run


def recent_lists(
    reports: DataFrame,
    window_ms: int = TRAILING_MS,
    k: int = TOP_N,
    buckets: int | None = None,
    context: DataFrame | None = None,
    scratch: str | None = None,
) -> DataFrame:
    """Every delayed report's list: ``(seq, rank, id, delay, lastupdate, changed)``.
    ``context``: earlier delayed reports ``(seq, id, delay, lastupdate)`` that
    shape the lists but get none of their own (see ``newest_distinct``)."""
    d = delayed(active(reports)).select("seq", "id", "delay", "lastupdate").withColumn("_emit", F.lit(True))
    if context is not None:
        d = d.unionByName(context.select("seq", "id", "delay", "lastupdate").withColumn("_emit", F.lit(False)))
    d = ordered_buckets(d, ["lastupdate", "seq"], buckets, scratch)
    # last bucket that each bucket's newest vehicles can matter to: one row per bucket
    bounds = d.groupBy("_b").agg(F.min("lastupdate").alias("lo"), F.max("lastupdate").alias("hi")).orderBy("_b").collect()
    begins = [r["lo"] for r in bounds]
    reach = [max(bisect.bisect_right(begins, r["hi"] + 2 * window_ms) - 1, i) for i, r in enumerate(bounds)]
    reached = d.sparkSession.createDataFrame([(i, last) for i, last in enumerate(reach)], "_b int, _last int")

    per_vehicle = latest_per_key(d, ["_b", "id"], ["lastupdate", "seq", "delay"], tie="last")
    newest = Window.partitionBy("_b").orderBy(F.col("lastupdate").desc(), F.col("seq").desc())
    tails = per_vehicle.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= k).drop("_n")
    seeds = tails.join(F.broadcast(reached), "_b").where("_last > _b").select(
        F.explode(F.sequence(F.col("_b") + 1, F.col("_last"))).alias("_b"),
        "id", "lastupdate", "seq", "delay", F.lit(0).alias("_kind"), F.lit(False).alias("_emit"),
    )
    rows = d.withColumn("_kind", F.lit(1)).unionByName(seeds)
    # a bucket per task
    rows = rows.repartitionById(max(len(bounds), 1), F.col("_b")).sortWithinPartitions("_b", "_kind", "lastupdate", "seq")
    return rows.mapInPandas(_scan(window_ms, k), LIST_SCHEMA)


def newest_distinct(reports: DataFrame, k: int = TOP_N, context: DataFrame | None = None) -> DataFrame:
    """The ``k`` newest distinct delayed vehicles with their newest delayed
    report ``(seq, id, delay, lastupdate)``: all that later reports need from
    the past (the newest k distinct vehicles of a union are among the newest
    k of each part)."""
    d = delayed(active(reports)).select("seq", "id", "delay", "lastupdate")
    if context is not None:
        d = d.unionByName(context.select("seq", "id", "delay", "lastupdate"))
    per_vehicle = latest_per_key(d, "id", ["seq", "delay", "lastupdate"], tie="last")
    order = (F.col("lastupdate").desc(), F.col("seq").desc())
    return top_k(per_vehicle, k, order).select("seq", "id", "delay", "lastupdate")


def recent_timeline(reports: DataFrame, window_ms: int = TRAILING_MS, k: int = TOP_N) -> DataFrame:
    """``(seq, rank, id, delay, lastupdate)`` for every delayed report."""
    return recent_lists(reports, window_ms, k).drop("changed")


def recent_changes(reports: DataFrame, window_ms: int = TRAILING_MS, k: int = TOP_N) -> DataFrame:
    """Only the lists that changed against the one before."""
    return recent_lists(reports, window_ms, k).where("changed").drop("changed")


def recent_changes_iso(reports: DataFrame, window_ms: int = TRAILING_MS, k: int = TOP_N) -> DataFrame:
    """Changed lists with the update time as ISO-8601 text (UTC)."""
    c = recent_changes(reports, window_ms, k)
    return c.select("seq", "rank", "id", "delay", iso_text("lastupdate").alias("lastupdate_iso"))


def list_lines(lists: DataFrame) -> DataFrame:
    """``(seq, t, line)``: each list as one JSON line ``[["id", delay, "iso time"],
    ...]``; t is the event time of the report it stands after."""
    item = F.concat(
        F.lit("["), json_string("id"), F.lit(", "), number_text("delay"), F.lit(', "'), iso_text("lastupdate"), F.lit('"]')
    )
    items = F.sort_array(F.collect_list(F.struct("rank", item.alias("item"))))
    lines = lists.groupBy("seq").agg(F.max("lastupdate").alias("t"), items.alias("items"))
    text = F.concat(F.lit("["), F.array_join(F.transform("items", lambda x: x["item"]), ", "), F.lit("]"))
    return lines.select("seq", "t", text.alias("line"))


def recent_final_from_latest(per_vehicle: DataFrame, window_ms: int = TRAILING_MS, k: int = TOP_N) -> DataFrame:
    """The final list from each vehicle's newest delayed report
    ``(id, delay, lastupdate, seq)``: a vehicle whose newest delayed report is
    outside the window has no report inside it either."""
    newest = per_vehicle.select(F.max("lastupdate")).scalar()
    recent = per_vehicle.where(F.col("lastupdate") >= newest - window_ms)
    order = (F.col("lastupdate").desc(), F.col("seq").desc())
    return top_k(recent, k, order).select("rank", "id", "delay", "lastupdate")


def recent_final(reports: DataFrame, window_ms: int = TRAILING_MS, k: int = TOP_N) -> DataFrame:
    """The list after the newest delayed report: ``(rank, id, delay, lastupdate)``.
    Declarative: a scalar subquery for the newest time, a range filter, a
    partial aggregate per vehicle and a partial top-k."""
    d = delayed(active(reports))
    newest = d.select(F.max("lastupdate")).scalar()
    recent = d.where(F.col("lastupdate") >= newest - window_ms)
    per_vehicle = latest_per_key(recent, "id", ["delay", "lastupdate", "seq"], tie="last")
    order = (F.col("lastupdate").desc(), F.col("seq").desc())
    return top_k(per_vehicle, k, order).select("rank", "id", "delay", "lastupdate")
