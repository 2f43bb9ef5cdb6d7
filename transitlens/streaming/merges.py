"""Micro-batch merges for fleet-wide answers (Q4 lists, Q6 buffer and gaps, late rows).

A fleet-wide answer must not become one long-lived group in the state store.
Each micro-batch reduces its own rows first, then merges the small result with
the state of the batch before in ``foreachBatch``.  A state is written to one of
two alternating slots (``slot = batch_id mod 2``) with its ``batch_id`` inside; a
batch reads the slot it does not write, so a replayed batch rewrites its own
slot with the same content and the folder count stays fixed.

Answers per report (the Q4 list, the Q6 gap) depend on the order of the
reports, and a report may come late.  With L the allowed lateness, the
*frontier* is the newest event time seen minus L.  A report behind the frontier
of the earlier batches goes to the late output; the others wait until the
frontier has passed them and are then answered in event-time order.  So an
answer once given cannot be made wrong by a report within L, and the state is
the reports of the last L plus the little the answers need from before.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.carry import ordered_buckets, rows_before, with_oldest_of_last
from ..operators.filters import active, delayed, trains
from ..operators.gaps import gap_text
from ..operators.latest import last_stop_changes, latest_per_key
from ..operators.recent import newest_distinct, recent_lists
from ..operators.rolling import top_after_each
from ..operators.topk import top_k
from ..schema import LAST_N, LATENESS_MS, TOP_N, TRAILING_MS
from ..session import path_exists

SLOTS = 2


def write_state(df: DataFrame, base: str, batch_id: int) -> None:
    """Store a state of ``batch_id`` in its slot."""
    out = df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    out.write.mode("overwrite").parquet(f"{base}/slot={batch_id % SLOTS}")


def previous_snapshot(spark: SparkSession, base: str, batch_id: int) -> DataFrame | None:
    """The state of the batch before ``batch_id``; None for the first batch only.
    Micro-batch ids run consecutively and every batch writes a state, so it sits
    in the other slot; a slot that is missing, cannot be read or holds the state
    of another batch fails the batch."""
    if batch_id <= 0:
        return None
    slot = f"{base}/slot={(batch_id - 1) % SLOTS}"
    if not path_exists(spark, slot):
        raise FileNotFoundError(f"the state of batch {batch_id - 1} is missing: {slot}")
    state = spark.read.parquet(slot)
    held = [r["batch_id"] for r in state.select("batch_id").distinct().take(2)]
    # a state without rows names no batch
    if held and held != [batch_id - 1]:
        raise RuntimeError(f"{slot} holds the state of batch {held}, not of {batch_id - 1}")
    return state.drop("batch_id")


def latest_state(spark: SparkSession, base: str) -> DataFrame:
    """The newest state (for reading a result after the stream)."""
    snaps = spark.read.parquet(base)
    newest = snaps.select(F.max("batch_id")).scalar()
    return snaps.where(F.col("batch_id") == newest).drop("batch_id", "slot")


def latest_writer(
    base: str,
    rows_of: Callable[[DataFrame], DataFrame],
    cols: Sequence[str],
    key: str = "id",
    tie: str = "first",
    sink: Callable[[DataFrame, int], None] | None = None,
):
    """``foreachBatch`` function that keeps the newest report per ``key`` seen so
    far, ``(key, cols..., seq)``; ``sink`` gets the state after each micro-batch.
    A micro-batch is reduced to a row per key before it meets the state."""
    kept = list(dict.fromkeys([*cols, "lastupdate", "seq"]))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mine = rows_of(batch).select(key, *kept)
        prev = previous_snapshot(spark, base, batch_id)
        if prev is not None:
            mine = mine.unionByName(prev.select(key, *kept))
        write_state(latest_per_key(mine, key, kept, tie), base, batch_id)
        if sink is not None:
            sink(spark.read.parquet(f"{base}/slot={batch_id % SLOTS}").drop("batch_id"), batch_id)

    return write


def last_n_buffer_writer(base: str, n: int = LAST_N):
    """``foreachBatch`` function over raw report rows: keeps the ``n`` newest
    active report times seen so far as ``(rank, seq, lastupdate)``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        order = (F.col("lastupdate").desc(), F.col("seq").desc())
        mine = top_k(active(batch).select("seq", "lastupdate"), n, order).drop("rank")
        prev = previous_snapshot(batch.sparkSession, base, batch_id)
        if prev is not None:
            mine = mine.unionByName(prev.select("seq", "lastupdate"))
        write_state(top_k(mine, n, order).select("rank", "seq", "lastupdate"), base, batch_id)

    return write


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """A batch's own rows; a replay overwrites them, an empty batch leaves
    no folder."""
    df = df.persist()  # looked at and written
    try:
        if not df.isEmpty():
            df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    finally:
        df.unpersist()


def read_batches(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """What ``write_batch`` has written below ``path``; no rows when no batch had any."""
    empty = spark.createDataFrame([], schema)
    if not path_exists(spark, path):
        return empty
    return spark.read.schema(empty.schema).parquet(path).select(empty.columns)


#: a bucket of a micro-batch holds about so many reports
BUCKET_ROWS = 40_000


def buckets_for(df: DataFrame) -> int:
    """Buckets of a micro-batch: few for few reports, and as many as the session
    has shuffle partitions for many."""
    most = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(most, df.count() // BUCKET_ROWS + 1))


def newest_time(df: DataFrame) -> int | None:
    return df.agg(F.max("lastupdate")).first()[0]


def late_rows_writer(base: str, delay_ms: int = LATENESS_MS):
    """``foreachBatch`` function that sets aside the reports of a micro-batch
    lying more than ``delay_ms`` behind the newest event time of all earlier
    batches.  They go to ``base/late/batch_id=N``; the newest time seen is kept
    in ``base/clock``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # two passes over one micro-batch
        try:
            prev = previous_snapshot(batch.sparkSession, f"{base}/clock", batch_id)
            before = None if prev is None else newest_time(prev)
            now = newest_time(batch)
            if before is not None:
                write_batch(batch.where(F.col("lastupdate") < before - delay_ms), f"{base}/late", batch_id)
            newest = max((t for t in (before, now) if t is not None), default=None)
            clock = batch.sparkSession.createDataFrame([(newest,)], "lastupdate bigint")
            write_state(clock, f"{base}/clock", batch_id)
        finally:
            batch.unpersist()

    return write


def settled_writer(
    base: str,
    rows_of: Callable[[DataFrame], DataFrame],
    answer: Callable[[DataFrame, DataFrame | None, int], DataFrame],
    remember: Callable[[DataFrame, DataFrame | None], DataFrame],
    sink: Callable[[DataFrame, int], None],
    late: Callable[[DataFrame, int], None],
    lateness_ms: int = LATENESS_MS,
):
    """``foreachBatch`` function that answers reports in event-time order once
    the frontier has passed them.

    ``rows_of(batch)``: the rows that take part, with ``seq`` and ``lastupdate``;
    ``answer(rows, context, buckets)``: the answers of settled rows, worked off in
    so many buckets, which ``sink`` gets;
    ``remember(rows, context)``: the new context (a few rows); ``late`` gets the
    rows that came behind the frontier.  The state in ``base/state`` holds the
    context, the rows still waiting, and the newest time of all reports."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state_path = f"{base}/state"
        batch = batch.persist()
        try:
            prev = previous_snapshot(spark, state_path, batch_id)
            before = newest_time(prev.where("_kind = 'clock'")) if prev is not None else None
            now = newest_time(batch)
            newest = max((t for t in (before, now) if t is not None), default=None)
            rows = rows_of(batch)
            context = waiting = None
            if prev is not None:
                context = prev.where("_kind = 'context'").select(rows.columns)
                waiting = prev.where("_kind = 'waiting'").select(rows.columns)
            if before is not None:
                behind = F.col("lastupdate") < before - lateness_ms
                late(rows.where(behind), batch_id)
                rows = rows.where(~behind)
            if waiting is not None:
                rows = waiting.unionByName(rows)
            if newest is None:
                settled, rest = rows.limit(0), rows
            else:
                settled, rest = (rows.where(F.col("lastupdate") < newest - lateness_ms), rows.where(F.col("lastupdate") >= newest - lateness_ms))
            settled = settled.persist()
            sink(answer(settled, context, buckets_for(settled)), batch_id)
            clock = spark.createDataFrame([(newest,)], "lastupdate bigint").withColumn("_kind", F.lit("clock"))
            state = remember(settled, context).select(rows.columns).withColumn("_kind", F.lit("context"))
            state = state.unionByName(rest.withColumn("_kind", F.lit("waiting"))).unionByName(clock, allowMissingColumns=True)
            write_state(state, state_path, batch_id)
            settled.unpersist()
        finally:
            batch.unpersist()

    return write


def recent_changes_writer(
    base: str,
    window_ms: int = TRAILING_MS,
    k: int = TOP_N,
    lateness_ms: int = LATENESS_MS,
    sink: Callable[[DataFrame, int], None] | None = None,
    only_changes: bool = True,
):
    """The trailing-window list after every delayed report, emitted only when it
    changed, to ``base/changes/batch_id=N`` (or ``sink``); late reports go to
    ``base/late``.  The context is the newest ``k`` distinct delayed vehicles as
    of the last settled report."""

    def answer(rows: DataFrame, context: DataFrame | None, buckets: int) -> DataFrame:
        lists = recent_lists(rows, window_ms, k, buckets, context=context, scratch=f"{base}/scratch")
        return lists.where("changed").drop("changed") if only_changes else lists.drop("changed")

    def remember(rows: DataFrame, context: DataFrame | None) -> DataFrame:
        return newest_distinct(rows, k, context).withColumn("isinactive", F.lit("false"))

    return settled_writer(
        base,
        lambda batch: delayed(active(batch)).select("seq", "id", "delay", "lastupdate", "isinactive"),
        answer,
        remember,
        sink or (lambda df, i: write_batch(df, f"{base}/changes", i)),
        lambda df, i: write_batch(df, f"{base}/late", i),
        lateness_ms,
    )


def top_changes_writer(
    base: str, k: int = TOP_N, lateness_ms: int = LATENESS_MS, sink: Callable[[DataFrame, int], None] | None = None
):
    """The top-``k`` delayed list after every active report, when it changed, as
    ``(seq, rank, id, delay, lastupdate)`` to ``base/changes/batch_id=N`` (or
    ``sink``); late reports go to ``base/late``.  The context is the newest
    settled report of each vehicle that is delayed: one below the list may come
    up again when another one falls."""

    def answer(rows: DataFrame, context: DataFrame | None, buckets: int) -> DataFrame:
        return top_after_each(rows, k, buckets, context, f"{base}/scratch", only_changes=True).drop("changed")

    def remember(rows: DataFrame, context: DataFrame | None) -> DataFrame:
        both = rows if context is None else rows.unionByName(context)
        newest = latest_per_key(both, "id", ["seq", "delay", "lastupdate"], tie="first")
        return delayed(newest).withColumn("isinactive", F.lit("false"))

    return settled_writer(
        base,
        lambda batch: active(batch).select("seq", "id", "delay", "lastupdate", "isinactive"),
        answer,
        remember,
        sink or (lambda df, i: write_batch(df, f"{base}/changes", i)),
        lambda df, i: write_batch(df, f"{base}/late", i),
        lateness_ms,
    )


def last_stop_changes_writer(base: str, sink: Callable[[DataFrame, int], None] | None = None):
    """Every report that replaced what was known of its train, in the order of
    arrival, to ``base/changes/batch_id=N`` (or ``sink``); the state in
    ``base/state`` is the newest report per train."""

    def write(batch: DataFrame, batch_id: int) -> None:
        prev = previous_snapshot(batch.sparkSession, f"{base}/state", batch_id)
        mine = trains(active(batch)).select("seq", "id", "laststopid", "lastupdate", "ltype", "isinactive").persist()
        try:
            known = None if prev is None else prev.select("id", "lastupdate")
            changes = last_stop_changes(mine, buckets_for(mine), known, f"{base}/scratch")
            (sink or (lambda df, i: write_batch(df, f"{base}/changes", i)))(changes, batch_id)
            newest = mine.select("seq", "id", "lastupdate")
            if prev is not None:
                newest = newest.unionByName(prev.select("seq", "id", "lastupdate"))
            write_state(latest_per_key(newest, "id", ["seq", "lastupdate"], tie="first"), f"{base}/state", batch_id)
        finally:
            mine.unpersist()

    return write


def gap_text_writer(
    base: str, n: int = LAST_N, lateness_ms: int = LATENESS_MS, sink: Callable[[DataFrame, int], None] | None = None
):
    """The fleet-wide mean gap over the last ``n`` reports after every active
    report, as ``(seq, lastupdate, gap_text)`` to ``base/gaps/batch_id=N`` (or ``sink``).
    The context is the last ``n - 1`` settled reports."""

    def answer(rows: DataFrame, context: DataFrame | None, buckets: int) -> DataFrame:
        both = rows.withColumn("_new", F.lit(True))
        if context is not None:
            both = both.unionByName(context.withColumn("_new", F.lit(False)))
        frames = with_oldest_of_last(both, n, buckets=buckets, scratch=f"{base}/scratch").where("_new")
        return gap_text(frames, "lastupdate")

    def remember(rows: DataFrame, context: DataFrame | None) -> DataFrame:
        both = rows if context is None else rows.unionByName(context)
        return top_k(both, n - 1, (F.col("lastupdate").desc(), F.col("seq").desc()))

    return settled_writer(
        base,
        lambda batch: active(batch).select("seq", "lastupdate"),
        answer,
        remember,
        sink or (lambda df, i: write_batch(df, f"{base}/gaps", i)),
        lambda df, i: write_batch(df, f"{base}/late", i),
        lateness_ms,
    )


def last_n_per_vehicle_writer(base: str, n: int = LAST_N, sink: Callable[[DataFrame, int], None] | None = None):
    """The mean gap over a vehicle's ``n`` newest reports that have arrived so
    far, after every active report that is among them, as ``state.GAP_SCHEMA``
    to ``base/gaps/batch_id=N`` (or ``sink``).  The reports of a micro-batch count
    in event-time order; the state in ``base/state`` is the ``n`` newest reports
    of each vehicle.

    A micro-batch is worked off in buckets of equal counts (``operators.carry``),
    so neither a busy vehicle nor a large micro-batch is held by one task."""
    newest_first = (F.col("lastupdate").desc(), F.col("seq").desc())

    def write(batch: DataFrame, batch_id: int) -> None:
        state_path = f"{base}/state"
        batch = active(batch).select("id", "seq", "lastupdate").persist()  # counted and ordered
        try:
            rows = ordered_buckets(batch, ["id", "lastupdate", "seq"], buckets_for(batch), f"{base}/scratch")
        finally:
            batch.unpersist()
        before = rows_before(rows, n - 1, ["id"], "lastupdate", "seq").withColumn("_own", F.lit(False))
        both = rows.withColumn("_own", F.lit(True)).unionByName(before)
        last = Window.partitionBy("_b", "id").orderBy("lastupdate", "seq").rowsBetween(1 - n, 0)
        report = F.struct("lastupdate", "seq")
        both = both.withColumn("_last", F.collect_list(report).over(last)).where("_own")
        prev = previous_snapshot(batch.sparkSession, state_path, batch_id)
        mine = rows.select("id", "seq", "lastupdate")
        if prev is not None:
            # a vehicle's older reports go to each of its buckets once
            old = prev.groupBy("id").agg(F.collect_list(report).alias("_old")).withColumnRenamed("id", "_id")
            old = rows.select("id", "_b").distinct().join(old, F.col("id").eqNullSafe(F.col("_id")))
            old = old.select("_id", F.col("_b").alias("_ob"), "_old")
            both = both.join(old, (F.col("_b") == F.col("_ob")) & F.col("id").eqNullSafe(F.col("_id")), "left")
            both = both.withColumn("_last", F.concat("_last", F.coalesce("_old", F.array().cast(both.schema["_last"].dataType))))
            mine = mine.unionByName(prev.select("id", "seq", "lastupdate"))
        both = both.withColumn("_last", F.slice(F.sort_array("_last", asc=False), 1, n))
        both = both.where((F.size("_last") > 1) & (F.element_at("_last", -1) <= report))
        both = both.select(
            "id",
            "seq",
            "lastupdate",
            F.size("_last").cast("bigint").alias("n"),
            (F.element_at("_last", 1)["lastupdate"] - F.element_at("_last", -1)["lastupdate"]).alias("span_ms"),
        )
        gaps = both.withColumn("gap_ms", F.col("span_ms") / (F.col("n") - 1))
        (sink or (lambda df, i: write_batch(df, f"{base}/gaps", i)))(gaps, batch_id)
        write_state(top_k(mine, n, newest_first, by=["id"]).drop("rank"), state_path, batch_id)

    return write
