"""Named queries over the test tables: ``name -> f(spark, sf_dir) -> DataFrame``.

Each one reads ``events`` through the report adapter, so its work grows with
the table.  Text-level keys (scan, tokenize, parse) go through the JSON text a
landing directory would hold; the others read the columns directly so that
Parquet pruning and filter pushdown reach the scan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import filters, gaps, latest, recent, rolling, topk, windows
from .. import streaming
from ..schema import REPORT_COLUMNS, SLIDE_10MIN_MS, TRAILING_6H_MS, TRAIN_HEADER
from ..session import fresh_path
from ..sources import (
    corrupt_reports,
    load_table,
    parse_reports,
    read_report_lines,
    report_lines_from_events,
    reports_from_events,
    tokenize_lines,
)
from ..sources.landing import report_source
from ..sources.text import ARRIVAL_PLACES
from ..sources.replay import JITTER_MS, land_text, stream_events

Query = Callable[[SparkSession, str], DataFrame]

# Rule that damages landing lines for the corrupt-input query: the text of
# every report whose event value exceeds 200 (about 1.7 % of them) is cut in half.
DAMAGE_ABOVE_VALUE = 200.0
TIMELINE_TICK_MS = 3600 * 1000


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "events")


def _reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports_from_events(_events(spark, sf_dir))


def _active(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active reports only; the operators' own test on them stays as it is."""
    return reports_from_events(_events(spark, sf_dir), active_only=True)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_lines_from_events(_events(spark, sf_dir))


def q_scan_reports(spark, sf_dir):
    return _lines(spark, sf_dir)


def q_tokenize_lines(spark, sf_dir):
    return tokenize_lines(_lines(spark, sf_dir))


def q_parse_reports(spark, sf_dir):
    return parse_reports(_lines(spark, sf_dir))


def q_corrupt_reports(spark, sf_dir):
    lines = report_lines_from_events(_events(spark, sf_dir), carry=("value",))
    damaged = lines.select(
        "seq",
        F.when(F.col("_src_value") > DAMAGE_ABOVE_VALUE, F.expr("substring(value, 1, length(value) div 2)"))
        .otherwise(F.col("value"))
        .alias("value"),
    )
    return corrupt_reports(damaged)


def q_reports_as_json(spark, sf_dir):
    r = _reports(spark, sf_dir)
    return r.select("seq", F.to_json(F.struct(*REPORT_COLUMNS)).alias("json"))


def q_active_reports(spark, sf_dir):
    return filters.active(_active(spark, sf_dir))


def q_train_reports(spark, sf_dir):
    return filters.trains(filters.active(_active(spark, sf_dir)))


def q_delayed_reports(spark, sf_dir):
    return filters.delayed(filters.active(_active(spark, sf_dir)))


def q_north_bearing(spark, sf_dir):
    return filters.north(filters.active(_active(spark, sf_dir)))


def q_north_json_lines(spark, sf_dir):
    return filters.north_lines(filters.active(_active(spark, sf_dir)))


def q_train_last_stop(spark, sf_dir):
    return latest.train_last_stop(_active(spark, sf_dir))


def q_train_last_stop_csv(spark, sf_dir):
    return latest.train_snapshot_lines(latest.train_last_stop(_active(spark, sf_dir)), TRAIN_HEADER)


def q_latest_delay_per_vehicle(spark, sf_dir):
    return topk.latest_delay_per_vehicle(_active(spark, sf_dir))


def q_top5_delayed(spark, sf_dir):
    return topk.top_delayed(_active(spark, sf_dir))


def q_top5_delayed_filter_first(spark, sf_dir):
    return topk.top_delayed(_active(spark, sf_dir), filter_first=True)


def q_top5_delayed_json(spark, sf_dir):
    return topk.top_list_json(topk.top_delayed(_active(spark, sf_dir)))


def q_top5_delayed_timeline(spark, sf_dir):
    return topk.top_delayed_timeline(_active(spark, sf_dir), TIMELINE_TICK_MS)


def q_top5_delayed_per_report(spark, sf_dir):
    return rolling.top_after_each(_active(spark, sf_dir)).drop("changed")


def q_top5_delayed_changes(spark, sf_dir):
    return rolling.top_after_each(_active(spark, sf_dir)).where("changed").drop("changed")


def _arrived(reports):
    """Reports numbered as the replay delivers them: by event time plus delay."""
    delay = F.conv(F.substring(F.md5(F.col("seq").cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint") % JITTER_MS
    return reports.withColumn("seq", (F.col("lastupdate") + delay) * ARRIVAL_PLACES + F.col("seq") % ARRIVAL_PLACES)


def q_train_last_stop_changes(spark, sf_dir):
    return latest.last_stop_changes(_arrived(_active(spark, sf_dir)))


def q_avg_delay_vehicles(spark, sf_dir):
    return windows.sliding_vehicle_average(_active(spark, sf_dir))


def q_avg_delay_vehicles_6h(spark, sf_dir):
    return windows.sliding_vehicle_average(_active(spark, sf_dir), size_ms=TRAILING_6H_MS, slide_ms=SLIDE_10MIN_MS)


def q_avg_delay_stored_panes(spark, sf_dir):
    """Two halves of the reports stored as panes, and merged."""
    out = fresh_path(spark, "panes")
    r = _active(spark, sf_dir)
    for half in (0, 1):
        windows.store_panes(r.where(F.col("seq") % 2 == half), out, str(half), slide_ms=SLIDE_10MIN_MS)
    return windows.average_of_panes(windows.stored_panes(spark, out), TRAILING_6H_MS, SLIDE_10MIN_MS)


def q_avg_delay_total(spark, sf_dir):
    return windows.total_average(_active(spark, sf_dir))


def q_avg_delay_sliding(spark, sf_dir):
    return windows.sliding_average(_active(spark, sf_dir))


def q_avg_delay_sliding_6h(spark, sf_dir):
    return windows.sliding_average(_active(spark, sf_dir), size_ms=TRAILING_6H_MS, slide_ms=SLIDE_10MIN_MS)


def q_window_report_count(spark, sf_dir):
    return windows.window_counts(_active(spark, sf_dir))


def q_window_report_count_6h(spark, sf_dir):
    return windows.window_counts(_active(spark, sf_dir), size_ms=TRAILING_6H_MS, slide_ms=SLIDE_10MIN_MS)


def q_recent5_final(spark, sf_dir):
    return recent.recent_final(_active(spark, sf_dir))


def q_recent5_final_6h(spark, sf_dir):
    return recent.recent_final(_active(spark, sf_dir), TRAILING_6H_MS)


def q_recent5_timeline(spark, sf_dir):
    return recent.recent_timeline(_active(spark, sf_dir))


def q_recent5_timeline_6h(spark, sf_dir):
    return recent.recent_timeline(_active(spark, sf_dir), TRAILING_6H_MS)


def q_recent5_changes(spark, sf_dir):
    return recent.recent_changes(_active(spark, sf_dir))


def q_recent5_changes_6h(spark, sf_dir):
    return recent.recent_changes(_active(spark, sf_dir), TRAILING_6H_MS)


def q_recent5_iso(spark, sf_dir):
    return recent.recent_changes_iso(_active(spark, sf_dir))


def q_recent5_iso_6h(spark, sf_dir):
    return recent.recent_changes_iso(_active(spark, sf_dir), TRAILING_6H_MS)


def q_last10_buffer(spark, sf_dir):
    return gaps.last_n_buffer(_active(spark, sf_dir))


def q_last10_gap_final(spark, sf_dir):
    return gaps.gap_final(_active(spark, sf_dir))


def q_last10_deltas(spark, sf_dir):
    return gaps.buffer_deltas(_active(spark, sf_dir))


def q_last10_gap_timeline(spark, sf_dir):
    return gaps.gap_timeline(_active(spark, sf_dir))


def q_last10_gap_per_vehicle(spark, sf_dir):
    return gaps.gap_per_vehicle(_active(spark, sf_dir))


def q_last10_gap_text(spark, sf_dir):
    return gaps.gap_text_timeline(_active(spark, sf_dir))


# --- streaming twins: run to completion (availableNow), read the sink back ---


#: lateness of the streamed answers over ``events``: as far as the replay is
#: out of order; the late-row key allows less, so that it has rows
REPLAY_LATENESS_MS = JITTER_MS
LATE_KEY_LATENESS_MS = 12 * 3600 * 1000
COARSE_VEHICLES = 7


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streaming.report_stream_from_events(spark, sf_dir)


def _placed(reports: DataFrame) -> DataFrame:
    """What a list or a gap is made of: a micro-batch is kept while it is worked
    off, and holds no other column."""
    return reports.select("seq", "id", "delay", "lastupdate", "isinactive")


def _coarse(reports: DataFrame) -> DataFrame:
    """Few vehicles and one delay, so that neighbouring lists repeat."""
    vehicle = F.concat(F.lit("v"), F.pmod(F.col("id").cast("bigint"), F.lit(COARSE_VEHICLES)).cast("string"))
    return reports.withColumn("id", vehicle).withColumn("delay", F.signum("delay"))


def q_recent5_coarse_timeline(spark, sf_dir):
    return recent.recent_timeline(_coarse(_active(spark, sf_dir)), TRAILING_6H_MS)


def q_recent5_coarse_changes(spark, sf_dir):
    return recent.recent_changes(_coarse(_active(spark, sf_dir)), TRAILING_6H_MS)


def q_stream_scan_reports(spark, sf_dir):
    lines = report_lines_from_events(stream_events(spark, sf_dir))
    return streaming.run_append(parse_reports(lines), "stream_scan_reports")


def q_stream_north_bearing(spark, sf_dir):
    return streaming.run_append(streaming.north_stream(_stream(spark, sf_dir)), "stream_north")


def q_stream_train_last_stop(spark, sf_dir):
    s = latest.train_last_stop(_stream(spark, sf_dir))
    return streaming.run_snapshots(s, "stream_train_last_stop", lambda b: b, mode="complete")


def q_stream_top5_delayed(spark, sf_dir):
    per_vehicle = topk.latest_delay_per_vehicle(_stream(spark, sf_dir))

    def snapshot(state):
        return topk.top_k(filters.delayed(state), 5, topk.delay_order()).select("rank", "id", "delay", "lastupdate")

    return streaming.run_snapshots(per_vehicle, "stream_top5_delayed", snapshot, mode="complete")


def q_stream_avg_delay_sliding(spark, sf_dir):
    s = streaming.sliding_average_stream(_stream(spark, sf_dir), watermark=f"{REPLAY_LATENESS_MS // 1000} seconds")
    return streaming.run_append(s, "stream_avg_delay_sliding")


def q_stream_avg_delay_ptime(spark, sf_dir):
    """What the processing-time windows hold whatever the clock says: every
    report is in 36 windows of 180 seconds."""
    s = streaming.sliding_average_processing_time(_stream(spark, sf_dir))
    w = streaming.run_snapshots(s, "stream_avg_delay_ptime", lambda b: b, mode="update", key=["window_start"])
    seconds = F.col("window_end").cast("long") - F.col("window_start").cast("long")
    return w.agg(F.sum("n").alias("reports_in_windows"), F.min(seconds).alias("shortest_s"), F.max(seconds).alias("longest_s"))


def q_stream_last10_per_vehicle(spark, sf_dir):
    out = fresh_path(spark, "stream_last10_per_vehicle-out")
    streaming.run_foreach(_placed(_stream(spark, sf_dir)), "stream_last10_per_vehicle", streaming.last_n_per_vehicle_writer(out))
    return streaming.read_batches(spark, f"{out}/gaps", streaming.state.GAP_SCHEMA)


def q_stream_last10_listed(spark, sf_dir):
    """The same over a list state per vehicle."""
    with streaming.keyed_state(spark):
        return streaming.run_append(streaming.last_n_per_vehicle_listed(_stream(spark, sf_dir)), "stream_last10_listed")


def q_stream_recent5(spark, sf_dir):
    d = filters.delayed(filters.active(_stream(spark, sf_dir)))
    per_vehicle = latest.latest_per_key(d, "id", ["delay", "lastupdate", "seq"], tie="last")

    def snapshot(state):
        state = state.persist()  # used for the newest time and for the list
        state.count()
        return recent.recent_final_from_latest(state)

    return streaming.run_snapshots(per_vehicle, "stream_recent5", snapshot, mode="complete")


def _recent_stream(spark, reports, name, **options):
    out = fresh_path(spark, f"{name}-out")
    writer = streaming.recent_changes_writer(out, **{"lateness_ms": REPLAY_LATENESS_MS, **options})
    streaming.run_foreach(reports, name, writer)
    columns = [f for f in recent.LIST_SCHEMA.fields if f.name != "changed"]
    return streaming.read_batches(spark, f"{out}/changes", StructType(columns))


def q_stream_recent5_changes(spark, sf_dir):
    return _recent_stream(spark, _placed(_stream(spark, sf_dir)), "stream_recent5_changes")


def q_stream_recent5_coarse_changes(spark, sf_dir):
    return _recent_stream(spark, _coarse(_placed(_stream(spark, sf_dir))), "stream_recent5_coarse", window_ms=TRAILING_6H_MS)


def q_stream_top5_delayed_changes(spark, sf_dir):
    out = fresh_path(spark, "stream_top5_changes-out")
    streaming.run_foreach(_placed(_stream(spark, sf_dir)), "stream_top5_changes", streaming.top_changes_writer(out, lateness_ms=REPLAY_LATENESS_MS))
    return streaming.read_batches(spark, f"{out}/changes", "seq bigint, rank int, id string, delay double, lastupdate bigint")


def q_stream_train_last_stop_changes(spark, sf_dir):
    out = fresh_path(spark, "stream_train_changes-out")
    streaming.run_foreach(_arrived(_stream(spark, sf_dir)), "stream_train_changes", streaming.last_stop_changes_writer(out))
    return streaming.read_batches(spark, f"{out}/changes", "seq bigint, id string, last_stop string, last_update bigint")


def q_stream_last10_buffer(spark, sf_dir):
    out = fresh_path(spark, "stream_last10_buffer-out")
    streaming.run_foreach(_stream(spark, sf_dir), "stream_last10_buffer", streaming.last_n_buffer_writer(out))
    return streaming.merges.latest_state(spark, out)


def q_stream_last10_gap_text(spark, sf_dir):
    out = fresh_path(spark, "stream_last10_gap_text-out")
    streaming.run_foreach(_placed(_stream(spark, sf_dir)), "stream_last10_gap_text", streaming.gap_text_writer(out, lateness_ms=REPLAY_LATENESS_MS))
    return streaming.read_batches(spark, f"{out}/gaps", "seq bigint, gap_text string")


def q_stream_late_rows(spark, sf_dir):
    out = fresh_path(spark, "stream_late_rows-out")
    s = _stream(spark, sf_dir).select("seq", "id", "lastupdate")
    streaming.run_foreach(s, "stream_late_rows", streaming.late_rows_writer(out, LATE_KEY_LATENESS_MS))
    return streaming.read_batches(spark, f"{out}/late", "seq bigint, id string, lastupdate bigint")


# --- text files: write the landing directory, read it back as text ---


def _landing_text(spark, sf_dir):
    """Folder of text files with one JSON document per line, and ``documents``
    texts beside them: what a landing directory holds."""
    out = fresh_path(spark, "landing-text")
    _lines(spark, sf_dir).select("value").write.text(out)
    return out


def q_text_scan_reports(spark, sf_dir):
    return parse_reports(read_report_lines(spark, _landing_text(spark, sf_dir))).drop("seq")


def q_text_stream_scan_reports(spark, sf_dir):
    lines = read_report_lines(spark, _landing_text(spark, sf_dir), stream=True, max_files_per_trigger=1)
    return streaming.run_append(parse_reports(lines).drop("seq", "arrival"), "text_stream_scan_reports")


# two documents a line, two files at a time, many reports of one time: what
# comes first is known by the order of arrival only

#: shuffled pairs lie within 128 events, less than six days of the smallest table
TEXT_LATENESS_MS = 6 * 24 * 3600 * 1000


def q_text_arrival_order(spark, sf_dir):
    return report_source(spark, land_text(spark, sf_dir)).select("seq", "id", "lastupdate", "laststopid")


def q_text_train_last_stop(spark, sf_dir):
    return latest.train_last_stop(report_source(spark, land_text(spark, sf_dir)))


def q_text_top5_delayed(spark, sf_dir):
    return topk.top_delayed(report_source(spark, land_text(spark, sf_dir)))


def q_text_recent5_changes(spark, sf_dir):
    return recent.recent_changes(report_source(spark, land_text(spark, sf_dir)), TRAILING_6H_MS)


def _text_stream(spark, sf_dir):
    return streaming.report_stream_from_text(spark, land_text(spark, sf_dir), max_files_per_trigger=2)


def _text_latest(spark, sf_dir, name, rows, cols):
    out = fresh_path(spark, f"{name}-out")
    streaming.run_foreach(_text_stream(spark, sf_dir), name, streaming.latest_writer(out, rows, cols))
    return streaming.merges.latest_state(spark, out)


def q_text_stream_train_last_stop(spark, sf_dir):
    state = _text_latest(spark, sf_dir, "text_stream_train", lambda b: filters.trains(filters.active(b)), latest.LAST_STOP)
    return latest.as_last_stop(state)


def q_text_stream_top5_delayed(spark, sf_dir):
    state = _text_latest(spark, sf_dir, "text_stream_top5", filters.active, ("delay", "lastupdate"))
    return topk.top_k(filters.delayed(state), 5, topk.delay_order()).select("rank", "id", "delay", "lastupdate")


def q_text_stream_recent5_changes(spark, sf_dir):
    lists = _recent_stream(spark, _text_stream(spark, sf_dir), "text_stream_recent5", window_ms=TRAILING_6H_MS, lateness_ms=TEXT_LATENESS_MS)
    return lists.drop("seq")


def q_text_tokens(spark, sf_dir):
    """Occurrences of every white-space token of the ``documents`` texts, read
    from text files."""
    out = fresh_path(spark, "landing-documents")
    load_table(spark, sf_dir, "documents").select(F.col("text").alias("value")).write.text(out)
    tokens = tokenize_lines(read_report_lines(spark, out))
    return tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def queries() -> dict[str, Query]:
    return {name[2:]: fn for name, fn in globals().items() if name.startswith("q_") and callable(fn)}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_north_bearing(spark, sf_dir)
