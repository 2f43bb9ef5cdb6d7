import json
import os
import random
import shutil

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import report
from transitlens import streaming
from transitlens.operators import filters, gaps, latest, recent, topk
from transitlens.sources import parse_reports, read_report_lines
from transitlens.streaming.merges import latest_state, previous_snapshot, write_state
from transitlens.streaming.runner import run_append, run_foreach, run_snapshots
from transitlens.streaming.state import last_n_per_vehicle_stream


def _docs(n=60):
    # 6 vehicles, times increasing, a train among them
    return [report(f"v{i % 6}", 1_000_000 + 7_000 * i, bearing=(i * 37) % 361, delay=(i * 13) % 50 - 20,
                   ltype=5 if i % 6 == 0 else 3, stop=f"s{i}") for i in range(n)]


def _chunks(docs, k):
    return [docs[i: i + k] for i in range(0, len(docs), k)]


def test_north_stream_equals_batch_over_many_files(spark, landing, tmp_path):
    docs = _docs()
    path = landing(_chunks(docs, 7))
    batch = sorted(map(tuple, filters.north(filters.active(parse_reports(read_report_lines(spark, path)))).collect()))
    s = streaming.north_stream(streaming.report_stream_from_text(spark, path, max_files_per_trigger=1))
    got = sorted(map(tuple, run_append(s, "t-north").collect()))
    assert got == batch and len(got) > 0


def test_aggregate_stream_equals_batch(spark, landing):
    docs = _docs()
    path = landing(_chunks(docs, 11))
    batch = sorted(map(tuple, latest.train_last_stop(parse_reports(read_report_lines(spark, path))).collect()))
    s = latest.train_last_stop(streaming.report_stream_from_text(spark, path, max_files_per_trigger=2))
    got = sorted(map(tuple, run_snapshots(s, "t-train", lambda b: b).collect()))
    assert got == batch


def test_top5_stream_snapshot(spark, landing):
    path = landing(_chunks(_docs(), 10))
    reports = parse_reports(read_report_lines(spark, path))
    batch = [tuple(r) for r in topk.top_delayed(reports).orderBy("rank").collect()]
    per_vehicle = topk.latest_delay_per_vehicle(streaming.report_stream_from_text(spark, path, max_files_per_trigger=1))

    def snap(state):
        return topk.top_k(filters.delayed(state), 5, topk.delay_order()).select("rank", "id", "delay", "lastupdate")

    got = [tuple(r) for r in run_snapshots(per_vehicle, "t-top", snap).orderBy("rank").collect()]
    assert got == batch


def test_restart_from_checkpoint_gives_same_result(spark, landing, tmp_path):
    docs = _docs(80)
    chunks = _chunks(docs, 10)
    src = landing(chunks[:4], name="restart-src")
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    s = last_n_per_vehicle_stream(streaming.report_stream_from_text(spark, src, max_files_per_trigger=1))
    run_append(s, "t-restart", out=out, checkpoint=ck)
    for i, c in enumerate(chunks[4:], start=4):  # more files land while the query is down
        name = os.path.join(src, f"part-{i:04d}.json")
        with open(name, "w") as f:
            f.write("\n".join(c) + "\n")
        os.utime(name, (1_700_000_000 + i, 1_700_000_000 + i))
    s = last_n_per_vehicle_stream(streaming.report_stream_from_text(spark, src, max_files_per_trigger=1))
    resumed = run_append(s, "t-restart", out=out, checkpoint=ck)
    once = str(tmp_path / "once")
    shutil.copytree(src, once)
    s = last_n_per_vehicle_stream(streaming.report_stream_from_text(spark, once, max_files_per_trigger=1))
    fresh = run_append(s, "t-once")
    cols = ["id", "lastupdate", "n", "span_ms"]
    assert sorted(map(tuple, resumed.select(cols).collect())) == sorted(map(tuple, fresh.select(cols).collect()))
    assert resumed.count() == 80 - 6


def test_watermark_drops_late_rows_and_closes_windows(spark, landing):
    on_time = [report("a", 1_000_000 + 60_000 * i, delay=1) for i in range(10)]
    more = [report("a", 1_000_000 + 60_000 * 10, delay=1)]
    late = [report("b", 1_000_000, delay=100)]  # 10 minutes behind
    # Spark drops a row behind the watermark of the *previous* micro-batch,
    # so the late row comes two batches after time has moved on
    path = landing([on_time, more, late])
    s = streaming.sliding_average_stream(streaming.report_stream_from_text(spark, path, max_files_per_trigger=1))
    rows = run_append(s, "t-late").collect()
    assert rows and all(r.avg_delay == 1.0 for r in rows)
    newest = 1_000_000 + 60_000 * 10
    assert max(r.window_end_ms for r in rows) <= newest - 10_000


def test_state_slots(spark, tmp_path):
    base = str(tmp_path / "state")
    assert previous_snapshot(spark, base, 0) is None
    with pytest.raises(FileNotFoundError):  # batch 0 wrote a state, which is lost
        previous_snapshot(spark, base, 1)
    for i in range(3):
        write_state(spark.range(i + 3), base, i)
    assert latest_state(spark, base).count() == 5
    assert previous_snapshot(spark, base, 3).count() == 5
    with pytest.raises(RuntimeError, match="holds the state of batch"):
        previous_snapshot(spark, base, 5)


def test_the_replay_is_out_of_order(spark):
    from conftest import SF_ORACLE
    from pyspark.sql import functions as F
    from pyspark.sql.window import Window
    from transitlens.sources.replay import LANDED_MS, land_events

    rows = spark.read.option("recursiveFileLookup", "true").parquet(land_events(spark, SF_ORACLE))
    rows = rows.select("ts", F.unix_millis("_metadata.file_modification_time").alias("landed"))
    newest = rows.groupBy("landed").agg(F.max("ts").alias("newest"))
    before = newest.select(F.col("landed").alias("l"), F.max("newest").over(Window.orderBy("landed").rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    behind = rows.join(before, F.col("landed") == F.col("l")).where("ts < before").count()
    assert behind >= 0.01 * rows.count() and rows.agg(F.min("landed")).first()[0] == LANDED_MS


def test_latest_state_follows_the_order_of_arrival(spark, landing, tmp_path):
    # one time for all: the first arrival wins, over lines, files and micro-batches
    docs = [report(f"T{i % 3}", 1000, stop=f"s{i}", ltype=5) for i in range(12)]
    path = landing([[f"{docs[0]} {docs[1]}", docs[2]], docs[3:7], docs[7:]])
    out = str(tmp_path / "latest")
    s = streaming.report_stream_from_text(spark, path, max_files_per_trigger=1)
    run_foreach(s, "t-latest", streaming.latest_writer(out, lambda b: b, latest.LAST_STOP))
    got = sorted(map(tuple, latest.as_last_stop(latest_state(spark, out)).collect()))
    assert got == [("T0", "s0", 1000), ("T1", "s1", 1000), ("T2", "s2", 1000)]


def test_unreadable_state_fails_loudly(spark, tmp_path):
    base = tmp_path / "broken"
    (base / "slot=0").mkdir(parents=True)
    (base / "slot=0" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="parquet|footer|schema|SCHEMA"):
        previous_snapshot(spark, str(base), 1).count()


def test_update_mode_keeps_untouched_keys(spark, landing):
    path = landing([[report("a", 1_000_000)], [report("b", 1_000_001)], [report("a", 1_000_002)]])
    r = streaming.report_stream_from_text(spark, path, max_files_per_trigger=1)
    counts = r.groupBy("id").count()
    got = run_snapshots(counts, "t-update", lambda b: b, mode="update", key=["id"]).collect()
    assert sorted(map(tuple, got)) == [("a", 2), ("b", 1)]


def test_fleet_buffer_merged_over_batches(spark, landing, tmp_path):
    from transitlens.operators.gaps import last_n_buffer
    from transitlens.streaming import last_n_buffer_writer, run_foreach

    docs = _docs(45)
    path = landing(_chunks(docs, 4))
    out = str(tmp_path / "buf")
    s = streaming.report_stream_from_text(spark, path, max_files_per_trigger=1)
    run_foreach(s, "t-buf", last_n_buffer_writer(out))
    assert sorted(os.listdir(out)) == ["slot=0", "slot=1"]  # bounded, not one folder per batch
    got = [r.lastupdate for r in latest_state(spark, out).orderBy("rank").collect()]
    want = [r.lastupdate for r in last_n_buffer(parse_reports(read_report_lines(spark, path))).orderBy("rank").collect()]
    assert got == want and len(got) == 10


def test_late_rows_are_set_aside(spark, landing, tmp_path):
    from transitlens.streaming import late_rows_writer, run_foreach

    first = [report("a", 1_000_000 + 1000 * i) for i in range(5)]
    second = [report("b", 1_003_500), report("c", 990_000), report("d", 1_010_000)]
    third = [report("e", 1_000_001)]
    path = landing([first, second, third])
    base = str(tmp_path / "late")
    s = streaming.report_stream_from_text(spark, path, max_files_per_trigger=1)
    run_foreach(s, "t-late-split", late_rows_writer(base, delay_ms=2000))
    late = sorted(r.id for r in spark.read.parquet(f"{base}/late").collect())
    # batch 2: newest before = 1_004_000, c (990_000) is late; b is within 2 s
    # batch 3: newest before = 1_010_000, e is late
    assert late == ["c", "e"]


def test_train_snapshot_file(spark, tmp_path):
    from helpers import frame
    from transitlens.sinks import write_train_snapshot

    rows = [{"seq": i, "id": f"T{i % 3}", "t": 100 + i, "stop": f"s{i}", "ltype": 5} for i in range(9)]
    path = str(tmp_path / "snap")
    write_train_snapshot(latest.train_last_stop(frame(spark, rows)), path)
    text = "".join(open(os.path.join(path, f)).read() for f in sorted(os.listdir(path)) if f.startswith("part-"))
    lines = text.strip().split("\n")
    assert lines[0] == "id,laststop,lastupdate"
    assert sorted(lines[1:]) == ["'T0','s6','106'", "'T1','s7','107'", "'T2','s8','108'"]


def test_pane_and_plain_streaming_windows_agree(spark, landing):
    docs = [report(f"v{i % 3}", 1_000_000 + 1700 * i, delay=i % 7) for i in range(120)]
    path = landing(_chunks(docs, 30))
    results = []
    for panes in (True, False):
        s = streaming.sliding_average_stream(streaming.report_stream_from_text(spark, path, max_files_per_trigger=1), panes=panes)
        results.append(sorted(map(tuple, run_append(s, f"t-panes-{panes}").collect())))
    assert results[0] == results[1] and results[0]


def _per_report(spark, landing, tmp_path, shuffle):
    """Reports of few vehicles in 7 files; with ``shuffle`` up to 40 s late."""
    docs = [(1_000_000 + 5_000 * i, report(f"v{(i // 2) % 6}", 1_000_000 + 5_000 * i, delay=1 + (i // 2) % 2)) for i in range(90)]
    if shuffle:
        r = random.Random(shuffle)
        docs.sort(key=lambda x: x[0] + r.randrange(40_000))
    path = landing(_chunks([d for _, d in docs], 13), name=f"late-{shuffle}")
    reports = parse_reports(read_report_lines(spark, path))
    s = streaming.report_stream_from_text(spark, path, max_files_per_trigger=1)
    return reports, s, str(tmp_path / f"out-{shuffle}"), 1_000_000 + 5_000 * 89 - 40_000


@pytest.mark.parametrize("shuffle", [0, 1, 2])
def test_recent_changes_stream_equals_batch_over_late_batches(spark, landing, tmp_path, shuffle):
    reports, s, base, until = _per_report(spark, landing, tmp_path, shuffle)
    run_foreach(s, "t-rc", streaming.recent_changes_writer(base, window_ms=120_000, lateness_ms=40_000))
    got = sorted(map(tuple, spark.read.parquet(f"{base}/changes").select("rank", "id", "delay", "lastupdate").collect()))
    lists = recent.recent_lists(reports, 120_000)
    settled = lists.join(reports.where(f"lastupdate < {until}").select("seq"), "seq")
    want = sorted(map(tuple, settled.where("changed").select("rank", "id", "delay", "lastupdate").collect()))
    assert got == want
    assert len(want) < settled.count()  # some lists did not change
    assert not os.path.exists(f"{base}/late")


@pytest.mark.parametrize("shuffle", [0, 3])
def test_gap_text_stream_equals_batch_over_late_batches(spark, landing, tmp_path, shuffle):
    reports, s, base, until = _per_report(spark, landing, tmp_path, shuffle)
    run_foreach(s, "t-gap", streaming.gap_text_writer(base, lateness_ms=40_000))
    got = sorted(r.gap_text for r in spark.read.parquet(f"{base}/gaps").collect())
    want = gaps.gap_text_timeline(reports).join(reports.where(f"lastupdate < {until}").select("seq"), "seq")
    assert got == sorted(r.gap_text for r in want.collect()) and got


def test_reports_behind_the_frontier_go_to_the_late_output(spark, landing, tmp_path):
    path = landing([[report(f"v{i}", 1_000_000 + 1000 * i, delay=1) for i in range(12)], [report("late", 1_000_000, delay=9)], [report("z", 1_100_000, delay=1)]])
    base = str(tmp_path / "behind")
    s = streaming.report_stream_from_text(spark, path, max_files_per_trigger=1)
    run_foreach(s, "t-behind", streaming.recent_changes_writer(base, lateness_ms=2000))
    assert [r.id for r in spark.read.parquet(f"{base}/late").collect()] == ["late"]
    lists = spark.read.parquet(f"{base}/changes")
    assert lists.where("id = 'late'").isEmpty()
    # a report of the second batch sees the vehicles of the first
    assert lists.groupBy("seq").count().agg({"count": "max"}).first()[0] == 5


@pytest.mark.parametrize("keyed", [False, True])
def test_busy_vehicle_beyond_one_arrow_batch(spark, landing, tmp_path, keyed):
    """Within a micro-batch the event time decides, whatever the Arrow batches."""
    r = random.Random(4)
    files = []
    for k in range(3):
        times = [("a", 1_000_000 + 150_000 * k + 1000 * i) for i in range(200)] + [("b", 1_000_000 + 150_000 * k + 70_000 * i) for i in range(4)]
        r.shuffle(times)
        files.append(times)
    path = landing([[report(v, t) for v, t in times] for times in files])
    want, buffers = [], {}
    for times in files:
        for v, t in sorted(times, key=lambda x: x[1]):
            buf = buffers.setdefault(v, [])
            if len(buf) == 10 and t < buf[0]:
                continue
            buffers[v] = buf = sorted([*buf, t])[-10:]
            if len(buf) > 1:
                want.append((v, t, len(buf), buf[-1] - buf[0]))
    name, before = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set(name, "7")
    try:
        s = streaming.report_stream_from_text(spark, path, max_files_per_trigger=1)
        if keyed:
            got = run_append(last_n_per_vehicle_stream(s), "t-busy")
        else:
            run_foreach(s, "t-busy", streaming.last_n_per_vehicle_writer(str(tmp_path / "busy")))
            got = streaming.read_batches(spark, str(tmp_path / "busy" / "gaps"), streaming.state.GAP_SCHEMA)
        got = sorted(map(tuple, got.select("id", "lastupdate", "n", "span_ms").collect()))
    finally:
        spark.conf.set(name, before)
    assert got == sorted(want)


@pytest.mark.parametrize("shuffle", [0, 5])
def test_top_changes_stream_equals_batch_over_late_batches(spark, landing, tmp_path, shuffle):
    from transitlens.operators import rolling

    docs = [(1_000_000 + 5_000 * i, report(f"v{(i * 5) % 8}", 1_000_000 + 5_000 * i, delay=(i * 7) % 11 - 3)) for i in range(90)]
    if shuffle:
        r = random.Random(shuffle)
        docs.sort(key=lambda x: x[0] + r.randrange(40_000))
    path = landing(_chunks([d for _, d in docs], 23), name=f"top-{shuffle}")
    base = str(tmp_path / "top")
    run_foreach(streaming.report_stream_from_text(spark, path, max_files_per_trigger=1), "t-top-changes", streaming.top_changes_writer(base, lateness_ms=40_000))
    columns = ["rank", "id", "delay", "lastupdate"]
    got = sorted(map(tuple, spark.read.parquet(f"{base}/changes").select(columns).collect()))
    reports = parse_reports(read_report_lines(spark, path))
    settled = reports.where(f"lastupdate < {1_000_000 + 5_000 * 89 - 40_000}").select("seq")
    want = rolling.top_after_each(reports).where("changed").join(settled, "seq")
    assert got == sorted(map(tuple, want.select(columns).collect())) and got


def test_last_stop_changes_stream_equals_batch(spark, landing, tmp_path):
    r = random.Random(6)
    docs = [report(f"T{i % 3}", r.randint(0, 40), stop=f"s{i}", ltype=5) for i in range(60)]
    path = landing(_chunks(docs, 13))
    base = str(tmp_path / "stops")
    run_foreach(streaming.report_stream_from_text(spark, path, max_files_per_trigger=1), "t-stops", streaming.last_stop_changes_writer(base))
    got = sorted(map(tuple, spark.read.parquet(f"{base}/changes").select("id", "last_stop", "last_update").collect()))
    want = latest.last_stop_changes(parse_reports(read_report_lines(spark, path)))
    assert got == sorted(map(tuple, want.select("id", "last_stop", "last_update").collect())) and len(got) < 60


def _lines_of(spark, sink):
    return sorted(r.value for r in sink.lines(spark).collect())


def test_rolling_lines_bound_the_files_and_survive_a_restart(spark, tmp_path):
    from transitlens.sinks import RollingLines

    path = str(tmp_path / "rolled")
    sink = RollingLines(path, ("line",), roll_bytes=60)
    want = []
    for i in range(20):
        lines = [f"batch {i:02d} line {k}" for k in range(i % 3)]
        want += lines
        sink(spark.createDataFrame([(x,) for x in lines], "line string"), i)
    assert _lines_of(spark, sink) == sorted(want)
    finished = sink.finished(spark)
    assert len(finished) >= 3 and len(os.listdir(f"{path}/_open")) <= 4
    # in the order of the batches, and no batch twice
    first = []
    for a, b in finished:
        folder = tmp_path / "rolled" / f"batches={a}-{b}"
        first += [x for f in sorted(folder.glob("part-*")) for x in f.read_text().splitlines()]
    assert first == sorted(first) and all(b < c for (_, b), (c, _) in zip(finished, finished[1:], strict=False))
    # a replayed batch that has rolled over is left alone; one that has not is written anew
    again = RollingLines(path, ("line",), roll_bytes=60)
    again(spark.createDataFrame([("other",)], "line string"), finished[0][0])
    again(spark.createDataFrame([(x,) for x in want if x.startswith("batch 19")], "line string"), 19)
    assert _lines_of(spark, again) == sorted(want)
    # a run that ended after the move, before its open folders went
    a, b = finished[-1]
    left = f"{path}/_open/batch_id={b}"
    os.makedirs(left)
    with open(f"{left}/part-0.txt", "w") as f:
        f.write("line of a finished batch\n")
    assert _lines_of(spark, again) == sorted(want)
    again(spark.createDataFrame([], "line string"), 20)
    assert not os.path.exists(left)


def test_idle_lines_roll_over(spark, tmp_path):
    from transitlens.sinks import RollingLines

    sink = RollingLines(str(tmp_path / "idle"), ("line",), idle_batches=2)
    sink(spark.createDataFrame([("a",)], "line string"), 0)
    for i in (1, 2):
        sink(spark.createDataFrame([], "line string"), i)
    assert sink.finished(spark) == [(0, 0)] and _lines_of(spark, sink) == ["a"]


def test_replaced_folder_is_never_lost(spark, tmp_path):
    from transitlens.session import replace_path, restore_path

    def put(name, text):
        spark.createDataFrame([(text,)], "value string").write.text(str(tmp_path / name))

    path = str(tmp_path / "snap")
    put("snap", "one")
    put("new", "two")
    replace_path(spark, str(tmp_path / "new"), path)
    assert spark.read.text(path).first().value == "two" and not os.path.exists(f"{path}__old")
    # a run that ended between the two moves
    os.rename(path, f"{path}__old")
    restore_path(spark, path)
    assert spark.read.text(path).first().value == "two"


def test_a_cluster_has_to_name_its_shared_folder(spark):
    from types import SimpleNamespace

    from transitlens.session import shared_dir

    session = SimpleNamespace(sparkContext=SimpleNamespace(master="spark://host:7077"), conf=SimpleNamespace(get=lambda *a: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session)


def test_list_state_writes_touched_vehicles_only(spark, landing, tmp_path):
    from transitlens.streaming import keyed_state, last_n_per_vehicle_listed

    r = random.Random(5)
    many = [report(f"v{i % 30}", 1_000_000 + 500 * i) for i in range(120)]
    r.shuffle(many)
    path = landing([many, [report("v3", 2_000_000), report("v3", 1_999_000)]])
    s = streaming.report_stream_from_text(spark, path, max_files_per_trigger=1)
    with keyed_state(spark):
        assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
        out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
        df = last_n_per_vehicle_listed(s)
        q = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start()
        q.awaitTermination()
        updated = [p["stateOperators"][0]["numRowsUpdated"] for p in (json.loads(x.json) for x in q.recentProgress) if p["stateOperators"]]
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    # the second micro-batch puts the list of one vehicle
    assert updated[0] >= 30 and updated[1] <= 12
    columns = ["id", "lastupdate", "n", "span_ms"]
    want = run_append(last_n_per_vehicle_stream(s), "t-unlisted").select(columns)
    got = spark.read.parquet(out).select(columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.where("id = 'v3'").count() == 5


def test_vehicles_of_a_group_share_a_call_and_not_a_list():
    from transitlens.streaming.state import LastTimes

    class Map(dict):
        def getValue(self, key):
            return self.get(key)

        def updateValue(self, key, value):
            self[key] = value

    class Handle:
        def getMapState(self, *_):
            return Map()

    frame = lambda rows: pd.DataFrame(rows, columns=["id", "seq", "lastupdate"])
    last = LastTimes(2, None)
    last.init(Handle())
    first = list(last.handleInputRows((0,), iter([frame([("b", 1, 50), ("a", 2, 10), (None, 3, 7)]), frame([("a", 4, 5), (None, 5, 9)])]), None))
    # one frame for the vehicles of both
    assert len(first) == 1
    assert sorted(map(tuple, first[0][["seq", "n", "span_ms"]].to_numpy().tolist())) == [(2, 2, 5), (5, 2, 2)]
    # a report behind the list gives nothing, a newer one pushes the oldest out
    second = list(last.handleInputRows((0,), iter([frame([("a", 6, 4), ("b", 7, 60), ("a", 8, 30)])]), None))
    assert sorted(map(tuple, second[0][["seq", "n", "span_ms"]].to_numpy().tolist())) == [(7, 2, 10), (8, 2, 20)]
    assert last.times[("a",)] == ([10, 30], [2, 8]) and set(last.times) == {("a",), ("b",), (None,)}


def test_landed_file_has_row_groups_for_several_tasks(spark, tmp_path):
    import pyarrow.parquet as pq

    from transitlens.sources.replay import files_below, land_events

    rows = spark.range(600_000).select(
        F.col("id").alias("event_id"),
        F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id)").alias("ts"),
        F.xxhash64("id").alias("user_id"),
        F.rand(1).alias("value"),
    )
    rows.write.parquet(str(tmp_path / "events.parquet"))
    out = land_events(spark, str(tmp_path))
    files = [f for d in files_below(spark, out) for f in files_below(spark, d)]
    found = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in files]
    # a file per arrival batch, and each can be read by several tasks
    assert len(files) == 6 and sum(m.num_rows for m in found) == 600_000
    assert all(m.num_row_groups > 1 for m in found)


def test_ordered_micro_batch_is_worked_out_once(spark, tmp_path):
    from transitlens.operators.carry import ordered_buckets

    worked = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            worked.add(b.num_rows)
            yield b

    df = spark.range(0, 1000, 1, 4).mapInArrow(count, "id long")
    got = ordered_buckets(df, ["id"], 3, str(tmp_path / "scratch"))
    assert got.count() == 1000 and worked.value == 1000
    assert got.select("_b").distinct().count() == 3
