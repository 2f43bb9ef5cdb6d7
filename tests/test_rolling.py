import random
import re

import numpy as np
import pytest

from helpers import frame, random_reports
from test_plans import _explain
from transitlens.operators import latest, rolling, topk, windows


def brute_lists(rows, k=5):
    """{seq: (list of (id, delay, t), changed)} after every active report."""
    known, out, before = {}, {}, []
    for r in sorted((r for r in rows if r.get("inactive", "false") == "false"), key=lambda r: (r["t"], r["seq"])):
        if r["id"] not in known or r["t"] > known[r["id"]]["t"]:
            known[r["id"]] = r
        top = sorted((q for q in known.values() if q["delay"] is not None and q["delay"] > 0), key=lambda q: (-q["delay"], q["id"]))[:k]
        out[r["seq"]] = ([(q["id"], float(q["delay"]), q["t"]) for q in top], [(q["id"], q["delay"]) for q in top] != before)
        before = [(q["id"], q["delay"]) for q in top]
    return out


def got_lists(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.seq, r["rank"])):
        out.setdefault(r.seq, ([], r.changed))[0].append((r.id, r.delay, r.lastupdate))
    return out


@pytest.mark.parametrize("buckets", [1, 2, 7, 40])
def test_lists_after_every_report(spark, buckets):
    rows = random_reports(260, 9, seed=buckets, max_step=50, delays=(3, 1, -2, 7, 7, None))
    for r in rows[::11]:
        r["inactive"] = "true"
    want = {s: x for s, x in brute_lists(rows).items() if x[0]}
    assert got_lists(rolling.top_after_each(frame(spark, rows), buckets=buckets)) == want


def test_a_vehicle_that_falls_leaves_and_a_forgotten_one_returns(spark):
    rows = [{"seq": i, "id": f"v{i}", "t": i, "delay": 10 + i} for i in range(6)] + [{"seq": 9, "id": "v5", "t": 9, "delay": 1}, {"seq": 10, "id": "v4", "t": 10, "delay": 0}]
    got = got_lists(rolling.top_after_each(frame(spark, rows), buckets=4))
    assert [i for i, _, _ in got[5][0]] == ["v5", "v4", "v3", "v2", "v1"]
    assert [i for i, _, _ in got[9][0]] == ["v4", "v3", "v2", "v1", "v0"]
    assert [i for i, _, _ in got[10][0]] == ["v3", "v2", "v1", "v0", "v5"]


def test_equal_times_and_repeated_states_over_bucket_borders(spark):
    rows = [{"seq": i, "id": f"v{i % 4}", "t": 1000 * (i // 50), "delay": (i * 7) % 5} for i in range(200)]
    want = {s: x for s, x in brute_lists(rows).items() if x[0]}
    assert got_lists(rolling.top_after_each(frame(spark, rows), buckets=30)) == want


def test_context_shapes_the_lists_but_gets_none(spark):
    rows = random_reports(120, 6, seed=4, max_step=20, delays=(3, 1, -2, 7))
    rows.sort(key=lambda r: (r["t"], r["seq"]))
    cut = rows[60]["t"]
    old, new = [r for r in rows if r["t"] < cut], [r for r in rows if r["t"] >= cut]
    known = {}
    for r in old:
        if r["id"] not in known or r["t"] > known[r["id"]]["t"]:
            known[r["id"]] = r
    context = [r for r in known.values() if r["delay"] > 0]
    got = got_lists(rolling.top_after_each(frame(spark, new), buckets=5, context=frame(spark, context)))
    whole = brute_lists(rows)
    first = min(new, key=lambda r: (r["t"], r["seq"]))["seq"]
    for s, (top, changed) in got.items():
        assert top == whole[s][0] and (s == first or changed == whole[s][1])
    assert set(got) == {r["seq"] for r in new if whole[r["seq"]][0]}


def test_no_reports(spark):
    empty = frame(spark, [])
    assert rolling.top_after_each(empty).count() == 0 and topk.top_delayed_timeline(empty, 10).count() == 0
    assert windows.sliding_vehicle_average(empty).count() == 0 and latest.last_stop_changes(empty).count() == 0


def test_blocks_cover_each_bucket_of_a_run_once(spark):
    r = random.Random(2)
    for n in (1, 2, 5, 13, 64):
        size = 1 << max(n - 1, 0).bit_length()
        runs = [(a, r.randint(a, n)) for a in (r.randint(0, n) for _ in range(60))]
        cover = [[] for _ in runs]
        df_blocks = []
        for at, block in rolling.blocks_between(np.array([a for a, _ in runs]), np.array([b for _, b in runs]), size):
            for i, x in zip(at.tolist(), block.tolist(), strict=True):
                cover[i].append(x)
                df_blocks.append((x,))
        assert all(len(c) <= 2 * size.bit_length() for c in cover)
        below = {}
        if df_blocks:
            made = spark.createDataFrame(sorted(set(df_blocks)), "node long").withColumn("b", rolling.buckets_of_block("node", n))
            below = {x.node: x.b for x in made.collect()}
        for (a, b), c in zip(runs, cover, strict=True):
            assert sorted(x for node in c for x in below[node]) == list(range(a, b))


def test_ticks_follow_states_and_marks_not_vehicles_times_ticks(spark):
    # 400 vehicles report once and stand for 2000 ticks: 800,000 pairs
    rows = [{"seq": i, "id": f"v{i}", "t": i, "delay": 1 + i % 50} for i in range(400)] + [{"seq": 1000, "id": "last", "t": 20_000, "delay": -1}]
    df = topk.top_delayed_timeline(frame(spark, rows), 10, buckets=8)
    assert df.count() == 5 * 1999 + 5 + 1
    plan = _explain(df)
    # the states that outlive their bucket are limited per block before they are shuffled
    assert "WindowGroupLimit" in plan and "MapInArrow" in plan and not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan)


def test_mean_over_vehicles_counts_each_once(spark):
    rows = [{"seq": 0, "id": "a", "t": 1_000_000, "delay": 2}, {"seq": 1, "id": "a", "t": 1_004_000, "delay": 4}, {"seq": 2, "id": "b", "t": 1_004_000, "delay": 8},
            {"seq": 3, "id": "a", "t": 1_004_000, "delay": 100}]
    got = {r.window_end_ms: (r.n, r.avg_delay) for r in windows.sliding_vehicle_average(frame(spark, rows)).collect()}
    # the first window end behind a report is the next multiple of five seconds
    assert got == {1_005_000 + 5000 * i: (2, 6.0) for i in range(36)}


@pytest.mark.parametrize("buckets", [1, 3, 20])
def test_mean_over_vehicles_equals_a_walk_over_the_windows(spark, buckets):
    rows = random_reports(300, 7, seed=buckets, max_step=9000, gap_every=40, delays=(1.25, 2, -1, None))
    size, slide = 60_000, 5000
    want = {}
    for end in range(rows and min(r["t"] for r in rows) // slide * slide, max(r["t"] for r in rows) + size + slide, slide):
        newest = {}
        for r in sorted(rows, key=lambda r: (r["t"], -r["seq"])):
            if end - size <= r["t"] < end:
                newest[r["id"]] = r
        delays = [r["delay"] for r in newest.values() if r["delay"] is not None]
        if delays:
            want[end] = (len(delays), round(sum(delays), 6))
    got = {r.window_end_ms: (r.n, round(r.delay_sum, 6)) for r in windows.sliding_vehicle_average(frame(spark, rows), size, slide, buckets).collect()}
    assert got == want


def test_stored_panes_are_merged_and_replaced(spark, tmp_path):
    rows = random_reports(200, 5, seed=8, max_step=4000)
    path = str(tmp_path / "panes")
    for part, some in (("a", rows[:70]), ("b", rows[70:]), ("b", rows[70:])):
        windows.store_panes(frame(spark, some), path, part)
    merged = windows.average_of_panes(windows.stored_panes(spark, path))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, windows.sliding_average(frame(spark, rows)).collect()))


@pytest.mark.parametrize("buckets", [1, 4, 25])
def test_last_stop_changes_in_the_order_of_arrival(spark, buckets):
    r = random.Random(buckets)
    rows = [{"seq": i, "id": f"T{r.randint(0, 3) and 1}", "t": r.randint(0, 60), "stop": f"s{i}", "ltype": 5} for i in range(150)]
    known, want = {}, []
    for x in rows:
        if x["t"] > known.get(x["id"], -1):
            known[x["id"]] = x["t"]
            want.append((x["seq"], x["id"], x["stop"], x["t"]))
    got = sorted(map(tuple, latest.last_stop_changes(frame(spark, rows), buckets).collect()))
    assert got == want
    # with what was known of the first half, the second half goes on
    newest = latest.latest_per_key(frame(spark, rows[:75]), "id", ["lastupdate"])
    later = sorted(map(tuple, latest.last_stop_changes(frame(spark, rows[75:]), buckets, newest).collect()))
    assert later == [x for x in want if x[0] >= 75]


def test_only_changes_are_the_changed_lists_of_all(spark):
    for seed, vehicles in ((1, 3), (2, 12), (3, 40)):
        df = frame(spark, random_reports(300, vehicles, seed, delays=(1, 2, 3, 50, -1, None)))
        every = rolling.top_after_each(df, buckets=5).where("changed")
        only = rolling.top_after_each(df, buckets=5, only_changes=True)
        assert only.rdd.getNumPartitions() == 5  # a bucket per task
        assert sorted(map(tuple, only.collect())) == sorted(map(tuple, every.collect()))
