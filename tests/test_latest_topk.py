from helpers import frame
from transitlens.operators import latest, topk


def test_train_last_stop_strictly_newer_wins(spark):
    rows = [
        {"seq": 0, "id": "T", "t": 100, "stop": "A", "ltype": 5},
        {"seq": 1, "id": "T", "t": 90, "stop": "B", "ltype": 5},
        {"seq": 2, "id": "T", "t": 100, "stop": "C", "ltype": 5},
        {"seq": 3, "id": "bus", "t": 500, "stop": "Z", "ltype": 3},
    ]
    got = [tuple(r) for r in latest.train_last_stop(frame(spark, rows)).collect()]
    assert got == [("T", "A", 100)]


def test_snapshot_lines(spark):
    rows = [{"seq": 0, "id": "T", "t": 100, "stop": "A", "ltype": 5}]
    ls = latest.train_snapshot_lines(latest.train_last_stop(frame(spark, rows)), "id,laststop,lastupdate")
    assert [r.line for r in ls.orderBy("ord").collect()] == ["id,laststop,lastupdate", "'T','A','100'"]


def _top(df):
    return [(r.id, r.delay) for r in df.orderBy("rank").collect()]


def test_each_vehicle_once(spark):
    rows = [{"seq": i, "id": "a", "t": i, "delay": 10 + i} for i in range(3)]
    rows += [{"seq": 10 + i, "id": f"b{i}", "t": 10 + i, "delay": 1 + i} for i in range(4)]
    assert _top(topk.top_delayed(frame(spark, rows))) == [("a", 12), ("b3", 4), ("b2", 3), ("b1", 2), ("b0", 1)]


def test_sixth_vehicle_returns_when_listed_one_falls(spark):
    rows = [{"seq": i, "id": f"v{i}", "t": i, "delay": 10 + i} for i in range(6)]
    rows.append({"seq": 9, "id": "v5", "t": 9, "delay": 1})
    assert [i for i, _ in _top(topk.top_delayed(frame(spark, rows)))] == ["v4", "v3", "v2", "v1", "v0"]


def test_on_time_again_drops_unless_filter_first(spark):
    rows = [{"seq": 0, "id": "a", "t": 0, "delay": 10}, {"seq": 1, "id": "a", "t": 1, "delay": 0},
            {"seq": 2, "id": "b", "t": 2, "delay": 3}]
    assert _top(topk.top_delayed(frame(spark, rows))) == [("b", 3)]
    assert _top(topk.top_delayed(frame(spark, rows), filter_first=True)) == [("a", 10), ("b", 3)]


def test_json_list_line(spark):
    rows = [{"seq": 0, "id": "a", "t": 7, "delay": 10}, {"seq": 1, "id": "b", "t": 8, "delay": 2.5}]
    line = topk.top_list_json(topk.top_delayed(frame(spark, rows))).collect()[0].line
    assert line == '[["a", 10, 7], ["b", 2.5, 8]]'


def test_timeline_as_of_ticks(spark):
    rows = [
        {"seq": 0, "id": "a", "t": 5, "delay": 3},
        {"seq": 1, "id": "b", "t": 12, "delay": 4},
        {"seq": 2, "id": "a", "t": 25, "delay": 0},
        {"seq": 3, "id": "b", "t": 31, "delay": 1},
    ]
    got = [tuple(r) for r in topk.top_delayed_timeline(frame(spark, rows), 10).orderBy("tick_ms", "rank").collect()]
    assert got == [(10, 1, "a", 3.0), (20, 1, "b", 4.0), (20, 2, "a", 3.0), (30, 1, "b", 4.0)]


def test_timeline_with_small_buckets_matches_one_bucket(spark):
    from helpers import random_reports

    rows = random_reports(250, 6, seed=5, max_step=20, delays=(3, 1, -2, 7))
    df = frame(spark, rows)
    one = sorted(map(tuple, topk.top_delayed_timeline(df, 10, buckets=1).collect()))
    many = sorted(map(tuple, topk.top_delayed_timeline(df, 10, buckets=9).collect()))
    assert one == many and len(one) > 0


def test_next_time_across_buckets(spark):
    from transitlens.operators.carry import with_next_time

    rows = [{"seq": i, "id": "a" if i % 3 else "b", "t": t} for i, t in enumerate([5, 5, 9, 30, 31, 77, 200, 200])]
    got = {r.seq: r._next for r in with_next_time(frame(spark, rows), buckets=4).collect()}
    # per id in (t asc, seq desc) order: a: 5(s1),9(s2),31(s4),77(s5),200(s7); b: 5(s0),30(s3),200(s6)
    assert got == {1: 9, 2: 31, 4: 77, 5: 200, 7: None, 0: 30, 3: 200, 6: None}
