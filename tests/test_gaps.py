import datetime as dt

import pytest

from helpers import brute_last_n, frame, random_reports
from transitlens.operators import gaps
from transitlens.operators.carry import ordered_buckets, with_oldest_of_last


def _timeline(df):
    return {r.seq: (r.n, r.span_ms) for r in df.collect()}


@pytest.mark.parametrize("count", [1, 2, 10, 11])
def test_small_counts(spark, count):
    rows = [{"seq": i, "id": "a", "t": 1000 * i * i} for i in range(count)]
    got = _timeline(gaps.gap_timeline(frame(spark, rows), buckets=5))
    assert got == brute_last_n(rows)
    final = gaps.gap_final(frame(spark, rows)).collect()
    if count < 2:
        assert final == []
    else:
        n = min(count, 10)
        assert final[0].n == n and final[0].gap_ms == final[0].span_ms / (n - 1)


@pytest.mark.parametrize("buckets", [1, 4, 40, 290])
def test_fleet_timeline_matches_brute_force(spark, buckets):
    rows = random_reports(300, 5, seed=buckets, max_step=5000, gap_every=15, gap=200_000)
    assert _timeline(gaps.gap_timeline(frame(spark, rows), buckets=buckets)) == brute_last_n(rows)


@pytest.mark.parametrize("buckets", [1, 7, 60])
def test_per_vehicle_matches_brute_force(spark, buckets):
    rows = random_reports(300, 4, seed=11, max_step=5000)
    got = _timeline(gaps.gap_per_vehicle(frame(spark, rows), buckets=buckets))
    assert got == brute_last_n(rows, by_vehicle=True)


def test_equal_times_and_out_of_order_input(spark):
    rows = [{"seq": i, "id": "a", "t": t} for i, t in enumerate([50, 10, 10, 30, 10])]
    assert _timeline(gaps.gap_timeline(frame(spark, rows), buckets=3)) == brute_last_n(rows)


def test_frame_ends(spark):
    rows = [{"seq": i, "id": "a", "t": 10 * i} for i in range(25)]
    got = {r.seq: (r.n, r.span_ms) for r in with_oldest_of_last(frame(spark, rows), 4, buckets=6).collect()}
    assert got[0] == (1, 0) and got[2] == (3, 20) and got[24] == (4, 30)


def test_gap_text_matches_timedelta(spark):
    rows = [{"seq": i, "id": "a", "t": t} for i, t in enumerate([0, 1, 3, 1000, 2_000_000, 90_000_000_000])]
    got = {r.seq: r.gap_text for r in gaps.gap_text_timeline(frame(spark, rows), buckets=3).collect()}
    ts = sorted(r["t"] for r in rows)
    for i in range(1, len(ts)):
        fr = ts[max(0, i - 9): i + 1]
        deltas = [dt.timedelta(milliseconds=b - a) for a, b in zip(fr, fr[1:])]
        assert got[i] == str(sum(deltas, dt.timedelta()) / len(deltas))


def test_buffer_and_deltas(spark):
    rows = [{"seq": i, "id": "a", "t": t} for i, t in enumerate([5, 1, 9, 20, 40, 41, 50, 60, 61, 70, 80, 100])]
    buf = [r.lastupdate for r in gaps.last_n_buffer(frame(spark, rows)).orderBy("rank").collect()]
    assert buf == [100, 80, 70, 61, 60, 50, 41, 40, 20, 9]
    d = [r.delta_ms for r in gaps.buffer_deltas(frame(spark, rows)).orderBy("pos").collect()]
    assert d == [11, 20, 1, 9, 10, 1, 9, 10, 20]


def test_burst_and_hot_vehicle_are_spread(spark):
    rows = [{"seq": i, "id": "hot" if i % 4 else f"c{i}", "t": 1000 * i} for i in range(1200)]
    # a burst: 400 reports of the hot vehicle at one and the same time
    rows += [{"seq": 4000 + j, "id": "hot", "t": 2_000_000} for j in range(400)]
    df = frame(spark, rows)
    sizes = [r["count"] for r in ordered_buckets(df, ["id", "lastupdate", "seq"], buckets=16).groupBy("_b").count().collect()]
    assert len(sizes) >= 14 and max(sizes) < 3 * 1600 / 16
    assert _timeline(gaps.gap_per_vehicle(df, buckets=16)) == brute_last_n(rows, by_vehicle=True)


def test_no_rows(spark):
    df = frame(spark, [{"seq": 0, "id": "a", "t": 1}]).limit(0)
    assert gaps.gap_timeline(df).collect() == [] and gaps.gap_per_vehicle(df).collect() == []
