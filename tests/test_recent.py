import pytest

from helpers import brute_recent, frame, random_reports
from transitlens.operators import recent

W = 180_000


def _lists(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.seq, []).append((r.rank, r.id, r.delay, r.lastupdate, r.changed))
    return {s: ([(i, d, t) for _, i, d, t, _ in sorted(v)], v[0][4]) for s, v in out.items()}


def test_trailing_bound_inclusive(spark):
    t = 10_000_000
    rows = [{"seq": 0, "id": "a", "t": t, "delay": 1}, {"seq": 1, "id": "b", "t": t + W, "delay": 1},
            {"seq": 2, "id": "c", "t": t + W + 1, "delay": 1}]
    got = _lists(recent.recent_lists(frame(spark, rows), W))
    assert [i for i, _, _ in got[1][0]] == ["b", "a"]
    assert [i for i, _, _ in got[2][0]] == ["c", "b"]


def test_same_id_and_delay_is_no_change(spark):
    rows = [{"seq": i, "id": f"v{i}", "t": 1000 * i, "delay": 1} for i in range(5)]
    rows.append({"seq": 5, "id": "v4", "t": 5000, "delay": 1})
    got = _lists(recent.recent_lists(frame(spark, rows), W))
    assert [got[s][1] for s in range(6)] == [True, True, True, True, True, False]


def test_shrinking_list_counts_as_change(spark):
    rows = [{"seq": i, "id": f"v{i}", "t": 1000 * i, "delay": 1} for i in range(5)]
    rows.append({"seq": 5, "id": "v4", "t": 4000 + W + 10_000, "delay": 1})
    got = _lists(recent.recent_lists(frame(spark, rows), W))
    assert got[5] == ([("v4", 1.0, 4000 + W + 10_000)], True)


@pytest.mark.parametrize(
    "seed,vehicles,buckets,gap_every", [(1, 6, 6, 0), (2, 8, 3, 20), (3, 3, 1, 10), (4, 12, 12, 30), (5, 6, 7, 12)]
)
def test_matches_brute_force(spark, seed, vehicles, buckets, gap_every):
    rows = random_reports(300, vehicles, seed, gap_every=gap_every, gap=W + 1000)
    got = _lists(recent.recent_lists(frame(spark, rows), W, buckets=buckets))
    want = brute_recent(rows, W)
    assert got == want
    assert any(not c for _, c in want.values()) or vehicles < 5 or gap_every


def test_final_list(spark):
    rows = random_reports(200, 7, seed=9)
    d = brute_recent(rows, W)
    last = max((r for r in rows if r["delay"] > 0), key=lambda r: (r["t"], r["seq"]))
    got = [(r.id, r.delay, r.lastupdate) for r in recent.recent_final(frame(spark, rows), W).orderBy("rank").collect()]
    assert got == d[last["seq"]][0]


@pytest.mark.parametrize("chunk", [3, 20, 10**9])
def test_chunks_of_a_bucket_match_brute_force(spark, chunk, monkeypatch):
    monkeypatch.setattr(recent, "CHUNK_ROWS", chunk)
    rows = random_reports(250, 7, seed=chunk, gap_every=25, gap=W + 1000)
    got = _lists(recent.recent_lists(frame(spark, rows), W, buckets=3))
    assert got == brute_recent(rows, W)


def test_newest_places_equal_a_scan():
    import random

    import numpy as np

    r = random.Random(2)
    for n, vehicles, k in ((1, 1, 5), (50, 3, 5), (400, 9, 5), (400, 200, 3), (300, 1, 2)):
        code = [r.randrange(vehicles) for _ in range(n)]
        got = recent.newest_places(np.array(code), k)
        for i in range(n):
            want, seen = [], set()
            for p in range(i, -1, -1):
                if code[p] not in seen and len(want) < k:
                    seen.add(code[p])
                    want.append(p)
            assert [p for p in got[i] if p >= 0] == want


def test_a_bucket_per_task(spark):
    df = frame(spark, random_reports(200, 6, 4))
    lists = recent.recent_lists(df, W, buckets=5)
    assert lists.rdd.getNumPartitions() == 5
    assert sorted(map(tuple, lists.collect())) == sorted(map(tuple, recent.recent_lists(df, W, buckets=1).collect()))
