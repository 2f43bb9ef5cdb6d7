"""Property tests: the bucketed operators equal their direct definitions for
any input and any bucket size."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import brute_last_n, brute_recent, frame
from transitlens.operators import recent
from transitlens.operators.carry import with_next_time, with_oldest_of_last

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

reports = st.lists(
    st.tuples(st.integers(0, 4), st.integers(0, 600), st.sampled_from([-1.0, 1.0, 2.0])),
    min_size=1,
    max_size=60,
)


def _rows(raw):
    return [{"seq": i, "id": f"v{v}", "t": t * 1000, "delay": d} for i, (v, t, d) in enumerate(raw)]


@SETTINGS
@given(raw=reports, buckets=st.sampled_from([1, 2, 5, 20]))
def test_recent_lists_property(spark, raw, buckets):
    rows = _rows(raw)
    got = {}
    for r in recent.recent_lists(frame(spark, rows), 60_000, buckets=buckets).collect():
        got.setdefault(r.seq, []).append((r.rank, r.id, r.delay, r.lastupdate, r.changed))
    got = {s: ([(i, d, t) for _, i, d, t, _ in sorted(v)], v[0][4]) for s, v in got.items()}
    assert got == brute_recent(rows, 60_000)


@SETTINGS
@given(raw=reports, buckets=st.sampled_from([1, 3, 9, 40]), n=st.integers(2, 6))
def test_frame_ends_property(spark, raw, buckets, n):
    rows = _rows(raw)
    for part in ([], ["id"]):
        got = {r.seq: (r.n, r.span_ms) for r in with_oldest_of_last(frame(spark, rows), n, part, buckets=buckets).collect() if r.n > 1}
        assert got == brute_last_n(rows, n=n, by_vehicle=bool(part))


@SETTINGS
@given(raw=reports, buckets=st.sampled_from([1, 4, 30]))
def test_next_time_property(spark, raw, buckets):
    rows = _rows(raw)
    got = {r.seq: r._next for r in with_next_time(frame(spark, rows), buckets=buckets).collect()}
    want = {}
    for vid in {r["id"] for r in rows}:
        mine = sorted((r for r in rows if r["id"] == vid), key=lambda r: (r["t"], -r["seq"]))
        for a, b in zip(mine, mine[1:] + [None]):
            want[a["seq"]] = None if b is None else b["t"]
    assert got == want
