"""Plan shape checks: pushdown, partial top-k, no data window in one task."""

import re

from helpers import frame
from transitlens.operators import filters, gaps, recent, topk


def _explain(df, mode="formatted"):
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def test_filters_reach_parquet_scan(spark, tmp_path):
    rows = [{"seq": i, "id": f"v{i % 7}", "t": i, "bearing": (i * 15) % 375, "delay": i % 5} for i in range(200)]
    path = str(tmp_path / "reports")
    frame(spark, rows).write.parquet(path)
    plan = _explain(filters.north(filters.active(spark.read.parquet(path))))
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan).group(1)
    assert "EqualTo(isinactive,false)" in pushed
    assert "GreaterThanOrEqual(bearing" in pushed
    schema = re.search(r"ReadSchema: (struct<.*>)", plan).group(1)
    assert schema == "struct<id:string,bearing:double,isinactive:string>"


def test_top_k_is_limited_before_the_shuffle(spark):
    rows = [{"seq": i, "id": f"v{i % 50}", "t": i, "delay": i % 17} for i in range(500)]
    plan = _explain(topk.top_delayed(frame(spark, rows)))
    assert "TakeOrderedAndProject" in plan or "WindowGroupLimit" in plan
    per_tick = _explain(topk.top_delayed_timeline(frame(spark, rows), 100))
    assert "WindowGroupLimit" in per_tick and "Partial" in per_tick


def test_frames_and_tails_are_partitioned_by_bucket(spark):
    rows = [{"seq": i, "id": f"v{i % 5}", "t": 1000 * i, "delay": i % 3} for i in range(100)]
    for df in (gaps.gap_timeline(frame(spark, rows)), gaps.gap_per_vehicle(frame(spark, rows)), recent.recent_lists(frame(spark, rows))):
        plan = _explain(df, "simple")
        assert "SinglePartition" not in plan and "Window" in plan
        for w in re.findall(r"Window \[[^\n]*", plan):
            assert "_b" in w.split("windowspecdefinition(")[1].split(",")[0]


def test_latest_per_vehicle_is_partially_aggregated(spark):
    rows = [{"seq": i, "id": f"v{i % 5}", "t": i, "delay": 1} for i in range(100)]
    plan = _explain(topk.latest_delay_per_vehicle(frame(spark, rows)))
    assert "partial_max_by" in plan


def test_latest_states_are_aggregated_by_hash(spark):
    rows = [{"seq": i, "id": f"v{i % 5}", "t": i, "delay": 1} for i in range(100)]
    r = frame(spark, rows)
    for df in (topk.latest_delay_per_vehicle(r), topk.top_delayed(r), recent.recent_final(r)):
        plan = _explain(df, "simple")
        assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_active_test_reaches_the_events_scan(spark):
    from transitlens.plans import queries

    q = queries()
    for name in ("active_reports", "top5_delayed", "avg_delay_sliding", "recent5_final"):
        plan = _explain(q[name](spark, "/root/testdata/sf0.001"))
        assert any("event_type" in p for p in re.findall(r"PushedFilters: \[(.*)\]", plan)), name
