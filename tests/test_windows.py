from pyspark.sql import functions as F

from helpers import frame, random_reports
from transitlens.operators import windows


def test_each_report_in_36_windows_and_no_empty_window(spark):
    rows = [{"seq": 0, "id": "a", "t": 1_000_000, "delay": 2}, {"seq": 1, "id": "b", "t": 1_004_000, "delay": 4},
            {"seq": 2, "id": "c", "t": 1_600_000, "delay": 6}, {"seq": 3, "id": "d", "t": 2_200_000, "delay": 8}]
    w = windows.sliding_average(frame(spark, rows)).collect()
    assert sum(r.n for r in w) == 4 * 36
    assert all(r.n > 0 for r in w)
    both = [r for r in w if r.window_start_ms <= 1_000_000 and r.window_end_ms > 1_004_000]
    assert both and all(r.avg_delay == 3.0 for r in both)


def test_panes_equal_builtin_window(spark):
    rows = random_reports(400, 20, seed=3, max_step=3000)
    df = frame(spark, rows)
    mine = {(r.window_start_ms, r.n, r.delay_sum) for r in windows.sliding_average(df).collect()}
    ts = df.withColumn("ts", F.timestamp_millis("lastupdate"))
    ref = ts.groupBy(F.window("ts", "180 seconds", "5 seconds")).agg(F.count("delay").alias("n"), F.sum("delay").alias("s"))
    theirs = {(r.ws, r.n, r.s) for r in ref.select(F.unix_millis("window.start").alias("ws"), "n", "s").collect()}
    assert mine == theirs


def test_total_average(spark):
    rows = [{"seq": i, "id": "a", "t": i, "delay": d} for i, d in enumerate([1, 2, 6])]
    r = windows.total_average(frame(spark, rows)).collect()[0]
    assert (r.delay_sum, r.n, r.avg_delay) == (9.0, 3, 3.0)
