from conftest import report
from transitlens.functions import duration_text, heading_within, iso_text, json_pair_line, number_text
from transitlens.operators import filters


def test_bearing_bounds(reports_of):
    bearings = [0, 45, 45.5, 46, 180, 314.9, 315, 360, 361, -1]
    r = reports_of([report(i, i, bearing=b) for i, b in enumerate(bearings)])
    got = sorted(x.bearing for x in filters.north(filters.active(r)).collect())
    assert got == [0, 45, 315, 360]


def test_inactive_flag(spark, reports_of):
    docs = [report(1, 1, inactive="false"), report(2, 2, inactive="true"), report(3, 3, inactive="False")]
    missing = report(4, 4).replace(',"isinactive":"false"', "")
    r = reports_of(docs + [missing])
    assert [x.id for x in filters.active(r).collect()] == ["1"]


def test_delay_bounds(reports_of):
    docs = [report(i, i, delay=d) for i, d in enumerate([-1, 0, 0.5])]
    docs.append(report(9, 9).replace('"delay":0', '"delay":""'))
    assert [x.delay for x in filters.delayed(reports_of(docs)).collect()] == [0.5]


def test_heading_within_wraps(spark):
    df = spark.createDataFrame([(float(b),) for b in (0, 80, 90, 100, 350, 10, 200)], ["bearing"])
    east = [r.bearing for r in df.where(heading_within("bearing", 90, 10)).collect()]
    assert east == [80, 90, 100]
    wrap = [r.bearing for r in df.where(heading_within("bearing", 0, 15)).collect()]
    assert wrap == [0, 350, 10]


def test_json_line_format(spark):
    import json

    ids = [("v1", 45.0), ('a"b', 315.5), ("Želivského", 0.0), ("bus😀\t", 360.0)]
    df = spark.createDataFrame(ids, ["id", "bearing"])
    lines = [r.l for r in df.select(json_pair_line("id", "bearing").alias("l")).collect()]
    want = [json.dumps([i, int(b) if b == int(b) else b]) for i, b in ids]
    assert lines == want


def test_number_text(spark):
    df = spark.createDataFrame([(1.0,), (2.5,), (-3.0,)], ["x"])
    assert [r.t for r in df.select(number_text("x").alias("t")).collect()] == ["1", "2.5", "-3"]


def test_iso_and_duration_text_match_python(spark):
    import datetime as dt

    ms = [0, 1703181905807, 1703181905000, 1704067207179]
    df = spark.createDataFrame([(m,) for m in ms], ["ms"])
    got = [r.t for r in df.select(iso_text("ms").alias("t")).collect()]
    want = [dt.datetime.fromtimestamp(m / 1000, dt.timezone.utc).replace(tzinfo=None).isoformat() for m in ms]
    assert got == want
    us = [0, 1, 999999, 61_000_000, 3_600_000_001, 86_400_000_000, 2 * 86_400_000_000 + 5, 90_061_000_007]
    df = spark.createDataFrame([(u,) for u in us], ["us"])
    got = [r.t for r in df.select(duration_text("us").alias("t")).collect()]
    assert got == [str(dt.timedelta(microseconds=u)) for u in us]


def test_north_lines(reports_of):
    r = reports_of([report("v", 1, bearing=0), report("w", 2, bearing=100)])
    assert [x.line for x in filters.north_lines(filters.active(r)).collect()] == ['["v", 0]']
