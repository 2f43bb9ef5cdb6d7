"""Brute-force reference computations for small fixtures."""

import random

from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

REPORT_SCHEMA = StructType(
    [
        StructField("seq", LongType()),
        StructField("id", StringType()),
        StructField("bearing", DoubleType()),
        StructField("isinactive", StringType()),
        StructField("ltype", IntegerType()),
        StructField("delay", DoubleType()),
        StructField("lastupdate", LongType()),
        StructField("laststopid", StringType()),
    ]
)


def frame(spark, rows):
    """rows: dicts with seq, id, t and optional delay, bearing, ltype, inactive, stop."""
    data = [
        (
            r["seq"], str(r["id"]), float(r.get("bearing", 0)), r.get("inactive", "false"), r.get("ltype", 3),
            None if r.get("delay") is None else float(r["delay"]), r["t"], str(r.get("stop", "S")),
        )
        for r in rows
    ]
    return spark.createDataFrame(data, REPORT_SCHEMA)


def random_reports(n, vehicles, seed, max_step=40_000, gap_every=0, gap=1_000_000, delays=(1, 2, -1)):
    rnd = random.Random(seed)
    t, out = 1_000_000_000, []
    for i in range(n):
        t += rnd.choice([0, rnd.randint(0, max_step)])
        if gap_every and rnd.random() < 1 / gap_every:
            t += gap
        out.append({"seq": i, "id": f"v{rnd.randint(1, vehicles)}", "t": t, "delay": rnd.choice(delays)})
    rnd.shuffle(out)
    return out


def brute_recent(rows, window_ms, k=5):
    """{seq: (list of (id, delay, t), changed)} over delayed rows."""
    d = sorted((r for r in rows if r.get("delay") is not None and r["delay"] > 0 and r.get("inactive", "false") == "false"),
               key=lambda r: (r["t"], r["seq"]))
    res, prev = {}, None
    for i, r in enumerate(d):
        latest = {}
        for q in d[: i + 1]:
            if q["t"] >= r["t"] - window_ms:
                latest[q["id"]] = q
        top = sorted(latest.values(), key=lambda q: (q["t"], q["seq"]), reverse=True)[:k]
        key = [(q["id"], float(q["delay"])) for q in top]
        changed = prev is None or len(prev) < k or len(key) < k or key != prev
        prev = key
        res[r["seq"]] = ([(q["id"], float(q["delay"]), q["t"]) for q in top], changed)
    return res


def brute_last_n(rows, n=10, by_vehicle=False):
    """{seq: (count, span)} for rows with a frame of at least 2."""
    a = sorted((r for r in rows if r.get("inactive", "false") == "false"), key=lambda r: (r["t"], r["seq"]))
    groups = {}
    for r in a:
        groups.setdefault(r["id"] if by_vehicle else None, []).append(r)
    out = {}
    for g in groups.values():
        for i, r in enumerate(g):
            fr = g[max(0, i - n + 1): i + 1]
            if len(fr) > 1:
                out[r["seq"]] = (len(fr), fr[-1]["t"] - fr[0]["t"])
    return out
