import math
import re

import pytest

from transitlens.llm import url_filter

URLS = [
    None, "", "no scheme", "http://", "https://A.Example.ORG/es/1?x#y", "http://example.org/en/12", "http://sub.example.org/en/2#f",
    "http://x.com/fr/a", "http://x.com/de/b", "http://x.com/DE/b", "ftp://org", "http://org/", "http://notorg/x", "http://cheap-pills.example.net/en/1",
    "http://a.net?q=/fr/", "x://y://z/p", "http://blog.tionsh.example.net/es/533/", "http://h.net/" + "long/" * 3000,
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.split("[?#]", rest[len(host):])[0]


def rule(host, path):
    fits = [(len(h + p), v == "block", h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, None)


@pytest.fixture(scope="module")
def weights(spark):
    return url_filter.fit(spark)


def test_host_path_rule_and_verdict(spark, weights):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)] + [(3, "http://", "x")], "page_id long, url string, host string")
    got = url_filter.judge(pages, weights).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        host, path = parts(URLS[r["page_id"]])
        name, verdict = rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, name)
        assert r["verdict"] == (verdict or ("block" if r["score"] >= 0.5 else "allow"))


def test_fit_is_full_batch_gradient_descent(spark):
    """The SQL fit against the same steps in plain Python, on few buckets."""
    table, buckets = url_filter.LABELLED[:6] + url_filter.LABELLED[-6:], 64
    rows = spark.createDataFrame([(t,) for t, _ in table], "t string")
    x = [set(r[0]) for r in rows.select(url_filter.feature_buckets(rows["t"], buckets)).collect()]
    w = [0.0] * (buckets + 1)
    for _ in range(5):
        d = [1 / (1 + math.exp(-(w[-1] + sum(w[b - 1] for b in f)))) - y for f, (_, y) in zip(x, table)]
        g = [sum(e for f, e in zip(x, d) if b in f) for b in range(1, buckets + 1)] + [sum(d)]
        w = [a - url_filter.RATE * (b / len(table) + url_filter.RIDGE * a) for a, b in zip(w, g)]
    assert url_filter.fit(spark, table, buckets, 5) == pytest.approx(w, abs=1e-9)


def test_training_table_is_separated_and_unseen_hosts_generalise(spark, weights):
    seen = [(i, "http://" + t) for i, (t, _) in enumerate(url_filter.LABELLED)]
    unseen = ["http://very-cheap-pills.example.net/en/9", "http://spam-farmer.example.net/es/2", "http://blog.tiontion.example.net/en/853/"]
    pages = spark.createDataFrame(seen + [(1000 + i, u) for i, u in enumerate(unseen)], "page_id long, url string")
    score = {r["page_id"]: r["score"] for r in url_filter.judge(pages, weights, rules=[]).collect()}
    right = sum((score[i] >= 0.5) == bool(y) for i, (_, y) in enumerate(url_filter.LABELLED))
    assert right >= 0.95 * len(url_filter.LABELLED)
    assert score[1000] > 0.5 and score[1001] > 0.5 and score[1002] < 0.5


def test_no_python_in_the_plan_and_empty_table(spark, weights):
    pages = spark.createDataFrame([], "page_id long, url string")
    judged = url_filter.judge(pages, weights)
    assert judged.count() == 0
    plan = judged._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
