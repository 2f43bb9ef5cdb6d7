import hashlib
import math
from collections import Counter

from pyspark.sql import functions as F

from transitlens.llm import mixing


def uniform(*parts):
    return int(hashlib.md5(":".join(parts).encode()).hexdigest()[:13], 16) / 2**52


def draw(rate, doc, seed):
    parts = max(1, math.ceil(rate / mixing.PART_MEAN))
    steps = mixing.poisson_steps(rate / parts)
    return sum(sum(s <= uniform(seed, str(i), doc) for s in steps) for i in range(parts))


def test_copies_follow_the_poisson_inverse(spark):
    rows = [(i, f"t{i}", "big" if i % 3 else "small" if i % 2 else None) for i in range(900)] + [(None, "n", "big"), (5, "t5", "big")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("rate", F.lit("x"))
    weights = {"big": 0.1, "small": 0.8, "*": 0.1}
    for size in (900.0, 30000.0):
        got = Counter((r["doc_id"], r["source"]) for r in mixing.mix(docs, weights, size).collect())
        counts = Counter(s if s in weights else "*" for _, _, s in rows)
        want = Counter()
        for i, _, s in rows:
            b = s if s in weights else "*"
            want[i, s] += draw(weights[b] * size / counts[b], "" if i is None else str(i), mixing.SEED)
        assert got == +want
        share = sum(n for (_, s), n in got.items() if s == "small") / sum(got.values())
        assert abs(share - 0.8) < 0.08


def test_poisson_steps_are_the_distribution_function():
    steps = mixing.poisson_steps(2.5)
    assert abs(steps[0] - math.exp(-2.5)) < 1e-15 and abs(steps[-1] - 1) < 1e-12 and steps == sorted(steps)


def test_order_is_a_shuffle_and_is_the_same_again(spark):
    docs = spark.createDataFrame([(i, "a") for i in range(2000)], "doc_id long, source string")
    one, two = ([tuple(r) for r in mixing.mix(docs, {"*": 1.0}).collect()] for _ in range(2))
    assert sorted(one) == sorted(two)
    ids = [r[0] for r in one]
    assert abs(sum(a < b for a, b in zip(ids, ids[1:])) / len(ids) - 0.5) < 0.08


def test_empty_table_zero_weight_and_plan(spark):
    empty = spark.createDataFrame([], "doc_id long, source string")
    assert mixing.mix(empty).count() == 0
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, source string")
    assert {r["source"] for r in mixing.mix(docs, {"a": 0.0, "*": 1.0}, 100.0).collect()} == {"b"}
    plan = mixing.mix(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
