import random
import zlib
from collections import Counter, defaultdict
from itertools import product

import pytest

from transitlens.llm import sharding

from .conftest import odd_rows


def sums_of(sizes, to, shards):
    out = [0] * shards
    for s, t in zip(sizes, to, strict=True):
        out[t] += s
    return out


def spread(sizes, to, shards):
    out = sums_of(sizes, to, shards)
    return max(out) - min(out)


def plain_differencing(sizes, shards):
    """The same method on lists of items, without a heap or parts."""
    parts = [sorted([(0, [])] * (shards - 1) + [(s, [i])], key=lambda x: x[0]) for i, s in sorted(enumerate(sizes), key=lambda x: (-x[1], x[0]))]
    while len(parts) > 1:
        parts.sort(key=lambda p: p[0][0] - p[-1][0])
        a, b, *parts = parts
        parts.append(sorted(((x + y, m + n) for (x, m), (y, n) in zip(a, reversed(b), strict=True)), key=lambda x: x[0]))
    return [x for x, _ in parts[0]]


def test_differencing_of_the_textbook_example():
    # 8, 7, 6, 5, 4 in two parts: differencing ends at a difference of 2
    assert spread([8, 7, 6, 5, 4], sharding.difference([8, 7, 6, 5, 4], 2), 2) == 2


@pytest.mark.parametrize("shards", [2, 3, 16])
def test_differencing_places_every_item_and_beats_greedy(shards):
    r = random.Random(shards)
    sizes = [int(r.lognormvariate(8, 1)) for _ in range(3000)]
    to = sharding.difference(sizes, shards)
    assert len(to) == len(sizes) and set(to) == set(range(shards))
    greedy = [0] * shards
    for s in sorted(sizes, reverse=True):
        greedy[greedy.index(min(greedy))] += s
    assert spread(sizes, to, shards) <= max(1, max(greedy) - min(greedy))
    sums = sums_of(sizes, to, shards)
    assert sums == sorted(sums, reverse=True)


def test_differencing_follows_the_method_on_distinct_spreads():
    r = random.Random(8)
    for _ in range(50):
        sizes = r.sample(range(1, 10**9), r.randint(1, 12))
        for shards in (2, 3, 4):
            sums = sums_of(sizes, sharding.difference(sizes, shards), shards)
            assert sorted(sums) == sorted(plain_differencing(sizes, shards))


def test_differencing_is_never_far_from_the_best_of_small_lists():
    r = random.Random(9)
    for _ in range(20):
        sizes = [r.randint(1, 60) for _ in range(8)]
        best = min(spread(sizes, t, 2) for t in product(range(2), repeat=8))
        assert spread(sizes, sharding.difference(sizes, 2), 2) <= best + max(sizes)


def check(rows, got, shards):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows
    )
    assert {r["law"] for r in got} <= {"bytes"} and all(r["grown_shard"] is None for r in got)
    by_text, slots = defaultdict(set), defaultdict(list)
    for r in got:
        by_text[r["text_crc32"], r["size"]].add(r["shard"])
        slots[r["shard"]].append((r["slot"], r["doc_id"] if r["doc_id"] is not None else -1))
    assert all(len(s) == 1 for s in by_text.values()) and set(slots) <= set(range(shards))
    for s in slots.values():
        s.sort()
        assert [x for x, _ in s] == list(range(len(s))) and [x for _, x in s] == sorted(x for _, x in s)


def test_groups_stay_together_and_slots_have_no_gaps(spark, docs_of, words):
    r = random.Random(4)
    rows = odd_rows(words) + [(100 + i, " ".join(words(r.randint(1, 60)))) for i in range(600)] + [(900 + i, "copy of a text") for i in range(40)]
    r.shuffle(rows)
    for fine in (2, 1024):
        got = sharding.sharded(docs_of(rows, extra=True).repartition(5), shards=4, fine=fine).collect()
        check(rows, got, 4)
        if fine == 1024:
            sizes = Counter()
            for x in got:
                sizes[x["shard"]] += x["size"]
            # the two long texts that are equal weigh more than a fourth; the rest fills up evenly
            rest = sorted(sizes.values())[:-1]
            assert max(rest) - min(rest) <= 20_000


def test_many_small_groups_are_balanced_to_a_byte_or_two(docs_of, words):
    rows = [(i, " ".join(words(1 + i % 40))) for i in range(2000)]
    got = sharding.sharded(docs_of(rows), shards=16).collect()
    check(rows, got, 16)
    sizes = Counter()
    for x in got:
        sizes[x["shard"]] += x["size"]
    assert max(sizes.values()) - min(sizes.values()) <= 2


def test_a_group_with_most_bytes_is_alone(docs_of, words):
    rows = [(i, "the same text again and again") for i in range(400)] + [(1000 + i, " ".join(words(3))) for i in range(100)]
    got = sharding.sharded(docs_of(rows), shards=4).collect()
    check(rows, got, 4)
    hot = {r["shard"] for r in got if r["doc_id"] < 1000}
    assert len(hot) == 1 and not any(r["shard"] in hot for r in got if r["doc_id"] >= 1000)


def test_empty_table_and_fewer_groups_than_shards(docs_of):
    assert sharding.sharded(docs_of([])).count() == 0
    got = sharding.sharded(docs_of([(1, "a"), (2, "b"), (3, None)])).collect()
    assert len({r["shard"] for r in got}) == 3 and {r["slot"] for r in got} == {0}


def test_written_shards_hold_all_columns(spark, docs_of, words, tmp_path):
    rows = odd_rows(words)
    docs = docs_of(rows, extra=True)
    sharding.write_shards(docs, str(tmp_path / "shards"), shards=4)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert set(back.columns) == {*docs.columns, "shard"}
    assert Counter((r["doc_id"], r["text"]) for r in back.collect()) == Counter(rows)
    assert back.select("text").distinct().count() == back.select("text", "shard").distinct().count()
