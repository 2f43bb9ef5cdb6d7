import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from transitlens.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string, v int, n string, part int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", 1, "x", 1) for r in rows], SCHEMA)


def brute(rows, parts=8, entries=16, rounds=6):
    kept = [(i, [math.floor(4096 * x) for x in np.array(v, np.float32).tolist()], l) for i, v, l in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return Counter()
    d = len(kept[0][1])
    cut = lambda v: [v[p * d // parts : (p + 1) * d // parts] for p in range(parts)]
    cells = [cut(v) for _, v, _ in kept]
    books = [[c[p] for c in cells[:entries]] for p in range(parts)]

    def near(p, sub):
        return min((sum((a - b) ** 2 for a, b in zip(sub, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        sums = defaultdict(list)
        for c in cells:
            for p in range(parts):
                sums[p, near(p, c[p])[1]].append(c[p])
        for (p, k), subs in sums.items():
            books[p][k] = [sum(x) // len(subs) for x in zip(*subs, strict=True)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [[near(p, c[p]) for p in range(parts)] for c in cells]
    errors = [sum(x for x, _ in f) for f in found]
    by_label = Counter()
    for (_, _, l), e in zip(kept, errors, strict=True):
        by_label[l] += e
    return Counter((i, "".join(f"{k:02x}" for _, k in f), e, by_label[l], sha) for (i, _, l), f, e in zip(kept, found, errors, strict=True))


def got(df):
    return Counter(map(tuple, df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()))


def vectors(n, dims=16, seed=3, spread=1.0):
    r = random.Random(seed)
    return [(i, [r.gauss(0, spread) for _ in range(dims)], r.choice([None, 0, 1, 1, 1, 2])) for i in range(n)]


def test_matches_brute_force_with_odd_rows(spark):
    rows = vectors(90)
    rows += [(500, None, 1), (501, [None] + [0.0] * 15, 1), (502, [math.nan] * 16, 1), (503, [math.inf] + [0.0] * 15, 1)]
    rows += [(7, rows[7][1], rows[7][2]), (7, [0.0] * 16, 2), (None, [0.25] * 16, None), (None, [0.25] * 16, 3), (600, [-1e-9] * 16, 5)]
    random.Random(1).shuffle(rows)
    assert got(vc.compressed(frame(spark, rows).repartition(5))) == brute(rows)


def test_ties_go_to_the_lower_index(spark):
    # few distinct values: many equal distances and equal entries
    r = random.Random(5)
    rows = [(i, [r.choice([-1.0, 0.0, 1.0]) for _ in range(16)], i % 3) for i in range(120)]
    assert got(vc.compressed(frame(spark, rows))) == brute(rows)


@pytest.mark.parametrize("dims", [8, 11])
def test_few_vectors_and_uneven_parts(spark, dims):
    rows = vectors(5, dims)
    assert got(vc.compressed(frame(spark, rows))) == brute(rows)


def test_other_lengths_are_dropped_and_empty_tables_give_no_rows(spark):
    rows = vectors(30)
    odd = [(1000, [1.0, 2.0], 1), (1001, [], 1)]
    assert got(vc.compressed(frame(spark, rows + odd))) == brute(rows)
    assert vc.compressed(frame(spark, [])).count() == 0
    assert vc.compressed(frame(spark, [(1, None, 1)])).count() == 0


def test_components_that_do_not_fit_raise(spark):
    with pytest.raises(Exception, match="beyond"):
        vc.compressed(frame(spark, [(1, [1e9] * 8, 1)])).count()


def test_tree_finds_what_brute_force_finds_with_fewer_distances():
    r = np.random.default_rng(2)
    centres = r.integers(-50_000, 50_000, (8, 6))
    entries = (centres[r.integers(0, 8, 64)] + r.integers(-50, 50, (64, 6))).astype(np.int64)
    entries[10] = entries[3]
    queries = np.concatenate([entries, entries + r.integers(-60, 60, entries.shape), r.integers(-60_000, 60_000, (200, 6))])
    search = vc.Search(entries, vc.build_tree(entries))
    index, d = search.nearest(queries)
    every = ((queries[:, None, :] - entries[None]) ** 2).sum(2)
    assert (index == every.argmin(1)).all() and (d == every.min(1)).all()
    assert search.computed < 0.7 * every.size


def test_ranges_enclose_all_distances_below():
    r = np.random.default_rng(4)
    entries = r.integers(-3000, 3000, (40, 8)).astype(np.int64)

    def below(node):
        out = [[s] for s in node.splits]
        for j, c in enumerate(node.children):
            if c is not None:
                inner = below(c)
                for i, s in enumerate(node.splits):
                    for m in [x for g in inner for x in g]:
                        x = float(np.sqrt(((entries[s] - entries[m]) ** 2).sum()))
                        assert node.low[i, j] <= x <= node.high[i, j]
                out[j] += [x for g in inner for x in g]
        return out

    assert sorted(x for g in below(vc.build_tree(entries)) for x in g) == list(range(40))


def test_decoded_vectors_are_the_entries(spark):
    rows = frame(spark, vectors(40))
    ints = vc.integer_vectors(rows)
    books, _ = vc.train(ints)
    both = vc.decode(vc.encode(ints, books), books).join(ints.select("vec_id", "v"), "vec_id").collect()
    for r in both:
        back = [round(x * vc.SCALE) for x in r["restored"]]
        assert sum((a - b) ** 2 for a, b in zip(back, r["v"], strict=True)) == r["error"]
