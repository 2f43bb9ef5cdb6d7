import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from transitlens.llm import lm_score, lm_tail, lm_tree
from transitlens.llm.common import id_remainder, written

from .conftest import odd_rows

SHARES = {"frequent_share": 2.0**-8, "symbol_share": 2.0**-8, "context_share": 2.0**-9, "pair_share": 2.0**-11}


def corpus(words):
    line = "all rights reserved by the owner of this text"
    rows = [(i, " ".join(words(20)) + (" " + line if i % 2 else "") + " " + " ".join(words(5))) for i in range(400)]
    return rows + [(1000 + i, t) for i, t in odd_rows(words) if i is not None] + [(None, None), (None, "Only Here")]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def test_base_score_and_counts(docs_of, words):
    rows = corpus(words)
    got = lm_score.score(docs_of(rows, extra=True), id_remainder(7) == 2, **SHARES).collect()
    train = Counter(w for i, t in rows if not held(i) for w in lm_score.words(t))
    total, size = sum(train.values()), len(train)
    want = Counter()
    for i, t in rows:
        w = lm_score.words(t)
        base = sum(math.log10((train[x] + 1) / (total + size + 1)) for x in w)
        want[str(i), held(i), len(w), sum(train[x] > 0 for x in w), total, round(base, 6)] += 1
    assert Counter((str(r[0]), *r[1:5], round(r["base_score"], 6)) for r in got) == want
    unseen = [r for r in got if r["held_out"] and r["n_tokens"] > 10]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


def tree_of(docs_of, rows):
    docs = docs_of(rows).withColumn("held_out", F.lit(False))
    return lm_score.train(docs, written(lm_score.count_words(docs), "t"), **SHARES)


def test_every_state_is_a_distribution(docs_of, words):
    tree = tree_of(docs_of, corpus(words))
    base = 10 ** tree.base_log()
    rest = 1 - base.sum()  # words below the frequent share and the unknown one

    def prob(state, symbol):
        key = state * tree.n_symbols + symbol
        at = lm_score.find(tree.pairs, np.array([key]))[0] if state and symbol < tree.n_symbols else -1
        if at >= 0:
            return 10 ** tree.pair_logp[at]
        return 10 ** tree.back[state] * prob(tree.parent[state], symbol) if state else base[symbol]

    def other(state):
        return 10 ** tree.back[state] * other(tree.parent[state]) if state else rest

    assert len(tree.parent) > 3
    for state in range(len(tree.parent)):
        total = sum(prob(state, w) for w in range(len(tree.counts))) + other(state)
        assert abs(total - 1) < 1e-9


def test_longest_suffix_state_scores_the_text(docs_of, words):
    rows = corpus(words)
    tree = tree_of(docs_of, rows)
    base = tree.base_log()
    for _, t in rows[:40]:
        ids = tree.encode(lm_score.words(t))
        want = 0.0
        for k, symbol in enumerate(ids):
            state = 0
            for depth in (1, 2):
                if k >= depth and all(0 <= x < tree.n_symbols for x in ids[k - depth : k]) and len(tree.contexts) >= depth:
                    key = 0
                    for x in ids[k - depth : k]:
                        key = key * tree.n_symbols + int(x)
                    at = lm_score.find(tree.contexts[depth - 1], np.array([key]))[0]
                    state = tree.states[depth - 1][at] if at >= 0 else state
            while state:
                at = lm_score.find(tree.pairs, np.array([state * tree.n_symbols + symbol]))[0] if 0 <= symbol < tree.n_symbols else -1
                if at >= 0:
                    want += tree.pair_logp[at]
                    break
                want += tree.back[state]
                state = tree.parent[state]
            if not state:
                want += base[symbol] if symbol >= 0 else 0.0
        assert abs(lm_score.score_ids(tree, ids, base)[1].sum() - want) < 1e-9


def brute_force_scores(rows, shares, min_count=lm_score.MIN_COUNT, max_depth=lm_score.MAX_DEPTH):
    """log10 probability of every text by plain dictionaries of word tuples."""
    texts = [lm_score.words(t) for _, t in rows]
    train = [w for (i, _), w in zip(rows, texts, strict=True) if not held(i)]
    c, n = Counter(x for w in train for x in w), Counter(x for w in texts for x in w)
    total, size = sum(c.values()), len(c)
    base = lambda w: (c[w] + 1) / (total + size + 1)
    frequent = {w for w in n if n[w] >= shares["frequent_share"] * sum(n.values())}
    symbols = {w for w in frequent if c[w] >= max(shares["symbol_share"] * total, 1)}
    rare_mass = 1 - sum(map(base, frequent))

    states = {(): None}  # context -> (explicit probabilities, rest / rest under the suffix, suffix)

    def suffix_state(context):
        return next(context[k:] for k in range(len(context) + 1) if context[k:] in states)

    def prob(state, w, root=base):
        factor = 1.0
        while state:
            explicit, back, parent = states[state]
            if w in explicit:
                return factor * explicit[w]
            factor, state = factor * back, parent
        return factor * root(w)

    hot = [set()] * (max_depth + 2)
    hot[1] = {(w,) for w in symbols - {lm_score.END} if c[w] >= shares["context_share"] * total}
    for depth in range(1, max_depth + 1):
        after = {s: Counter() for s in hot[depth]}
        whole = {s: 0 for s in hot[depth]}
        for w in train:
            for k in range(depth, len(w)):
                s = tuple(w[k - depth : k])
                if s in after and w[k] in symbols:
                    after[s][w[k]] += 1
        for s in hot[depth]:
            whole[s] = c[s[0]] if depth == 1 else sum(tuple(w[k - depth : k]) == s for w in train for k in range(depth, len(w) + 1))
        grown = {}
        for s, counts in after.items():
            explicit = {w: k for w, k in counts.items() if k >= shares["pair_share"] * total}
            under = suffix_state(s[1:])
            q = {w: prob(under, w) for w in explicit}
            rest, rest_q = max(whole[s] - sum(explicit.values()), 0), max(1 - sum(q.values()), 1e-12)
            kl = sum(k / whole[s] * math.log(k / whole[s] / q[w]) for w, k in explicit.items())
            kl += rest / whole[s] * math.log(rest / whole[s] / rest_q) if rest else 0
            if explicit and kl >= lm_score.MIN_DIVERGENCE and 2 * whole[s] * kl >= lm_score.SIGNIFICANCE * (len(explicit) + 1):
                m = lm_score.PRIOR
                p = {w: (k + m * q[w]) / (whole[s] + m) for w, k in explicit.items()}
                grown[s] = (p, (rest + m * rest_q) / (whole[s] + m) / rest_q, under)
            for w, k in explicit.items():
                if k >= shares["context_share"] * total and w != lm_score.END and (*s[1:], w) in hot[depth]:
                    hot[depth + 1] = hot[depth + 1] | {(*s, w)}
        states.update(grown)

    def leaves(w, k):
        """The shortest context of place k that is not hot, if it lies inside the text."""
        for d in range(1, max_depth + 2):
            if k < d:
                return None
            if tuple(w[k - d : k]) not in hot[d]:
                return tuple(w[k - d : k])
        return None

    symbol = lambda w: w if w in frequent else None
    tail = {}
    for w in train:
        for k in range(len(w)):
            if (s := leaves(w, k)) is not None:
                tail.setdefault(s, Counter())[symbol(w[k])] += 1

    def gain(s, w):
        counts = tail.get(s, Counter())
        whole = sum(counts.values())
        q = lambda x: prob(suffix_state(s[1:]), x, lambda y: rare_mass if y is None else base(y))
        kl = sum(k / whole * math.log(k / whole / q(x)) for x, k in counts.items())
        if whole < min_count or kl < lm_score.MIN_DIVERGENCE or 2 * whole * kl < lm_score.SIGNIFICANCE * (len(counts) + 1):
            return 1.0
        return (counts[w] + lm_score.PRIOR * q(w)) / (whole + lm_score.PRIOR) / q(w)

    out = []
    for w in texts:
        score = 0.0
        for k in range(len(w)):
            inside = [tuple(w[k - d : k]) for d in range(min(max_depth, k), 0, -1)]
            score += math.log10(prob(next((s for s in inside if s in states), ()), w[k]))
            if (s := leaves(w, k)) is not None:
                score += math.log10(gain(s, symbol(w[k])))
        out.append(score)
    return out


def test_scores_equal_a_brute_force_tree(docs_of, words):
    rows = corpus(words) + [(5000 + i, "seen only two times in all these lines zq" + str(i // 2)) for i in range(8)]
    want = Counter((str(i), round(x, 6)) for (i, _), x in zip(rows, brute_force_scores(rows, SHARES), strict=True))
    got = lm_score.score(docs_of(rows, extra=True), id_remainder(7) == 2, **SHARES).collect()
    assert Counter((str(r["doc_id"]), round(r["score"], 6)) for r in got) == want


def test_parts_and_segments_do_not_change_scores(docs_of, words, monkeypatch):
    rows = corpus(words)
    want = brute_force_scores(rows, SHARES)
    monkeypatch.setattr(lm_tail, "HELD", 40)
    monkeypatch.setattr(lm_tail, "SEGMENT", 100)
    docs = docs_of(rows).repartition(3)
    got = lm_score.score(docs, id_remainder(7) == 2, **SHARES).collect()
    assert Counter((str(r["doc_id"]), round(r["score"], 6)) for r in got) == Counter(
        (str(i), round(x, 6)) for (i, _), x in zip(rows, want, strict=True)
    )


def test_a_passage_that_occurs_twice_gains_at_any_size(docs_of, words):
    """Absolute counts: a passage of two training texts scores above its base,
    and above the same passage seen once, however much other text there is."""
    passage = " ".join(f"word{i} under{i}" for i in range(30))
    train_ids = [i for i in range(10**6, 10**6 + 50) if not held(i)]
    for others in (200, 2000):
        background = [(i, " ".join(words(25))) for i in range(others)]
        gains = []
        for copies in (1, 2):
            got = lm_score.score(docs_of(background + [(i, passage) for i in train_ids[:copies]]), id_remainder(7) == 2, **SHARES)
            row = got.filter(f"doc_id = {train_ids[0]}").first()
            gains.append(row["score"] - row["base_score"])
        assert gains[1] > gains[0] + 5


def test_nothing_to_learn_from(docs_of):
    ids = [i for i in range(40) if held(i)]
    got = lm_score.score(docs_of([(i, "a b c") for i in ids]), id_remainder(7) == 2).collect()
    assert len(got) == len(ids) and {r["train_tokens"] for r in got} == {0}
    assert all(r["score"] == r["base_score"] for r in got)


def test_empty_table(docs_of):
    assert lm_score.score(docs_of([]), id_remainder(7) == 2).count() == 0


def test_find_by_table_and_by_search():
    wanted = np.array([5, -1, 0, 7, 10**12, 6, 3, -9], np.int64)
    for keys in ([0, 5, 6], [3, 7, 10**12], [5], []):
        keys = np.array(keys, np.int64)
        want = [{int(k): i for i, k in enumerate(keys)}.get(int(w), -1) for w in wanted]
        assert lm_tree.find(keys, wanted).tolist() == want
        assert lm_tree.find(keys, np.tile(wanted, 50)).tolist() == want * 50
    assert lm_tree.encoded({b"a": 0, b"": 1}, [b"a", b"x", b""]).tolist() == [0, -1, 1]


def test_word_counts_of_both_sides(docs_of):
    train, out = (next(i for i in range(99) if held(i) == side) for side in (False, True))
    docs = docs_of([(train, "a b a"), (out, "a c c"), (train, "b")]).selectExpr("text", f"doc_id = {out} AS held_out")
    got = {bytes(r["word"]): (r["c"], r["n"]) for r in lm_score.count_words(docs).collect()}
    assert got == {b"a": (2, 3), b"b": (2, 2), b"c": (0, 2), b"": (2, 3)}
