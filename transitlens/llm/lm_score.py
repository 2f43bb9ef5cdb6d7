"""Language-model scoring with a probabilistic suffix tree over words.

Symbols are the words of a text (A-Z lower-cased, cut at ASCII white space)
and one end.  The tree's root is the add-one unigram distribution ("base").  A
hot context (the last 1 .. ``max_depth`` words, at least ``context_share`` of
the training tokens) is retained when its next-symbol distribution diverges from
that of its longest retained suffix by at least ``min_divergence`` nats.  At a retained context s

    P(w | s) = (c(s, w) + m P(w | suffix)) / (c(s) + m)      explicit w
    P(w | s) = rest(s) P(w | suffix) / (1 - B(s))            all other w

where w is explicit when (s, w) makes up at least ``pair_share`` of the
training tokens, rest(s) is the mass the explicit symbols leave and B(s) the
explicit symbols' mass under the suffix.  Every distribution sums to 1 over
the known symbols and one unknown.  A text is scored at the state of its
longest retained context at each symbol.

The hot contexts are what is broadcast: at any input size there are at most
1/share contexts, pairs and frequent words.  All other contexts (one more word
before a hot one, so up to ``max_depth`` + 1 words) are kept from MIN_COUNT
occurrences on, in a table that Spark partitions by context (``lm_tail``): that
part of the tree grows with the corpus.  All counts are exact and cover every
training text.  Words below the frequent share are joined to the corpus counts
through a shuffle; no such word holds more than ``frequent_share`` of the tokens,
so no key is hot.

Edge cases: null and empty texts have one token, the end; a very long text is
read whole, in one task; a null ``doc_id`` belongs to the training side; repeated
rows each count in training and are scored alike; among words of equal counts
the order of their bytes gives the ids, and no score depends on it; an empty table
gives an empty result; without training texts the score is the base; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_remainder, slices, table, written
from .lm_tail import MIN_COUNT, gains
from .lm_tree import END, Tree, context_keys, encoded, find, words

FREQUENT_SHARE = 2.0**-20
SYMBOL_SHARE = 2.0**-16
CONTEXT_SHARE = 2.0**-14
PAIR_SHARE = 2.0**-20
MIN_DIVERGENCE = 0.01
SIGNIFICANCE = 2.0
PRIOR = 8.0
MAX_DEPTH = 2
#: a task hands on its counts when it holds so many (bounds its memory)
HELD = 200_000


def count_words(docs: DataFrame) -> DataFrame:
    """word, c (training count), n (count in all texts)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bool, Counter] = {False: Counter(), True: Counter()}

        def flush() -> pa.RecordBatch:
            train, other = held[False], held[True]
            # the training words first, then those of other texts only
            c, n = list(train.values()), train
            for w, k in other.items():
                n[w] = n.get(w, 0) + k
            c += [0] * (len(n) - len(c))
            columns = [pa.array(list(n), pa.binary()), pa.array(c, pa.int64()), pa.array(list(n.values()), pa.int64())]
            out = pa.RecordBatch.from_arrays(columns, names=["word", "c", "n"])
            train.clear()
            other.clear()
            return out

        for b in slices(batches):
            for text, out in zip(b.column("text").to_pylist(), b.column("held_out").to_pylist(), strict=True):
                held[out].update(words(text))
            if len(held[False]) + len(held[True]) > HELD:
                yield flush()
        yield flush()

    counted = docs.mapInArrow(count, "word binary, c long, n long")
    return counted.groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


def count_pairs(docs: DataFrame, tree: Tree, depth: int, keys: np.ndarray) -> DataFrame:
    """(candidate context, next symbol) counts at one depth, as
    key = place of the context in ``keys`` * n_symbols + symbol."""
    shipped = docs.sparkSession.sparkContext.broadcast((tree.ids, keys))
    n_symbols = tree.n_symbols

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, contexts = shipped.value
        held, n_held = [], 0

        def flush() -> pa.RecordBatch:
            key, n = np.unique(np.concatenate(held) if held else np.zeros(0, np.int64), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(n.astype(np.int64))], names=["key", "n"])

        for b in slices(batches):
            # ends stand between texts, and no context holds one
            tokens = [w for text in b.column("text").to_pylist() for w in words(text)]
            seen = encoded(ids, tokens)
            at = find(contexts, context_keys(seen, depth, n_symbols))
            ok = (at >= 0) & (seen >= 0) & (seen < n_symbols)
            held.append(at[ok] * n_symbols + seen[ok])
            n_held += len(held[-1])
            if n_held > 8 * HELD:
                yield flush()
                n_held = 0
        yield flush()

    counted = docs.filter(~F.col("held_out")).select("text").mapInArrow(count, "key long, n long")
    return counted.groupBy("key").agg(F.sum("n").alias("n"))


def grow(docs: DataFrame, tree: Tree, context_share, pair_share, min_divergence, prior, max_depth) -> Tree:
    """Add the retained contexts, depth by depth."""
    S = tree.n_symbols
    base = 10.0 ** tree.base_log()
    end = tree.ids.get(END, -1)
    # candidates of depth 1: symbols that often come before another (not the end)
    often = np.flatnonzero(tree.counts[:S] >= context_share * tree.total)
    candidates = {(int(i),): int(tree.counts[i]) for i in often if i != end}
    states: dict[tuple, int] = {}
    parents, backs, explicit = [0], [0.0], []  # by state; explicit: (state, symbols, log10 P)
    probs: dict[int, dict[int, float]] = {0: {}}
    hot_states = [np.zeros(1, np.int64)]

    def sorted_keys(depth: int) -> tuple[list[tuple], np.ndarray]:
        key_of = {c: sum(w * S ** (depth - 1 - i) for i, w in enumerate(c)) for c in candidates}
        ordered = sorted(candidates, key=key_of.get)
        return ordered, np.array([key_of[c] for c in ordered], np.int64)

    def prob(state: int, symbol: int) -> float:
        factor = 1.0
        while state:
            p = probs[state].get(symbol)
            if p is not None:
                return factor * p
            factor *= 10.0 ** backs[state]
            state = parents[state]
        return factor * base[symbol]

    for depth in range(1, max_depth + 1):
        if not candidates:
            break
        ordered, keys = sorted_keys(depth)
        counted = count_pairs(docs, tree, depth, keys).filter(F.col("n") >= F.lit(pair_share * tree.total))
        found = counted.toPandas().sort_values("key")  # at most 1 / pair_share rows
        place, symbol, n = (found["key"] // S).to_numpy(), (found["key"] % S).to_numpy(), found["n"].to_numpy()
        following: dict[tuple, int] = {}
        kept_states = []
        for i, c in enumerate(ordered):
            lo, hi = np.searchsorted(place, [i, i + 1])
            syms, cnt, total = symbol[lo:hi], n[lo:hi].astype(float), float(candidates[c])
            for w, k in zip(syms.tolist(), cnt.tolist(), strict=True):
                if k >= context_share * tree.total and w != end:
                    following[(*c, w)] = int(k)
            parent = next((states[c[k:]] for k in range(1, depth) if c[k:] in states), 0)
            under = np.array([prob(parent, int(w)) for w in syms])
            rest_under = max(1.0 - under.sum(), 1e-12)
            rest = max(total - cnt.sum(), 0.0)
            divergence = float((cnt / total * np.log(cnt / total / under)).sum()) if len(syms) else 0.0
            divergence += rest / total * math.log(rest / total / rest_under) if rest else 0.0
            # the test: large enough, and beyond what chance gives (2 n D is
            # about the number of symbols when both distributions are the same)
            chance = SIGNIFICANCE * (len(syms) + 1)
            if not len(syms) or divergence < min_divergence or 2 * total * divergence < chance:
                continue
            state = len(parents)
            states[c] = state
            p = (cnt + prior * under) / (total + prior)
            parents.append(parent)
            backs.append(math.log10((rest + prior * rest_under) / (total + prior) / rest_under))
            probs[state] = dict(zip(syms.tolist(), p.tolist(), strict=True))
            explicit.append((state, syms, np.log10(p)))
            kept_states.append((keys[i], state))
        tree.contexts.append(np.array([k for k, _ in kept_states], np.int64))
        tree.states.append(np.array([s for _, s in kept_states], np.int64))
        tree.hot.append(keys)
        hot_states.append(np.array([next((states[c[k:]] for k in range(depth) if c[k:] in states), 0) for c in ordered], np.int64))
        # the next depth extends contexts whose own suffix was a candidate here
        candidates = {c: k for c, k in following.items() if c[1:] in candidates}
    tree.hot.append(sorted_keys(len(tree.hot) + 1)[1])
    tree.hot_state = np.concatenate(hot_states)
    tree.parent, tree.back = np.array(parents, np.int64), np.array(backs)
    if explicit:
        keys = np.concatenate([s * S + syms for s, syms, _ in explicit])
        logs = np.concatenate([lp for _, _, lp in explicit])
        order = np.argsort(keys)
        tree.pairs, tree.pair_logp = keys[order], logs[order]
    return tree


def train(docs: DataFrame, vocabulary: DataFrame, frequent_share=FREQUENT_SHARE, symbol_share=SYMBOL_SHARE, context_share=CONTEXT_SHARE,
          pair_share=PAIR_SHARE, min_divergence=MIN_DIVERGENCE, prior=PRIOR, max_depth=MAX_DEPTH) -> Tree:
    """The tree of docs(text, held_out), given the written word counts."""
    sums = vocabulary.agg(F.sum("c"), F.sum("n"), F.sum((F.col("c") > 0).cast("long"))).first()
    total, seen, size = (int(x or 0) for x in sums)
    # at most 1 / frequent_share words
    often = vocabulary.filter(F.col("n") >= F.lit(frequent_share * seen)).toPandas().sort_values(["c", "word"], ascending=[False, True])
    counts = often["c"].to_numpy(np.int64)
    n_symbols = max(int((counts >= max(symbol_share * total, 1)).sum()), 1)
    ids = {bytes(w): i for i, w in enumerate(often["word"])}
    tree = Tree(ids, counts, n_symbols, total, size)
    return grow(docs, tree, context_share, pair_share, min_divergence, prior, max_depth) if total else tree


def score_ids(tree: Tree, ids: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(base, model) log10 of each of some texts' frequent words; the model's
    part holds the back-off factors of rare words too, whose base part is joined
    later.  Texts may follow one another: no context holds an end."""
    S = tree.n_symbols
    known = ids >= 0
    base_log = np.where(known, base[np.maximum(ids, 0)], 0.0) if len(base) else np.zeros(len(ids))
    state = np.zeros(len(ids), np.int64)
    for depth, (keys, states) in enumerate(zip(tree.contexts, tree.states, strict=True), 1):
        at = find(keys, context_keys(ids, depth, S))
        state = np.where(at >= 0, states[at] if len(states) else 0, state)
    model, open_ = base_log.copy(), np.flatnonzero(state)
    model[open_] = 0.0
    while len(open_):
        symbol = ids[open_]
        explicit = find(tree.pairs, np.where((symbol >= 0) & (symbol < S), state[open_] * S + symbol, -1))
        model[open_[explicit >= 0]] += tree.pair_logp[explicit[explicit >= 0]]
        open_ = open_[explicit < 0]
        model[open_] += tree.back[state[open_]]
        state[open_] = tree.parent[state[open_]]
        at_root = state[open_] == 0
        model[open_[at_root]] += base_log[open_[at_root]]
        open_ = open_[~at_root]
    return base_log, model


ROWS = (
    "who long, doc_id long, held_out boolean, n_tokens long, n_frequent long, base_sum double, model_sum double, "
    "rare array<binary>, rare_n array<int>"
)


def score_rows(docs: DataFrame, tree: Tree) -> DataFrame:
    """One row per text: what the frequent words give, and the rare words."""
    # as plain values: executors need not have this package
    shipped = docs.sparkSession.sparkContext.broadcast(vars(tree))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Tree(**shipped.value)
        base, counted = tree.base_log(), tree.counts > 0
        for b in slices(batches):
            tokens, starts = [], []
            for text in b.column("text").to_pylist():
                starts.append(len(tokens))
                tokens += words(text)
            ids = tree.encode(tokens)
            n_tokens = np.diff([*starts, len(tokens)])
            known = np.where(ids >= 0, counted[np.maximum(ids, 0)], False) if len(counted) else np.zeros(len(ids), bool)
            base_sum, model_sum = (np.add.reduceat(x, starts) for x in score_ids(tree, ids, base))
            places = np.flatnonzero(ids < 0)
            rare, cuts = [tokens[i] for i in places.tolist()], np.searchsorted(places, [*starts, len(tokens)]).tolist()
            others = [Counter(rare[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("who"), b.column("doc_id"), b.column("held_out"), pa.array(n_tokens, pa.int64()),
                    pa.array(np.add.reduceat(known.astype(np.int64), starts)), pa.array(base_sum), pa.array(model_sum),
                    pa.array([list(o) for o in others], pa.list_(pa.binary())), pa.array([list(o.values()) for o in others], pa.list_(pa.int32())),
                ],
                names=["who", "doc_id", "held_out", "n_tokens", "n_frequent", "base_sum", "model_sum", "rare", "rare_n"],
            )

    return docs.mapInArrow(score, ROWS)


def score(docs: DataFrame, held_out, min_count: int = MIN_COUNT, **shares) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    vocabulary = written(count_words(rows), "word-counts")
    tree = train(rows, vocabulary, **shares)
    # rows of one id and text score alike, so they share a number
    rows = rows.withColumn("who", F.xxhash64("doc_id", "text", "held_out"))
    scored = written(score_rows(rows, tree).withColumn("row_id", F.monotonically_increasing_id()), "scored")
    rare = scored.select("row_id", F.explode(F.arrays_zip("rare", "rare_n")).alias("r"))
    rare = rare.select("row_id", F.col("r.rare").alias("word"), F.col("r.rare_n").alias("k"))
    c = F.coalesce(F.col("c"), F.lit(0))
    log_base = F.log10((c + 1) / F.lit(float(tree.total + tree.vocabulary + 1)))
    sums = (
        rare.join(vocabulary.select("word", "c"), "word", "left")
        .groupBy("row_id")
        .agg(F.sum(F.col("k") * log_base).alias("rare_sum"), F.sum(F.when(c > 0, F.col("k")).otherwise(0)).alias("n_rare"))
    )
    extra = F.coalesce("rare_sum", F.lit(0.0))
    out = scored.drop("rare", "rare_n").join(sums, "row_id", "left")
    gain = F.lit(0.0)
    if tree.total:
        gained = gains(
            rows, tree, min_count, shares.get("min_divergence", MIN_DIVERGENCE), SIGNIFICANCE, shares.get("prior", PRIOR)
        )
        copies = scored.groupBy("who").agg(F.count("*").alias("copies"))
        out = out.join(copies.join(gained, "who"), "who", "left")
        gain = F.coalesce(F.col("gain") / F.col("copies"), F.lit(0.0))
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_frequent") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(tree.total).cast("long").alias("train_tokens"),
        (F.col("base_sum") + extra).alias("base_score"),
        (F.col("model_sum") + extra + gain).alias("score"),
    )


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), id_remainder(7) == 2)
