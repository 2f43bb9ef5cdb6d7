"""The part of the suffix tree that grows with the corpus.

``lm_score`` broadcasts the contexts that hold a fixed share of all tokens (the
hot ones).  Every other context is kept here, in a table of counts that Spark
partitions by context, whatever its share: a place of a text belongs to its
shortest context that is not hot, i.e. one more word before a hot context
("under" it; the empty context is hot).  All occurrences of such a context meet
in one segment, which counts them, makes the divergence test against the hot
state under it, and returns what the places gain:

    P(w | s) = (c(s, w) + m P(w | under)) / (c(s) + m)

for every w, which sums to 1 because P(. | under) does.  A context is retained
when it occurs at least MIN_COUNT times in the training texts (an absolute
count, so the tree grows with the corpus) and its distribution diverges.
Words below the frequent share are told apart as contexts; as next symbols they
are one class, whose members share its probability as in the base.

A context that is not hot holds less than ``context_share`` of the training
tokens; a segment holds about SEGMENT places and such a context at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices
from .lm_tree import Tree, context_keys, encoded, find, words

MIN_COUNT = 2
#: places a segment holds, about
SEGMENT = 2_000_000
#: places a task holds before it deals them out
HELD = 1_000_000
RARE_WORD = np.uint64(1 << 63)


def packed(values: np.ndarray) -> bytes:
    """The first bytes of all values, then the second ones, compressed: most
    values are small."""
    return zstandard.compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes(), 1)


def unpacked(parts: list[bytes], kind) -> list[np.ndarray]:
    size = np.dtype(kind).itemsize
    flat = (np.frombuffer(zstandard.decompress(x), np.uint8).reshape(size, -1) for x in parts)
    return [np.ascontiguousarray(x.T).view(kind).ravel() for x in flat]


def segment_of(place: np.ndarray, word: np.ndarray, n_segments: int) -> np.ndarray:
    h = (place.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) ^ word * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return (h % np.uint64(n_segments)).astype(np.uint16 if n_segments <= 1 << 16 else np.uint32)


def word_codes(ids: np.ndarray, tokens: list[bytes]) -> np.ndarray:
    """The id of a frequent word, else a marked 63-bit hash."""
    codes = ids.astype(np.uint64)
    rare = np.flatnonzero(ids < 0)
    codes[rare] = np.fromiter(map(xxhash.xxh3_64_intdigest, [tokens[i] for i in rare.tolist()]), np.uint64, len(rare)) | RARE_WORD
    return codes


def tail_places(tree: Tree, ids: np.ndarray, codes: np.ndarray, ends: np.ndarray):
    """(index, hot context under it, word before that) of every place whose
    context leaves the hot ones; ``ends`` marks the ends of texts, which no
    context crosses."""
    n = len(ids)
    under, first = np.zeros(n, np.int64), 1
    alive = np.ones(n, bool)
    found = []
    for depth, keys in enumerate(tree.hot, 1):
        at = find(keys, context_keys(ids, depth, tree.n_symbols))
        leaves = np.flatnonzero(alive & (at < 0))
        leaves = leaves[leaves >= depth]
        leaves = leaves[~ends[leaves - depth]]
        found.append((leaves, under[leaves], codes[leaves - depth]))
        alive &= at >= 0
        under = np.where(alive, first + at, under)
        first += len(keys)
    index, below, word = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(index, kind="stable")
    return index[order], below[order], word[order]


#: of one task's places in one segment: the rows they come from, how many places
#: each has, then by place; a rare word is a mark in ``word`` and a hash in ``rare``
PART = "segment int, who binary, held binary, places binary, under binary, word binary, rare binary, symbol binary"
MARK = np.uint32(0xFFFFFFFF)


def dealt(docs: DataFrame, tree: Tree, n_segments: int) -> DataFrame:
    """All places of docs(who, text, held_out) in packed parts, by segment."""
    shipped = docs.sparkSession.sparkContext.broadcast(vars(tree))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Tree(**shipped.value)
        rare = len(tree.ids)
        held: list[tuple] = []
        who, held_out = [], []

        def flush() -> pa.RecordBatch:
            row, under, word, symbol = (np.concatenate(x) for x in zip(*held, strict=True))
            of = segment_of(under, word, n_segments)
            order = np.argsort(of, kind="stable")
            cuts = np.searchsorted(of[order], np.arange(n_segments + 1))
            ids, sides = np.array(who, np.int64), np.array(held_out, np.uint8)
            out: list[list] = [[] for _ in range(8)]
            for s in np.flatnonzero(np.diff(cuts)).tolist():
                mine = order[cuts[s] : cuts[s + 1]]
                rows, words_ = row[mine], word[mine]  # rows ascend
                first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
                touched, is_rare = rows[first], words_ >= RARE_WORD
                columns = (
                    ids[touched], sides[touched], np.diff(np.append(first, len(rows))).astype(np.uint32), under[mine].astype(np.uint32),
                    np.where(is_rare, MARK, words_).astype(np.uint32), words_[is_rare], symbol[mine],
                )
                for o, x in zip(out, (s, *map(packed, columns)), strict=True):
                    o.append(x)
            held.clear()
            who.clear()
            held_out.clear()
            names = ["segment", "who", "held", "places", "under", "word", "rare", "symbol"]
            return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), *[pa.array(x, pa.binary()) for x in out[1:]]], names=names)

        n_held = 0
        for b in slices(batches):
            tokens, stops = [b""], [1]
            for text in b.column("text").to_pylist():
                tokens += words(text)
                stops.append(len(tokens))
            ids = encoded(tree.ids, tokens)
            ends = np.zeros(len(tokens), bool)
            ends[np.array(stops) - 1] = True
            index, under, word = tail_places(tree, ids, word_codes(ids, tokens), ends)
            row = np.searchsorted(stops, index, side="right") - 1 + len(who)
            held.append((row, under, word, np.where(ids[index] < 0, rare, ids[index]).astype(np.uint32)))
            who += b.column("who").to_pylist()
            held_out += b.column("held_out").to_pylist()
            n_held += len(index)
            if n_held > HELD:
                yield flush()
                n_held = 0
        if held:
            yield flush()

    return docs.select("who", "held_out", "text").mapInArrow(deal, PART)


def under_log(tree: Tree, state: np.ndarray, symbol: np.ndarray, base: np.ndarray) -> np.ndarray:
    """log10 P(symbol | hot state); ``base`` ends with the class of rare words."""
    state, out, open_ = state.copy(), np.zeros(len(state)), np.arange(len(state))
    while len(open_):
        at_root = open_[state[open_] == 0]
        out[at_root] += base[symbol[at_root]]
        open_ = open_[state[open_] > 0]
        w = symbol[open_]
        at = find(tree.pairs, np.where(w < tree.n_symbols, state[open_] * tree.n_symbols + w, -1))
        done = at >= 0
        out[open_[done]] += tree.pair_logp[at[done]]
        open_ = open_[~done]
        out[open_] += tree.back[state[open_]]
        state[open_] = tree.parent[state[open_]]
    return out


def base_with_rare(tree: Tree) -> np.ndarray:
    """log10 of the base of the frequent words, and of all others together."""
    base = tree.base_log()
    least = 1.0 / (tree.total + tree.vocabulary + 1.0)
    return np.append(base, np.log10(max(1.0 - float((10.0**base).sum()), least)))


def segment_gains(
    tree: Tree, under, word, rare, symbol, train, min_count: int, min_divergence: float, significance: float, prior: float
) -> np.ndarray:
    """Gain in log10 of each place of one segment over the hot state under it."""
    n_words = len(tree.ids)
    names, code_of_rare = np.unique(rare, return_inverse=True)
    code = word.astype(np.int64)
    code[word == MARK] = n_words + code_of_rare
    # the bounds of the shares and of a segment keep this below 2 ** 63
    key = (under.astype(np.int64) * (n_words + len(names)) + code) * (n_words + 1) + symbol
    order = np.argsort(key)
    key = key[order]
    pair = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    context_key = key[pair] // (n_words + 1)
    context = np.flatnonzero(np.concatenate([[True], context_key[1:] != context_key[:-1]]))
    context_of = np.repeat(np.arange(len(context)), np.diff(np.append(context, len(pair))))
    c = np.add.reduceat(train[order].astype(np.int64), pair).astype(float)
    total = np.add.reduceat(c, context)
    state = tree.hot_state[under[order][pair].astype(np.int64)]
    log_under = under_log(tree, state, key[pair] % (n_words + 1), base_with_rare(tree))
    with np.errstate(divide="ignore", invalid="ignore"):
        share = c / total[context_of]
        each = np.where(c > 0, share * (np.log(share) - log_under * np.log(10.0)), 0.0)
    divergence = np.add.reduceat(each, context)
    chance = significance * (np.add.reduceat((c > 0).astype(float), context) + 1.0)
    kept = (total >= min_count) & (divergence >= min_divergence) & (2.0 * total * divergence >= chance)
    p = (c + prior * 10.0**log_under) / (total[context_of] + prior)
    gain = np.where(kept[context_of], np.log10(p) - log_under, 0.0)
    out = np.empty(len(key))
    out[order] = np.repeat(gain, np.diff(np.append(pair, len(key))))
    return out


def gains(docs: DataFrame, tree: Tree, min_count: int, min_divergence: float, significance: float, prior: float) -> DataFrame:
    """who, gain: what the contexts beyond the hot ones add to a text's log10
    probability, summed over all rows of that ``who``."""
    n_segments = 32
    while tree.total / n_segments > SEGMENT:
        n_segments *= 2
    shipped = docs.sparkSession.sparkContext.broadcast(vars(tree))

    def add_up(parts: pa.Table) -> pa.Table:
        tree = Tree(**shipped.value)
        read = lambda name, kind: np.concatenate(unpacked(parts.column(name).to_pylist(), kind))
        who, places = read("who", np.int64), read("places", np.uint32)
        row = np.repeat(np.arange(len(who)), places)
        train = ~np.repeat(read("held", np.uint8) > 0, places)
        gain = segment_gains(tree, read("under", np.uint32), read("word", np.uint32), read("rare", np.uint64), read("symbol", np.uint32), train,
                             min_count, min_divergence, significance, prior)
        gain = np.bincount(row, gain, len(who))
        some = np.flatnonzero(gain)
        return pa.table({"who": pa.array(who[some]), "gain": pa.array(gain[some])})

    parts = dealt(docs, tree, n_segments)
    added = parts.groupBy("segment").applyInArrow(add_up, "who long, gain double")
    return added.groupBy("who").agg(F.sum("gain").alias("gain"))
