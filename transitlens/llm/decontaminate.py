"""Benchmark decontamination under edit distance.

Texts and items are lower-cased and their white space made single spaces.
The windows of a text begin at every ``STRIDE``-th word; an item is indexed
from each of its word starts with ``WALK`` characters left.  A planted copy of
an item with at least ``WINDOWS`` * ``STRIDE`` such starts meets ``WINDOWS`` of
them aligned, wherever in the text it begins.

CGK embedding: a random walk reads a window; at step t it writes the current
character and moves on by one if a hash of (t, character) says so.  Strings a
small edit distance apart give walks a small Hamming distance apart, as walks
fall in step again after an edit.  Bit-sampling LSH: ``BITS`` sampled
coordinates of the walk are the bucket of a window.  It is repeated with
independent walks and samples, ``repeats_for_recall`` times, as often as the
items with the fewest aligned windows need, whatever else is in the block.

Anchors: every item with a start is searched for by walks.  Items with fewer
than those starts (short ones, unspaced script) meet too few aligned windows for
the target recall; they are cut into
one piece more than the edits allowed as well, so one piece of any copy is unchanged.
The pieces are searched for at every character; a piece's neighbour must be
there with one edit at most, as some pair of pieces has no more.  No copy of
such an item is lost.  A longer item has one anchor, the rarest of the block,
which finds each of its unchanged copies.

Windows that share a bucket with an item, and whose whole embedding is near the
item's in Hamming distance, are verified exactly: the edit
distance of the whole item to the best part of the item-sized region around
the window or anchor (bit-parallel, in one pass over the region) must be at most
``EDIT_SHARE`` of the item's length.

The items are a stated query set; they are collected in blocks of about
``BLOCK`` items, one block at a time, and each block meets all texts in a pass
without a shuffle.  With several blocks, a pass writes only what it finds, by
(doc_id, SHA-256 of the text), and the findings meet the documents at the end.

Edge cases: null and empty texts are clean; null and empty items are never
found; items without an ``item_id`` are searched for like others and reported
as a null id (of one document once, with the least edits); items that share an
id are reported once, with the least edits; items too short for an edit are
searched for as they are; texts of any length are searched whole; repeated rows
are judged alike, and so are rows that share a ``doc_id`` but not a text; an
empty benchmark leaves all documents clean; an empty table gives an empty result; other
columns are kept by :func:`drop_contaminated` and ignored by the report.
"""

from __future__ import annotations

import itertools
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table, worker_memory, written

EDIT_SHARE = 0.1
RECALL = 0.95
STRIDE = 4
#: aligned windows that an item has at least if it is searched for by walks
WINDOWS = 8
BITS = 8
WALK = 48
#: a window and an item that share a bucket are compared further when at most
#: this share of their walks differs (at the largest edit distance about 0.3 does)
HAMMING_SHARE = 0.4
#: coordinates taken from the first steps, which sort out most windows
EARLY_BITS, EARLY_STEPS = 4, 16
GRAM = 5
#: characters of a piece, and of its neighbour, that are compared
PIECE = 24
BLOCK = 20_000
SEED = 20_240
TABLE = 1 << 18
MIX = np.uint64(0x9E3779B97F4A7C15)


def normalised(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def repeats_for_recall(item_words: float, edit_share: float = EDIT_SHARE, recall: float = RECALL) -> int:
    """Independent walks needed so that some aligned window of an item at the
    largest allowed distance shares its bucket with the given probability.

    An edit disturbs about three coordinates of the walk, so at the largest
    distance a coordinate agrees with probability 1 - 3 * edit_share; an item
    has words / STRIDE aligned windows.
    """
    same = (1 - min(3 * edit_share, 0.9)) ** BITS
    tries = math.log(1 - recall) / math.log(1 - same)
    return max(4, math.ceil(tries / max(item_words / STRIDE, 1)))


def pieces(length: int, n: int) -> list[int]:
    """Borders of n pieces: pairs of equal length, and with an odd n a last
    piece on its own that is longer."""
    units = n if n % 2 == 0 else n + 0.6
    return [*(int(i * length / units) for i in range(n)), length]


def symbols(joined: str) -> np.ndarray:
    """One byte per character (code points folded), padded for walks off the end."""
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    folded = (points ^ (points >> 8)).astype(np.uint8)
    return np.concatenate([folded, np.zeros(WALK + 1, np.uint8)])


class Walks:
    """The random moves and sampled coordinates, the same on every executor."""

    def __init__(self, repeats: int):
        rng = np.random.default_rng(SEED)
        self.moves = [rng.integers(0, 2, (WALK, 256), dtype=np.uint8) for _ in range(repeats)]
        self.early = [frozenset(rng.choice(EARLY_STEPS, EARLY_BITS, replace=False).tolist()) for _ in range(repeats)]
        self.late = [
            frozenset((EARLY_STEPS + rng.choice(WALK - EARLY_STEPS, BITS - EARLY_BITS, replace=False)).tolist()) for _ in range(repeats)
        ]

    def embed(self, r: int, text: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The whole embedding, one row per window."""
        out = np.empty((len(at), WALK), np.uint8)
        for t in range(WALK):
            out[:, t] = text[at]
            at = at + self.moves[r][t][out[:, t]]
        return out

    def run(self, r: int, text: np.ndarray, at: np.ndarray, key: np.ndarray, first: int, last: int, sample) -> tuple[np.ndarray, np.ndarray]:
        """Walk steps first .. last - 1; returns places and bucket keys."""
        moves = self.moves[r]
        last_sampled = max(sample)
        for t in range(first, last):
            c = text[at]
            if t in sample:
                key = (key + c + np.uint64(1)) * MIX
                key ^= key >> np.uint64(29)
            if t == last_sampled and last == WALK:
                break
            at = at + moves[t][c]
        return at, key


def grams(text: np.ndarray, n: int) -> np.ndarray:
    """The n <= 8 bytes from each place on, as one number."""
    padded = text.tobytes() + bytes(8)
    return np.ndarray((len(text),), "<u8", buffer=padded, strides=(1,)) & np.uint64((1 << 8 * n) - 1)


def leading(equal: np.ndarray) -> np.ndarray:
    """How many of the first columns are true."""
    return np.where(equal.all(axis=1), equal.shape[1], (~equal).argmax(axis=1))


class Anchors:
    """Pieces of items, of which the first ``size`` bytes are looked up at
    every place of a text.  Entries: (item, its symbols, begin, end, and begin
    and end of the neighbour; an empty one for a piece on its own)."""

    CHUNK = 1 << 20

    def __init__(self, size: int, entries: list[tuple[int, np.ndarray, int, int, int, int]]):
        self.size, n = size, len(entries)
        keys = np.zeros(n, np.uint64)
        self.owner, self.offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.piece, self.beside = np.zeros((n, PIECE), np.uint8), np.zeros((n, PIECE), np.uint8)
        self.length, self.reach = np.zeros(n, np.int64), np.zeros(n, np.int64)
        # where the neighbour begins, from the piece's begin, and which way it is read
        self.turn, self.way = np.zeros(n, np.int64), np.ones(n, np.int64)
        for k, (item, text, a, b, c, d) in enumerate(entries):
            keys[k] = int.from_bytes(text[a : a + size].tobytes(), "little")
            self.owner[k], self.offset[k] = item, a
            self.length[k], self.reach[k] = min(b - a, PIECE), min(d - c, PIECE)
            self.piece[k, : self.length[k]] = text[a:b][:PIECE]
            near = text[c:d] if c >= a else text[c:d][::-1]
            self.beside[k, : self.reach[k]] = near[:PIECE]
            self.turn[k], self.way[k] = (b - a, 1) if c >= a else (-1, -1)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        for name in ("owner", "offset", "piece", "beside", "length", "reach", "turn", "way"):
            setattr(self, name, getattr(self, name)[order])
        self.shift = np.uint64(64 - max(18, (16 * n).bit_length()))
        self.gate = np.zeros(1 << (64 - int(self.shift)), bool)
        self.gate[(self.keys * MIX) >> self.shift] = True

    def find(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, entry) of every piece that is there beside its neighbour."""
        places, entries = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        padded = np.concatenate([np.zeros(PIECE + 2, np.uint8), text, np.zeros(2 * PIECE + 2, np.uint8)])
        for first in range(0, len(text), self.CHUNK):
            key = grams(text[first : first + self.CHUNK + 8], self.size)[: self.CHUNK]
            through = np.flatnonzero(self.gate[(key * MIX) >> self.shift])
            key = key[through]
            lo = np.searchsorted(self.keys, key, "left")
            n = np.searchsorted(self.keys, key, "right") - lo
            at = np.repeat(through + first, n)
            e = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
            for part in range(0, len(at), self.CHUNK >> 4):
                p, x = self.there(padded, at[part : part + (self.CHUNK >> 4)], e[part : part + (self.CHUNK >> 4)])
                places.append(p)
                entries.append(x)
        return np.concatenate(places), np.concatenate(entries)

    def there(self, padded: np.ndarray, at: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        step, zero = np.arange(PIECE), PIECE + 2
        same = (padded[zero + at[:, None] + step] == self.piece[e]) | (step >= self.length[e][:, None])
        ok = same.all(axis=1)
        at, e = at[ok], e[ok]
        # the neighbour with one edit at most: equal up to the edit, and after
        # it as it is (replaced) or moved by one (left out, put in)
        reach = self.reach[e]
        start, way, beside = zero + at + self.turn[e], self.way[e][:, None], self.beside[e]
        beyond = step >= reach[:, None]
        equal = [(padded[start[:, None] + way * (step + move)] == beside) | beyond for move in (0, -1, 1)]
        before = leading(equal[0])
        after = [leading(q[:, ::-1]) - (PIECE - reach) for q in equal]
        left = reach - before
        ok = (before >= reach) | (after[0] >= left - 1) | (after[1] >= left - 1) | (after[2] >= left)
        return at[ok], e[ok]


class Index:
    """Buckets and anchors of one block of items."""

    def __init__(self, items: list[tuple[int, str]], edit_share: float):
        self.items = [(i, normalised(t)) for i, t in items]
        self.limit = [int(edit_share * len(t)) for _, t in self.items]
        # items too short for an edit are searched for as they are
        self.short = [k for k, (_, t) in enumerate(self.items) if 0 < len(t) < WALK and not self.limit[k]]
        self.walks = Walks(repeats_for_recall(WINDOWS * STRIDE, edit_share))
        self.masks: dict[int, dict[str, int]] = {}
        self.grams: dict[int, list[str]] = {}
        owner, offset, places, text, base = [], [], [], [], 0
        walked, cut = [], []
        for k, (_, t) in enumerate(self.items):
            starts = [o for o in (0, *[j + 1 for j, c in enumerate(t) if c == " "]) if len(t) - o >= WALK]
            if len(starts) < WINDOWS * STRIDE:
                if self.limit[k] or len(t) >= WALK:
                    cut.append(k)
            else:
                walked.append(k)
            if not starts:
                continue
            for o in starts:
                owner.append(k)
                offset.append(o)
                places.append(base + o)
            text.append(t)
            base += len(t) + 1
        self.anchors = self.anchored(cut, walked)
        self.owner, self.offset = np.array(owner, np.int64), np.array(offset, np.int64)
        joined, places = symbols("\0".join(text)), np.array(places, np.int64)
        self.gates, self.keys, self.at, self.embedded = [], [], [], []
        for r in range(len(self.walks.moves)):
            pos, key = self.walks.run(r, joined, places, np.zeros(len(places), np.uint64), 0, EARLY_STEPS, self.walks.early[r])
            gate = np.zeros(TABLE, bool)
            gate[key & np.uint64(TABLE - 1)] = True
            _, key = self.walks.run(r, joined, pos, key, EARLY_STEPS, WALK, self.walks.late[r])
            order = np.argsort(key, kind="stable")
            self.gates.append(gate)
            self.keys.append(key[order])
            self.at.append(order)
            self.embedded.append(self.walks.embed(r, joined, places)[order])

    def anchored(self, cut: list[int], walked: list[int]) -> list[Anchors]:
        """Anchors by the bytes looked up: all pieces of the items ``cut``, the
        rarest part of those ``walked``."""
        by_size: dict[int, list] = {}
        for k in cut:
            text, n = symbols(self.items[k][1]), self.limit[k] + 1
            borders = pieces(len(self.items[k][1]), n)
            size = min(8, min(b - a for a, b in zip(borders, borders[1:])))
            for i in range(n):
                other = i ^ 1 if i ^ 1 < n else None
                beside = (borders[other], borders[other + 1]) if other is not None else (borders[i + 1], borders[i + 1])
                by_size.setdefault(size, []).append((k, text, borders[i], borders[i + 1], *beside))
        places = {k: grams(symbols(self.items[k][1]), 8)[: len(self.items[k][1]) - PIECE + 1] for k in walked}
        if walked:
            seen, n = np.unique(np.concatenate(list(places.values())), return_counts=True)
            for k in walked:
                o = int(np.argmin(n[np.searchsorted(seen, places[k])]))
                by_size.setdefault(8, []).append((k, symbols(self.items[k][1]), o, o + PIECE, o + PIECE, o + PIECE))
        return [Anchors(size, entries) for size, entries in sorted(by_size.items()) if size]

    def candidates(self, texts: list[str]) -> set[tuple[int, int, int]]:
        """(text, item, where the item would begin) of all shared buckets and anchors."""
        joined = symbols("\0".join(texts))
        begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])[:-1]]).astype(np.int64)
        found: set[tuple[int, int, int]] = set()
        for anchors in self.anchors:
            at, e = anchors.find(joined[: -WALK - 1])
            text = np.searchsorted(begins, at, "right") - 1
            begin = at - begins[text] - anchors.offset[e]
            found.update(zip(text.tolist(), anchors.owner[e].tolist(), begin.tolist(), strict=True))
        if not self.owner.size:
            return found
        spaces = np.flatnonzero(joined[: -WALK - 1] == 32) + 1
        starts = np.sort(np.concatenate([spaces, begins]))
        owner = np.searchsorted(begins, starts, "right") - 1
        rank = np.arange(len(starts)) - np.searchsorted(starts, begins)[owner]
        chosen = rank % STRIDE == 0
        starts, owner = starts[chosen], owner[chosen]
        for r in range(len(self.walks.moves)):
            at, key = self.walks.run(r, joined, starts, np.zeros(len(starts), np.uint64), 0, EARLY_STEPS, self.walks.early[r])
            through = np.flatnonzero(self.gates[r][key & np.uint64(TABLE - 1)])
            if not len(through):
                continue
            _, key = self.walks.run(r, joined, at[through], key[through], EARLY_STEPS, WALK, self.walks.late[r])
            lo, hi = np.searchsorted(self.keys[r], key, "left"), np.searchsorted(self.keys[r], key, "right")
            n = hi - lo
            if not n.any():
                continue
            # all (window, item start) pairs of equal buckets, then those whose
            # embeddings are near in Hamming distance
            w = np.repeat(np.arange(len(n)), n)
            e = np.arange(len(w)) - np.repeat(np.cumsum(n) - n, n) + lo[w]
            hit = np.flatnonzero(n)
            walked = self.walks.embed(r, joined, starts[through[hit]])[np.searchsorted(hit, w)]
            near = (walked != self.embedded[r][e]).sum(axis=1) <= HAMMING_SHARE * WALK
            window, entry = through[w[near]], self.at[r][e[near]]
            begin = starts[window] - begins[owner[window]] - self.offset[entry]
            found.update(zip(owner[window].tolist(), self.owner[entry].tolist(), begin.tolist(), strict=True))
        return found

    def distance(self, item: int, region: str) -> int:
        """Least edit distance of the item to any part of the region; the
        item's length stands for any distance beyond the limit."""
        pattern = self.items[item][1]
        if pattern in region:
            return 0
        # an edit changes at most GRAM of the item's grams, so an item within
        # the limit keeps this many of them; what has fewer is beyond it
        least = len(pattern) - GRAM + 1 - GRAM * self.limit[item]
        if least > 0:
            there = {region[j : j + GRAM] for j in range(len(region) - GRAM + 1)}
            grams = self.grams.get(item)
            if grams is None:
                grams = self.grams[item] = [pattern[j : j + GRAM] for j in range(len(pattern) - GRAM + 1)]
            if sum(map(there.__contains__, grams)) < least:
                return len(pattern)
        mask = self.masks.get(item)
        if mask is None:
            mask = {}
            for i, c in enumerate(pattern):
                mask[c] = mask.get(c, 0) | 1 << i
            self.masks[item] = mask
        full, top = (1 << len(pattern)) - 1, 1 << (len(pattern) - 1)
        up, down, score = full, 0, len(pattern)
        best = score
        for c in region:
            eq = mask.get(c, 0)
            xv = eq | down
            xh = (((eq & up) + up) ^ up) | eq
            ph, mh = down | ~(xh | up) & full, up & xh
            if ph & top:
                score += 1
            elif mh & top:
                score -= 1
            ph, mh = (ph << 1) & full, (mh << 1) & full
            up, down = mh | ~(xv | ph) & full, ph & xv
            best = min(best, score)
        return best

    def hits(self, texts: list[str | None]) -> list[dict[int, int]]:
        """Per text: item id -> edit distance, of every item found."""
        plain = [normalised(t) for t in texts]
        out: list[dict[int, int]] = [{} for _ in texts]
        if self.owner.size or self.anchors:
            tried: set[tuple[int, int, int]] = set()
            for d, k, begin in sorted(self.candidates(plain)):
                item, near = self.items[k], begin // max(self.limit[k], 8)
                if (d, k, near) in tried or out[d].get(item[0], 1) == 0:
                    continue
                tried.add((d, k, near))
                slack = 3 * self.limit[k] + 8
                edits = self.distance(k, plain[d][max(0, begin - slack) : begin + len(item[1]) + slack])
                if edits <= self.limit[k] and edits < out[d].get(item[0], edits + 1):
                    out[d][item[0]] = edits
        for k in self.short:
            for d, t in enumerate(plain):
                if self.items[k][1] in t:
                    out[d][self.items[k][0]] = 0
        return out


def item_blocks(items: DataFrame, block: int) -> Iterator[list[tuple[int | None, str]]]:
    """The query set in blocks of about ``block`` items, one at a time on the driver."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter(F.col("text").isNotNull())
    parts = max(1, math.ceil(rows.count() / block))
    # the hash of the text alone: items that share an id may be in different blocks
    part = F.pmod(F.xxhash64("text"), F.lit(parts))
    for k in range(parts):
        yield [(r[0], r[1]) for r in (rows.filter(part == k) if parts > 1 else rows).orderBy("item_id", "text").collect()]


def index_of(shipped, key: str, edit_share: float) -> Index:
    return worker_memory("decontamination", key, lambda: Index(shipped.value, edit_share))


FOUND = "item_ids array<long>, edits array<int>"


def search_block(docs: DataFrame, part: list[tuple[int | None, str]], edit_share: float) -> DataFrame:
    """docs without its text, which is the last column, and with what is found
    of one block: item_ids, edits (smallest id first, the null id last)."""
    shipped, key = docs.sparkSession.sparkContext.broadcast(part), uuid.uuid4().hex
    names = docs.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = index_of(shipped, key, edit_share)
        for b in slices(batches):
            found = [sorted(f.items(), key=lambda x: (x[0] is None, x[0])) for f in index.hits(b.column(len(names)).to_pylist())]
            lists = [pa.array([[x[i] for x in f] for f in found], pa.list_(t)) for i, t in enumerate((pa.int64(), pa.int32()))]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(names))), *lists], names=[*names, "item_ids", "edits"])

    schema = ", ".join([*(f"{n} {t}" for n, t in docs.dtypes[:-1]), FOUND])
    return docs.mapInArrow(run, schema)


def text_digest() -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256))


def all_findings(docs: DataFrame, first: list, blocks: Iterator[list], edit_share: float) -> DataFrame:
    """digest, id, item_ids, edits of the contaminated documents, over several
    blocks; what a block finds is written before the next one is collected."""
    keyed = docs.select(text_digest().alias("digest"), F.col("doc_id").cast("long").alias("id"), "text")
    found = None
    for part in itertools.chain([first], blocks):
        hits = search_block(keyed, part, edit_share).filter(F.size("item_ids") > 0)
        hits = written(hits, "contaminated").select("digest", "id", F.explode(F.arrays_zip("item_ids", "edits")).alias("f"))
        found = hits if found is None else found.unionByName(hits)
    least = found.groupBy("digest", "id", F.col("f.item_ids").alias("item")).agg(F.min("f.edits").alias("n"))
    # as many entries as a document holds items
    listed = F.sort_array(F.collect_list(F.struct(F.col("item").isNull().alias("none"), "item", "n")))
    each = least.groupBy("digest", "id").agg(listed.alias("l"))
    return each.select("digest", "id", F.col("l.item").alias("item_ids"), F.col("l.n").alias("edits"))


def contamination(docs: DataFrame, items: DataFrame, edit_share: float = EDIT_SHARE, block: int = BLOCK) -> DataFrame:
    """doc_id, contaminated, n_items, item_ids, edits: one row per document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    blocks = item_blocks(items, block)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        report = search_block(rows, first, edit_share)
    else:
        found = all_findings(rows, first, itertools.chain([second], blocks), edit_share)
        rows = rows.select("doc_id", text_digest().alias("text_digest"))
        same = (F.col("text_digest") == F.col("digest")) & F.col("doc_id").eqNullSafe(F.col("id"))
        ids, edits = (F.coalesce(c, F.array().cast(t)).alias(c) for c, t in (("item_ids", "array<long>"), ("edits", "array<int>")))
        report = rows.join(found, same, "left").select("doc_id", ids, edits)
    n = F.size("item_ids")
    return report.select("doc_id", (n > 0).alias("contaminated"), n.cast("long").alias("n_items"), "item_ids", "edits")


def drop_contaminated(docs: DataFrame, items: DataFrame, edit_share: float = EDIT_SHARE, block: int = BLOCK) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    blocks = item_blocks(items, block)
    first, second = next(blocks), next(blocks, None)
    if second is not None:
        found = all_findings(docs, first, itertools.chain([second], blocks), edit_share)
        found = found.select(F.col("digest").alias("__digest"), F.col("id").alias("__id"))
        same = (text_digest() == F.col("__digest")) & F.col("doc_id").cast("long").eqNullSafe(F.col("__id"))
        return docs.join(found, same, "left_anti")
    place = docs.columns.index("text")
    shipped, key = docs.sparkSession.sparkContext.broadcast(first), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = index_of(shipped, key, edit_share)
        for b in slices(batches):
            yield b.filter(pa.array([not found for found in index.hits(b.column(place).to_pylist())], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def contaminated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
