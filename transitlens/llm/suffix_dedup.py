"""Repeated byte strings by minimiser sampling with hashed fingerprints.

A position's rank at length h stands for the h bytes that begin there; the
rank at length 2h is made from the pair (rank at i, rank at i + h).  Ranks are
64-bit names that equal strings share everywhere (so no table of ranks has to
be sent around), doubled from 1 to 16 and 32 bytes; overlapping pairs close
the lengths between (16 and 16 at offset 8, 32 and 32 at offset 18).  All this
is done inside a task, in place of distributed prefix doubling, whose one row
per byte would be some 13 GB of shuffle for 0.86 GB of text.  Spark groups only
the ranks of these lengths, and positions whose rank is unique take no further
part:

1. length 24, at sampled positions: of each 50-byte string, the position of
   its smallest 24-byte rank (equal strings have theirs at the same place).
   Neighbouring strings share it, so a run of about 14 positions is one row.
2. length 50, a whole run at a time: runs around the same sampled string with
   the same 50-byte ranks form a class.  In every document but the class's
   first one, all strings of the run are repeats.
3. length 50, position by position, only where the sampled string has several
   classes, and only for the first document of each class.  The bytes of such a
   run go under its sampled rank, where strings are told apart and neighbours
   found again leave as one span.

What is broadcast has a bounded size: bitmaps of the sampled ranks that occur
more than once, of the classes of step 3 (16 bits each, at most 2^30) and of the
documents with repeats (collisions cost work, never a wrong result), and at most
``1 / FREQUENT_SHARE`` frequent ranks.  A sampled rank is the least of many, so it
is mixed once more before its upper bits choose a bit.  The rows of a frequent
sampled string are dealt to parts by document, in step 3 string by string; only
the first documents of each part, at most SALTS, come together once more.

Edge cases: null text counts as empty; texts shorter than the threshold keep
all; a null ``doc_id`` comes after all others and counts as equal to the
largest 64-bit id; documents of equal id never remove each other's strings; repeated rows give equal rows; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bitmap_place, hash_sums, packed_bitmap, slices, small_batches, table, test_bits, text_or_empty, written

THRESHOLD = 50
SAMPLED = 24
FREQUENT_SHARE = 2.0**-12
SALTS = 64
ID_BITS = 1 << 24
LAST_ID = (1 << 63) - 1
#: bytes of text that are ranked at a time: some 100 bytes of arrays for each, kept near the cache
CHUNK = 1 << 17
C1, C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
PLACE_BITS = np.uint64(30)
#: a run's row holds its first place, its size (below the threshold) and whether it is salted as one number
FIRST_AT = 20
BYTE_RANKS = np.random.default_rng(50).integers(0, 1 << 63, 256, dtype=np.uint64)


def pair_rank(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rank of the pairs (a, b)."""
    out = a * C1
    out += b
    out ^= out >> np.uint64(32)
    out *= C2
    out ^= out >> np.uint64(29)
    return out


class Runs:
    """Sampled positions and runs of a chunk of texts."""

    def __init__(self, texts: list[bytes], threshold: int = THRESHOLD, whole: bool = True):
        joined = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum([len(t) for t in texts])
        begins = ends - np.array([len(t) for t in texts])
        width = threshold - SAMPLED + 1  # sampled candidates of one string
        n = len(joined) - threshold + 1
        empty = np.zeros(0, np.int64)
        self.begins, self.owner, self.first, self.size = begins, empty, empty, empty
        self.anchor, self.run = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        if n <= 0:
            return
        rank, h = BYTE_RANKS[joined], 1
        sampled = None
        while 2 * h <= threshold:
            rank = pair_rank(rank[:-h], rank[h:])
            h *= 2
            if h == SAMPLED - SAMPLED % 16:
                sampled = pair_rank(rank[: -(SAMPLED - h)], rank[SAMPLED - h :]) if SAMPLED > h else rank
                if not whole:
                    break
        # smallest sampled rank among the candidates of each string, leftmost
        # first: the upper bits of the rank, then the place
        place = np.arange(len(sampled), dtype=np.uint64)
        least, w = (sampled >> PLACE_BITS << PLACE_BITS) | place, 1
        while 2 * w <= width:
            least = np.minimum(least[:-w], least[w:])
            w *= 2
        if w < width:
            least = np.minimum(least[: len(least) - (width - w)], least[width - w :])
        at = (least[:n] & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
        # strings must lie within one text
        inside = np.zeros(n + 1, np.int64)
        long = ends - begins >= threshold
        np.add.at(inside, begins[long], 1)
        np.add.at(inside, ends[long] - threshold + 1, -1)
        starts = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
        if not len(starts):
            return
        at = at[starts]
        cut = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)]))
        self.starts, self.cut = starts, cut
        self.first = starts[cut]
        self.size = np.diff(np.concatenate([cut, [len(starts)]]))
        self.owner = np.searchsorted(ends, self.first, "right")
        self.anchor = sampled[at[cut]]
        if whole:
            self.rank = pair_rank(rank[:n], rank[threshold - h : threshold - h + n])[starts] if h < threshold else rank[starts]
            offset = (starts - at).astype(np.uint64)
            self.run = np.add.reduceat(pair_rank(self.rank, offset), cut)


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[bytes]]]:
    """(ids, texts) of about CHUNK bytes; a longer text is a chunk of its own."""
    ids, texts, held = [], [], 0
    for b in slices(batches):
        for i, t in zip(b.column("id").to_pylist(), b.column("text").to_pylist(), strict=True):
            ids.append(i)
            texts.append(t.encode())
            held += len(texts[-1])
            if held > CHUNK:
                yield ids, texts
                ids, texts, held = [], [], 0
    if texts:
        yield ids, texts


def class_bits(n_classes: int) -> int:
    """Size of the bitmap of the open classes: sixteen bits each, within bounds."""
    return 1 << min(30, max(27, (16 * n_classes).bit_length()))


def class_place(run: np.ndarray, doc: np.ndarray, bits: int) -> np.ndarray:
    return pair_rank(run, doc.view(np.uint64)) >> np.uint64(64 - bits.bit_length() + 1)


def hash_of(anchor: np.ndarray) -> np.ndarray:
    """32 even bits of sampled ranks, which as least ranks of some crowd at the low end."""
    return (pair_rank(anchor, np.uint64(0)) >> np.uint64(32)).astype(np.uint32)


def named_texts(docs: DataFrame) -> DataFrame:
    """id (null: last), text (null: empty), nameless (the id is null)."""
    doc_id = F.col("doc_id").cast("long")
    return docs.select(F.coalesce(doc_id, F.lit(LAST_ID)).alias("id"), text_or_empty().alias("text"), doc_id.isNull().alias("nameless"))


def text_name(text: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)


def names_of(raw: list[bytes], named: bool) -> np.ndarray:
    """Tells texts of equal ids apart; 0 for all where ids are unique."""
    return np.array([text_name(t) for t in raw], np.int64) if named else np.zeros(len(raw), np.int64)


def salted(key: np.ndarray, doc: np.ndarray, often: np.ndarray) -> np.ndarray:
    """The keys, those of frequent sampled ranks dealt to parts by document."""
    return np.where(often, pair_rank(key, (1 + doc % SALTS).astype(np.uint64)), key).view(np.int64)


def columns_of(named: bool, **kinds: str) -> dict[str, str]:
    """Columns and their types; a name only where ids repeat."""
    return kinds | ({"name": "long"} if named else {})


def schema_of(columns: dict[str, str]) -> str:
    return ", ".join(f"{c} {kind}" for c, kind in columns.items())


def sampled_runs(texts: DataFrame, sums: Broadcast, threshold: int, named: bool) -> DataFrame:
    """One row per run whose sampled rank occurs more than once: key (sampled
    rank, salted if frequent), run (rank), id, place (first, size, salted), name."""
    columns = columns_of(named, key="long", run="long", id="long", place="long")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, often = np.frombuffer(sums.value[0], np.uint8), np.frombuffer(sums.value[1], np.uint32)
        for ids, raw in chunks(batches):
            runs = Runs(raw, threshold)
            upper = hash_of(runs.anchor)
            ok = test_bits(bitmap, bitmap_place(upper))
            owner, hot = runs.owner[ok], np.isin(upper[ok], often)
            doc = np.array(ids, np.int64)[owner]
            place = (runs.first[ok] - runs.begins[owner]) << FIRST_AT | runs.size[ok] << 1 | hot
            made = [salted(runs.anchor[ok], doc, hot), runs.run[ok].view(np.int64), doc, place, names_of(raw, named)[owner]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in made[: len(columns)]], names=list(columns))

    return texts.mapInArrow(emit, schema_of(columns))


def open_runs(texts: DataFrame, sums: Broadcast, classes: Broadcast, threshold: int, named: bool) -> DataFrame:
    """The runs of open classes in the first document of each, with their bytes
    under the sampled rank; of a frequent one string by string, with the
    string's rank, under that rank salted."""
    columns = columns_of(named, key="long", id="long", place="long", what="binary")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, often = np.frombuffer(sums.value[0], np.uint8), np.frombuffer(sums.value[1], np.uint32)
        bits = np.frombuffer(classes.value, np.uint8)
        for ids, raw in chunks(batches):
            runs, doc = Runs(raw, threshold), np.array(ids, np.int64)
            upper = hash_of(runs.anchor)
            some = np.flatnonzero(test_bits(bitmap, bitmap_place(upper)))
            some = some[test_bits(bits, class_place(runs.run[some], doc[runs.owner[some]], 8 * len(bits)))]
            hot = np.isin(upper[some], often)
            plain, some = some[~hot], some[hot]
            row, i = spread(runs.size[some])
            owner = np.concatenate([runs.owner[plain], runs.owner[some][row]])
            first = np.concatenate([runs.first[plain], runs.first[some][row] + i])
            size = np.concatenate([runs.size[plain], np.ones(len(row), np.int64)])
            rank = runs.rank[runs.cut[some][row] + i] if len(row) else np.zeros(0, np.uint64)
            joined = b"".join(raw)
            what = [joined[f : f + n + threshold - 1] for f, n in zip(runs.first[plain].tolist(), runs.size[plain].tolist(), strict=True)]
            what += [r.tobytes() for r in rank]
            hot = np.arange(len(owner)) >= len(plain)
            key = np.concatenate([runs.anchor[plain], rank])
            place = (first - runs.begins[owner]) << FIRST_AT | size << 1 | hot
            made = [salted(key, doc[owner], hot), doc[owner], place, what, names_of(raw, named)[owner]]
            kinds = [None, None, None, pa.binary(), None]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(made, kinds, strict=True)][: len(columns)], names=list(columns))

    return texts.mapInArrow(emit, schema_of(columns))


def spread(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, number within the row) of ``size`` entries per row."""
    row = np.repeat(np.arange(len(size)), size)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)


def string_ranks(joined: np.ndarray, threshold: int) -> np.ndarray:
    """Rank of the string at every position of the joined bytes."""
    rank, h = BYTE_RANKS[joined], 1
    while 2 * h <= threshold:
        rank = pair_rank(rank[:-h], rank[h:])
        h *= 2
    return pair_rank(rank[: len(rank) - (threshold - h)], rank[threshold - h :]) if h < threshold else rank


def whole_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows in the order of key, cut between keys only."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        key = b.column("key").to_numpy()
        if held and held[-1].column("key")[-1].as_py() != key[-1]:
            cut = int(np.flatnonzero(key != key[-1])[-1]) + 1 if key[0] != key[-1] else 0
            yield pa.Table.from_batches([*held, b.slice(0, cut)])
            held, b = [], b.slice(cut)
        held.append(b)
    if held:
        yield pa.Table.from_batches(held)


def repeated_in_keys(rows: DataFrame, threshold: int, named: bool) -> DataFrame:
    """id, start, end, rank, name: strings (neighbours as one) that begin under
    the same key in a row of a smaller id, rank null; and, with their rank, the
    strings of a salted key that do not."""
    columns = columns_of(named, id="long", start="int", end="int", rank="long")

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_keys(batches):
            key, doc, place = (t.column(c).to_numpy() for c in ("key", "id", "place"))
            first, size, hot = place >> FIRST_AT, (place & (1 << FIRST_AT) - 1) >> 1, (place & 1) > 0
            what = t.column("what").to_pylist()
            row, i = spread(size)
            rank = np.zeros(len(row), np.uint64)
            if hot.any():
                rank[hot[row]] = np.frombuffer(b"".join(w for w, one in zip(what, hot.tolist(), strict=True) if one), np.uint64)
            if not hot.all():
                joined = np.frombuffer(b"".join(w for w, one in zip(what, hot.tolist(), strict=True) if not one), np.uint8)
                long = np.where(hot, 0, size + threshold - 1)
                rank[~hot[row]] = string_ranks(joined, threshold)[((np.cumsum(long) - long)[row] + i)[~hot[row]]]
            group = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))[row]
            order = np.lexsort((rank, group))  # stable: rows stay in the order of id
            fresh = np.concatenate([[True], (rank[order][1:] != rank[order][:-1]) | (group[order][1:] != group[order][:-1])])
            least = np.empty(len(row), np.int64)
            least[order] = doc[row[order[np.flatnonzero(fresh)]]][np.cumsum(fresh) - 1]
            again = doc[row] > least
            at = np.flatnonzero(again)
            cut = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1] + 1) | (row[at[1:]] != row[at[:-1]])])) if len(at) else at
            last = at[np.concatenate([cut[1:] - 1, [len(at) - 1]])] if len(at) else at
            at, undecided = at[cut], np.flatnonzero(hot[row] & ~again)
            of = np.concatenate([row[at], row[undecided]])
            start = np.concatenate([(first[row] + i)[at], first[row][undecided]])
            end = np.concatenate([(first[row] + i)[last], first[row][undecided]]) + threshold
            ranks = pa.array(np.concatenate([rank[at], rank[undecided]]).view(np.int64), mask=np.arange(len(of)) < len(at))
            made = [pa.array(doc[of]), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32)), ranks, *([pa.array(t.column("name").to_numpy()[of])] if named else [])]
            yield pa.RecordBatch.from_arrays(made, names=list(columns))

    return rows.repartition("key").sortWithinPartitions("key", "id").mapInArrow(told, schema_of(columns))


def with_origin(rows: DataFrame, *by: str) -> DataFrame:
    return rows.withColumn("origin", F.min("id").over(Window.partitionBy(*by)))


def repeated_spans(texts: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """id, name, start, end of the strings (by runs) that also begin in a
    document of a smaller id."""
    sc = texts.sparkSession.sparkContext
    named = not texts.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def anchors(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, raw in chunks(iter([batch])):
            yield hash_of(Runs(raw, threshold, whole=False).anchor)

    sums = sc.broadcast(hash_sums(texts, anchors, n_bytes // 14, FREQUENT_SHARE)[:2])
    runs = with_origin(sampled_runs(texts, sums, threshold, named), "key", "run")
    part = Window.partitionBy("key")
    runs = runs.withColumn("several", F.min("run").over(part) < F.max("run").over(part))
    # the ranks of runs are only needed where a class is open or was grouped in parts
    undecided = (F.col("id") == F.col("origin")) & (F.col("several") | (F.col("place") % 2 == 1))
    runs = runs.select("id", "place", F.when(undecided, F.col("run")).alias("run"), name_in(named), (F.col("id") > F.col("origin")).alias("covered"))
    runs = written(runs.filter("covered or run is not null"), "runs")
    # at most SALTS documents of a class are left of its parts; a class of a frequent string counts as one of several
    salted_runs = with_origin(runs.filter("not covered and place % 2 = 1"), "run")
    salted_runs = written(salted_runs.select("id", "place", "run", "name", (F.col("id") > F.col("origin")).alias("covered")), "salted")
    decided = runs.filter("covered or place % 2 = 0").unionByName(salted_runs)
    first, size = F.shiftright("place", FIRST_AT), F.shiftright("place", 1) % (1 << FIRST_AT - 1)
    covered = decided.filter("covered").select("id", "name", first.cast("int").alias("start"), (first + size + (threshold - 1)).cast("int").alias("end"))
    open_classes = decided.filter("not covered").select("run", "id")
    bits = class_bits(open_classes.count())

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            run, doc = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("run", "id"))
            yield pa.RecordBatch.from_arrays([pa.array(class_place(run.view(np.uint64), doc, bits).astype(np.int64))], names=["place"])

    classes = sc.broadcast(packed_bitmap(open_classes.mapInArrow(places, "place long"), F.col("place"), bits))
    strings = repeated_in_keys(open_runs(texts, sums, classes, threshold, named), threshold, named)
    strings = written(strings.select("id", "start", "end", "rank", name_in(named)), "strings")
    spans = ["id", "name", "start", "end"]
    again = with_origin(strings.filter("rank is not null"), "rank").filter(F.col("id") > F.col("origin"))
    return covered.select(*spans).unionByName(strings.filter("rank is null").select(*spans)).unionByName(again.select(*spans))


def name_in(named: bool) -> Column:
    return F.col("name") if named else F.lit(0).cast("long").alias("name")


def remove_repeats(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every document."""
    with small_batches(docs.sparkSession):
        return written(without_repeats(docs, threshold), "deduplicated")


def without_repeats(docs: DataFrame, threshold: int) -> DataFrame:
    texts = named_texts(docs)
    spans = repeated_spans(texts, threshold)
    # a document has at most as many spans as bytes
    per_text = spans.groupBy("id", "name").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))
    per_text = written(per_text, "spans")
    packed = packed_bitmap(per_text, F.pmod("id", F.lit(ID_BITS)), ID_BITS)
    named = not per_text.filter("name <> 0").isEmpty()
    shipped = texts.sparkSession.sparkContext.broadcast(packed)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts without a repeat are done here; of the others the packed text
        goes to its spans."""
        import zstandard

        bitmap, squeeze = np.frombuffer(shipped.value, np.uint8), zstandard.ZstdCompressor(level=3).compress
        for b in slices(batches):
            raw = [t.encode() for t in b.column("text").to_pylist()]
            some = test_bits(bitmap, (b.column("id").to_numpy() % ID_BITS).astype(np.uint64))
            columns = [
                b.column("id"),
                b.column("nameless"),
                pa.array(names_of(raw, named)),
                pa.array([len(t) for t in raw], pa.int64()),
                pa.array([squeeze(t) if s else None for t, s in zip(raw, some, strict=True)], pa.binary()),
                pa.array([None if s else hashlib.sha256(t).hexdigest() for t, s in zip(raw, some, strict=True)], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "nameless", "name", "n_bytes", "packed", "sha"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        for b in slices(batches, 64):
            rows = []
            for packed, sha, starts, ends in zip(*[b.column(c).to_pylist() for c in ("packed", "sha", "starts", "ends")], strict=True):
                if packed is None:
                    rows.append((0, 0, sha))
                else:
                    rows.append(removed(zstandard.ZstdDecompressor().decompress(packed), starts or [], ends or []))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("nameless"), b.column("n_bytes"), *[pa.array(c, pa.int64()) for c in columns[:2]], pa.array(columns[2], pa.string())],
                names=["id", "nameless", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    joined = texts.mapInArrow(pack, "id long, nameless boolean, name long, n_bytes long, packed binary, sha string").join(per_text, ["id", "name"], "left")
    out = joined.select("id", "nameless", "n_bytes", "packed", "sha", "starts", "ends").mapInArrow(
        cut, "id long, nameless boolean, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
    return out.select(F.when(~F.col("nameless"), F.col("id")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def removed(raw: bytes, starts: list[int], ends: list[int]) -> tuple[int, int, str]:
    """(bytes removed, maximal runs, digest of what is left)."""
    if not starts:
        return 0, 0, hashlib.sha256(raw).hexdigest()
    change = np.zeros(len(raw) + 1, np.int64)
    np.add.at(change, np.array(starts), 1)
    np.add.at(change, np.array(ends), -1)
    gone = np.cumsum(change[:-1]) > 0
    n_spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
    return int(gone.sum()), n_spans, hashlib.sha256(kept).hexdigest()


def deduplicated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
