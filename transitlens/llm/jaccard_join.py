"""N-gram Jaccard self-join: blocked sparse product of the document by
n-gram incidence matrix.

A document's row of the matrix is its set of distinct ``words``-word shingles
(64-bit hashes).  Two documents link when ``100 * |A & B| >= percent * |A u B|``.

1. Equal rows collapse: documents with the same set are one *entity*.
2. Column sums (in how many documents a shingle occurs) are counted over all
   documents in blocks of the hash range.  They give a global order of the
   columns: those with one document first, frequent ones last.  Any order gives
   the same links; this one makes the product sparse.
3. Size-derived bounds: a linked pair of sizes n <= m shares at least
   ``percent/100 * m`` shingles, hence a column among the first
   ``n - ceil(percent/100 * n) + 1`` of either.  Only these prefixes are
   multiplied, and columns with one document are left out at once.
4. A column with more than FEW entities first compares its members with one of
   them (a star, not all pairs).  Connected components of these links follow.
5. The product of each block of columns adds up overlap counts of pairs in
   different components; a pair whose count plus what the prefixes leave open
   cannot reach the bound is discarded.  The others are verified on the whole
   sets.  In a column with more than ``wide`` entities the pairs that lie in
   different components, and for which the column can be the first one shared,
   are taken in square blocks of its members.  No link between components is
   lost, and large groups of near copies cost a star each.

A text is cut into shingles twice: for its name and the column sums, and for its
prefix, which is written with the whole set where it has columns to multiply.

What is broadcast has a fixed size: a bitmap of ``BITMAP_BITS`` bits naming the
columns with more than one document, at most ``1 / COMMON_SHARE`` frequent
columns with their counts, and a bitmap of the entities to verify.  Collisions
in a bitmap cost work, never a link.

Edge cases: null and empty texts have an empty set, linked with nothing;
repeated rows are one entity; with a null ``doc_id`` a document takes part and
its id is never the smallest; very long texts are one row with a long set; an empty table gives an empty result; other
columns are ignored by :func:`jaccard_components` and kept by
:func:`drop_near_duplicates`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import HELD, HashParts, bitmap_place, packed_bitmap, slices, table, test_bits, text_or_empty, worker_memory, written

WORDS = 5
PERCENT = 80
WIDE = 48
#: columns with more entities than this have a star before anything is multiplied
FEW = 3
SQUARE = 512
ENTITY_BITS = 1 << 24
COMMON_SHARE = 2.0**-20
#: words remembered by a Python worker; a fuller memory is emptied
REMEMBERED = 300_000
MIX = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * MIX
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def shingle_sets(texts: list[str | None], hashes: WordHashes, k: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    out = []
    get = hashes.__getitem__
    for text in texts:
        tokens = (text or "").encode().lower().split()
        n = len(tokens)
        if not n:
            out.append(np.zeros(0, np.uint64))
            continue
        h = np.fromiter(map(get, tokens), np.uint64, n)
        width = min(n, k)
        # the words' hashes are random, so a polynomial tells sequences apart
        total = h[: n - width + 1] + np.uint64(width)
        for i in range(1, width):
            total *= MIX
            total += h[i : n - width + 1 + i]
        total = mixed(total)
        out.append(np.unique(total))
    return out


def entity_of(shingles: np.ndarray) -> int:
    """64-bit name of a set (signed, as Spark's long)."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def from_spark(name: str) -> pa.DataType:
    return {"bigint": pa.int64(), "long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}[name]


def memory() -> WordHashes:
    return worker_memory("word hashes", 0, WordHashes)


def least_overlap(n, m, percent: int):
    """Smallest overlap of linked sets of sizes n and m: the least i with
    100 i >= percent (n + m - i)."""
    return -(-percent * (n + m) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


#: documents of a group that passes through the shuffle beside the sums
PASSED_ROWS = 20_000


def entities_and_sums(docs: DataFrame, k: int) -> tuple[DataFrame, tuple[bytes, bytes, bytes]]:
    """(the rows with entity and n instead of the text; the column sums).

    The column sums: the columns (by the hash's upper 32 bits) that occur in
    more than one row, as a bitmap, and the frequent ones (sorted) with their
    counts.  Both come from one pass over the texts: a task's rows go through
    the shuffle of the sums in groups of their own."""
    rest = [c for c in docs.columns if c != "text"]
    n_rows, n_bytes = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    how = HashParts((n_bytes or 0) // 6, COMMON_SHARE)
    groups = max(256, n_rows // PASSED_ROWS)
    types = {c: docs.schema[c].dataType.simpleString() for c in rest} | {"entity": "long", "size": "long"}
    made = {"segment": "int", "bitmap": "binary", "often": "binary", "n": "binary"}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held = [], 0

        def flush() -> pa.RecordBatch:
            parts = how.parts(held)
            held.clear()
            columns = {"segment": pa.array([x[0] for x in parts], pa.int32())} | {c: pa.array([x[i] for x in parts], pa.binary()) for i, c in ((1, "part"), (2, "n"))}
            return batch_with(columns, len(parts))

        for b in slices(batches):
            sets = shingle_sets(b.column("text").to_pylist(), memory(), k)
            names = np.array([entity_of(s) for s in sets], np.int64)
            columns = {c: b.column(c) for c in rest} | {"entity": pa.array(names), "size": pa.array([len(s) for s in sets], pa.int64())}
            # rows of one entity may be many, so a row's place says its group
            columns["segment"] = pa.array(-1 - (names.view(np.uint64) + np.arange(len(names), dtype=np.uint64)).astype(np.int64) % groups, pa.int32())
            yield batch_with(columns, len(sets))
            for s in sets:
                held.append((s >> np.uint64(32)).astype(np.uint32))
                n_held += len(s)
            if n_held > HELD:
                yield flush()
                n_held = 0
        yield flush()

    schema = pa.schema([(c, from_spark(t)) for c, t in (types | {"segment": "int", "part": "binary", "n": "binary"}).items()])

    def batch_with(columns: dict, n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)

    out_schema = pa.schema([(c, from_spark(t)) for c, t in (types | made).items()])

    def add_up(rows: pa.Table) -> pa.Table:
        if rows.column("segment")[0].as_py() < 0:
            columns = {c: rows.column(c) for c in types}
            return pa.table([columns[f.name] if f.name in columns else pa.nulls(rows.num_rows, f.type) for f in out_schema], schema=out_schema)
        summed = how.summed(rows.column("part").to_pylist(), rows.column("n").to_pylist())
        columns = {"segment": rows.column("segment").slice(0, 1)} | {c: pa.array([x], pa.binary()) for c, x in zip(("bitmap", "often", "n"), summed, strict=True)}
        return pa.table([columns[f.name] if f.name in columns else pa.nulls(1, f.type) for f in out_schema], schema=out_schema)

    ddl = lambda fields: ", ".join(f"{c} {t}" for c, t in fields.items())
    dealt = docs.mapInArrow(work, ddl(types | {"segment": "int", "part": "binary", "n": "binary"}))
    both = written(dealt.groupBy("segment").applyInArrow(add_up, ddl(types | made)), "entities")
    named = both.filter("segment is null").select(*rest, "entity", F.col("size").alias("n"))
    return named, how.joined(both.filter("segment is not null").select(*made).collect())


def prefix_of(s: np.ndarray, bitmap: np.ndarray, often: np.ndarray, often_n: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """The columns of a set's prefix that other documents have too, in order,
    and the place of the first of them among all the set's columns.

    Order of the columns: those without a bit (one document only), then by the
    count of the frequent ones (0 for the rest), then by hash.
    """
    upper = (s >> np.uint64(32)).astype(np.uint32)
    shared = test_bits(bitmap, bitmap_place(upper))
    alone = len(s) - int(shared.sum())
    left = prefix_length(len(s), percent) - alone
    if left <= 0:
        return s[:0], alone
    s, upper = s[shared], upper[shared]
    count = np.zeros(len(s), np.int64)
    if len(often):
        at = np.minimum(np.searchsorted(often, upper), len(often) - 1)
        count = np.where(often[at] == upper, often_n[at], 0)
    return s[np.lexsort((s, count))][:left], alone


def prefixes(docs: DataFrame, sums: tuple[bytes, bytes, bytes], percent: int, k: int) -> DataFrame:
    """entity, n, place, columns, shingles of the rows that have columns to be
    multiplied; place is that of the first one in the set's order, and shingles
    is the packed set."""
    shipped = docs.sparkSession.sparkContext.broadcast(sums)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, often, often_n = (np.frombuffer(x, t) for x, t in zip(shipped.value, (np.uint8, np.uint32, np.int64), strict=True))
        for b in slices(batches):
            rows = []
            for s in shingle_sets(b.column("text").to_pylist(), memory(), k):
                prefix, place = prefix_of(s, bitmap, often, often_n, percent) if len(s) else (s, 0)
                if len(prefix):
                    rows.append((entity_of(s), len(s), place, prefix.view(np.int64), s.tobytes()))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["entity", "n", "place", "columns", "shingles"]
                )

    return docs.select("text").mapInArrow(cut, "entity long, n long, place long, columns array<long>, shingles binary")


def prefix_columns(cut: DataFrame) -> DataFrame:
    """h, entity, n, pos: the entries of the incidence matrix that are
    multiplied; pos is the column's place in the set's order."""
    rows = cut.select("entity", "n", "place", F.posexplode("columns").alias("i", "h"))
    # copies have the same entries: partial aggregation drops them before the shuffle
    return rows.groupBy("h", "entity").agg(F.first("n").alias("n"), F.first(F.col("place") + F.col("i")).alias("pos"))


def sets_of(cut: DataFrame, wanted: DataFrame) -> DataFrame:
    """entity, shingles (packed) of the wanted entities, one row each."""
    bitmap = packed_bitmap(wanted, F.pmod("entity", F.lit(ENTITY_BITS)), ENTITY_BITS)
    shipped = cut.sparkSession.sparkContext.broadcast(bitmap)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(shipped.value, np.uint8)
        for b in batches:
            place = np.mod(b.column("entity").to_numpy(), ENTITY_BITS).astype(np.uint64)
            yield b.filter(pa.array(test_bits(bitmap, place), pa.bool_()))

    found = cut.select("entity", "shingles").mapInArrow(emit, "entity long, shingles binary")
    return found.groupBy("entity").agg(F.first("shingles").alias("shingles")).join(wanted, "entity", "left_semi")


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) whose whole sets link."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            keep = []
            for x, y in zip(b.column("sx").to_pylist(), b.column("sy").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield b.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.select("x", "y").join(sets.select(F.col("entity").alias("x"), F.col("shingles").alias("sx")), "x")
    both = both.join(sets.select(F.col("entity").alias("y"), F.col("shingles").alias("sy")), "y")
    return both.select("x", "y", "sx", "sy").mapInArrow(verify, "x long, y long")


def within_bounds(n: Column, m: Column, percent: int) -> Column:
    """Sizes that can link at all: percent * larger <= 100 * smaller."""
    return percent * F.greatest(n, m) <= 100 * F.least(n, m)


def overlap_needed(n: Column, m: Column, percent: int) -> Column:
    return F.ceil(percent * (n + m) / (100 + percent))


def can_be_first(percent: int) -> Column:
    """Whether a shared column can be the first one shared by a linked pair:
    from there on, either set must have as many columns as must be shared."""
    least = overlap_needed(F.col("nx"), F.col("ny"), percent)
    return (F.col("px") + least <= F.col("nx")) & (F.col("py") + least <= F.col("ny"))


def stars(entries: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y) of each column's members with one of them.  The centre is
    the member with the most entries in such columns: an original has more of
    them than its edited copies."""
    weights = written(entries.groupBy("entity").agg(F.count(F.lit(1)).alias("w")), "weights")
    ranked = written(entries.join(weights, "entity"), "ranked")
    centre = written(ranked.groupBy("h").agg(F.max(F.struct("w", "entity", "n")).alias("centre")), "centres")
    star = ranked.join(centre, "h").select(F.col("entity").alias("x"), F.col("n").alias("nx"), F.col("centre.entity").alias("y"), F.col("centre.n").alias("ny"))
    star = star.filter((F.col("x") != F.col("y")) & within_bounds(F.col("nx"), F.col("ny"), percent))
    return star.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()


def product_pairs(entries: DataFrame, percent: int, wide: int) -> DataFrame:
    """Pairs (x, y) in different components (column ``label``) to verify, from
    the overlap counts of the columns with at most ``wide`` members."""
    narrow = entries.filter(F.col("m") <= wide)
    left, right = (
        narrow.select("h", F.col("entity").alias(e), F.col("n").alias(f"n{e}"), F.col("pos").alias(f"p{e}"), F.col("label").alias(f"l{e}")) for e in ("x", "y")
    )
    apart = (F.col("x") < F.col("y")) & (F.col("lx") != F.col("ly"))
    product = left.join(right, "h").filter(apart & within_bounds(F.col("nx"), F.col("ny"), percent))
    counted = product.groupBy("x", "y", "nx", "ny").agg(F.count(F.lit(1)).alias("c"), F.max(can_be_first(percent)).alias("first"))
    # entries in wide columns are not counted: each may be one more overlap
    open_ = entries.filter(F.col("m") > wide).groupBy("entity").agg(F.count(F.lit(1)).alias("w"))
    counted = counted.filter("first").join(open_.select(F.col("entity").alias("x"), F.col("w").alias("wx")), "x", "left")
    counted = counted.join(open_.select(F.col("entity").alias("y"), F.col("w").alias("wy")), "y", "left")
    # Of the set whose prefix ends first in the order of columns, all entries
    # shared in the prefix are counted; its rest adds at most its size.  Which
    # set that is isn't known here, so the larger rest stands for both.
    rest = F.greatest(*[F.ceil(F.col(n) * percent / 100) - 1 for n in ("nx", "ny")])
    most = F.col("c") + F.least(F.coalesce("wx", F.lit(0)), F.coalesce("wy", F.lit(0))) + rest
    return counted.filter(most >= overlap_needed(F.col("nx"), F.col("ny"), percent)).select("x", "y")


def components(links: DataFrame) -> DataFrame:
    """node, label of every node of the links (x, y): the smallest node of its
    component.  Each round takes the least label among the neighbours, then
    the label's own label; the rounds grow with the logarithm of a path's
    length.  Every round is written, so nothing is computed twice."""
    both = written(links.select("x", "y").union(links.select("y", "x")).distinct(), "links")
    labels = written(both.groupBy(F.col("x").alias("node")).agg(F.least(F.min("x"), F.min("y")).alias("label")), "labels")
    while True:
        heard = both.join(labels, both["y"] == labels["node"]).groupBy("x").agg(F.min("label").alias("heard"))
        lower = labels.join(heard, labels["node"] == heard["x"], "left").select("node", "label", F.least("label", "heard").alias("next"))
        # hooking: the old label learns of the lower one too
        told = lower.groupBy("label").agg(F.min("next").alias("told"))
        own = lower.select("node", "label", "next").join(told.withColumnRenamed("label", "root"), F.col("node") == F.col("root"), "left")
        own = own.select("node", "label", F.least("next", "told").alias("next"))
        jump = own.select(F.col("node").alias("via"), F.col("next").alias("beyond"))
        new = own.join(jump, F.col("next") == F.col("via"), "left").select("node", "label", F.least("next", "beyond").alias("next"))
        new = written(new, "labels")
        if new.filter("next < label").isEmpty():
            return new.select("node", F.col("next").alias("label"))
        labels = new.select("node", F.col("next").alias("label"))


def pairs_across(broad: DataFrame, percent: int) -> DataFrame:
    """Pairs of a wide column in different components that can link, square by
    square."""
    entries = broad.select("h", "entity", "n", "pos", "label")
    mixed_columns = entries.groupBy("h").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("m")).filter("lo < hi")
    blocks = written(mixed_columns.select("h", F.ceil(F.col("m") / SQUARE).cast("int").alias("blocks")), "blocks")
    entries = entries.join(blocks, "h").withColumn("block", F.pmod(F.xxhash64("entity"), F.col("blocks")).cast("int"))
    # a member meets every block of its column: once as left, once as right side
    left = entries.select("h", F.col("block").alias("a"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("b"),
                          F.col("entity").alias("x"), F.col("n").alias("nx"), F.col("pos").alias("px"), F.col("label").alias("lx"))
    right = entries.select("h", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("a"), F.col("block").alias("b"),
                           F.col("entity").alias("y"), F.col("n").alias("ny"), F.col("pos").alias("py"), F.col("label").alias("ly"))
    pairs = left.filter("a <= b").join(right.filter("a <= b"), ["h", "a", "b"])
    pairs = pairs.filter((F.col("lx") != F.col("ly")) & ((F.col("a") < F.col("b")) | (F.col("x") < F.col("y"))))
    pairs = pairs.filter(within_bounds(F.col("nx"), F.col("ny"), percent) & can_be_first(percent))
    return pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()


def entity_components(docs: DataFrame, sums: tuple[bytes, bytes, bytes], percent: int, k: int, wide: int) -> DataFrame:
    """entity, label for every entity that has a link."""
    cut = written(prefixes(docs, sums, percent, k), "prefixes")
    columns = prefix_columns(cut)
    sums = written(columns.groupBy("h").agg(F.count(F.lit(1)).alias("m")).filter("m > 1"), "column-sums")
    entries = written(columns.join(sums, "h"), "columns")
    sets = written(sets_of(cut, written(entries.select("entity").distinct(), "wanted")), "sets")
    links = written(linked(written(stars(entries.filter(F.col("m") > FEW), percent), "stars"), sets, percent), "linked")
    labels = components(links)
    label = F.coalesce("label", F.col("entity"))
    entries = written(entries.join(labels.withColumnRenamed("node", "entity"), "entity", "left").withColumn("label", label), "labelled")
    across = product_pairs(entries, percent, wide).union(pairs_across(entries.filter(F.col("m") > wide), percent)).distinct()
    found = written(linked(written(across, "across"), sets, percent), "linked")
    if not found.isEmpty():
        labels = components(links.union(found))
    return labels.withColumnRenamed("node", "entity")


def row_components(rows: DataFrame, percent: int, k: int, wide: int) -> tuple[DataFrame, DataFrame]:
    """(rows with n and label of those that have a set, rows with none)."""
    named, sums = entities_and_sums(rows, k)
    labels = entity_components(rows, sums, percent, k, wide)
    some = named.filter("n > 0").join(labels, "entity", "left").withColumn("label", F.coalesce("label", F.col("entity")))
    return some, named.filter("n = 0")


def jaccard_components(docs: DataFrame, percent: int = PERCENT, k: int = WORDS, wide: int = WIDE) -> DataFrame:
    """doc_id, n_shingles, component_id for every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    some, none = row_components(rows, percent, k, wide)
    smallest = written(some.groupBy("label").agg(F.min("doc_id").alias("component_id")), "smallest")
    out = some.join(smallest, "label").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = none.select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return out.unionByName(alone)


def text_digest() -> Column:
    return F.unhex(F.md5(text_or_empty().cast("binary")))


def drop_near_duplicates(docs: DataFrame, percent: int = PERCENT, k: int = WORDS, wide: int = WIDE) -> DataFrame:
    """One document of each component, with all columns: that with the smallest
    id (null ids last), then the smallest digest of its text; of its repeated
    rows one.  Rows are told apart by id and text, so another text under the
    same id has a decision of its own.  Documents with an empty set all stay."""
    some, _ = row_components(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_digest().alias("digest")), percent, k, wide)
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "digest")
    groups = written(some.groupBy("label", "doc_id", "digest").agg(F.count(F.lit(1)).alias("rows")), "near-rows")
    stays = written(groups.groupBy("label").agg(F.min(key).alias("stays")), "near-kept")
    decided = groups.join(stays, "label").withColumn("drop", key != F.col("stays")).filter(F.col("drop") | (F.col("rows") > 1))
    goes = written(decided.select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), F.col("drop").alias("__drop")), "goes")
    marked = docs.withColumn("__text", text_digest()).join(goes, (F.col("__text") == F.col("__digest")) & F.col("doc_id").cast("long").eqNullSafe(F.col("__id")), "left")
    plain = marked.filter(F.col("__drop").isNull())
    again = marked.filter(~F.col("__drop")).dropDuplicates(["__id", "__digest"])
    return plain.select(docs.columns).unionByName(again.select(docs.columns))


def linked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
