"""Sharding: groups of equal texts to shards of near equal bytes.

Law ``bytes``: the size of a row is the UTF-8 bytes of its text plus 1, rows of
equal text stay together, and the shards' sums differ as little as
Karmarkar-Karp differencing makes them.  A partial partition is one sum per
shard; at first each item is a partition of its own.  The two partitions of the
largest spread are combined again and again, the largest sum of one with the
smallest of the other, until one is left; its parts are the shards, largest
first.

What is differenced is a list of bounded length, whatever the table.  A group
with more than 1/FINE of a shard's mean bytes is an item of its own (at most
shards x FINE of them); the other groups are gathered by the first bits of their
digest into shards x FINE bundles, whose mean is below 1/FINE of a shard.  All
groups are placed, at every size in the same way; with few groups a bundle is a
group or two.  The list is (item, bytes), 32,768 entries at most with 16 shards.

Spark reads the texts once (digest, size, CRC), adds up the groups before the
shuffle, so a text that a third of the rows share is one row of each task, and
places the rows by two broadcast maps of the bounded items, without a shuffle.
Slots count the rows of a shard by ascending id: one exchange by ranges of
(shard, id, row), numbers inside a range, and the ranges' offsets, one row per
range and shard.  No task holds a shard.

Edge cases: null text counts as empty, in one group with empty texts (size 1,
CRC 0); null ids take the first slots of their shard; repeated rows share the
shard and take slots of their own; a group larger than all else is one shard
alone; equal spreads are combined in the order of size, then of item; with
fewer groups than shards some shards stay empty; an empty table gives no rows;
very long texts are only hashed and measured; other columns are ignored by
:func:`sharded` and kept by :func:`write_shards`.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_or_empty, written

SHARDS = 16
#: a group with more than 1/FINE of a shard is differenced by itself
FINE = 1024


def difference(sizes: list[int], shards: int) -> list[int]:
    """Karmarkar-Karp: the shard of each item; shard 0 has the largest sum.

    A part is a node of a binary forest: items are leaves, and a combined part
    has the two parts it was made of.
    """
    if not sizes:
        return []
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    made: list[tuple[int, int]] = []  # the two parts of each combined part; -1: empty
    n_items, heap = len(sizes), []
    for turn, i in enumerate(order):
        # sums ascending, with their parts
        heap.append((-sizes[i], turn, [0] * (shards - 1) + [sizes[i]], [-1] * (shards - 1) + [i]))
    heapq.heapify(heap)
    turn = len(order)
    while len(heap) > 1:
        _, _, sums, parts = heapq.heappop(heap)
        _, _, other_sums, other_parts = heapq.heappop(heap)
        both = []
        for a, pa_, b, pb in zip(sums, parts, reversed(other_sums), reversed(other_parts), strict=True):
            if pa_ < 0 or pb < 0:
                part = max(pa_, pb)
            else:
                part = n_items + len(made)
                made.append((pa_, pb))
            both.append((a + b, part))
        both.sort()
        heapq.heappush(heap, (both[0][0] - both[-1][0], turn, [x for x, _ in both], [p for _, p in both]))
        turn += 1
    out = [0] * n_items
    for shard, part in enumerate(reversed(heap[0][3])):
        stack = [part] if part >= 0 else []
        while stack:
            p = stack.pop()
            if p < n_items:
                out[p] = shard
            else:
                stack.extend(made[p - n_items])
    return out


def group_digest(text: str = "text") -> Column:
    return F.unhex(F.sha2(text_or_empty(text).cast("binary"), 256))


def size_column(text: str = "text") -> Column:
    return F.octet_length(text_or_empty(text)).cast("long") + 1


def bundle_of(digest: Column, bundles: int) -> Column:
    return (F.conv(F.substring(F.hex(digest), 1, 12), 16, 10).cast("long") % bundles).cast("int")


class Plan:
    """Where every group goes: ``heavy`` (digest, shard) and ``bundles``
    (bundle, shard), both of bounded length."""

    def __init__(self, heavy: list[tuple[bytes, int]], bundles: list[tuple[int, int]], n_bundles: int):
        self.heavy, self.bundles, self.n_bundles = heavy, bundles, n_bundles

    def place(self, rows: DataFrame, digest: str = "digest", shard: str = "shard") -> DataFrame:
        """``rows`` with the shard of each row's group; no shuffle."""
        spark = rows.sparkSession
        heavy = spark.createDataFrame(self.heavy, "__of binary, __heavy int")
        bundles = spark.createDataFrame(self.bundles, "__bundle int, __light int")
        out = rows.join(F.broadcast(heavy), F.col(digest) == F.col("__of"), "left")
        out = out.join(F.broadcast(bundles), bundle_of(F.col(digest), self.n_bundles) == F.col("__bundle"), "left")
        return out.select(*rows.columns, F.coalesce("__heavy", "__light").alias(shard))


def plan(rows: DataFrame, shards: int = SHARDS, fine: int = FINE) -> Plan:
    """Difference the groups of rows(digest, size)."""
    groups = rows.groupBy("digest").agg(F.sum("size").alias("size"))
    n_bundles = shards * fine
    total = rows.agg(F.sum("size")).collect()[0][0] or 0
    own = F.col("size") > F.lit(total // n_bundles)
    items = groups.groupBy(F.when(own, F.col("digest")).alias("digest"), F.when(~own, bundle_of(F.col("digest"), n_bundles)).alias("bundle"))
    # at most n_bundles groups hold more than total / n_bundles, and there are n_bundles bundles
    found = items.agg(F.sum("size").alias("size")).collect()
    found.sort(key=lambda r: (-r["size"], r["digest"] is None, bytes(r["digest"] or b""), r["bundle"] or 0))
    to = difference([r["size"] for r in found], shards)
    heavy = [(bytes(r["digest"]), s) for r, s in zip(found, to, strict=True) if r["digest"] is not None]
    bundles = [(r["bundle"], s) for r, s in zip(found, to, strict=True) if r["digest"] is None]
    return Plan(heavy, bundles, n_bundles)


def with_slots(placed: DataFrame) -> DataFrame:
    """Number the rows of each shard from 0 by (doc_id, crc, row_id).

    ``placed`` needs shard, doc_id, text_crc32 and a fixed row_id.
    """
    order = ["shard", "doc_id", "text_crc32", "row_id"]
    n = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = placed.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("range", F.spark_partition_id())

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for b in batches:
            shard = b.column("shard").to_numpy()
            place = np.zeros(len(shard), np.int64)
            for s in np.unique(shard):
                mine = np.flatnonzero(shard == s)
                place[mine] = np.arange(len(mine)) + seen.get(int(s), 0)
                seen[int(s)] = seen.get(int(s), 0) + len(mine)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(place)], names=[*b.schema.names, "place"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranges.schema.fields) + ", place long"
    numbered = written(ranges.mapInArrow(number, schema), "shard-slots")
    counts = numbered.groupBy("shard", "range").agg(F.count(F.lit(1)).alias("n")).collect()
    # one row per range and shard in it: at most the ranges plus the shards
    offsets, sums = [], {}
    for r in sorted(counts, key=lambda r: (r["shard"], r["range"])):
        offsets.append((r["shard"], r["range"], sums.get(r["shard"], 0)))
        sums[r["shard"]] = sums.get(r["shard"], 0) + r["n"]
    offset = placed.sparkSession.createDataFrame(offsets, "shard int, range int, offset long")
    out = numbered.join(F.broadcast(offset), ["shard", "range"])
    return out.withColumn("slot", F.col("place") + F.col("offset")).drop("place", "offset", "range")


def sharded(docs: DataFrame, shards: int = SHARDS, fine: int = FINE) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    text = text_or_empty()
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        size_column().alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        group_digest().alias("digest"),
        F.monotonically_increasing_id().alias("row_id"),
    )
    rows = written(rows, "sized-rows")
    placed = plan(rows, shards, fine).place(rows).drop("digest")
    out = with_slots(placed)
    # growing by a shard keeps rows in place under the law by key only
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, fine: int = FINE) -> None:
    """Write the documents, all columns, to one folder per shard (shard=0 ...).
    A column of the documents named ``shard`` is replaced by it."""
    sized = docs.select(group_digest().alias("digest"), size_column().alias("size"))
    marked = docs.drop("shard").withColumn("__digest", group_digest())
    placed = plan(sized, shards, fine).place(marked, "__digest").drop("__digest")
    placed.write.partitionBy("shard").parquet(path)


def sharded_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(table(spark, sf_dir, "documents"))
