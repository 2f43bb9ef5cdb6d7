"""Small helpers shared by the training-data operators of this subpackage."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transitlens.session import fresh_path

#: ASCII white space, as a regular expression class body
ASCII_SPACE = r"[\x20\x09-\x0D]+"

#: size of the bitmap of repeated hashes: fixed, whatever the input
BITMAP_BITS = 1 << 27


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage at a place every executor can reach, so a lost executor
    costs a re-read and not a recomputation of all that came before.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Jobs run inside hand at most ``rows`` rows at a time to Python and back:
    an executor holds a batch several times over (Arrow vectors, the buffer
    sent, the batch received).  Afterwards the session's setting is as before."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def id_remainder(mod: int, col: str = "doc_id") -> Column:
    """crc32 of the id's decimal text, modulo ``mod`` (null ids: null)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % mod


def slices(batches: Iterable[pa.RecordBatch], rows: int = 256, size: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into pieces of at most ``rows`` rows and ``size`` bytes
    (a longer text is a piece of its own), so that what a task holds as Python
    objects stays small however long the texts are."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield from sized(b.slice(i, rows), size)


def sized(b: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """Halves of halves until a piece has at most ``size`` bytes or one row."""
    if b.num_rows <= 1 or b.nbytes <= size:
        yield b
    else:
        half = b.num_rows // 2
        yield from sized(b.slice(0, half), size)
        yield from sized(b.slice(half), size)


def worker_memory(name: str, key, make):
    """A helper object that the tasks of one Python worker share.  A worker
    holds one at a time: asking for another name or key lets the last one go,
    so a chain of stages holds no more than its largest.  Results never depend
    on it."""
    memory = sys.modules.setdefault("transitlens_worker_memory", types.ModuleType("transitlens_worker_memory"))
    held = getattr(memory, "held", None)
    if held is None or held[0] != (name, key):
        memory.held = held = None
        memory.held = held = ((name, key), make())
    return held[1]


def bitmap_place(upper: np.ndarray) -> np.ndarray:
    """Bit of a 32-bit hash in the bitmap of repeated hashes."""
    return upper.astype(np.uint64) * np.uint64(BITMAP_BITS) >> np.uint64(32)


def test_bits(bitmap: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (bitmap[place >> np.uint64(3)] >> (np.uint64(7) - (place & np.uint64(7))).astype(np.uint8)) & 1 > 0


#: hashes of one range, about: some 60 bytes each while a range is added up
RANGE = 500_000


class HashParts:
    """Counting of 32-bit hashes in ranges of the hash: tasks deal their hashes
    to the ranges (equal ones added up before the shuffle), a range adds up its
    parts.  ``n_entries``: about how many hashes there are; a range holds about
    RANGE of them."""

    def __init__(self, n_entries: int, common_share: float):
        segments = max(64, min(1 << 22, n_entries // RANGE + 1))
        self.segments = 1 << (segments - 1).bit_length()
        self.shift, self.bits = 32 - (self.segments.bit_length() - 1), BITMAP_BITS // self.segments
        self.common = max(8, int(n_entries * common_share))

    def parts(self, held: list[np.ndarray]) -> list[tuple[int, bytes, bytes]]:
        """(segment, hashes, counts) of some hashes."""
        upper, n = np.unique(np.concatenate(held) if held else np.zeros(0, np.uint32), return_counts=True)
        cuts = np.searchsorted(upper, np.arange(1, self.segments, dtype=np.uint64) << np.uint64(self.shift))
        both = zip(np.split(upper, cuts), np.split(n.astype(np.uint32), cuts), strict=True)
        return [(i, u.tobytes(), c.tobytes()) for i, (u, c) in enumerate(both) if len(u)]

    def summed(self, parts: Iterable[bytes], counts: Iterable[bytes]) -> tuple[bytes, bytes, bytes]:
        """(bitmap, frequent hashes, their counts) of a segment's parts."""
        values = np.concatenate([np.frombuffer(p, np.uint32) for p in parts])
        n = np.concatenate([np.frombuffer(p, np.uint32) for p in counts])
        order = np.argsort(values, kind="stable")
        values, n = values[order], n[order].astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
        value, n = values[first], np.add.reduceat(n, first)
        bitmap = np.zeros(self.bits, bool)
        bitmap[bitmap_place(value[n > 1]) % np.uint64(self.bits)] = True
        often = n > self.common
        return np.packbits(bitmap).tobytes(), value[often].tobytes(), n[often].tobytes()

    def joined(self, summed: list) -> tuple[bytes, bytes, bytes]:
        """All segments' rows (segment, bitmap, often, n) as one."""
        by = {r["segment"]: r for r in summed}
        empty = bytes(self.bits // 8)
        bitmap = b"".join(bytes(by[i]["bitmap"]) if i in by else empty for i in range(self.segments))
        return bitmap, *[b"".join(bytes(by[i][c]) for i in sorted(by)) for c in ("often", "n")]


#: hashes that a task holds before it deals them out
HELD = 2_000_000


def hash_sums(
    docs: DataFrame, hashes: Callable[[pa.RecordBatch], Iterable[np.ndarray]], n_entries: int, common_share: float
) -> tuple[bytes, bytes, bytes]:
    """How often each 32-bit hash occurs, over all rows.

    Returns a bitmap (BITMAP_BITS, fixed) of the hashes that occur more than
    once, and the hashes with more than ``common_share`` of all entries (at
    least 8; at most 1 / common_share of them), sorted, with their counts.
    """
    how = HashParts(n_entries, common_share)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held = [], 0

        def flush() -> pa.RecordBatch:
            parts = how.parts(held)
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in parts], pa.int32()), *[pa.array([x[i] for x in parts], pa.binary()) for i in (1, 2)]],
                names=["segment", "part", "n"],
            )

        for b in slices(batches):
            for h in hashes(b):
                held.append(h)
                n_held += len(h)
            if n_held > HELD:
                yield flush()
                n_held = 0
        yield flush()

    def add_up(rows: pa.Table) -> pa.Table:
        made = how.summed(rows.column("part").to_pylist(), rows.column("n").to_pylist())
        return pa.table({"segment": rows.column("segment").slice(0, 1), **{c: pa.array([x], pa.binary()) for c, x in zip(("bitmap", "often", "n"), made, strict=True)}})

    parts = docs.mapInArrow(deal, "segment int, part binary, n binary")
    return how.joined(parts.groupBy("segment").applyInArrow(add_up, "segment int, bitmap binary, often binary, n binary").collect())


def packed_bitmap(rows: DataFrame, place: Column, n_bits: int) -> bytes:
    """Bitmap of ``n_bits`` with the bits at ``place`` of all rows set."""
    segment = 1 << 16

    def pack(rows: pa.Table) -> pa.Table:
        bits = np.zeros(segment, bool)
        bits[rows.column("bit").to_numpy()] = True
        return pa.table({"segment": rows.column("segment").slice(0, 1), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    parts = rows.select(F.floor(place / segment).cast("int").alias("segment"), (place % segment).cast("int").alias("bit")).distinct()
    packed = {r["segment"]: bytes(r["bits"]) for r in parts.groupBy("segment").applyInArrow(pack, "segment int, bits binary").collect()}
    return b"".join(packed.get(i, bytes(segment // 8)) for i in range(max(1, n_bits // segment)))
