"""Vector code compression: product codes whose entries are searched by a GNAT.

A vector becomes integers floor(4096 * x) and is cut into 8 consecutive parts;
each part position has a codebook of 16 entries.  The codebook starts as that
part of the first kept vectors by id; each of 6 rounds assigns every part to
its nearest entry (squared Euclidean distance, ties to the lower index) and
moves every used entry to the componentwise floor(sum / count) of its parts;
then the parts are assigned once more.

Nearest entries come from a geometric near-neighbour access tree over the
entries of each position.  A node takes a few entries as split points (farthest
first), gives every other entry to its nearest split point, and stores for
every pair (split point, child) the range of distances from the split point to
the child's entries.  The distance of a query to one split point, the range and
the best distance so far rule out whole children by the triangle inequality.
Distances are square roots: lower ends are rounded down and upper ends up, and
a child goes only when its bound is strictly beyond the best distance, so an
entry that ties is always reached; what is reached is compared by its integer
squared distance, then by its index.  The search works on arrays of queries: a
node sees those queries that could not rule it out.

Spark reads the vectors once into a table of integers; every round is one scan
of it in which a task sums its parts per entry, so 1024 sums a task are
shuffled, added up and read by the driver (parts x entries x components of a
part, whatever the number of vectors).  The errors of a label are added before
the shuffle; the sums of labels with more than 1/256 of the rows (256 at most)
are broadcast, the others joined by an ordinary shuffle.

Edge cases: rows whose vector is null, holds null, NaN or infinite components
are dropped; so are vectors of another length than the first one's (smallest
id).  Where 8 does not divide the length, part i begins at floor(i * length /
8).  Null ids come last; equal ids are ordered by their vectors, so repeated
rows count each and get equal results.  With fewer than 16 kept vectors there
are as many entries.  Null labels form one group.  An empty table, or one where
nothing is kept, gives no rows.  Components beyond +-2^26 (|x| >= 16384) raise
an error, since sums of their squares do not fit a long.  Other columns are
ignored; there is no text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: split points of a node
DEGREE = 4
#: largest component of an integer vector
LARGEST = 1 << 26
#: relative rounding of a distance, far above that of the square root
SLACK = 2.0**-48
#: a label with more than 1/HEAVY_SHARE of the rows has its sum broadcast
HEAVY_SHARE = 256


def down(squared):
    return np.sqrt(np.asarray(squared, np.float64)) * (1 - SLACK)


def up(squared):
    return np.sqrt(np.asarray(squared, np.float64)) * (1 + SLACK)


def squared_distances(queries: np.ndarray, entry: np.ndarray) -> np.ndarray:
    d = queries - entry
    return np.einsum("ij,ij->i", d, d)


@dataclass
class Node:
    """``low[i, j]``..``high[i, j]`` encloses the distances from split point i
    to split point j and to all entries below it."""

    splits: list[int]
    low: np.ndarray
    high: np.ndarray
    children: list[Node | None] = field(default_factory=list)


def build_tree(entries: np.ndarray, members: list[int] | None = None, degree: int = DEGREE) -> Node:
    members = list(range(len(entries))) if members is None else members
    splits, apart = [members[0]], squared_distances(entries[members], entries[members[0]])
    while len(splits) < min(degree, len(members)):
        free = [i for i, m in enumerate(members) if m not in splits]
        far = max(free, key=lambda i: (apart[i], -members[i]))
        splits.append(members[far])
        apart = np.minimum(apart, squared_distances(entries[members], entries[members[far]]))
    groups: list[list[int]] = [[] for _ in splits]
    for m in members:
        if m not in splits:
            to = [int(squared_distances(entries[[m]], entries[s])[0]) for s in splits]
            groups[to.index(min(to))].append(m)
    low, high = np.zeros((len(splits),) * 2), np.zeros((len(splits),) * 2)
    for i, s in enumerate(splits):
        for j, group in enumerate(groups):
            d = squared_distances(entries[[splits[j], *group]], entries[s])
            low[i, j], high[i, j] = down(d.min()), up(d.max())
    return Node(splits, low, high, [build_tree(entries, g, degree) if g else None for g in groups])


class Search:
    """Nearest entries of many queries in one tree; ``computed`` counts the
    distances that were needed."""

    def __init__(self, entries: np.ndarray, tree: Node):
        self.entries, self.tree, self.computed = entries, tree, 0

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each query's nearest entry."""
        self.queries = queries
        self.best = np.full(len(queries), np.iinfo(np.int64).max)
        self.index = np.full(len(queries), len(self.entries), np.int64)
        self.visit(self.tree, np.arange(len(queries)))
        return self.index, self.best

    def visit(self, node: Node, rows: np.ndarray) -> None:
        # the distance to anything at or below split point j is at least bound[:, j]
        bound = np.zeros((len(rows), len(node.splits)))
        for i, s in enumerate(node.splits):
            open_ = np.flatnonzero(bound[:, i] <= up(self.best[rows]))
            if not len(open_):
                continue
            at = rows[open_]
            d = squared_distances(self.queries[at], self.entries[s])
            self.computed += len(at)
            better = (d < self.best[at]) | ((d == self.best[at]) & (s < self.index[at]))
            self.best[at[better]], self.index[at[better]] = d[better], s
            beyond = np.maximum(down(d)[:, None] - node.high[i], node.low[i] - up(d)[:, None])
            bound[open_] = np.maximum(bound[open_], beyond)
        for j, child in enumerate(node.children):
            if child is not None:
                left = rows[bound[:, j] <= up(self.best[rows])]
                if len(left):
                    self.visit(child, left)


@dataclass
class Codebooks:
    """The entries of every part position, and where the parts begin."""

    cuts: list[int]
    entries: list[np.ndarray]

    def searches(self) -> list[Search]:
        return [Search(e, build_tree(e)) for e in self.entries]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(int(x)) for e in self.entries for x in e.reshape(-1)).encode()).hexdigest()


def integer_vectors(vectors: DataFrame, column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id, label, v: the kept rows with integer components."""
    x = F.col(column).cast("array<double>")
    whole = x.isNotNull() & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    v = F.transform(x, lambda c: F.floor(c * scale))
    too_far = F.exists(v, lambda c: F.abs(c) > LARGEST)
    v = F.when(too_far, F.raise_error(F.lit(f"a component is beyond {LARGEST} after scaling"))).otherwise(v)
    return vectors.filter(whole).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), v.cast("array<int>").alias("v"))


def matrix(column: pa.ListArray | pa.ChunkedArray, n: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, -1)


def first_codebooks(rows: DataFrame, parts: int, entries: int) -> tuple[Codebooks, int] | None:
    """The parts of the first vectors, and the length of a vector."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("v")]
    smallest = rows.orderBy(*order).limit(1).select(F.size("v")).collect()
    if not smallest:
        return None
    length = smallest[0][0]
    first = rows.filter(F.size("v") == length).orderBy(*order).limit(entries).select("v").collect()
    v = np.array([r["v"] for r in first], np.int64).reshape(len(first), length)
    cuts = [i * length // parts for i in range(parts + 1)]
    return Codebooks(cuts, [v[:, a:b] for a, b in zip(cuts, cuts[1:], strict=False)]), length


def moved(rows: DataFrame, books: Codebooks) -> Codebooks:
    """One round: every used entry becomes the floor of the mean of its parts."""
    cuts, searches = books.cuts, books.searches()
    n_entries = len(books.entries[0])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((n_entries, b - a), np.int64) for a, b in zip(cuts, cuts[1:], strict=False)]
        counts = np.zeros((len(sums), n_entries), np.int64)
        for batch in batches:
            v = matrix(batch.column(0), batch.num_rows) if batch.num_rows else np.zeros((0, cuts[-1]), np.int64)
            for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                index, _ = searches[p].nearest(v[:, a:b])
                np.add.at(sums[p], index, v[:, a:b])
                counts[p] += np.bincount(index, minlength=n_entries)
        for p, s in enumerate(sums):
            used = np.flatnonzero(counts[p])
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([p] * len(used), pa.int32()), "entry": pa.array(used, pa.int32()), "n": pa.array(counts[p][used], pa.int64()),
                 "total": pa.array(s[used].tolist(), pa.list_(pa.int64()))}
            )

    schema = "part int, entry int, n long, total array<long>"
    each = rows.select("v").mapInArrow(add, schema).select("part", "entry", "n", F.posexplode_outer("total").alias("at", "x"))
    # sums of long columns can pass 2^63 on very many rows: decimals hold them
    total = each.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
    out = [e.copy() for e in books.entries]
    for r in total.collect():
        if r["at"] is not None:
            out[r["part"]][r["entry"], r["at"]] = int(r["x"]) // r["n"]
    return Codebooks(cuts, out)


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[Codebooks, int] | None:
    """Codebooks of a table of :func:`integer_vectors`; None if it is empty."""
    if entries > 256:
        raise ValueError("a code has two hex digits: at most 256 entries")
    start = first_codebooks(rows, parts, entries)
    if start is None:
        return None
    books, length = start
    same = rows.filter(F.size("v") == length)
    for _ in range(rounds):
        books = moved(same, books)
    return books, length


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, code, error of integer vectors of the codebooks' length."""
    cuts, searches = books.cuts, books.searches()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = matrix(batch.column(2), batch.num_rows)
            codes, error = np.zeros((len(v), len(searches)), np.uint8), np.zeros(len(v), np.int64)
            for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                index, d = searches[p].nearest(v[:, a:b])
                codes[:, p] = index
                error += d
            hexes = [c.tobytes().hex() for c in codes]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(hexes, pa.string()), pa.array(error, pa.int64())], names=["vec_id", "label", "code", "error"])

    label = rows.schema["label"].dataType.simpleString()
    return rows.select("vec_id", "label", "v").mapInArrow(assign, f"vec_id long, label {label}, code string, error long")


def decode(codes: DataFrame, books: Codebooks, scale: int = SCALE) -> DataFrame:
    """The given columns and ``restored``, the vector that each code stands for."""
    parts = [F.array(*[F.array(*[F.lit(int(x) / scale) for x in e]) for e in part]) for part in books.entries]
    index = lambda p: F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int")
    return codes.withColumn("restored", F.concat(*[F.element_at(part, index(p) + 1) for p, part in enumerate(parts)]))


def with_label_errors(coded: DataFrame) -> DataFrame:
    """Add label_error, the error summed over the rows of equal labels."""
    sums = written(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")), "label-errors")
    n_rows = sums.agg(F.sum("n")).collect()[0][0] or 0
    sums = sums.withColumnRenamed("label", "of_label")
    # the number of hot labels is bounded by the share: at most HEAVY_SHARE
    heavy = sums.filter(F.col("n") > n_rows // HEAVY_SHARE)
    hot = coded.join(F.broadcast(heavy), F.col("label").eqNullSafe(F.col("of_label")), "left")
    light = sums.filter(F.col("n") <= n_rows // HEAVY_SHARE)
    cold = hot.filter(F.col("n").isNull()).select(coded.columns).join(light, F.col("label").eqNullSafe(F.col("of_label")))
    columns = [*coded.columns, "label_error"]
    return hot.filter(F.col("n").isNotNull()).select(columns).unionByName(cold.select(columns))


def compressed(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256 of every kept vector."""
    rows = written(integer_vectors(vectors, scale=scale), "integer-vectors")
    trained = train(rows, parts, entries, rounds)
    if trained is None:
        label = rows.schema["label"].dataType.simpleString()
        return rows.sparkSession.createDataFrame([], f"vec_id long, label {label}, code string, error long, label_error long, codebooks_sha256 string")
    books, length = trained
    coded = written(encode(rows.filter(F.size("v") == length), books), "vector-codes")
    return with_label_errors(coded).withColumn("codebooks_sha256", F.lit(books.sha256()))


def compressed_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = compressed(table(spark, sf_dir, "embeddings"))
    return out.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def oracle_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same rounds in SQL, each part compared with every entry."""
    distance = "list_sum([(c.sub[i] - e.sub[i]) * (c.sub[i] - e.sub[i]) for i in range(1, len(c.sub) + 1)])"
    out = [
        f"""WITH ints AS MATERIALIZED (
  SELECT vec_id, label, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
kept AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS r FROM ints),
cells AS MATERIALIZED (
  SELECT r, p.p, v[p.p * len(v) // {parts} + 1 : (p.p + 1) * len(v) // {parts}] AS sub
  FROM kept, (SELECT unnest(range({parts})) AS p) p),
book0 AS MATERIALIZED (SELECT p, r - 1 AS entry, sub FROM cells WHERE r <= {entries})"""
    ]
    for k in range(rounds + 1):
        out.append(
            f"""near{k} AS MATERIALIZED (
  SELECT c.r, c.p, min(struct_pack(d := CAST({distance} AS BIGINT), entry := e.entry)) AS best, any_value(c.sub) AS sub
  FROM cells c JOIN book{k} e USING (p) GROUP BY c.r, c.p)"""
        )
        if k < rounds:
            out.append(
                f"""mean{k} AS MATERIALIZED (
  SELECT p, entry, list((s - ((s % n + n) % n)) // n ORDER BY pos) AS sub
  FROM (SELECT p, best.entry AS entry, pos, CAST(sum(sub[pos]) AS BIGINT) AS s, count(*) AS n
        FROM near{k}, (SELECT unnest(range(1, 1 + (SELECT max(len(sub)) FROM cells))) AS pos) x WHERE pos <= len(sub) GROUP BY ALL)
  GROUP BY p, entry),
book{k + 1} AS MATERIALIZED (
  SELECT b.p, b.entry, coalesce(m.sub, b.sub) AS sub FROM book{k} b LEFT JOIN mean{k} m USING (p, entry))"""
            )
    out.append(
        f"""coded AS (
  SELECT r, string_agg(printf('%02x', CAST(best.entry AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM near{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(sub, ','), ',' ORDER BY p, entry)) FROM book{rounds}) AS codebooks_sha256
FROM kept JOIN coded USING (r)"""
    )
    return ",\n".join(out[:-1]) + ",\n" + out[-1]
