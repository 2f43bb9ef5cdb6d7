"""Exact duplicates: heavy-hitter split over text digests.

Texts are equal when they are identical after every run of ASCII white space
became one space; null counts as empty.  The digest is the SHA-256 of the
normalised text.

1. A Misra-Gries summary per task (mergeable, at most ``counters`` entries)
   names every digest that may hold more than ``1 / heavy_share`` of the rows.
2. The candidates (a few hundred at most, by the summary's own bound) are
   recounted exactly; the verified winners (digest, row that stays, count) are
   broadcast, and the rows of these groups are decided where they are read.
3. All other groups go through an ordinary shuffle on the digest: added up per
   task first, then one row per group meets its members (a join, which adaptive
   execution splits where a group is large; no group is sorted or held).

Edge cases: null text equals empty text; a null ``doc_id`` sorts after all
others; of repeated rows (same id, equal text) exactly one stays; an empty
table gives an empty result; other columns are ignored by
:func:`exact_duplicates` and kept by :func:`drop_exact_duplicates`.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, text_or_empty, written

#: a group with more than 1/HEAVY_SHARE of all rows is decided map-side
HEAVY_SHARE = 256
#: counters of each task's summary
COUNTERS = 1024


def digest_column(col: str = "text"):
    return F.unhex(F.sha2(F.regexp_replace(text_or_empty(col), ASCII_SPACE, " ").cast("binary"), 256))


def trim_summary(counts: dict, counters: int) -> dict:
    """Misra-Gries reduction: subtract the (counters+1)-th largest count."""
    if len(counts) <= counters:
        return counts
    cut = sorted(counts.values(), reverse=True)[counters]
    return {k: v - cut for k, v in counts.items() if v > cut}


def misra_gries(batches: Iterable[pa.RecordBatch], counters: int) -> dict:
    """Summary of the first column of the batches; every value's counter is
    short of its true count by at most rows / (counters + 1)."""
    counts: dict = {}
    for b in batches:
        for pair in pc.value_counts(b.column(0)).to_pylist():
            counts[pair["values"]] = counts.get(pair["values"], 0) + pair["counts"]
        counts = trim_summary(counts, counters)
    return counts


def frequent_digests(rows: DataFrame, n_rows: int, heavy_share: int, counters: int) -> list:
    """Digests that may hold more than n_rows / heavy_share rows (no false
    negatives).  At most 1 / (1/heavy_share - 1/(counters+1)) of them."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = misra_gries(batches, counters)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["digest", "n"]
        )

    floor = n_rows / heavy_share - n_rows / (counters + 1)
    merged = (
        rows.select("digest").mapInArrow(summarise, "digest binary, n long").groupBy("digest").agg(F.sum("n").alias("n"))
    )
    return [r["digest"] for r in merged.filter(F.col("n") >= F.lit(float(floor))).select("digest").collect()]


def decide(rows: DataFrame, heavy_share: int = HEAVY_SHARE, counters: int = COUNTERS) -> DataFrame:
    """rows(doc_id, digest, row_id) -> the same with keep_id, group_size, kept."""
    spark = rows.sparkSession
    n_rows = rows.count()
    candidates = frequent_digests(rows, n_rows, heavy_share, counters)
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("row_id").alias("row"))
    named = spark.createDataFrame([(bytes(d),) for d in candidates], "digest binary")
    grouped = [F.min(order).alias("first"), F.count(F.lit(1)).alias("group_size")]
    winners = rows.join(F.broadcast(named), "digest", "left_semi").groupBy("digest").agg(*grouped)
    # at most heavy_share rows, since each holds more than 1/heavy_share of the table
    heaviest = winners.filter(F.col("group_size") > F.lit(n_rows / heavy_share)).collect() if candidates else []
    won = [(bytes(r["digest"]), r["first"]["id"], r["first"]["row"], r["group_size"]) for r in heaviest]
    verified = spark.createDataFrame(won, "digest binary, keep_id long, keep_row long, group_size long")
    others = rows.join(F.broadcast(verified.select("digest")), "digest", "left_anti")
    groups = others.groupBy("digest").agg(*grouped)
    groups = groups.select("digest", F.col("first.id").alias("keep_id"), F.col("first.row").alias("keep_row"), "group_size")
    heavy, light = rows.join(F.broadcast(verified), "digest"), others.join(groups, "digest")
    return heavy.unionByName(light).withColumn("kept", F.col("row_id") == F.col("keep_row"))


def digest_table(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest_column().alias("digest"))
    # the row number is fixed by writing the table: every later step reads it
    return written(rows.withColumn("row_id", F.monotonically_increasing_id()), "digests")


def exact_duplicates(docs: DataFrame, heavy_share: int = HEAVY_SHARE, counters: int = COUNTERS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    out = decide(digest_table(docs), heavy_share, counters)
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, heavy_share: int = HEAVY_SHARE, counters: int = COUNTERS) -> DataFrame:
    """The documents that stay, with all their columns."""
    same = decide(digest_table(docs), heavy_share, counters).filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    keep = same.groupBy(F.col("digest").alias("__keep_digest"), F.col("keep_id").alias("__keep_id")).agg((F.count(F.lit(1)) > 1).alias("__repeated"))
    marked = docs.withColumn("__digest", digest_column()).join(
        keep, F.col("__digest").eqNullSafe(F.col("__keep_digest")) & F.col("doc_id").eqNullSafe(F.col("__keep_id"))
    )
    once = marked.filter(~F.col("__repeated"))
    again = marked.filter("__repeated").dropDuplicates(["__digest"])
    return once.unionByName(again).select(docs.columns)


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
