"""The order of arrival as unique numbers.

A row read from files has the key ``arrival``: when its file landed, the file,
and where the file split begins that it was read from; rows of a split follow
each other as they were read.  One row per split (least row number, count) gives
every split its first number, and a row's number is that plus its place in the
split, so the numbers run 0, 1, 2, ... without gaps or repeats, whatever files
share a time and however a large file was cut.  The splits are a table of their
own: Spark broadcasts it where it is small and joins by shuffle beyond that.

A micro-batch is numbered when it is written, since a stream cannot number rows:
the batch's id is the upper part of the number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

#: numbers of a micro-batch begin at its id times this
BATCH_NUMBERS = 1 << 40


def arrival_key() -> Column:
    """Key of a file source's row; files of one time follow by their path."""
    m = "_metadata"
    return F.struct(
        F.unix_millis(f"{m}.file_modification_time").alias("landed"),
        F.col(f"{m}.file_path").alias("file"),
        F.col(f"{m}.file_block_start").alias("block"),
    )


def split_starts(rows: DataFrame) -> DataFrame:
    """``(_split, _first, _start)`` per split of rows with ``arrival`` and
    ``_row``: its least row number and the number its rows begin at."""
    splits = rows.groupBy("arrival").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # one row per split in one task
    before = Window.orderBy("arrival").rowsBetween(Window.unboundedPreceding, -1)
    return splits.select(F.col("arrival").alias("_split"), "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))


def _with_numbers(rows: DataFrame, starts: DataFrame, first: int) -> DataFrame:
    columns = [c for c in rows.columns if c not in ("arrival", "_row", "seq")]
    # every row has its split; an outer join, so that only the splits can be broadcast
    numbered = rows.join(starts, F.col("arrival") == F.col("_split"), "left")
    seq = F.col("_start") + F.col("_row") - F.col("_first") + F.lit(first)
    return numbered.select(seq.cast("bigint").alias("seq"), *columns)


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` read from files, ``arrival`` replaced by ``seq``: 0, 1, 2, ...
    The files are read once more for the counts of their splits."""
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    return _with_numbers(rows, written(split_starts(rows), "splits"), 0)


def numbered_writer(writer):
    """``foreachBatch`` function that gives ``writer`` each micro-batch with
    unique numbers in ``seq`` (if its rows have an ``arrival``)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if "arrival" not in batch.columns:
            return writer(batch, batch_id)
        batch = batch.withColumn("_row", F.monotonically_increasing_id()).persist()
        try:
            # one row per file split of the micro-batch
            found = split_starts(batch)
            starts = batch.sparkSession.createDataFrame(found.collect(), found.schema)
            writer(_with_numbers(batch, starts, batch_id * BATCH_NUMBERS), batch_id)
        finally:
            batch.unpersist()

    return write
