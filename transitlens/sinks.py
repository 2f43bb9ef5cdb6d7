"""Sinks: text lines and the overwritten train snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .operators.latest import train_snapshot_lines
from .schema import TRAIN_HEADER
from .session import child_names, delete_path, folder_bytes, path_exists, replace_path, restore_path
from .sources.arrival import arrival_key


def write_lines(lines: DataFrame, path: str, column: str = "line", max_records_per_file: int | None = None) -> None:
    """Write one text line per row (bounded input), replacing ``path``;
    ``max_records_per_file`` rolls over to a new part file."""
    w = lines.select(F.col(column).alias("value")).write.mode("overwrite")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    w.text(path)


def stream_lines(lines: DataFrame, path: str, checkpoint: str, column: str = "line", trigger: dict | None = None) -> StreamingQuery:
    """Append text lines from a stream; the sink's commit log makes every
    line appear once even when a micro-batch is retried."""
    w = (
        lines.select(F.col(column).alias("value"))
        .writeStream.format("text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return w.trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def publish(lines: DataFrame, path: str, order: tuple[str, ...] = ("line",)) -> bool:
    """Make ``lines`` the one snapshot that readers find at ``path``, in one text
    file; left alone when it already holds the same lines.  The new snapshot is
    written beside it and moved into its place; until the move is done the one
    before stays readable beside it as ``path__old``, from where the next call
    restores it should a run end between the two moves.  A snapshot is a state
    of one line per vehicle at most, so one task sorts and writes it."""
    spark = lines.sparkSession
    lines = lines.persist()
    try:
        restore_path(spark, path)
        digest = [F.count(F.lit(1)), F.sum(F.xxhash64("line").cast("decimal(38,0)"))]
        if path_exists(spark, path):
            there = spark.read.text(path).select(F.col("value").alias("line"))
            if there.agg(*digest).first() == lines.agg(*digest).first():
                return False
        new = f"{path}__new"
        lines.repartition(1).sortWithinPartitions(*order).select(F.col("line").alias("value")).write.mode("overwrite").text(new)
        replace_path(spark, new, path)
        return True
    finally:
        lines.unpersist()


def write_train_snapshot(last_stop: DataFrame, path: str, header: str = TRAIN_HEADER) -> bool:
    """The snapshot: header line, then ``'id','stop','ms'`` per train."""
    return publish(train_snapshot_lines(last_stop, header), path, ("ord", "line"))


class RollingLines:
    """``foreachBatch`` sink of text lines in finished files.

    A micro-batch's lines go to ``path/_open/batch_id=N``.  Once the open
    batches hold ``roll_bytes``, or no new lines have come for
    ``idle_batches`` micro-batches, they roll over: their lines become one folder
    ``path/batches=FIRST-LAST`` (a file for each ``roll_bytes``, in the order of
    the batches), moved into place when it is complete, and the open folders go.
    So the files number about the bytes over ``roll_bytes``, not the batches.

    After a restart a replayed batch that has rolled over already is left
    alone, and open folders that a finished one covers are removed, so every
    line is there once.  ``lines`` reads all of them."""

    def __init__(self, path: str, order: tuple[str, ...], roll_bytes: int = 128 << 20, idle_batches: int = 12, show: bool = False):
        self.path, self.order, self.roll_bytes, self.idle_batches, self.show = path.rstrip("/"), order, roll_bytes, idle_batches, show

    def finished(self, spark: SparkSession) -> list[tuple[int, int]]:
        """(first, last) batch of each finished folder."""
        names = [n.removeprefix("batches=") for n in child_names(spark, self.path) if n.startswith("batches=")]
        return sorted(tuple(map(int, n.split("-"))) for n in names)

    def open_batches(self, spark: SparkSession) -> list[int]:
        last = max((b for _, b in self.finished(spark)), default=-1)
        found = [int(n.removeprefix("batch_id=")) for n in child_names(spark, f"{self.path}/_open") if n.startswith("batch_id=")]
        return sorted(b for b in found if b > last)

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        done = self.finished(spark)
        if any(first <= batch_id <= last for first, last in done):
            return
        df = df.persist()
        try:
            if not df.isEmpty():
                write_lines(df.orderBy(*self.order), f"{self.path}/_open/batch_id={batch_id}")
                if self.show:
                    show_lines(df.orderBy(*self.order))
        finally:
            df.unpersist()
        self.tidy(spark)
        waiting = self.open_batches(spark)
        size = sum(folder_bytes(spark, f"{self.path}/_open/batch_id={b}") for b in waiting)
        if waiting and (size >= self.roll_bytes or batch_id - waiting[-1] >= self.idle_batches):
            self.roll(spark, waiting, size)

    def tidy(self, spark: SparkSession) -> None:
        """Remove what a finished folder covers."""
        waiting = set(self.open_batches(spark))
        for n in child_names(spark, f"{self.path}/_open"):
            if n.startswith("batch_id=") and int(n.removeprefix("batch_id=")) not in waiting:
                delete_path(spark, f"{self.path}/_open/{n}")

    def roll(self, spark: SparkSession, batches: list[int], size: int) -> None:
        parts = spark.read.option("basePath", f"{self.path}/_open").text([f"{self.path}/_open/batch_id={b}" for b in batches])
        parts = parts.select("batch_id", arrival_key().alias("arrival"), F.monotonically_increasing_id().alias("row"), "value")
        n = max(1, -(-size // self.roll_bytes))
        lines = parts.repartitionByRange(n, "batch_id", "arrival", "row").sortWithinPartitions("batch_id", "arrival", "row")
        new = f"{self.path}/_rolling"
        lines.select("value").write.mode("overwrite").text(new)
        replace_path(spark, new, f"{self.path}/batches={batches[0]}-{batches[-1]}")
        self.tidy(spark)

    def lines(self, spark: SparkSession) -> DataFrame:
        """All lines, finished or open, as ``value``."""
        paths = [f"{self.path}/batches={a}-{b}" for a, b in self.finished(spark)]
        paths += [f"{self.path}/_open/batch_id={b}" for b in self.open_batches(spark)]
        return spark.read.schema("value string").text(paths) if paths else spark.createDataFrame([], "value string")


def show_lines(lines: DataFrame, n: int = 50) -> None:
    """Print the first lines to the console."""
    for row in lines.select("line").take(n):
        print(row["line"], flush=True)


def console(df: DataFrame, mode: str = "append", trigger: dict | None = None) -> StreamingQuery:
    """Print a stream's rows (console sink) for interactive use; aggregating
    streams need ``mode="update"`` or ``"complete"``."""
    return df.writeStream.format("console").outputMode(mode).trigger(**(trigger or {"processingTime": "5 seconds"})).start()
