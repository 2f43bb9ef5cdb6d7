"""Run streaming queries to completion and read their output back."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..session import fresh_path
from ..sources.arrival import numbered_writer
from .merges import latest_state, previous_snapshot, write_state


#: settings of a state store that writes what changed
KEYED_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their keyed state in RocksDB and write the
    changes of each micro-batch to the checkpoint; afterwards the session's
    settings are as before."""
    before = {k: spark.conf.get(k, None) for k in KEYED_STATE}
    for k, v in KEYED_STATE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run_append(df: DataFrame, name: str, out: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Append ``df`` into a Parquet folder until the input is exhausted
    (``availableNow``); the file sink's log makes this exactly-once across
    restarts.  Returns the folder as a batch DataFrame."""
    spark = df.sparkSession
    out = out or fresh_path(spark, f"{name}-out")
    checkpoint = checkpoint or fresh_path(spark, f"{name}-ckpt")
    q = (
        df.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()  # raises what ended the query
    return spark.read.schema(df.schema).parquet(out)


def run_snapshots(
    df: DataFrame,
    name: str,
    to_snapshot: Callable[[DataFrame], DataFrame],
    mode: str = "complete",
    out: str | None = None,
    checkpoint: str | None = None,
    key: Sequence[str] = (),
) -> DataFrame:
    """Run an aggregating stream; after every micro-batch ``to_snapshot`` turns
    the batch's result into the snapshot, kept in two alternating slots.  In
    update mode a batch holds only the rows that changed: they replace the rows
    of the same ``key`` in the snapshot before.  Returns the newest snapshot."""
    if mode == "update" and not key:
        raise ValueError("update mode needs the key its rows are merged by")
    spark = df.sparkSession
    out = out or fresh_path(spark, f"{name}-out")

    def write(batch: DataFrame, batch_id: int) -> None:
        snapshot = to_snapshot(batch)
        if mode == "update":
            snapshot = snapshot.persist()  # used by the merge and the write
            before = previous_snapshot(batch.sparkSession, out, batch_id)
            merged = snapshot if before is None else before.join(snapshot, list(key), "left_anti").unionByName(snapshot)
            write_state(merged, out, batch_id)
            snapshot.unpersist()
        else:
            write_state(snapshot, out, batch_id)

    run_foreach(df, name, write, checkpoint, mode)
    return latest_state(spark, out)


def run_foreach(df: DataFrame, name: str, writer, checkpoint: str | None = None, mode: str = "append") -> None:
    """Run a stream to completion through a ``foreachBatch`` writer; reports
    read from text files get their unique numbers here."""
    checkpoint = checkpoint or fresh_path(df.sparkSession, f"{name}-ckpt")
    q = (
        df.writeStream.foreachBatch(numbered_writer(writer))
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()  # raises what ended the query
