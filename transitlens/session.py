"""Session construction and the shared folder used for checkpoints and sinks."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "transitlens") -> SparkSession:
    """Session for tests and benchmarks.  On a cluster, use the cluster's own
    session; nothing in the library depends on these settings except UTC for
    rendered timestamps."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.  Where a local
    session (tests) names none, a folder in its SQL warehouse; a cluster has to
    name one, since nothing else is known to be shared by its executors."""
    sc = spark.sparkContext
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if not path:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        path = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_transitlens"
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unique location under the shared folder (one per run)."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: what follows can
    read it more than once, and a lost executor costs a re-read only.  With a
    ``path`` of the caller's, that folder is overwritten (a stream uses one and
    the same for all its micro-batches)."""
    path = path or fresh_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists; any other failure is raised."""
    p, fs = _hadoop(spark, path)
    return fs.exists(p)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none when it is not there."""
    p, fs = _hadoop(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []


def folder_bytes(spark: SparkSession, path: str) -> int:
    p, fs = _hadoop(spark, path)
    return fs.getContentSummary(p).getLength()


def delete_path(spark: SparkSession, path: str) -> None:
    p, fs = _hadoop(spark, path)
    fs.delete(p, True)


def _move(spark: SparkSession, source: str, to: str) -> None:
    p, fs = _hadoop(spark, source)
    if not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"cannot move {source} to {to}")


def restore_path(spark: SparkSession, path: str) -> None:
    """Put back what a run that ended inside ``replace_path`` moved aside."""
    old = f"{path}__old"
    if path_exists(spark, old):
        delete_path(spark, old) if path_exists(spark, path) else _move(spark, old, path)


def replace_path(spark: SparkSession, new: str, path: str) -> None:
    """Move the folder ``new`` to ``path``, in place of what is there.  What was
    there is moved aside first and deleted last, so it is never lost."""
    restore_path(spark, path)
    if path_exists(spark, path):
        _move(spark, path, f"{path}__old")
    _move(spark, new, path)
    delete_path(spark, f"{path}__old")
