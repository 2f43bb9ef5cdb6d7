"""The ``events`` table as files that land one after the other, out of order, so
that the streamed questions see several micro-batches and late reports.

Row e belongs to arrival batch

    ((t - lo + j) * B) div (hi - lo + JITTER_MS)

with t its epoch milliseconds, lo and hi the table's first and last, B = max(6,
rows div 2,000,000), and the delay j the first 8 hex digits of the MD5 of its
``event_id`` modulo JITTER_MS.  A report is thus at most JITTER_MS behind the
newest one of the batches before; since the jitter is a good part of the span of
a batch, many are behind it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path
from .events import epoch_millis, load_table, report_lines_from_events

JITTER_MS = 2 * 24 * 3600 * 1000
LEAST_BATCHES = 6
ROWS_PER_FILE = 2_000_000
ROW_GROUP_BYTES = 1 << 20
LANDED_MS = 1_600_000_000_000

_landed: dict[tuple[str, str], str] = {}


def arrival_batch(lo: int, hi: int, batches: int):
    jitter = F.conv(F.substring(F.md5(F.col("event_id").cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint") % JITTER_MS
    shifted = epoch_millis("ts") - F.lit(lo) + jitter
    return F.floor(shifted * batches / F.lit(hi - lo + JITTER_MS)).cast("int")


def state_landing_times(spark: SparkSession, files: list[tuple[str, int]]) -> None:
    """Set the modification times (ms) of files: the order in which they landed."""
    for name, at in files:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).setTimes(path, at, -1)


def files_below(spark: SparkSession, folder: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return sorted(f.getPath().toString() for f in found if f.getPath().getName().startswith(("part-", "b=")))


def land_events(spark: SparkSession, sf_dir: str) -> str:
    """Folder with one Parquet file per arrival batch, in landing order; made
    once per application and table."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landed:
        events = load_table(spark, sf_dir, "events")
        t = epoch_millis("ts")
        lo, hi, n = events.agg(F.min(t), F.max(t), F.count(F.lit(1))).first()
        batches = max(LEAST_BATCHES, n // ROWS_PER_FILE)
        out = fresh_path(spark, "landing")
        numbered = events.withColumn("b", arrival_batch(lo or 0, hi or 0, batches))
        # a task per file, and row groups that several tasks can read
        numbered.repartitionById(batches, F.col("b")).write.option("parquet.block.size", ROW_GROUP_BYTES).partitionBy("b").parquet(out)
        # a file stream takes the oldest file first: state the landing order
        folders = files_below(spark, out)
        batch = lambda f: int(f.rstrip("/").rsplit("b=", 1)[1])
        state_landing_times(spark, [(f, LANDED_MS + 10_000 * batch(d)) for d in folders for f in files_below(spark, d)])
        _landed[key] = out
    return _landed[key]


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a stream, one arrival batch per micro-batch."""
    schema = load_table(spark, sf_dir, "events").schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").option("recursiveFileLookup", "true")
    return reader.parquet(land_events(spark, sf_dir))


#: pairs of documents that change places in the landing files, and the factor
#: (prime to it) that says how
SHUFFLED_PAIRS, PAIR_STEP = 64, 37
TEXT_FILES = 12

_landed_text: dict[tuple[str, str], str] = {}


def land_text(spark: SparkSession, sf_dir: str) -> str:
    """Folder of text files with two documents a line.

    The events 2k and 2k + 1 stand on one line, the second one first; of 64
    lines in a row, line k comes in place (37 k) mod 64.  The files hold
    ranges of these lines and land two at a time, with the same time.  Event
    times are cut to the hour, so that reports of one time abound and the order
    of arrival decides."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landed_text:
        hour = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00' + make_dt_interval(0, int(timestampdiff(HOUR, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)), 0, 0)")
        lines = report_lines_from_events(load_table(spark, sf_dir, "events").withColumn("ts", hour))
        pair = F.floor(F.col("seq") / 2).cast("bigint")
        both = F.array_sort(F.collect_list(F.struct((-F.col("seq")).alias("at"), "value")))
        lines = lines.groupBy(pair.alias("pair")).agg(F.array_join(F.transform(both, lambda x: x["value"]), " ").alias("value"))
        at = F.floor(F.col("pair") / SHUFFLED_PAIRS) * SHUFFLED_PAIRS + (F.col("pair") % SHUFFLED_PAIRS) * PAIR_STEP % SHUFFLED_PAIRS
        out = fresh_path(spark, "landing-pairs")
        lines.withColumn("at", at).repartitionByRange(TEXT_FILES, "at").sortWithinPartitions("at").select("value").write.text(out)
        files = files_below(spark, out)
        state_landing_times(spark, [(f, LANDED_MS + 10_000 * (i // 2)) for i, f in enumerate(files)])
        _landed_text[key] = out
    return _landed_text[key]
