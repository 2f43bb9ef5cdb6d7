"""Command-line runner: one of the six questions over a landing directory.

    python -m transitlens -d LANDING_DIR -o OUT_DIR -q 1..6 [--batch | --once]

Default: a continuous stream polling every 5 seconds.  ``--once`` processes
what is there and stops (``availableNow``); ``--batch`` uses a bounded read.
The checkpoint lives in ``spark.checkpoint.dir`` (or ``OUT_DIR/_checkpoints``
when the session names none), so a restarted job resumes where it stopped.
"""

from __future__ import annotations

import argparse
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sinks, streaming
from .functions import number_text
from .operators import filters, gaps, latest, recent, topk, windows
from .schema import TOP_N, TRAIN_HEADER
from .session import build_session
from .sources import report_source
from .sources.arrival import numbered_writer

QUESTIONS = {
    "1": "vehicles heading north (±45°)",
    "2": "last stop and update time of every train",
    "3": "at most 5 delayed vehicles by last reported delay",
    "4": "at most 5 delayed vehicles reported in the last 3 minutes, newest first",
    "5": "mean delay of all vehicles reported in the last 3 minutes (sliding 5 s)",
    "6": "mean time between reports over the last 10 reports",
}


def _trigger(once: bool) -> dict:
    return {"availableNow": True} if once else {"processingTime": "5 seconds"}


def question_lines(r: DataFrame, q: str) -> tuple[DataFrame, tuple[str, ...], str]:
    """(lines, their order, folder) of a question over a bounded table."""
    if q == "1":
        return filters.north_lines(filters.active(r)), ("line",), "heading_north"
    if q == "2":
        return latest.train_snapshot_lines(latest.train_last_stop(r), TRAIN_HEADER), ("ord", "line"), "trains"
    if q == "3":
        return topk.top_list_json(topk.top_delayed(r)), ("line",), "delayed"
    if q == "4":
        return recent.list_lines(recent.recent_changes(r)), ("t", "seq"), "delayed3minutes"
    if q == "5":
        return average_lines(windows.sliding_average(r)), ("window_start_ms",), "averagedelay"
    if q == "6":
        return gap_lines(gaps.gap_text(gaps.gap_timeline(r), "lastupdate")), ("lastupdate", "seq"), "last10reports"
    raise ValueError(f"unknown question {q}")


def average_lines(averages: DataFrame) -> DataFrame:
    return averages.select("window_start_ms", number_text("avg_delay").alias("line"))


def gap_lines(texts: DataFrame) -> DataFrame:
    return texts.select("seq", "lastupdate", F.col("gap_text").alias("line"))


def run_batch(spark: SparkSession, src: str, out: str, q: str, show: bool = False) -> None:
    lines, order, folder = question_lines(report_source(spark, src), q)
    if q in "23":
        sinks.publish(lines, f"{out}/{folder}", order)
    else:
        sinks.write_lines(lines.orderBy(*order), f"{out}/{folder}")
    if show:
        sinks.show_lines(lines.orderBy(*order))


def run_stream(spark: SparkSession, src: str, out: str, q: str, once: bool, show: bool = False) -> None:
    """The same lines as a bounded run, as the reports come in.  Answers per
    report (4 and 6) and per window (5) follow once they are settled: when the
    newest event time lies the lateness (10 s) beyond them.  Reports that come
    later than that go to a folder of their own."""
    ck = spark.conf.get("spark.checkpoint.dir", None) or f"{out}/_checkpoints"
    # stable per (output, question): a restarted job finds its own checkpoint
    ck = f"{ck.rstrip('/')}/question-{q}-{hashlib.sha1(out.encode()).hexdigest()[:10]}"
    r = streaming.report_stream_from_text(spark, src)
    df, queries = r, []

    def start(frame, writer, checkpoint):
        w = frame.writeStream.foreachBatch(numbered_writer(writer)).option("checkpointLocation", checkpoint)
        queries.append(w.trigger(**_trigger(once)).start())

    if q == "1":
        df, write = filters.north_lines(filters.active(r)), sinks.RollingLines(f"{out}/heading_north", ("line",), show=show)
    elif q in ("2", "3"):
        folder = "trains" if q == "2" else "delayed"

        def snapshot(b, i):
            if q == "2":
                lines, order = latest.train_snapshot_lines(latest.as_last_stop(b), TRAIN_HEADER), ("ord", "line")
            else:
                lines, order = topk.top_list_json(topk.top_k(filters.delayed(b), TOP_N, topk.delay_order())), ("line",)
            if sinks.publish(lines, f"{out}/{folder}", order) and show:
                sinks.show_lines(lines.orderBy(*order))

        rows = (lambda b: filters.trains(filters.active(b))) if q == "2" else filters.active
        write = streaming.latest_writer(f"{out}/_{folder}", rows, latest.LAST_STOP if q == "2" else ("delay", "lastupdate"), sink=snapshot)
    elif q == "4":
        sink = sinks.RollingLines(f"{out}/delayed3minutes", ("t", "seq"), show=show)
        write = streaming.recent_changes_writer(f"{out}/_delayed3minutes", sink=lambda b, i: sink(recent.list_lines(b), i))
    elif q == "5":
        sink = sinks.RollingLines(f"{out}/averagedelay", ("window_start_ms",), show=show)
        df, write = streaming.sliding_average_stream(r), lambda b, i: sink(average_lines(b), i)
        start(filters.active(r), streaming.late_rows_writer(f"{out}/_averagedelay"), f"{ck}-late")
    elif q == "6":
        sink = sinks.RollingLines(f"{out}/last10reports", ("lastupdate", "seq"), show=show)
        write = streaming.gap_text_writer(f"{out}/_last10reports", sink=lambda b, i: sink(gap_lines(b), i))
    else:
        raise ValueError(f"unknown question {q}")
    start(df, write, ck)
    for query in queries:
        query.awaitTermination()


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="transitlens", description="Vehicle report questions on Spark")
    p.add_argument("-d", "--input", required=True, help="landing directory of JSON report files")
    p.add_argument("-o", "--output", required=True, help="output directory")
    p.add_argument("-q", "--question", required=True, choices=sorted(QUESTIONS), help="; ".join(f"{k}: {v}" for k, v in QUESTIONS.items()))
    g = p.add_mutually_exclusive_group()
    g.add_argument("--batch", action="store_true", help="bounded read of the files present now")
    g.add_argument("--once", action="store_true", help="stream what is there, then stop")
    p.add_argument("--console", action="store_true", help="print the answers too")
    p.add_argument("--master", default=None, help="Spark master for a local run, e.g. local[8]")
    a = p.parse_args(argv)
    spark = build_session(a.master) if a.master else SparkSession.builder.getOrCreate()
    if a.batch:
        run_batch(spark, a.input, a.output, a.question, a.console)
    else:
        run_stream(spark, a.input, a.output, a.question, a.once, a.console)


if __name__ == "__main__":
    main()
