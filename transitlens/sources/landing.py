"""One entry point for report input: a landing directory read as a bounded
table or watched as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrival import numbered
from .text import arriving_lines, parse_reports, split_documents, tokenize_lines, with_provisional_seq

SPLITS = ("documents", "whitespace", "none", "files")

MODES = ("batch", "bulk", "stream")


def report_source(
    spark: SparkSession,
    path: str,
    mode: str = "batch",
    split: str = "documents",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Reports from the JSON files under ``path``.

    ``mode``: "batch" (or "bulk") reads the files present now; "stream" watches
    the directory.  ``split``: "documents" (default) cuts a line after each
    document, "whitespace" cuts at every run of whitespace (compact documents
    only; a document holding a space is torn and lands among the corrupt ones),
    "none" takes each line as one document, "files" cuts whole files, whose
    documents may run over several lines (a file must fit into a row).

    ``seq`` numbers the documents in their order of arrival, each one once; in a
    stream the numbers are given to each micro-batch (``run_foreach``).
    """
    if not path:
        raise ValueError("an input path is required")
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; use one of {MODES}")
    if split not in SPLITS:
        raise ValueError(f"unknown split {split!r}; use one of {SPLITS}")
    stream = mode == "stream"
    lines = arriving_lines(spark, path, stream, max_files_per_trigger, whole_files=split == "files")
    if split != "none":
        toks = tokenize_lines(lines) if split == "whitespace" else split_documents(lines)
        lines = toks.select("arrival", F.col("arrival.file").alias("source_file"), F.col("token").alias("value"))
    return parse_reports(with_provisional_seq(lines) if stream else numbered(lines))
