"""Text sources: landing-directory scans, tokenising and JSON parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import CORRUPT_COLUMN, REPORT_COLUMNS, REPORT_JSON_SCHEMA
from .arrival import arrival_key, numbered

# lower part of a streamed line's provisional number: 22 bits below the milliseconds
ARRIVAL_PLACES = 1 << 22

_PARSE_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT_COLUMN,
    # documents written with single quotes are accepted as they are, so an
    # apostrophe inside a value (O'Brien) survives
    "allowSingleQuotes": "true",
}


def arriving_lines(
    spark: SparkSession,
    path: str,
    stream: bool = False,
    max_files_per_trigger: int | None = None,
    glob: str | None = None,
    whole_files: bool = False,
) -> DataFrame:
    """Lines of the landing directory as ``(arrival, source_file, value)``, not
    numbered yet (see ``sources.arrival``); with ``whole_files`` a file is one
    value, so that a document may run over several lines."""
    if not path:
        raise ValueError("an input path is required")
    reader = spark.readStream if stream else spark.read
    reader = reader.format("text").option("wholetext", str(whole_files).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path).select(arrival_key().alias("arrival"), F.col("_metadata.file_path").alias("source_file"), "value")


def with_provisional_seq(lines: DataFrame) -> DataFrame:
    """A streamed line's ``seq`` until its micro-batch is numbered: when its
    file landed, and a hash to tell lines apart.  ``arrival`` stays beside it."""
    place = F.pmod(F.xxhash64("source_file", "value"), F.lit(ARRIVAL_PLACES))
    return lines.withColumn("seq", F.col("arrival.landed") * ARRIVAL_PLACES + place)


def read_report_lines(
    spark: SparkSession,
    path: str,
    stream: bool = False,
    max_files_per_trigger: int | None = None,
    glob: str | None = None,
) -> DataFrame:
    """Lines of the landing directory ``path`` as ``(seq, source_file, value)``.

    Batch: a bounded scan of the files present now.  Stream: the directory is
    watched; ``max_files_per_trigger`` bounds a micro-batch.  Writers must
    land files atomically (write elsewhere, then rename) so that no partial
    document is read.  ``seq`` is the order of arrival, unique and without gaps:
    by the file's modification time, its path and the place in the file.  In a
    stream it is provisional, and the column ``arrival`` lets
    ``arrival.numbered_writer`` number each micro-batch."""
    lines = arriving_lines(spark, path, stream, max_files_per_trigger, glob)
    if stream:
        return with_provisional_seq(lines).select("seq", "arrival", "source_file", "value")
    return numbered(lines)


ORDER_COLUMNS = ("seq", "arrival")


def _order_columns(lines: DataFrame) -> list[str]:
    return [c for c in ORDER_COLUMNS if c in lines.columns]


def tokenize_lines(lines: DataFrame) -> DataFrame:
    """One row per whitespace-separated token of each line, empty tokens
    dropped: ``(seq, pos, token)``.  Several documents on one line become
    several tokens; a document that itself holds a space is torn apart, as
    whitespace splitting implies."""
    toks = lines.select(
        *_order_columns(lines),
        F.posexplode(F.split(F.trim(F.col("value")), r"\s+")).alias("pos", "token"),
    )
    return toks.where(F.length("token") > 0)


BARE_FLAG = r"""["']isinactive["']\s*:\s*(true|false)"""


def _parsed(lines: DataFrame, text_col: str):
    """Each line with its parsed document as one struct column ``_r``: the flat
    report fields plus ``_corrupt_record`` and the raw ``_text``."""
    doc = F.from_json(F.col(text_col), REPORT_JSON_SCHEMA, _PARSE_OPTIONS)
    parsed = lines.select(*_order_columns(lines), F.col(text_col).alias("_text"), doc.alias("_doc"))
    a = F.col("_doc.attributes")
    row = F.struct(
        a["id"].alias("id"),
        a["bearing"].alias("bearing"),
        # the flag is text; an unquoted true or false is another value
        F.when(~F.col("_text").rlike(BARE_FLAG), a["isinactive"]).alias("isinactive"),
        a["ltype"].alias("ltype"),
        a["delay"].try_cast("double").alias("delay"),
        a["lastupdate"].alias("lastupdate"),
        a["laststopid"].alias("laststopid"),
        # a document without attributes (e.g. "{}") counts as corrupt too
        F.coalesce(
            F.col(f"_doc.{CORRUPT_COLUMN}"),
            F.when(a.isNull(), F.coalesce(F.col("_text"), F.lit(""))),
        ).alias(CORRUPT_COLUMN),
        F.col("_text").alias("_text"),
    )
    return parsed.select(*_order_columns(lines), row.alias("_r"))


# objects nested deeper than this are not told apart
DOCUMENT_DEPTH = 8
# stands between documents while a text is cut; JSON allows it nowhere
CUT = "\u0000"


def document_pattern(depth: int = DOCUMENT_DEPTH) -> str:
    """A JSON object as a regular expression: strings in either quotes with
    their escapes, objects nested up to ``depth`` levels.  All loops are
    possessive, so that a long document needs neither stack nor retries."""
    text = "|".join(rf"{q}(?:[^{q}\\]++|\\[\s\S])*+{q}" for q in ('"', "'"))
    inner = rf"""(?:[^{{}}"']++|{text})*+"""
    for _ in range(depth):
        inner = rf"""(?:[^{{}}"']++|{text}|\{{{inner}\}})*+"""
    return rf"\{{{inner}\}}"


def split_documents(lines: DataFrame) -> DataFrame:
    """One row per JSON document when several share a line (or a whole file):
    ``(seq, pos, token)``.  A document ends at the brace that closes it, so
    braces and spaces inside its strings do not matter, and the next one may
    follow without a space.  Text between documents, and a document that is
    never closed, becomes a row of its own (which does not parse).  Built-in
    expressions only.  (The JSON parser reads the first document of a line and
    ignores the rest, so without this split a second one would be lost.)"""
    cut = F.regexp_replace("value", f"({document_pattern()})", f"{CUT}$1{CUT}")
    pieces = F.filter(F.transform(F.split(cut, CUT), lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), lambda x: F.length(x) > 0)
    return lines.select(*_order_columns(lines), F.posexplode(pieces).alias("pos", "token"))


def parse_report_lines(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """Parse JSON documents into the flat report columns plus the raw text of
    any document that did not parse (``_corrupt_record``) and the line itself
    (``_text``)."""
    return _parsed(lines, text_col).select(*_order_columns(lines), "_r.*")


def _keep(lines: DataFrame, text_col: str, corrupt: bool) -> DataFrame:
    # The parse is wrapped in a one-element array that is filtered and then
    # inlined: a filter on the parsed fields cannot be pushed below the
    # generator, so every line is parsed once (a plain where() would be pushed
    # under the projection and evaluate from_json a second time).
    p = _parsed(lines, text_col)
    test = (lambda r: r[CORRUPT_COLUMN].isNotNull()) if corrupt else (lambda r: r[CORRUPT_COLUMN].isNull())
    kept = p.select(*_order_columns(lines), F.explode(F.filter(F.array("_r"), test)).alias("_r"))
    return kept.select(*_order_columns(lines), "_r.*")


def parse_reports(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """Well-formed reports only (streamed ones keep their ``arrival``)."""
    kept = _keep(lines, text_col, corrupt=False)
    return kept.select(*REPORT_COLUMNS, *[c for c in ("arrival",) if c in kept.columns])


def corrupt_reports(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """Documents that did not parse, kept aside as ``(seq, value)``."""
    return _keep(lines, text_col, corrupt=True).select("seq", F.col("_text").alias("value"))
