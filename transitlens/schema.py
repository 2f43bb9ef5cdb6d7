"""Report schema and the fixed values the queries are defined by."""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# ---------------------------------------------------------------------------
# Fixed values (they define the semantics of the six questions):
#   a report counts only when attributes.isinactive equals the text "false";
#   a train is a report with ltype 5;
#   a vehicle heads north when its bearing lies in [315, 360] or [0, 45];
#   a vehicle is delayed when delay > 0;
#   top lists hold 5 vehicles;
#   the trailing window and the sliding window span 3 minutes, the slide is 5 seconds;
#   the mean gap is taken over the last 10 reports;
#   event time may lag by at most 10 seconds (watermark);
#   the train snapshot starts with the header line "id,laststop,lastupdate".
# ---------------------------------------------------------------------------
ACTIVE_FLAG = "false"
TRAIN_LTYPE = 5
NORTH_CENTER = 0.0
NORTH_TOLERANCE = 45.0
TOP_N = 5
TRAILING_MS = 3 * 60 * 1000
SLIDE_MS = 5 * 1000
LAST_N = 10
WATERMARK = "10 seconds"
# how far behind the newest event time a report may come (streamed answers)
LATENESS_MS = 10 * 1000
TRAIN_HEADER = "id,laststop,lastupdate"

# Dense variant used on data whose reports are minutes apart: 6 h windows
# sliding by 10 min keep the 36-windows-per-report shape of the 3 min / 5 s one.
TRAILING_6H_MS = 6 * 60 * 60 * 1000
SLIDE_10MIN_MS = 10 * 60 * 1000

# JSON layout of one report.  ``delay`` is read as text and converted with
# try_cast, so an empty string becomes null instead of spoiling the record.
ATTRIBUTES = StructType(
    [
        StructField("id", StringType()),
        StructField("bearing", DoubleType()),
        StructField("isinactive", StringType()),
        StructField("ltype", IntegerType()),
        StructField("delay", StringType()),
        StructField("lastupdate", LongType()),
        StructField("laststopid", StringType()),
    ]
)
CORRUPT_COLUMN = "_corrupt_record"
REPORT_JSON_SCHEMA = StructType(
    [
        StructField("attributes", ATTRIBUTES),
        StructField(CORRUPT_COLUMN, StringType()),
    ]
)

# Flat report columns every operator works on.  ``seq`` is the arrival order
# and breaks ties between reports with the same ``lastupdate``.
REPORT_COLUMNS = [
    "seq",
    "id",
    "bearing",
    "isinactive",
    "ltype",
    "delay",
    "lastupdate",
    "laststopid",
]
