from .events import load_table, report_lines_from_events, reports_from_events
from .landing import report_source
from .text import (
    corrupt_reports,
    parse_report_lines,
    parse_reports,
    read_report_lines,
    tokenize_lines,
)

__all__ = [
    "load_table",
    "report_source",
    "reports_from_events",
    "report_lines_from_events",
    "read_report_lines",
    "tokenize_lines",
    "parse_report_lines",
    "parse_reports",
    "corrupt_reports",
]
