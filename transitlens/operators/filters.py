"""Predicates and projections shared by the questions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import heading_within, json_pair_line
from ..schema import ACTIVE_FLAG, NORTH_CENTER, NORTH_TOLERANCE, TRAIN_LTYPE


def active(reports: DataFrame) -> DataFrame:
    """Reports whose ``isinactive`` is exactly the text "false"."""
    return reports.where(F.col("isinactive") == ACTIVE_FLAG)


def trains(reports: DataFrame) -> DataFrame:
    return reports.where(F.col("ltype") == TRAIN_LTYPE)


def delayed(reports: DataFrame) -> DataFrame:
    """Strictly positive delay; null (empty) delays drop out."""
    return reports.where(F.col("delay") > 0)


def heading(reports: DataFrame, center: float = NORTH_CENTER, tolerance: float = NORTH_TOLERANCE) -> DataFrame:
    """``(id, bearing)`` of reports heading within ``center ± tolerance``."""
    return reports.where(heading_within("bearing", center, tolerance)).select("id", "bearing")


def north(reports: DataFrame) -> DataFrame:
    return heading(reports)


def north_lines(reports: DataFrame) -> DataFrame:
    """Each northbound report as the text line ``["<id>", <bearing>]``."""
    return north(reports).select(json_pair_line("id", "bearing").alias("line"))
