"""Row filters of the models and the loader (all pushed to the scan)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.flags import as_of_date


def only_success(df: DataFrame, success: str = "success") -> DataFrame:
    """``success is true``: NULL and false drop out."""
    return df.filter(F.col(success).eqNullSafe(True))


def released(df: DataFrame, as_of: date | str | None = None,
             column: str = "cleaned_release_date") -> DataFrame:
    """Parsed release date present and not after ``as_of`` (default today, UTC)."""
    d = F.col(column)
    return df.filter(d.isNotNull() & (d <= as_of_date(as_of)))


def on_day(df: DataFrame, column: str, day: date | str) -> DataFrame:
    """Equality on the day partition column (a partition filter on tables)."""
    return df.filter(F.col(column) == F.lit(str(day)).cast("date"))


def off_day(df: DataFrame, column: str, day: date | str) -> DataFrame:
    """Rows of another day (or without a day)."""
    c = F.col(column)
    return df.filter(c.isNull() | (c != F.lit(str(day)).cast("date")))
