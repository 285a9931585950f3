"""Calendars and the days missing from a table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..arguments import day
from ..functions.dates import dayofweek

# Day names.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday"]
WEEKENDS = ["Sunday", "Saturday"]
ALL_DAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def calendar(bounds: DataFrame, days=ALL_DAYS) -> DataFrame:
    """Every day of the wanted weekdays from `start_dt` to `end_dt` of each bounds row."""
    spans = bounds.where("start_dt <= end_dt")
    each = spans.select(F.explode(F.sequence("start_dt", "end_dt")).alias("dt"))
    return each.where(dayofweek(F.col("dt")).isin(list(days)))


def missing_dates(present: DataFrame, end, days=ALL_DAYS) -> DataFrame:
    """Calendar days from the first present date to `end` that have no row."""
    bounds = present.agg(F.min("dt").alias("start_dt"), day(end).alias("end_dt"))
    return calendar(bounds, days).join(present.select("dt").distinct(), "dt", "left_anti")
