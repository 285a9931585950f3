"""Date arguments: a date, `YYYYMMDD` or `YYYY-MM-DD`."""

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_day(value) -> datetime.date:
    if isinstance(value, datetime.datetime):
        return value.date()
    if isinstance(value, datetime.date):
        return value
    return datetime.date.fromisoformat(str(value))


def day(value) -> Column:
    """A date argument as a literal; a Column passes through."""
    return value if isinstance(value, Column) else F.lit(as_day(value))
