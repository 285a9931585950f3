"""Column expressions on prices."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import PRICES


def whole(value) -> Column:
    """Truncate towards zero; what is no number counts as 0."""
    return F.coalesce(F.col(value).try_cast("bigint"), F.lit(0)).cast("double")


def _deviation(row, before, after, name) -> Column:
    middle = (whole(f"{before}.{name}") + whole(f"{after}.{name}")) / 2
    difference = middle - whole(f"{row}.{name}")
    return difference * difference


def price_error(row, before, after) -> Column:
    """Sum over the four prices of the squared distance to the neighbours' mean."""
    total = _deviation(row, before, after, PRICES[0])
    for name in PRICES[1:]:
        total = total + _deviation(row, before, after, name)
    return total


def volume_error(row, before, after) -> Column:
    return _deviation(row, before, after, "volume")


def adjusted_or_raw(name) -> Column:
    return F.coalesce(f"adj_{name}", name)
