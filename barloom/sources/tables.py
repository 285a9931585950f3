"""Reads over the stored bar tables, which are partitioned by year."""

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..arguments import day


def fetch_bars(bars: DataFrame, symbols=None, start=None, end=None, ordered=False) -> DataFrame:
    """Bars of the given symbols in [start, end].

    `symbols` is a name, a list of names, a DataFrame with a `symbol` column for
    lists too long for a literal, or None for all. A date condition alone does not
    prune year folders, so the year condition is added where the table has one.
    """
    if symbols is not None:
        if isinstance(symbols, DataFrame):
            bars = bars.join(symbols.select("symbol").distinct(), "symbol", "left_semi")
        elif isinstance(symbols, str):
            bars = bars.where(F.col("symbol") == symbols)
        elif isinstance(symbols, Iterable):
            bars = bars.where(F.col("symbol").isin(list(symbols)))
    bars = from_date(bars, start)
    if end is not None:
        last = day(end)
        bars = bars.where(F.col("dt") <= last)
        if "year" in bars.columns:
            bars = bars.where(F.col("year") <= F.year(last))
    return bars.orderBy("symbol", "dt") if ordered else bars


def from_date(bars: DataFrame, start) -> DataFrame:
    if start is None:
        return bars
    first = day(start)
    bars = bars.where(F.col("dt") >= first)
    if "year" in bars.columns:
        bars = bars.where(F.col("year") >= F.year(first))
    return bars
