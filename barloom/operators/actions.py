"""Split and bonus multipliers, and the prices adjusted by them."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..arguments import day
from ..schemas import ADJUSTED, KEY, MOD_SOURCE, PRICES, RAW_SOURCE
from .asof import as_of, in_years
from .dedupe import first_rows
from .symbols import rename_symbols


@dataclass(frozen=True)
class Multipliers:
    kept: DataFrame
    skipped: DataFrame


def clean_multipliers(raw: DataFrame, renames: DataFrame, ranges: DataFrame) -> Multipliers:
    """Rename, then keep actions on or after the symbol's first bar; the rest are skipped.

    The first bar is that of the modified table where the symbol has one, else of the raw.
    """
    start = F.coalesce(
        F.min(F.when(F.col("source") == MOD_SOURCE, F.col("start_dt"))),
        F.min(F.when(F.col("source") == RAW_SOURCE, F.col("start_dt"))),
    )
    starts = ranges.groupBy("symbol").agg(start.alias("_start"))
    dated = rename_symbols(raw, renames).join(starts, "symbol", "left")
    valid = F.coalesce(F.col("dt") >= F.col("_start"), F.lit(False))
    return Multipliers(dated.where(valid).drop("_start"), dated.where(~valid).drop("_start"))


def append_multipliers(stored: DataFrame, raw: DataFrame) -> DataFrame:
    """Stored actions first, then the file; one action per symbol and date, the first wins."""
    columns = [*KEY, "multiplier", "seq"]
    both = stored.select(*columns, F.lit(0).alias("_prio")).unionByName(
        raw.select(*columns, F.lit(1).alias("_prio"))
    )
    return first_rows(both, KEY, ("_prio", "seq")).drop("_prio")


def cum_multiplier(multipliers: DataFrame, *others) -> DataFrame:
    """Running product per symbol in date order, beside the columns `others`."""
    window = Window.partitionBy("symbol").orderBy("dt").rowsBetween(Window.unboundedPreceding, 0)
    return multipliers.select(*KEY, "multiplier", *others, F.product("multiplier").over(window).alias("cum_multiplier"))


def adjust_prices(bars_mod: DataFrame, multipliers: DataFrame, from_date=None, method="interval") -> DataFrame:
    """Set the adjusted prices from the cumulative multiplier of the latest action.

    Bars before the symbol's first action, or before `from_date`, keep what they have.
    `multipliers` carries `cum_multiplier`; all of it applies, also actions before `from_date`.
    """
    return apply_multiplier(as_of(bars_mod, multipliers, "cum_multiplier", method=method), from_date)


def adjust_in_years(bars_mod: DataFrame, multipliers: DataFrame, years, from_date=None) -> DataFrame:
    """`adjust_prices` of bars of some calendar years, in one shuffle by year and symbol, the order in which they are stored."""
    if not years:
        return bars_mod
    events = in_years(multipliers, "cum_multiplier", max(years)).where(F.col("_year").isin([int(y) for y in years]))
    bars = bars_mod.withColumns({"_year": F.year("dt"), "_is_bar": F.lit(True)})
    stacked = bars.unionByName(events, allowMissingColumns=True).repartitionByRange("_year", "symbol")
    is_bar = F.col("_is_bar").isNotNull()
    # An action applies on its own date: it stands before the bars of that day.
    so_far = Window.partitionBy("_year", "symbol").orderBy("dt", is_bar).rowsBetween(Window.unboundedPreceding, 0)
    matched = stacked.withColumn("_event", F.last("_event", ignorenulls=True).over(so_far)).where(is_bar)
    matched = matched.select(*bars_mod.columns, F.col("_event.cum_multiplier").alias("cum_multiplier"))
    return apply_multiplier(matched, from_date)


def apply_multiplier(matched: DataFrame, from_date=None) -> DataFrame:
    """The adjusted prices of bars that have met their `cum_multiplier`."""
    touched = F.col("cum_multiplier").isNotNull()
    if from_date is not None:
        touched = touched & (F.col("dt") >= day(from_date))
    new = {
        a: F.when(touched, F.col(p) * F.col("cum_multiplier")).otherwise(F.col(a))
        for a, p in zip(ADJUSTED, PRICES)
    }
    return matched.withColumns(new).drop("cum_multiplier")


def without_adjustment(bars: DataFrame) -> DataFrame:
    """Bars with empty adjusted columns."""
    return bars.withColumns({c: F.lit(None).cast("double") for c in ADJUSTED})
