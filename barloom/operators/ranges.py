"""First and last bar date per symbol and table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..arguments import day
from ..schemas import MOD_SOURCE, RAW_SOURCE


def symbol_range(bars: DataFrame, bars_mod: DataFrame) -> DataFrame:
    both = bars.select("symbol", F.lit(RAW_SOURCE).alias("source"), "dt").unionByName(
        bars_mod.select("symbol", F.lit(MOD_SOURCE).alias("source"), "dt")
    )
    return both.groupBy("symbol", "source").agg(F.min("dt").alias("start_dt"), F.max("dt").alias("end_dt"))


def merge_ranges(stored: DataFrame, new: DataFrame, merge_existing=True) -> DataFrame:
    if not merge_existing:
        return new
    both = stored.unionByName(new)
    return both.groupBy("symbol", "source").agg(
        F.min("start_dt").alias("start_dt"), F.max("end_dt").alias("end_dt")
    )


def _against_stored(new: DataFrame, ranges: DataFrame) -> DataFrame:
    n = new.select("symbol", "source", F.col("start_dt").alias("min_dt"), F.col("end_dt").alias("max_dt"))
    return n.join(ranges, ["symbol", "source"], "full_outer")


def range_delta(new: DataFrame, ranges: DataFrame) -> DataFrame:
    """Ranges after the new bars: unknown symbols inserted, later ends extended.

    `new` is `symbol_range` over the new bars. A stored start never moves.
    """
    joined = _against_stored(new, ranges)
    action = (
        F.when(F.col("end_dt").isNull(), "insert")
        .when(F.col("max_dt") > F.col("end_dt"), "extend")
        .otherwise("keep")
    )
    return joined.select(
        "symbol",
        "source",
        F.coalesce("start_dt", "min_dt").alias("start_dt"),
        F.greatest("end_dt", "max_dt").alias("end_dt"),
        action.alias("action"),
    )


def range_anomalies(new: DataFrame, ranges: DataFrame) -> DataFrame:
    """New bars that reach back into, or end inside, the stored range."""
    early = F.col("min_dt") <= F.col("start_dt")
    short = F.col("max_dt") <= F.col("end_dt")
    joined = _against_stored(new, ranges).where(early | short)
    return joined.select(
        "symbol",
        "source",
        "min_dt",
        "max_dt",
        "start_dt",
        "end_dt",
        early.alias("starts_early"),
        short.alias("ends_inside"),
    )


def delta_gate(ranges: DataFrame, delta_date) -> DataFrame:
    """One row: the latest stored date and whether the delta date lies after it."""
    first = day(delta_date)
    last = ranges.agg(F.max("end_dt").alias("last_dt"))
    return last.select("last_dt", first.alias("delta_dt"), F.coalesce(F.col("last_dt") < first, F.lit(False)).alias("ok"))


def require_delta_after(ranges: DataFrame, delta_date) -> None:
    row = delta_gate(ranges, delta_date).first()
    if not row.ok:
        raise ValueError(f"delta date {row.delta_dt} must be later than the stored date {row.last_dt}")
