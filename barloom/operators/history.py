"""Serving: price history with adjusted prices, buffer mark, index flag and splits."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..arguments import as_day, day
from ..functions.prices import adjusted_or_raw
from ..schemas import KEY, PRICES
from ..sources.tables import fetch_bars
from .membership import MEMBER, _ranked_dates, change_history, flag_bars


def check_dates(start, end, buffer_start=None):
    """Returns the first day to fetch."""
    start, end = as_day(start), as_day(end)
    if start > end:
        raise ValueError(f"end date {end} cannot be before start date {start}")
    if buffer_start is None:
        return start
    buffer_start = as_day(buffer_start)
    if buffer_start > start:
        raise ValueError(f"buffer start {buffer_start} cannot be after start date {start}")
    return buffer_start


def buffer_flag(date, start) -> Column:
    """True before the start date, null from it on."""
    return F.when(F.col(date) < day(start), F.lit(True))


def index_markers(snapshots: DataFrame, index_name) -> DataFrame:
    """Per symbol: 1 on each snapshot date that holds it, 0 on the first one that no longer does."""
    snapshots = change_history(snapshots, index_name).select(*MEMBER, "dt").distinct()
    dates = _ranked_dates(snapshots)
    held = snapshots.join(dates, ["index_name", "dt"])
    next_rank = F.lead("rank").over(Window.partitionBy(*MEMBER).orderBy("rank"))
    held = held.withColumn("next_rank", next_rank)
    leaves = F.col("next_dt").isNotNull() & (F.col("next_rank").isNull() | (F.col("next_rank") > F.col("rank") + 1))
    marks = F.array(
        F.struct(F.col("dt").alias("dt"), F.lit(1).alias("flag")),
        F.when(leaves, F.struct(F.col("next_dt").alias("dt"), F.lit(0).alias("flag"))),
    )
    return held.select("symbol", F.explode(F.array_compact(marks)).alias("mark")).select("symbol", "mark.*")


def index_flag(bars: DataFrame, snapshots: DataFrame, index_name, name="idxflag") -> DataFrame:
    """1 while the latest snapshot on or before the bar's date holds the symbol, else 0."""
    return flag_bars(bars, snapshots, [index_name], [name])


def index_flag_exact(bars: DataFrame, snapshots: DataFrame, index_name, first_day, name="idxflag") -> DataFrame:
    """Markers joined on equal dates and filled forward over the bars.

    The gap before a symbol's first matched marker takes its latest marker before
    `first_day`, else 0. Markers on days without a bar are lost; `index_flag` has no such gap.
    """
    markers = index_markers(snapshots, index_name)
    before = markers.where(F.col("dt") < day(first_day))
    seeds = before.groupBy("symbol").agg(F.max_by("flag", "dt").alias("_seed"))
    marked = bars.join(markers.withColumnRenamed("flag", "_mark"), KEY, "left").join(seeds, "symbol", "left")
    # Bars are unique per symbol and date: a window partition is bounded by the calendar.
    window = Window.partitionBy("symbol").orderBy("dt").rowsBetween(Window.unboundedPreceding, 0)
    filled = F.coalesce(F.last("_mark", ignorenulls=True).over(window), F.col("_seed"), F.lit(0))
    return marked.select(*bars.columns, filled.alias(name))


def split_history(multipliers: DataFrame, symbols=None) -> DataFrame:
    splits = fetch_bars(multipliers, symbols)
    return splits.select(*KEY, F.col("multiplier").alias("split"))


def add_splits(bars: DataFrame, multipliers: DataFrame) -> DataFrame:
    """The multiplier on action dates, 0 on all other days."""
    joined = bars.join(split_history(multipliers), KEY, "left")
    return joined.select(*bars.columns, F.coalesce("split", F.lit(0.0)).alias("split"))


def symbol_history(
    bars_mod: DataFrame,
    start,
    end,
    symbols=None,
    buffer_start=None,
    index_name=None,
    snapshots=None,
    multipliers=None,
    flag_mode="asof",
) -> DataFrame:
    """History of one, several or all symbols as one plan.

    `buffer` is present when buffer days are fetched, `idxflag` with an index name,
    `split` with multipliers. Adjusted prices fall back to the raw ones column by column.
    """
    history = _flagged(bars_mod, start, end, symbols, buffer_start, index_name, snapshots, flag_mode)
    if multipliers is not None:
        history = add_splits(history, multipliers)
    return history.withColumnRenamed("dt", "date")


def _flagged(bars_mod, start, end, symbols, buffer_start, index_name, snapshots, flag_mode) -> DataFrame:
    first_day = check_dates(start, end, buffer_start)
    if flag_mode not in ("asof", "exact"):
        raise ValueError(f"flag_mode must be asof or exact, not {flag_mode}")
    bars = fetch_bars(bars_mod, symbols, first_day, end)
    columns = [*KEY, *PRICES, "volume", *[adjusted_or_raw(p).alias(f"adj{p}") for p in PRICES]]
    if first_day != as_day(start):
        columns.append(buffer_flag("dt", start).alias("buffer"))
    history = bars.select(*columns)
    if index_name is not None:
        if flag_mode == "asof":
            history = index_flag(history, snapshots, index_name)
        else:
            history = index_flag_exact(history, snapshots, index_name, first_day)
    return history


def index_history(
    bars_mod: DataFrame,
    snapshots: DataFrame,
    index_name,
    start,
    end,
    buffer_start=None,
    multipliers=None,
    flag_mode="asof",
) -> DataFrame:
    """History of every symbol that was in the index on a fetched day, buffer days included.

    Bars are flagged once and meet the flags of their symbol in the same task: they are unique per
    symbol and date, so a window partition is bounded by the calendar.
    """
    ever = change_history(snapshots, index_name).select("symbol")
    flagged = _flagged(bars_mod, start, end, ever, buffer_start, index_name, snapshots, flag_mode)
    columns = flagged.columns
    inside = F.max("idxflag").over(Window.partitionBy("symbol"))
    history = flagged.withColumn("_inside", inside).where("_inside = 1").select(*columns)
    if multipliers is not None:
        history = add_splits(history, multipliers)
    return history.withColumnRenamed("dt", "date")


def slice_history(history: DataFrame, symbols=None, start=None, end=None, strict=False) -> DataFrame:
    """Rows of the symbols in [start, end]; `end` defaults to `start`, and counts only with it.

    `strict` fails on a listed symbol without rows; it runs a job to find out.
    """
    if not symbols and not start:
        raise ValueError("symbols or a start date are required")
    if symbols:
        names = [symbols] if isinstance(symbols, str) else list(symbols)
        rows = history.where(F.col("symbol").isin(names))
        if strict:
            found = {r.symbol for r in rows.select("symbol").distinct().collect()}
            missing = [n for n in names if n not in found]
            if missing:
                raise KeyError(f"no history for {missing}")
        history = rows
    if start:
        first, last = day(start), day(end or start)
        history = history.where(F.col("date").between(first, last))
    return history
