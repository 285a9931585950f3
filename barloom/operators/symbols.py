"""Ticker renames and the modified bar table."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import ADJUSTED, BAR, KEY
from ..session import cut_lineage
from .asof import in_years
from .dedupe import Appended, first_rows, match


@dataclass(frozen=True)
class Modified:
    rows: DataFrame
    losers: DataFrame


def replace_values(df: DataFrame, mapping: DataFrame, column, old="old", new="new", by=()) -> DataFrame:
    """Replace `column` where (column, *by) is mapped. The mapping has one row per old value.

    No broadcast hint: Spark broadcasts the mapping when it is small enough, and
    otherwise sort-merge joins with run-time splitting of hot values.
    """
    m = mapping.select(
        F.col(old).alias("_old"), F.col(new).alias("_new"), *[F.col(b).alias(f"_by_{b}") for b in by]
    )
    condition = F.col(column) == F.col("_old")
    for b in by:
        condition = condition & (F.col(b) == F.col(f"_by_{b}"))
    replaced = F.when(F.col("_old").isNotNull(), F.col("_new")).otherwise(F.col(column))
    return (
        df.join(m, condition, "left")
        .withColumn(column, replaced)
        .drop("_old", "_new", *[f"_by_{b}" for b in by])
    )


def rename_symbols(df: DataFrame, renames: DataFrame, column="symbol") -> DataFrame:
    """Apply a resolved rename map in one pass."""
    return replace_values(df, renames, column)


def resolve_map(mapping: DataFrame, by=()) -> DataFrame:
    """Collapse a map that is applied entry after entry, in `pos` order, to one pass.

    An old value listed twice takes its last new value at its first position. A value
    moves on only through entries listed later, so positions rise and the hops end.
    Every round doubles the hops an entry has behind it, so a chain of n entries
    takes about log2(n) rounds.
    """
    state = mapping.groupBy(*by, "old").agg(F.max_by("new", "pos").alias("new"), F.min("pos").alias("pos"))
    state = state.withColumn("reached", F.col("pos"))
    while True:
        step = state.select(
            *[F.col(b).alias(f"_by_{b}") for b in by],
            F.col("old").alias("_old"),
            F.col("new").alias("_new"),
            F.col("pos").alias("_pos"),
            F.col("reached").alias("_reached"),
        )
        condition = (F.col("new") == F.col("_old")) & (F.col("_pos") > F.col("reached"))
        for b in by:
            condition = condition & (F.col(b) == F.col(f"_by_{b}"))
        moved = state.join(step, condition, "left")
        hopped = F.col("_old").isNotNull()
        moved = moved.select(
            *by,
            "old",
            F.when(hopped, F.col("_new")).otherwise(F.col("new")).alias("new"),
            "pos",
            F.when(hopped, F.col("_reached")).otherwise(F.col("reached")).alias("reached"),
            hopped.alias("hopped"),
        )
        moved = cut_lineage(moved)
        if moved.where("hopped").isEmpty():
            return state.select(*by, "old", "new")
        state = moved.drop("hopped")


def _replacements_then_bars(bars, replace, renames) -> DataFrame:
    """Both inputs renamed; `_prio` puts replacements (0) before bars (1)."""
    columns = [*BAR, "seq"]
    stacked = replace.select(*columns, F.lit(0).alias("_prio")).unionByName(
        bars.select(*columns, F.lit(1).alias("_prio"))
    )
    # A bar that was renamed keeps its ingest position; ties between symbols are
    # settled by the name it came with.
    stacked = stacked.withColumn("_from", F.col("symbol"))
    return rename_symbols(stacked, renames)


_ORDER = ("_prio", "seq", "_from")


def _unadjusted():
    return [F.lit(None).cast("double").alias(c) for c in ADJUSTED]


def _displaced(df: DataFrame, order) -> DataFrame:
    """Rows behind the first of their key, in one shuffle.

    For bars that were unique before they were renamed or met replacements: a key has at most one
    row of each old symbol and one replacement, so no window grows with the input.
    """
    place = F.rank().over(Window.partitionBy(*KEY).orderBy(*order))
    return df.withColumn("_place", place).where("_place > 1").drop("_place")


def modified_keys(bars: DataFrame, replace: DataFrame, renames: DataFrame) -> DataFrame:
    """Symbol and date of the rows of `build_modified`, repeated, without a shuffle of bars."""
    return _replacements_then_bars(bars, replace, renames).select(*KEY)


def ranked_modified(
    bars: DataFrame, replace: DataFrame, renames: DataFrame, multipliers: DataFrame | None = None, last_year=None
) -> DataFrame:
    """`build_modified` as one frame: `kind` is "row" for what stays and "loser" for what does not.

    `cum_multiplier` is that of the latest action up to the bar's date; `last_year` is the last of
    the bars. All is dealt out once, by calendar year and symbol, the order in which it is stored.
    """
    stacked = _replacements_then_bars(bars, replace, renames).withColumn("_year", F.year("dt"))
    if multipliers is None:
        multipliers = bars.limit(0).select(*KEY, F.lit(None).cast("double").alias("cum_multiplier"))
    stacked = stacked.unionByName(in_years(multipliers, "cum_multiplier", last_year), allowMissingColumns=True)
    stacked = stacked.repartitionByRange("_year", "symbol")
    is_bar = F.col("_prio").isNotNull()
    # An action applies on its own date: it stands before the bars of that day.
    so_far = Window.partitionBy("_year", "symbol").orderBy("dt", is_bar).rowsBetween(Window.unboundedPreceding, 0)
    stacked = stacked.withColumn("_event", F.last("_event", ignorenulls=True).over(so_far)).where(is_bar)
    window = Window.partitionBy("_year", *KEY).orderBy(*_ORDER)
    kind = F.when(F.col("_row") == 1, "row").when(F.col("_place") > 1, "loser")
    ranked = stacked.select("*", F.row_number().over(window).alias("_row"), F.rank().over(window).alias("_place"))
    ranked = ranked.select(*BAR, *_unadjusted(), F.col("_event.cum_multiplier").alias("cum_multiplier"), kind.alias("kind"))
    return ranked.where("kind is not null")


def build_modified(bars: DataFrame, replace: DataFrame, renames: DataFrame) -> Modified:
    """Renamed bars with replacements first; the first row per key stays, the rest are losers."""
    stacked = _replacements_then_bars(bars, replace, renames)
    rows = first_rows(stacked, KEY, _ORDER).select(*BAR, *_unadjusted())
    losers = _displaced(stacked, _ORDER).select(*BAR, "seq")
    return Modified(rows, losers)


def append_modified(stored: DataFrame, bars: DataFrame, replace: DataFrame, renames: DataFrame, stage=None) -> Appended:
    """Stored rows win over replacements, replacements over new bars, as in `append_first`.

    Of the stored rows only the keys are dealt out, once, together with the new rows: by calendar
    year and symbol, the order in which rows are stored. `stage` (rows, label) writes that down.
    """
    stage = stage or (lambda df, label: df)
    keep = [*BAR, *ADJUSTED]
    delta = _replacements_then_bars(bars, replace, renames)
    stacked = delta.unionByName(stored.select(*KEY, F.lit(-1).alias("_prio")), allowMissingColumns=True)
    stacked = stacked.withColumn("_year", F.year("dt")).repartitionByRange("_year", "symbol")
    of_key = Window.partitionBy("_year", *KEY)
    is_new = F.col("_prio") >= 0
    marked = stacked.select(
        *BAR, "_prio", F.rank().over(of_key.orderBy(*_ORDER)).alias("_place"), F.count_if(is_new).over(of_key).alias("_rows")
    )
    marked = stage(marked.where(is_new).select(*BAR, *_unadjusted(), "_place", "_rows"), "arrivals")
    fresh, skipped = marked.where("_place = 1").select(*keep), marked.where("_place > 1").select(*keep)
    stored = stored.select(*keep)
    again = match(stored, marked.select(*KEY).distinct(), KEY, "left_semi")
    duplicates = again.unionByName(marked.where("_place > 1 or _rows > 1").select(*keep))
    return Appended(stored.unionByName(fresh), fresh, duplicates, skipped)


def rename_stored(bars_mod: DataFrame, renames: DataFrame) -> Modified:
    """Rename stored rows. A row already under the new name wins; rows that collide are reported."""
    moved = rename_symbols(bars_mod.withColumn("_from", F.col("symbol")), renames)
    moved = moved.withColumn("_prio", (F.col("symbol") != F.col("_from")).cast("int"))
    order = ("_prio", "_from")
    return Modified(
        first_rows(moved, KEY, order).drop("_prio", "_from"),
        _displaced(moved, order).withColumnRenamed("_from", "old_symbol").drop("_prio"),
    )
