"""Price and membership exports as partitioned CSV."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..arguments import as_day
from ..operators.membership import current_flags
from ..schemas import ADJUSTED, BAR, INDEX_CODES, KEY, PRICES
from ..sources.tables import from_date


def export_raw(bars_mod: DataFrame, start=None) -> DataFrame:
    return from_date(bars_mod, start).select(*BAR)


def export_adjusted(bars_mod: DataFrame, start=None) -> DataFrame:
    """Adjusted prices under `symbol.A`; rows without an adjusted open are raw throughout."""
    adjusted = F.col("adj_open").isNotNull()
    return from_date(bars_mod, start).select(
        F.concat("symbol", F.lit(".A")).alias("symbol"),
        "dt",
        *[F.when(adjusted, F.col(a)).otherwise(F.col(p)).alias(p) for a, p in zip(ADJUSTED, PRICES)],
        "volume",
    )


def export_flags(flags: DataFrame, index_name, start=None, codes=None) -> DataFrame:
    """Flags of one index as bars under `symbol.CODE`."""
    code = (INDEX_CODES if codes is None else codes)[index_name]
    return from_date(flags, start).select(
        F.concat("symbol", F.lit(f".{code}")).alias("symbol"),
        "dt",
        *[F.lit(v).alias(p) for v, p in zip((0, 0, 0, 1), PRICES)],
        index_name,
    )


def export_flags_delta(
    bars_mod: DataFrame, snapshots: DataFrame, current: DataFrame, index_name, start, codes=None
) -> DataFrame:
    """Current flags of one index from a date on; refused when members changed after that date.

    The refusal is part of the plan: with a later change the result is empty.
    `require_no_later_change` raises instead.
    """
    flags = current_flags(bars_mod, current, [index_name], start)
    last = snapshots.agg(F.max("dt").alias("last_dt")).scalar()
    allowed = F.coalesce(F.lit(as_day(start)) >= last, F.lit(True))
    return export_flags(flags.where(allowed), index_name, start, codes)


def require_no_later_change(snapshots: DataFrame, start) -> None:
    last = snapshots.agg(F.max("dt").alias("dt")).first().dt
    if last is not None and as_day(start) < last:
        raise ValueError(f"start date {start} is before the last index change {last}")


def write_csv_by_year(df: DataFrame, path) -> None:
    """Header CSV, one folder per year, dates as yyyyMMdd."""
    dated = df.withColumn("year", F.year("dt")).hint("rebalance", "year").sortWithinPartitions("year", *KEY)
    dated.write.mode("overwrite").partitionBy("year").option("header", "true").option(
        "dateFormat", "yyyyMMdd"
    ).csv(path)


def write_csv_delta(df: DataFrame, path, start) -> None:
    """The same for a delta export, in a folder named by its start date."""
    write_csv_by_year(df, f"{path}/{as_day(start):%Y%m%d}")


def write_report(df: DataFrame, path) -> int:
    """Header CSV; returns the number of rows, counted while they are written."""
    counts = Observation()
    df = df.observe(counts, F.count(F.lit(1)).alias("rows"))
    df.write.mode("overwrite").option("header", "true").option("dateFormat", "yyyyMMdd").csv(path)
    return counts.get["rows"]


def write_yearly_flags(flags: DataFrame, path, years) -> dict[int, int]:
    """The wide flags as header CSV, one folder per year; returns the rows of each of `years`, counted in the same pass."""
    counts = Observation()
    per_year = [F.count_if(F.year("dt") == y).alias(str(y)) for y in years]
    flags = flags.observe(counts, F.count(F.lit(1)).alias("rows"), *per_year)
    write_csv_by_year(flags, path)
    return {y: counts.get[str(y)] for y in years}


def write_bar_files(bars: DataFrame, path, of_day, order="seq") -> None:
    """Headerless `*.txt` bar files in one folder per day, rows in `order`.

    Range partitioning on (day, order) keeps the files of a day in sequence even when a
    day is split over several tasks.
    """
    dated = bars.withColumn("file_day", of_day)
    dated = dated.repartitionByRange("file_day", order).sortWithinPartitions("file_day", order)
    dated.select(*BAR, "file_day").write.mode("append").partitionBy("file_day").option(
        "extension", "txt"
    ).option("dateFormat", "yyyyMMdd").csv(path)
