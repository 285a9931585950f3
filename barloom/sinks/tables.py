"""Writes to the stored tables. Parquet has no update, so changed years are rewritten.

What replaces stored rows is first staged under the name of the run, and moved from there. A run
that breaks off in between leaves the staged copy, which the next run of the name moves again.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..arguments import day
from ..operators.dedupe import match
from ..schemas import KEY
from ..session import work_path


def with_year(bars: DataFrame) -> DataFrame:
    return bars.withColumn("year", F.year("dt"))


def by_year(bars: DataFrame) -> DataFrame:
    """Ranges of (year, symbol, date), sorted inside.

    A large year is written by many tasks, each with its own range of symbols, so the statistics
    of a file tell which symbols it may hold, and a year of one hot symbol is cut by date.
    """
    return with_year(bars).repartitionByRange("year", *KEY).sortWithinPartitions("year", *KEY)


def in_order(bars: DataFrame) -> DataFrame:
    """The same for rows read from a copy that is laid out by year and symbol: they are not shuffled again."""
    return with_year(bars).sortWithinPartitions("year", *KEY)


def append_bars_table(bars: DataFrame, path, layout=by_year) -> None:
    layout(bars).write.mode("append").partitionBy("year").parquet(path)


def append_new_keys(bars: DataFrame, stored: DataFrame, path) -> None:
    """Append the rows whose key is not stored, so a repeated append changes nothing."""
    append_bars_table(match(bars, stored, KEY, "left_anti"), path)


def write_batch(rows: DataFrame, path, batch) -> None:
    """Write a run's rows as its own folder; a repeated run replaces them, also by no rows."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/batch={batch}")


def write_bars_table(bars: DataFrame, path, layout=by_year) -> None:
    layout(bars).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("year").parquet(path)


def overwrite_years(bars: DataFrame, path, years, stage=None, layout=by_year) -> None:
    """Replace exactly these years of a stored table by the rows of `bars`.

    The rows may come from the same table: `stage` (`stage_once` of a run) writes them down first.
    A listed year without rows ends up empty.
    """
    stage = stage or stage_anew
    staged = stage(bars.where(F.year("dt").isin(list(years))), "years")
    kept = set(years_of(staged))
    move_years(layout(staged), path)
    for empty in sorted(set(years) - kept):
        staged.limit(0).write.mode("overwrite").parquet(f"{path}/year={empty}")


def move_years(staged: DataFrame, path) -> None:
    """Replace the years of rows that are laid out by one of the functions above."""
    staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(path)


def replace_table(df: DataFrame, path, stage=None) -> None:
    """Overwrite a table that `df` may itself read, by way of a staged copy."""
    move_table((stage or stage_anew)(df, "table"), path)


def move_table(staged: DataFrame, path) -> None:
    staged.write.mode("overwrite").parquet(path)


def stage_anew(df: DataFrame, label) -> DataFrame:
    """A copy under a name of its own, for replacements outside a run."""
    path = work_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def replace_from_year(bars: DataFrame, path, stored_years, start_year, stage=None, layout=by_year) -> None:
    """Replace the stored years from `start_year` on by the rows of `bars`; earlier years stay."""
    bars = bars.where(F.year("dt") >= int(start_year))
    years = set(years_of(bars)) | {y for y in stored_years if y >= int(start_year)}
    if years:
        overwrite_years(bars, path, sorted(years), stage, layout)


def years_of(bars: DataFrame) -> list[int]:
    """The calendar years present: one small number per year comes to the driver."""
    return sorted(r.year for r in with_year(bars).select("year").distinct().collect() if r.year is not None)


def replace_symbol_tail(table: DataFrame, updates: DataFrame) -> DataFrame:
    """The table with each updated symbol's rows from its first updated date on replaced."""
    starts = updates.groupBy("symbol").agg(F.min("dt").alias("_start"))
    kept = table.join(starts, "symbol", "left").where("_start is null or dt < _start").drop("_start")
    return kept.unionByName(updates)


def update_symbol_tail(path, updates: DataFrame) -> None:
    """`replace_symbol_tail` on a stored table; only years from the first update on are rewritten."""
    spark = updates.sparkSession
    stored = spark.read.parquet(path)
    first = updates.agg(F.min("dt").alias("dt")).first().dt
    if first is None:
        return
    touched = stored.where((F.col("year") >= first.year) & (F.col("dt") >= day(first.replace(month=1, day=1))))
    years = sorted(set(years_of(touched.drop("year"))) | set(years_of(updates)))
    overwrite_years(replace_symbol_tail(touched.drop("year"), updates), path, years)


def save_history(history: DataFrame, path) -> None:
    history.write.mode("overwrite").parquet(path)


def load_history(spark, path) -> DataFrame:
    return spark.read.parquet(path)


def save_by_symbol(history: DataFrame, path) -> None:
    """History for reading symbol by symbol: files by ranges of symbols, and which range each file holds.

    The number of files follows from the size of the data, not from the number of symbols; a
    symbol too large for one file is cut by date.
    """
    spark = history.sparkSession
    rows = history.repartitionByRange("symbol", "date").sortWithinPartitions("symbol", "date")
    rows.write.mode("overwrite").parquet(f"{path}/rows")
    written = spark.read.schema(history.schema).parquet(f"{path}/rows")
    ranges = written.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.min("symbol").alias("first_symbol"), F.max("symbol").alias("last_symbol")
    )
    ranges.coalesce(1).write.mode("overwrite").parquet(f"{path}/ranges")


def load_by_symbol(spark, path, symbols) -> DataFrame:
    """The rows of a symbol or a list of symbols; only files whose range may hold one are read."""
    names = [symbols] if isinstance(symbols, str) else list(symbols)
    ranges = spark.read.parquet(f"{path}/ranges")
    wanted = F.exists(F.array(*[F.lit(n) for n in names]), lambda n: n.between(F.col("first_symbol"), F.col("last_symbol")))
    files = [r.file for r in ranges.where(wanted).select("file").collect()] if names else []
    whole = spark.read.parquet(f"{path}/rows")
    if not files:
        return whole.limit(0)
    rows = spark.read.schema(whole.schema).parquet(*[f"{path}/rows/{f}" for f in files])
    return rows.where(F.col("symbol").isin(names))
