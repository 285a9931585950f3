"""First row per key, the rows it displaces, and appends where stored rows win.

A single (symbol, dt) may hold a large share of all input rows, so no step below
gathers the rows of a key in one task:

* `first_rows` is a `row_number() = 1` filter, which Spark limits to one row per key
  in every map task before the shuffle;
* the keys that occur more than once are aggregated to their first order value and row
  count (combined map-side) and joined back. Spark knows that they are few only once they
  are written: a caller that stages `repeated_keys` and hands them in has them broadcast,
  and no row is shuffled. Otherwise, and where they are many, adaptive execution splits
  the rows of a hot key.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import BAR, KEY


@dataclass(frozen=True)
class Split:
    unique: DataFrame
    duplicates: DataFrame
    skipped: DataFrame


@dataclass(frozen=True)
class Appended:
    rows: DataFrame
    fresh: DataFrame
    duplicates: DataFrame
    skipped: DataFrame


def _order_value(order) -> Column:
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def match(left: DataFrame, right: DataFrame, names, how) -> DataFrame:
    """Semi or anti join on null-safe equality; null keys form a group of their own."""
    right = right.select(*[F.col(n).alias(f"_m_{n}") for n in names])
    conditions = [F.col(n).eqNullSafe(F.col(f"_m_{n}")) for n in names]
    return left.join(right, conditions, how)


def first_rows(df: DataFrame, keys=KEY, order=("seq",)) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def repeated_keys(df: DataFrame, keys=KEY, order=("seq",)) -> DataFrame:
    """`_first` order value and `key_rows` of every key of more than one row.

    `order` must be unique within a key.
    """
    counted = df.groupBy(*keys).agg(F.min(_order_value(order)).alias("_first"), F.count(F.lit(1)).alias("key_rows"))
    return counted.where("key_rows > 1")


def _beside(df: DataFrame, repeated: DataFrame, keys, how) -> DataFrame:
    """Rows beside their key's entry; null keys form a group of their own."""
    side = repeated.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_first", "key_rows")
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return df.join(side, same, how).drop(*[f"_k_{k}" for k in keys])


def _known(df, keys, order, repeated):
    return repeated_keys(df, keys, order) if repeated is None else repeated


def mark_copies(df: DataFrame, keys=KEY, order=("seq",), repeated: DataFrame | None = None) -> DataFrame:
    """Add `key_rows`: the row count of the key on its first row, null on later rows."""
    marked = _beside(df, _known(df, keys, order, repeated), keys, "left")
    key_rows = F.when(F.col("_first").isNull(), F.lit(1).cast("bigint")).when(
        _order_value(order) == F.col("_first"), F.col("key_rows")
    )
    return marked.withColumn("key_rows", key_rows).drop("_first")


def later_rows(df: DataFrame, keys=KEY, order=("seq",), repeated: DataFrame | None = None) -> DataFrame:
    copies = _beside(df, _known(df, keys, order, repeated), keys, "inner")
    return copies.where(_order_value(order) != F.col("_first")).drop("_first", "key_rows")


def duplicate_rows(df: DataFrame, keys=KEY, order=("seq",), repeated: DataFrame | None = None) -> DataFrame:
    """Every row of a key that occurs more than once, the first included."""
    return _beside(df, _known(df, keys, order, repeated), keys, "inner").drop("_first", "key_rows")


def split_duplicates(df: DataFrame, keys=KEY, order=("seq",), repeated: DataFrame | None = None) -> Split:
    """All three; the repeated keys are found once in a plan that uses several of them."""
    marked = mark_copies(df, keys, order, repeated)
    return Split(
        marked.where(F.col("key_rows").isNotNull()).drop("key_rows"),
        duplicate_rows(df, keys, order, repeated),
        later_rows(df, keys, order, repeated),
    )


def _mark_arrivals(delta: DataFrame, stored_again: DataFrame, keys, order) -> DataFrame:
    """`mark_copies`, and `_known` where the key is stored, by one join with both kinds of keys."""
    copies = repeated_keys(delta, keys, order).withColumn("_known", F.lit(False))
    stored_keys = stored_again.select(*keys, F.lit(True).alias("_known"))
    side = copies.unionByName(stored_keys, allowMissingColumns=True).groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys])
    side = side.agg(F.min("_first").alias("_first"), F.max("key_rows").alias("key_rows"), F.max("_known").alias("_known"))
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    key_rows = F.when(F.col("_first").isNull(), F.lit(1).cast("bigint")).when(
        _order_value(order) == F.col("_first"), F.col("key_rows")
    )
    marked = delta.join(side, same, "left").withColumn("key_rows", key_rows)
    known = F.coalesce("_known", F.lit(False))
    return marked.withColumn("_known", known).drop("_first", *[f"_k_{k}" for k in keys])


def append_first(stored: DataFrame, delta: DataFrame, keys=KEY, order=("seq",), stage=None) -> Appended:
    """Add delta rows whose key is not stored; within the delta the first row wins.

    `stored` is only cut down to the delta's keys, without a shuffle while those are few;
    only `fresh` needs writing. `stage` (rows, label) writes down what several of the results
    share, which else each of them works out anew.
    """
    stage = stage or (lambda df, label: df)
    stored_again = stage(match(stored, delta.select(*keys).distinct(), keys, "left_semi"), "stored-again")
    marked = stage(_mark_arrivals(delta, stored_again, keys, order), "arrivals")
    is_fresh = F.col("key_rows").isNotNull() & ~F.col("_known")
    rows_of = lambda test: marked.where(test).drop("key_rows", "_known")
    fresh = rows_of(is_fresh)
    duplicates = stored_again.unionByName(rows_of(~is_fresh | (F.col("key_rows") > 1)), allowMissingColumns=True)
    return Appended(stored.unionByName(fresh, allowMissingColumns=True), fresh, duplicates, rows_of(~is_fresh))


def duplicates_not_skipped(duplicates: DataFrame, skipped: DataFrame) -> DataFrame:
    """Duplicate-group rows with no value-identical skipped row.

    Plain equality: a row holding a null never matches, so it stays in the result.
    """
    rejected = skipped.select(*BAR).distinct()
    return duplicates.join(rejected, BAR, "left_anti")


def key_counts(duplicates: DataFrame) -> DataFrame:
    counts = duplicates.groupBy(*KEY).agg(F.count("dt").alias("row_count"))
    return counts.orderBy(F.desc("row_count"), *KEY)
