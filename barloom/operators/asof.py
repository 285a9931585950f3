"""Backward as-of lookup."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def as_of(facts: DataFrame, events: DataFrame, value, key="symbol", on="dt", method="interval") -> DataFrame:
    """Add `value` of the latest event of the same key on or before the fact's date.

    Events without a date apply to nothing; of several on one date the largest value counts.
    Both methods give the same rows. "interval" turns events into [date, next date) spans and
    joins them by key, leaving it to the optimizer whether to broadcast them or to sort and split
    a skewed key. "window" fills forward over facts and events together: one window per key, with
    facts unique per (key, date) bounded by the number of calendar days.
    """
    events = events.where(F.col(on).isNotNull()).groupBy(key, on).agg(F.max(value).alias(value))
    return {"interval": _by_interval, "window": _by_window}[method](facts, events, value, key, on)


def in_years(events: DataFrame, value, last_year, key="symbol", on="dt") -> DataFrame:
    """What `as_of` needs within a calendar year: each event, and on New Year's Day the one still in force.

    Up to `last_year`, the last of the facts; `value` is in the struct `_event`, which is never null.
    """
    events = events.where(F.col(on).isNotNull() & F.col(key).isNotNull()).groupBy(key, on).agg(F.max(value).alias(value))
    upto = F.lead(on).over(Window.partitionBy(key).orderBy(on))
    first = F.year(on)
    last = F.greatest(first, F.coalesce(F.year(F.date_sub(upto, 1)), F.lit(last_year).cast("int"), first))
    spans = events.select(key, on, F.struct(value).alias("_event"), F.sequence(first, last).alias("_years"))
    spans = spans.select(key, on, "_event", F.explode("_years").alias("_year"))
    return spans.withColumn(on, F.greatest(on, F.make_date("_year", F.lit(1), F.lit(1))))


def _by_interval(facts, events, value, key, on) -> DataFrame:
    upto = F.lead(on).over(Window.partitionBy(key).orderBy(on))
    spans = events.select(
        F.col(key).alias("_key"), F.col(on).alias("_from"), upto.alias("_to"), F.col(value)
    )
    inside = (F.col(on) >= F.col("_from")) & (F.col("_to").isNull() | (F.col(on) < F.col("_to")))
    return facts.join(spans, (F.col(key) == F.col("_key")) & inside, "left").drop("_key", "_from", "_to")


def _by_window(facts, events, value, key, on) -> DataFrame:
    tagged = facts.select(key, on, F.struct("*").alias("_fact"), F.lit(1).alias("_kind"))
    tagged = tagged.unionByName(
        events.select(key, on, F.struct(value).alias("_event"), F.lit(0).alias("_kind")),
        allowMissingColumns=True,
    )
    # Events sort before facts of the same day: an event applies on its own date.
    window = Window.partitionBy(key).orderBy(on, "_kind").rowsBetween(Window.unboundedPreceding, 0)
    filled = tagged.withColumn("_event", F.last("_event", ignorenulls=True).over(window))
    return filled.where("_kind = 1").select("_fact.*", F.col(f"_event.{value}").alias(value))
