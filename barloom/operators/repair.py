"""Score rejected bars against the neighbouring days and pick replacements."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..arguments import day
from ..functions.prices import price_error, volume_error
from ..schemas import BAR, KEY, PRICES, SEQ
from .dedupe import _mark_arrivals, first_rows, mark_copies, match

_VALUES = [*PRICES, "volume"]
_OF_BAR = ", ".join(f"{c}: {'bigint' if c == 'volume' else 'double'}" for c in _VALUES)
#: The columns of `mark_beside` over rows from files.
MARKED = (
    f"symbol string, dt date, {_OF_BAR.replace(':', '')}, seq {SEQ.simpleString()}, key_rows bigint, "
    f"beside array<struct<{', '.join(f'{k}: struct<{_OF_BAR}>' for k in ('kept', 'prev', 'next'))}>>"
)


def distinct_skipped(skipped: DataFrame, from_date=None) -> DataFrame:
    """One row per distinct rejected bar with its earliest ingest position."""
    if from_date is not None:
        skipped = skipped.where(F.col("dt") >= day(from_date))
    return skipped.groupBy(*BAR).agg(F.min("seq").alias("seq"))


def with_neighbours(unique: DataFrame, asked: DataFrame) -> DataFrame:
    """Kept bar of each key of `asked` with the previous and next bar of its symbol and calendar year.

    Each key asked for goes into the shuffle of the bars as one row, so only bars that are asked
    for leave it. The key is unique here: one window partition holds at most twice 366 rows.
    """
    known = F.col("symbol").isNotNull() & F.col("dt").isNotNull()
    asked = asked.select(*KEY).where(known).distinct().withColumn("_asked", F.lit(True))
    rows = unique.where(known).select(*KEY, *_VALUES, F.lit(False).alias("_asked"))
    rows = rows.unionByName(asked, allowMissingColumns=True)
    rows = rows.withColumn("_year", F.year("dt")).repartition("symbol", "_year")
    wanted = F.max("_asked").over(Window.partitionBy("symbol", "_year", "dt"))
    rows = rows.withColumn("_wanted", wanted).where(~F.col("_asked"))
    bar = F.struct(*_VALUES)
    window = Window.partitionBy("symbol", "_year").orderBy("dt")
    beside = rows.select(
        *KEY, bar.alias("kept"), F.lag(bar).over(window).alias("prev"), F.lead(bar).over(window).alias("next"), "_wanted"
    )
    return beside.where("_wanted").drop("_wanted")


def score_skipped(unique: DataFrame, skipped: DataFrame, from_date=None) -> DataFrame:
    """Each distinct rejected bar beside the kept one, with both errors.

    A missing neighbour is stood in for by the other; `neighbours` counts the real ones.
    """
    candidates = distinct_skipped(skipped, from_date).alias("s")
    asked = skipped if from_date is None else skipped.where(F.col("dt") >= day(from_date))
    return _scored(candidates.join(with_neighbours(unique, asked).alias("u"), KEY))


def _scored(pairs: DataFrame) -> DataFrame:
    """Both errors of pairs of a rejected bar and `kept` with its neighbours `prev` and `next`."""
    prev, following = F.coalesce("prev", "next"), F.coalesce("next", "prev")
    pairs = pairs.select(
        *KEY,
        F.struct(*_VALUES).alias("row"),
        "seq",
        "kept",
        (F.col("prev").isNotNull().cast("int") + F.col("next").isNotNull().cast("int")).alias("neighbours"),
        prev.alias("before"),
        following.alias("after"),
    )
    return pairs.select(
        *KEY,
        *[F.col(f"row.{c}").alias(c) for c in _VALUES],
        "seq",
        *[F.col(f"kept.{c}").alias(f"kept_{c}") for c in _VALUES],
        "neighbours",
        price_error("row", "before", "after").alias("price_error"),
        volume_error("row", "before", "after").alias("volume_error"),
        price_error("kept", "before", "after").alias("kept_price_error"),
        volume_error("kept", "before", "after").alias("kept_volume_error"),
    )


#: Groups of (symbol, calendar year) are counted by this many hashes; those of a hash that holds
#: more rows than both of these are too large to be gathered in one task.
BUCKETS, LARGE_ROWS, LARGE_SHARE = 1 << 16, 100_000, 8


def _bucket():
    return F.pmod(F.xxhash64("symbol", F.year("dt")), F.lit(BUCKETS))


def large_buckets(raw: DataFrame) -> list[int | None]:
    """Hashes of symbol and year that hold far more rows than others: at most BUCKETS / LARGE_SHARE numbers.

    None is among them if there are rows without a key.
    """
    known = F.col("symbol").isNotNull() & F.col("dt").isNotNull()
    counted = raw.groupBy(F.when(known, _bucket()).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    limit = F.greatest(F.lit(LARGE_ROWS), F.sum("n").over(Window.partitionBy()) * LARGE_SHARE / BUCKETS)
    large = counted.withColumn("limit", limit).where("bucket is null or n > limit")
    return [r.bucket for r in large.select("bucket").collect()]


def mark_beside(raw: DataFrame) -> DataFrame:
    """`mark_copies` with, on later rows, `beside`: each kept bar of the key with the previous and next one.

    The rows are dealt out once, by calendar year and symbol, which is also their order; what
    belongs together is found inside. Years of a symbol with very many rows are marked by
    `mark_copies` and `with_neighbours`, which split them, as are rows without a key.
    """
    raw = raw.select(*BAR, "seq")
    large = large_buckets(raw)
    if not large:
        return _beside_in_years(raw)
    known = F.col("symbol").isNotNull() & F.col("dt").isNotNull()
    apart = ~known | _bucket().isin([b for b in large if b is not None])
    return _beside_in_years(raw.where(~apart)).union(_beside_by_joins(raw.where(apart)))


def _beside_in_years(raw: DataFrame) -> DataFrame:
    rows = raw.withColumn("_year", F.year("dt")).repartitionByRange("_year", "symbol")
    row, bar = F.struct(*_VALUES, "seq"), lambda r: F.named_struct(*[x for c in _VALUES for x in (F.lit(c), r[c])])
    keyed = rows.groupBy("_year", "symbol", "dt").agg(
        F.min("seq").alias("_first"), F.count(F.lit(1)).alias("_n"), F.collect_list(row).alias("_rows")
    )
    alone = (F.col("_n") == 1) | F.col("_first").isNull()
    is_first = lambda r: alone | F.coalesce(r["seq"] == F.col("_first"), F.lit(False))
    keyed = keyed.withColumn("_kept", F.transform(F.filter("_rows", is_first), bar))
    window = Window.partitionBy("_year", "symbol").orderBy("dt")
    keyed = keyed.select(
        "*", F.lag(F.element_at("_kept", -1)).over(window).alias("_prev"), F.lead(F.element_at("_kept", 1)).over(window).alias("_next")
    )
    beside = F.when(F.size("_kept") < F.size("_rows"), _each_kept())
    rows = keyed.select("symbol", "dt", "_first", "_n", beside.alias("_beside"), F.explode("_rows").alias("_row"))
    first = is_first(F.col("_row"))
    key_rows = F.when(alone, F.lit(1).cast("bigint")).when(first, F.col("_n"))
    return rows.select(
        *KEY, *[F.col(f"_row.{c}").alias(c) for c in (*_VALUES, "seq")], key_rows.alias("key_rows"),
        F.when(~first, F.col("_beside")).alias("beside"),
    )


def _each_kept():
    """Kept bars of one position stand beside each other, as they do in `with_neighbours`."""
    return F.transform(
        "_kept",
        lambda k, i: F.named_struct(
            F.lit("kept"), k,
            F.lit("prev"), F.when(i == 0, F.col("_prev")).otherwise(F.get("_kept", i - 1)),
            F.lit("next"), F.when(i == F.size("_kept") - 1, F.col("_next")).otherwise(F.get("_kept", i + 1)),
        ),
    )


def _beside_by_joins(raw: DataFrame) -> DataFrame:
    marked = mark_copies(raw)
    unique, later = marked.where("key_rows is not null"), marked.where("key_rows is null")
    found = with_neighbours(unique, later).select(*KEY, F.struct("kept", "prev", "next").alias("_one"))
    found = found.groupBy(*KEY).agg(F.collect_list("_one").alias("beside"))
    later = later.join(found, KEY, "left").select(*BAR, "seq", "key_rows", "beside")
    return unique.select(*BAR, "seq", "key_rows", F.lit(None).cast(found.schema["beside"].dataType)).union(later)


def mark_arrivals(stored: DataFrame, raw: DataFrame, from_day) -> DataFrame:
    """`mark_beside` of dated rows that come to the stored ones of their years, with `kind`.

    The row of a new key is "lone", "first" where it has later ones, or "late" where it is dated
    before `from_day`; every other row is "later". "stored" are the stored rows of the keys that
    come again. Neighbours are what is stored and what is not late. All meet in one shuffle.
    """
    stored, raw = stored.select(*BAR, "seq"), raw.select(*BAR, "seq")
    large = large_buckets(raw)
    if not large:
        return _arrivals_in_years(stored, raw, from_day)
    known = F.col("symbol").isNotNull() & F.col("dt").isNotNull()
    apart = ~known | _bucket().isin([b for b in large if b is not None])
    inside = _arrivals_in_years(stored.where(~apart), raw.where(~apart), from_day)
    return inside.unionByName(_arrivals_by_joins(stored.where(apart), raw.where(apart), from_day))


def _arrivals_in_years(stored: DataFrame, raw: DataFrame, from_day) -> DataFrame:
    rows = stored.withColumn("_old", F.lit(True)).unionByName(raw.withColumn("_old", F.lit(False)))
    rows = rows.withColumn("_year", F.year("dt")).repartitionByRange("_year", "symbol")
    keyed = rows.groupBy("_year", "symbol", "dt").agg(
        F.min(F.when(~F.col("_old"), F.col("seq"))).alias("_first"),
        F.count_if(~F.col("_old")).alias("_n"),
        F.max("_old").alias("_known"),
        F.collect_list(F.struct(*_VALUES, "seq", "_old")).alias("_rows"),
    )
    alone = (F.col("_n") == 1) | F.col("_first").isNull()
    timely = F.col("dt") >= day(from_day)
    opens = lambda r: ~F.col("_known") & (alone | F.coalesce(r["seq"] == F.col("_first"), F.lit(False)))
    bar = lambda r: F.named_struct(*[x for c in _VALUES for x in (F.lit(c), r[c])])
    keyed = keyed.withColumn("_kept", F.transform(F.filter("_rows", lambda r: r["_old"] | (opens(r) & timely)), bar))
    # A key of late rows has no kept bar: its neighbours stand beside each other.
    window = "over (partition by _year, symbol order by dt)"
    keyed = keyed.select(
        "*",
        F.expr(f"lag(get(_kept, size(_kept) - 1)) ignore nulls {window}").alias("_prev"),
        F.expr(f"lead(get(_kept, 0)) ignore nulls {window}").alias("_next"),
    )
    beside = F.when(F.size("_kept") < F.size("_rows"), _each_kept())
    rows = keyed.where("_n > 0").select(
        "symbol", "dt", "_first", "_n", "_known", beside.alias("_beside"), F.explode("_rows").alias("_row")
    )
    row = F.col("_row")
    kind = F.when(row["_old"], "stored").when(~opens(row), "later").when(~timely, "late").when(alone, "lone").otherwise("first")
    rows = rows.withColumn("kind", kind)
    opened, later = F.col("kind").isin("lone", "first", "late"), F.col("kind") == "later"
    return rows.select(
        *KEY, *[row[c].alias(c) for c in (*_VALUES, "seq")],
        F.when(opened, F.when(alone, F.lit(1).cast("bigint")).otherwise(F.col("_n"))).alias("key_rows"),
        F.when(later, F.col("_beside")).alias("beside"), "kind",
    )


def _arrivals_by_joins(stored: DataFrame, raw: DataFrame, from_day) -> DataFrame:
    again = match(stored, raw.select(*KEY).distinct(), KEY, "left_semi")
    marked = _mark_arrivals(raw, again, KEY, ("seq",))
    opens = F.col("key_rows").isNotNull() & ~F.col("_known")
    kind = F.when(~opens, "later").when(F.col("dt") < day(from_day), "late").when(F.col("key_rows") > 1, "first").otherwise("lone")
    marked = marked.withColumn("kind", kind).drop("_known")
    later = marked.where("kind = 'later'")
    bars = stored.unionByName(marked.where("kind in ('lone', 'first')").select(*BAR, "seq"))
    found = with_neighbours(bars, later).select(*KEY, F.struct("kept", "prev", "next").alias("_one"))
    found = found.groupBy(*KEY).agg(F.collect_list("_one").alias("beside"))
    later = later.join(found, KEY, "left").withColumn("key_rows", F.lit(None).cast("bigint"))
    columns = [*BAR, "seq", "key_rows", "beside", "kind"]
    later = later.select(*columns)
    others = marked.where("kind <> 'later'").unionByName(again.withColumn("kind", F.lit("stored")), allowMissingColumns=True)
    return later.unionByName(others.withColumn("beside", F.lit(None).cast(later.schema["beside"].dataType)).select(*columns))


def score_beside(marked: DataFrame, from_date=None) -> DataFrame:
    """`score_skipped` from the later rows of `mark_beside`."""
    later = marked.where("key_rows is null and beside is not null")
    if from_date is not None:
        later = later.where(F.col("dt") >= day(from_date))
    # The rows of a key stand beside the same kept bars.
    distinct = later.groupBy(*BAR).agg(F.min("seq").alias("seq"), F.any_value("beside").alias("beside"))
    pairs = distinct.select(*BAR, "seq", F.explode("beside").alias("_one"))
    return _scored(pairs.select(*BAR, "seq", "_one.*"))


def replaceable(scores: DataFrame) -> DataFrame:
    better = (F.col("price_error") < F.col("kept_price_error")) | (
        F.col("volume_error") < F.col("kept_volume_error")
    )
    return scores.where((F.col("neighbours") > 0) & better)


def unverified(scores: DataFrame) -> DataFrame:
    return scores.where("neighbours = 0").drop(
        "price_error", "volume_error", "kept_price_error", "kept_volume_error"
    )


def pick_replacements(pairs: DataFrame) -> DataFrame:
    """One replacement per key, the earliest ingested of its replaceable rows."""
    return first_rows(pairs.select(*BAR, "seq"))
