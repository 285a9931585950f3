"""Index membership: change feed, snapshots, flags and their reconciliation.

Membership is handled as date lists and intervals per (index, symbol), each bounded by
the number of change dates, never as all dates x all symbols.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..arguments import day
from ..schemas import DEFAULT_INDICES, INDEX_RENAMES, KEY, MOD_SOURCE
from .symbols import rename_symbols, replace_values

MEMBER = ["index_name", "symbol"]


# ---- change feed -----------------------------------------------------------------


def change_kind(text) -> Column:
    value = F.col(text)
    return F.when(value.contains("Inclusion"), "I").when(value.contains("Exclusion"), "E").otherwise(value)


def feed_date(text) -> Column:
    """`dd-mm-yyyy` with any separator, or a date printed as `yyyy-mm-dd`, with or without a time."""
    value = F.col(text)
    day_first = F.concat(F.substring(value, 7, 4), F.substring(value, 4, 2), F.substring(value, 1, 2))
    return F.coalesce(
        F.try_to_date(F.substring(value, 1, 10), "yyyy-MM-dd"),
        F.try_to_date(day_first, "yyyyMMdd"),
    )


def normalise_changes(
    feed: DataFrame, scrip_map: DataFrame, renames: DataFrame, manual: DataFrame, index_renames=None
) -> DataFrame:
    """Feed rows with symbols, dates, I/E kinds and present index names.

    `scrip_map`, `renames` and `manual` have one row per old value
    (see `resolve_map` and `manual_map`).
    """
    changes = feed.withColumns(
        {
            "symbol": F.col("scrip"),
            "change_type": change_kind("change_text"),
            "dt": feed_date("date_text"),
        }
    ).drop("scrip", "change_text", "date_text")
    changes = replace_values(changes, scrip_map, "symbol", old="scrip", new="symbol")
    changes = rename_symbols(changes, renames)
    names = INDEX_RENAMES if index_renames is None else index_renames
    name = F.col("index_name")
    for old, new in names.items():
        name = F.when(F.col("index_name") == old, new).otherwise(name)
    changes = changes.withColumn("index_name", name)
    return replace_values(changes, manual, "symbol", by=("dt",))


def manual_map(manual: DataFrame) -> DataFrame:
    """Manual corrections as a map: old symbol and date to the first correct symbol listed.

    `pos` is the first line that names the symbol, the order in which symbols are handled.
    """
    first = manual.groupBy("symbol").agg(
        F.min_by("correct_symbol", "pos").alias("new"), F.min("pos").alias("pos")
    )
    days = manual.select("symbol", "dt").distinct()
    return days.join(first, "symbol").select("dt", F.col("symbol").alias("old"), "new", "pos")


def unmapped_scrips(feed: DataFrame, scrip_map: DataFrame) -> DataFrame:
    return feed.select("scrip").distinct().join(scrip_map.select("scrip"), "scrip", "left_anti")


# ---- snapshots -------------------------------------------------------------------


def _ranked_dates(dated: DataFrame) -> DataFrame:
    """Distinct dates per index with rank and next date; bounded by the calendar."""
    by_date = Window.partitionBy("index_name").orderBy("dt")
    return (
        dated.select("index_name", "dt")
        .distinct()
        .select(
            "index_name",
            "dt",
            F.row_number().over(by_date).alias("rank"),
            F.lead("dt").over(by_date).alias("next_dt"),
        )
    )


def index_snapshots(changes: DataFrame, current: DataFrame) -> DataFrame:
    """Members of each index from each of its change dates on.

    The newest date takes the current components as given. Going back, a date shows the
    symbol out if it was excluded then (also if included too), in if it was included,
    else by its nearest later change: a later exclusion means it was in, a later
    inclusion that it was not; with none, it was in if it is a current component.

    The dates of an index are numbered. One row per (index, symbol) holds the numbers of the
    symbol's own changes in order; one walk over them gives the stretches of dates in between
    that hold the symbol, so the work grows with changes plus members, not with changes times
    dates. Both lists are bounded by the calendar.
    """
    out = F.when(F.col("change_type") == "E", 1).when(F.col("change_type") == "I", 0)
    events = changes.where("dt is not null").select(*MEMBER, "dt", out.alias("out"))
    days = _ranked_dates(events.join(current.select("index_name").distinct(), "index_name", "left_semi"))
    of_index = days.groupBy("index_name").agg(F.array_sort(F.collect_list("dt")).alias("dates"))
    coded = events.where(F.col("out").isNotNull()).join(days.select("index_name", "dt", "rank"), ["index_name", "dt"])
    # An inclusion on date r is 2r, an exclusion 2r + 1: ordered, one date's codes stand together.
    own = coded.select(*MEMBER, (2 * F.col("rank") + F.col("out")).alias("code"), F.lit(0).alias("listed")).unionByName(
        current.select(*MEMBER, F.lit(None).cast("int").alias("code"), F.lit(1).alias("listed"))
    )
    own = own.groupBy(*MEMBER).agg(
        F.array_sort(F.collect_set("code")).alias("codes"), F.sum("listed").cast("int").alias("listings")
    )
    date_of = lambda code: F.shiftright(code, 1)
    before = lambda i: F.coalesce(date_of(F.get("codes", i - 1)), F.lit(0))

    def between(first, last):
        return F.slice("dates", first, F.greatest(last - first + 1, F.lit(0)))

    def held(code, i):
        excluded, date = code % 2 == 1, date_of(code)
        # In up to an exclusion; on an inclusion's own date unless the symbol is excluded then too.
        until = F.when(excluded & (before(i) < date), between(before(i) + 1, date - 1))
        at = F.when(
            ~excluded & (date < F.size("dates")) & ~F.coalesce(F.get("codes", i + 1) == code + 1, F.lit(False)),
            between(date, date),
        )
        return F.coalesce(until, at, F.slice("dates", 1, 0))

    last = F.coalesce(date_of(F.get("codes", F.size("codes") - 1)), F.lit(0))
    since = F.when(F.col("listings") > 0, between(last + 1, F.size("dates") - 1)).otherwise(F.slice("dates", 1, 0))
    newest = F.array_repeat(F.element_at("dates", -1), F.col("listings"))
    dates = F.concat(F.flatten(F.transform("codes", held)), since, newest)
    return own.join(of_index, "index_name").select(*MEMBER, F.explode(dates).alias("dt"))


def change_history(snapshots: DataFrame, index_name) -> DataFrame:
    return snapshots.where(F.col("index_name") == index_name)


def change_dates(snapshots: DataFrame, index_name) -> DataFrame:
    return change_history(snapshots, index_name).select("dt").distinct()


def snapshots_from(snapshots: DataFrame, from_year, indices=None) -> DataFrame:
    """Snapshots needed to flag bars from a year on: the last one before it, else the first after."""
    if indices is not None:
        snapshots = snapshots.where(F.col("index_name").isin(list(indices)))
    start = F.make_date(F.lit(int(from_year)), F.lit(1), F.lit(1))
    first = snapshots.groupBy("index_name").agg(
        F.coalesce(F.max(F.when(F.col("dt") < start, F.col("dt"))), F.min("dt")).alias("first_dt")
    )
    return snapshots.join(first, "index_name").where("dt >= first_dt").drop("first_dt")


def membership_intervals(snapshots: DataFrame) -> DataFrame:
    """Maximal [from_dt, to_dt) stretches of consecutive snapshots that hold the symbol."""
    dates = _ranked_dates(snapshots)
    # One shuffle by symbol serves the window, the grouping and later joins on symbol.
    held = snapshots.select(*MEMBER, "dt").join(dates, ["index_name", "dt"]).repartition("symbol")
    island = F.col("rank") - F.dense_rank().over(Window.partitionBy("symbol", "index_name").orderBy("rank"))
    return (
        held.withColumn("island", island)
        .groupBy("symbol", "index_name", "island")
        .agg(F.min("dt").alias("from_dt"), F.max_by("next_dt", "rank").alias("to_dt"))
        .drop("island")
    )


# ---- flags -----------------------------------------------------------------------


def _inside(spans, date) -> Column:
    return F.exists(
        spans, lambda s: (date >= s["from_dt"]) & (s["to_dt"].isNull() | (date < s["to_dt"]))
    )


def flag_bars(bars: DataFrame, snapshots: DataFrame, indices, names=None) -> DataFrame:
    """Add a 0/1 column per index by the latest snapshot on or before the bar's date.

    The intervals are first folded to one row per symbol with one short array per index,
    so a bar meets one row whatever the number of indices, and the bars are not
    multiplied, pivoted or grouped.
    """
    names = list(indices) if names is None else names
    of_index = [
        F.collect_list(F.when(F.col("index_name") == i, F.struct("from_dt", "to_dt"))).alias(f"_spans{n}")
        for n, i in enumerate(indices)
    ]
    spans = membership_intervals(snapshots.where(F.col("index_name").isin(list(indices))))
    spans = spans.groupBy("symbol").agg(*of_index)
    flagged = bars.join(spans, "symbol", "left")
    flags = {
        name: F.when(_inside(F.col(f"_spans{n}"), F.col("dt")), 1).otherwise(0) for n, name in enumerate(names)
    }
    return flagged.select(*bars.columns, *[flags[name].alias(name) for name in names])


def membership_flags(bars_mod: DataFrame, snapshots: DataFrame, indices=None, from_year=1995) -> DataFrame:
    indices = DEFAULT_INDICES if indices is None else indices
    start = F.make_date(F.lit(int(from_year)), F.lit(1), F.lit(1))
    bars = bars_mod.where(F.col("dt") >= start).select(*KEY)
    return flag_bars(bars, snapshots_from(snapshots, from_year, indices), indices)


def current_flags(bars_mod: DataFrame, current: DataFrame, indices=None, from_date="1900-01-01") -> DataFrame:
    """0/1 per index by the current components, for bars from a date on."""
    indices = DEFAULT_INDICES if indices is None else indices
    bars = bars_mod.where(F.col("dt") >= day(from_date)).select(*KEY)
    held = current.where(F.col("index_name").isin(list(indices)))
    held = held.groupBy("symbol").agg(
        *[F.max(F.when(F.col("index_name") == i, 1)).alias(f"_held{n}") for n, i in enumerate(indices)]
    )
    flagged = bars.join(held, "symbol", "left")
    return flagged.select(
        *KEY, *[F.coalesce(f"_held{n}", F.lit(0)).alias(i) for n, i in enumerate(indices)]
    )


# ---- checks ----------------------------------------------------------------------


def check_change_dates(changes: DataFrame, bars_mod: DataFrame, ranges: DataFrame) -> DataFrame:
    """Changes without a bar on their date whose symbol is unknown or out of its range."""
    # The bars are cut down to the few keys in question before anything else.
    wanted = changes.select(*KEY).distinct()
    present = bars_mod.select(*KEY).join(wanted, KEY, "left_semi").distinct()
    absent = changes.join(present, KEY, "left_anti")
    stored = ranges.where(F.col("source") == MOD_SOURCE).select("symbol", "start_dt", "end_dt")
    dated = absent.join(stored, "symbol", "left")
    unknown = F.col("start_dt").isNull()
    in_range = (F.col("start_dt") < F.col("dt")) & (F.col("dt") < F.col("end_dt"))
    sentinel = F.lit("9999-01-01").cast("date")
    report = dated.where(unknown | ~in_range).select(
        "change_type",
        "symbol",
        F.coalesce("start_dt", sentinel).alias("range_start"),
        F.coalesce("end_dt", sentinel).alias("range_end"),
        F.when(unknown, "Not Found").otherwise("Found out of Range").alias("found"),
        F.col("dt").alias("search_dt"),
        "index_name",
    )
    return report.withColumns(
        {
            "diff_before": F.greatest(F.lit(0), F.datediff("range_start", "search_dt")),
            "diff_after": F.greatest(F.lit(0), F.datediff("search_dt", "range_end")),
        }
    )


def last_change(changes: DataFrame) -> DataFrame:
    """Latest change per index and symbol; on one date the later listed one."""
    latest = F.max(F.struct("dt", "seq", "change_type")).alias("last")
    return changes.groupBy(*MEMBER).agg(latest).select(*MEMBER, "last.dt", "last.change_type")


def membership_recon(changes: DataFrame, current: DataFrame) -> DataFrame:
    """Symbols last included but not current, and current but not last included."""
    last = last_change(changes)
    included = last.where("change_type = 'I'").select(*MEMBER, F.lit(True).alias("_included"))
    seen = last.select("index_name").distinct()
    listed = current.join(seen, "index_name", "left_semi").select(*MEMBER, F.lit(True).alias("_listed")).distinct()
    both = included.join(listed, MEMBER, "full_outer").where("_included is null or _listed is null")
    side = F.when(F.col("_listed").isNull(), "last include not current").otherwise("current not last include")
    return both.select(*MEMBER, side.alias("side"))


def flags_recon(flags: DataFrame, snapshots: DataFrame, indices=None, end_year=None) -> DataFrame:
    """Per snapshot interval and calendar year: members without a flagged bar, and the reverse.

    The last interval runs to the last year of the flags. Flagged bars before the first
    snapshot are compared with an empty membership dated 1900-01-01. With `end_year` neither
    snapshots nor flags after that year count.

    The change dates of all indices cut time into stretches. Bars are folded to one row per
    symbol, year and stretch before they meet the indices, so neither bars nor days are
    multiplied; stretches and intervals are bounded by the calendar.
    """
    indices = list(DEFAULT_INDICES if indices is None else indices)
    snapshots = snapshots.where(F.col("index_name").isin(indices))
    if end_year is not None:
        snapshots = snapshots.where(F.year("dt") <= int(end_year))
        flags = flags.where(F.year("dt") <= int(end_year))
    dates = _ranked_dates(snapshots).select("index_name", "dt", "next_dt")
    cuts = dates.select(F.col("dt").alias("cut")).distinct()

    # Stretches from one cut to the next, per year that they touch; the last one is open.
    ordered = cuts.agg(F.sort_array(F.collect_list("cut")).alias("cuts"))
    stretches = ordered.select(F.posexplode("cuts").alias("at", "cut"), "cuts")
    stretches = stretches.select("cut", F.get("cuts", F.col("at") + 1).alias("next_cut"))
    last_cut = cuts.agg(F.max(F.year("cut"))).scalar()
    touched = F.sequence(F.year("cut"), F.coalesce(F.year("next_cut"), F.year("cut")))
    stretches = stretches.select("cut", "next_cut", F.explode(touched).alias("_year"))
    held = [F.max(F.col(i)).alias(f"_held{n}") for n, i in enumerate(indices)]
    days = flags.select(*KEY, *indices).withColumn("_year", F.least(F.year("dt"), last_cut))
    in_stretch = (F.col("dt") >= F.col("cut")) & (F.col("next_cut").isNull() | (F.col("dt") < F.col("next_cut")))
    days = days.join(stretches.withColumnRenamed("_year", "_y"), (F.col("_year") == F.col("_y")) & in_stretch, "left")
    folded = days.groupBy("symbol", F.year("dt").alias("year"), "cut").agg(*held)

    # Which snapshot of each index holds during a stretch: the last one on or before its cut.
    index_cuts = cuts.select("cut", F.explode(F.array(*[F.lit(i) for i in indices])).alias("index_name"))
    index_cuts = index_cuts.join(
        dates.select("index_name", F.col("dt").alias("cut"), F.col("dt").alias("own")), ["index_name", "cut"], "left"
    )
    so_far = Window.partitionBy("index_name").orderBy("cut").rowsBetween(Window.unboundedPreceding, 0)
    index_cuts = index_cuts.select("index_name", "cut", F.last("own", ignorenulls=True).over(so_far).alias("snap_dt"))

    flagged = F.array_compact(F.array(*[F.when(F.col(f"_held{n}") == 1, F.lit(i)) for n, i in enumerate(indices)]))
    found = folded.select("symbol", "year", "cut", F.explode(flagged).alias("index_name"))
    found = found.join(index_cuts, ["index_name", "cut"], "left").select(
        *MEMBER,
        F.coalesce("snap_dt", F.lit("1900-01-01").cast("date")).alias("snap_dt"),
        "year",
        F.lit(True).alias("_found"),
    )
    found = found.distinct()

    last_year = flags.agg(F.max(F.year("dt"))).scalar()
    until = F.coalesce(F.year(F.date_sub("next_dt", 1)), F.greatest(F.year("dt"), last_year))
    years = dates.select("index_name", "dt", F.explode(F.sequence(F.year("dt"), until)).alias("year"))
    expected = snapshots.select(*MEMBER, "dt").distinct().join(years, ["index_name", "dt"])
    expected = expected.select(*MEMBER, F.col("dt").alias("snap_dt"), "year", F.lit(True).alias("_expected"))

    both = expected.join(found, [*MEMBER, "snap_dt", "year"], "full_outer")
    both = both.where("_expected is null or _found is null")
    side = F.when(F.col("_found").isNull(), "snapshot only").otherwise("flags only")
    return both.select("index_name", "snap_dt", "year", "symbol", side.alias("side"))
