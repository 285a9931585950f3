"""The batch runs: full load, delta run, membership refresh, rename of stored rows.

Every step reads stored or staged tables and writes tables, so no run carries a long
lineage. Staged results carry the run's name: a run that is started again after a
failure picks up what it had finished, and its appends leave out keys already there.
A run that ends well drops them, so the next one sees new and corrected inputs.

Every raw row is found in exactly one of `bars`, `bars_skipped` (a later row of a key),
`bars_late` (dated before what a run adds), `bars_undated` (no date) and `bars_malformed` (a
line that does not parse).
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..arguments import as_day, day
from ..operators import actions, dedupe, membership, ranges, repair, review, symbols
from ..schemas import ADJUSTED, BAR, KEY
from ..sinks import tables as sink
from ..sources.files import read_bar_lines
from ..sources.tables import from_date
from .store import PriceStore

_STORED = [*BAR, "seq"]
_RAW = [*_STORED, "malformed"]


def _in_years(table: DataFrame, years) -> DataFrame:
    return table.where(F.col("year").isin([int(y) for y in years])).drop("year")


#: What a load lists besides the bars; a reload replaces these for the years that it loads.
REJECTS = (
    "bars_skipped",
    "bars_duplicates",
    "bars_late",
    "bars_undated",
    "bars_malformed",
    "bars_unverified",
    "modified_losers",
    "replacements_refused",
)


def full_load(
    store: PriceStore, files, renames, multipliers=None, start_year=None, reviewed: review.Reviewed | None = None
) -> None:
    """Build every bar table from the files. `renames` is a resolved map.

    With `start_year` the stored years from it on are emptied and loaded, earlier ones stay.
    `reviewed` pairs replace bars instead of those that the scores would pick.
    """
    batch = "full" if start_year is None else f"full-{int(start_year)}"
    # Each staged copy goes when all that comes of it is written: the disk holds one or two at a time.
    if not store.is_staged("scores", batch):
        marked = _marked_rows(store, files, start_year, batch)
        unique = marked.where("kind in ('lone', 'first')").select(*_STORED)
        skipped = marked.where("kind = 'later'").select(*_STORED)
        duplicates = marked.where("kind in ('first', 'later')").select(*_STORED)
        _write_loaded(store, "bars", unique, start_year, batch)
        sink.write_batch(skipped, store.path("bars_skipped"), batch)
        sink.write_batch(duplicates, store.path("bars_duplicates"), batch)
        # What stands beside a rejected row was found with it: neighbours are of its calendar year, which is loaded whole.
        store.stage_once(repair.score_beside(marked.where("kind = 'later'")), "scores", batch)
    store.drop_staged(batch, "marked")

    bars = store.read("bars").drop("year")
    replace = _repair(store, store.staged("scores", batch), batch, reviewed=reviewed)
    loaded = bars if start_year is None else bars.where(F.year("dt") >= int(start_year))
    # The rows of a key share its symbol and date: ranges need not wait for the first of them.
    keys = symbols.modified_keys(loaded, replace, renames)
    if start_year is not None:
        before = store.read("bars_mod").where(F.col("year") < int(start_year))
        keys = before.select(*KEY).unionByName(keys)
    store.replace(ranges.symbol_range(bars, keys), "symbol_range", batch)
    if multipliers is not None:
        load_multipliers(store, multipliers, renames, batch=batch)
    # Ranked and adjusted behind one shuffle; rows and losers are folders of one copy.
    last_year = store.read("symbol_range").agg(F.max(F.year("end_dt")).alias("year")).first().year
    ranked = symbols.ranked_modified(loaded, replace, renames, store.read("multipliers"), last_year)
    ranked = actions.apply_multiplier(ranked)
    ranked = store.stage_once(ranked, "modified", batch, ["kind"])
    losers = ranked.where("kind = 'loser'").select(*BAR)
    sink.write_batch(losers, store.path("modified_losers"), batch)
    _write_loaded(store, "bars_mod", ranked.where("kind = 'row'").drop("kind"), start_year, batch)
    store.drop_staged(batch)


def _marked_rows(store, files, start_year, batch) -> DataFrame:
    """The rows of a load as `mark_beside` gives them, by `kind`; all that is left out is listed."""
    if not store.is_staged("marked", batch):
        # Parsed once; everything after reads columns of the staged copy.
        raw = read_bar_lines(store.spark, files, start_year=start_year).select(*_RAW)
        raw = store.stage_once(raw, "raw", batch)
        in_scope = F.col("dt").isNotNull()
        if start_year is not None:
            in_scope = in_scope & (F.year("dt") >= int(start_year))
        _clear_rejects(store, batch, start_year)
        raw = _well_formed(store, raw, batch)
        sink.write_batch(raw.where("dt is null"), store.path("bars_undated"), batch)
        sink.write_batch(raw.where(F.col("dt").isNotNull() & ~in_scope), store.path("bars_late"), batch)
        # One folder per kind, so the few repeated rows are found without reading the rest.
        kind = F.when(F.col("key_rows").isNull(), "later").when(F.col("key_rows") > 1, "first").otherwise("lone")
        marked = repair.mark_beside(raw.where(in_scope)).select(*_STORED, "key_rows", "beside", kind.alias("kind"))
        store.stage_once(marked, "marked", batch, ["kind"])
    store.drop_staged(batch, "raw")
    return store.staged("marked", batch, f"{repair.MARKED}, kind string")


def _well_formed(store, raw, batch) -> DataFrame:
    """The rows without malformed lines, which are listed."""
    sink.write_batch(raw.where("malformed is not null").select("malformed", "seq"), store.path("bars_malformed"), batch)
    return raw.where("malformed is null").drop("malformed")


def _write_loaded(store, table, rows, start_year, batch) -> None:
    """Write rows that the run has staged, laid out by year and symbol."""
    if start_year is None:
        sink.write_bars_table(rows, store.path(table), sink.in_order)
    else:
        years = _years_once(store, store.read(table), f"stored-{table}", batch)
        staged = lambda df, label: df
        sink.replace_from_year(rows, store.path(table), years, start_year, staged, sink.in_order)


def _years_once(store, table, label, batch) -> list[int]:
    """The years of stored rows as a run found them first: a broken replacement may have emptied one."""
    years = store.stage_once(table.select("year").distinct(), f"{label}-years", batch)
    return sorted(r.year for r in years.collect() if r.year is not None)


def _clear_rejects(store, batch, start_year) -> None:
    """Empty the reject tables of what a reload is about to list again."""
    for table in REJECTS:
        if not store.exists(store.path(table)):
            continue
        old = store.read(table)
        # Undated and malformed rows go by the day of their file, and stay where that has none.
        year = F.year("dt") if table not in ("bars_undated", "bars_malformed") else F.year("seq.day")
        kept = old.limit(0) if start_year is None else old.where(year.isNull() | (year < int(start_year)))
        kept = store.stage_once(kept, f"kept-{table}", batch)
        # Written as a whole: no folder of an earlier batch is left.
        kept.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("batch").parquet(store.path(table))


def _repair(store, scores, batch, from_day=None, reviewed=None) -> DataFrame:
    """Replacements for the bars of this run, from the scores of the rows it rejected or from reviewed pairs."""
    scores = store.stage_once(scores, "scores", batch)
    sink.write_batch(repair.unverified(scores).select(*_STORED), store.path("bars_unverified"), batch)
    if reviewed is None:
        picked = repair.pick_replacements(repair.replaceable(scores))
    else:
        picked = from_date(reviewed.accepted, from_day)
        sink.write_batch(
            reviewed.refused.select(*BAR, "pair", "seq", "reason"), store.path("replacements_refused"), batch
        )
    store.replace(picked, "bars_replace", batch)
    return store.read("bars_replace")


def load_multipliers(
    store: PriceStore, multipliers, renames, append=False, current_ranges=None, batch="multipliers"
) -> None:
    """Clean the actions, keep one per symbol and date and store their running product.

    Within a run `batch` is its name; what is staged goes when the run ends well.
    """
    if append:
        multipliers = actions.append_multipliers(store.read("multipliers"), multipliers)
    known = store.read("symbol_range") if current_ranges is None else current_ranges
    # Written down first: they may be a costly view, or read the table that is replaced below.
    multipliers = store.stage_once(multipliers.select(*KEY, "multiplier", "seq"), "actions", batch)
    cleaned = actions.clean_multipliers(multipliers, renames, known)
    running = actions.cum_multiplier(dedupe.first_rows(cleaned.kept), "seq")
    store.replace(running.select(*KEY, "multiplier", "seq", "cum_multiplier"), "multipliers", batch)
    store.replace(cleaned.skipped.select(*KEY, "multiplier"), "multipliers_skipped", batch)
    if batch == "multipliers":
        store.drop_staged(batch)


def delta_run(
    store: PriceStore,
    files,
    delta_date,
    renames,
    multipliers=None,
    action_mode="refresh",
    reviewed: review.Reviewed | None = None,
) -> None:
    """Add the files from `delta_date` on, which must come after everything stored.

    `action_mode` "refresh" replaces the stored actions by `multipliers`; "append" adds them to
    the stored ones, first come first kept, and adjusts stored rows after new actions again.
    `reviewed` pairs replace bars of the new days instead of those that the scores would pick.
    """
    batch = f"{as_day(delta_date):%Y%m%d}"
    known = store.read("symbol_range")
    if known.isEmpty():
        # A run that broke off while replacing the ranges left their copy behind.
        known = store.stage_once(known, "ranges_before", batch)
    ranges.require_delta_after(known, delta_date)
    raw = read_bar_lines(store.spark, files, start_date=delta_date).select(*_RAW)
    raw = _well_formed(store, store.stage_once(raw, "raw", batch), batch)
    take_in(store, raw, batch, delta_date, renames, multipliers, action_mode, reviewed)
    store.drop_staged(batch)


def take_in(
    store: PriceStore, raw: DataFrame, batch, from_day, renames, multipliers=None, action_mode="refresh", reviewed=None
) -> None:
    """Carry new raw rows through every table; only new rows are written to the bar tables.

    Rows of new keys dated before `from_day` are listed in `bars_late`, rows without a date in
    `bars_undated`.
    New rows are adjusted before they are appended, so no stored year is rewritten, unless
    appended actions reach back before `from_day`.
    """
    sink.write_batch(raw.where("dt is null"), store.path("bars_undated"), batch)
    raw = raw.where("dt is not null")
    stored_ranges = store.stage_once(store.read("symbol_range"), "ranges_before", batch)
    years = sink.years_of(raw)
    stored = _in_years(store.read("bars"), years)
    # Written down once, by kind: what is fresh, late, skipped and repeated are folders of the same copy.
    marked = store.stage_once(repair.mark_arrivals(stored, raw, from_day), "marked", batch, ["kind"])
    fresh = marked.where("kind in ('lone', 'first')").select(*_STORED)
    late = marked.where("kind = 'late'").select(*_STORED)
    if store.exists(store.path(f"bars_late/batch={batch}")):
        # The stream has listed its late files there already.
        late = late.unionByName(store.read("bars_late").where(F.col("batch") == batch).drop("batch")).distinct()
    sink.write_batch(store.stage_once(late, "late", batch), store.path("bars_late"), batch)
    _append_once(store, "bars", fresh, stored, batch)
    later = marked.where("kind = 'later'")
    sink.write_batch(later.select(*_STORED), store.path("bars_skipped"), batch)
    repeated = marked.where("kind in ('stored', 'first', 'later') or key_rows > 1")
    sink.write_batch(repeated.select(*_STORED), store.path("bars_duplicates"), batch)

    # What stands beside a rejected row was found with it, among the stored and the fresh bars of its year.
    replace = _repair(store, repair.score_beside(later, from_day), batch, from_day, reviewed)
    stored_mod = _in_years(store.read("bars_mod"), years)
    # Only the bars that this run adds: those of batches before have met the modified table already.
    modified = symbols.append_modified(stored_mod, fresh, replace, renames, store.stage_for("bars_mod", batch))
    fresh_mod = modified.fresh
    sink.write_batch(modified.skipped.select(*BAR), store.path("modified_losers"), batch)

    new_ranges = ranges.symbol_range(fresh, fresh_mod)
    anomalies = store.stage_once(ranges.range_anomalies(new_ranges, stored_ranges), "anomalies", batch)
    updated = store.stage_once(
        ranges.range_delta(new_ranges, stored_ranges).drop("action"), "ranges", batch
    )
    sink.write_batch(anomalies, store.path("range_anomalies"), batch)
    since = None
    if multipliers is not None:
        before = store.stage_once(store.read("multipliers"), "actions_before", batch)
        load_multipliers(store, multipliers, renames, action_mode == "append", updated, batch)
        if action_mode == "append":
            added = store.read("multipliers").join(before.select(*KEY), KEY, "left_anti")
            since = added.agg(F.min("dt").alias("dt")).first().dt
    adjusted = fresh_mod
    if store.exists(store.path("multipliers")):
        adjusted = actions.adjust_in_years(fresh_mod, store.read("multipliers"), years, from_day)
    _append_once(store, "bars_mod", adjusted, stored_mod, batch)
    if since is not None and since < as_day(from_day):
        update_adjusted(store, since, batch)
    # Last: from here on the gate refuses this date.
    sink.move_table(updated, store.path("symbol_range"))


def _append_once(store, table, fresh, stored, batch) -> None:
    """Append rows, laid out by year and symbol, that were found not to be stored; a run that comes here again leaves out what it appended."""
    if store.first_try(f"append-{table}", batch):
        sink.append_bars_table(fresh, store.path(table), sink.in_order)
    else:
        sink.append_new_keys(fresh, stored, store.path(table))


def update_adjusted(store: PriceStore, start_date="1900-01-01", batch="update-adjusted") -> None:
    """Re-adjust stored rows of symbols with actions from a date on; touched years are rewritten."""
    multipliers = store.read("multipliers")
    first = multipliers.agg(F.min("dt").alias("dt")).first().dt
    if first is None:
        return
    since = max(first, as_day(start_date))
    rows = store.read("bars_mod").where((F.col("year") >= since.year))
    affected = rows.where(F.col("dt") >= day(since)).join(multipliers.select("symbol"), "symbol", "left_semi")
    years = _years_once(store, affected, "adjusted", batch)
    adjusted = actions.adjust_prices(_in_years(rows, years), multipliers, start_date)
    if years:
        sink.overwrite_years(adjusted, store.path("bars_mod"), years, store.stage_for("adjusted", batch))
    if batch == "update-adjusted":
        store.drop_staged(batch)


def refresh_membership(store: PriceStore, feed, scrip_map, renames, manual, current) -> None:
    """Normalise the change feed and rebuild the snapshots.

    The maps are as the files have them, with `pos`: they are resolved here, so a scrip or fix
    listed twice does not multiply feed rows. `renames` may be resolved already.
    """
    batch = "membership"
    if "pos" in renames.columns:
        renames = symbols.resolve_map(renames)
    scrips = symbols.resolve_map(scrip_map.select(F.col("scrip").alias("old"), F.col("symbol").alias("new"), "pos"))
    fixes = symbols.resolve_map(membership.manual_map(manual), by=("dt",))
    scrips = scrips.select(F.col("old").alias("scrip"), F.col("new").alias("symbol"))
    changes = membership.normalise_changes(feed, scrips, renames, fixes)
    store.replace(changes.select("index_name", "symbol", "dt", "change_type", "seq"), "index_changes", batch)
    store.replace(membership.index_snapshots(store.read("index_changes"), current), "snapshots", batch)
    store.drop_staged(batch)


def rename_stored_symbols(store: PriceStore, renames: DataFrame) -> DataFrame:
    """Apply new renames to the stored modified rows and merge the ranges; returns the collisions."""
    # Named by the map and the last raw bar, neither of which the run changes: it can be started again.
    named = renames.agg(F.sum(F.xxhash64("old", "new").cast("decimal(38,0)")).alias("of")).first().of or 0
    last = store.read("bars").agg(F.max("dt").alias("dt")).first().dt
    batch = f"rename-{last}-{int(named) % (1 << 63):x}"
    rows = store.read("bars_mod")
    moving = rows.join(renames.select(F.col("old").alias("symbol")), "symbol", "left_semi")
    years = _years_once(store, moving, "moving", batch)
    renamed = symbols.rename_stored(_in_years(rows, years), renames)
    collisions = renamed.losers.select(*BAR, *ADJUSTED, "old_symbol")
    collisions = store.stage_once(collisions, "collisions", batch)
    sink.write_batch(collisions, store.path("rename_collisions"), batch)
    if years:
        sink.overwrite_years(renamed.rows, store.path("bars_mod"), years, store.stage_for("bars_mod", batch))
    current = ranges.symbol_range(store.read("bars"), store.read("bars_mod"))
    store.replace(ranges.merge_ranges(store.read("symbol_range"), current), "symbol_range", batch)
    collided = store.spark.read.schema(f"{_ddl(collisions)}, batch string").parquet(store.path("rename_collisions"))
    store.drop_staged(batch)
    return collided.where(F.col("batch") == batch).drop("batch")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
