"""Every operator as a query over the given tables."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..operators import actions, days, dedupe, history, membership, ranges, repair, reports, review, symbols
from ..plans import runs, serve
from ..plans.store import PriceStore
from ..schemas import ADJUSTED, BAR, KEY
from ..session import tune, work_path
from ..sinks import exports
from ..sinks import tables as sink
from ..sources import files
from ..sources.files import read_bar_files
from ..sources.tables import fetch_bars
from ..streaming.ingest import start_ingest
from .views import CODES, INDICES, spark_view, spelled_out

QUERIES = {}

# The dates that split the data into stored and newly delivered rows. Deliveries reach
# back before the end of what is stored, so both sides hold some of the same keys.
STORED_UNTIL = "2000-01-01"
DELIVERED_FROM = "1999-07-01"
DELTA = "2000-01-01"
INDEX = "1-URGENT"
# After the last membership change, and before the last bar.
AFTER_CHANGES = "2001-08-15"


class Inputs:
    """The views of one data folder."""

    def __init__(self, spark, sf_dir):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name) -> DataFrame:
        return spark_view(self.spark, self.sf_dir, name)

    def unique(self, view="bars_raw") -> DataFrame:
        return dedupe.first_rows(spark_view(self.spark, self.sf_dir, view))

    def bars_mod(self) -> DataFrame:
        return actions.without_adjustment(self.unique().select(*BAR))

    def adjusted(self) -> DataFrame:
        return actions.adjust_prices(self.bars_mod(), self.cumulative())

    def cumulative(self) -> DataFrame:
        return actions.cum_multiplier(self.multipliers_raw)

    def repeated(self, view="bars_raw") -> DataFrame:
        return self.table("repeated", dedupe.repeated_keys(spark_view(self.spark, self.sf_dir, view)))

    def skipped(self, view="bars_raw") -> DataFrame:
        return dedupe.later_rows(spark_view(self.spark, self.sf_dir, view), repeated=self.repeated(view))

    def marked(self, view="bars_raw") -> DataFrame:
        return repair.mark_beside(spark_view(self.spark, self.sf_dir, view))

    def scores(self, view="bars_raw", from_date=None, marked=None) -> DataFrame:
        if marked is None:
            # A row without a position is no later row of its key.
            marked = self.marked(view).where("key_rows is not null or seq is not null")
        return repair.score_beside(marked, from_date)

    def table(self, name, df) -> DataFrame:
        """`df` as a stored table, which is how later operators find it."""
        store = PriceStore(self.spark, work_path(self.spark, name))
        df.write.parquet(store.path(name))
        return self.spark.read.schema(df.schema).parquet(store.path(name))

    def replacements(self, marked=None) -> DataFrame:
        return self.table("bars_replace", repair.pick_replacements(repair.replaceable(self.scores(marked=marked))))

    def modified(self) -> symbols.Modified:
        """One marking of the copies serves the scores and the bars."""
        marked = self.table("marked", self.marked())
        unique = marked.where("key_rows is not null").select(*BAR, "seq")
        return symbols.build_modified(unique, self.replacements(marked), self.renames)

    def snapshots(self) -> DataFrame:
        return self.table("snapshots", membership.index_snapshots(self.index_changes, self.index_current))

    def stored(self) -> DataFrame:
        return dedupe.first_rows(self.bars_raw.where(F.col("dt") < STORED_UNTIL))

    def delivered(self) -> DataFrame:
        return self.bars_raw.where(F.col("dt") >= DELIVERED_FROM)

    def ranges(self) -> DataFrame:
        """Ranges of the stored part; renamed symbols only occur in the modified table."""
        bars = self.stored()
        return ranges.symbol_range(bars, symbols.rename_symbols(bars, self.renames))

    def new_ranges(self) -> DataFrame:
        bars = self.bars_raw.where(F.col("dt") >= DELIVERED_FROM)
        return ranges.symbol_range(bars, symbols.rename_symbols(bars, self.renames))


def query(function):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spelled_out(function(Inputs(tune(spark), sf_dir)))

    run.__doc__ = function.__doc__
    QUERIES[function.__name__] = run
    return function


# ---- files -----------------------------------------------------------------------


def _month(column="dt"):
    return F.trunc(column, "month")


def _landed(x: Inputs) -> str:
    """The raw bars as headerless text files, one folder per month."""
    path = work_path(x.spark, "landing")
    exports.write_bar_files(x.bars_raw, path, _month())
    return path


@query
def scan_bars(x):
    return read_bar_files(x.spark, _landed(x), start_year=1996).drop("seq")


@query
def scan_bars_delta(x):
    return read_bar_files(x.spark, _landed(x), start_date=DELTA).drop("seq")


@query
def fetch_bars_range(x):
    return fetch_bars(x.unique(), x.wanted_symbols, "1996-03-01", "1999-10-31").select(*BAR)


@query
def ingest_stream(x):
    """Stored bars, then a stream of the files from two months before their end on."""
    store = PriceStore(x.spark, work_path(x.spark, "stream"))
    files = _landed(x)
    loaded = dedupe.first_rows(
        read_bar_files(x.spark, files).where(F.col("file_day") < STORED_UNTIL).drop("file_day")
    )
    sink.write_bars_table(loaded, store.path("bars"))
    start_ingest(store, files, start_date="1999-11-01").awaitTermination()
    tables = [
        store.read(table).select(*BAR, F.lit(table).alias("went_to"))
        for table in ("bars", "bars_skipped", "bars_late", "bars_mod")
    ]
    return reduce(DataFrame.unionByName, tables)


def _file_multipliers(x):
    """Actions as read from a file: the position is file, block and row."""
    return _placed(x.multipliers_raw)


@query
def ingest_stream_files(x):
    """A stream that takes three files a batch; which of equal keys comes first is up to the order of files."""
    store = PriceStore(x.spark, work_path(x.spark, "stream-files"))
    landing = work_path(x.spark, "landing")
    exports.write_bar_files(x.bars_raw, landing, F.trunc("dt", "year"))
    start_ingest(store, landing, max_files=3).awaitTermination()
    tables = [store.read(t).select(*KEY, F.lit(t).alias("went_to")) for t in ("bars", "bars_skipped")]
    return reduce(DataFrame.unionByName, tables)


@query
def full_load(x):
    """Text files to adjusted bars through every stored table."""
    store = PriceStore(x.spark, work_path(x.spark, "full"))
    runs.full_load(store, _landed(x), x.renames, _file_multipliers(x))
    return store.read("bars_mod").select(*BAR, *ADJUSTED)


@query
def full_load_again(x):
    """Loaded before the last files have come, and once more with them."""
    store = PriceStore(x.spark, work_path(x.spark, "again"))
    landing = work_path(x.spark, "landing")
    raw, new = x.bars_raw, F.col("dt") >= DELTA
    exports.write_bar_files(raw.where(~new), f"{landing}/old", _month())
    runs.full_load(store, landing, x.renames, _file_multipliers(x))
    exports.write_bar_files(raw.where(new), f"{landing}/new", _month())
    runs.full_load(store, landing, x.renames, _file_multipliers(x))
    return store.read("bars_mod").select(*BAR, *ADJUSTED)


@query
def full_load_from_year(x):
    """Loaded, then the years from 1999 on loaded again; earlier ones stay."""
    store = PriceStore(x.spark, work_path(x.spark, "from-year"))
    landing = _landed(x)
    runs.full_load(store, landing, x.renames, _file_multipliers(x))
    runs.full_load(store, landing, x.renames, _file_multipliers(x), start_year=1999)
    return store.read("bars").select(*BAR)


@query
def read_multipliers(x):
    """Actions written as a CSV file and read back through the reader."""
    path = work_path(x.spark, "actions-csv")
    rows = x.multipliers_raw.select(
        F.col("symbol").alias("Symbol"), F.date_format("dt", "yyyyMMdd").alias("Date"), F.col("multiplier").alias("Multiplier")
    )
    rows.write.option("header", True).csv(path)
    return files.read_multipliers(x.spark, path).drop("seq")


def _placed(df):
    """The position as files give it."""
    place = F.struct(
        F.lit(None).cast("date").alias("day"), F.lit("").alias("file"), F.lit(0).cast("bigint").alias("block"),
        F.col("seq").cast("bigint").alias("row"),
    )
    return df.withColumn("seq", place)


def _spoilt(x) -> str:
    """Bar files in which the lines of some volumes do not parse: a price, a field too few, one too many."""
    path = work_path(x.spark, "spoilt")
    volume = F.col("volume")
    fields = [
        F.col("symbol"), F.date_format("dt", "yyyyMMdd"), F.when(volume == 7, "n/a").otherwise(F.col("open").cast("string")),
        *[F.col(c).cast("string") for c in ("high", "low", "close")],
        F.when(volume != 13, volume.cast("string")), F.when(volume == 21, "more"),
    ]
    lines = x.bars_raw.select(F.concat_ws(",", *fields).alias("line"), _month().alias("file_day"), "seq")
    lines = lines.repartitionByRange("file_day", "seq").sortWithinPartitions("file_day", "seq")
    lines.select("line", "file_day").write.partitionBy("file_day").text(path)
    return path


@query
def malformed_lines(x):
    """Every raw line in one table: kept, rejected or malformed."""
    store = PriceStore(x.spark, work_path(x.spark, "malformed"))
    runs.full_load(store, _spoilt(x), x.renames)
    nothing = F.lit(None).cast("int")
    parts = F.split("malformed", ",")
    bad = store.read("bars_malformed").select(
        parts[0].alias("symbol"), F.to_date(parts[1], "yyyyMMdd").alias("dt"), F.size(parts).alias("fields"),
        F.lit("bars_malformed").alias("went_to"),
    )
    good = [
        store.read(t).select(*KEY, nothing.alias("fields"), F.lit(t).alias("went_to")) for t in ("bars", "bars_skipped")
    ]
    return reduce(DataFrame.unionByName, [bad, *good])


def _reviewed(x) -> review.Reviewed:
    """Pairs written to two files as a reviewer leaves them, and read back.

    By the rejected row's volume: some pairs are struck out, some lose their selected or their
    skipped line, some get another date or symbol, some a price that is no number.
    """
    path = work_path(x.spark, "pairs")
    scores = x.table("pairs-found", repair.replaceable(x.scores())).withColumn("pair", F.sha2(F.to_json(F.struct(*BAR)), 256))
    volume = F.col("volume")
    scores = scores.where(volume != 5).repartitionByRange("seq").sortWithinPartitions("seq")
    date = lambda of: F.date_format(of, "yyyyMMdd").alias("dt")
    selected = scores.where(volume != 11).select(
        "pair", F.when(volume == 17, "OTHER").otherwise(F.col("symbol")).alias("symbol"),
        date(F.when(volume == 23, F.date_add("dt", 1)).otherwise(F.col("dt"))),
        *[F.col(f"kept_{c}").alias(c) for c in BAR if c not in KEY],
    )
    skipped = scores.where(volume != 31).select(
        "pair", "symbol", date(F.col("dt")), F.when(volume == 41, "n/a").otherwise(F.col("open").cast("string")).alias("open"),
        *[c for c in BAR if c not in (*KEY, "open")],
    )
    sides = []
    for name, lines in (("selected", selected), ("skipped", skipped)):
        lines.write.option("header", "true").csv(f"{path}/{name}")
        # Parsed once: the pairs are counted and judged from the copy.
        sides.append(x.table(f"pairs-{name}", files.read_pairs(x.spark, f"{path}/{name}")))
    return review.match_pairs(*sides, stage=lambda df, label: x.table(f"pairs-{label}", df))


@query
def read_replacements(x):
    found = _reviewed(x)
    accepted = found.accepted.select(*KEY, "open", "volume", F.lit(None).cast("string").alias("reason"))
    return accepted.unionByName(found.refused.select(*KEY, "open", "volume", "reason"))


@query
def full_load_reviewed(x):
    """A load that replaces bars by reviewed pairs."""
    store = PriceStore(x.spark, work_path(x.spark, "reviewed"))
    runs.full_load(store, _landed(x), x.renames, _file_multipliers(x), reviewed=_reviewed(x))
    return store.read("bars_mod").select(*BAR, *ADJUSTED)


@query
def read_index_feed(x):
    """The change feed in two landings, read as one."""
    path = work_path(x.spark, "feed-csv")
    feed = x.index_feed.select(
        F.col("index_name").alias("Index"), F.col("date_text").alias("Date"), F.col("scrip").alias("Symbol"),
        F.col("change_text").alias("ChangeType"),
    )
    old = F.substring("Date", 7, 4) < "1999"
    for name, part in (("old", feed.where(old)), ("new", feed.where(~old))):
        part.write.option("header", "true").csv(f"{path}/{name}")
    return files.read_index_feed(x.spark, [f"{path}/old", f"{path}/new"]).drop("seq")


@query
def read_scrip_map(x):
    path = work_path(x.spark, "scrips-csv")
    x.scrip_map.write.option("header", "true").csv(path)
    return files.read_scrip_map(x.spark, path).drop("pos")


@query
def read_manual_fixes(x):
    """A file in the Windows code page, with letters and marks beyond ASCII."""
    path = work_path(x.spark, "manual-csv")
    # Bytes 0x96 and 0x93: a dash and a quotation mark there.
    named = F.concat("symbol", F.lit(" \x96 Caf\u00e9 \x93x"))
    fixes = x.manual_fix.select(named.alias("Symbol"), F.date_format("dt", "yyyyMMdd").alias("Date"), F.col("correct_symbol").alias("CorrectSymbol"))
    fixes.write.option("header", "true").option("encoding", "iso-8859-1").csv(path)
    return files.read_manual_fixes(x.spark, path).drop("pos")


@query
def read_index_current(x):
    path = work_path(x.spark, "current-csv")
    x.index_current.write.option("header", "true").csv(path)
    return files.read_index_current(x.spark, path)


@query
def refresh_membership(x):
    """Feed and maps through the store, with every scrip and fix listed twice, to snapshots."""
    store = PriceStore(x.spark, work_path(x.spark, "membership"))
    pos = F.monotonically_increasing_id()
    scrips = x.scrip_map.withColumn("pos", pos)
    fixes = x.manual_fix.drop("pos").withColumn("pos", pos)
    twice = lambda df: df.unionByName(df.withColumn("pos", F.col("pos") + (1 << 60)))
    current = x.index_current
    runs.refresh_membership(store, _placed(x.index_feed), twice(scrips), x.renames, twice(fixes), current)
    changed = store.read("index_changes").select("index_name", "symbol", "dt", "change_type")
    return changed.unionByName(store.read("snapshots").withColumn("change_type", F.lit("snapshot")))


def _loaded(x, label) -> PriceStore:
    store = PriceStore(x.spark, work_path(x.spark, label))
    runs.full_load(store, _landed(x), x.renames, _file_multipliers(x))
    return store


@query
def update_adjusted(x):
    """Loaded without actions, which come later: the stored rows from 1999 on are adjusted in place."""
    store = PriceStore(x.spark, work_path(x.spark, "unadjusted"))
    runs.full_load(store, _landed(x), x.renames)
    runs.load_multipliers(store, _file_multipliers(x), x.renames)
    runs.update_adjusted(store, "1999-01-01")
    return store.read("bars_mod").select(*BAR, *ADJUSTED)


@query
def delta_run_append(x):
    """The actions up to 1999 with the load, the others appended by the delta run."""
    store = PriceStore(x.spark, work_path(x.spark, "append"))
    landing = work_path(x.spark, "landing")
    raw, new = x.bars_raw, F.col("dt") >= DELTA
    exports.write_bar_files(raw.where(~new), f"{landing}/old", _month())
    exports.write_bar_files(raw.where(new), f"{landing}/new", _month())
    known = _file_multipliers(x)
    runs.full_load(store, f"{landing}/old", x.renames, known.where(~new))
    runs.delta_run(store, landing, DELTA, x.renames, known.where(F.col("dt") >= DELIVERED_FROM), action_mode="append")
    return store.read("bars_mod").select(*BAR, *ADJUSTED)


@query
def rename_stored_run(x):
    """Loaded under the old names, then renamed in the store; collisions are listed."""
    store = PriceStore(x.spark, work_path(x.spark, "renamed"))
    runs.full_load(store, _landed(x), x.renames.limit(0))
    collisions = runs.rename_stored_symbols(store, x.renames)
    kept = store.read("bars_mod").select(*KEY, F.lit(None).cast("string").alias("old_symbol"))
    return kept.unionByName(collisions.select(*KEY, "old_symbol"))


@query
def reports_written(x):
    """All reports and yearly flag files from a store: rows counted while writing and rows read back."""
    store = _loaded(x, "reports")
    _placed(x.index_changes).write.parquet(store.path("index_changes"))
    x.snapshots().write.parquet(store.path("snapshots"))
    path = work_path(x.spark, "reports-csv")
    written = serve.write_reports(store, path, INDICES, 1996)
    read = []
    for name, rows in written.items():
        folder = f"{path}/{name}" if not name.startswith("flags_") else f"{path}/flags/year={name[6:]}"
        back = x.spark.read.option("header", "true").csv(folder) if rows else x.spark.range(0)
        read.append(back.agg(F.lit(name).alias("report"), F.lit(rows).cast("bigint").alias("written"), F.count(F.lit(1)).alias("read_back")))
    return reduce(DataFrame.unionByName, read)


@query
def read_renames(x):
    """The rename map written as CSV and read back."""
    path = work_path(x.spark, "renames-csv")
    x.renames.write.option("header", True).csv(path)
    return files.read_renames(x.spark, path).drop("pos")


@query
def delta_run(x):
    """The years up to 1999 loaded in full, the rest added by a delta run."""
    store = PriceStore(x.spark, work_path(x.spark, "delta"))
    files = work_path(x.spark, "landing")
    raw, new = x.bars_raw, F.col("dt") >= DELTA
    exports.write_bar_files(raw.where(~new), f"{files}/old", _month())
    exports.write_bar_files(raw.where(new), f"{files}/new", _month())
    runs.full_load(store, f"{files}/old", x.renames, _file_multipliers(x))
    runs.delta_run(store, files, DELTA, x.renames, _file_multipliers(x))
    return store.read("bars_mod").select(*BAR, *ADJUSTED)


@query
def rewrite_year(x):
    """One stored year replaced by halved prices, read back with the untouched years."""
    path = work_path(x.spark, "rewrite")
    sink.write_bars_table(x.unique().select(*BAR), path)
    stored = x.spark.read.parquet(path)
    halved = stored.where("year = 1998").drop("year").withColumn("close", F.col("close") / 2)
    sink.overwrite_years(halved, path, [1998])
    return x.spark.read.parquet(path).select(*BAR)


# ---- duplicates ------------------------------------------------------------------


@query
def dedupe_first(x):
    return x.unique()


@query
def duplicates_all(x):
    return dedupe.duplicate_rows(x.bars_raw, repeated=x.repeated())


@query
def skipped_rows(x):
    return x.skipped()


@query
def skipped_distinct(x):
    return reports.skipped_distinct(x.skipped(), "1996-01-01")


@query
def append_bars(x):
    return dedupe.append_first(x.stored(), x.delivered()).rows


@query
def append_skipped(x):
    return dedupe.append_first(x.stored(), x.delivered()).skipped


@query
def append_duplicates(x):
    return dedupe.append_first(x.stored(), x.delivered()).duplicates


@query
def dups_not_skipped(x):
    raw = x.bars_sparse
    return dedupe.duplicates_not_skipped(dedupe.duplicate_rows(raw), dedupe.later_rows(raw))


@query
def dup_key_counts(x):
    return dedupe.key_counts(dedupe.duplicate_rows(x.bars_raw, repeated=x.repeated()))


# ---- repair ----------------------------------------------------------------------


@query
def repair_scores(x):
    return x.scores()


@query
def repair_scores_sparse(x):
    return x.scores("bars_sparse")


@query
def replaceable(x):
    return repair.replaceable(x.scores(from_date="1996-01-01"))


@query
def unverified(x):
    return repair.unverified(x.scores("bars_sparse"))


@query
def replacements(x):
    return repair.pick_replacements(repair.replaceable(x.scores()))


# ---- symbols ---------------------------------------------------------------------


@query
def rename_symbols(x):
    return symbols.rename_symbols(x.bars_raw, x.renames)


@query
def resolve_map(x):
    return symbols.resolve_map(x.rename_chain)


@query
def build_modified(x):
    return x.modified().rows


@query
def modified_losers(x):
    return x.modified().losers


@query
def append_modified(x):
    stored = actions.without_adjustment(x.stored().select(*BAR))
    new = dedupe.first_rows(x.delivered())
    return symbols.append_modified(stored, new, x.replacements(), x.renames).rows


@query
def rename_stored(x):
    renamed = symbols.rename_stored(x.unique().select(*BAR), x.renames)
    kept = renamed.rows.select("*", F.lit(None).cast("string").alias("old_symbol"))
    return kept.unionByName(renamed.losers)


@query
def symbol_range(x):
    return ranges.symbol_range(x.bars_raw, symbols.rename_symbols(x.bars_raw, x.renames))


@query
def symbol_range_merge(x):
    return ranges.merge_ranges(x.ranges(), x.new_ranges())


@query
def range_delta(x):
    return ranges.range_delta(x.new_ranges(), x.ranges())


@query
def range_anomalies(x):
    """The older bars delivered again, against the ranges of the later ones."""
    return ranges.range_anomalies(x.ranges(), x.new_ranges())


@query
def delta_gate(x):
    return ranges.delta_gate(x.ranges(), DELTA)


# ---- corporate actions -----------------------------------------------------------


def _cleaned(x):
    return actions.clean_multipliers(x.multipliers_raw, x.renames, x.ranges())


@query
def multipliers_kept(x):
    return _cleaned(x).kept


@query
def multipliers_skipped(x):
    return _cleaned(x).skipped


@query
def multipliers_append(x):
    raw = x.multipliers_raw
    stored = raw.where(F.col("dt") < STORED_UNTIL)
    delivered = raw.where(F.col("dt") >= DELIVERED_FROM).withColumn("multiplier", F.col("multiplier") * 8)
    return actions.append_multipliers(stored, delivered)


@query
def cum_multiplier(x):
    return x.cumulative()


@query
def adjust_prices(x):
    return x.adjusted()


@query
def adjust_prices_window(x):
    """The same adjustment by filling forward over bars and actions."""
    return actions.adjust_prices(x.bars_mod(), x.cumulative(), method="window")


@query
def adjust_prices_delta(x):
    return actions.adjust_prices(x.bars_mod(), x.cumulative(), DELTA)


@query
def replace_symbol_tail(x):
    stored = x.bars_mod()
    updates = actions.adjust_prices(stored.where(F.col("dt") >= DELTA), x.cumulative())
    return sink.replace_symbol_tail(stored, updates.where("adj_open is not null"))


# ---- membership ------------------------------------------------------------------


def _normalised(x):
    return membership.normalise_changes(
        x.index_feed, x.scrip_map, x.renames, membership.manual_map(x.manual_fix), {"5-LOW": "LOW"}
    )


@query
def normalise_changes(x):
    return _normalised(x)


@query
def unmapped_scrips(x):
    return membership.unmapped_scrips(x.index_feed, x.scrip_map)


@query
def index_snapshots(x):
    return membership.index_snapshots(x.index_changes, x.index_current)


@query
def change_history(x):
    return membership.change_history(x.snapshots(), INDEX)


@query
def change_dates(x):
    return membership.change_dates(x.snapshots(), INDEX)


@query
def snapshots_from(x):
    return membership.snapshots_from(x.snapshots(), 1998)


@query
def membership_flags(x):
    return membership.membership_flags(x.unique(), x.snapshots(), INDICES, 1996)


@query
def current_flags(x):
    return membership.current_flags(x.unique(), x.index_current, INDICES, DELTA)


@query
def check_change_dates(x):
    bars = x.unique()
    changes = _normalised(x)
    return membership.check_change_dates(changes, bars, ranges.symbol_range(bars, bars))


@query
def last_change(x):
    return membership.last_change(x.index_changes)


@query
def membership_recon(x):
    return membership.membership_recon(x.index_changes, x.index_current)


@query
def flags_recon_until(x):
    """The same up to a year, which ends the last interval of that year."""
    snapshots = x.snapshots()
    flags = membership.membership_flags(x.unique(), snapshots, INDICES, 1995)
    return membership.flags_recon(symbols.rename_symbols(flags, x.renames), snapshots, INDICES, end_year=1998)


@query
def flags_recon(x):
    """Flags stored under the new symbols against snapshots that still have the old ones."""
    snapshots = x.snapshots()
    flags = membership.membership_flags(x.unique(), snapshots, INDICES, 1995)
    return membership.flags_recon(symbols.rename_symbols(flags, x.renames), snapshots, INDICES)


# ---- exports ---------------------------------------------------------------------


@query
def export_raw(x):
    return exports.export_raw(x.bars_mod(), "1996-06-01")


@query
def export_adjusted(x):
    return exports.export_adjusted(x.adjusted(), "1996-06-01")


@query
def export_flags(x):
    flags = membership.membership_flags(x.unique(), x.snapshots(), INDICES, 1996)
    return exports.export_flags(flags, INDEX, "1996-06-01", CODES)


@query
def export_flags_delta(x):
    """The days after the last change, from which current membership holds."""
    changes = x.index_changes.select("index_name", "symbol", "dt")
    return exports.export_flags_delta(x.bars_mod(), changes, x.index_current, INDEX, AFTER_CHANGES, CODES)


# ---- history ---------------------------------------------------------------------

START, END, BUFFER = "1997-01-01", "2001-06-30", "1996-07-01"


@query
def buffer_flag(x):
    bars = fetch_bars(x.unique(), None, BUFFER, END)
    return bars.select(*KEY, history.buffer_flag("dt", START).alias("buffer"))


@query
def index_markers(x):
    return history.index_markers(x.snapshots(), INDEX)


@query
def index_flag(x):
    return history.index_flag(x.unique().select(*KEY), x.snapshots(), INDEX)


@query
def index_flag_exact(x):
    bars = fetch_bars(x.unique(), None, BUFFER, END).select(*KEY)
    return history.index_flag_exact(bars, x.snapshots(), INDEX, BUFFER)


@query
def split_history(x):
    return history.add_splits(x.unique().select(*KEY), x.multipliers_raw)


@query
def symbol_history(x):
    return history.symbol_history(
        x.adjusted(), START, END, None, BUFFER, INDEX, x.snapshots(), x.multipliers_raw
    )


@query
def index_history(x):
    # The actions are found once, for the prices and for the splits.
    multipliers = x.table("multipliers", x.multipliers_raw)
    bars = x.table("bars_mod", actions.adjust_prices(x.bars_mod(), actions.cum_multiplier(multipliers)))
    return history.index_history(bars, x.snapshots(), INDEX, START, END, BUFFER, multipliers)


@query
def history_by_symbol(x):
    """The history of all symbols saved by ranges of symbols, and some of them read back."""
    path = work_path(x.spark, "by-symbol")
    sink.save_by_symbol(history.symbol_history(x.adjusted(), START, END, None, BUFFER), path)
    return sink.load_by_symbol(x.spark, path, ["S1", "S7", "S50"])


@query
def slice_history(x):
    served = history.symbol_history(x.adjusted(), START, END, None, BUFFER)
    return history.slice_history(served, None, "1998-02-01", "2000-11-30")


# ---- reports ---------------------------------------------------------------------


@query
def symbol_counts(x):
    return reports.symbol_counts(x.bars_raw)


@query
def year_totals(x):
    return reports.year_totals(x.adjusted(), adjusted=True)


@query
def year_totals_diff(x):
    return reports.year_totals_diff(x.unique(), x.modified().rows)


@query
def year_counts(x):
    return reports.year_counts(x.unique())


@query
def distinct_symbols(x):
    return reports.distinct_symbols(symbols.rename_symbols(x.bars_raw, x.renames))


# ---- dates -----------------------------------------------------------------------


@query
def calendar(x):
    bounds = x.bars_raw.agg(F.min("dt").alias("start_dt"), F.max("dt").alias("end_dt"))
    return days.calendar(bounds, days.WEEKDAYS)


@query
def missing_dates(x):
    month_starts = x.index_changes.select("dt")
    return days.missing_dates(month_starts, "2001-12-31", days.WEEKDAYS)


@query
def date_functions(x):
    d = F.col("d")
    base = x.bars_raw.select("seq", "symbol", F.col("dt").alias("d"))
    as_text = F.date_format(d, "yyyy-MM-dd")
    compact = F.date_format(d, "yyyyMMdd")
    return base.select(
        "seq",
        "symbol",
        "d",
        D.ddmmyy(d).alias("ddmmyy"),
        D.ddmmyyyy(d).alias("ddmmyyyy"),
        D.ddMMMyyyy(d).alias("ddmmmyyyy"),
        D.yyyy(d).alias("yyyy"),
        D.mm_int(d).alias("mm_int"),
        D.MMM(d).alias("mmm"),
        D.weekday(d).alias("weekday"),
        D.dayofweek(d).alias("dayofweek"),
        D.relativedate(d, years=1, months=-3, days=10).alias("relativedate"),
        D.setdate(d, year=2001, day=31).alias("setdate"),
        D.datediff(d, F.lit("1996-02-29").cast("date")).alias("datediff"),
        D.todate(compact).alias("todate"),
        D.yyyy_mm_dd_to_yyyymmdd(as_text).alias("iso_to_compact"),
        D.yyyymmdd_to_yyyy_mm_dd(compact).alias("compact_to_iso"),
        D.mm_dd_yyyy_to_yyyy_mm_dd(F.date_format(d, "MM-dd-yyyy"), "/").alias("us_to_ymd"),
        D.ddmmyy_to_yyyy_mm_dd(F.concat(F.date_format(d, "ddMM"), F.lpad(F.dayofyear(d) % 100, 2, "0"))).alias(
            "pivoted"
        ),
        D.ddMMMyyyy_to_yyyy_mm_dd(D.ddMMMyyyy(d)).alias("from_ddmmmyyyy"),
        D.dd_MMM_yyyy_to_yyyy_mm_dd(F.date_format(d, "dd-MMM-yyyy")).alias("from_dd_mmm_yyyy"),
        D.ddmmyyyy_to_yyyy_mm_dd(D.ddmmyyyy(d)).alias("from_ddmmyyyy"),
        D.dd_mm_yyyy_to_yyyymmdd(F.date_format(d, "dd-MM-yyyy")).alias("from_dd_mm_yyyy"),
        D.mm(F.date_format(d, "MMMM")).alias("mm_full"),
        D.mm(F.concat(F.date_format(d, "MMM"), F.when(F.month(d) == 2, "x").otherwise(""))).alias("mm_short"),
        D.months(F.date_format(d, "MM")).alias("month_name"),
        D.months(F.month(d) + 2, "MMM").alias("month_later"),
    )


QUERIES["fetch_bars"] = QUERIES.pop("fetch_bars_range")
