import pytest
from conftest import bar, bars, day, rows
from pyspark.sql import functions as F

from barloom.operators import review
from barloom.plans import runs, serve
from barloom.plans.store import PriceStore
from barloom.schemas import BAR
from barloom.sinks import tables as sink
from barloom.sources import files
from test_files import write

HEADER = "pair,symbol,dt,open,high,low,close,volume"


def line(pair, symbol="A", dt="20010102", price=1, volume=5):
    return f"{pair},{symbol},{dt},{price},2,0.5,1.5,{volume}"


def matched(spark, folder, selected, skipped):
    write(folder, "selected.csv", HEADER, *selected)
    write(folder, "skipped.csv", HEADER, *skipped)
    return review.match_pairs(*[files.read_pairs(spark, f"{folder}/{n}.csv") for n in ("selected", "skipped")])


def test_pairs_meet_by_key_not_by_line(spark, folder):
    found = matched(
        spark,
        folder,
        [line("p3", dt="20010104"), line("p1"), line("p2", "B"), line("lone", "C"), line("p5", "D", "x"), line("q", "E"), line("q", "E")],
        [
            line("p1", price=9), line("p2", "X"), line("p3", dt="20010105"), line("p4"), line("p1b"), line("p5", "D"),
            line("q", "E"), line("", "F"), "bad,A,20010102,n/a,2,1,1,1", "short,A,20010102", line("p6", "G"), line("p6", "G", price=3),
        ],
    )
    assert rows(found.accepted, "symbol", "dt", "open") == [("A", "2001-01-02", 9.0)]
    assert rows(found.refused, "pair", "reason") == sorted(
        [
            ("p2", "another symbol"), ("p3", "another date"), ("p4", "no selected row"), ("p1b", "no selected row"),
            ("p5", "another date"), ("p5", "malformed line"), ("q", "pair listed again"), (None, "no pair key"),
            ("bad", "malformed line"), ("short", "malformed line"), ("p6", "pair listed again"), ("p6", "pair listed again"),
            ("lone", "no skipped row"),
        ], key=repr,
    )


def test_first_accepted_pair_of_a_bar_stays(spark, folder):
    found = matched(spark, folder, [line("a"), line("b")], [line("b", price=7), line("a", price=8)])
    assert rows(found.accepted, "open") == [(7.0,)]
    assert rows(found.refused, "open", "reason") == [(8.0, "bar replaced already")]
    nothing = matched(spark, f"{folder}/none", [], [])
    assert nothing.accepted.count() == nothing.refused.count() == 0


def test_a_load_takes_reviewed_pairs(spark, folder):
    renames = spark.createDataFrame([], "old string, new string")
    write(f"{folder}/f", "2001-01-02.txt", "A,20010102,1,1,1,1,1", "A,20010102,2,2,2,2,2", "A,20010102,3,3,3,3,3")
    write(f"{folder}/f", "2001-01-03.txt", "A,20010103,3,3,3,3,3")
    store = PriceStore(spark, f"{folder}/store")
    runs.full_load(store, f"{folder}/f", renames)
    assert rows(store.read("bars_mod"), "open") == [(2.0,), (3.0,)]
    selected, skipped = serve.replaceable_pairs(store)
    for name, side in (("selected", selected), ("skipped", skipped.where("open = 3"))):
        side.write.option("header", True).option("dateFormat", "yyyyMMdd").csv(f"{folder}/{name}")
    found = review.match_pairs(*[files.read_pairs(spark, f"{folder}/{n}") for n in ("selected", "skipped")])
    runs.full_load(store, f"{folder}/f", renames, reviewed=found)
    assert rows(store.read("bars_mod"), "open") == [(3.0,), (3.0,)]
    assert rows(store.read("replacements_refused"), "open", "reason") == [(1.0, "no skipped row")]


LINES = ["A,20010102,1,1,1,1,1", "A,20010103,x,1,1,1,1", "A,20010104,1,1", "A,20010105,1,1,1,1,1,1", "A,,1,1,1,1,1", "A,2001-1-6,1,1,1,1,1", "A,20010107,1,1,1,1,1e30"]


def test_malformed_lines_are_listed_whatever_is_asked_for(spark, folder):
    write(folder, "2001-01-02.txt", *LINES)
    whole = files.read_bar_lines(spark, folder)
    bad = [r.malformed for r in whole.where("malformed is not null").collect()]
    assert sorted(bad) == sorted([LINES[1], LINES[2], LINES[3], LINES[5], "A,2001-01-07,1.0,1.0,1.0,1.0,1.0E30"])
    good = files.read_bar_files(spark, folder)
    assert good.count() == 2 and rows(good, "symbol") == [("A",), ("A",)] and rows(good, "dt", "open") == [("2001-01-02", 1.0), (None, 1.0)]


def test_every_raw_line_is_in_one_table(spark, folder):
    renames = spark.createDataFrame([], "old string, new string")
    write(f"{folder}/f", "2001-01-02.txt", *LINES)
    store = PriceStore(spark, f"{folder}/store")
    runs.full_load(store, f"{folder}/f", renames)
    count = lambda: {t: store.read(t).count() for t in ("bars", "bars_skipped", "bars_undated", "bars_malformed")}
    assert count() == {"bars": 1, "bars_skipped": 0, "bars_undated": 1, "bars_malformed": 5}
    write(f"{folder}/f", "2001-01-08.txt", "A,20010108,1,1,1,1,1", "nonsense")
    runs.delta_run(store, f"{folder}/f", "20010108", renames)
    assert count() == {"bars": 2, "bars_skipped": 0, "bars_undated": 1, "bars_malformed": 6}
    # Loaded again from a year on: what that year's files list is not listed twice.
    runs.full_load(store, f"{folder}/f", renames, start_year=2001)
    assert count() == {"bars": 2, "bars_skipped": 0, "bars_undated": 1, "bars_malformed": 6}


class Lost(Exception):
    pass


def broken(monkeypatch, name):
    """The move deletes the stored rows and is lost before it writes."""
    whole = getattr(sink, name)

    def move(staged, path):
        if name == "move_table":
            staged.limit(0).write.mode("overwrite").parquet(path)
        else:
            for year in sink.years_of(staged):
                staged.limit(0).write.mode("overwrite").parquet(f"{path}/year={year}")
        raise Lost

    monkeypatch.setattr(sink, name, move)
    return lambda: monkeypatch.setattr(sink, name, whole)


def test_a_broken_replacement_of_a_table_is_found_again(spark, folder, monkeypatch):
    store = PriceStore(spark, f"{folder}/store")
    first = bars(spark, [bar("A", "2001-01-02", 1.0)], seq=False)
    first.write.parquet(store.path("t"))
    read = lambda: spark.read.schema(first.schema).parquet(store.path("t"))
    mended = broken(monkeypatch, "move_table")
    with pytest.raises(Lost):
        store.replace(read().withColumn("open", F.col("open") + 1), "t", "run")
    spark.catalog.refreshByPath(store.path("t"))
    assert read().count() == 0
    mended()
    store.replace(read().withColumn("open", F.col("open") + 1), "t", "run")
    spark.catalog.refreshByPath(store.path("t"))
    assert rows(read(), "open") == [(2.0,)]


def test_a_broken_adjustment_is_found_again(spark, folder, monkeypatch):
    renames = spark.createDataFrame([], "old string, new string")
    write(f"{folder}/f", "2001-01-02.txt", "A,20010102,1,1,1,1,1", "B,20020102,1,1,1,1,1")
    write(folder, "m.csv", "Symbol,Date,Multiplier", "A,20010102,2")
    store = PriceStore(spark, f"{folder}/store")
    runs.full_load(store, f"{folder}/f", renames)
    runs.load_multipliers(store, files.read_multipliers(spark, f"{folder}/m.csv"), renames)
    mended = broken(monkeypatch, "move_years")
    with pytest.raises(Lost):
        runs.update_adjusted(store)
    spark.catalog.refreshByPath(store.path("bars_mod"))
    assert rows(store.read("bars_mod"), "symbol") == [("B",)]
    mended()
    runs.update_adjusted(store)
    spark.catalog.refreshByPath(store.path("bars_mod"))
    assert rows(store.read("bars_mod"), "symbol", "adj_open") == [("A", 2.0), ("B", None)]
    assert not store.exists(store.path("_staged/update-adjusted"))


def test_a_broken_rename_is_found_again(spark, folder, monkeypatch):
    renames = spark.createDataFrame([], "old string, new string")
    write(f"{folder}/f", "2001-01-02.txt", "A,20010102,1,1,1,1,1", "B,20010102,2,1,1,1,1")
    store = PriceStore(spark, f"{folder}/store")
    runs.full_load(store, f"{folder}/f", renames)
    more = spark.createDataFrame([("A", "B")], "old string, new string")
    mended = broken(monkeypatch, "move_years")
    with pytest.raises(Lost):
        runs.rename_stored_symbols(store, more)
    mended()
    spark.catalog.refreshByPath(store.path("bars_mod"))
    collisions = runs.rename_stored_symbols(store, more)
    spark.catalog.refreshByPath(store.path("bars_mod"))
    assert rows(store.read("bars_mod"), "symbol", "open") == [("B", 2.0)]
    assert rows(collisions, "symbol", "old_symbol", "open") == [("B", "A", 1.0)]


@pytest.fixture
def eight_files(spark):
    names = {"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def holders(path, symbol):
    """Files whose statistics allow the symbol, of all files."""
    import glob

    import pyarrow.parquet as pq

    names = glob.glob(f"{path}/*.parquet")
    found = 0
    for name in names:
        meta = pq.ParquetFile(name).metadata
        at = meta.schema.names.index("symbol")
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        found += any(s.min <= symbol <= s.max for s in stats)
    return found, len(names)


def many(spark, symbols=40, days=100):
    start = day("2001-01-01").toordinal()
    data = [bar(f"S{s:02d}", str(day("2001-01-01").fromordinal(start + d)), 1.0) for s in range(symbols) for d in range(days)]
    return bars(spark, data, seq=False)


def test_a_symbol_is_in_few_files_of_a_split_year(spark, folder, eight_files):
    sink.write_bars_table(many(spark), f"{folder}/bars")
    found, files_of_year = holders(f"{folder}/bars/year=2001", "S07")
    assert files_of_year >= 6 and found <= 2


def test_history_by_symbol_reads_few_files(spark, folder, eight_files):
    served = many(spark).withColumnRenamed("dt", "date")
    sink.save_by_symbol(served, f"{folder}/h")
    one = sink.load_by_symbol(spark, f"{folder}/h", "S07")
    assert one.count() == 100 and len(one.inputFiles()) <= 2
    assert rows(sink.load_by_symbol(spark, f"{folder}/h", ["S07", "S30", "none"])) == rows(served.where("symbol in ('S07', 'S30')"))
    assert sink.load_by_symbol(spark, f"{folder}/h", "zzz").count() == 0
    assert BAR[0] in one.columns


def test_a_symbol_of_most_rows_is_split(spark, folder, eight_files):
    hot = many(spark, 2, 2000).withColumnRenamed("dt", "date")
    sink.save_by_symbol(hot, f"{folder}/h")
    assert len(sink.load_by_symbol(spark, f"{folder}/h", "S00").inputFiles()) >= 3


def test_reports_are_counted_while_written(spark, folder):
    renames = spark.createDataFrame([], "old string, new string")
    write(f"{folder}/f", "2001-01-02.txt", "A,20010102,1,1,1,1,1", "A,20010102,2,2,2,2,2", "A,20010103,1,1,1,1,1", "B,20020103,1,1,1,1,1")
    store = PriceStore(spark, f"{folder}/store")
    runs.full_load(store, f"{folder}/f", renames)
    written = serve.write_reports(store, f"{folder}/out")
    assert written["symbol_counts"] == 2 and written["symbol_range"] == 4 and written["unverified"] == 0
    assert written["flags_2001"] == 2 and written["flags_2002"] == 1 and written["range_anomalies"] == 0
    back = spark.read.option("header", True).csv(f"{folder}/out/flags")
    assert back.count() == 3 and len(back.columns) == 2 + 14 + 1


def test_lines_are_judged_once(spark, folder):
    write(folder, "selected.csv", HEADER, line("a"), line("b"))
    write(folder, "skipped.csv", HEADER, line("a", price=7), line("b", price=8))
    sides = [files.read_pairs(spark, f"{folder}/{n}.csv") for n in ("selected", "skipped")]
    labels = []
    found = review.match_pairs(*sides, stage=lambda df, label: labels.append(label) or df.cache())
    assert labels == ["judged", "accepted"]
    assert rows(found.accepted, "open") == [(7.0,)] and rows(found.refused, "open") == [(8.0,)]
