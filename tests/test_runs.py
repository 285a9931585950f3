import random
import time

import pytest
from conftest import bar, bars, day, rows
from pyspark.sql import functions as F

from barloom.plans import runs
from barloom.plans.store import PriceStore
from barloom.schemas import BAR
from barloom.sinks import exports
from barloom.streaming.ingest import ingest_batch, start_ingest
from barloom.sources.files import read_bar_lines
from test_files import write

BARS_MOD = [*BAR, "adj_open", "adj_high", "adj_low", "adj_close"]


def feed(spark, folder, seed=3):
    """Three months of bars over a year end, with repeated keys and some spoilt rows."""
    rng = random.Random(seed)
    data, seq = [], 0
    for n in range(60):
        date = str(day("2000-12-01").fromordinal(day("2000-12-01").toordinal() + n))
        for s in ("A", "B", "OLD"):
            for _ in range(2 if rng.random() < 0.3 else 1):
                seq += 1
                data.append(bar(s, date, 100.0 if rng.random() < 0.8 else rng.randint(1, 500), rng.randint(1, 999), seq))
    frame = bars(spark, data)
    exports.write_bar_files(frame, f"{folder}/files", F.col("dt"))
    return frame


def inputs(spark, folder):
    renames = spark.createDataFrame([("OLD", "NEW")], "old string, new string")
    write(folder, "multipliers.csv", "Symbol,Date,Multiplier", "A,20001215,0.5", "A,20010115,4", "OLD,20001220,2", "Z,20010101,3")
    from barloom.sources.files import read_multipliers

    return renames, read_multipliers(spark, f"{folder}/multipliers.csv")


def test_full_load_then_delta_equals_full_load(spark, folder):
    feed(spark, folder)
    renames, multipliers = inputs(spark, folder)
    whole = PriceStore(spark, f"{folder}/whole")
    runs.full_load(whole, f"{folder}/files", renames, multipliers)

    part = PriceStore(spark, f"{folder}/part")
    first = f"{folder}/files/file_day=2000-12-*"
    runs.full_load(part, [first], renames, multipliers)
    runs.delta_run(part, f"{folder}/files", "20010101", renames, multipliers)

    for table in ("bars", "bars_skipped", "bars_duplicates"):
        assert rows(part.read(table), *BAR) == rows(whole.read(table), *BAR), table
    # From the delta date on, the neighbours are the same, so the repairs are too.
    for table in ("bars_mod",):
        assert rows(part.read(table), *BARS_MOD) == rows(whole.read(table), *BARS_MOD), table
    assert rows(part.read("symbol_range")) == rows(whole.read("symbol_range"))
    assert rows(part.read("multipliers"), "symbol", "dt", "cum_multiplier") == [
        ("A", "2000-12-15", 0.5),
        ("A", "2001-01-15", 2.0),
        ("NEW", "2000-12-20", 2.0),
    ]
    assert rows(part.read("multipliers_skipped"), "symbol") == [("Z",)]

    with pytest.raises(ValueError):
        runs.delta_run(part, f"{folder}/files", "20010101", renames, multipliers)


def test_interrupted_delta_run_can_be_started_again(spark, folder, monkeypatch):
    feed(spark, folder)
    renames, multipliers = inputs(spark, folder)
    store = PriceStore(spark, f"{folder}/store")
    runs.full_load(store, [f"{folder}/files/file_day=2000-12-*"], renames, multipliers)

    fail = lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost"))
    original = runs.symbols.append_modified
    monkeypatch.setattr(runs.symbols, "append_modified", fail)
    with pytest.raises(RuntimeError):
        runs.delta_run(store, f"{folder}/files", "20010101", renames, multipliers)
    monkeypatch.setattr(runs.symbols, "append_modified", original)
    runs.delta_run(store, f"{folder}/files", "20010101", renames, multipliers)

    whole = PriceStore(spark, f"{folder}/whole")
    runs.full_load(whole, f"{folder}/files", renames, multipliers)
    for table in ("bars", "bars_skipped", "bars_duplicates"):
        assert rows(store.read(table), *BAR) == rows(whole.read(table), *BAR), table
    assert rows(store.read("bars_mod"), *BARS_MOD) == rows(whole.read("bars_mod"), *BARS_MOD)


@pytest.mark.parametrize("step", ["symbols.ranked_modified", "repair.score_beside"])
def test_a_load_drops_staged_copies_that_it_needs_no_more(spark, folder, monkeypatch, step):
    feed(spark, folder)
    renames, multipliers = inputs(spark, folder)
    store, whole = (PriceStore(spark, f"{folder}/{name}") for name in ("store", "whole"))
    module, name = step.split(".")
    held = []

    def lost(*a, **k):
        held.extend(label for label in ("raw", "marked", "scores") if store.is_staged(label, "full"))
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(getattr(runs, module), name, lost)
        with pytest.raises(RuntimeError):
            runs.full_load(store, f"{folder}/files", renames, multipliers)
    assert held == (["scores"] if name == "ranked_modified" else ["marked"])
    runs.full_load(store, f"{folder}/files", renames, multipliers)
    runs.full_load(whole, f"{folder}/files", renames, multipliers)
    for table in ("bars", "bars_skipped", "bars_duplicates", "bars_replace", "bars_unverified", "modified_losers"):
        assert rows(store.read(table), *BAR) == rows(whole.read(table), *BAR), table
    assert rows(store.read("bars_mod"), *BARS_MOD) == rows(whole.read("bars_mod"), *BARS_MOD)


def test_files_of_a_shuffle_go_with_its_query(spark, folder):
    """They would else stay until the driver collects its garbage, which a large run may never do."""
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = manager.getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    before = shuffled()
    spark.range(1000).repartition(5, "id").write.parquet(f"{folder}/rows")
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before


def test_new_actions_and_renames_on_stored_rows(spark, folder):
    feed(spark, folder)
    renames, multipliers = inputs(spark, folder)
    store = PriceStore(spark, f"{folder}/store")
    runs.full_load(store, f"{folder}/files", renames)
    assert store.read("bars_mod").where("adj_open is not null").count() == 0
    runs.load_multipliers(store, multipliers, renames, append=True)
    runs.update_adjusted(store, "20010110")
    spark.catalog.refreshByPath(store.path("bars_mod"))
    adjusted = store.read("bars_mod").where("adj_open is not null")
    assert rows(adjusted.groupBy("symbol").agg(F.min("dt"))) == [("A", "2001-01-10"), ("NEW", "2001-01-10")]
    total = store.read("bars_mod").count()

    more = spark.createDataFrame([("NEW", "A"), ("B", "BB")], "old string, new string")
    collisions = runs.rename_stored_symbols(store, more)
    spark.catalog.refreshByPath(store.path("bars_mod"))
    after = store.read("bars_mod")
    assert rows(after.select("symbol").distinct()) == [("A",), ("BB",)]
    assert collisions.count() == 60 and set(r.old_symbol for r in collisions.collect()) == {"NEW"}
    assert after.count() == total - 60
    known = rows(store.read("symbol_range").where("source = 'ModDump'"), "symbol")
    assert known == [("A",), ("B",), ("BB",), ("NEW",)]


def test_refresh_membership(spark, folder):
    write(folder, "feed.csv", "Index,Date,Symbol,ChangeType", "X,01-02-2001,Firm,Inclusion into Index", "X,01-03-2001,Other,Exclusion from Index")
    from barloom.sources import files

    store = PriceStore(spark, f"{folder}/store")
    none = spark.createDataFrame([], "old string, new string")
    # Scrips and fixes listed twice do not multiply the changes; the last scrip and the first fix count.
    write(folder, "scrips.csv", "Scrip,Symbol", "Firm,X", "Other,P", "Firm,F", "Other,Q")
    write(folder, "manual.csv", "Symbol,Date,CorrectSymbol", "Q,20010301,O", "Q,20010301,Z")
    write(folder, "current.csv", "Index,Symbol", "X,F")
    runs.refresh_membership(
        store,
        files.read_index_feed(spark, f"{folder}/feed.csv"),
        files.read_scrip_map(spark, f"{folder}/scrips.csv"),
        none,
        files.read_manual_fixes(spark, f"{folder}/manual.csv"),
        files.read_index_current(spark, f"{folder}/current.csv"),
    )
    assert store.read("index_changes").count() == 2
    assert rows(store.read("snapshots")) == [("X", "F", "2001-02-01"), ("X", "F", "2001-03-01"), ("X", "O", "2001-02-01")]


def test_stream_takes_each_file_once_and_sets_late_files_aside(spark, folder):
    landing = f"{folder}/landing"
    store = PriceStore(spark, f"{folder}/store")
    write(landing, "2001-01-02.txt", "A,20010102,1,1,1,1,1", "A,20010102,2,2,2,2,2")
    start_ingest(store, landing).awaitTermination()
    assert rows(store.read("bars"), "symbol", "open") == [("A", 1.0)]
    assert rows(store.read("bars_skipped"), "open") == [(2.0,)]
    assert rows(store.read("bars_mod"), "open") == [(1.0,)]

    write(landing, "2001-01-03.txt", "A,20010103,3,3,3,3,3", "A,20010102,4,4,4,4,4")
    write(landing, "2001-01-01.txt", "A,20010101,5,5,5,5,5")
    start_ingest(store, landing).awaitTermination()
    start_ingest(store, landing).awaitTermination()
    assert rows(store.read("bars"), "dt", "open") == [("2001-01-02", 1.0), ("2001-01-03", 3.0)]
    assert rows(store.read("bars_skipped"), "open") == [(2.0,), (4.0,)]
    assert rows(store.read("bars_late"), "open") == [(5.0,)]
    assert rows(store.read("bars_mod"), "dt", "open") == [("2001-01-02", 1.0), ("2001-01-03", 3.0)]
    assert rows(store.read("symbol_range")) == [
        ("A", "Dump", "2001-01-02", "2001-01-03"),
        ("A", "ModDump", "2001-01-02", "2001-01-03"),
    ]


def test_repeated_batch_changes_nothing(spark, folder):
    write(f"{folder}/f", "2001-01-02.txt", "A,20010102,1,1,1,1,1", "A,20010102,2,2,2,2,2")
    store = PriceStore(spark, f"{folder}/store")
    batch = read_bar_lines(spark, f"{folder}/f")
    for _ in range(2):
        ingest_batch(store, batch, "stream-0")
    assert rows(store.read("bars"), "open") == [(1.0,)]
    assert rows(store.read("bars_skipped"), "open") == [(2.0,)]
    assert rows(store.read("bars_mod"), "open") == [(1.0,)]


def test_serving_from_the_store(spark, folder):
    import os

    from barloom.plans import serve

    feed(spark, folder)
    renames, multipliers = inputs(spark, folder)
    store = PriceStore(spark, f"{folder}/store")
    runs.full_load(store, f"{folder}/files", renames, multipliers)
    snapshots = spark.createDataFrame(
        [("Nifty 50", "A", day("2000-12-10")), ("Nifty 50", "B", day("2001-01-10"))],
        "index_name string, symbol string, dt date",
    )
    snapshots.write.parquet(store.path("snapshots"))

    one = serve.symbol_history(store, "A", "20001210", "20010120", "20001201", "Nifty 50")
    by_flag = {f: n for f, n in rows(one.groupBy("idxflag").count())}
    assert by_flag == {1: 31, 0: 20}
    assert rows(one.where("split <> 0"), "date", "split") == [("2000-12-15", 0.5), ("2001-01-15", 4.0)]
    members = serve.index_history(store, "Nifty 50", "20001210", "20010109")
    assert rows(members.select("symbol").distinct()) == [("A",)]
    assert serve.split_history(store, "NEW").count() == 1
    changed, dates = serve.index_change_history(store, "Nifty 50")
    assert changed.count() == 2 and dates.count() == 2

    raw, mod, diff = serve.table_report(store)
    assert rows(raw, "year") == rows(mod, "year") == [(2000,), (2001,)]
    assert diff.where("metric = 'row_count'").count() == 0
    flags = serve.membership_flags(store)
    assert len(flags.columns) == 2 + 14
    assert serve.flags_recon(store, flags).count() == 0

    serve.export_prices(store, f"{folder}/out")
    serve.export_prices(store, f"{folder}/out_delta", "20010101", delta=True)
    serve.export_membership(store, f"{folder}/flags", "Nifty 50", "20001201")
    assert os.path.isdir(f"{folder}/out/adjusted/year=2000") and os.path.isdir(f"{folder}/out_delta/raw/20010101")
    back = spark.read.option("header", True).csv(f"{folder}/flags")
    assert set(back.where("symbol = 'A.N50'").select("Nifty 50").toPandas()["Nifty 50"]) == {"0", "1"}
    current = spark.createDataFrame([("Nifty 50", "B")], "index_name string, symbol string")
    serve.export_membership(store, f"{folder}/flags_delta", "Nifty 50", "20010110", current)
    with pytest.raises(ValueError):
        serve.export_membership(store, f"{folder}/flags_delta", "Nifty 50", "20010109", current)
    assert serve.last_stored_day(store) == day("2001-01-29")


TABLES = ("bars", "bars_skipped", "bars_late", "bars_undated")


def places(store):
    return sorted(((*x, t) for t in TABLES for x in rows(store.read(t), "dt", "open")), key=repr)


def test_stream_takes_a_backlog_in_any_order_of_files(spark, folder):
    import os
    import time

    landing = f"{folder}/landing"
    names = ["2001-01-04", "2001-01-02", "2001-01-03"]
    for n, name in enumerate(names):
        write(landing, f"{name}.txt", f"A,{name.replace('-', '')},{n},1,1,1,1", f"A,,{n},1,1,1,1", f"A,bad,{n},1,1,1,1")
        os.utime(f"{landing}/{name}.txt", (time.time() - 100 + n, time.time() - 100 + n))
    store = PriceStore(spark, f"{folder}/store")
    start_ingest(store, landing, max_files=1).awaitTermination()
    assert rows(store.read("bars"), "dt", "open") == [("2001-01-02", 1.0), ("2001-01-03", 2.0), ("2001-01-04", 0.0)]
    assert rows(store.read("bars_undated"), "open") == [(0.0,), (1.0,), (2.0,)]
    assert rows(store.read("bars_malformed"), "malformed") == [(f"A,bad,{n},1,1,1,1",) for n in range(3)]
    assert store.read("bars_late").count() == 0
    assert rows(store.read("bars_mod"), "dt") == rows(store.read("bars"), "dt")


def test_reload_sees_new_files_and_leaves_earlier_years(spark, folder):
    renames = spark.createDataFrame([], "old string, new string")
    files, store = f"{folder}/files", PriceStore(spark, f"{folder}/store")
    write(files, "2000-12-29.txt", "A,20001229,1,1,1,1,1", "A,20001229,2,2,2,2,2", "A,,3,3,3,3,3")
    write(files, "2001-01-02.txt", "A,20010102,4,4,4,4,4", "A,20001230,5,5,5,5,5", "A,20010102,6,6,6,6,6")
    runs.full_load(store, files, renames)
    assert rows(store.read("bars"), "open") == [(1.0,), (4.0,), (5.0,)]
    write(files, "2001-01-03.txt", "A,20010103,7,7,7,7,7")
    runs.full_load(store, files, renames)
    assert rows(store.read("bars"), "open") == [(1.0,), (4.0,), (5.0,), (7.0,)]
    write(files, "2001-01-02.txt", "A,20010102,8,8,8,8,8", "A,20001230,9,9,9,9,9")
    write(files, "2000-12-29.txt", "A,20001229,10,1,1,1,1")
    runs.full_load(store, files, renames, start_year=2001)
    assert rows(store.read("bars"), "open") == [(1.0,), (5.0,), (7.0,), (8.0,)]
    assert rows(store.read("bars_mod"), "dt") == rows(store.read("bars"), "dt")
    # Rejected rows of the year before stay, those of the loaded years are listed anew.
    assert rows(store.read("bars_skipped"), "open") == [(2.0,)]
    assert rows(store.read("bars_late"), "open") == [(9.0,)]
    assert rows(store.read("bars_undated"), "open") == [(3.0,)]
    assert rows(store.read("symbol_range"), "start_dt", "end_dt") == [("2000-12-29", "2001-01-03")] * 2
    assert not store.exists(store.path("_staged/full")) and not store.exists(store.path("_staged/full-2001"))


def test_delta_lists_what_it_does_not_add(spark, folder):
    renames = spark.createDataFrame([], "old string, new string")
    files, store = f"{folder}/files", PriceStore(spark, f"{folder}/store")
    write(files, "2001-01-02.txt", "A,20010102,1,1,1,1,1")
    runs.full_load(store, files, renames)
    write(files, "2001-01-03.txt", "A,20010103,2,2,2,2,2", "A,20010101,3,3,3,3,3", "B,,4,4,4,4,4", "A,20010103,5,5,5,5,5")
    runs.delta_run(store, files, "20010103", renames)
    write(files, "2001-01-04.txt", "A,20010104,6,6,6,6,6")
    runs.delta_run(store, files, "20010104", renames)
    assert places(store) == [
        ("2001-01-01", 3.0, "bars_late"),
        ("2001-01-02", 1.0, "bars"),
        ("2001-01-03", 2.0, "bars"),
        ("2001-01-03", 5.0, "bars_skipped"),
        ("2001-01-04", 6.0, "bars"),
        (None, 4.0, "bars_undated"),
    ]


def test_appended_actions_adjust_stored_rows(spark, folder):
    from barloom.sources.files import read_multipliers

    renames = spark.createDataFrame([], "old string, new string")
    files, store = f"{folder}/files", PriceStore(spark, f"{folder}/store")
    write(files, "2001-01-02.txt", "A,20010102,1,1,1,1,1")
    write(files, "2001-01-03.txt", "A,20010103,1,1,1,1,1")
    write(folder, "one.csv", "Symbol,Date,Multiplier", "A,20010102,2")
    runs.full_load(store, files, renames, read_multipliers(spark, f"{folder}/one.csv"))
    write(files, "2001-01-04.txt", "A,20010104,1,1,1,1,1")
    write(folder, "two.csv", "Symbol,Date,Multiplier", "A,20010103,4", "A,20010102,16")
    more = read_multipliers(spark, f"{folder}/two.csv")
    runs.delta_run(store, files, "20010104", renames, more, action_mode="append")
    assert rows(store.read("bars_mod"), "dt", "adj_open") == [("2001-01-02", 2.0), ("2001-01-03", 8.0), ("2001-01-04", 8.0)]


def test_no_rows_replace_a_batch(spark, folder):
    from barloom.sinks.tables import write_batch

    store = PriceStore(spark, f"{folder}/store")
    some = bars(spark, [bar("A", "2001-01-02", 1.0, seq=1)]).drop("seq")
    for batch in (some, some.limit(0)):
        write_batch(batch, store.path("modified_losers"), "x")
    write_batch(some, store.path("modified_losers"), "y")
    assert rows(store.read("modified_losers"), "batch") == [("y",)]


def test_a_step_is_tried_first_once_until_the_run_ends(spark, folder):
    store = PriceStore(spark, folder)
    assert [store.first_try("append", "x"), store.first_try("append", "x"), store.first_try("append", "y")] == [True, False, True]
    store.drop_staged("x")
    assert store.first_try("append", "x")


def test_a_later_batch_lists_no_bar_of_an_earlier_one_as_loser(spark, folder):
    store = PriceStore(spark, f"{folder}/store")
    write(f"{folder}/files", "2001-01-02.txt", "A,20010102,1,1,1,1,1", "A,20010103,2,2,2,2,1")
    write(f"{folder}/files", "2001-01-03.txt", "A,20010103,3,3,3,3,1", "A,20010104,4,4,4,4,1")
    start_ingest(store, f"{folder}/files", max_files=1).awaitTermination()
    assert store.read("bars").count() == store.read("bars_mod").count() == 3
    assert store.read("bars_skipped").count() == 1
    again = store.read("modified_losers").join(store.read("bars").select(*BAR), BAR, "left_semi")
    assert again.count() == 0


def test_new_rows_are_adjusted_by_year_like_by_intervals(spark):
    from barloom.operators import actions

    data = [bar(s, d, 10.0, 1, 1) for s in ("A", "B", None) for d in ("2000-12-31", "2001-01-01", "2001-06-01", "2002-03-01")]
    new = actions.without_adjustment(bars(spark, data, seq=True).drop("seq"))
    events = spark.createDataFrame(
        [("A", "1999-06-15", 2.0), ("A", "2001-06-01", 4.0), ("A", "2002-01-01", None), ("B", "2001-01-02", 3.0), (None, "2000-01-01", 8.0), ("A", None, 9.0)],
        "symbol string, d string, cum_multiplier double",
    ).select("symbol", F.to_date("d").alias("dt"), "cum_multiplier")
    got = actions.adjust_in_years(new, events, [2000, 2001, 2002], "2001-01-01")
    assert rows(got, *BARS_MOD) == rows(actions.adjust_prices(new, events, "2001-01-01"), *BARS_MOD)
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange rangepartitioning") == 1
