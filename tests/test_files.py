import os
import re

from conftest import bar, bars, day, rows
from pyspark.sql import functions as F

from barloom.operators import actions, dedupe, symbols
from barloom.sinks import exports
from barloom.sinks import tables as sink
from barloom.sources import files
from barloom.sources.tables import fetch_bars


def write(path, name, *lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="windows-1252") as f:
        f.write("\n".join(lines) + "\n")


def test_bar_files_are_chosen_by_name_and_keep_their_order(spark, folder):
    write(folder, "2000-12-29-X.txt", "A,20001229,1,2,0.5,1.5,100")
    write(folder, "2001-01-02-X.txt", "A,20010102,1,2,0.5,1.5,100", "A,20010102,9,9,9,9,900", "B,20010102,,2,0.5,1.5,")
    write(folder, "2001-01-03-X.txt", "A,20010102,7,7,7,7,700", "A,20010103,1,2,0.5,1.5,100.0")
    write(folder, "2001-01-03-X.csv", "Z,20010103,1,2,0.5,1.5,100")
    assert files.read_bar_files(spark, folder).count() == 6
    assert files.read_bar_files(spark, folder, start_year=2001).count() == 5
    delta = files.read_bar_files(spark, folder, start_date="20010103")
    assert rows(delta, "symbol", "dt", "volume", "file_day") == [
        ("A", "2001-01-02", 700, "2001-01-03"),
        ("A", "2001-01-03", 100, "2001-01-03"),
    ]
    kept = dedupe.first_rows(files.read_bar_files(spark, folder, start_year=2001))
    assert rows(kept, "symbol", "dt", "open") == [
        ("A", "2001-01-02", 1.0),
        ("A", "2001-01-03", 1.0),
        ("B", "2001-01-02", None),
    ]


def test_day_condition_skips_files_unread(spark, folder):
    for n in range(1, 6):
        write(folder, f"2001-01-0{n}.txt", f"A,2001010{n},1,2,0.5,1.5,100")
    delta = files.read_bar_files(spark, folder, start_date="2001-01-04")
    delta.write.format("noop").mode("overwrite").save()
    scan = delta._jdf.queryExecution().executedPlan().toString()
    assert "file_path" in scan or "_metadata" in scan
    assert delta.select(F.input_file_name().alias("f")).distinct().count() == 2


def test_bar_files_written_by_spark_read_back_in_order(spark, folder):
    data = bars(spark, [bar("A", f"2001-01-{1 + n % 5:02d}", n, n, seq=n) for n in range(200)])
    exports.write_bar_files(data, folder, F.col("dt"))
    back = files.read_bar_files(spark, folder)
    assert rows(back, "symbol", "dt", "open", "volume") == rows(data, "symbol", "dt", "open", "volume")
    assert rows(dedupe.first_rows(back), "open") == rows(dedupe.first_rows(data), "open")


def test_small_inputs(spark, folder):
    write(folder, "renames.csv", "Old,New", "A,B", "B,C", "A,D")
    renames = files.read_renames(spark, f"{folder}/renames.csv")
    assert rows(symbols.resolve_map(renames)) == [("A", "D"), ("B", "C")]
    write(folder, "multipliers.csv", "Symbol,Date,Multiplier", "A,20010102,0.5")
    assert rows(files.read_multipliers(spark, f"{folder}/multipliers.csv"), "symbol", "dt", "multiplier") == [
        ("A", "2001-01-02", 0.5)
    ]
    for n in (1, 2):
        write(folder, f"feed{n}.csv", "Index,Date,Symbol,ChangeType", f"X,0{n}-02-2001,Firm,Inclusion into Index")
    feed = files.read_index_feed(spark, [f"{folder}/feed1.csv", f"{folder}/feed2.csv"])
    assert rows(feed, "date_text") == [("01-02-2001",), ("02-02-2001",)]
    write(folder, "manual.csv", "Symbol,Date,CorrectSymbol", "Café – “Ltd”,20010102,CAFE")
    assert rows(files.read_manual_fixes(spark, f"{folder}/manual.csv"), "symbol", "dt") == [("Café – “Ltd”", "2001-01-02")]
    write(folder, "current.csv", "Index,Symbol", "X,A")
    assert rows(files.read_index_current(spark, f"{folder}/current.csv")) == [("X", "A")]
    write(folder, "scrips.csv", "Scrip,Symbol", "Firm,F")
    assert rows(files.read_scrip_map(spark, f"{folder}/scrips.csv"), "scrip", "symbol") == [("Firm", "F")]


def sample(spark):
    days = ["2000-12-29", "2001-01-02", "2001-06-01", "2002-01-02"]
    return bars(spark, [bar(s, d, n) for n, d in enumerate(days) for s in ("A", "B")], seq=False)


def test_fetch_prunes_year_folders(spark, folder):
    sink.write_bars_table(sample(spark), f"{folder}/bars")
    stored = spark.read.parquet(f"{folder}/bars")
    got = fetch_bars(stored, ["A"], "20010101", "20011231", ordered=True)
    assert [r.dt for r in got.collect()] == [day("2001-01-02"), day("2001-06-01")]
    text = got._jdf.queryExecution().executedPlan().toString()
    partition = text[text.index("PartitionFilters") :].split("]")[0]
    assert ">= 2001" in partition and "<= 2001" in partition
    pushed = text[text.index("PushedFilters") :].split("]")[0]
    assert "EqualTo(symbol,A)" in pushed and "GreaterThanOrEqual(dt" in pushed
    assert fetch_bars(stored, "B").count() == 4
    names = spark.createDataFrame([("B",), ("B",)], "symbol string")
    assert fetch_bars(stored, names).count() == 4


def test_overwrite_years_replaces_only_those_and_can_empty_one(spark, folder):
    path = f"{folder}/bars"
    sink.write_bars_table(sample(spark), path)
    stored = spark.read.parquet(path)
    changed = stored.where("year = 2001").drop("year").withColumn("open", F.lit(99.0))
    sink.overwrite_years(changed, path, [2001])
    spark.catalog.refreshByPath(path)
    after = spark.read.parquet(path)
    assert rows(after, "dt", "open") == [
        ("2000-12-29", 0.0), ("2000-12-29", 0.0), ("2001-01-02", 99.0), ("2001-01-02", 99.0),
        ("2001-06-01", 99.0), ("2001-06-01", 99.0), ("2002-01-02", 3.0), ("2002-01-02", 3.0),
    ]
    sink.overwrite_years(after.drop("year").limit(0), path, [2002])
    spark.catalog.refreshByPath(path)
    assert rows(spark.read.parquet(path).select("year").distinct()) == [(2000,), (2001,)]


def test_update_symbol_tail_in_place(spark, folder):
    path = f"{folder}/bars"
    sink.write_bars_table(sample(spark), path)
    updates = bars(spark, [bar("A", "2001-03-01", 50)], seq=False)
    sink.update_symbol_tail(path, updates)
    spark.catalog.refreshByPath(path)
    assert rows(spark.read.parquet(path).where("symbol = 'A'"), "dt", "open") == [
        ("2000-12-29", 0.0),
        ("2001-01-02", 1.0),
        ("2001-03-01", 50.0),
    ]
    assert spark.read.parquet(path).where("symbol = 'B'").count() == 4


def test_history_round_trips(spark, folder):
    served = sample(spark).withColumnRenamed("dt", "date")
    sink.save_history(served, f"{folder}/h")
    assert rows(sink.load_history(spark, f"{folder}/h")) == rows(served)
    sink.save_by_symbol(served, f"{folder}/s")
    assert rows(sink.load_by_symbol(spark, f"{folder}/s", "A")) == rows(served.where("symbol = 'A'"))


def test_exports(spark, folder):
    data = actions.without_adjustment(sample(spark)).withColumn(
        "adj_open", F.when(F.col("symbol") == "A", 5.0)
    )
    out = exports.export_adjusted(data, "20020101")
    # The open alone decides: A's other adjusted prices are empty and stay so.
    assert rows(out, "symbol", "open", "high") == [("A.A", 5.0, None), ("B.A", 3.0, 4.0)]
    exports.write_csv_by_year(exports.export_raw(data, "20010101"), f"{folder}/raw")
    back = spark.read.option("header", True).csv(f"{folder}/raw")
    assert sorted({r.dt for r in back.collect()}) == ["20010102", "20010601", "20020102"]
    exports.write_csv_delta(exports.export_raw(data, "20020101"), f"{folder}/delta", "20020101")
    assert os.path.isdir(f"{folder}/delta/20020101/year=2002")
    exports.write_report(out, f"{folder}/report")
    assert spark.read.option("header", True).csv(f"{folder}/report").count() == 2


def test_flag_exports_and_the_refusal(spark):
    data = actions.without_adjustment(sample(spark))
    current = spark.createDataFrame([("Nifty 50", "A")], "index_name string, symbol string")
    snapshots = spark.createDataFrame(
        [("Nifty 50", "A", day("2001-06-01"))], "index_name string, symbol string, dt date"
    )
    got = exports.export_flags_delta(data, snapshots, current, "Nifty 50", "20010601")
    assert rows(got, "symbol", "dt", "open", "close", "Nifty 50") == [
        ("A.N50", "2001-06-01", 0, 1, 1),
        ("A.N50", "2002-01-02", 0, 1, 1),
        ("B.N50", "2001-06-01", 0, 1, 0),
        ("B.N50", "2002-01-02", 0, 1, 0),
    ]
    assert exports.export_flags_delta(data, snapshots, current, "Nifty 50", "20010531").count() == 0
    exports.require_no_later_change(snapshots, "20010601")
    try:
        exports.require_no_later_change(snapshots, "20010531")
        raise AssertionError("not refused")
    except ValueError:
        pass


def test_a_path_without_a_day_is_searched_once():
    # Tries grow with the square of the path's length where the pattern may begin anywhere.
    assert files._DAY_IN_PATH.startswith("^")
    found = re.search(files._DAY_IN_PATH, "file:/in/2001-01-02/day=2001-01-03/part-0.txt")
    assert found.group(1) == "2001-01-03"
    assert re.search(files._DAY_IN_PATH, "file:/in/pairs/part-0.csv") is None
