import pytest
from conftest import bar, bars, day, rows
from pyspark.sql import functions as F

from barloom.operators import actions, days, history
from test_membership import snapshot_rows


def stored(spark):
    data = actions.without_adjustment(
        bars(
            spark,
            [bar("A", d, 10) for d in ("2001-01-02", "2001-01-03", "2001-01-04", "2001-01-05")]
            + [bar("B", "2001-01-03", 20), bar("C", "2001-01-03", 30)],
            seq=False,
        )
    )
    return data.withColumn("adj_open", F.when(F.col("dt") == "2001-01-04", 5.0))


def splits(spark):
    return spark.createDataFrame([("A", day("2001-01-04"), 0.5)], "symbol string, dt date, multiplier double")


def test_arguments_are_checked_before_planning():
    with pytest.raises(ValueError):
        history.check_dates("20010105", "20010104")
    with pytest.raises(ValueError):
        history.check_dates("20010103", "20010104", "20010104")
    assert history.check_dates("2001-01-03", "20010104", day("2001-01-01")) == day("2001-01-01")


def test_history_of_one_symbol(spark):
    snapshots = snapshot_rows(spark, [("X", "A", "2001-01-03"), ("X", "B", "2001-01-05")])
    got = history.symbol_history(
        stored(spark), "20010103", "20010105", "A", "20010102", "X", snapshots, splits(spark)
    )
    assert got.columns == [
        "symbol", "date", "open", "high", "low", "close", "volume",
        "adjopen", "adjhigh", "adjlow", "adjclose", "buffer", "idxflag", "split",
    ]
    assert rows(got, "date", "adjopen", "adjhigh", "buffer", "idxflag", "split") == [
        ("2001-01-02", 10.0, 11.0, True, 0, 0.0),
        ("2001-01-03", 10.0, 11.0, None, 1, 0.0),
        ("2001-01-04", 5.0, 11.0, None, 1, 0.5),
        ("2001-01-05", 10.0, 11.0, None, 0, 0.0),
    ]


def test_optional_columns_are_left_out(spark):
    got = history.symbol_history(stored(spark), "20010103", "20010105", ["A", "B"], "20010103")
    assert not {"buffer", "idxflag", "split"} & set(got.columns)
    assert got.count() == 4


def test_exact_mode_loses_markers_on_days_without_bars(spark):
    # A enters on a day without a bar and leaves on a bar day.
    snapshots = snapshot_rows(spark, [("X", "A", "2001-01-01"), ("X", "B", "2001-01-05")])
    flags = lambda mode, start: rows(
        history.symbol_history(stored(spark), start, "20010105", "A", None, "X", snapshots, flag_mode=mode),
        "date",
        "idxflag",
    )
    assert [f for _, f in flags("asof", "20010101")] == [1, 1, 1, 0]
    assert [f for _, f in flags("exact", "20010101")] == [0, 0, 0, 0]
    # Fetched from a later day, the marker before it seeds the gap.
    assert [f for _, f in flags("exact", "20010102")] == [1, 1, 1, 0]


def test_markers_show_entry_and_first_absence(spark):
    snapshots = snapshot_rows(
        spark,
        [("X", "A", "2001-01-01"), ("X", "B", "2001-02-01"), ("X", "B", "2001-03-01"), ("X", "A", "2001-04-01")],
    )
    assert rows(history.index_markers(snapshots, "X")) == [
        ("A", "2001-01-01", 1),
        ("A", "2001-02-01", 0),
        ("A", "2001-04-01", 1),
        ("B", "2001-02-01", 1),
        ("B", "2001-03-01", 1),
        ("B", "2001-04-01", 0),
    ]


def test_index_history_keeps_all_days_of_members(spark):
    snapshots = snapshot_rows(spark, [("X", "A", "2001-01-05"), ("X", "B", "2001-01-06")])
    got = history.index_history(stored(spark), snapshots, "X", "20010103", "20010105", "20010102")
    assert rows(got, "symbol", "idxflag") == [("A", 0), ("A", 0), ("A", 0), ("A", 1)]


def test_index_history_reads_the_bars_once(spark, folder):
    stored(spark).write.parquet(f"{folder}/bars")
    snapshots = snapshot_rows(spark, [("X", "A", "2001-01-05"), ("X", "B", "2001-01-06")])
    for mode in ("asof", "exact"):
        got = history.index_history(
            spark.read.parquet(f"{folder}/bars"), snapshots, "X", "20010103", "20010105", "20010102", flag_mode=mode
        )
        assert rows(got, "symbol", "idxflag") == [("A", 0), ("A", 0), ("A", 0), ("A", 1)]
        assert got._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1


def test_slice(spark):
    served = history.symbol_history(stored(spark), "20010102", "20010105")
    assert rows(history.slice_history(served, "A", "2001-01-03"), "date") == [("2001-01-03",)]
    assert history.slice_history(served, ["A", "B"], "2001-01-03", "2001-01-04").count() == 3
    assert history.slice_history(served, ["A"], None, "2001-01-03").count() == 4
    assert history.slice_history(served, None, "2001-01-03").count() == 3
    with pytest.raises(ValueError):
        history.slice_history(served)
    with pytest.raises(KeyError):
        history.slice_history(served, ["A", "NOBODY"], strict=True)


def test_calendar_and_missing_days(spark):
    present = spark.createDataFrame([(day("2001-01-04"),), (day("2001-01-08"),)], "dt date")
    got = days.missing_dates(present, "20010110", days.WEEKDAYS)
    assert rows(got) == [("2001-01-05",), ("2001-01-09",), ("2001-01-10",)]
    assert rows(days.missing_dates(present, "20010108", days.WEEKENDS)) == [("2001-01-06",), ("2001-01-07",)]
