import pytest
from conftest import bar, bars, day, plan, rows
from pyspark.sql import functions as F

from barloom.operators import actions, ranges



def range_rows(spark, data):
    return spark.createDataFrame(
        [(s, t, day(a), day(b)) for s, t, a, b in data], "symbol string, source string, start_dt date, end_dt date"
    )


def test_range_delta_new_extended_and_anomalies(spark):
    stored = range_rows(
        spark,
        [
            ("A", "Dump", "2001-01-01", "2001-06-30"),
            ("B", "Dump", "2001-03-01", "2001-06-30"),
            ("C", "Dump", "2001-01-01", "2001-06-30"),
        ],
    )
    new = range_rows(
        spark,
        [
            ("A", "Dump", "2001-07-01", "2001-07-31"),
            ("B", "Dump", "2001-02-01", "2001-06-01"),
            ("N", "ModDump", "2001-07-01", "2001-07-02"),
        ],
    )
    assert rows(ranges.range_delta(new, stored)) == [
        ("A", "Dump", "2001-01-01", "2001-07-31", "extend"),
        ("B", "Dump", "2001-03-01", "2001-06-30", "keep"),
        ("C", "Dump", "2001-01-01", "2001-06-30", "keep"),
        ("N", "ModDump", "2001-07-01", "2001-07-02", "insert"),
    ]
    assert rows(ranges.range_anomalies(new, stored), "symbol", "starts_early", "ends_inside") == [("B", True, True)]


def test_merge_and_gate(spark):
    stored = range_rows(spark, [("A", "Dump", "2001-01-01", "2001-06-30")])
    new = range_rows(spark, [("A", "Dump", "2000-01-01", "2001-01-30")])
    assert rows(ranges.merge_ranges(stored, new)) == [("A", "Dump", "2000-01-01", "2001-06-30")]
    assert rows(ranges.merge_ranges(stored, new, merge_existing=False)) == rows(new)
    ranges.require_delta_after(stored, "20010701")
    with pytest.raises(ValueError):
        ranges.require_delta_after(stored, "20010630")
    with pytest.raises(ValueError):
        ranges.require_delta_after(stored.limit(0), "20010630")


def multiplier_rows(spark, data):
    return spark.createDataFrame(
        [(s, day(d), m, i) for i, (s, d, m) in enumerate(data)], "symbol string, dt date, multiplier double, seq int"
    )


def test_multipliers_before_first_bar_or_of_unknown_symbols_are_skipped(spark):
    raw = multiplier_rows(
        spark, [("OLD", "2000-12-31", 2.0), ("OLD", "2001-01-01", 3.0), ("Z", "2001-01-01", 4.0), ("R", "2001-01-01", 5.0)]
    )
    known = range_rows(
        spark,
        [
            ("NEW", "Dump", "2000-01-01", "2001-06-30"),
            ("NEW", "ModDump", "2001-01-01", "2001-06-30"),
            ("R", "Dump", "2000-01-01", "2001-06-30"),
        ],
    )
    renames = spark.createDataFrame([("OLD", "NEW")], "old string, new string")
    cleaned = actions.clean_multipliers(raw, renames, known)
    assert rows(cleaned.kept, "symbol", "multiplier") == [("NEW", 3.0), ("R", 5.0)]
    assert rows(cleaned.skipped, "symbol", "multiplier") == [("NEW", 2.0), ("Z", 4.0)]


def test_append_multipliers_keeps_stored(spark):
    stored = multiplier_rows(spark, [("A", "2001-01-01", 2.0)])
    raw = multiplier_rows(spark, [("A", "2001-01-01", 9.0), ("A", "2001-01-02", 3.0)])
    got = actions.append_multipliers(stored, raw)
    assert rows(got, "dt", "multiplier") == [("2001-01-01", 2.0), ("2001-01-02", 3.0)]


@pytest.mark.parametrize("method", ["interval", "window"])
def test_adjustment_on_action_dates_and_between_bars(spark, method):
    cumulative = actions.cum_multiplier(
        multiplier_rows(
            spark,
            [("A", "2001-01-05", 0.5), ("A", "2001-01-03", 2.0), ("A", "2001-01-06", 4.0), ("B", "2001-01-09", 2.0)],
        )
    )
    assert rows(cumulative.where("symbol = 'A'"), "dt", "cum_multiplier") == [
        ("2001-01-03", 2.0),
        ("2001-01-05", 1.0),
        ("2001-01-06", 4.0),
    ]
    days = ["2001-01-02", "2001-01-03", "2001-01-04", "2001-01-07"]
    data = bars(spark, [bar("A", d, 10) for d in days] + [bar("B", "2001-01-04", 10), bar("C", "2001-01-04", 10)], seq=False)
    adjusted = actions.adjust_prices(actions.without_adjustment(data), cumulative, method=method)
    assert rows(adjusted.where("symbol = 'A'"), "dt", "adj_open") == [
        ("2001-01-02", None),
        ("2001-01-03", 20.0),
        ("2001-01-04", 20.0),
        ("2001-01-07", 40.0),
    ]
    assert rows(adjusted.where("symbol <> 'A'"), "symbol", "adj_close") == [("B", None), ("C", None)]


def test_delta_adjustment_leaves_older_rows_but_uses_older_actions(spark):
    cumulative = actions.cum_multiplier(multiplier_rows(spark, [("A", "2000-01-05", 2.0)]))
    data = actions.without_adjustment(bars(spark, [bar("A", "2001-01-02", 10), bar("A", "2001-01-03", 10)], seq=False))
    stored = data.withColumn("adj_open", F.lit(1.0))
    adjusted = actions.adjust_prices(stored, cumulative, "20010103")
    assert rows(adjusted, "dt", "adj_open") == [("2001-01-02", 1.0), ("2001-01-03", 20.0)]


def test_as_of_does_not_depend_on_method_or_join(spark):
    events = spark.createDataFrame(
        [("A", None, 9.0), ("A", day("2001-01-03"), 2.0), ("A", day("2001-01-03"), 3.0), (None, day("2001-01-01"), 5.0)],
        "symbol string, dt date, cum_multiplier double",
    )
    data = bars(spark, [bar("A", d, 10) for d in ("2001-01-02", "2001-01-03", "2001-01-05", None)], seq=False)
    found = []
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for threshold in (before, "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for method in ("interval", "window"):
            joined = actions.as_of(data, events, "cum_multiplier", method=method)
            assert "CartesianProduct" not in plan(joined) and "NestedLoop" not in plan(joined)
            found.append(rows(joined, "dt", "cum_multiplier"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    expected = [("2001-01-02", None), ("2001-01-03", 3.0), ("2001-01-05", 3.0), (None, None)]
    assert all(f == sorted(expected, key=repr) for f in found[:1] + found[2:3])
    assert all(f[:3] == found[0][:3] for f in found)
