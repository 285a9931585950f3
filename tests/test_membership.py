import random

from conftest import bar, bars, day, plan, rows
from pyspark.sql import functions as F

from barloom.operators import membership


def change_rows(spark, data):
    return spark.createDataFrame(
        [(i, s, day(d), k, n) for n, (i, s, d, k) in enumerate(data)],
        "index_name string, symbol string, dt date, change_type string, seq int",
    )


def current_rows(spark, data):
    return spark.createDataFrame(data, "index_name string, symbol string")


def snapshot_rows(spark, data):
    return spark.createDataFrame([(i, s, day(d)) for i, s, d in data], "index_name string, symbol string, dt date")


def walk_back(changes, current):
    """Sets carried from the newest change date to the oldest."""
    out = []
    for index in {i for i, _ in current}:
        of_index = [c for c in changes if c[0] == index]
        members, newest = None, True
        for date in sorted({c[2] for c in of_index}, reverse=True):
            ins = {c[1] for c in of_index if c[2] == date and c[3] == "I"}
            outs = {c[1] for c in of_index if c[2] == date and c[3] == "E"}
            if newest:
                shown, newest = {s for i, s in current if i == index}, False
            else:
                shown = (members | ins) - outs
            out += [(index, s, date) for s in shown]
            members = (shown | outs) - ins
    return sorted(out)


def test_snapshots_equal_walking_back_in_random_histories(spark):
    rng = random.Random(11)
    dates = [f"2001-{m:02d}-01" for m in range(1, 8)]
    changes, current = [], []
    # Many independent small histories at once, one index each.
    for n in range(150):
        index = f"I{n}"
        symbols = [f"S{i}" for i in range(5)]
        changes += [
            (index, rng.choice(symbols), rng.choice(dates), rng.choice("IE")) for _ in range(rng.randint(0, 9))
        ]
        current += [(index, s) for s in symbols if rng.random() < 0.5]
    got = membership.index_snapshots(change_rows(spark, changes), current_rows(spark, current))
    assert rows(got) == walk_back(changes, current)


def test_special_cases_of_snapshots(spark):
    changes = [
        ("X", "BOTH", "2001-01-01", "I"),
        ("X", "BOTH", "2001-01-01", "E"),
        ("X", "GONE", "2001-02-01", "I"),  # newest date contradicts the current list
        ("ABSENT", "A", "2001-01-01", "I"),  # index without current components
    ]
    current = [("X", "KEPT"), ("X", "KEPT"), ("QUIET", "Q")]
    got = membership.index_snapshots(change_rows(spark, changes), current_rows(spark, current))
    # The newest date takes the current list as given, repeats included.
    assert rows(got) == [
        ("X", "KEPT", "2001-01-01"),
        ("X", "KEPT", "2001-02-01"),
        ("X", "KEPT", "2001-02-01"),
    ]


def test_intervals_merge_consecutive_snapshots(spark):
    snapshots = snapshot_rows(
        spark,
        [
            ("X", "A", "2001-01-01"),
            ("X", "A", "2001-02-01"),
            ("X", "B", "2001-03-01"),
            ("X", "A", "2001-04-01"),
            ("X", "A", "2001-04-01"),
        ],
    )
    assert rows(membership.membership_intervals(snapshots), "symbol", "from_dt", "to_dt") == [
        ("A", "2001-01-01", "2001-03-01"),
        ("A", "2001-04-01", None),
        ("B", "2001-03-01", "2001-04-01"),
    ]


def test_flags_follow_the_latest_snapshot_also_in_years_without_changes(spark):
    snapshots = snapshot_rows(spark, [("X", "A", "2001-01-06"), ("X", "B", "2004-01-03")])
    data = bars(
        spark,
        [bar("A", d, 1) for d in ("2001-01-05", "2001-01-08", "2002-06-03", "2004-01-02", "2004-01-05")]
        + [bar("B", "2004-01-05", 1), bar("C", "2004-01-05", 1)],
        seq=False,
    )
    flags = membership.membership_flags(data, snapshots, ["X", "NONE"], 2002)
    assert rows(flags) == [
        ("A", "2002-06-03", 1, 0),
        ("A", "2004-01-02", 1, 0),
        ("A", "2004-01-05", 0, 0),
        ("B", "2004-01-05", 1, 0),
        ("C", "2004-01-05", 0, 0),
    ]
    assert rows(membership.membership_flags(data, snapshots, ["X"], 2001))[0] == ("A", "2001-01-05", 0)


def test_flags_do_not_group_or_multiply_bars(spark):
    snapshots = snapshot_rows(spark, [("X", "A", "2001-01-06")])
    data = bars(spark, [bar("A", "2001-01-05", 1)], seq=False)
    text = plan(membership.membership_flags(data, snapshots, ["X"], 2001))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_snapshots_from_takes_last_before_else_first_after(spark):
    snapshots = snapshot_rows(
        spark,
        [("X", "A", "1999-01-01"), ("X", "B", "2000-05-01"), ("X", "C", "2001-05-01"), ("Y", "D", "2002-01-01"), ("Y", "E", "2003-01-01")],
    )
    assert rows(membership.snapshots_from(snapshots, 2001), "symbol") == [("B",), ("C",), ("D",), ("E",)]
    assert rows(membership.snapshots_from(snapshots, 2001, ["Y"]), "symbol") == [("D",), ("E",)]


def test_feed_is_normalised_step_by_step(spark):
    feed = spark.createDataFrame(
        [
            ("Nifty Free Float Midcap 100", "03-02-2001", "Alpha Ltd", "Inclusion into Index", 1),
            ("X", "2001-02-03 00:00:00", "Beta Ltd", "Exclusion from Index", 2),
            ("X", "03/02/2001", "Gamma Ltd", "E", 3),
        ],
        "index_name string, date_text string, scrip string, change_text string, seq int",
    )
    scrips = spark.createDataFrame([("Alpha Ltd", "ALPHA"), ("Beta Ltd", "BETA")], "scrip string, symbol string")
    renames = spark.createDataFrame([("ALPHA", "ALPHANEW")], "old string, new string")
    manual = spark.createDataFrame(
        [("Gamma Ltd", day("2001-02-03"), "GAMMA", 1), ("Gamma Ltd", day("2001-02-04"), "OTHER", 2)],
        "symbol string, dt date, correct_symbol string, pos int",
    )
    got = membership.normalise_changes(feed, scrips, renames, membership.manual_map(manual))
    assert rows(got, "index_name", "symbol", "dt", "change_type") == [
        ("NIFTY Midcap 100", "ALPHANEW", "2001-02-03", "I"),
        ("X", "BETA", "2001-02-03", "E"),
        ("X", "GAMMA", "2001-02-03", "E"),
    ]
    assert rows(membership.unmapped_scrips(feed, scrips)) == [("Gamma Ltd",)]


def test_manual_map_takes_the_first_correct_symbol_for_every_date(spark):
    manual = spark.createDataFrame(
        [("A", day("2001-01-01"), "B", 1), ("A", day("2001-01-02"), "C", 2)],
        "symbol string, dt date, correct_symbol string, pos int",
    )
    assert rows(membership.manual_map(manual), "dt", "new", "pos") == [("2001-01-01", "B", 1), ("2001-01-02", "B", 1)]


def test_change_date_report(spark):
    data = bars(spark, [bar("A", "2001-01-02", 1), bar("A", "2001-01-10", 1)], seq=False)
    stored = spark.createDataFrame(
        [("A", "ModDump", day("2001-01-02"), day("2001-01-10")), ("U", "Dump", day("2001-01-02"), day("2001-01-10"))],
        "symbol string, source string, start_dt date, end_dt date",
    )
    changes = change_rows(
        spark,
        [
            ("X", "A", "2001-01-02", "I"),  # bar on the date
            ("X", "A", "2001-01-05", "I"),  # inside the range
            ("X", "A", "2000-12-31", "I"),
            ("X", "A", "2001-01-13", "E"),
            ("X", "U", "2001-01-05", "E"),  # only a raw range
        ],
    )
    report = membership.check_change_dates(changes, data, stored)
    got = rows(report, "symbol", "search_dt", "found", "diff_before", "diff_after")
    assert got[:2] == [
        ("A", "2000-12-31", "Found out of Range", 2, 0),
        ("A", "2001-01-13", "Found out of Range", 0, 3),
    ]
    assert got[2][:3] == ("U", "2001-01-05", "Not Found") and got[2][3] > 2_900_000 and got[2][4] == 0


def test_last_change_and_recon(spark):
    changes = change_rows(
        spark,
        [
            ("X", "A", "2001-01-01", "I"),
            ("X", "B", "2001-01-01", "I"),
            ("X", "B", "2001-02-01", "E"),
            ("X", "C", "2001-02-01", "E"),
            ("X", "C", "2001-02-01", "I"),
        ],
    )
    assert rows(membership.last_change(changes), "symbol", "change_type") == [("A", "I"), ("B", "E"), ("C", "I")]
    current = current_rows(spark, [("X", "C"), ("X", "D"), ("UNSEEN", "E")])
    assert rows(membership.membership_recon(changes, current)) == [
        ("X", "A", "last include not current"),
        ("X", "D", "current not last include"),
    ]


def test_flags_recon_checks_every_interval_and_year(spark):
    snapshots = snapshot_rows(spark, [("X", "A", "2000-06-01"), ("X", "B", "2001-06-01")])
    data = [
        ("A", "2000-05-01", 1),  # before the first snapshot
        ("A", "2000-07-03", 1),
        ("B", "2001-03-01", 1),  # flagged too early; A has no bar in this part
        ("B", "2001-07-02", 1),
        ("B", "2002-01-02", 0),  # last interval runs on to 2002, unflagged there
    ]
    flags = spark.createDataFrame([(s, day(d), f) for s, d, f in data], "symbol string, dt date, X int")
    assert rows(membership.flags_recon(flags, snapshots, ["X"])) == [
        ("X", "1900-01-01", 2000, "A", "flags only"),
        ("X", "2000-06-01", 2001, "A", "snapshot only"),
        ("X", "2000-06-01", 2001, "B", "flags only"),
        ("X", "2001-06-01", 2002, "B", "snapshot only"),
    ]


def test_current_flags(spark):
    data = bars(spark, [bar("A", "2001-01-01", 1), bar("A", "2001-01-02", 1), bar("B", "2001-01-02", 1)], seq=False)
    flags = membership.current_flags(data, current_rows(spark, [("X", "A"), ("Y", "B")]), ["X", "Y"], "20010102")
    assert rows(flags) == [("A", "2001-01-02", 1, 0), ("B", "2001-01-02", 0, 1)]
    assert flags.select(F.sum("X")).first()[0] == 1
