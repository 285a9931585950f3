from conftest import bar, bars, plan, rows
from pyspark.sql import functions as F

from barloom.operators import dedupe, repair
from barloom.schemas import BAR


def scored(spark, data, from_date=None):
    split = dedupe.split_duplicates(bars(spark, data))
    return repair.score_skipped(split.unique, split.skipped, from_date)


def test_both_neighbours_and_int_truncation(spark):
    data = [
        bar("A", "2001-01-01", (10.9, 10.9, 10.9, 10.9), 100, 1),
        bar("A", "2001-01-02", (20.0, 20.0, 20.0, 20.0), 100, 2),
        bar("A", "2001-01-02", (12.7, 12.7, 12.7, 12.7), 100, 3),
        bar("A", "2001-01-03", (13.2, 13.2, 13.2, 13.2), 100, 4),
    ]
    [row] = scored(spark, data).collect()
    # mean of 10 and 13 is 11.5
    assert row.price_error == 4 * 0.25 and row.kept_price_error == 4 * 8.5**2
    assert (row.volume_error, row.kept_volume_error, row.neighbours) == (0.0, 0.0, 2)
    assert repair.replaceable(scored(spark, data)).count() == 1


def test_one_neighbour_counts_twice(spark):
    data = [
        bar("A", "2001-01-02", 50, 100, 1),
        bar("A", "2001-01-02", 10, 100, 2),
        bar("A", "2001-01-03", 11, 100, 3),
        bar("B", "2001-01-01", 11, 100, 4),
        bar("B", "2001-01-02", 50, 100, 5),
        bar("B", "2001-01-02", 10, 100, 6),
    ]
    got = scored(spark, data).collect()
    assert {(r.symbol, r.neighbours, r.price_error) for r in got} == {("A", 1, 4.0), ("B", 1, 4.0)}


def test_neighbours_stay_in_the_calendar_year(spark):
    data = [
        bar("A", "2000-12-31", 10, 100, 1),
        bar("A", "2001-06-01", 50, 100, 2),
        bar("A", "2001-06-01", 10, 100, 3),
        bar("A", "2002-01-01", 10, 100, 4),
    ]
    scores = scored(spark, data)
    assert rows(repair.unverified(scores), "seq", "kept_open") == [(3, 50.0)]
    assert repair.replaceable(scores).count() == 0


def test_worse_price_but_better_volume_replaces_and_equal_errors_do_not(spark):
    data = [
        bar("A", "2001-01-01", 10, 100, 1),
        bar("A", "2001-01-02", 10, 500, 2),
        bar("A", "2001-01-02", 90, 100, 3),
        bar("A", "2001-01-03", 10, 100, 4),
        bar("B", "2001-01-01", 10, 100, 5),
        bar("B", "2001-01-02", (10.1, 11.1, 9.1, 10.6), 100, 6),
        bar("B", "2001-01-02", (10.8, 11.8, 9.8, 10.9), 100, 7),
        bar("B", "2001-01-03", 10, 100, 8),
    ]
    assert rows(repair.replaceable(scored(spark, data)), "seq") == [(3,)]


def test_missing_numbers_count_as_zero(spark):
    nan = float("nan")
    data = [
        bar("A", "2001-01-01", (nan, 4.0, 4.0, 4.0), None, 1),
        bar("A", "2001-01-02", (9.0, 9.0, 9.0, 9.0), 9, 2),
        bar("A", "2001-01-02", (0.0, 4.0, 4.0, nan), 0, 3),
    ]
    [row] = scored(spark, data).collect()
    assert (row.price_error, row.volume_error) == (16.0, 0.0)


def test_identical_rejected_rows_are_one_and_first_ingested_is_picked(spark):
    data = [
        bar("A", "2001-01-01", 10, 100, 1),
        bar("A", "2001-01-02", 90, 100, 2),
        bar("A", "2001-01-02", 12, 100, 5),
        bar("A", "2001-01-02", 12, 100, 3),
        bar("A", "2001-01-02", 10, 100, 4),
    ]
    scores = scored(spark, data)
    assert rows(scores, "open", "seq") == [(10.0, 4), (12.0, 3)]
    assert rows(repair.pick_replacements(repair.replaceable(scores)), "open", "seq") == [(12.0, 3)]


def test_from_date_limits_the_rejected_rows(spark):
    data = [
        bar("A", "2001-01-02", 1, 1, 1),
        bar("A", "2001-01-02", 2, 1, 2),
        bar("A", "2001-01-03", 1, 1, 3),
        bar("A", "2001-01-03", 2, 1, 4),
    ]
    assert rows(scored(spark, data, "20010103"), "seq") == [(4,)]


def test_only_bars_with_rejected_rows_leave_the_window(spark):
    data = [bar("A", f"2001-01-0{d}", 10 * d, 100, d) for d in (1, 2, 3, 4)] + [bar("B", "2001-01-02", 5, 100, 9)]
    asked = bars(spark, [bar("A", "2001-01-03", 1, 1, 20), bar("A", "2001-01-03", 2, 1, 21), bar("C", "2001-01-03", 1, 1, 22), bar("A", None, 1, 1, 23)])
    found = repair.with_neighbours(bars(spark, data), asked)
    assert rows(found, "symbol", "dt", "prev.open", "next.open") == [("A", "2001-01-03", 20.0, 40.0)]


def _odd_raw(spark):
    data = [bar(f"S{i % 7}", f"200{i % 2}-0{1 + i % 5}-1{i % 3}", float(i * i % 37), i % 11, i) for i in range(300)]
    data += [bar("HOT", "2001-03-01", float(i), i % 5, 1000 + i) for i in range(60)]
    data += [bar("HOT", "2001-02-28", 7, 1, 2000), bar("HOT", "2001-03-02", 9, 1, 2001)]
    data += [bar(None, "2001-03-01", 1, 1, 3000), bar(None, "2001-03-01", 2, 1, 3001), bar("A", None, 1, 1, 3002)]
    return bars(spark, data)


def test_marking_by_year_and_symbol_scores_like_the_joins(spark, monkeypatch):
    raw = _odd_raw(spark)
    split = dedupe.split_duplicates(raw)
    expected = rows(repair.score_skipped(split.unique, split.skipped))
    copies = rows(dedupe.mark_copies(raw))
    assert repair.large_buckets(raw) == [None]
    for limit in (repair.LARGE_ROWS, 50):
        monkeypatch.setattr(repair, "LARGE_ROWS", limit)
        marked = repair.mark_beside(raw)
        assert rows(repair.score_beside(marked)) == expected
        assert rows(marked.drop("beside")) == copies
    assert len(repair.large_buckets(raw)) == 2


def test_bars_meet_their_neighbours_in_one_shuffle_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(repair, "large_buckets", lambda raw: [])
    raw = bars(spark, [bar("A", f"2001-01-0{d}", 10 * d, 100, d) for d in (1, 2, 2, 3)])
    shown = plan(repair.mark_beside(raw))
    assert shown.count("Exchange rangepartitioning") == 1 and "hashpartitioning" not in shown


def test_a_rejected_row_without_a_position_is_scored(spark):
    data = [bar("A", "2001-01-01", 10, 1, 1), bar("A", "2001-01-02", 50, 1, 2), (*bar("A", "2001-01-02", 11, 1), None)]
    marked = repair.mark_beside(bars(spark, data))
    assert rows(repair.score_beside(marked), "open", "seq", "kept_open") == [(11.0, None, 50.0)]


def test_arrivals_meet_stored_bars_as_in_an_append(spark, monkeypatch):
    raw = _odd_raw(spark).where("dt is not null")
    odd = [bar(None, "2001-03-01", 5, 1, -9), bar("HOT", "2001-02-27", 6, 1, -8), bar("HOT", "2001-03-01", 4, 1, -7)]
    old = [bar(f"S{i % 4}", f"200{i % 2}-0{1 + i % 5}-1{i % 3}", float(i), 3, -100 - i) for i in range(40, 70)]
    stored = dedupe.first_rows(bars(spark, odd + old))
    appended = dedupe.append_first(stored, raw)
    for from_day in ("2000-01-01", "2000-04-01"):
        late = F.col("dt") < from_day
        kept = stored.unionByName(appended.fresh.where(~late))
        expected = rows(repair.score_skipped(kept, appended.skipped, from_day))
        for limit in (repair.LARGE_ROWS, 50):
            monkeypatch.setattr(repair, "LARGE_ROWS", limit)
            marked = repair.mark_arrivals(stored, raw, from_day).cache()
            columns = [*BAR, "seq"]
            assert rows(marked.where("kind in ('lone', 'first')"), *columns) == rows(appended.fresh.where(~late), *columns)
            assert rows(marked.where("kind = 'late'"), *columns) == rows(appended.fresh.where(late), *columns)
            assert rows(marked.where("kind = 'later'"), *columns) == rows(appended.skipped, *columns)
            repeated = marked.where("kind in ('stored', 'first', 'later') or key_rows > 1")
            assert rows(repeated, *columns) == rows(appended.duplicates, *columns)
            assert rows(repair.score_beside(marked.where("kind = 'later'"), from_day)) == expected
    monkeypatch.setattr(repair, "large_buckets", lambda raw: [])
    shown = plan(repair.mark_arrivals(stored.coalesce(1), raw.coalesce(1), "2000-01-01"))
    assert shown.count("Exchange rangepartitioning") == 1
