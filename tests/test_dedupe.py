from conftest import bar, bars, plan, rows
from pyspark.sql import functions as F

from barloom.operators import dedupe


def sample(spark):
    return bars(
        spark,
        [
            bar("A", "2001-01-02", 10, seq=3),
            bar("A", "2001-01-02", 11, seq=1),
            bar("A", "2001-01-02", 12, seq=2),
            bar("A", "2001-01-03", 13, seq=4),
            bar("B", "2001-01-02", 14, seq=5),
            bar(None, "2001-01-02", 15, seq=6),
            bar(None, "2001-01-02", 16, seq=7),
        ],
    )


def test_key_three_times_gives_one_unique_three_duplicates_two_skipped(spark):
    split = dedupe.split_duplicates(sample(spark))
    of_key = lambda df: rows(df.where("symbol = 'A' and dt = '2001-01-02'"), "seq")
    assert of_key(split.unique) == [(1,)]
    assert of_key(split.duplicates) == [(1,), (2,), (3,)]
    assert of_key(split.skipped) == [(2,), (3,)]


def test_null_keys_form_a_group(spark):
    split = dedupe.split_duplicates(sample(spark))
    assert rows(split.skipped.where("symbol is null"), "seq") == [(7,)]


def test_unique_and_skipped_make_up_the_input(spark):
    data = sample(spark)
    split = dedupe.split_duplicates(data)
    assert rows(split.unique.unionByName(split.skipped)) == rows(data)
    assert rows(dedupe.first_rows(data)) == rows(split.unique)
    assert rows(dedupe.later_rows(data)) == rows(split.skipped)


def test_file_year_can_be_part_of_the_key(spark):
    data = bars(spark, [bar("A", "2001-01-02", 10, seq=1), bar("A", "2001-01-02", 11, seq=2)])
    data = data.withColumn("file_year", F.col("seq") + 2000)
    assert dedupe.first_rows(data, ["file_year", "symbol", "dt"]).count() == 2


def test_append_keeps_stored_rows(spark):
    stored = bars(spark, [bar("A", "2001-01-02", 1, seq=100)])
    delta = bars(
        spark,
        [
            bar("A", "2001-01-02", 2, seq=1),
            bar("A", "2001-01-03", 3, seq=2),
            bar("A", "2001-01-03", 4, seq=3),
            bar("A", "2001-01-04", 5, seq=4),
        ],
    )
    result = dedupe.append_first(stored, delta)
    assert rows(result.rows, "dt", "open") == [("2001-01-02", 1.0), ("2001-01-03", 3.0), ("2001-01-04", 5.0)]
    assert rows(result.fresh, "seq") == [(2,), (4,)]
    assert rows(result.skipped, "seq") == [(1,), (3,)]
    assert rows(result.duplicates, "open") == [(1.0,), (2.0,), (3.0,), (4.0,)]


def test_duplicates_not_skipped_keeps_rows_with_nulls(spark):
    data = bars(
        spark,
        [
            bar("A", "2001-01-02", 10, seq=1),
            bar("A", "2001-01-02", 10, seq=2),
            bar("B", "2001-01-02", 10, None, seq=3),
            bar("B", "2001-01-02", 10, None, seq=4),
            bar("C", "2001-01-02", 10, seq=5),
            bar("C", "2001-01-02", 11, seq=6),
        ],
    )
    split = dedupe.split_duplicates(data)
    left = dedupe.duplicates_not_skipped(split.duplicates, split.skipped)
    assert rows(left, "seq") == [(3,), (4,), (5,)]


def test_first_rows_are_limited_before_the_shuffle(spark):
    text = plan(dedupe.first_rows(sample(spark)))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_few_repeated_keys_shuffle_no_rows(spark, folder):
    """Staged keys are broadcast by their size, and the rows meet them where they are."""
    sample(spark).write.parquet(f"{folder}/rows")
    data = spark.read.parquet(f"{folder}/rows")
    dedupe.repeated_keys(data).write.parquet(f"{folder}/repeated")
    repeated = spark.read.parquet(f"{folder}/repeated")
    for copies in (dedupe.later_rows, dedupe.duplicate_rows, dedupe.mark_copies):
        found = copies(data, repeated=repeated)
        assert rows(found) == rows(copies(data))
        text = plan(found)
        assert "Exchange hashpartitioning" not in text and "BroadcastHashJoin" in text


def test_key_counts_are_ordered(spark):
    counts = dedupe.key_counts(dedupe.duplicate_rows(sample(spark))).collect()
    assert [(r.symbol, r.row_count) for r in counts] == [("A", 3), (None, 2)]


def test_an_append_works_out_shared_rows_once(spark):
    stored = bars(spark, [bar("A", "2001-01-01", 1, 1, 1), bar(None, "2001-01-01", 1, 1, 2), bar("D", "2001-01-01", 1, 1, 3)])
    delta = bars(spark, [bar("A", "2001-01-01", 2, 1, 11), bar(None, "2001-01-01", 2, 1, 12), bar("B", None, 3, 1, 13), bar("B", None, 4, 1, 14), bar("C", "2001-01-02", 5, 1, 15)])
    labels = []
    got = dedupe.append_first(stored, delta, stage=lambda df, label: labels.append(label) or df.cache())
    assert labels == ["stored-again", "arrivals"]
    assert rows(got.fresh, "seq") == [(13,), (15,)]
    assert rows(got.skipped, "seq") == [(11,), (12,), (14,)]
    assert rows(got.duplicates, "seq") == [(1,), (11,), (12,), (13,), (14,), (2,)]
    assert got.rows.count() == 5
