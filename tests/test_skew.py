"""A key with a third of all rows: joins split it, windows never see it whole."""

import pytest
from pyspark.sql import functions as F

from barloom.operators import dedupe, repair, symbols

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def small_partitions(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def hot_bars(spark, n=30000):
    hot = F.col("id") % 3 == 0
    price = (F.xxhash64("id") % 1000).cast("double")
    return spark.range(0, n, 1, 8).select(
        F.when(hot, "HOT").otherwise(F.concat(F.lit("S"), F.col("id") % 500)).alias("symbol"),
        F.when(hot, F.lit("2001-03-01").cast("date"))
        .otherwise(F.date_add(F.lit("2001-01-01").cast("date"), (F.col("id") % 300).cast("int")))
        .alias("dt"),
        *[(price + n).alias(c) for n, c in enumerate(["open", "high", "low", "close"])],
        F.col("id").alias("volume"),
        F.col("id").alias("seq"),
    )


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_scores_of_a_hot_key_are_split(small_partitions):
    split = dedupe.split_duplicates(hot_bars(small_partitions))
    scores, shown = final_plan(repair.score_skipped(split.unique, split.skipped))
    assert "skew=true" in shown
    assert sum(r.symbol == "HOT" for r in scores) == 9999


def test_rows_of_a_hot_key_are_split(small_partitions):
    for copies, expected in ((dedupe.later_rows, 9999), (dedupe.duplicate_rows, 10000)):
        found, shown = final_plan(copies(hot_bars(small_partitions)))
        assert "skew=true" in shown
        assert sum(r.symbol == "HOT" for r in found) == expected


def test_rename_of_a_hot_symbol_is_split(small_partitions):
    spark = small_partitions
    renames = spark.range(500).select(
        F.concat(F.lit("S"), "id").alias("old"), F.concat(F.lit("T"), "id").alias("new")
    ).union(spark.sql("select 'HOT', 'COLD'"))
    renamed, shown = final_plan(symbols.rename_symbols(hot_bars(spark), renames))
    assert "skew=true" in shown
    assert sum(r.symbol == "COLD" for r in renamed) == 10000 and len(renamed) == 30000


def test_replacements_of_a_hot_key_match_a_plain_restatement(small_partitions):
    data = hot_bars(small_partitions, 3000)
    split = dedupe.split_duplicates(data)
    picked = repair.pick_replacements(
        repair.replaceable(repair.score_skipped(split.unique, split.skipped))
    ).collect()
    frame = sorted(data.collect(), key=lambda r: r.seq)
    kept, rejected = {}, []
    for r in frame:
        if (r.symbol, r.dt) in kept:
            rejected.append(r)
        else:
            kept[(r.symbol, r.dt)] = r
    expected = {}
    for r in rejected:
        days = sorted(d for s, d in kept if s == r.symbol and d.year == r.dt.year)
        at = days.index(r.dt)
        prev = kept[(r.symbol, days[at - 1])] if at else None
        following = kept[(r.symbol, days[at + 1])] if at + 1 < len(days) else None
        if prev is None and following is None:
            continue
        prev, following = prev or following, following or prev
        dist = lambda x, c: ((int(prev[c]) + int(following[c])) / 2 - int(x[c])) ** 2
        price = lambda x: sum(dist(x, c) for c in ("open", "high", "low", "close"))
        k = kept[(r.symbol, r.dt)]
        if price(r) < price(k) or dist(r, "volume") < dist(k, "volume"):
            expected.setdefault((r.symbol, r.dt), r.seq)
    assert {(r.symbol, r.dt): r.seq for r in picked} == expected
