import numpy as np
import pytest
from tokenizers import Tokenizer
from pyspark.sql import functions as F
from plain import shingles
from test_jaccard import brute

import corpus_pipeline
from barloom.llm.queries import tokenizer
from barloom.llm.resampling import resample
from barloom.llm.secrets import _masked, unwrap

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark, folder):
    read = lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
    secret = F.when(F.col("doc_id") % 5 == 0, F.lit(" token=abcdefgh1 %41KIAABCDEFGHIJKLMNOP")).otherwise("")
    docs = read("documents").withColumn("text", F.concat("text", secret))
    docs = docs.withColumn("n_chars", F.char_length("text").cast("long"))
    columns, frame = docs.columns, docs
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, SF)
        frame.write.parquet(f"{folder}/{name}")
        frame = spark.read.parquet(f"{folder}/{name}")
        if name != "packing":
            assert frame.columns == columns
        kept.append(frame.collect())

    # What resampling takes is held against its own definition in test_resampling.
    texts = {r.doc_id: r.text for r in docs.collect()}
    first = {r.doc_id for r in resample(docs, read("labels")).collect()}
    assert {r.doc_id for r in kept[0]} == first
    bad = {r.doc_id for r in read("labels").where("quality = 0").collect()}
    good = {r.doc_id for r in read("labels").where("quality = 1").collect()}
    assert good & set(texts) <= first and len(bad & first) <= 1

    second = {d for d, _, c in brute([(d, texts[d]) for d in first]) if d == c}
    assert {r.doc_id for r in kept[1]} == second and len(kept[1]) == len(second) < len(first)

    items = [shingles(r.text) for r in read("benchmark").collect()]
    held = lambda own: any(s and 4 * len(s & own) >= 3 * len(s) for s in items)
    third = {d for d in second if not held(shingles(texts[d]))}
    assert {r.doc_id for r in kept[2]} == third != second

    masked = {d: _masked(texts[d], unwrap(texts[d])[0]) for d in third}
    assert {r.doc_id: r.text for r in kept[3]} == masked and any(masked[d] != texts[d] for d in third)
    assert all(r.n_chars == len(r.text) for r in kept[3])

    ids = {}
    for r in sorted(kept[4], key=lambda r: (r.doc_id, r.start)):
        assert len(ids.setdefault(r.doc_id, [])) == r.start
        ids[r.doc_id] += np.frombuffer(bytes(r.ids), "<u4").tolist()
    own = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    assert ids == {d: [*own.encode(t, add_special_tokens=False).ids, 1] for d, t in masked.items()}


def test_run_is_the_stages(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    assert rows.count() > 0


def test_odd_rows_of_the_quality_stage(spark):
    """Texts without n-grams go; the others are weighed by the labels of the folder."""
    stage = dict(corpus_pipeline.STAGES)["quality"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(5)
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (1, "", "en", None, 0), (1, " \n", "en", None, 2), (2, "a b", None, "s", 3)], docs.schema
    )
    kept = stage(spark, odd, SF)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} <= {2}
    assert stage(spark, odd.limit(0), SF).count() == 0


@pytest.mark.parametrize("stage", [f for n, f in corpus_pipeline.STAGES if n != "quality"])
def test_odd_rows_and_empty_tables(spark, stage):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(5)
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, "a b", None, "s", 3)],
        docs.schema,
    )
    assert stage(spark, odd, SF).count() in (3, 4, 5)
    assert stage(spark, odd.limit(0), SF).count() == 0
