import math
import random
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from plain import documents  # noqa: F401

from barloom.llm import toxicity

BAD = ["scum", "idiot", "worthless"]


def corpus(n, seed):
    rng = random.Random(seed)
    texts, labels, langs = [], [], []
    for i in range(n):
        words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(rng.randint(5, 120))]
        bad = i % 3 == 0
        if bad:
            words[rng.randrange(len(words))] = rng.choice(BAD) + rng.choice(["", ".", ","])
        texts.append(" ".join(words))
        labels.append(float(bad))
        langs.append("en" if i % 2 else "fr")
    return texts, labels, langs


def test_held_out_accuracy_and_thresholds():
    model = toxicity.train(*corpus(600, 1))
    texts, labels, _ = corpus(300, 2)
    scores = model.scores(pa.array(texts))
    assert ((scores >= 0.7) == np.array(labels, bool)).mean() > 0.97
    assert set(model.thresholds) == {"", "en", "fr"}


def test_a_text_is_scored_alone():
    model = toxicity.train(*corpus(200, 3))
    texts = ["", None, "scum", "a b", "scum idiot " * 50, "x"]
    together = model.scores(pa.array(texts))
    alone = [model.scores(pa.array([t], pa.string()))[0] for t in texts]
    assert np.allclose(together, alone) and together[0] == together[1]
    assert ((0 <= together) & (together <= 1)).all()


def test_one_class_or_nothing():
    for texts, labels in (([], []), (["a", "b"], [1.0, 1.0])):
        model = toxicity.train(texts, labels, ["en"] * len(texts))
        assert (model.scores(pa.array(["a", None], pa.string())) < 0.7).all()


def test_frames(spark, documents):
    texts, labels, langs = corpus(200, 4)
    docs = documents([*enumerate(texts), (0, texts[0]), (None, None)])
    known = spark.createDataFrame(
        [(i, 1, int(y)) for i, y in enumerate(labels)] + [(0, 1, 1), (None, None, None), (10_000, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    model = toxicity.fit_toxicity(docs, known, per_class=60)
    rows = toxicity.score_toxicity(docs, model).collect()
    assert len(rows) == len(texts) + 2 and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0
    assert toxicity.fit_toxicity(docs, known.limit(0)).dense.any() == 0


def test_rare_forms_of_toxic_words():
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 7)))
    texts, labels = [], []
    for i in range(1200):
        words = [word() for _ in range(rng.randint(5, 60))]
        if i % 6 == 0:
            words[rng.randrange(len(words))] = rng.choice(["zumo", "kruv"]) + "".join(rng.choices("rstuv", k=6))
        texts.append(" ".join(words))
        labels.append(float(i % 6 == 0))
    model = toxicity.train(texts[:900], labels[:900], ["es"] * 900)
    hit = model.scores(pa.array(texts[900:])) >= 0.7
    bad = np.array(labels[900:], bool)
    assert hit[bad].mean() > 0.9 and hit[~bad].mean() < 0.05


def plain_score(model, text):
    """The forward pass of one text by the definition, word by word and window by window."""
    words = [w for w in re.split("[ \t\n\x0b\x0c\r]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)) if w]
    most = model.buckets - 1
    known = set(model.vocabulary.tolist())

    def embedding(word):
        bare, total = word.strip(toxicity.MARKS), np.zeros(model.tables.shape[2])
        for form in [bare, *[f"{bare[:n]}*{n}" for n in toxicity.PIECES]]:
            h = xxhash.xxh64_intdigest(form)
            if h in known:
                total = total + model.tables[0][1 + (h & 0xFFFFFFFF) % most] + model.tables[1][1 + (h >> 32) % most]
        return total

    vectors = [embedding(w) for w in words] + [np.zeros(model.tables.shape[2])] * max(toxicity.WIDTHS)
    pooled = []
    for width, filters, bias in zip(toxicity.WIDTHS, model.filters, model.biases):
        windows = [sum(vectors[i + k] @ filters[k] for k in range(width)) for i in range(len(vectors) - width + 1)]
        pooled += np.maximum(np.max(windows, axis=0) + bias, 0).tolist()
    z = model.scale * (np.dot(pooled, model.dense) + model.offset) + model.shift
    return 1 / (1 + math.exp(-min(30, max(-30, z))))


def test_scores_by_the_definition():
    model = toxicity.train(*corpus(300, 5))
    texts = [*corpus(30, 6)[0], "", " \n ", "SCUM! idiotic, (worthless)", "é scumé " * 20]
    got = model.scores(pa.array(texts))
    assert np.allclose(got, [plain_score(model, t) for t in texts], atol=1e-4)


def test_every_labelled_document_counts(spark, documents):
    texts, labels, langs = corpus(600, 9)
    docs = documents([*enumerate(texts)]).drop("lang")
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 1, "en").otherwise("fr"))
    known = spark.createDataFrame([(i, 1, int(y)) for i, y in enumerate(labels)], "doc_id long, quality int, toxic int")
    for model in (toxicity.fit_toxicity(docs, known, per_class=5), toxicity.fit_toxicity(docs, known, max_bytes=0)):
        # Words and thresholds come from all documents, also where few or none begin.
        assert set(toxicity.forms(BAD)[0].tolist()) <= set(model.vocabulary.tolist())
        assert set(model.thresholds) == {"", "en", "fr"}
    model = toxicity.fit_toxicity(docs, known, per_class=5)
    more, bad, _ = corpus(300, 10)
    assert ((model.scores(pa.array(more)) >= 0.7) == np.array(bad, bool)).mean() > 0.95


def test_known_forms_and_counts_of_logits(spark, documents):
    texts, labels, langs = corpus(300, 11)
    known = spark.createDataFrame([(i, 1, int(y)) for i, y in enumerate(labels)], "doc_id long, quality int, toxic int")
    table = toxicity.labelled_texts(documents([*enumerate(texts)]), known, 5)
    share = float(np.mean(labels))
    found, bad, every = toxicity.form_counts(pa.array(texts), np.array(labels, bool))
    expected = np.unique(found[toxicity.worth_knowing(bad, every, share)])
    assert toxicity.known_forms(table, share).tolist() == expected.tolist()
    model = toxicity.train(texts, labels, langs)
    counts = toxicity.logit_counts(table, model).collect()
    assert sum(r.bad for r in counts) == sum(labels) and sum(r.bad + r.good for r in counts) == len(texts)


def test_equal_logits_do_not_stretch_the_scores():
    model = toxicity.untrained(np.random.default_rng(1))
    toxicity.calibrate_counts(model, [-1.0, 0.0, 2.0], [0, 0, 5], [3, 45, 0], [None] * 3)
    assert model.scale == 1.0 and math.isclose(model.shift, math.log(0.7 / 0.3) - 1.0)
