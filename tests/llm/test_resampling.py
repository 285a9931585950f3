import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from plain import documents  # noqa: F401

from barloom.llm import resampling
from barloom.llm.common import hashes_of, mix


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = ["".join(rng.choices("abcdefg", k=rng.randint(2, 6))) for _ in range(rng.randint(20, 120))]
        bad = i % 7 == 0
        if bad:
            words = [w + "***" for w in words] if i % 2 else [w for w in words[:8] for _ in range(10)]
        docs.append((i, " ".join(words)))
        if i % 2 == 0 or i % 3 == 0:
            labels.append((i, int(not bad), 0))
    return docs, labels


def brute_grams(text, buckets):
    """Buckets of the tokens and pairs of one text, one by one."""
    tokens = [p for w in (text or "").split() for p in resampling.PART.findall(w.lower()) or [w]]
    raw = hashes_of(tokens).tolist()
    marked = []
    for i, h in enumerate(raw):
        again = i >= 1 and raw[i] == raw[i - 1]
        for d in range(2, resampling.REACH + 1):
            again |= i - d - 1 >= 0 and raw[i] == raw[i - d] and raw[i - 1] == raw[i - 1 - d]
        marked.append(int(resampling.AGAIN) if again else h)
    one = mix(np.array(marked, np.uint64)) % np.uint64(buckets)
    two = [
        int(mix(np.array([(a * int(resampling.STEP) + b) % 2**64], np.uint64))[0] % np.uint64(buckets))
        for a, b in zip(marked, marked[1:])
    ]
    return Counter(one.tolist() + two)


def test_grams_one_by_one():
    texts = ["A b, c! a b", None, "", "x x x x", "is it. is it. is it.", "*** (q)", "b c d e f b c d"]
    bucket, text_of = resampling.grams(pa.array(texts), 1 << 16)
    for k, text in enumerate(texts):
        assert Counter(bucket[text_of == k].tolist()) == brute_grams(text, 1 << 16)


def test_weights_by_the_definition(spark, documents):
    docs, labels = corpus(60)
    frame = documents([*docs, (900, None), (901, "")])
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    buckets = 1 << 12
    raw, target = Counter(), Counter()
    good = {i for i, q, _ in labels if q == 1}
    for i, text in docs:
        raw += brute_grams(text, buckets)
        target += brute_grams(text, buckets) if i in good else Counter()
    p = np.array([target[b] + 1 for b in range(buckets)]) / (sum(target.values()) + buckets)
    q = np.array([raw[b] + 1 for b in range(buckets)]) / (sum(raw.values()) + buckets)
    ratio = resampling.fit_ratio(frame, known, buckets=buckets)
    assert np.allclose(ratio, np.log(p / q))
    rows = {r.doc_id: r.log_weight for r in resampling.weigh(frame, ratio).collect()}
    for i, text in docs:
        assert rows[i] == pytest.approx(sum(n * ratio[b] for b, n in brute_grams(text, buckets).items()))
    assert rows[900] is None and rows[901] is None


def test_good_kept_bad_rejected_and_rows_whole(spark, documents):
    docs, labels = corpus()
    frame = documents([*docs, docs[1], (900, None), (None, docs[1][1])])
    known = spark.createDataFrame([*labels, (None, None, None)], "doc_id long, quality int, toxic int")
    got = resampling.resample(frame, known)
    assert got.columns == [*frame.columns, "log_weight", "sample_key"]
    ids = [r.doc_id for r in got.collect()]
    good = [i for i, _ in docs if i % 7]
    assert set(good) <= set(ids) and ids.count(1) == 2 and 900 not in ids
    assert len(set(ids) - {None} - set(good)) <= 2


@pytest.mark.parametrize("k", [0, 1, 7, 399, 400, 1000])
def test_exactly_the_largest_keys(spark, documents, k):
    docs, labels = corpus()
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    frame = documents(docs)
    keys = [(r.sample_key, r.doc_id) for r in resampling.weigh(frame, resampling.fit_ratio(frame, known)).collect()]
    got = [r.doc_id for r in resampling.resample(frame, known, k=k).collect()]
    assert sorted(got) == sorted(i for _, i in sorted(keys, reverse=True)[:k])


def test_gumbel_noise_samples_in_proportion(spark):
    # With weights log p, the largest key falls on each row with probability p.
    rng = [resampling.xxhash.xxh64_intdigest(f"{s}:{i}:t") for s in range(4000) for i in range(2)]
    u = ((np.array(rng, np.uint64) >> np.uint64(11)).astype(float) + 0.5) / 2**53
    keys = np.log([0.8, 0.2]) - np.log(-np.log(u.reshape(-1, 2)))
    assert (keys.argmax(axis=1) == 0).mean() == pytest.approx(0.8, abs=0.03)


def test_no_labels_or_no_documents(spark, documents):
    docs, labels = corpus(50)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert resampling.resample(documents(docs), known.limit(0)).count() == len(docs)
    assert resampling.resample(documents(docs).limit(0), known).count() == 0
