"""Importance resampling: hashed n-gram models of target and raw text, sampled by Gumbel top-k."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import work_path
from .common import bounded, column, hashes_of, mix, save, word_codes

PART = re.compile(r"\w+|[^\w\s]+")
#: How far back a token pair is looked for; one that recurs counts as the token AGAIN.
REACH = 8
AGAIN = np.uint64(xxhash.xxh64_intdigest("again"))
STEP = np.uint64(0x9E3779B97F4A7C15)
#: Keys are compared as whole millionths.
UNIT = 1_000_000


def grams(texts, buckets):
    """(bucket, number of its text) of every token and pair of tokens of the texts.

    Tokens are runs of word characters and of other marks, A-Z lower-cased. A token that with the
    one before it repeats a pair of the last few tokens is taken as one special token, so that
    text running in circles looks alike whatever its words.
    """
    codes, starts, words = word_codes(texts)
    parts = [PART.findall(w) or [w] for w in words]
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    hashes = hashes_of([x for p in parts for x in p])
    first = np.concatenate([[0], np.cumsum(sizes)])
    n = sizes[codes] if len(codes) else np.zeros(0, np.int64)
    total = np.concatenate([[0], np.cumsum(n)])
    inside = np.arange(total[-1]) - np.repeat(total[:-1], n)
    h = hashes[np.repeat(first[:-1][codes], n) + inside] if len(codes) else np.zeros(0, np.uint64)
    text_of = np.repeat(np.arange(len(starts) - 1), np.diff(total[starts]))
    again = np.zeros(len(h), dtype=bool)
    if len(h) > 1:
        again[1:] = (h[1:] == h[:-1]) & (text_of[1:] == text_of[:-1])
    for d in range(2, REACH + 1):
        if len(h) > d + 1:
            same = (h[d:] == h[:-d]) & (text_of[d:] == text_of[:-d])
            again[d + 1 :] |= same[1:] & same[:-1]
    h = np.where(again, AGAIN, h)
    pairs = mix(h[:-1] * STEP + h[1:])
    within = text_of[:-1] == text_of[1:]
    bucket = np.concatenate([mix(h), pairs[within]]) % np.uint64(buckets)
    return bucket.astype(np.int64), np.concatenate([text_of, text_of[:-1][within]])


def labelled_sample(labels: DataFrame, most: int) -> DataFrame:
    """doc_id and good of at most `most` labelled documents of each class, settled by a hash."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg((F.max("quality") == 1).alias("good"))
    sides = [
        known.where(test).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        for test in (F.col("good"), ~F.col("good"))
    ]
    return sides[0].unionByName(sides[1])


def fit_ratio(docs: DataFrame, labels: DataFrame, *, buckets: int = 1 << 16, most: int = 10_000) -> np.ndarray:
    """log of target over raw probability by bucket, from add-one counts.

    The raw model counts every document; the target model the good ones among at most `most`
    labelled ones of each class. Counts are summed per task before they are shuffled.
    """
    marked = docs.select("doc_id", "text").join(
        F.broadcast(labelled_sample(labels, most).where("good")), "doc_id", "left"
    )

    def count(batches):
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in bounded(batches, most=2_000_000):
            bucket, text_of = grams(column(batch, "text"), buckets)
            good = column(batch, "good").fill_null(False).to_numpy(zero_copy_only=False).astype(bool)
            raw += np.bincount(bucket, minlength=buckets)
            target += np.bincount(bucket[good[text_of]], minlength=buckets)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_pydict({"bucket": some, "raw": raw[some], "target": target[some]})

    counts = (
        marked.mapInArrow(count, "bucket long, raw long, target long")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        .toPandas()
    )
    raw, target = np.ones(buckets), np.ones(buckets)
    raw[counts.bucket.to_numpy()] += counts.raw.to_numpy()
    target[counts.bucket.to_numpy()] += counts.target.to_numpy()
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def weigh(docs: DataFrame, ratio: np.ndarray, seed: int = 0) -> DataFrame:
    """The rows of `docs` with log_weight (sum of the log ratios of the text's n-grams) and sample_key.

    The key is the weight plus Gumbel noise from a hash of seed, doc_id and text, in whole
    millionths, so that a row's key is the same in every run. A text without n-grams, null and
    empty ones among them, has null for both.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ratio)
    names = [c for c in docs.columns if c.lower() not in ("log_weight", "sample_key")]

    def run(batches):
        ratio = shared.value
        for batch in bounded(batches, most=2_000_000):
            texts = column(batch, "text")
            bucket, text_of = grams(texts, len(ratio))
            weight = np.bincount(text_of, ratio[bucket], minlength=batch.num_rows)
            empty = np.bincount(text_of, minlength=batch.num_rows) == 0
            ids = column(batch, "doc_id").to_pylist()
            hashed = np.array(
                [xxhash.xxh64_intdigest(f"{seed}:{i}:{t}") for i, t in zip(ids, texts.to_pylist())], dtype=np.uint64
            )
            uniform = ((hashed >> np.uint64(11)).astype(np.float64) + 0.5) / 2**53
            key = np.floor((weight - np.log(-np.log(uniform))) * UNIT).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(weight, mask=empty), pa.array(key, mask=empty)],
                names=[*names, "log_weight", "sample_key"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(names).schema.fields)
    return docs.select(names).mapInArrow(run, f"{fields}, log_weight double, sample_key long")


def cut_weight(good: np.ndarray, bad: np.ndarray, max_good_loss: float) -> float | None:
    """The weight that parts labelled documents best, losing at most that share of the good ones."""
    if len(good) == 0 or len(bad) == 0:
        return None
    values = np.concatenate([good, bad])
    order = np.argsort(values, kind="stable")
    edges = values[order]
    is_good = (np.arange(len(values)) < len(good))[order]
    lost = np.concatenate([[0], np.cumsum(is_good)]) / len(good)
    caught = np.concatenate([[0], np.cumsum(~is_good)]) / len(bad)
    right = np.where(lost <= max_good_loss, caught - lost, -1)
    best = int(np.argmax(right))
    if best in (0, len(edges)):
        return float(edges[0] - 1 if best == 0 else edges[-1] + 1)
    return float(edges[best - 1] + edges[best]) / 2


def kth_key(keys: DataFrame, k: int, parts: int = 4096) -> int | None:
    """The k-th largest sample_key, by counts in ever narrower ranges of keys; None where all count.

    Each round brings `parts` counts at most to the driver, whatever the number of keys.
    """
    low, high, n = keys.agg(F.min("sample_key"), F.max("sample_key"), F.count("sample_key")).first()
    if k >= n:
        return None
    if k <= 0:
        return high + 1
    above = 0
    while low < high:
        width = (high - low) // parts + 1
        slot = F.expr(f"(sample_key - ({low})) div {width}")
        counts = dict(
            keys.where(F.col("sample_key").between(low, high)).groupBy(slot.alias("s")).count().collect()
        )
        for s in sorted(counts, reverse=True):
            if above + counts[s] >= k:
                low, high = low + s * width, min(high, low + (s + 1) * width - 1)
                break
            above += counts[s]
    return low


def resample(
    docs: DataFrame,
    labels: DataFrame,
    *,
    k: int | None = None,
    max_good_loss: float = 0.001,
    buckets: int = 1 << 16,
    most: int = 10_000,
    seed: int = 0,
) -> DataFrame:
    """The rows of `docs` that importance resampling takes, with log_weight and sample_key.

    `labels` (doc_id, quality) say which documents look like the target. Where `k` is not given it
    is the number of documents whose weight is above the one that parts labelled documents best
    (losing at most `max_good_loss` of the good ones), or all where there are labels of one class
    only. Rows with equal keys at the end of the k are all taken.

    Texts without n-grams (null, empty, white space) are never taken; copies of a text under
    different ids draw their own noise; a row that repeats another is taken or left with it; a
    null doc_id has no label but is weighed like others; of rows that repeat a labelled id the one
    of the least key stands for it; columns named log_weight or sample_key, in any case, are
    replaced and other extra columns kept; an empty table gives no rows.

    Three passes over the texts without a shuffle of them: counts, keys, and the rows taken. Keys
    are written once, and selection works on them.
    """
    ratio = fit_ratio(docs, labels, buckets=buckets, most=most)
    weighed = weigh(docs, ratio, seed)
    keys = weighed.select("doc_id", "log_weight", "sample_key").where("sample_key is not null")
    keys = save(keys, work_path(docs.sparkSession, "sample-keys"))
    if k is None:
        sample = labelled_sample(labels, most)
        # One row per labelled id, of which there are at most 2 * most.
        found = keys.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(
            F.min(F.struct("sample_key", "log_weight", "good")).alias("row")
        )
        found = found.select("row.good", "row.log_weight").toPandas()
        cut = cut_weight(
            found.log_weight[found.good].to_numpy(), found.log_weight[~found.good].to_numpy(), max_good_loss
        )
        k = keys.where(F.lit(True) if cut is None else F.col("log_weight") >= cut).count()
    least = kth_key(keys, k)
    taken = F.col("sample_key").isNotNull()
    return weighed.where(taken if least is None else taken & (F.col("sample_key") >= least))
