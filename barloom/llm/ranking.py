"""Ranked lexical search by the Best Position Algorithm over impact lists of index shards."""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import work_path
from .common import bounded, column, save

#: Text bytes of one index shard; a longer text is a shard by itself.
SHARD_BYTES = 4_000_000
#: Bytes of items that one pass over the index looks for; more items take more passes.
BLOCK_BYTES = 4_000_000
#: First depth of a search; it doubles until the search stops.
DEPTH = 16
#: Groups in which the best of an item's shards are chosen before the best of all.
BUCKETS = 256

#: Separators of terms are the ASCII characters but digits and letters; A-Z become a-z.
_TERM = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def term_codes(texts):
    """(code of each term, first term of each text plus the end, distinct terms) of a string array.

    Terms are maximal runs of ASCII digits and letters and of characters beyond ASCII, with only
    A-Z lower-cased; a null text has none.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if texts.offset:
        texts = pa.concat_arrays([texts])
    _, offsets, data = texts.buffers()
    clean = pa.py_buffer((data.to_pybytes() if data else b"").translate(_TERM))
    texts = pa.LargeStringArray.from_buffers(len(texts), offsets, clean)
    lists = pc.ascii_split_whitespace(texts)
    starts = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.slice(starts[0], starts[-1] - starts[0]).dictionary_encode()
    codes, terms = flat.indices.to_numpy(zero_copy_only=False), flat.dictionary
    # Separators at either end of a text leave empty pieces.
    full = codes != pc.index(terms, pa.scalar("", terms.type)).as_py()
    ends = np.concatenate([[0], np.cumsum(full)])
    return codes[full], ends[starts - starts[0]], terms


def build_index(docs: DataFrame, path: str | None = None, *, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """An inverted index of all documents, one row per shard, written to `path`.

    Columns: shard (a random 63-bit number), n_docs (documents with a term), n_terms (their terms
    with repeats), doc_id and n (terms of each document), terms, df (documents of the shard that
    hold each term), and the documents (places in doc_id) and frequencies of all postings, term
    after term, ascending.

    Null and empty texts are documents without terms. Rows that repeat a doc_id are documents of
    their own; extra columns are ignored; an empty table gives an empty index. Shards hold bounded
    text, wherever copies or one source make up much of the input, and are written without a
    shuffle.
    """
    kinds = pa.schema(
        [("shard", pa.int64()), ("n_docs", pa.int64()), ("n_terms", pa.int64())]
        + [("doc_id", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())), ("terms", pa.list_(pa.string()))]
        + [(k, pa.list_(pa.int32())) for k in ("df", "places", "tf")]
    )

    def run(batches):
        for batch in bounded(batches, most=shard_bytes):
            codes, starts, terms = term_codes(column(batch, "text"))
            n = np.diff(starts)
            keys, tf = np.unique(
                codes.astype(np.int64) * len(n) + np.repeat(np.arange(len(n)), n), return_counts=True
            )
            held, df = np.unique(keys // max(1, len(n)), return_counts=True)
            lists = [
                column(batch, "doc_id"),
                pa.array(n, pa.int64()),
                terms.take(pa.array(held)).cast(pa.string()),
                *[pa.array(x, pa.int32()) for x in (df, keys % max(1, len(n)), tf)],
            ]
            scalars = [uuid.uuid4().int >> 65, int((n > 0).sum()), int(n.sum())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], pa.int64()) for x in scalars]
                + [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists],
                schema=kinds,
            )

    shards = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run,
        "shard long, n_docs long, n_terms long, doc_id array<long>, n array<long>, terms array<string>, "
        "df array<int>, places array<int>, tf array<int>",
    )
    return save(shards, path or work_path(docs.sparkSession, "index"), wide=True)


@dataclass
class Block:
    """The items of one pass: their keys, and for each its terms with their number of repeats."""

    keys: list
    terms: list
    wanted: list

    @classmethod
    def of(cls, keys, texts):
        codes, starts, terms = term_codes(pa.array(texts, pa.string()))
        wanted = [np.unique(codes[a:b], return_counts=True) for a, b in zip(starts[:-1], starts[1:])]
        return cls(keys, terms.to_pylist(), wanted)


class Lists:
    """The impact lists of one shard for the terms of a block.

    A list is a slice of arrays over all postings of these terms: `docs` and `impact` by document,
    for direct accesses; `by_impact` by falling impact, for sorted ones; `position` is where a
    posting stands there.
    """

    def __init__(self, shard, block, weights, total_docs, total_terms):
        self.doc_id, n = shard["doc_id"], shard["n"]
        self.n_docs = len(n)
        known = pa.array(block.terms, pa.string())
        place = pc.index_in(known, shard["terms"])
        #: List of each term of the block, -1 where the shard lacks it.
        at = np.asarray(pc.fill_null(place, -1).to_numpy(zero_copy_only=False), dtype=np.int64)
        held = np.flatnonzero(at >= 0)
        self.list_of = np.full(len(at), -1, dtype=np.int64)
        self.list_of[held] = np.arange(len(held))
        df = shard["df"].astype(np.int64)
        first, self.size = (np.cumsum(df) - df)[at[held]], df[at[held]]
        self.start = np.cumsum(self.size) - self.size
        postings = np.repeat(first - self.start, self.size) + np.arange(self.size.sum())
        self.docs = shard["places"][postings].astype(np.int64)
        tf = shard["tf"][postings].astype(np.int64)
        m = 75 + (25 * n * total_docs) // max(1, total_terms)
        own = np.repeat(np.arange(len(held)), self.size)
        self.impact = weights[held][own] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[self.docs]))
        self.keys = own * self.n_docs + self.docs
        self.by_impact = np.lexsort((self.docs, -self.impact, own))
        self.position = np.empty_like(self.by_impact)
        self.position[self.by_impact] = np.arange(len(own))

    def best(self, wanted, k):
        """(places, scores) of the k best documents for an item, or more where scores tie.

        All lists are read from the top in steps that double. A document met for the first time
        is looked up in every list by direct access, which marks its position there as seen. The
        best position of a list is the last one up to which all are seen: what has not been met
        stands below it, so it scores at most the sum of the impacts there. The search stops when
        that sum is strictly below the k-th score.
        """
        terms, repeats = wanted
        lists = self.list_of[terms]
        repeats, lists = repeats[lists >= 0], lists[lists >= 0]
        if not len(lists):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        start, size = self.start[lists], self.size[lists]
        met = np.zeros(self.n_docs, dtype=bool)
        seen = [np.zeros(s, dtype=bool) for s in size]
        best = np.zeros(len(lists), dtype=np.int64)
        places, scores, depth, step = [], [], 0, DEPTH
        while True:
            rows = [
                self.by_impact[a + depth : a + min(depth + step, s)] for a, s in zip(start, size) if depth < s
            ]
            depth, step = depth + step, 2 * step
            new = np.unique(self.docs[np.concatenate(rows)]) if rows else np.zeros(0, np.int64)
            new = new[~met[new]]
            met[new] = True
            keys = (lists[:, None] * self.n_docs + new).ravel()
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hit = (self.keys[at] == keys).reshape(len(lists), len(new))
            at = at.reshape(hit.shape)
            places.append(new)
            scores.append((np.where(hit, self.impact[at], 0) * repeats[:, None]).sum(axis=0))
            threshold = 0
            for j in range(len(lists)):
                own = seen[j]
                own[self.position[at[j][hit[j]]] - start[j]] = True
                ahead = own[best[j] :]
                best[j] += len(ahead) if ahead.all() else int(ahead.argmin())
                if best[j] < size[j]:
                    threshold += int(repeats[j] * self.impact[self.by_impact[start[j] + best[j] - 1]])
            found = np.concatenate(scores)
            found = found[found > 0]
            if threshold == 0 or len(found) >= k and np.partition(found, len(found) - k)[len(found) - k] > threshold:
                break
        places, scores = np.concatenate(places), np.concatenate(scores)
        if len(scores) > k:
            kth = np.partition(scores, len(scores) - k)[len(scores) - k]
            places, scores = places[scores >= kth], scores[scores >= kth]
        return places[scores > 0], scores[scores > 0]


def _blocks(items, most):
    """Blocks of the distinct texts of the items, of about `most` bytes each."""
    texts = items.select("key", "text").groupBy("key").agg(F.first("text").alias("text"))
    texts = save(texts, work_path(items.sparkSession, "item-texts"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, math.ceil(total / most))
    for b in range(count):
        rows = texts.where(F.pmod(F.xxhash64("key"), F.lit(count)) == b).orderBy("key").collect()
        if rows:
            yield Block.of([r.key for r in rows], [r.text for r in rows])


def _shard(batch, names):
    """The rows of a batch of shards, as numpy arrays but for terms and document ids."""
    for i in range(batch.num_rows):
        row = {k: column(batch, k)[i].values for k in names}
        yield {k: v if k in ("doc_id", "terms") else v.to_numpy(zero_copy_only=False) for k, v in row.items()}


def best_documents(index: DataFrame, items: DataFrame, *, k: int = 20, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score) of the k documents that score highest for each item.

    The score of a document sums, over the terms of the item with repeats, the term's weight times
    (1000000000 tf) div (1000 tf + 12 m); see the README for weight and m. Only scores above 0
    count. Ranks start at 1; equal scores go by ascending doc_id, null first. Items without terms,
    null ones among them, have no rows; rows that repeat an item_id are items of their own; an
    empty table on either side gives no rows.

    Each block of items makes two passes over the index: one for the document frequencies of its
    terms, which are as many as a bounded block has, one for the search of each shard. The k best
    of each shard are merged in two steps, so no task takes the rows of all shards of an item.
    """
    spark = index.sparkSession
    items = items.select(
        "item_id", F.coalesce("text", F.lit("")).alias("text"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("key")
    )
    totals = index.agg(F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("terms")).first()
    total_docs, total_terms = totals.docs or 0, totals.terms or 0
    columns = "key string, bucket int, doc_id long, score long"
    parts = [spark.createDataFrame([], columns)]
    for block in _blocks(items, block_bytes):
        shared = spark.sparkContext.broadcast(block)
        counted = index.select("terms", "df").mapInArrow(_counter(shared), "term int, df long")
        df = np.zeros(len(block.terms))
        for r in counted.groupBy("term").agg(F.sum("df").alias("df")).collect():
            df[r.term] = r.df
        # Terms that no document holds have no list, so their weight does not matter.
        weights = np.floor(1000 * np.log((2 * total_docs + 2) / (2 * df + 1))).astype(np.int64)
        weighed = spark.sparkContext.broadcast((block, weights, total_docs, total_terms, k))
        parts.append(
            index.select("shard", "doc_id", "n", "terms", "df", "places", "tf").mapInArrow(_searcher(weighed), columns)
        )
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    order = [F.desc("score"), F.asc_nulls_first("doc_id")]
    for groups in (["key", "bucket"], ["key"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*groups).orderBy(*order)))
        found = found.where(F.col("rank") <= k)
    return items.select("item_id", "key").join(found, "key").select("item_id", "rank", "doc_id", "score")


def _counter(shared):
    kinds = pa.schema([("term", pa.int32()), ("df", pa.int64())])

    def run(batches):
        wanted = pa.array(shared.value.terms, pa.string())
        for batch in batches:
            for shard in _shard(batch, ("terms", "df")):
                term = pc.index_in(shard["terms"], wanted).to_numpy(zero_copy_only=False)
                known = np.flatnonzero(~np.isnan(term))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(term[known].astype(np.int32)), pa.array(shard["df"][known].astype(np.int64))], schema=kinds
                )

    return run


def _searcher(weighed):
    kinds = pa.schema([("key", pa.string()), ("bucket", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches):
        block, weights, total_docs, total_terms, k = weighed.value
        for batch in batches:
            numbers = batch.column(0).to_pylist()
            for number, shard in zip(numbers, _shard(batch, ("doc_id", "n", "terms", "df", "places", "tf"))):
                lists = Lists(shard, block, weights, total_docs, total_terms)
                doc_ids = lists.doc_id
                rank = np.empty(lists.n_docs, np.int64)
                rank[pc.sort_indices(doc_ids, null_placement="at_start").to_numpy()] = np.arange(lists.n_docs)
                keys, places, scores = [], [], []
                for key, wanted in zip(block.keys, block.wanted):
                    own, found = lists.best(wanted, k)
                    best = np.lexsort((rank[own], -found))[:k]
                    keys += [key] * len(best)
                    places.append(own[best])
                    scores.append(found[best])
                places = np.concatenate(places)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.string()),
                        pa.array(np.full(len(keys), number % BUCKETS, np.int32)),
                        doc_ids.take(pa.array(places, pa.int64())),
                        pa.array(np.concatenate(scores), pa.int64()),
                    ],
                    schema=kinds,
                )

    return run
