"""Benchmark items inside documents: size-partitioned MinHash search, verified by exact containment."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import work_path
from .common import SHINGLE, SPACE, bounded, column, save, shingle_sets

THRESHOLD = 0.75
#: Shingles of the items that one pass over the documents looks for; more items take more passes.
BLOCK_SHINGLES = 2_000_000
_LOWER = {c: c + 32 for c in range(65, 91)}


def signature_size(n: int, threshold: float) -> int:
    """Minima kept of an item of n shingles: those its size class (a power of two) needs.

    A document that holds `threshold` of an item lacks at most (1 - threshold) * n of its
    shingles, so among one more than that many minima at least one is in the document. The class
    takes the number that its largest size needs.
    """
    largest = (1 << n.bit_length()) - 1
    return min(n, math.floor((1 - threshold) * largest + 1e-9) + 1)


def spelled(text: str, width: int = SHINGLE):
    """The set of shingles of a text, as tuples of words; with a width of 1, its words in order."""
    words = [w for w in _split(text.translate(_LOWER)) if w]
    if width == 1:
        return words
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def _split(text):
    for c in SPACE[1:]:
        text = text.replace(c, " ")
    return text.split(" ")


@dataclass
class Block:
    """The items of one pass: their shingle sets, texts, and the items behind each minimum."""

    ids: list
    texts: list
    sets: list
    minima: np.ndarray
    first: np.ndarray
    items: np.ndarray
    threshold: float
    short: dict  # by number of words under SHINGLE: hashes of whole items, ascending, and their items

    @classmethod
    def of(cls, ids, texts, threshold):
        sets = shingle_sets(pa.array(texts, pa.string()))
        keys, owners, short = [], [], {}
        for i, s in enumerate(sets):
            words = spelled(texts[i], 1)
            n = len(words) if len(s) == 1 else SHINGLE
            if n < SHINGLE:
                whole = shingle_sets(pa.array([texts[i]], pa.string()), n)[0][0]
                short.setdefault(n, []).append((int(whole), i))
            elif len(s):
                # Shingle hashes are their own random order: the smallest are the minima.
                keys.append(s[: signature_size(len(s), threshold)])
                owners.append(np.full(len(keys[-1]), i))
        keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        owners = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        order = np.argsort(keys, kind="stable")
        minima, first = np.unique(keys[order], return_index=True)
        kinds = (np.uint64, np.int64)
        short = {n: tuple(np.array(x, k) for x, k in zip(zip(*sorted(found)), kinds)) for n, found in short.items()}
        return cls(ids, texts, sets, minima, np.append(first, len(keys)), owners[order], threshold, short)

    def search(self, texts):
        """(row, item, shingles of the item, shared ones) of every hit in a string array."""
        yield from self.search_short(texts)
        sets = shingle_sets(texts)
        sizes = [len(s) for s in sets]
        if not len(self.minima) or not sum(sizes):
            return
        flat = np.concatenate(sets)
        row_of = np.repeat(np.arange(len(sets)), sizes)
        low = flat <= self.minima[-1]
        flat, row_of = flat[low], row_of[low]
        at = np.searchsorted(self.minima, flat)
        hit = self.minima[np.minimum(at, len(self.minima) - 1)] == flat
        at, row_of = at[hit], row_of[hit]
        counts = self.first[at + 1] - self.first[at]
        places = np.repeat(self.first[at] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
        owners = self.items[places + np.arange(counts.sum())]
        pairs = np.unique(np.repeat(row_of, counts) * len(self.ids) + owners)
        words, known = None, None
        for row, item in zip((pairs // len(self.ids)).tolist(), (pairs % len(self.ids)).tolist()):
            wanted, own = self.sets[item], sets[row]
            where = np.minimum(np.searchsorted(own, wanted), len(own) - 1)
            if (own[where] == wanted).sum() < self.threshold * len(wanted) - 1e-9:
                continue
            # Hashes agree; the words decide.
            if known != row:
                words, known = spelled(texts[row].as_py()), row
            inside = spelled(self.texts[item])
            shared = len(inside & words)
            if shared >= self.threshold * len(inside) - 1e-9:
                yield row, item, len(inside), shared


    def search_short(self, texts):
        """The same for items of fewer than SHINGLE words, as shingles of their own length."""
        for width, (hashes, items) in self.short.items():
            sets = shingle_sets(texts, width)
            sizes = [len(s) for s in sets]
            if not sum(sizes):
                continue
            flat, row_of = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
            low, high = (np.searchsorted(hashes, flat, side=side) for side in ("left", "right"))
            for at in np.flatnonzero(high > low).tolist():
                row = int(row_of[at])
                own = spelled(texts[row].as_py(), width) if width > 1 else {(w,) for w in spelled(texts[row].as_py(), 1)}
                for item in items[low[at] : high[at]].tolist():
                    if tuple(spelled(self.texts[item], 1)) in own:
                        yield row, item, 1, 1


def keyed(items: DataFrame) -> DataFrame:
    """item_id, text (empty for null) and the digest of the text."""
    text = F.coalesce("text", F.lit(""))
    return items.select("item_id", text.alias("text"), F.sha2(text, 256).alias("key"))


def blocks(items: DataFrame, threshold: float, most: int):
    """Broadcast blocks of the distinct texts of the items, of about `most` shingles each."""
    spark = items.sparkSession
    texts = keyed(items).groupBy("key").agg(F.first("text").alias("text"))
    texts = save(texts.withColumn("n", F.octet_length("text") / 4 + 1), work_path(spark, "items"))
    total = texts.agg(F.sum("n")).first()[0] or 0
    count = max(1, math.ceil(total / most))
    for k in range(count):
        rows = texts.where(F.pmod(F.xxhash64("key"), F.lit(count)) == k).orderBy("key").collect()
        yield spark.sparkContext.broadcast(Block.of([r.key for r in rows], [r.text for r in rows], threshold))


def contained_items(
    docs: DataFrame, items: DataFrame, *, threshold: float = THRESHOLD, most: int = BLOCK_SHINGLES
) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment) of every item that a document holds.

    An item is held when `threshold` of its distinct five-word shingles (A-Z lower-cased) are in
    the document. An item of fewer words is one shingle of its own length, which is held wherever
    its words stand in a row; items and documents without words, null ones among them, take no
    part. Repeated rows give repeated pairs; null ids stay null; extra columns are ignored; an
    empty table on either side gives no rows.

    Items are partitioned by size: each size class has its own number of minima. With these all
    containments are found, and a document's shingles are looked up whole, however long it is.
    Equal items are one text; the texts go round in blocks of bounded size, each a pass over the
    documents without a shuffle, and the ids are joined to what is found.
    """
    kinds = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("key", pa.string()),
            ("n_item", pa.int64()),
            ("n_shared", pa.int64()),
            ("containment", pa.float64()),
        ]
    )

    def finder(shared):
        def run(batches):
            for batch in bounded(batches):
                ids = column(batch, "doc_id")
                rows = [
                    (ids[row].as_py(), shared.value.ids[item], n, m, m / n)
                    for row, item, n, m in shared.value.search(column(batch, "text"))
                ]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), kinds.types)], schema=kinds
                    )

        return run

    schema = "doc_id long, key string, n_item long, n_shared long, containment double"
    found = [docs.select("doc_id", "text").mapInArrow(finder(b), schema) for b in blocks(items, threshold, most)]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    out = out.join(keyed(items).select("item_id", "key"), "key")
    return out.select("doc_id", "item_id", "n_item", "n_shared", "containment")


def decontaminate(
    docs: DataFrame, items: DataFrame, *, threshold: float = THRESHOLD, most: int = BLOCK_SHINGLES
) -> DataFrame:
    """The rows of `docs`, all columns, that hold no item; see contained_items for the cases.

    An item of one word takes all documents with that word away: leave out of `items` what is not
    to count.
    """

    def keeper(shared):
        def run(batches):
            for batch in bounded(batches):
                clean = np.ones(batch.num_rows, dtype=bool)
                for row, *_ in shared.value.search(column(batch, "text")):
                    clean[row] = False
                yield batch.filter(pa.array(clean))

        return run

    for block in blocks(items, threshold, most):
        docs = docs.mapInArrow(keeper(block), docs.schema)
    return docs
