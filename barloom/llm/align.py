"""Token alignment of two tokenizers over the same texts, and how firmly their tokens belong together."""

from __future__ import annotations

import hashlib
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import work_path
from .bpe import prefix_encoder, spellings
from .common import bounded, column, save

#: Text bytes that share one block of pair counts; a longer text is a block by itself.
BLOCK_BYTES = 3_000_000
#: Groups of more links than this are counted by distinct ids instead of occurrences.
WIDE = 1 << 16
#: Searches from one that begins by a guess to the next.
STRIDE = 16


class PieceEncoder:
    """Ids of whole texts by a sentencepiece model, and the bytes that its pieces stand for."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.size = self.model.vocab_size()
        self.bytes_of = [self._spelled(i) for i in range(self.size)]

    def _spelled(self, i):
        if self.model.is_control(i) or self.model.is_unknown(i):
            return b""
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("\u2581", " ").encode("utf-8")

    def encode(self, texts) -> list:
        """Ids of each text; none where the bytes of its pieces are not a blank and the text."""
        spelled = self.bytes_of.__getitem__
        return [
            ids if b"".join(map(spelled, ids)) == b" " + text.encode("utf-8") else []
            for text, ids in zip(texts, self.model.encode(texts, num_threads=1))
        ]


def gallop(driver, into, start):
    """For each value of `driver` the index of the first value of `into` that is not less.

    Both lists ascend. Each search begins at its place in `start`, doubles its step until the
    value lies between two probes, and halves that range; all searches advance together.
    """
    n = len(into)
    low = np.clip(start, 0, n - 1)
    high = low.copy()
    up = into[low] < driver
    # Invariant at the end: everything before `low` is less, `high` is not less (or is the end).
    step = np.ones(len(driver), dtype=np.int64)
    todo = np.flatnonzero(up)
    while len(todo):
        high[todo] = low[todo] + step[todo]
        less = high[todo] < n
        less[less] = into[high[todo][less]] < driver[todo][less]
        low[todo] = np.where(less, high[todo], low[todo])
        step[todo] *= 2
        high[todo] = np.minimum(high[todo], n)
        todo = todo[less]
    todo = np.flatnonzero(~up)
    while len(todo):
        high[todo] = low[todo]
        low[todo] -= step[todo]
        inside = low[todo] >= 0
        inside[inside] = into[low[todo][inside]] >= driver[todo][inside]
        step[todo] *= 2
        low[todo] = np.maximum(low[todo], -1)
        todo = todo[inside]
    # low is less (or before the start), high is not less (or the end).
    todo = np.flatnonzero(high - low > 1)
    while len(todo):
        middle = (low[todo] + high[todo]) >> 1
        less = into[middle] < driver[todo]
        low[todo] = np.where(less, middle, low[todo])
        high[todo] = np.where(less, high[todo], middle)
        todo = todo[high[todo] - low[todo] > 1]
    return high


def common_ends(ends_a, ends_b, starts_a, starts_b):
    """Indices in either list of the byte offsets at which tokens of both end, in order.

    The lists of many texts stand one after the other, texts from `starts_a` and `starts_b` on;
    offsets go on over all texts. In each text the shorter list drives the search in the longer.
    """
    n_a, n_b = np.diff(starts_a), np.diff(starts_b)
    a_drives = n_a <= n_b
    found_a, found_b = [], []
    for drives, ends, into, own, other in (
        (a_drives, ends_a, ends_b, starts_a, starts_b),
        (~a_drives, ends_b, ends_a, starts_b, starts_a),
    ):
        counts = np.where(drives, np.diff(own), 0)
        text = np.repeat(np.arange(len(counts)), counts)
        if not len(text):
            continue
        rank = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
        mine = own[text] + rank
        # Both lists cut the same bytes: every 16th search begins at the same share of the other
        # list, those in between as many tokens behind the last of these.
        anchors = np.flatnonzero(rank % STRIDE == 0)
        start = other[text[anchors]] + rank[anchors] * np.diff(other)[text[anchors]] // np.diff(own)[text[anchors]]
        found = gallop(ends[mine[anchors]], into, start)
        start = found[np.cumsum(rank % STRIDE == 0) - 1] + rank % STRIDE
        place = gallop(ends[mine], into, start)
        same = into[np.minimum(place, len(into) - 1)] == ends[mine]
        pair = (mine[same], place[same])
        found_a.append(pair[0] if own is starts_a else pair[1])
        found_b.append(pair[1] if own is starts_a else pair[0])
    if not found_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    order = np.argsort(a, kind="stable")
    return a[order], b[order]


def _spread(first, counts):
    """first[i], first[i] + 1, ... of each i, counts[i] of them."""
    return np.repeat(first - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


class _Digits:
    """Decimal spelling of ids, as rows of bytes."""

    def __init__(self, size):
        text = [str(i).encode() for i in range(size)]
        self.width = max(map(len, text))
        self.lengths = np.array([len(t) for t in text])
        self.rows = np.frombuffer(b"".join(t.ljust(self.width) for t in text), np.uint8).reshape(size, self.width)


class Aligner:
    """Aligns texts in batches; one per worker."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = prefix_encoder(path_a, True), PieceEncoder(path_b)
        spelled = spellings(path_a)
        self.size_a, self.size_b = len(spelled), self.b.size
        self.length_a = np.array([len(t) for t in spelled])
        self.length_b = np.array([len(t) for t in self.b.bytes_of])
        self.digits = _Digits(max(self.size_a, self.size_b))

    def align(self, texts):
        """(tokens per text of a and of b, groups per text, ids a, ids b, tokens per group of a and of b)."""
        own_b = self.b.encode(texts)
        own_a = self.a.encode([" " + text if ids else "" for ids, text in zip(own_b, texts)])
        n_a = np.array([len(x) for x in own_a], dtype=np.int64) // self.a.dtype.itemsize
        n_b = np.array([len(x) for x in own_b], dtype=np.int64)
        ids_a = np.frombuffer(b"".join(own_a), self.a.dtype).astype(np.int64)
        ids_b = np.concatenate([np.array(x, np.int64) for x in own_b]) if own_b else np.zeros(0, np.int64)
        starts_a, starts_b = np.append(0, np.cumsum(n_a)), np.append(0, np.cumsum(n_b))
        ends_a, ends_b = np.cumsum(self.length_a[ids_a]), np.cumsum(self.length_b[ids_b])
        at_a, at_b = common_ends(ends_a, ends_b, starts_a, starts_b)
        # Every text ends at a common end, so groups never reach over texts.
        groups = np.diff(np.searchsorted(at_a, starts_a))
        return n_a, n_b, groups, ids_a, ids_b, np.diff(at_a, prepend=-1), np.diff(at_b, prepend=-1)

    def spelled(self, groups, ids_a, ids_b, in_a, in_b):
        """The groups of each text as bytes: ids of a, a bar, ids of b, groups parted by semicolons."""
        n = len(ids_a) + len(ids_b)
        both = in_a + in_b
        first = np.cumsum(both) - both
        ids, marks = np.empty(n, np.int64), np.full(n, ord(","), np.uint8)
        ids[_spread(first, in_a)] = ids_a
        ids[_spread(first + in_a, in_b)] = ids_b
        marks[first + in_a - 1] = ord("|")
        marks[first + both - 1] = ord(";")
        lengths = self.digits.lengths[ids]
        rows = np.empty((n, self.digits.width + 1), np.uint8)
        rows[:, :-1] = self.digits.rows[ids]
        rows[np.arange(n), lengths] = marks
        flat = rows[np.arange(self.digits.width + 1) <= lengths[:, None]].tobytes()
        ends = np.append(0, np.cumsum(lengths + 1))[np.append(first, n)]
        at = np.append(0, np.cumsum(groups))
        return [flat[ends[i] : max(ends[j] - 1, ends[i])] for i, j in zip(at[:-1], at[1:])]

    def pairs(self, groups, ids_a, ids_b, in_a, in_b):
        """(text, id of a * size of b + id of b, links) of the linked id pairs, ordered, each once."""
        text = np.repeat(np.arange(len(groups)), groups)
        first_a, first_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        links = in_a * in_b
        space = self.size_a * self.size_b
        narrow = links <= WIDE
        # Of each a token of a narrow group all b tokens of the group.
        owner = np.repeat(np.flatnonzero(narrow), in_a[narrow])
        a = np.repeat(ids_a[_spread(first_a[narrow], in_a[narrow])], in_b[owner])
        b = ids_b[_spread(first_b[owner], in_b[owner])]
        keys = [np.repeat(text[owner], in_b[owner]) * space + a * self.size_b + b]
        times = [np.ones(len(a), np.int64)]
        for g in np.flatnonzero(~narrow).tolist():
            own_a, many_a = np.unique(ids_a[first_a[g] : first_a[g] + in_a[g]], return_counts=True)
            own_b, many_b = np.unique(ids_b[first_b[g] : first_b[g] + in_b[g]], return_counts=True)
            keys.append((text[g] * space + own_a[:, None] * self.size_b + own_b).ravel())
            times.append((many_a[:, None] * many_b).ravel())
        keys, times = np.concatenate(keys), np.concatenate(times)
        if len(times) == len(a):
            keys.sort()
        else:
            order = np.argsort(keys, kind="stable")
            keys, times = keys[order], times[order]
        new = np.flatnonzero(np.diff(keys, prepend=-1))
        totals = np.add.reduceat(times, new) if len(new) else times
        return keys[new] // space, keys[new] % space, totals


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


_DOCUMENT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def align_documents(docs: DataFrame, path_a: str, path_b: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per block of documents: what aligning gives for each, and the linked id pairs.

    Columns: block (a random 63-bit number), documents (doc_id, n_a, n_b, n_groups, n_links,
    groups_sha256), a, b and docs (the distinct linked id pairs of the block, with the number of
    its documents that hold each linked), and for each document the entries from first[i] up to
    first[i + 1] of place (which pair) and links (how often).
    """
    kinds = pa.schema(
        [
            ("block", pa.int64()),
            (
                "documents",
                pa.list_(
                    pa.struct(
                        [(k, pa.int64()) for k in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
                        + [("groups_sha256", pa.string())]
                    )
                ),
            ),
            ("a", pa.list_(pa.int32())),
            ("b", pa.list_(pa.int32())),
            ("docs", pa.list_(pa.int32())),
            ("first", pa.list_(pa.int32())),
            ("place", pa.list_(pa.int32())),
            ("links", pa.list_(pa.int64())),
        ]
    )

    def run(batches):
        own = aligner(path_a, path_b)
        for batch in _blocks(batches, block_bytes):
            n_a, n_b, groups, *tokens = own.align([t or "" for t in column(batch, "text").to_pylist()])
            ends = np.append(0, np.cumsum(tokens[2] * tokens[3]))
            at = np.append(0, np.cumsum(groups))
            n_links = np.diff(ends[at])
            digests = [hashlib.sha256(s).hexdigest() if s else "" for s in own.spelled(groups, *tokens)]
            text, pair, links = own.pairs(groups, *tokens)
            pairs, place, many = np.unique(pair, return_inverse=True, return_counts=True)
            first = np.searchsorted(text, np.arange(len(groups) + 1))
            documents = pa.StructArray.from_arrays(
                [column(batch, "doc_id"), *[pa.array(x, pa.int64()) for x in (n_a, n_b, groups, n_links)], pa.array(digests)],
                fields=list(kinds.field("documents").type.value_type),
            )
            whole = [pairs // own.size_b, pairs % own.size_b, many, first, place, links]
            lists = [_one(documents), *[_one(pa.array(x, f.type.value_type)) for x, f in zip(whole, list(kinds)[2:])]]
            yield pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().int >> 65], pa.int64()), *lists], schema=kinds)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run,
        f"block long, documents array<struct<{_DOCUMENT.replace(' ', ':').replace(',:', ', ')}>>, a array<int>, "
        "b array<int>, docs array<int>, first array<int>, place array<int>, links array<long>",
    )


def _one(values):
    """A list column of one row."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _blocks(batches, most):
    """Batches put together, or cut, to about `most` bytes of text."""
    held, size = [], 0
    for batch in bounded(batches, most=most):
        n = column(batch, "text").nbytes
        if held and size + n > most:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += n
    if held:
        yield pa.concat_batches(held)


def aligned_documents(docs: DataFrame, path_a: str, path_b: str, *, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document.

    Both tokenizers encode a blank and the text. Byte offsets at which tokens of both end cut the
    tokens into groups; a link is an a and a b occurrence in one group. The count of an id pair is
    the number of documents (rows) that hold it linked. n_best counts the links whose pair has the
    highest count of its a id, ties included; count_sum adds the counts over all links.

    Texts that are null or empty, or that one of the tokenizers does not give back byte by byte,
    have zeros and an empty digest, and count for no pair. Rows that repeat a doc_id are documents
    of their own; extra columns are ignored; an empty table gives no rows.

    Documents are aligned once, in blocks of bounded text, and written. A block meets the counts
    with each of its distinct pairs once, so a pair of every document costs a row per block, and
    the join can be split; the counts come back to a block as one group of bounded size.
    """
    spark = docs.sparkSession
    path = work_path(spark, "aligned")
    blocks = save(align_documents(docs, path_a, path_b, block_bytes), path, wide=True)
    held = blocks.select("block", F.explode(F.arrays_zip("a", "b", "docs")).alias("p")).select("block", "p.a", "p.b", "p.docs")
    counts = held.groupBy("a", "b").agg(F.sum("docs").alias("count"))
    counts = save(counts, work_path(spark, "pair-counts"))
    best = counts.groupBy("a").agg(F.max("count").alias("most"))
    facts = counts.join(best, "a").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))
    found = held.join(facts, ["a", "b"]).select("block", "a", "b", "count", "best")
    kinds = pa.schema([(k, pa.int64()) for k in COLUMNS[:-1]] + [(COLUMNS[-1], pa.string())])

    def sums(block, pairs):
        found = pairs.select(["a", "b", "count", "best"]).sort_by([("a", "ascending"), ("b", "ascending")])
        count = found.column("count").to_numpy()
        best = found.column("best").to_numpy().astype(np.int64)
        row = {name: block.column(name).combine_chunks() for name in ("documents", "first", "place", "links")}
        documents = row["documents"].flatten()
        first, place, links = (row[k].flatten().to_numpy().astype(np.int64) for k in ("first", "place", "links"))

        def by_document(values):
            return pa.array(np.diff(np.append(0, np.cumsum(values))[first]), pa.int64())

        own = {f.name: documents.field(f.name) for f in documents.type}
        own |= {"n_best": by_document(links * best[place]), "count_sum": by_document(links * count[place])}
        return pa.Table.from_arrays([own[k] for k in COLUMNS], schema=kinds)

    # Read anew: the two sides of a cogroup must not share columns.
    wide = spark.read.schema(blocks.schema).parquet(path).select("block", "documents", "first", "place", "links")
    schema = ", ".join(f"{k} {'string' if k == COLUMNS[-1] else 'long'}" for k in COLUMNS)
    return wide.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(sums, schema)


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
