"""Packing token streams into sequences by dynamic programming over document and sentence ends."""

from __future__ import annotations

from collections import deque
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, column
from .encode import encoder

#: Cost of a cut in units of one padding token.
AT_DOCUMENT, AT_SENTENCE, ELSEWHERE = 0, 4, 24
#: Cost of each sequence, so that short ones without padding are not taken for nothing.
PER_SEQUENCE = 8
#: Cuts that are neither at a document's nor a sentence's end are offered at this distance.
STRIDE = 64
BLOCK = 1 << 20


@lru_cache(maxsize=2)
def sentence_ends(path: str) -> np.ndarray:
    """By token id: whether the token ends a sentence or a line."""
    vocabulary = encoder(path).tokenizer.get_vocab()
    out = np.zeros(max(vocabulary.values()) + 2, dtype=bool)
    for token, i in vocabulary.items():
        out[i] = token.removesuffix("</w>").endswith((".", "!", "?", "Ċ"))
    return out


def candidates(ids, document_ends, ends_sentence):
    """(positions, costs) of the cuts on offer, ascending; positions count the ids before the cut."""
    cost = np.full(len(ids) + 1, -1, dtype=np.int8)
    marks = np.flatnonzero(ends_sentence[np.minimum(ids, len(ends_sentence) - 1)]) + 1
    cost[marks] = AT_SENTENCE
    cost[document_ends] = AT_DOCUMENT
    places = np.flatnonzero(cost >= 0)
    before = np.concatenate([[0], places])[: len(places)]
    wide = np.flatnonzero(places - before > STRIDE)
    for a, b in zip(before[wide].tolist(), places[wide].tolist()):
        cost[a + STRIDE : b : STRIDE] = ELSEWHERE
    cost[0] = -1
    places = np.flatnonzero(cost >= 0)
    return places, cost[places].astype(np.int64)


def best_cuts(places, costs, window):
    """The ends of the windows of least total cost that cover [0, last place).

    A window's cost is its padding to `window` (none at a power of two), PER_SEQUENCE, and that of
    the cut behind it. With f(i) the least cost up to place i, padding makes
    f(j) = cost(j) + window - place(j) + min over i of f(i) + place(i), a minimum over the places
    at most `window` before place(j): a monotone queue gives it in amortised constant time. The
    few power-of-two lengths are looked up besides. Ties go to the earlier place.
    """
    behind = {}
    for length in [1 << k for k in range(window.bit_length() - 1) if 16 << k >= window]:
        start = places - length
        k = np.searchsorted(places, start)
        hit = (start == 0) | ((k < len(places)) & (places[np.minimum(k, len(places) - 1)] == start))
        for j, i in zip(np.flatnonzero(hit).tolist(), np.where(start == 0, -1, k)[hit].tolist()):
            behind.setdefault(j, []).append(i)
    places, costs = places.tolist(), costs.tolist()
    queue, f, back = deque([(0, 0, -1)]), [0] * (len(places) + 1), [-1] * len(places)
    for j, (p, cut) in enumerate(zip(places, costs)):
        least = p - window
        while queue[0][1] < least:
            queue.popleft()
        value, _, i = queue[0]
        best = value - least
        if j in behind:
            for k in behind[j]:
                # f[-1] is that of the start, which is 0.
                if f[k] < best:
                    best, i = f[k], k
        total = best + cut + PER_SEQUENCE
        f[j], back[j] = total, i
        key = total + p
        while queue and queue[-1][0] > key:
            queue.pop()
        queue.append((key, p, j))
    out, j = [], len(places) - 1
    while j >= 0:
        out.append(places[j])
        j = back[j]
    return out[::-1]


class _Packer:
    """Packs one stream of documents; holds a block of ids and the window that is still open."""

    def __init__(self, window, ends_sentence, first):
        self.window, self.ends_sentence, self.next = window, ends_sentence, first
        self.docs = []  # (doc_id, ids from the open window on, ids of the document before them)
        self.held = 0

    def add(self, doc_id, ids):
        self.docs.append((doc_id, ids, 0))
        self.held += len(ids)

    def pack(self, last):
        """Pieces of all windows, or of all but the last one while the stream goes on."""
        ends = np.cumsum([len(ids) for _, ids, _ in self.docs])
        ids = np.concatenate([x for _, x, _ in self.docs])
        places, costs = candidates(ids, ends, self.ends_sentence)
        cuts = best_cuts(places, costs, self.window)
        done = cuts if last else cuts[:-1]
        rows = []
        if done:
            stop, begins = done[-1], np.array([0, *done[:-1]], dtype=np.int64)
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            edges = np.union1d(begins, starts[starts < stop])
            doc_of = np.searchsorted(ends, edges, side="right")
            window_of = np.searchsorted(begins, edges, side="right") - 1
            for a, b, d, w in zip(
                edges.tolist(), [*edges[1:].tolist(), stop], doc_of.tolist(), window_of.tolist()
            ):
                doc_id, own, before = self.docs[d]
                rows.append(
                    (
                        doc_id,
                        int(a - starts[d] + before),
                        b - a,
                        ids[a:b].astype("<u4").tobytes(),
                        before + len(own),
                        self.next + w,
                        int(a - begins[w]),
                    )
                )
            self.next += len(done)
            d = int(np.searchsorted(ends, stop, side="right"))
            rest = self.docs[d:]
            if rest:
                doc_id, own, before = rest[0]
                cut = int(stop - starts[d])
                # The cut document keeps the count of its ids that are already packed.
                rest[0] = (doc_id, own[cut:], before + cut)
            self.docs, self.held = rest, int(ends[-1] - stop)
        return rows


def pack(
    docs: DataFrame, tokenizer: str, *, window: int = 2048, end_id: int = 1, block: int = BLOCK
) -> DataFrame:
    """Pieces of token sequences of at most `window` ids that hold every id of every document once.

    Columns: doc_id, start (ids of the document before the piece), length, ids (little-endian
    unsigned 32-bit), doc_tokens (with `end_id`), sequence_id, offset (in the sequence, gapless).
    The order of documents within a partition is kept, and pieces follow it. Null and empty texts
    are the end id alone; rows that repeat a doc_id are packed each; extra columns are ignored; an
    empty table gives no rows.

    Each partition is one stream, without a shuffle: documents are encoded as they come and packed
    in blocks of `block` ids, of which the last window stays open. Sequence ids are the partition
    number times 2^33 plus a count, so no task waits for another and a task run again gives the
    same rows. The stream's last sequence is the only one that a partition's end may leave short.
    """
    kinds = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("start", pa.int64()),
            ("length", pa.int64()),
            ("ids", pa.binary()),
            ("doc_tokens", pa.int64()),
            ("sequence_id", pa.int64()),
            ("offset", pa.int64()),
        ]
    )

    def run(batches):
        own = encoder(tokenizer)
        packer = _Packer(window, sentence_ends(tokenizer), TaskContext.get().partitionId() << 33)
        for batch in bounded(batches, most=1_000_000):
            found = own.encode(column(batch, "text").to_pylist())
            for doc_id, ids in zip(column(batch, "doc_id").to_pylist(), found):
                ids = np.frombuffer(ids, own.dtype)
                packer.add(doc_id, np.append(ids, np.array(end_id, own.dtype)))
            if packer.held >= block:
                yield as_batch(packer.pack(last=False))
        if packer.docs:
            yield as_batch(packer.pack(last=True))

    def as_batch(rows):
        columns = zip(*rows) if rows else [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.types)], schema=kinds)

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run,
        "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long",
    )
