"""Byte-pair encoding by dynamic programming over prefixes, and decoding, with a public vocabulary.

Of every prefix of a piece exactly one token can be the last one, because the encoding of a prefix
of an encoding is again one. An automaton over the vocabulary names the tokens that a prefix ends
with, longest first; the one that goes together with the last token of the prefix before it is
kept. The tokens of a piece are then read off from its end.
"""

from __future__ import annotations

import json
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, column
from .encode import ChunkEncoder, byte_letters


class _Table:
    """Numbers by non-negative 64-bit keys, looked up and put in whole arrays; at most half full."""

    def __init__(self, keys, values, bits=None):
        bits = bits or max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask, self.held = np.uint64(64 - bits), (1 << bits) - 1, 0
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
        self.put(np.asarray(keys, np.int64), np.asarray(values, np.int32))

    def _slots(self, keys):
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def put(self, keys, values):
        """Keys must be new and distinct."""
        self.held += len(keys)
        slots = self._slots(keys)
        while len(keys):
            free = self.keys[slots] < 0
            self.keys[slots[free]] = keys[free]
            placed = self.keys[slots] == keys
            self.values[slots[placed]] = values[placed]
            keys, values, slots = keys[~placed], values[~placed], (slots[~placed] + 1) & self.mask

    def get(self, keys):
        """The numbers, -1 for keys that are not held."""
        slots = self._slots(keys)
        found = self.keys[slots]
        out = np.where(found == keys, self.values[slots], -1)
        todo = np.flatnonzero((found != keys) & (found >= 0))
        while len(todo):
            slots[todo] = (slots[todo] + 1) & self.mask
            found = self.keys[slots[todo]]
            same = found == keys[todo]
            out[todo[same]] = self.values[slots[todo[same]]]
            todo = todo[~same & (found >= 0)]
        return out


class PrefixCoder:
    """The merges of a byte-level vocabulary as an automaton, and the prefix program over it."""

    #: Bits of the table of pair tests; it starts afresh when half full.
    PAIR_BITS = 20
    #: Pieces up to this length go through the program together, byte by byte; longer ones alone.
    TOGETHER = 48

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        if model["type"] != "BPE" or any(
            model.get(k)
            for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        ):
            raise ValueError(f"{path}: not a plain byte-level BPE")
        byte_of = {chr(letter): b for b, letter in byte_letters().items()}
        vocab = model["vocab"]
        self.size = max(vocab.values()) + 1
        self.bytes_of = [b""] * self.size
        for text, i in vocab.items():
            self.bytes_of[i] = bytes(byte_of[c] for c in text)
        rank, left, right, merges = [-1] * self.size, [-1] * self.size, [-1] * self.size, {}
        for r, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            token = vocab[a + b]
            a, b = vocab[a], vocab[b]
            if rank[token] >= 0 or r <= max(rank[a], rank[b]):
                raise ValueError(f"{path}: a token has two merges, or comes before its parts")
            rank[token], left[token], right[token] = r, a, b
            merges[a * self.size + b] = r
        self.rank, self.left, self.right = (np.array(x, np.int64) for x in (rank, left, right))
        self.end_of_time = len(merges)
        self.merges = _Table(list(merges), list(merges.values()))
        self._automaton()
        self._forget()

    def _automaton(self):
        """Steps between trie nodes, and for each node the longest token that its bytes end with."""
        steps, depth_of, own = {}, [0], [-1]
        node_of = [0] * self.size
        made = np.flatnonzero(self.rank >= 0)
        # A token that its own bytes do not encode as is never the last one.
        whole = self.rank < 0
        whole[made] = self._goes(self.left[made], self.right[made], self.rank[made])
        for token, text in enumerate(self.bytes_of):
            if not text or not whole[token]:
                continue
            node = 0
            for b in text:
                key = node << 8 | b
                below = steps.get(key)
                if below is None:
                    below = steps[key] = len(own)
                    own.append(-1)
                    depth_of.append(depth_of[node] + 1)
                node = below
            own[node], node_of[token] = token, node
        if any(b not in steps or own[steps[b]] < 0 for b in range(256)):
            raise ValueError("some byte is no token")
        # A node falls back on the node of its longest proper suffix; shallow nodes come first.
        fall, longest, beyond = [0] * len(own), own[:], [-1] * len(own)
        for key, node in sorted(steps.items(), key=lambda step: depth_of[step[1]]):
            parent, b = key >> 8, key & 255
            if parent:
                at = fall[parent]
                while (at << 8 | b) not in steps and at:
                    at = fall[at]
                fall[node] = steps.get(at << 8 | b, 0)
            beyond[node] = longest[fall[node]]
            if own[node] < 0:
                longest[node] = beyond[node]
        self.steps = _Table(list(steps), list(steps.values()))
        self.fall, self.longest = np.array(fall, np.int64), np.array(longest, np.int64)
        self.shorter = np.array([beyond[n] for n in node_of], np.int64)
        self.length = np.array([len(text) for text in self.bytes_of], np.int64)

    def _forget(self):
        self.fits = _Table([], [], self.PAIR_BITS)

    def _goes(self, a, b, until):
        """Whether, before merge `until`, no merge joins bytes of token a with those of b behind it.

        The parts at the border are undone from the last merge backwards. A merge of the two parts
        that face each other happens if it comes before either is used up in a larger part of its
        own token; at equal rank the place further left comes first.
        """
        out = np.ones(len(a), dtype=bool)
        above_a = np.broadcast_to(until, len(a)).copy()
        above_b, pairs = above_a.copy(), np.arange(len(a))
        while len(pairs):
            merge = self.merges.get(a * self.size + b)
            joined = (merge >= 0) & (merge < above_a) & (merge <= above_b)
            out[pairs[joined]] = False
            rank_a, rank_b = self.rank[a], self.rank[b]
            on = ~joined & ((rank_a >= 0) | (rank_b >= 0))
            undo_a = rank_a > rank_b
            above_a, above_b = np.where(undo_a, rank_a, above_a)[on], np.where(undo_a, above_b, rank_b)[on]
            a, b = np.where(undo_a, self.right[a], a)[on], np.where(undo_a, b, self.left[b])[on]
            pairs = pairs[on]
        return out

    def _step(self, nodes, b):
        """The node of the longest suffix that some token begins with, after one byte more."""
        out = self.steps.get(nodes << 8 | b)
        todo = np.flatnonzero(out < 0)
        nodes = nodes[todo]
        while len(todo):
            # Every byte is a token, so the root always has a step.
            nodes = self.fall[nodes]
            found = self.steps.get(nodes << 8 | b[todo])
            out[todo] = found
            todo, nodes = todo[found < 0], nodes[found < 0]
        return out.astype(np.int64)

    def _fit(self, pairs):
        """Whether the second token of each pair can follow the first as the last one."""
        fit = self.fits.get(pairs)
        new = np.unique(pairs[fit < 0])
        if len(new):
            if self.fits.held + len(new) > 1 << self.PAIR_BITS - 1:
                self._forget()
                new = np.unique(pairs)
            goes = self._goes(new // self.size, new % self.size, self.end_of_time)
            if len(new) <= 1 << self.PAIR_BITS - 1:
                self.fits.put(new, goes.astype(np.int32))
                return self.fits.get(pairs) > 0
            return goes[np.searchsorted(new, pairs)]
        return fit > 0

    def last_tokens(self, pieces):
        """For pieces from the longest to the shortest, as rows by byte: the last token of each prefix."""
        lengths = np.array([len(p) for p in pieces])
        width = int(lengths[0])
        bytes_at = np.frombuffer(b"".join(p.ljust(width) for p in pieces), np.uint8).reshape(-1, width)
        bytes_at = np.ascontiguousarray(bytes_at.T).astype(np.int64)
        last, nodes = np.zeros(bytes_at.shape, np.int64), np.zeros(len(pieces), np.int64)
        for end in range(width):
            live = int(np.searchsorted(-lengths, -end))
            nodes = self._step(nodes[:live], bytes_at[end, :live])
            tokens = self.longest[nodes]
            before = end - self.length[tokens]
            todo = np.flatnonzero(before >= 0)
            while len(todo):
                token = tokens[todo]
                fit = self._fit(last[before[todo], todo] * self.size + token)
                todo, token = todo[~fit], self.shorter[token[~fit]]
                tokens[todo], before[todo] = token, end - self.length[token]
                todo = todo[before[todo] >= 0]
            last[end, :live] = tokens
        return last, lengths

    def encode_pieces(self, pieces, dtype="<u4") -> list[bytes]:
        """The ids of each piece of the split text, bytes each, as numbers of `dtype`."""
        order = sorted(range(len(pieces)), key=lambda i: len(pieces[i]), reverse=True)
        out = [b""] * len(pieces)
        long = 0
        while long < len(order) and len(pieces[order[long]]) > self.TOGETHER:
            out[order[long]] = self._alone(pieces[order[long]]).astype(dtype).tobytes()
            long += 1
        order = [i for i in order[long:] if pieces[i]]
        if not order:
            return out
        last, lengths = self.last_tokens([pieces[i] for i in order])
        # Read off from the end of all pieces together: owners and tokens, the last ones first.
        at, row, owners, tokens = lengths - 1, np.arange(len(order)), [], []
        while len(row):
            token = last[at, row]
            owners.append(row)
            tokens.append(token)
            at = at - self.length[token]
            row, at = row[at >= 0], at[at >= 0]
        owners, tokens = np.concatenate(owners[::-1]), np.concatenate(tokens[::-1])
        ids = tokens[np.argsort(owners, kind="stable")].astype(dtype)
        ends = np.cumsum(np.bincount(owners, minlength=len(order))) * ids.itemsize
        flat, start = ids.tobytes(), 0
        for i, end in zip(order, ends.tolist()):
            out[i] = flat[start:end]
            start = end
        return out

    def _alone(self, piece: bytes):
        """The same program for one long piece."""
        size, fits, steps = self.size, {}, {}
        last, node = [], 0
        length, longest, shorter = self.length.tolist(), self.longest.tolist(), self.shorter.tolist()
        for end, b in enumerate(piece):
            key = node << 8 | b
            node = steps.get(key)
            if node is None:
                node = steps[key] = int(self._step(np.array([key >> 8]), np.array([b]))[0])
            token = longest[node]
            while length[token] <= end:
                pair = last[end - length[token]] * size + token
                fit = fits.get(pair)
                if fit is None:
                    fit = fits[pair] = bool(self._fit(np.array([pair]))[0])
                if fit:
                    break
                token = shorter[token]
            last.append(token)
            if len(fits) + len(steps) > 1 << self.PAIR_BITS:
                fits, steps = {}, {}
        at, ids = len(piece) - 1, []
        while at >= 0:
            ids.append(last[at])
            at -= length[last[at]]
        return np.array(ids[::-1], np.int64)


class PrefixEncoder(ChunkEncoder):
    """Encodes texts as the library does, with the prefix program in place of its merges.

    The library's splitting rule makes the pieces; strings of special tokens get their own ids,
    unless `plain`. What recurs comes from the cache of chunks.
    """

    def __init__(self, path: str, most: int = 300_000, plain: bool = False):
        super().__init__(path, most, plain)
        rule = json.loads(self.tokenizer.to_str())["pre_tokenizer"]
        if not self.exact or not rule or rule["type"] != "ByteLevel" or rule["add_prefix_space"]:
            raise ValueError(f"{path}: texts are not split by the byte-level rule alone")
        self.coder = PrefixCoder(path)
        self.byte_of = {letter: b for b, letter in byte_letters().items()}
        self.added = {
            t.content: array(self.code, [i]).tobytes()
            for i, t in self.tokenizer.get_added_tokens_decoder().items()
        }

    def _merge(self, stems):
        self.known.update(zip(stems, self.coder.encode_pieces([s.encode("utf-8") for s in stems], self.dtype)))

    def _whole(self, texts, marked=False):
        split = [list(self._parts(t)) for t in texts]
        pieces = list({p for parts in split for p in parts if isinstance(p, bytes)})
        ids_of = dict(zip(pieces, self.coder.encode_pieces(pieces, self.dtype))) | self.added
        return [b"".join([ids_of[p] for p in parts]) for parts in split]

    def _parts(self, text):
        """The pieces between the special tokens' strings, as bytes, and these strings."""
        at = 0
        while True:
            found = [(text.find(m, at), -len(m), m) for m in self.marks]
            where, _, mark = min((f for f in found if f[0] >= 0), default=(len(text), 0, None))
            for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text[at:where]):
                yield self._spelled(piece)
            if mark is None:
                return
            yield mark
            at = where + len(mark)

    def _spelled(self, piece):
        """The bytes that a piece in letters of the vocabulary stands for."""
        return piece.translate(self.byte_of).encode("latin-1")


@lru_cache(maxsize=2)
def prefix_encoder(path: str, plain: bool = False) -> PrefixEncoder:
    """One encoder per worker and vocabulary; its cache lives as long as the worker."""
    return PrefixEncoder(path, plain=plain)


@lru_cache(maxsize=2)
def spellings(path: str) -> list:
    """The bytes of each id of a byte-level vocabulary, special tokens among them; one empty entry more."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    byte_of = {letter: b for b, letter in byte_letters().items()}

    def spelled(text):
        letters = [byte_of.get(ord(c)) for c in text]
        return text.encode("utf-8") if None in letters else bytes(letters)

    ids = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
    found = [b""] * (max(ids.values()) + 2)
    for text, i in ids.items():
        found[i] = spelled(text)
    return found


def encode_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids array<int>): the ids of every whole text, as the library gives them.

    Special tokens are not added; their strings in a text get their ids. Null and empty texts have
    no ids. Rows that repeat a doc_id, null ones among them, are encoded each; extra columns are
    ignored; an empty table gives no rows. There is no shuffle: batches of bounded size go through
    one encoder per worker, and a task run again gives the same rows.
    """
    kinds = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        own = prefix_encoder(tokenizer)
        for batch in bounded(batches):
            found = own.encode(column(batch, "text").to_pylist())
            ends = np.cumsum([0, *map(len, found)]) // own.dtype.itemsize
            flat = np.frombuffer(b"".join(found), own.dtype).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), ids], schema=kinds)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, ids array<int>"
    )


def decode_documents(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids, text): the text of each row's ids, special tokens among them.

    Bytes that are no UTF-8 become U+FFFD; ids that the vocabulary lacks are left out, as are null
    ones; a null list is an empty text. Other columns are ignored.
    """
    kinds = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("text", pa.string())])

    def run(batches):
        known = spellings(tokenizer)
        for batch in batches:
            # Rows by turns, so that the texts held are bounded by a few rows, not by the batch.
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                ids = column(part, "ids")
                sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy()
                flat = pc.fill_null(ids.flatten(), -1).to_numpy()
                flat = np.where((flat >= 0) & (flat < len(known) - 1), flat, len(known) - 1)
                ends, texts = np.cumsum(sizes), []
                for end, size in zip(ends.tolist(), sizes.tolist()):
                    spelled = b"".join(map(known.__getitem__, flat[end - size : end].tolist()))
                    texts.append(spelled.decode("utf-8", "replace"))
                columns = [column(part, "doc_id"), ids, pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, schema=kinds)

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")
