"""Token shards as wavelet matrices: bit planes with rank and select in one compressed file."""

from __future__ import annotations

import io
import json
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import work_path
from .common import bounded, column, save, storage
from .encode import encoder

MAGIC = b"WAVEMTX1"
#: Bits of a plane that are compressed together; ranks are kept at the start of each block.
BLOCK_BITS = 1 << 15
SHARD_TOKENS = 1 << 21


def build(ids: np.ndarray, docs: dict[str, list]) -> bytes:
    """The file of one shard.

    Planes go from the highest bit to the lowest; each plane orders the ids for the next one by
    its bit, zeros first. Behind a JSON header (numbers of ids and bits, zeros by plane, and for
    each section its place) lie the tables of the documents and, by plane, the starts of its
    blocks, the ones before each block, and the compressed blocks.
    """
    n = len(ids)
    bits = max(1, int(ids.max()).bit_length()) if n else 1
    parts, sections, at = [], {}, 0

    def put(name, data):
        nonlocal at
        sections[name] = (at, len(data))
        parts.append(data)
        at += len(data)

    put("docs", zlib.compress(json.dumps(docs).encode(), 1))
    zeros, current = [], ids
    for plane in range(bits):
        one = (current & current.dtype.type(1 << (bits - 1 - plane))) != 0
        bytes_of = np.packbits(one)
        packed = bytes_of.tobytes()
        size = BLOCK_BITS // 8
        blocks = [zlib.compress(packed[i : i + size], 1) for i in range(0, len(packed), size)]
        counts = np.bitwise_count(bytes_of)
        ones = np.add.reduceat(counts, np.arange(0, len(counts), size), dtype=np.int64) if n else np.zeros(0, np.int64)
        put(f"starts{plane}", np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype("<u8").tobytes())
        put(f"ranks{plane}", np.concatenate([[0], np.cumsum(ones)]).astype("<u8").tobytes())
        put(f"blocks{plane}", b"".join(blocks))
        zeros.append(n - int(ones.sum()))
        if plane < bits - 1:
            current = np.concatenate([current.take(np.flatnonzero(~one)), current.take(np.flatnonzero(one))])
    header = json.dumps({"n": n, "bits": bits, "zeros": zeros, "sections": sections, "dtype": ids.dtype.str}).encode()
    return b"".join([MAGIC, len(header).to_bytes(4, "little"), header, *parts])


class Shard:
    """Random access to a shard: reads of a seekable file touch only the blocks they need."""

    def __init__(self, file):
        self.file = file
        if file.read(len(MAGIC)) != MAGIC:
            raise ValueError("not a wavelet shard")
        size = int.from_bytes(file.read(4), "little")
        head = json.loads(file.read(size))
        self.n, self.bits, self.zeros = head["n"], head["bits"], head["zeros"]
        self.dtype = np.dtype(head["dtype"])
        self.sections, self.base = head["sections"], len(MAGIC) + 4 + size
        self.tables, self.blocks = {}, {}

    def section(self, name, start=0, stop=None):
        at, size = self.sections[name]
        self.file.seek(self.base + at + start)
        return self.file.read((size if stop is None else stop) - start)

    def docs(self):
        """doc_ids, ids of each document in this shard, ids of it in shards before."""
        return json.loads(zlib.decompress(self.section("docs")))

    def table(self, name):
        if name not in self.tables:
            self.tables[name] = np.frombuffer(self.section(name), "<u8").astype(np.int64)
        return self.tables[name]

    def block(self, plane, k):
        """The bits of block k of a plane; the last sixty-four blocks asked for are kept."""
        if (plane, k) not in self.blocks:
            if len(self.blocks) >= 64:
                self.blocks.pop(next(iter(self.blocks)))
            starts = self.table(f"starts{plane}")
            data = zlib.decompress(self.section(f"blocks{plane}", int(starts[k]), int(starts[k + 1])))
            count = min(BLOCK_BITS, self.n - k * BLOCK_BITS)
            self.blocks[plane, k] = np.unpackbits(np.frombuffer(data, np.uint8), count=count)
        return self.blocks[plane, k]

    def ones(self, plane, i):
        """Ones before place i of a plane."""
        k, rest = divmod(i, BLOCK_BITS)
        before = int(self.table(f"ranks{plane}")[k])
        return before + (int(self.block(plane, k)[:rest].sum()) if rest else 0)

    def place(self, plane, bit, rank):
        """The place of the zero or one of a plane that has `rank` of its kind before it."""
        ranks = self.table(f"ranks{plane}")
        if not bit:
            ranks = np.minimum(np.arange(len(ranks)) * BLOCK_BITS, self.n) - ranks
        k = int(np.searchsorted(ranks, rank, side="right")) - 1
        hits = np.flatnonzero(self.block(plane, k) == bit)
        return k * BLOCK_BITS + int(hits[rank - int(ranks[k])])

    def access(self, i):
        """The id at place i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for plane in range(self.bits):
            k, rest = divmod(i, BLOCK_BITS)
            bit = int(self.block(plane, k)[rest])
            ones = self.ones(plane, i)
            i = self.zeros[plane] + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, token, start, stop):
        for plane in range(self.bits):
            a, b = self.ones(plane, start), self.ones(plane, stop)
            if token >> (self.bits - 1 - plane) & 1:
                start, stop = self.zeros[plane] + a, self.zeros[plane] + b
            else:
                start, stop = start - a, stop - b
        return start, stop

    def count(self, token, start=0, stop=None):
        """How often a token occurs in [start, stop)."""
        if not 0 <= token < 1 << self.bits or not self.n:
            return 0
        a, b = self._range(token, start, self.n if stop is None else stop)
        return b - a

    def find(self, token, rank):
        """The place of the occurrence of a token with `rank` occurrences before it."""
        if not 0 <= rank < self.count(token):
            raise IndexError(rank)
        i = self._range(token, 0, self.n)[0] + rank
        for plane in reversed(range(self.bits)):
            bit = token >> (self.bits - 1 - plane) & 1
            i = self.place(plane, bit, i - self.zeros[plane] if bit else i)
        return i

    def decode(self):
        """All ids, plane by plane from the lowest."""
        out = np.zeros(self.n, dtype=self.dtype)
        for plane in reversed(range(self.bits)):
            starts, data = self.table(f"starts{plane}").tolist(), self.section(f"blocks{plane}")
            raw = b"".join(zlib.decompress(data[a:b]) for a, b in zip(starts, starts[1:]))
            one = np.unpackbits(np.frombuffer(raw, np.uint8), count=self.n).view(bool)
            above = np.empty_like(out)
            zeros = self.zeros[plane]
            above[np.flatnonzero(~one)] = out[:zeros]
            above[np.flatnonzero(one)] = out[zeros:] | self.dtype.type(1 << (self.bits - 1 - plane))
            out = above
        return out


def write_shards(
    docs: DataFrame, tokenizer: str, root: str | None = None, *, end_id: int = 2, shard_tokens: int = SHARD_TOKENS
) -> DataFrame:
    """Encode documents in ascending doc_id order into shards; returns the manifest, a row per part.

    Columns: part (parts follow the order of ids), root, paths (shards of the part in order),
    tokens, documents. Null and empty texts are the end id alone. Null ids come first; rows that
    repeat an id follow each other, ordered by text; extra columns are ignored; an empty table
    gives no parts.

    Texts are dealt out by ranges of doc_id and hash, so parts follow the order of ids without one
    task seeing all, and an id of many rows is split. A part becomes as many shards as its ids need; a document may go on in the next
    shard. A worker holds the ids of one shard. Files of a failed attempt are in no manifest.
    """
    root = root or work_path(docs.sparkSession, "wavelet")

    def write(batches):
        fs, folder = storage(root)
        fs.create_dir(f"{folder}/shards", recursive=True)
        own = encoder(tokenizer)
        end = np.array([end_id], own.dtype).tobytes()
        paths, held, size, table = [], [], 0, {"doc_id": [], "n": [], "before": []}
        tokens = documents = 0

        def flush():
            nonlocal held, size, table
            path = f"{folder}/shards/{uuid.uuid4().hex}.wmx"
            with fs.open_output_stream(path, compression=None) as out:
                out.write(build(np.frombuffer(b"".join(held), own.dtype), table))
            paths.append(path)
            held, size, table = [], 0, {"doc_id": [], "n": [], "before": []}

        for batch in bounded(batches, most=1_000_000):
            found = own.encode(column(batch, "text").to_pylist())
            for doc_id, ids in zip(column(batch, "doc_id").to_pylist(), found):
                ids += end
                total, before = len(ids) // own.dtype.itemsize, 0
                while before < total:
                    n = min(total - before, shard_tokens - size)
                    width = own.dtype.itemsize
                    held.append(ids[before * width : (before + n) * width])
                    table["doc_id"].append(doc_id)
                    table["n"].append(n)
                    table["before"].append(before)
                    before, size = before + n, size + n
                    if size == shard_tokens:
                        flush()
                tokens, documents = tokens + total, documents + 1
        if held:
            flush()
        if paths:
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([TaskContext.get().partitionId()], pa.int32()),
                    "paths": [paths],
                    "tokens": [tokens],
                    "documents": [documents],
                }
            )

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    manifest = (
        # The ranges are found from a sample of keys, so a hash stands for the text there.
        rows.repartitionByRange("doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
        .mapInArrow(write, "part int, paths array<string>, tokens long, documents long")
        .withColumn("root", F.lit(root))
    )
    return save(manifest, f"{root}/manifest")


def read_shards(manifest: DataFrame) -> DataFrame:
    """Documents from their shards: doc_id, start (ids of all documents before), n_tokens, ids.

    `ids` are little-endian unsigned 32-bit. A part's shards are read in order by one task, which
    holds one shard and one document.
    """
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per part: the running total is over a table as small as the number of tasks.
    parts = manifest.withColumn("base", F.coalesce(F.sum("tokens").over(order), F.lit(0)))
    kinds = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]
    )

    def read(batches):
        for batch in batches:
            for root, paths, base in zip(*(column(batch, c).to_pylist() for c in ("root", "paths", "base"))):
                fs, _ = storage(root)
                rows, held, open_doc = [], 0, None
                for path in paths:
                    with fs.open_input_file(path) as file:
                        shard = Shard(io.BytesIO(file.read()))
                    ids, at, docs = shard.decode().astype("<u4"), 0, shard.docs()
                    for doc_id, n, before in zip(docs["doc_id"], docs["n"], docs["before"]):
                        piece = ids[at : at + n].tobytes()
                        at += n
                        if before:
                            open_doc[3].append(piece)
                            continue
                        if open_doc:
                            rows.append(closed(open_doc))
                            base += rows[-1][2]
                            held += len(rows[-1][3])
                        open_doc = [doc_id, base, 0, [piece]]
                        if held > 8_000_000:
                            yield as_batch(rows)
                            rows, held = [], 0
                if open_doc:
                    rows.append(closed(open_doc))
                if rows:
                    yield as_batch(rows)

    def closed(doc):
        ids = b"".join(doc[3])
        return doc[0], doc[1], len(ids) // 4, ids

    def as_batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds.types)], schema=kinds)

    parts = parts.select("root", "paths", "base")
    return parts.repartition(max(1, manifest.count())).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids binary"
    )
