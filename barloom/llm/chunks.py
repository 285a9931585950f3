"""Passages that repeat across documents, by content-defined chunks of a gear rolling hash."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import work_path
from .common import bounded, column, fresh, save

#: Bytes that the rolling hash looks back over.
REACH = 32
#: One byte in so many ends a chunk, unless another one did less than `LEAST` bytes before.
AVERAGE = 32
LEAST = 8
#: Staged chunks and runs are mostly ascending numbers, which this packs closer than the default.
CODEC = "zstd"
GEAR = np.frombuffer(
    b"".join(xxhash.xxh32_digest(bytes([b]), seed=1) for b in range(256)), dtype="<u4"
).astype(np.uint32)


def gear_hashes(data: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """h(i) = 2 h(i-1) + GEAR[byte i] in 32 bits, so a byte is forgotten after 32 more.

    `fresh` marks the places of padding between texts, which add nothing.
    """
    h = GEAR[data]
    h[fresh] = 0
    step = 1
    while step < REACH:
        # Sums over twice the reach: the second half, shifted past the first.
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
        step *= 2
    return h


def cut_texts(texts, average=AVERAGE, least=LEAST):
    """Chunks of all texts (bytes each), as arrays: text number, start, end, first and last word.

    A chunk ends behind a byte at which the hash is small, where no other byte of the last `least`
    has a small one: whether a place is a border depends on the REACH + least bytes before it alone. Two
    copies of a passage thus have the same borders from there on, whatever stands before them.

    `first` and `last` bound the words (from first, before last) of any passage that holds the
    chunk and neither of its neighbours whole: it begins at most REACH + least bytes before the chunk in
    front of it, and ends in the one behind it.
    """
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    data = np.frombuffer(bytes(REACH).join([b"", *texts, b""]), dtype=np.uint8)
    starts = np.cumsum(sizes + REACH) - sizes
    ends = starts + sizes
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    np.add.at(inside, starts, 1)
    np.add.at(inside, ends, -1)
    padding = np.cumsum(inside[:-1]) == 0
    hits = np.flatnonzero((gear_hashes(data, padding) < np.uint32(2**32 // average)) & ~padding) + 1
    cuts = hits[np.diff(hits, prepend=-least) >= least]
    full = sizes > 0
    border = np.unique(np.concatenate([starts[full], cuts, ends[full]]))
    text = np.searchsorted(starts, border, side="right") - 1
    chunk = np.flatnonzero(border < ends[text])
    text, start, end = text[chunk], border[chunk], border[chunk + 1]
    begun, ended = word_counts(data, padding)
    new = np.diff(text, prepend=-1) > 0
    before = np.where(new, start, np.roll(start, 1))
    behind = np.where(np.roll(new, -1), end, np.roll(end, -1))
    first = begun[np.maximum(before - REACH - least, starts[text])] - begun[starts[text]]
    last = ended[behind] - ended[starts[text]]
    return data, text, start, end, first, last


def word_counts(data, padding):
    """For each place the number of words that begin before it, and of those that have ended there."""
    word = ~((data == 32) | ((data >= 9) & (data <= 13)) | padding)
    changes = np.diff(word.astype(np.int8), prepend=0, append=0)
    begun = np.append(0, np.cumsum(changes == 1))
    return begun[:-1], np.cumsum(changes == -1)


def row_marks(texts):
    return np.array([xxhash.xxh64_intdigest(t) for t in texts], np.uint64).view(np.int64)


def longs(names):
    return pa.schema([(c, pa.int64()) for c in names]), ", ".join(f"`{c}` long" for c in names)


def cut_table(docs: DataFrame, words: int) -> DataFrame:
    """A row per document of `words` words or more: its text's hash, extent and chunks.

    Columns: doc_id, row (hash of the text), start and end of all its words in code points, words,
    and for each chunk its digest and the first and last word that `cut_texts` gives.
    """
    kinds = pa.schema(
        [(c, pa.int64()) for c in ("doc_id", "row", "start", "end", "words")]
        + [("digest", pa.list_(pa.int64())), ("first", pa.list_(pa.int32())), ("last", pa.list_(pa.int32()))]
    )

    def run(batches):
        for batch in bounded(batches, most=1_000_000):
            texts = [t.encode("utf-8") for t in pc.fill_null(column(batch, "text"), "").to_pylist()]
            data, text, start, end, first, last = cut_texts(texts)
            view = memoryview(data)
            digest = [xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(start.tolist(), end.tolist())]
            at = np.searchsorted(text, np.arange(len(texts) + 1))
            outline = np.array([extent(t) for t in texts], dtype=np.int64).reshape(-1, 3).T
            lists = [
                pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(x, k))
                for x, k in (
                    (np.array(digest, np.uint64).view(np.int64), pa.int64()), (first, pa.int32()), (last, pa.int32()),
                )
            ]
            whole = [column(batch, "doc_id"), pa.array(row_marks(texts)), *[pa.array(x) for x in outline], *lists]
            rows = pa.RecordBatch.from_arrays(whole, schema=kinds)
            yield rows.filter(pa.array(outline[2] >= words))

    schema = "doc_id long, row long, start long, end long, words long, digest array<long>, first array<int>, last array<int>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def extent(text: bytes):
    """Start and end in code points of all words of a text, and their number."""
    words = text.split()
    if not words:
        return 0, 0, 0
    # bytes.split parts at the same characters as words do.
    begin = len(text) - len(text.lstrip())
    end = len(text.rstrip())
    return len(text[:begin]), len(text[:end].decode("utf-8")), len(words)


def word_places(text):
    """The text in UTF-8, first bytes and ends of its words, and the code points before each byte."""
    body = text.encode("utf-8")
    data = np.frombuffer(body, dtype=np.uint8)
    word = ~((data == 32) | ((data >= 9) & (data <= 13)))
    changes = np.diff(word.astype(np.int8), prepend=0, append=0)
    begins, ends = np.flatnonzero(changes == 1), np.flatnonzero(changes == -1)
    return body, begins, ends, np.append(0, np.cumsum((data & 0xC0) != 0x80))


def run_table(docs: DataFrame, words: int) -> DataFrame:
    """A row per run of `words` words in the `spans` of documents: its first word, place and digest."""
    kinds, schema = longs(["doc_id", "row", "at", "start", "end", "digest"])

    def run(batches):
        for batch in bounded(batches, most=250_000):
            ids, marks = column(batch, "doc_id"), column(batch, "row")
            for i, (text, spans) in enumerate(zip(column(batch, "text"), column(batch, "spans").to_pylist())):
                body, begins, ends, points = word_places(text.as_py())
                at = np.unique(np.concatenate([np.arange(s["first"], s["last"] - words + 1) for s in spans]))
                start, end = begins[at], ends[at + words - 1]
                pieces = [xxhash.xxh3_64_intdigest(body[a:b]) for a, b in zip(start.tolist(), end.tolist())]
                of = pa.array(np.full(len(at), i))
                found = [at, points[start], points[end], np.array(pieces, np.uint64).view(np.int64)]
                yield pa.RecordBatch.from_arrays(
                    [ids.take(of), marks.take(of), *[pa.array(x) for x in found]], schema=kinds
                )

    return docs.select("doc_id", "row", "text", "spans").mapInArrow(run, schema)


def repeated_passages(docs: DataFrame, *, min_words: int = 45) -> DataFrame:
    """Passages of a document that are found in another one too.

    Columns: doc_id, row (hash of the text), start, end (code points, of whole words), n_chunks,
    n_words, first_doc_id, is_first. A passage is all runs of `min_words` words, blanks between
    them included, that another document has byte by byte, where they overlap or touch; n_chunks
    counts these runs. `is_first` holds where no run of it is in a document before (by doc_id,
    then by the text's hash): there it is kept when repeats are dropped, elsewhere first_doc_id
    names the earliest document with one of its runs.

    Null and empty texts have no chunks; rows that repeat doc_id and text are one document; equal
    texts under different ids repeat each other; repeats within one document alone are not listed;
    extra columns are ignored; an empty table gives no rows.

    Texts are cut by their content (see `cut_texts`), and chunks deduplicated by digest. Every
    chunk that two different texts hold is a candidate; neighbouring ones are joined, extended
    over the chunk on either side, and kept where that has `min_words` words. What is in them is
    then compared exactly, run by run. A passage is missed only if no whole chunk lies in it
    behind its first REACH + LEAST bytes (the README has the measured share), as in text that
    repeats itself every few bytes. Equal texts repeat each other whole.

    Texts are cut once and written. Digests are counted with a combine before the shuffle; copies
    of a text are combined before its chunks are put in order; the joins split skewed digests.
    """
    spark = docs.sparkSession
    of_text = Window.partitionBy("row")
    cut = save(cut_table(docs, min_words), work_path(spark, "cuts"), CODEC)
    outlines = cut.select("doc_id", "row", "start", "end", "words")
    texts = outlines.groupBy("row").agg(
        F.min(F.struct("doc_id")).alias("least"),
        F.max(F.struct("doc_id")).alias("largest"),
        F.first("start").alias("start"),
        F.first("end").alias("end"),
        F.first("words").alias("words"),
    )
    texts = texts.select(
        "row", "start", "end", "words", F.col("least.doc_id").alias("doc_id"),
        (~F.col("least").eqNullSafe(F.col("largest"))).alias("many"),
    )

    shared = cut.select("row", F.explode("digest").alias("digest"))
    shared = shared.groupBy("digest").agg(F.min("row").alias("a"), F.max("row").alias("b")).where("a <> b")
    shared = save(shared.select("digest"), work_path(spark, "chunks"), CODEC)
    chunks = cut.select("row", F.posexplode(F.arrays_zip("digest", "first", "last")).alias("number", "chunk"))
    chunks = chunks.select("row", "number", "chunk.digest", "chunk.first", "chunk.last")
    hits = chunks.join(shared, "digest").groupBy("row", "number").agg(
        F.min("first").alias("first"), F.max("last").alias("last")
    )
    spans = (
        hits.withColumn("run", F.col("number") - F.row_number().over(of_text.orderBy("number")))
        .groupBy("row", "run")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"))
        .where(F.col("last") - F.col("first") >= min_words)
        .groupBy("row")
        .agg(F.collect_list(F.struct("first", "last")).alias("spans"))
        .join(texts.select("row", F.col("doc_id").alias("__doc_id")), "row")
    )
    same = F.col("doc_id").eqNullSafe(F.col("__doc_id")) & (F.col("__hash") == F.col("row"))
    runs = run_table(row_hashes(docs.select("doc_id", "text"), "__hash").join(spans, same), min_words)
    runs = save(runs, work_path(spark, "runs"), CODEC)

    shared = (
        runs.groupBy("digest")
        .agg(F.min(F.struct("doc_id", "row")).alias("first"), F.min("row").alias("a"), F.max("row").alias("b"))
        .where("a <> b")
    )
    shared = save(shared.select("digest", "first"), work_path(spark, "shared-runs"), CODEC)
    step = F.col("at") - F.lag("at").over(of_text.orderBy("at"))
    parts = (
        runs.drop("doc_id")
        .join(shared, "digest")
        .withColumn("step", step)
        .withColumn("part", F.count(F.when(F.col("step") > min_words, 1)).over(of_text.orderBy("at")))
        .groupBy("row", "part")
        .agg(
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            F.count(F.when(F.col("step").isNull() | (F.col("step") > 0), 1)).alias("n_chunks"),
            (F.max("at") - F.min("at") + min_words).alias("n_words"),
            F.min("first").alias("first"),
        )
    )
    parts = save(parts, work_path(spark, "passages"), CODEC)

    passages = parts.join(texts.where(~F.col("many")).select("row"), "row").drop("part")
    earlier = parts.groupBy("row").agg(F.min("first").alias("earlier"))
    # least() leaves out nulls, and a null id inside the struct comes before all others.
    first = F.least("earlier", F.struct("doc_id", "row"))
    whole = texts.where("many").join(earlier, "row", "left").select(
        "row", "start", "end", (F.col("words") - min_words + 1).alias("n_chunks"), F.col("words").alias("n_words"),
        first.alias("first"),
    )
    found = passages.unionByName(whole).join(outlines.select("doc_id", "row").distinct(), "row")
    return found.select(
        "doc_id",
        "row",
        "start",
        "end",
        "n_chunks",
        "n_words",
        F.col("first.doc_id").alias("first_doc_id"),
        F.col("first").eqNullSafe(F.struct("doc_id", "row")).alias("is_first"),
    )


def drop_passages(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """The documents with passages cut out of their texts wherever is_first does not hold.

    All columns stay, whatever their names; null and empty texts and rows of no passage stay as
    they are; rows that repeat doc_id and text are cut alike; an empty table stays empty.
    """
    row, of_row, of_id, spans = (fresh(n, docs.columns) for n in ("row", "of_row", "of_id", "spans"))
    wanted = (
        passages.where(~F.col("is_first"))
        .groupBy(F.col("doc_id").alias(of_id), F.col("row").alias(of_row))
        .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias(spans))
    )
    schema = docs.schema

    def cut(batches):
        for batch in batches:
            texts = []
            for text, parts in zip(column(batch, "text").to_pylist(), column(batch, spans).to_pylist()):
                for part in reversed(parts or []):
                    text = text[: part["start"]] + text[part["end"] :]
                texts.append(text)
            at = batch.schema.get_field_index("text")
            kept = batch.set_column(at, "text", pa.array(texts, batch.schema.field(at).type))
            yield kept.select([f.name for f in schema])

    same = F.col("doc_id").eqNullSafe(F.col(of_id)) & (F.col(row) == F.col(of_row))
    joined = row_hashes(docs, row).join(wanted, same, "left")
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], spans).mapInArrow(cut, schema)


def row_hashes(docs: DataFrame, name: str) -> DataFrame:
    """`docs` with the hash of the text that cut_table uses, under `name`."""

    def run(batches):
        for batch in bounded(batches):
            texts = pc.fill_null(column(batch, "text"), "").to_pylist()
            marks = row_marks([t.encode("utf-8") for t in texts])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(marks)], names=[*batch.schema.names, name])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{fields}, `{name}` long")
