"""Helpers shared by the operators: table access, words, shingle hashes, batches of bounded size."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import DataFrame, SparkSession

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
SHINGLE = 5

_ODD = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    dtype=np.uint64,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that each hold millions of values: a reader decodes a row group up to 4096 rows at a time, and
#: the writer of one looks at its size every 100 rows unless it is told to look at each.
WIDE_ROWS = {
    "parquet.block.size": str(8 << 20),
    "parquet.block.row.count.limit": "4",
    "parquet.page.size.row.check.min": "1",
    "parquet.page.size.row.check.max": "1",
}


def save(df: DataFrame, path: str, codec: str | None = None, wide: bool = False) -> DataFrame:
    """Write a step's result to the shared folder and read it back: later steps never repeat it.

    With `wide` rows, a row group holds a few of them, so what a reader holds does not grow with the file.
    """
    writer = df.write.mode("overwrite").options(**(WIDE_ROWS if wide else {}))
    (writer if codec is None else writer.option("compression", codec)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded(batches, text="text", most=4_000_000):
    """Arrow batches cut into row slices of about `most` bytes of text, one row at least."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0)
        total = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = total[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(total, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def mix(h):
    """Finalizer that spreads the bits of 64-bit hashes."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_codes(texts, lower=True):
    """(code of each word, first word of each text plus the end, distinct words); null is no text.

    Words are those of WORD, with A-Z lower-cased.
    """
    texts = pc.fill_null(texts, "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    encoded = flat.dictionary_encode()
    words = encoded.dictionary.to_pylist()
    codes = encoded.indices.to_numpy(zero_copy_only=False)
    if "" not in words:
        return codes, offsets - offsets[0], words
    # Leading and trailing white space leaves empty pieces.
    full = codes != words.index("")
    ends = np.concatenate([[0], np.cumsum(full)])
    return codes[full], ends[offsets - offsets[0]], words


def hashes_of(words):
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), dtype=np.uint64, count=len(words))


def word_hashes(texts, lower=True):
    """(hash of each word, first word of each text plus the end) of a string array."""
    codes, starts, words = word_codes(texts, lower)
    return (hashes_of(words)[codes] if words else np.zeros(0, np.uint64)), starts


def shingle_sets(texts, width=SHINGLE):
    """Sorted distinct 64-bit shingle hashes of each text.

    A text of fewer words than `width` has one shingle, its whole sequence; one without words has none.
    """
    hashes, starts = word_hashes(texts)
    combined = np.zeros(max(0, len(hashes) - width + 1), dtype=np.uint64)
    for k in range(width):
        combined += hashes[k : k + len(combined)] * _ODD[k]
    combined = mix(combined)
    sets = []
    for start, stop in zip(starts[:-1].tolist(), starts[1:].tolist()):
        n = stop - start
        if n >= width:
            sets.append(np.unique(combined[start : stop - width + 1]))
        elif n:
            whole = (hashes[start:stop] * _ODD[:n]).sum(dtype=np.uint64) + np.uint64(n)
            sets.append(mix(np.array([whole], dtype=np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def storage(uri: str):
    """(file system, path) of a folder of the shared store, usable inside tasks."""
    if "://" not in uri and not uri.startswith("file:"):
        uri = "file://" + uri
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return pafs.FileSystem.from_uri(uri)


def fresh(name: str, taken) -> str:
    """A column name like `name` that none of `taken` equals, in any case."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name += "_"
    return name


def column(batch: pa.RecordBatch, name: str):
    return batch.column(batch.schema.get_field_index(name))
