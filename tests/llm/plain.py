"""Plain versions of what the operators compute, and the frame that their tests share."""

import glob
import re

import pyarrow.parquet as pq
import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    return WORD.findall(text or "")


def shingles(text, width=5):
    """The distinct shingles of a text by the plain definition."""
    w = words(lower(text or ""))
    if len(w) >= width:
        return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}
    return {tuple(w)} if w else set()


def row_groups(folder):
    """Rows of each row group of the Parquet files of a folder."""
    files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{folder}/*.parquet")]
    return [m.row_group(i).num_rows for m in files for i in range(m.num_row_groups)]


@pytest.fixture
def documents(spark):
    """A frame of documents from (doc_id, text) pairs, with a column of a clashing name."""

    def make(pairs):
        rows = [(i, t, "en", "src", len(t or ""), 1) for i, t in pairs]
        return spark.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, n_chars long, n int"
        )

    return make
