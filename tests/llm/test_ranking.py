import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plain import documents, lower, row_groups  # noqa: F401

from barloom.llm import ranking

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(lower(text or ""))


def brute_force(docs, items, k):
    """(item_id, rank, doc_id, score) by scoring every document for every item."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(bool(c) for _, c in counted)
    n_terms = sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    rows = []
    for item_id, text in items:
        scored = []
        for doc_id, c in counted:
            score = 0
            for t in terms(text):
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 100 - 25 + (25 * c.total() * n_docs) // n_terms
                    score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                scored.append((-score, doc_id is not None, doc_id or 0, doc_id))
        rows += [(item_id, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(rows, key=repr)


def search(docs, items, k=20, **sizes):
    index = ranking.build_index(docs, shard_bytes=sizes.pop("shard_bytes", ranking.SHARD_BYTES))
    found = ranking.best_documents(index, items, k=k, **sizes)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, found.collect()), key=repr)


@pytest.fixture
def benchmark(spark):
    return lambda pairs: spark.createDataFrame([(*p, 1) for p in pairs], "item_id long, text string, term string")


DOCS = [
    (1, "The cat, the CAT and the dog."),
    (2, None),
    (3, ""),
    (4, "...!"),
    (5, "dog dog_dog über Über straße"),
    (None, "the cat, the CAT and the dog."),
    (7, "cat " * 20_000 + "mouse"),
    *[(100 + i, "the same copy of a cat") for i in range(60)],
    (9, "mouse"),
    (9, "mouse"),
]
ITEMS = [(1, "Cat dog the the"), (2, None), (3, "?!"), (4, "absent words"), (5, "über mouse cat"), (5, "mouse"), (None, "mouse"), (6, "copy")]


@pytest.mark.parametrize("sizes", [{}, {"shard_bytes": 60, "block_bytes": 10}, {"shard_bytes": 400, "k": 3}])
def test_against_brute_force(documents, benchmark, sizes):
    got = search(documents(DOCS).repartition(3), benchmark(ITEMS), **sizes)
    assert got == brute_force(DOCS, ITEMS, sizes.get("k", 20))


def test_shards_are_read_a_few_at_a_time(documents, tmp_path):
    """A file of many shards has row groups of a few: a reader holds no more however long the file is."""
    docs = documents([(i, f"text number {i}") for i in range(40)]).coalesce(1)
    assert ranking.build_index(docs, str(tmp_path / "index"), shard_bytes=1).count() == 40
    found = row_groups(tmp_path / "index")
    assert sum(found) == 40 and max(found) <= 4


def test_empty_tables(documents, benchmark):
    docs, items = documents(DOCS), benchmark(ITEMS)
    assert search(docs.limit(0), items) == []
    assert search(docs, items.limit(0)) == []
    assert search(documents([(1, None)]), items) == []


def test_given_tables(spark):
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    expected = brute_force([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], 20)
    assert search(docs, items, shard_bytes=50_000) == expected


WORDS = st.lists(st.sampled_from(["a", "b", "c", "d", "e", "f"]), max_size=12).map(" ".join)


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(WORDS, min_size=1, max_size=80), item=WORDS, k=st.integers(1, 6), depth=st.integers(1, 3))
def test_search_of_one_shard(texts, item, k, depth):
    block = ranking.Block.of(["x"], [item])
    codes, starts, known = ranking.term_codes(pa.array(texts))
    n = np.diff(starts)
    keys, tf = np.unique(codes.astype(np.int64) * len(n) + np.repeat(np.arange(len(n)), n), return_counts=True)
    held, df = np.unique(keys // len(n), return_counts=True)
    shard = {
        "doc_id": pa.array(range(len(n))), "n": n, "terms": known.take(pa.array(held)).cast(pa.string()),
        "df": df, "places": keys % len(n), "tf": tf,
    }
    total_docs, total_terms = int((n > 0).sum()), int(n.sum())
    of = dict(zip(shard["terms"].to_pylist(), df.tolist()))
    weights = np.array([math.floor(1000 * math.log((2 * total_docs + 2) / (2 * of.get(t, 0) + 1))) for t in block.terms], dtype=np.int64)
    before, ranking.DEPTH = ranking.DEPTH, depth
    try:
        lists = ranking.Lists(shard, block, weights, total_docs, total_terms)
        places, scores = lists.best(block.wanted[0], k)
    finally:
        ranking.DEPTH = before
    got = sorted(zip((-scores).tolist(), places.tolist()))[:k]
    expected = brute_force(list(enumerate(texts)), [(0, item)], k)
    assert [(d, -s) for s, d in got] == [(d, s) for _, _, d, s in sorted(expected, key=lambda r: r[1])]


def test_a_search_stops_early():
    """Of a long list only the top is read where the next documents score strictly less."""
    n = 5000
    shard = {
        "doc_id": pa.array(range(n)), "n": np.full(n, 10), "terms": pa.array(["x"]),
        "df": np.array([n]), "places": np.arange(n), "tf": np.arange(n, 0, -1) % 4999 + 1,
    }
    lists = ranking.Lists(shard, ranking.Block.of(["x"], ["x"]), np.array([7]), n, 10 * n)
    read = []
    class Counted(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, slice):
                read.append(at.stop)
            return np.asarray(self)[at]
    lists.by_impact = lists.by_impact.view(Counted)
    places, _ = lists.best((np.array([0]), np.array([1])), 5)
    assert len(places) >= 5 and max(read) < 100
