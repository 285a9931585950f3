import io

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from plain import documents  # noqa: F401

from barloom.llm import packing, wavelet
from barloom.llm.encode import ChunkEncoder

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
ENCODERS = {f: ChunkEncoder(public_tokenizers.path(f), most=50) for f in FILES}
TEXT = st.text(st.sampled_from(list(" \n\t\r\x85\xa0\x1c aAbé'stΣ1.,!?-<|>́日")) | st.characters(codec="utf-8"), max_size=60)


LIBRARY = {f: Tokenizer.from_file(public_tokenizers.path(f)) for f in FILES}


def whole(name, text):
    return LIBRARY[name].encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=300, deadline=None)
@given(texts=st.lists(TEXT, max_size=4))
def test_chunks_encode_as_the_whole(name, texts):
    own = ENCODERS[name]
    assert [np.frombuffer(b, own.dtype).tolist() for b in own.encode(texts)] == [whole(name, t) for t in texts]


@pytest.mark.parametrize("name", FILES)
def test_strings_of_special_tokens(name):
    texts = ["x <|endoftext|> y", "<|startoftext|>", "a <|endoftext|><|endoftext|>\n b", "<|ENDOFTEXT|> z", None]
    own = ChunkEncoder(public_tokenizers.path(name))
    assert [np.frombuffer(b, own.dtype).tolist() for b in own.encode(texts)] == [whole(name, t) for t in texts]
    plain = ChunkEncoder(public_tokenizers.path(name), plain=True)
    library = Tokenizer.from_file(public_tokenizers.path(name))
    library.encode_special_tokens = True
    expected = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(b, own.dtype).tolist() for b in plain.encode(texts)] == expected


@settings(max_examples=60, deadline=None)
@given(ids=st.lists(st.integers(0, 49999) | st.integers(0, 5), max_size=300))
def test_shard_access_count_find(ids):
    array = np.array(ids, dtype="<u2")
    shard = wavelet.Shard(io.BytesIO(wavelet.build(array, {"doc_id": [None], "n": [len(ids)], "before": [0]})))
    assert shard.decode().tolist() == ids
    assert [shard.access(i) for i in range(0, len(ids), 7)] == ids[::7]
    for token in {*ids[:5], 3, 60000}:
        assert shard.count(token) == ids.count(token)
        assert shard.count(token, len(ids) // 3, len(ids) // 2) == ids[len(ids) // 3 : len(ids) // 2].count(token)
        places = [i for i, x in enumerate(ids) if x == token]
        assert [shard.find(token, k) for k in range(len(places))] == places


def test_shard_of_several_blocks():
    ids = np.random.default_rng(1).integers(0, 40000, 100_000).astype("<u2")
    ids[::3] = 7
    shard = wavelet.Shard(io.BytesIO(wavelet.build(ids, {})))
    assert (shard.decode() == ids).all()
    assert [shard.access(i) for i in (0, 32767, 32768, 99_999)] == ids[[0, 32767, 32768, 99_999]].tolist()
    assert shard.count(7) == (ids == 7).sum()
    assert [shard.find(7, k) for k in (0, 20_000, 33_333)] == np.flatnonzero(ids == 7)[[0, 20_000, 33_333]].tolist()


DOCS = [(5, "Hello <|endoftext|> world. It's é."), (2, None), (2, ""), (None, "x"), (9, "One two. " * 3000), (7, "a\tb  c\n\nd"), (7, "a\tb  c\n\nd"), (11, "z" * 5000)]


@pytest.mark.parametrize("size", [50, 1 << 21])
def test_shards_of_documents(documents, folder, size):
    path = public_tokenizers.path(FILES[0])
    manifest = wavelet.write_shards(documents(DOCS), path, folder, end_id=2, shard_tokens=size)
    got = sorted(wavelet.read_shards(manifest).collect(), key=lambda r: r.start)
    expected, start = [], 0
    for doc_id, text in sorted(DOCS, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or "")):
        ids = [*whole(FILES[0], text), 2]
        expected.append((doc_id, start, len(ids), np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert [(r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in got] == expected


def test_no_documents(documents, folder):
    none = documents(DOCS).limit(0)
    assert wavelet.read_shards(wavelet.write_shards(none, public_tokenizers.path(FILES[0]), folder)).count() == 0
    assert packing.pack(none, public_tokenizers.path(FILES[1])).count() == 0


def cost(places, costs, cuts, window):
    at, total = 0, 0
    for c in cuts:
        n = c - at
        assert 0 < n <= window
        total += (0 if n & (n - 1) == 0 and 16 * n >= window else window - n) + packing.PER_SEQUENCE
        total += costs[places.index(c)]
        at = c
    return total


@settings(max_examples=150, deadline=None)
@given(gaps=st.lists(st.tuples(st.integers(1, 30), st.sampled_from([0, 4, 24])), min_size=1, max_size=12))
def test_cuts_are_the_best(gaps):
    window = 32
    places = np.cumsum([g for g, _ in gaps]).tolist()
    costs = [c for _, c in gaps]
    best = None
    for mask in range(1 << (len(places) - 1)):
        cuts = [p for k, p in enumerate(places[:-1]) if mask >> k & 1] + [places[-1]]
        if max(np.diff([0, *cuts])) <= window:
            value = cost(places, costs, cuts, window)
            best = value if best is None else min(best, value)
    got = packing.best_cuts(np.array(places), np.array(costs), window)
    assert got[-1] == places[-1] and cost(places, costs, got, window) == best


@pytest.mark.parametrize("window,block", [(2048, 1 << 20), (64, 500), (2048, 100)])
def test_every_id_once(documents, window, block):
    path = public_tokenizers.path(FILES[1])
    rows = packing.pack(documents(DOCS).coalesce(1), path, window=window, block=block).collect()
    ids_of = {}
    for r in rows:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert len(ids) == r.length > 0
        ids_of.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, ids))
    got = sorted((k[0], tuple(x for _, ids in sorted(v) for x in ids)) for k, v in ids_of.items() if k[0] not in (2, 7, None))
    want = sorted((d, (*whole(FILES[1], t), 1)) for d, t in DOCS if d not in (2, 7, None))
    assert got == want
    assert sum(r.length for r in rows) == sum(len(whole(FILES[1], t)) + 1 for _, t in DOCS)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by.values():
        pieces.sort()
        assert [o for o, _ in pieces] == np.cumsum([0, *[n for _, n in pieces]])[:-1].tolist()
        assert sum(n for _, n in pieces) <= window


def test_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").coalesce(1)
    rows = packing.pack(docs, public_tokenizers.path(FILES[1])).groupBy("sequence_id").sum("length").collect()
    sizes = [r[1] for r in rows]
    padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in sizes)
    assert padding < 0.01 * sum(sizes) + 2048
