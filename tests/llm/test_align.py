import hashlib
from bisect import bisect_left
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from plain import documents, row_groups  # noqa: F401

from barloom.llm import align
from barloom.llm.encode import byte_letters

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LIBRARY_A = Tokenizer.from_file(A)
LIBRARY_A.encode_special_tokens = True
LIBRARY_B = SentencePieceProcessor(model_file=B)
BYTE_OF = {letter: b for b, letter in byte_letters().items()}


def tokens(text):
    """(id, bytes) of both tokenizers by the libraries alone; two empty lists for a text that does not come back."""
    if not text:
        return [], []
    a = LIBRARY_A.encode(" " + text, add_special_tokens=False)
    own_a = [(i, t.translate(BYTE_OF).encode("latin-1")) for i, t in zip(a.ids, a.tokens)]
    own_b = []
    for i in LIBRARY_B.encode(text):
        p = LIBRARY_B.id_to_piece(i)
        own_b.append((i, bytes([int(p[3:5], 16)]) if LIBRARY_B.is_byte(i) else p.replace("▁", " ").encode()))
    whole = b" " + text.encode()
    if any(b"".join(t for _, t in own) != whole for own in (own_a, own_b)):
        return [], []
    return own_a, own_b


def groups(text):
    """The groups by walking over the bytes: lists of (ids of a, ids of b)."""
    own_a, own_b = tokens(text)
    ends_a, ends_b = (set(np.cumsum([len(t) for _, t in own]).tolist()) for own in (own_a, own_b))
    out, at = [], [0, 0]
    for end in sorted(ends_a & ends_b):
        both = []
        for k, own in enumerate((own_a, own_b)):
            done = sum(len(t) for _, t in own[: at[k]])
            ids = []
            while done < end:
                ids.append(own[at[k]][0])
                done += len(own[at[k]][1])
                at[k] += 1
            both.append(ids)
        out.append(both)
    return out


def brute_force(texts):
    """Rows of (n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) by occurrence pairs."""
    cut = [groups(t) for t in texts]
    links = [[(a, b) for own_a, own_b in g for a in own_a for b in own_b] for g in cut]
    count = Counter(pair for own in links for pair in set(own))
    most = {}
    for (a, _), n in count.items():
        most[a] = max(n, most.get(a, 0))
    for g, own in zip(cut, links):
        spelled = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        yield (
            sum(len(a) for a, _ in g),
            sum(len(b) for _, b in g),
            len(g),
            len(own),
            sum(count[p] == most[p[0]] for p in own),
            sum(count[p] for p in own),
            hashlib.sha256(spelled.encode()).hexdigest() if spelled else "",
        )


TEXTS = [
    "Hello world, it's 12345 unhappiness!",
    "  two  blanks\n\n\tand tabs ",
    None,
    "",
    " ",
    "naïve Straße 日本語 🙂🙂 é",
    "a ▁ is given back as a blank",
    "<s> <|endoftext|> </s> plain strings",
    "x" * 3000 + " =====\x00\x85",
    "Hello world, it's 12345 unhappiness!",
]
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("block_bytes", [40, 3_000_000])
def test_against_brute_force(documents, block_bytes):
    docs = documents([(i if i != 4 else None, t) for i, t in enumerate(TEXTS)] + [(3, "repeated id")])
    got = align.aligned_documents(docs, A, B, block_bytes=block_bytes)
    assert got.columns == ["doc_id", *COLUMNS]
    expected = list(brute_force([*TEXTS, "repeated id"]))
    ids = [i if i != 4 else None for i in range(len(TEXTS))] + [3]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(i, *e) for i, e in zip(ids, expected)], key=repr)
    assert expected[6][:2] == (0, 0) and expected[7][0] > 0


def test_blocks_are_read_a_few_at_a_time(documents, monkeypatch, tmp_path):
    """A file of many blocks has row groups of a few: a reader holds no more however long the file is."""
    monkeypatch.setattr(align, "work_path", lambda spark, label: str(tmp_path / label))
    docs = documents([(i, f"text number {i}") for i in range(40)]).coalesce(1)
    assert align.aligned_documents(docs, A, B, block_bytes=1).count() == 40
    found = row_groups(tmp_path / "aligned")
    assert sum(found) == 40 and max(found) <= 4


def test_no_documents(documents):
    assert align.aligned_documents(documents([(1, "x")]).limit(0), A, B).count() == 0


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(60)
    rows = docs.collect()
    got = {r.doc_id: tuple(r)[1:] for r in align.aligned_documents(docs, A, B).collect()}
    assert got == {r.doc_id: e for r, e in zip(rows, brute_force([r.text for r in rows]))}


@settings(max_examples=200, deadline=None)
@given(texts=st.lists(st.text(st.sampled_from(list(" \n\tab's.,1▁é日🙂")) | st.characters(codec="utf-8"), max_size=40), max_size=4))
def test_groups(texts):
    own = align.aligner(A, B)
    n_a, n_b, n_groups, *found = own.align(texts)
    expected = [groups(t) for t in texts]
    assert n_groups.tolist() == [len(g) for g in expected]
    spelled = [";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g).encode() for g in expected]
    assert own.spelled(n_groups, *found) == spelled


@settings(max_examples=200, deadline=None)
@given(st.data())
def test_gallop(data):
    ascending = st.lists(st.integers(1, 5), min_size=1, max_size=60).map(lambda d: np.cumsum(d))
    driver, into = data.draw(ascending), data.draw(ascending)
    start = np.array(data.draw(st.lists(st.integers(0, len(into) - 1), min_size=len(driver), max_size=len(driver))))
    assert align.gallop(driver, into, start).tolist() == [bisect_left(into.tolist(), x) for x in driver.tolist()]


def test_wide_groups_count_as_narrow_ones(monkeypatch):
    own = align.aligner(A, B)
    n = np.array([7, 0, 5])
    ids = np.arange(12) % 5
    tokens = (np.array([2, 0, 1]), ids, ids[::-1].copy(), np.array([3, 4, 5]), np.array([4, 3, 5]))
    narrow = [x.tolist() for x in own.pairs(*tokens)]
    monkeypatch.setattr(align, "WIDE", 12)
    assert [x.tolist() for x in own.pairs(*tokens)] == narrow and sum(narrow[2]) == 12 + 12 + 25 and n.sum() == 12
