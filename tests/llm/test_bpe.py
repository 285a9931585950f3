import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from plain import documents  # noqa: F401

from barloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
TEXT = st.lists(
    st.sampled_from(list(" \n\t\r\x85\xa0\x1caAbé'stΣ1.,!?-<|>́日") + ["<|endoftext|>", "ing", "the "])
    | st.characters(codec="utf-8"),
    max_size=60,
).map("".join)


def library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("together", [48, 3])
@settings(max_examples=300, deadline=None)
@given(pieces=st.lists(st.text(st.sampled_from(list("aabeéhinorstz. =-0")), min_size=1, max_size=40), max_size=6))
def test_pieces_encode_as_the_merges_do(together, pieces):
    coder = bpe.prefix_encoder(PATH).coder
    coder.TOGETHER = together
    found = coder.encode_pieces([p.encode() for p in pieces])
    del coder.TOGETHER
    for p, ids in zip(pieces, found):
        letters = bpe.byte_letters()
        spelled = "".join(chr(letters[b]) for b in p.encode())
        assert list(memoryview(ids).cast("I")) == [t.id for t in LIBRARY.model.tokenize(spelled)]


@settings(max_examples=400, deadline=None)
@given(texts=st.lists(TEXT, max_size=4))
def test_texts_encode_as_by_the_library(texts):
    own = bpe.prefix_encoder(PATH)
    got = [list(memoryview(b).cast("H")) for b in own.encode(texts)]
    assert got == [library(t) for t in texts]
    known = bpe.spellings(PATH)
    assert [b"".join(known[i] for i in ids).decode("utf-8", "replace") for ids in got] == [
        LIBRARY.decode(ids, skip_special_tokens=False) for ids in got
    ]


def test_memories_start_afresh(monkeypatch):
    monkeypatch.setattr(bpe.PrefixCoder, "PAIR_BITS", 4)
    own = bpe.PrefixEncoder(PATH, most=20)
    for text in ["unhappiness of internationalization", "zzzzzz qqqq xyzzy", "unhappiness again"] * 2:
        assert list(memoryview(own.encode([text])[0]).cast("H")) == library(text)


TEXTS = ["Hello world. It's é.", None, "", "x <|endoftext|> y", "z" * 20_000, "One two. " * 3000, "a\tb  c\n\nd ", "日本語 🙂"]


def test_documents_there_and_back(documents):
    docs = documents([(i if i != 2 else None, t) for i, t in enumerate(TEXTS)] + [(0, "again"), (0, "again")])
    rows = bpe.decode_documents(bpe.encode_documents(docs, PATH), PATH).collect()
    expected = [(i if i != 2 else None, library(t), t or "") for i, t in enumerate([*TEXTS])] + [(0, library("again"), "again")] * 2
    assert sorted(map(tuple, rows), key=repr) == sorted(expected, key=repr)
    assert bpe.decode_documents(bpe.encode_documents(docs.limit(0), PATH), PATH).count() == 0


def test_any_ids_decode_as_by_the_library(spark):
    lists = [[50256, 262, 50256], [], [222, 255, 130], [70000, 262], None, [162, 245]]
    encoded = spark.createDataFrame(list(enumerate(lists)), "doc_id long, ids array<int>")
    got = {r.doc_id: r.text for r in bpe.decode_documents(encoded, PATH).collect()}
    assert got == {i: LIBRARY.decode(ids or [], skip_special_tokens=False) for i, ids in enumerate(lists)}


@pytest.mark.parametrize("name", ["word_bpe_49k.json"])
def test_other_kinds_of_vocabulary_are_refused(name):
    with pytest.raises(ValueError):
        bpe.PrefixEncoder(public_tokenizers.path(name))


def test_query_against_the_library(spark, tmp_path):
    from barloom.llm.queries import op13_bpe_prefix

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in op13_bpe_prefix(spark, str(tmp_path)).collect()}
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    expected = {}
    for r in docs.collect():
        ids = library(r.text)
        expected[r.doc_id] = (len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids, skip_special_tokens=False)))
    assert got == expected
