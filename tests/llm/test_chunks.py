import random
import re

import numpy as np

from plain import documents  # noqa: F401

from barloom.llm import chunks
from barloom.llm.chunks import GEAR, cut_texts, drop_passages, extent, gear_hashes, repeated_passages
from barloom.llm.common import save


def prose(rng, n):
    return " ".join("".join(rng.choices("aeioubcdtré", k=rng.randint(2, 8))) for _ in range(n))


def test_hash_by_the_recurrence():
    data = np.frombuffer(bytes(range(256)) * 3, np.uint8)
    got, h = gear_hashes(data, np.zeros(len(data), bool)), 0
    for i, b in enumerate(data.tolist()):
        h = (h << 1) + int(GEAR[b]) & 0xFFFFFFFF
        assert h == got[i]


def test_chunks_cover_texts_and_do_not_depend_on_company():
    rng = random.Random(1)
    texts = [t.encode() for t in ["", "é", prose(rng, 300), "日" * 400, "a" * 1000, prose(rng, 3), " \n "]]
    data, text, start, end, first, last = cut_texts(texts)
    for k, whole in enumerate(texts):
        own = text == k
        pieces = [data[a:b].tobytes() for a, b in zip(start[own], end[own])]
        assert b"".join(pieces) == whole
        alone = cut_texts([whole])
        assert [alone[0][a:b].tobytes() for a, b in zip(alone[2], alone[3])] == pieces
        assert (alone[4].tolist(), alone[5].tolist()) == (first[own].tolist(), last[own].tolist())
        assert (last[own] <= len(whole.split())).all() and extent(whole)[2] == len(whole.split())


def test_borders_resist_insertions():
    """Behind the bytes that the hash looks back over, a copy is cut as the original."""
    rng = random.Random(3)
    for _ in range(50):
        passage = prose(rng, 80).encode()
        ends = []
        for lead in (b"", prose(rng, rng.randint(1, 60)).encode() + b" "):
            data, text, start, end, *_ = cut_texts([lead + passage + b" " + prose(rng, 9).encode()])
            at = end - 32 - len(lead)
            ends.append([e for e in at.tolist() if 40 <= e <= len(passage)])
        assert ends[0] == ends[1] and len(ends[0]) > 3


def corpus():
    rng = random.Random(2)
    shared, line = [prose(rng, 60) for _ in range(5)], prose(rng, 9) + "."
    docs, planted = [], {}
    for i in range(60):
        parts = [prose(rng, rng.randint(30, 200)), line, prose(rng, rng.randint(1, 90))]
        if i % 4 == 0:
            parts.insert(rng.randrange(4), shared[i // 4 % 5])
            planted[i] = i // 4 % 5
        docs.append((i, "\n".join(parts)))
    return docs, shared, planted


def test_planted_passages_are_found_and_clean_documents_left(documents):
    docs, shared, planted = corpus()
    rows = repeated_passages(documents([*docs, docs[0], (99, None), (98, "")])).collect()
    assert {r.doc_id for r in rows} == set(planted)
    text = dict(docs)
    for r in rows:
        assert text[r.doc_id][r.start : r.end].strip() in shared[planted[r.doc_id]]
        first = min(d for d, k in planted.items() if k == planted[r.doc_id])
        assert r.first_doc_id == first and r.is_first == (r.doc_id == first)


def test_dropping_keeps_the_first(documents):
    docs, shared, planted = corpus()
    frame = documents([*docs, (None, docs[0][1]), (77, None)])
    got = drop_passages(frame, repeated_passages(frame))
    assert got.columns == frame.columns
    rows = {r.doc_id: r.text for r in got.collect()}
    # A null id comes before all others, so the copy under it is the first one.
    assert rows[None] == docs[0][1] and rows[0] == "" and rows[77] is None
    assert rows[1] == docs[1][1]
    assert len(rows[20]) < len(docs[20][1]) - 0.6 * len(shared[0])


def test_dropping_with_names_that_clash(documents, spark):
    docs, _, _ = corpus()
    frame = documents(docs).withColumnsRenamed({"lang": "spans", "source": "Row", "n": "__hash"})
    got = drop_passages(frame, repeated_passages(frame))
    assert got.columns == frame.columns and got.count() == len(docs)


def test_copies_are_one_text_before_their_chunks_are_ordered(documents):
    """Thousands of copies that share a passage with another text."""
    rng = random.Random(4)
    passage = prose(rng, 60)
    docs = [(i, "copied " + passage) for i in range(500)] + [(1000, prose(rng, 50) + " " + passage)]
    rows = repeated_passages(documents(docs)).collect()
    assert len(rows) == 501 and {r.first_doc_id for r in rows} == {0}


def test_empty_table(documents):
    assert repeated_passages(documents([(1, "x")]).limit(0)).count() == 0


def brute_passages(docs, words):
    """(doc_id, start, end) of the passages by the definition, run by run."""
    runs, at = {}, {}
    for d, text in docs:
        at[d] = [(m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
        for i in range(len(at[d]) - words + 1):
            runs.setdefault(text[at[d][i][0] : at[d][i + words - 1][1]], set()).add(d)
    out = []
    for d, text in docs:
        parts = []
        for i in range(len(at[d]) - words + 1):
            if len(runs[text[at[d][i][0] : at[d][i + words - 1][1]]]) > 1:
                if parts and i <= parts[-1][1]:
                    parts[-1][1] = i + words
                else:
                    parts.append([i, i + words])
        out += [(d, at[d][a][0], at[d][b - 1][1]) for a, b in parts]
    return sorted(out)


def test_passages_of_51_words_in_two_documents(documents):
    """What is found is exact; of passages of 51 words less than one in a hundred is missed."""
    rng = random.Random(5)
    docs = [(i, prose(rng, rng.randint(30, 150))) for i in range(1200)]
    for k in range(0, 1200, 2):
        passage = prose(rng, 51)
        for d in (k, k + 1):
            docs[d] = (d, docs[d][1] + "\n" + passage + "\n" + prose(rng, rng.randint(1, 90)))
    docs += [(1900, "a b " * 100), (1901, "b a " * 60 + "日 " * 50), (1902, "日 " * 44), (1903, "日 " * 45), (1904, "=" * 500)]
    rows = repeated_passages(documents(docs)).collect()
    expected = brute_passages(docs, 45)
    found = sorted((r.doc_id, r.start, r.end) for r in rows)
    assert set(found) <= set(expected)
    planted = [x for x in expected if x[0] < 1200]
    assert len(set(found) & set(planted)) >= 0.99 * len(planted) and len(planted) >= 1200
    assert all(r.n_words == len(dict(docs)[r.doc_id][r.start : r.end].split()) for r in rows)


def test_passages_by_brute_force(documents):
    rng = random.Random(6)
    pool = [prose(rng, 70) for _ in range(6)]
    docs = []
    for i in range(120):
        parts = [prose(rng, rng.randint(1, 40))]
        for _ in range(rng.randint(0, 3)):
            words = rng.choice(pool).split()
            a = rng.randint(0, 30)
            parts += [" ".join(words[a : a + rng.randint(10, 70)]), prose(rng, rng.randint(1, 9))]
        docs.append((i, " ".join(parts)))
    for words in (30, 45):
        rows = repeated_passages(documents(docs), min_words=words).collect()
        found, expected = {(r.doc_id, r.start, r.end) for r in rows}, set(brute_passages(docs, words))
        covered = lambda spans: {(d, p) for d, a, b in spans for p in range(a, b)}
        assert covered(found) <= covered(expected)
        assert len(covered(found)) >= 0.97 * len(covered(expected))


def test_staged_tables_are_packed(spark, documents, monkeypatch):
    codecs = []

    def noted(df, path, codec=None):
        codecs.append(codec)
        kept = save(df, path, codec)
        assert all(f.endswith(".zstd.parquet") for f in kept.inputFiles())
        return kept

    monkeypatch.setattr(chunks, "save", noted)
    words = " ".join(f"word{k * k}" for k in range(60))
    found = chunks.repeated_passages(documents([(1, f"one {words}"), (2, f"two {words}")]))
    assert {r.doc_id for r in found.collect()} == {1, 2} and codecs == ["zstd"] * len(codecs) != []
