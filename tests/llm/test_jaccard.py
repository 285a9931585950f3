import random
from collections import defaultdict

import pytest

from plain import documents, shingles  # noqa: F401

from barloom.llm import jaccard
from barloom.llm.jaccard import keep_one
from barloom.llm.graph import components


def brute(docs):
    """Rows by the plain definition: sets, all pairs that share a shingle, union of the linked."""
    sets = [shingles(t) for _, t in docs]
    by = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            by[x].append(i)
    parent = list(range(len(docs)))

    def top(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    shared = defaultdict(int)
    for members in by.values():
        for k, j in enumerate(members):
            for i in members[:k]:
                shared[i, j] += 1
    for (i, j), n in shared.items():
        if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
            parent[top(i)] = top(j)
    least = defaultdict(lambda: None)
    for i, (d, _) in enumerate(docs):
        r = top(i)
        if d is not None and (least[r] is None or d < least[r]):
            least[r] = d
    return sorted(((d, len(sets[i]), least[top(i)]) for i, (d, _) in enumerate(docs)), key=repr)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = "".join(rng.choices("xyzw", k=7))
    return " ".join(words)


def corpus():
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(1, 5)))
    text = lambda n: [word() for _ in range(n)]
    out = []
    # Many copies edited more or less, with the original and without it; small groups; a chain.
    base, lost = text(150), text(200)
    out.append(" ".join(base))
    out += [edited(rng, base, rng.randint(0, 8)) for _ in range(90)]
    out += [edited(rng, lost, rng.randint(1, 7)) for _ in range(80)]
    for _ in range(30):
        b = text(rng.choice([1, 3, 4, 5, 6, 7, 9, 12, 20, 60, 150]))
        out += [edited(rng, b, rng.randint(0, 2)) for _ in range(rng.randint(1, 6))]
    chain = text(120)
    for _ in range(12):
        chain = chain[3:] + text(3)
        out.append(" ".join(chain))
    # A passage in very many documents, most of a document in some.
    line = " ".join(text(14))
    out += [f"{' '.join(text(rng.choice([2, 4, 40])))} {line.upper()}" for _ in range(150)]
    # Sets that differ in order or repetition only.
    out += [f"{line} {line}", f"{line} {line} {line}"] + [" ".join(base)] * 40
    out += ["", " \n", None, "one", "ONE", "one two", "one two three four five", " one\ttwo three four\nfive "]
    rng.shuffle(out)
    docs = [(i * 3 % 1000, t) for i, t in enumerate(out)]
    return [*docs, docs[0], (docs[1][0], docs[2][1]), (None, out[3]), (None, "alone and null here"), (None, None)]


@pytest.mark.parametrize("limits", [{}, {"SHORT": 2, "FREQUENT": 3, "BLOCK": 8, "FLUSH": 2000}, {"SHORT": 10_000, "FREQUENT": 10_000}])
def test_against_brute_force(documents, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(jaccard, name, value)
    docs = corpus()
    got = jaccard.jaccard_components(documents(docs)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(docs)


def test_no_documents(documents):
    assert jaccard.jaccard_components(documents([(1, "a")]).limit(0)).count() == 0
    rows = jaccard.jaccard_components(documents([(4, None), (4, ""), (None, " ")])).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=repr) == [(4, 0, 4), (4, 0, 4), (None, 0, None)]


@pytest.mark.parametrize("n,m", [(1, 1), (3, 4), (4, 3), (100, 75), (100, 74), (600, 600)])
def test_prefixes_hold_a_shared_shingle(n, m):
    # A linked partner lacks at most prefix_size - 1 shingles of a set.
    most_missing = max((k for k in range(n + 1) if jaccard._linked(n - k, n, n - k)), default=0)
    assert jaccard.prefix_size(n) == most_missing + 1


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (7, 7), (300, -5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in range(100, 160)} == {100}
    assert got[202] == 200 and got[300] == -5
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_one_with_names_that_clash(documents):
    frame = documents([(1, "a b c"), (2, "a b c"), (3, "x y")]).withColumnsRenamed({"lang": "set_id", "n": "Set_Node", "source": "__id"})
    got = keep_one(frame)
    assert got.columns == frame.columns and sorted(r.doc_id for r in got.collect()) == [1, 3]
