import random


from plain import documents, lower, shingles, words  # noqa: F401

from barloom.llm.contamination import contained_items, decontaminate, signature_size


def corpus(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcde", k=rng.randint(1, 6)))
    items = [" ".join(word() for _ in range(rng.choice([0, 2, 4, 5, 6, 9, 30, 70]))) for _ in range(40)] + [None, ""]
    docs = []
    for i in range(120):
        parts = [word() for _ in range(rng.choice([0, 3, 40, 400]))]
        if i % 2:
            item = (rng.choice(items) or "").split()
            for _ in range(rng.randint(0, 2)):
                if item:
                    item[rng.randrange(len(item))] = word()
            at = rng.randrange(len(parts) + 1)
            parts[at:at] = [w.upper() for w in item]
        docs.append(rng.choice([" ", "\n", " \t "]).join(parts))
    docs[3] = items[20]
    return [*enumerate(docs), (1, docs[1]), (None, docs[5]), (500, None), (501, "")], list(enumerate(items))


def brute(docs, items):
    out = []
    for d, text in docs:
        own = shingles(text)
        for i, item in items:
            wanted, plain, inside = shingles(item), words(lower(item or "")), words(lower(text or ""))
            if 0 < len(plain) < 5:
                # A short item is one shingle of its own length.
                if any(inside[k : k + len(plain)] == plain for k in range(len(inside))):
                    out.append((d, i, 1, 1))
            elif wanted and 4 * len(wanted & own) >= 3 * len(wanted):
                out.append((d, i, len(wanted), len(wanted & own)))
    return sorted(out, key=repr)


def test_against_brute_force(spark, documents):
    docs, items = corpus()
    table = spark.createDataFrame(items, "item_id long, text string")
    for most in (2_000_000, 400):
        rows = contained_items(documents(docs), table, most=most).collect()
        assert sorted(((r.doc_id, r.item_id, r.n_item, r.n_shared) for r in rows), key=repr) == brute(docs, items)
    kept = decontaminate(documents(docs), table, most=400)
    bad = {d for d, *_ in brute(docs, items)}
    assert sorted(map(repr, [r.doc_id for r in kept.collect()])) == sorted(repr(d) for d, _ in docs if d not in bad)
    assert kept.columns == documents(docs).columns


def test_empty_sides(spark, documents):
    docs, items = corpus()
    table = spark.createDataFrame(items, "item_id long, text string")
    assert contained_items(documents(docs), table.limit(0)).count() == 0
    assert contained_items(documents(docs).limit(0), table).count() == 0
    assert decontaminate(documents(docs), table.limit(0)).count() == len(docs)


def test_short_items_inside_longer_documents(spark, documents):
    docs = [(1, "x y Alpha  beta\nGAMMA z q"), (2, "alpha beta x gamma"), (3, "alphabeta gamma"), (4, "gamma"), (5, None)]
    items = [(1, "alpha beta gamma"), (2, "gamma"), (2, "gamma"), (3, ""), (4, "beta gamma delta")]
    found = contained_items(documents(docs), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r.doc_id, r.item_id) for r in found.collect()) == sorted(
        [(1, 1), *[(d, 2) for d in (1, 2, 3, 4) for _ in range(2)]]
    )


def test_equal_items_are_one_text(spark, documents):
    items = spark.createDataFrame([(i, "one two three four five six") for i in range(300)], "item_id long, text string")
    found = contained_items(documents([(1, "zero one two three four five six")]), items, most=10)
    assert sorted(r.item_id for r in found.collect()) == list(range(300))


def test_signature_sizes():
    for n in range(1, 300):
        for t in (0.5, 0.75, 0.9):
            missing = int((1 - t) * n + 1e-9)
            assert signature_size(n, t) > min(missing, n - 1)
