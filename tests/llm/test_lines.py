from collections import Counter

import pytest

from plain import WORD, documents  # noqa: F401

from barloom.llm.lines import clean_lines

LONG = " ".join(f"word{i}" for i in range(60)) + "."
TEXTS = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, LONG),
    (5, LONG),
    (6, "a b c a b c a b c " * 20 + "."),
    (7, LONG + "\n" + LONG + "\nshort\n\nshort\nCafé #1 $$ <b>"),
    (8, "Home | News | About | Contact\nHome | News | About | Contact\n" + LONG),
    (9, LONG[:-1] + " no end\n" + LONG[:-1].replace("word", "other") + " none"),
    (10, "All rights reserved.\n" + LONG + "\nOne two three four two three four."),
    (11, "x" * 30_000 + " " + "the of and " * 20_000),
    (None, "one"),
]


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    counts = Counter(windows)
    hit = {i + k for i, x in enumerate(windows) if counts[x] > 1 for k in range(3)}
    lines = [s for s in text.split("\n") if WORD.search(s)]
    return (
        len(w),
        sum(map(len, w)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(hit),
        len(w) < 50 or 100 * len(hit) > 50 * len(w),
    )


def test_counts_by_the_definition(documents):
    got = {
        r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        for r in clean_lines(documents(TEXTS)).collect()
    }
    assert got == {i: brute(t) for i, t in TEXTS}


def test_lines_and_verdicts(documents):
    got = {r.doc_id: r for r in clean_lines(documents(TEXTS)).collect()}
    assert got[4].kept and got[5].kept and got[4].clean_text == LONG
    assert not got[1].kept and not got[2].kept
    assert got[8].n_navigation == 2 and got[8].clean_text == LONG and got[8].kept
    assert got[9].n_punctuation == 2 and not got[9].kept and not got[9].base_failed
    assert got[10].n_boilerplate == 1 and got[10].kept


@pytest.mark.parametrize(
    "line,rule",
    [
        ("Licensed under CC BY 4.0.", "boilerplate"),
        ("Home » News » Sport » Weather", "navigation"),
        ("GO!! GET!! IT!! NOW!!", "punctuation"),
        ("With*** was&&& by%%% the### end.", "punctuation"),
        ("A heading", None),
        ("He said: \"that is all.\"", None),
        ("Une phrase finie…", None),
        ("Alle Rechte vorbehalten.", "boilerplate"),
        ("Home \t|\tNews\t|\tSport", "navigation"),
        # Three words and many blanks are no menu of thirteen words, and five words parted by tabs no heading.
        ("Home      About | Contact |", "navigation"),
        ("one\ttwo\tthree\tfour\tfive", "punctuation"),
        ("   two     words   ", None),
    ],
)
def test_rules(documents, line, rule):
    row = clean_lines(documents([(1, line)])).first()
    assert {k: row[f"n_{k}"] for k in ("boilerplate", "navigation", "punctuation")} == {
        k: int(k == rule) for k in ("boilerplate", "navigation", "punctuation")
    }


def test_empty_table(documents):
    assert clean_lines(documents([(1, "x")]).limit(0)).count() == 0
