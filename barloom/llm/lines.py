"""Line-first cleaning in column expressions: judge lines, drop the failures, then judge documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE

HAS_WORD = r"[^\x20\x09-\x0D]"
GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"

#: A line ends well with closing punctuation, quotes or brackets after it allowed.
GOOD_END = r"[.!?:;\u2026\u3002\u00BB][\"')\]\u201D\u2019\u00BB]*[\x20\x09-\x0D]*$"
#: How far back from its end a line is searched for that.
TAIL = 20
#: Words that end in two or more marks, as in shouting or in lines strewn with symbols.
MARKED = r"([!?]{2}|[#*$%&<>]{2})([\x20\x09-\x0D]|$)"
#: Bars and arrows standing between the words of a menu.
SEPARATORS = r"[|\u00BB\u203A\u2022>]+([\x20\x09-\x0D]|$)"
#: Lower-cased phrases of page furniture.
BOILERPLATE = (
    "all rights reserved",
    "terms of use",
    "terms of service",
    "privacy policy",
    "cookie policy",
    "we use cookies",
    "enable javascript",
    "lorem ipsum",
    "subscribe to our",
    "sign up for our",
    "click here to",
    "share this article",
    "share this page",
    "follow us on",
    "licensed under",
    "powered by",
    "alle rechte vorbehalten",
    "datenschutzerkl\u00e4rung",
    "nutzungsbedingungen",
    "verwenden cookies",
    "diese seite teilen",
    "newsletter abonnieren",
    "tous droits r\u00e9serv\u00e9s",
    "politique de confidentialit\u00e9",
    "conditions d'utilisation",
    "utilisons des cookies",
    "partager cette page",
    "abonnez-vous \u00e0",
    "todos los derechos reservados",
    "pol\u00edtica de privacidad",
    "t\u00e9rminos de uso",
    "utilizamos cookies",
    "compartir esta p\u00e1gina",
    "suscr\u00edbete a",
)
#: Where a line's words are not one more than its blanks.
UNEVEN = r"[\x09\x0B-\x0D]|\x20\x20|^\x20|\x20$"


def _any(tests):
    return reduce(lambda a, b: a | b, tests)


def _count(text: Column, pattern: str) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))


def _word_count(line: Column) -> Column:
    blanks = F.char_length(line) - F.char_length(F.replace(line, F.lit(" "), F.lit("")))
    return F.when(line.rlike(UNEVEN), F.size(F.split(F.btrim(line, F.lit(SPACE)), GAP, -1))).otherwise(blanks + 1)


def _rule(x: Column, short: int, marked_share: float, separator_share: float, phrases) -> Column:
    """The rule that a line (struct of line, its lower-cased form and number of words) breaks, or null."""
    line, words = x["line"], x["words"]
    separators = F.when(line.rlike(SEPARATORS), _count(line, SEPARATORS)).otherwise(0)
    marked = F.when(line.rlike(MARKED), _count(line, MARKED)).otherwise(0)
    open_end = ~F.right(line, F.lit(TAIL)).rlike(GOOD_END)
    return (
        F.when(_any([F.contains(x["low"], F.lit(phrase)) for phrase in phrases] or [F.lit(False)]), "boilerplate")
        .when(F.greatest(F.lit(2), separator_share * words) <= separators, "navigation")
        .when((words >= short) & (open_end | (marked > marked_share * words)), "punctuation")
    )


def _broken(rule: str):
    return lambda x: x["rule"] == rule


def clean_lines(
    docs: DataFrame,
    *,
    min_words: int = 50,
    max_repeat_percent: int = 50,
    max_lost: float = 0.5,
    short_line: int = 3,
    marked_share: float = 0.3,
    separator_share: float = 0.2,
    phrases=BOILERPLATE,
) -> DataFrame:
    """Every document with its counts, its text without failing lines, and whether it is kept.

    A line fails as boilerplate (`phrases`, lower-cased), navigation (two separators or more that make up
    `separator_share` of its words) or punctuation (`short_line` words or more without a closing
    mark, or marks in a row at more than `marked_share` of its words). A document is kept unless
    it fails the base rule (too few words, too many in repeated 3-word windows) or its failing
    lines hold more than `max_lost` of the characters of its lines.

    Null text has no words and counts of zero, and is not kept; an empty text too. Repeated rows
    are judged alike, each on its own; an empty table gives no rows. Columns of other names in
    `docs` are ignored; `doc_id` may be null. Column expressions only, one pass, no shuffle.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    inner = F.btrim(F.col("text"), F.lit(SPACE))
    base = docs.select("doc_id", text.alias("text"))
    base = base.select(
        "doc_id",
        "text",
        F.when(inner == "", F.array().cast("array<string>"))
        .otherwise(F.split(inner, GAP, -1))
        .alias("words"),
        F.filter(F.split("text", "\n", -1), lambda s: s.rlike(HAS_WORD)).alias("lines"),
    )
    n = F.size("words")
    inner_words = F.slice("words", 1, F.greatest(n - 2, F.lit(0)))
    hashes = F.transform(
        inner_words, lambda a, i: F.xxhash64(a, F.get("words", i + 1), F.get("words", i + 2))
    )
    windows = F.transform(
        inner_words,
        lambda a, i: F.struct(
            F.concat_ws(" ", a, F.get("words", i + 1), F.get("words", i + 2)).alias("w"), i.alias("i")
        ),
    )
    judged = F.transform(
        F.transform(
            "lines",
            lambda s: F.struct(
                s.alias("line"),
                F.lower(s).alias("low"),
                _word_count(s).alias("words"),
            ),
        ),
        lambda x: F.struct(x["line"], _rule(x, short_line, marked_share, separator_share, phrases).alias("rule")),
    )
    base = base.withColumn("hashes", hashes)
    base = base.select(
        "doc_id",
        "text",
        n.cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.regexp_replace("text", SYMBOLS, "")))
        .cast("long")
        .alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        # Equal windows have equal hashes: texts without such need not sort their windows.
        F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), F.sort_array(windows)).alias("ranked"),
        judged.alias("judged"),
    )
    m = F.size("ranked")
    again = F.zip_with(
        F.slice("ranked", 1, m - 1),
        F.slice("ranked", 2, m - 1),
        lambda a, b: F.when(a["w"] == b["w"], F.array(a["i"], b["i"])),
    )
    places = F.sort_array(F.array_distinct(F.flatten(F.filter(again, lambda p: p.isNotNull()))))
    base = base.withColumn("places", F.when(F.col("ranked").isNotNull(), places)).drop("ranked")
    k = F.size("places")
    steps = F.zip_with(
        F.slice("places", 1, k - 1), F.slice("places", 2, k - 1), lambda a, b: F.least(F.lit(3), b - a)
    )
    covered = F.when(k > 0, F.aggregate(steps, F.lit(3), lambda total, step: total + step)).otherwise(0)

    def chars(where):
        return F.aggregate(
            F.filter("judged", where), F.lit(0), lambda total, x: total + F.char_length(x["line"])
        ).cast("long")

    base = base.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.array_join(
            F.transform(F.filter("judged", lambda x: x["rule"].isNull()), lambda x: x["line"]), "\n"
        ).alias("clean_text"),
        chars(lambda x: x["rule"].isNotNull()).alias("lost_chars"),
        chars(lambda x: F.lit(True)).alias("line_chars"),
        *[
            F.size(F.filter("judged", _broken(rule))).cast("long").alias(f"n_{rule}")
            for rule in ("boilerplate", "navigation", "punctuation")
        ],
    )
    failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")
    )
    return base.withColumn("base_failed", failed).withColumn(
        "kept", ~failed & (F.col("lost_chars") <= max_lost * F.col("line_chars"))
    )
