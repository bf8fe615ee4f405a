"""Quality rules: lines are judged first, then the document by what is left of it.

Everything is column expressions; a row is judged by itself, so there is no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.llm.words import WORD, let, text_or_empty, words

SYMBOLS = "#*$%&|<>"
SEPARATORS = "|»›•"
#: Phrases of page furniture; a line holding one, in lower case, is boilerplate.
BOILERPLATE = (
    "accept cookies",
    "all rights reserved",
    "click here to",
    "enable javascript",
    "privacy policy",
    "sign up for our",
    "subscribe to our",
    "terms of service",
    "terms of use",
)
REPEAT_WIDTH = 8


@dataclass(frozen=True)
class Limits:
    """Thresholds of the rules; all counts are over whole texts."""

    least_words: int = 20
    most_repeat_percent: int = 30
    most_symbol_percent: int = 30
    least_separators: int = 3
    most_lost_percent: int = 50


def char_count(text: Column, characters: str) -> Column:
    """How many of the given characters a text has."""
    return F.length(text) - F.length(F.regexp_replace(text, f"[{characters}]+", ""))


def word_chars(tokens: Column) -> Column:
    """Code points in words."""
    return F.aggregate(tokens, F.lit(0).cast("long"), lambda a, w: a + F.length(w))


def repeat_words(tokens: Column, width: int = REPEAT_WIDTH) -> Column:
    """Words in windows of ``width`` words, a power of two, that the text has twice or more.

    Windows are compared by a 64-bit digest, built by joining digests of half as many words.
    Their starts are sorted by digest, those with an equal neighbour are put back in text
    order, and each covers ``width`` words or as many as lie before the next one.
    """

    def covered(starts: Column) -> Column:
        steps = F.transform(
            starts,
            lambda x, j: F.least(F.lit(width), F.coalesce(F.get(starts, j + 1) - x, F.lit(width))),
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    def found_twice(ordered: Column) -> Column:
        starts = F.transform(
            ordered,
            lambda x, j: F.when(
                (F.get(ordered, j - 1)["h"] == x["h"]) | (F.get(ordered, j + 1)["h"] == x["h"]), x["i"]
            ),
        )
        return let(F.sort_array(F.filter(starts, lambda x: x.isNotNull())), covered)

    def of_windows(digests: Column) -> Column:
        pairs = F.transform(digests, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(digests)) == F.size(digests), F.lit(0).cast("long")).otherwise(
            let(F.sort_array(pairs), found_twice)
        )

    def widened(digests: Column, step: int) -> Column:
        joined = F.transform(digests, lambda h, i: F.xxhash64(h, F.get(digests, i + step)))
        return joined if 2 * step == width else let(joined, lambda d: widened(d, 2 * step))

    def of_words(w: Column) -> Column:
        digests = let(F.transform(w, lambda x: F.xxhash64(x)), lambda d: widened(d, 1))
        # The last entries lack words behind them and are no windows.
        whole = F.slice(digests, F.lit(1), F.size(w) - (width - 1))
        return F.when(F.size(w) < width, F.lit(0).cast("long")).otherwise(let(whole, of_windows))

    return let(tokens, of_words)


def line_fails(line: Column, limits: Limits = Limits()) -> Column:
    """True for navigation, boilerplate and symbol lines; blank lines pass.

    Navigation: several separators, one for every three words at least. Boilerplate: a
    phrase of ``BOILERPLATE``. Punctuation: no letter or digit at all, or symbols beyond a
    share of the characters other than white space.
    """
    separators, symbols = char_count(line, SEPARATORS), char_count(line, SYMBOLS)
    # The dearer counts follow cheap conditions that most lines do not meet.
    navigation = (separators >= limits.least_separators) & (3 * separators >= F.size(words(line)))
    symbolic = (symbols > 0) & (100 * symbols > limits.most_symbol_percent * word_chars(words(line)))
    return wordless(line) | (line.rlike(WORD) & (let(F.lower(line), has_phrase) | navigation | symbolic))


def has_phrase(low: Column) -> Column:
    found = F.lit(False)
    for text in BOILERPLATE:
        found = found | low.contains(text)
    return found


def wordless(line: Column) -> Column:
    """A line with something on it, but no letter or digit."""
    return line.rlike(WORD) & ~line.rlike("[\\p{L}\\p{N}]")


def good_lines(text: Column, limits: Limits = Limits()) -> Column:
    """The lines that do not fail, as an array.

    A text without any of the marks and phrases that the rules look for, as most are, has
    its lines judged by their letters alone.
    """
    lines = F.split(text, "\n", -1)
    marked = text.rlike(f"[{SYMBOLS}{SEPARATORS}]") | has_phrase(F.lower(text))
    return F.when(marked, F.filter(lines, lambda x: ~line_fails(x, limits))).otherwise(
        F.filter(lines, lambda x: ~wordless(x))
    )


def quality_rules(docs: DataFrame, text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """Add the measures, ``base_failed``, ``kept`` and ``cleaned_text`` to every row.

    Null text counts as empty: no words, so it fails. Rows are judged one by one, so ties,
    repeated rows and further columns do not matter; a column of the input with the name
    of a measure is replaced.
    """
    body = text_or_empty(F.col(text))
    lines = F.split(body, "\n", -1)
    worded = F.filter(lines, lambda x: x.rlike(WORD))
    # The words are found once for the three measures over them.
    measured = let(
        words(body),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n"), word_chars(w).alias("chars"), repeat_words(w).alias("repeats")
        ),
    )
    out = docs.withColumns(
        {
            "_measured": measured,
            "n_symbols": char_count(body, SYMBOLS).cast("long"),
            "n_dup_lines": let(worded, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
            "n_lines": F.size(lines).cast("long"),
            "cleaned_text": F.array_join(good_lines(body, limits), "\n"),
        }
    ).withColumns(
        {
            "n_words": F.col("_measured")["n"],
            "word_chars": F.col("_measured")["chars"],
            "n_repeat_words": F.col("_measured")["repeats"],
        }
    ).drop("_measured")
    out = out.withColumns(
        {
            "base_failed": (F.col("n_words") < limits.least_words)
            | (100 * F.col("n_repeat_words") > limits.most_repeat_percent * F.col("n_words")),
            "lost_chars": F.when(F.col("cleaned_text") == body, 0)
            .otherwise(F.col("word_chars") - word_chars(words(F.col("cleaned_text"))))
            .cast("long"),
        }
    )
    lost = 100 * F.col("lost_chars") > limits.most_lost_percent * F.col("word_chars")
    return out.withColumn("kept", ~F.col("base_failed") & ~lost)
