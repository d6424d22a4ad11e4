"""Line-first cleaning with SQL functions only.

Every line with a word meets three rules: punctuation (a line must end like a
sentence unless it is long, and must not be full of symbols), navigation (lines
of separators or menu words) and boilerplate (phrases of notices and footers).
Lines that fail go; a document that loses too much of its text goes as a whole.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.llm.common import BLANK, BLANKS, WORD, let, n_words, words

#: Symbols counted by the base figures.
SYMBOLS = r"[#*$%&|<>]"
#: A line ends like a sentence: one of these marks, perhaps closed by quotes or brackets.
END_MARKS = (".", "!", "?", ":", ";", "…", "。", "！", "？")
CLOSERS = "\"'”’»)]"
NAVIGATION_WORDS = (
    r"^(home|menu|login|log in|sign in|sign up|register|search|contact|contact us|about|about us|sitemap|next|previous"
    r"|back|back to top|share|share this|skip to content|read more|main page)([ |>»/·•-]+|$)"
)
BOILERPLATE = (
    "all rights reserved",
    "terms of use",
    "terms of service",
    "privacy policy",
    "cookie policy",
    "uses cookies",
    "accept cookies",
    "copyright ©",
    "copyright (c)",
    "enable javascript",
    "licensed under the",
    "powered by",
    "click here",
    "subscribe to our",
    "subscribe to the",
    "lorem ipsum",
)
#: A line without an end mark passes from so many words on.
LONG_LINE = 20
#: The largest share of a line's characters that may be symbols.
SYMBOL_SHARE = 0.1
SEPARATORS = r"[|»>•·]"
#: So many separators make a line a menu.
MENU_SEPARATORS = 3
#: The largest share of the words' characters that a kept document may lose.
MAX_LOSS = 0.5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
WINDOW = 5


def _chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, BLANK + "+", ""))


def line_fails(line: Column) -> Column:
    """Whether a line (trimmed, with a word) breaks one of the rules."""
    length = F.length(line)
    symbols = length - F.length(F.regexp_replace(line, SYMBOLS, ""))
    separators = length - F.length(F.regexp_replace(line, SEPARATORS, ""))
    unended = ~F.right(F.rtrim(line, F.lit(CLOSERS)), F.lit(1)).isin(*END_MARKS) & (n_words(line) < LONG_LINE)
    notice = let(F.lower(line), lambda low: reduce(or_, [F.contains(low, F.lit(x)) for x in BOILERPLATE], low.rlike(NAVIGATION_WORDS)))
    return unended | (symbols > SYMBOL_SHARE * length) | (separators >= MENU_SEPARATORS) | notice


def lines(text: Column) -> Column:
    """The lines that hold a word, as they are."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: x.rlike(WORD))


def _repeated_words(grams: Column) -> Column:
    """The words in windows that occur twice or more, from the windows' hashes in order.

    Sorted by hash, equal windows are neighbours; a repeated window adds the
    words up to the next repeated one, five at most.
    """

    def covered(places: Column) -> Column:
        last = F.size(places)
        steps = F.transform(places, lambda p, i: F.when(i + 1 < last, F.least(F.lit(WINDOW), F.get(places, i + 1) - p)).otherwise(WINDOW))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    def repeated(pairs: Column) -> Column:
        flagged = F.filter(
            F.transform(
                pairs,
                lambda x, i: F.when((F.get(pairs, i - 1)["h"] == x["h"]) | (F.get(pairs, i + 1)["h"] == x["h"]), x["p"]),
            ),
            lambda p: p.isNotNull(),
        )
        return let(F.sort_array(flagged), covered)

    pairs = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    return F.when(F.size(F.array_distinct(grams)) < F.size(grams), let(pairs, repeated)).otherwise(F.lit(0).cast("long"))


def _figures(text: Column) -> Column:
    """All figures of a text as one struct.

    Each array is bound once: as columns of their own they could be put into each
    other by the optimizer, and made anew for every element.
    """

    def windows(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))
        return F.when(F.size(w) > WINDOW, hashes).otherwise(F.array().cast("array<bigint>"))

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), let(windows(w), _repeated_words).alias("n_repeat_words"))

    def of_lines(all_lines: Column) -> Column:
        good = F.filter(F.transform(all_lines, lambda x: F.btrim(x, F.lit(BLANKS))), lambda x: ~line_fails(x))
        return let(
            good,
            lambda g: F.struct(
                F.size(all_lines).cast("long").alias("n_lines"),
                (F.size(all_lines) - F.size(g)).cast("long").alias("n_bad_lines"),
                (F.size(all_lines) - F.size(F.array_distinct(all_lines))).cast("long").alias("n_dup_lines"),
                F.array_join(g, "\n").alias("clean_text"),
            ),
        )

    def of_text(t: Column) -> Column:
        return F.struct(
            let(words(t), of_words).alias("w"),
            let(lines(t), of_lines).alias("l"),
            _chars(t).cast("long").alias("word_chars"),
            (F.length(t) - F.length(F.regexp_replace(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        )

    return let(F.coalesce(text, F.lit("")), of_text)


def clean_lines(docs: DataFrame, max_loss: float = MAX_LOSS) -> DataFrame:
    """The columns of ``docs`` with the figures, the verdict and ``clean_text``.

    Adds ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``,
    ``base_failed``, ``kept``, ``n_lines`` (with a word), ``n_bad_lines`` and
    ``clean_text`` (the lines that pass, without blanks at their ends, joined by
    line breaks). A null or empty text has no words, fails the base rules and has
    an empty clean text. Columns of ``docs`` with one of these names are
    replaced. Windows are compared by 64-bit hashes. Every document is handled
    by itself: nothing is shuffled.
    """
    f = "_line_figures"
    made = {name: F.col(f"{f}.w.{name}") for name in ("n_words", "n_repeat_words")}
    made |= {name: F.col(f"{f}.l.{name}") for name in ("n_lines", "n_bad_lines", "n_dup_lines", "clean_text")}
    made |= {name: F.col(f"{f}.{name}") for name in ("word_chars", "n_symbols")}
    failed = (made["n_words"] < MIN_WORDS) | (100 * made["n_repeat_words"] > MAX_REPEATED_PERCENT * made["n_words"])
    lost = made["word_chars"] - _chars(made["clean_text"])
    made |= {"base_failed": failed, "kept": ~failed & (lost <= max_loss * made["word_chars"])}
    return docs.drop(*made).withColumn(f, _figures(F.col("text"))).withColumns(made).drop(f)
