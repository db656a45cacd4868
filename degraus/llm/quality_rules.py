"""Quality rules, line first: lines failing a rule go, then documents that lose too much text.

Everything is a DataFrame expression over one row; there is no shuffle and no Python on the executors.

Defined cases: a null text counts as empty; an empty text has no words, so it fails the base rules; a blank line
(only white space) is no line for any rule and stays where it is; repeated rows are scored one by one; an empty table
gives an empty result; very long texts are one row each and scored whole. ``with_quality`` puts what it finds into one
struct, so the documents' columns may have any names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from degraus.llm.common import let, words_of

# Characters that count as symbols.
SYMBOLS = r"[#*$%&|<>]"

SENTENCE_MARKS = "[.!?…。！？]"
SEPARATORS = "[|›»·•]| > "
BOILERPLATE = (
    "all rights reserved", "cookie", "privacy policy", "terms of use", "terms of service", "javascript",
    "licensed under", "lorem ipsum", "subscribe to our newsletter", "sign in", "log in", "click here",
    "skip to content", "powered by", "share this",
)
WORD_FACTS = ("n_words", "word_chars", "n_repeat_words")
LINE_FACTS = (
    "n_symbols", "n_dup_lines", "n_lines", "n_punctuation", "n_navigation", "n_boilerplate", "line_chars", "kept_chars",
    "clean_text",
)
PHRASES = rf"(?i)\b(?:{'|'.join(BOILERPLATE)})"


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules and of the loss a document may take.

    A line without any sentence mark fails, so prose that breaks off in a later sentence stays.
    ``marks_per_hundred``: symbols, or pairs of exclamation marks, in 100 characters of a line. ``separators``: from so
    many menu separators on, a line is navigation. ``most_lost_percent``: a document that loses more of its
    characters goes.
    """

    marks_per_hundred: int = 5
    separators: int = 3
    most_lost_percent: int = 50


def _failed(line: Column, symbols: Column, rules: LineRules) -> Column:
    """Name of the first rule that a line fails; null if it passes."""
    shouted = F.length(line) - F.length(F.replace(line, F.lit("!!"), F.lit("")))
    dense = F.greatest(symbols, shouted) * 100 > F.length(line) * rules.marks_per_hundred
    return (
        F.when(F.regexp_count(line, F.lit(SEPARATORS)) >= rules.separators, "navigation")
        .when(line.rlike(PHRASES), "boilerplate")
        .when(~line.rlike(SENTENCE_MARKS) | dense, "punctuation")
    )


def _repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more; windows are compared by 64-bit hash within one text."""

    def counted(windows: Column) -> Column:
        def covered(ordered: Column) -> Column:
            again = F.filter(
                ordered,
                lambda w, i: (w["h"] == F.get(ordered, i - 1)["h"]) | (w["h"] == F.get(ordered, i + 1)["h"]),
            )
            places = F.transform(again, lambda w: F.array(w["i"], w["i"] + 1, w["i"] + 2))
            return F.size(F.array_distinct(F.flatten(places)))

        numbered = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(
            F.size(F.array_distinct(windows)) < F.size(windows), let(F.sort_array(numbered), covered)
        ).otherwise(0)

    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )
    return F.when(F.size(words) >= 3, let(hashes, counted)).otherwise(0)


def _word_facts(words: Column) -> Column:
    return F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.aggregate(words, F.lit(0).cast("long"), lambda n, w: n + F.length(w)).alias("word_chars"),
        _repeated_words(words).cast("long").alias("n_repeat_words"),
    )


def _line_facts(text: Column, rules: LineRules) -> Column:
    """Per line: the line, whether it has a word, its symbols, and the rule it fails."""

    def facts(line: Column) -> Column:
        symbols = F.regexp_count(line, F.lit(SYMBOLS))
        return let(
            symbols,
            lambda n: F.struct(
                line.alias("line"),
                n.alias("symbols"),
                F.when(line.rlike(r"[^\x20\x09-\x0D]"), F.coalesce(_failed(line, n, rules), F.lit("kept"))).alias("rule"),
            ),
        )

    return F.transform(F.split(text, "\n"), facts)


def _total(lines: Column, value) -> Column:
    return F.aggregate(lines, F.lit(0).cast("long"), lambda n, x: n + value(x))


def _document_facts(lines: Column) -> Column:
    filled = F.filter(lines, lambda x: x["rule"].isNotNull())

    def of(rule: str) -> Column:
        return F.size(F.filter(lines, lambda x: x["rule"] == rule)).cast("long").alias(f"n_{rule}")

    return F.struct(
        _total(lines, lambda x: x["symbols"]).alias("n_symbols"),
        (F.size(filled) - F.size(F.array_distinct(F.transform(filled, lambda x: x["line"]))))
        .cast("long").alias("n_dup_lines"),
        F.size(filled).cast("long").alias("n_lines"),
        of("punctuation"),
        of("navigation"),
        of("boilerplate"),
        _total(filled, lambda x: F.length(x["line"])).alias("line_chars"),
        _total(filled, lambda x: F.when(x["rule"] == "kept", F.length(x["line"])).otherwise(0)).alias("kept_chars"),
        F.array_join(
            F.transform(
                F.filter(lines, lambda x: x["rule"].isNull() | (x["rule"] == "kept")), lambda x: x["line"]
            ),
            "\n",
        ).alias("clean_text"),
    )


def with_quality(
    docs: DataFrame, into: str, text_col: str = "text", rules: LineRules | None = None
) -> DataFrame:
    """``docs`` with one more column ``into``, a struct of all that the rules found: the counts, ``base_failed``, ``kept``
    and ``clean_text``. The other columns may have any names; ``into`` must be new.

    ``kept`` is false for documents that fail the base rules (under 50 words, or over half of the words in repeated
    3-word windows) and for those that lose more than ``rules.most_lost_percent`` of their characters to line rules.
    ``clean_text`` has the lines that pass, in order.
    """
    if into in docs.columns:
        raise ValueError(f"the documents have a column {into} already")
    rules = rules or LineRules()
    text = F.coalesce(F.col(text_col), F.lit(""))
    scored = docs.select(
        F.struct(*docs.columns).alias("doc"),
        let(words_of(text), _word_facts).alias("words"),
        let(_line_facts(text, rules), _document_facts).alias("lines"),
    )
    words, lines = F.col("words"), F.col("lines")
    failed = (words["n_words"] < 50) | (100 * words["n_repeat_words"] > 50 * words["n_words"])
    lost = lines["line_chars"] - lines["kept_chars"]
    facts = F.struct(
        *(words[c].alias(c) for c in WORD_FACTS), *(lines[c].alias(c) for c in LINE_FACTS),
        failed.alias("base_failed"),
        (~failed & (100 * lost <= rules.most_lost_percent * lines["line_chars"])).alias("kept"),
    )
    return scored.select("doc.*", facts.alias(into))


def quality_rules(
    docs: DataFrame, *keep: str, text_col: str = "text", rules: LineRules | None = None
) -> DataFrame:
    """The ``keep`` columns of every document and what ``with_quality`` finds, each in a column of its own. A kept column
    may not have the name of one of those."""
    clash = sorted(set(keep) & {*WORD_FACTS, *LINE_FACTS, "base_failed", "kept"})
    if clash:
        raise ValueError(f"columns named like findings cannot be kept beside them: {clash}; see with_quality")
    needed = docs.select(*(F.col(c).alias(f"k{i}") for i, c in enumerate(keep)), F.col(text_col).alias("t"))
    found = with_quality(needed, "facts", "t", rules)
    return found.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(keep)), "facts.*")
