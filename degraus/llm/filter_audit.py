"""Audit of how filters interact: what each removes, wastes and shares, for every order in which they can be applied.

A document is reduced to the bits of the filters that it fails. Documents are counted by part and bits, so a part has at
most 32 cells, whatever its size. Each cell folds across the constant array of all orders: an ``aggregate`` walks one
order and writes what its steps do to the cell, a ``transform`` does so for all orders. That gives one array of
``120 * 5`` weighted structs a cell; the arrays of a part are summed element by element. Everything is a DataFrame
expression; no text is shuffled.

A text counts as a copy (E) if a smaller id has the same text, by SHA-256, in any part. Copies are counted by digest and
id first, so a text that a third of the documents share is spread over all tasks and leaves each as one row per part.

Defined cases: a null text is the empty text, which fails A, not B or C (0 of 0 is no share), and copies are found among
empty texts too; a null source is the part ``''``, together with empty sources; a document without a label, or with null
labels, loses nothing good or toxic; an id labelled more than once is good, or toxic, if one label says so; repeated rows
count one by one and are no copies of each other, for no id is smaller; a row without id is no copy and has no label;
very long texts are one row each and counted whole; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from degraus.llm.common import let, words_of
from degraus.session import stored

FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT_PERCENT, MOST_CAPITALS_PERCENT = 200, 50, 2
SYMBOLS = "[#$%&*|]"
#: What a step does to the documents of a cell.
EFFECTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def text_bits(text: Column) -> Column:
    """Bits of the filters that look at one text alone: 1 for A, 2 for B, 4 for C, 8 for D."""

    def of_words(words: Column) -> Column:
        def of_size(n: Column) -> Column:
            few = F.when(n < LEAST_WORDS, 1).otherwise(0)
            distinct = F.size(F.array_distinct(words)).cast("long")
            return few + F.when(100 * distinct < LEAST_DISTINCT_PERCENT * n, 2).otherwise(0)

        return let(F.size(words).cast("long"), of_size)

    capitals = F.regexp_count(text, F.lit("[A-Z]")).cast("long")
    return (
        let(words_of(text), of_words)
        + F.when(100 * capitals > MOST_CAPITALS_PERCENT * F.length(text).cast("long"), 4).otherwise(0)
        + F.when(text.rlike(SYMBOLS), 8).otherwise(0)
    )


def masked(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source"
) -> DataFrame:
    """Counts of documents: ``part, mask`` (bits of the failed filters, 1 for A to 16 for E), ``n, good, toxic``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc"), F.coalesce(F.col(part_col), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"), text_bits(text).alias("mask"),
    )
    marks = labels.groupBy(F.col(id_col).alias("doc")).agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    ).where("good or toxic")
    kinds = ["digest", "part", "mask", "good", "toxic"]
    # Rows of one id first, then ids of one text: a group of copies is spread by id and reduced in the map tasks.
    of_id = (
        rows.groupBy("doc", "digest", "part", "mask").agg(F.count("*").alias("n"))
        .join(marks, "doc", "left").fillna(False, ["good", "toxic"])
    )
    of_text = stored(of_id.groupBy(*kinds).agg(
        F.sum("n").alias("n"), F.min("doc").alias("low"),
        F.coalesce(F.min_by("n", "doc"), F.lit(0)).alias("at_low"),
        F.sum(F.when(F.col("doc").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
    ), "audit-texts")
    lowest = of_text.groupBy("digest").agg(F.min("low").alias("lowest"))
    firsts = F.when(F.col("low") == F.col("lowest"), F.col("at_low")).otherwise(0) + F.col("nameless")
    split = of_text.join(lowest, "digest").select(
        "part", "good", "toxic",
        F.explode(F.array(
            F.struct(F.col("mask").alias("mask"), firsts.alias("n")),
            F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - firsts).alias("n")),
        )).alias("cell"),
    ).where("cell.n > 0")
    return split.groupBy("part", "cell.mask").agg(
        F.sum("cell.n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("cell.n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("cell.n")).otherwise(0)).alias("toxic"),
    )


def _summed(cells: Column, value: Callable[[Column], Column]) -> Column:
    return F.aggregate(cells, F.lit(0).cast("long"), lambda total, x: total + value(x))


def _walked(order: Column) -> Column:
    """What each step of an order does to the cell of this row: the fold keeps whether the cell still stands."""
    mask, n = F.col("mask"), F.col("n")
    none = F.lit(0).cast("long")

    def step(state: Column, bit: Column) -> Column:
        stands = ~state["gone"]
        fails = mask.bitwiseAND(bit) != 0
        here = stands & fails
        effects = F.struct(
            bit.alias("bit"),
            F.when(stands & ~fails, n).otherwise(none).alias("kept"),
            F.when(here, n).otherwise(none).alias("removed"),
            F.when(fails & state["gone"], n).otherwise(none).alias("redundant"),
            F.when(mask == bit, n).otherwise(none).alias("unique_fails"),
            F.when(here, F.col("good")).otherwise(none).alias("good_lost"),
            F.when(here, F.col("toxic")).otherwise(none).alias("toxic_lost"),
        )
        return F.struct(
            (state["gone"] | fails).alias("gone"), F.concat(state["steps"], F.array(effects)).alias("steps")
        )

    kind = "array<struct<bit:int," + ",".join(f"{x}:bigint" for x in EFFECTS) + ">>"
    start = F.struct(F.lit(False).alias("gone"), F.array().cast(kind).alias("steps"))
    return F.aggregate(order, start, step, lambda state: state["steps"])


def filter_audit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source"
) -> DataFrame:
    """Per part, order and step: ``part, filter_order, step``, the effects, and ``shapley``, the documents that the
    step's filter removes summed over all orders."""
    orders = ["".join(x) for x in permutations(FILTERS)]
    bits = F.array(*(F.array(*(F.lit(1 << FILTERS.index(x)) for x in order)) for order in orders))
    folded = masked(docs, labels, id_col, text_col, part_col).withColumn(
        "steps", F.flatten(F.transform(bits, _walked))
    )
    # At most 32 cells a part, so the arrays that meet here have a bound.
    merged = folded.groupBy("part").agg(F.collect_list("steps").alias("cells")).withColumn(
        "steps",
        F.aggregate(
            F.slice("cells", 2, 32), F.get("cells", 0),
            lambda total, cell: F.zip_with(
                total, cell,
                lambda x, y: F.struct(x["bit"].alias("bit"), *((x[e] + y[e]).alias(e) for e in EFFECTS)),
            ),
        ),
    )
    shares = F.map_from_entries(F.array(*(
        F.struct(
            F.lit(1 << i),
            _summed(F.col("steps"), lambda x, i=i: F.when(x["bit"] == 1 << i, x["removed"]).otherwise(0)),
        )
        for i in range(len(FILTERS))
    )))
    names = F.array(*map(F.lit, orders))
    return merged.select("part", F.posexplode("steps").alias("at", "x"), shares.alias("shares")).select(
        "part", F.get(names, F.floor(F.col("at") / len(FILTERS)).cast("int")).alias("filter_order"),
        (F.col("at") % len(FILTERS) + 1).alias("step"),
        *(F.col(f"x.{e}").alias(e) for e in EFFECTS),
        F.element_at("shares", F.col("x.bit")).alias("shapley"),
    )
