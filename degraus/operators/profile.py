"""Profiling aggregates: histograms, counts, median, correlation, nulls, table profile."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from degraus.functions import round_even
from degraus.operators.selection import count_removed_of_few
from degraus.session import stored


def bin_number(column: str, first: float, last: float, width: float) -> Column:
    """Bin of a value in [first, last], the last bin closed; null outside."""
    x = F.col(column)
    top = int(round((last - first) / width)) - 1
    inside = (x >= first) & (x <= last)
    return F.when(inside, F.least(F.floor((x - F.lit(float(first))) / F.lit(float(width))), F.lit(top)).cast("int"))


def with_empty_bins(counts: DataFrame, first: float, last: float, width: float) -> DataFrame:
    """Bin counts (faixa, contagem) as edges and counts, bins without rows included."""
    bins = int(round((last - first) / width))
    edges = counts.sparkSession.range(bins).select(F.col("id").cast("int").alias("faixa"))
    return edges.join(counts, "faixa", "left").select(
        (F.col("faixa") * int(width) + int(first)).cast("int").alias("faixa_min"),
        ((F.col("faixa") + 1) * int(width) + int(first)).cast("int").alias("faixa_max"),
        F.coalesce("contagem", F.lit(0)).cast("bigint").alias("contagem"),
    )


def fixed_histogram(df: DataFrame, column: str, first: float, last: float, width: float) -> DataFrame:
    """Counts per [edge, edge + width); the last bin is closed, empty bins stay, the rest is dropped."""
    bins = df.select(bin_number(column, first, last, width).alias("faixa")).where(F.col("faixa").isNotNull())
    return with_empty_bins(bins.groupBy("faixa").agg(F.count("*").alias("contagem")), first, last, width)


def range_histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins over the range of the data; a single-valued column gets a unit-wide range."""
    data = df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("x"))
    bounds = data.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).select(
        F.struct(
            F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
            F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        ).alias("limites")
    )
    spread = data.withColumn("limites", bounds.scalar()).select("x", "limites.lo", "limites.hi")
    step = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    guess = F.least(F.floor((F.col("x") - F.col("lo")) / step), F.lit(bins - 1)).cast("int")

    def edge(i):
        return F.col("lo") + i.cast("double") * step

    # The division may land one bin off; the edges decide.
    placed = spread.withColumn("i", guess).withColumn(
        "faixa",
        F.when(F.col("x") < edge(F.col("i")), F.col("i") - 1)
        .when((F.col("i") < bins - 1) & (F.col("x") >= edge(F.col("i") + 1)), F.col("i") + 1)
        .otherwise(F.col("i")),
    )
    counts = placed.groupBy("faixa").agg(F.count("*").alias("contagem"))
    edges = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("faixa"))
    return edges.join(counts, "faixa", "left").select(
        "faixa", F.coalesce("contagem", F.lit(0)).cast("bigint").alias("contagem")
    )


def value_counts(
    df: DataFrame, column: str, categories: Sequence[str] | None = None, digits: int | None = None
) -> DataFrame:
    """Rows per value and share of the non-null rows.

    With ``categories`` only those are listed, in that order; an absent one has a null count.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("contagem"))
    total = counts.agg(F.sum("contagem")).scalar()
    if categories is not None:
        listed = df.sparkSession.range(len(categories)).select(
            F.element_at(F.array(*map(F.lit, categories)), (F.col("id") + 1).cast("int")).alias(column),
            F.col("id").cast("int").alias("ordem"),
        )
        counts = listed.join(counts, column, "left")
    share = F.col("contagem") / total.cast("double")
    return counts.withColumn("proporcao", share if digits is None else round_even(share, digits))


def exact_median(df: DataFrame, column: str, accuracy: int = 4_096, most: int = 100_000) -> DataFrame:
    """Exact median in one row, in two scans of the data, without one task holding all values.

    The first scan merges quantile sketches of size ``accuracy`` from all tasks; they bracket the middle ranks. The
    second counts the values below and above the bracket and, one by one, those inside, and stores these counts, which are
    few. The middle is then looked for among them: as long as there are more than ``most``, they are cut at pivots and only
    the part with the middle ranks is kept. The driver sees figures of pivots, never values of all rows.
    """
    spark, x = df.sparkSession, F.col("x")
    data = df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("x"))
    size = min(max(accuracy, 8), 65_535)
    total, sketch = data.agg(F.count("x"), F.kll_sketch_agg_double("x", F.lit(size))).first()
    if not total:
        return spark.createDataFrame([(None,)], "mediana DOUBLE")
    ranks = sorted({(total + 1) // 2, (total + 2) // 2})
    # Four times the rank error to be expected of such a sketch. A bracket that still misses the middle is widened, at
    # the price of another scan.
    reach = 4 * 2.3 / size**0.9
    while True:
        shares = [max(0.0, ranks[0] / total - reach), min(1.0, ranks[-1] / total + reach)]
        low, high = spark.range(1).select(
            F.kll_sketch_get_quantile_double(F.lit(bytes(sketch)), F.array(*map(F.lit, shares)))
        ).first()[0]
        side = F.when(x < low, -1).when(x > high, 1).otherwise(0)
        counted = data.select(side.alias("side"), F.when(side == 0, x).alias("x")).groupBy("side", "x").agg(
            F.count("*").alias("n")
        )
        kept = stored(counted, "mediana")
        under, inside, values = kept.agg(
            F.coalesce(F.sum(F.when(F.col("side") == -1, F.col("n"))), F.lit(0)),
            F.coalesce(F.sum(F.when(F.col("side") == 0, F.col("n"))), F.lit(0)), F.count_if(F.col("side") == 0),
        ).first()
        if under < ranks[0] and ranks[-1] <= under + inside:
            break
        reach *= 4
    found = _values_at(kept.where("side = 0").select("x", "n"), [r - under for r in ranks], values, most)
    return spark.createDataFrame([((found[0] + found[-1]) / 2.0,)], "mediana DOUBLE")


def _values_at(counts: DataFrame, ranks: Sequence[int], values: int, most: int, pivots: int = 64) -> list[float]:
    """Values at some neighbouring ranks of ``counts(x, n)``, which has ``values`` rows."""
    x = F.col("x")
    while values > most:
        shares = [(i + 1) / (pivots + 1) for i in range(pivots)]
        cuts = sorted(set(counts.agg(F.percentile_approx("x", shares, F.lit(100 * pivots))).first()[0]))
        part = F.aggregate(F.array(*map(F.lit, cuts)), F.lit(0), lambda at, cut: at + F.when(x > cut, 1).otherwise(0))
        placed = counts.withColumn("part", part)
        ends, before, kept, skipped = [], 0, [], 0
        for row in placed.groupBy("part").agg(F.sum("n").alias("n"), F.count("*").alias("values")).orderBy("part").collect():
            ends.append((row["part"], before, before + row["n"], row["values"]))
            before += row["n"]
        for at, start, end, _ in ends:
            if start < ranks[-1] and ranks[0] <= end:
                kept.append(at)
        skipped = next(start for at, start, _, _ in ends if at == kept[0])
        left = sum(n for at, _, _, n in ends if at in kept)
        if left == values:
            break  # two values, or a few that are as many as may remain
        counts, values = stored(placed.where(F.col("part").isin(kept)).select("x", "n"), "mediana"), left
        ranks = [r - skipped for r in ranks]
    upto = F.sum("n").over(Window.orderBy("x").rowsBetween(Window.unboundedPreceding, 0))
    placed = counts.select("x", "n", upto.alias("ate"))
    row = placed.agg(*(
        F.max(F.when((F.col("ate") - F.col("n") < r) & (F.col("ate") >= r), x)).alias(f"v{i}") for i, r in enumerate(ranks)
    )).first()
    return list(row)


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair, each over the rows where both are present; one pass."""
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    row = df.agg(*(F.corr(columns[i], columns[j]).alias(f"c_{i}_{j}") for i, j in pairs))
    cells = [
        F.struct(
            F.lit(columns[i]).alias("variavel_a"),
            F.lit(columns[j]).alias("variavel_b"),
            F.col(f"c_{min(i, j)}_{max(i, j)}").alias("correlacao"),
        )
        for i, j in product(range(len(columns)), repeat=2)
    ]
    return row.select(F.inline(F.array(*cells)))


def null_profile(df: DataFrame, digits: int = 1) -> DataFrame:
    """Share of nulls (percent) of the columns that have any, largest first."""
    counted = df.agg(
        F.count("*").alias("__n"), *(F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns)
    )
    return (
        counted.unpivot("__n", df.columns, "coluna", "nulos")
        .withColumn("pct_nulos", round_even(F.try_divide(F.col("nulos"), F.col("__n")) * 100.0, digits))
        .where(F.col("pct_nulos") > 0)
        .drop("__n")
        .orderBy(F.desc("pct_nulos"), "coluna")
    )


def table_profile(df: DataFrame, name: str) -> DataFrame:
    """Rows, columns, null cells, their share and repeated rows, all exact.

    Repeated rows are looked for among the rows whose hash occurs more than once, so what is
    shuffled is a hash per row, not the table.
    """
    width = len(df.columns)
    nulls = reduce(lambda a, b: a + b, (F.col(f"`{c}`").isNull().cast("bigint") for c in df.columns))
    repeated = count_removed_of_few(df, df.columns).scalar()
    cells = F.when(F.col("registros") > 0, F.col("registros") * width).otherwise(F.lit(1))
    return df.agg(F.count("*").alias("registros"), F.coalesce(F.sum(nulls), F.lit(0)).alias("nulos_total")).select(
        F.lit(name).alias("tabela"),
        "registros",
        F.lit(width).alias("colunas"),
        "nulos_total",
        round_even(F.col("nulos_total") / cells * 100.0, 2).alias("pct_nulos"),
        repeated.alias("duplicatas"),
    )


def ordered_head(df: DataFrame, order: Sequence[str], rows: int) -> DataFrame:
    """The first rows in a stated order."""
    return df.orderBy(*order).limit(rows)


def seeded_sample(df: DataFrame, key: Sequence[str], seed: int, rows: int) -> DataFrame:
    """A repeatable sample: the rows whose seeded key digest is smallest, in any engine that has MD5."""
    return df.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), *key)), *key).limit(rows)
