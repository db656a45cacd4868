"""Packing of documents into sequences of several permitted lengths, best fit first.

The plan is made on the histogram of lengths, not on the documents: equal lengths are placed in bulk, so the driver holds
at most one entry per length up to the longest sequence, however many documents there are. Lengths are taken in falling
order; a piece goes to the open bin it fills best; if none fits, the bin size opens that costs least per token it can
hope to hold; in the end every bin shrinks to the smallest permitted length that holds its contents. This is repeated
with each permitted length as the largest one to open by choice, and the plan of least total cost is kept.

The documents then find their places in parallel: the rank of a piece among those of its length gives its bin.

Defined cases: texts longer than the longest sequence are cut into whole sequences and a rest, nothing is dropped; a
document without tokens gets one row with 0 tokens and null bin; repeated rows are placed one by one; equal lengths are
interchangeable, so ties do not change the cost; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from degraus.llm.token_counts import counter
from degraus.session import stored

CAPACITIES = (512, 1024, 2048, 4096, 8192)
#: Cost of a sequence beside its tokens, in tokens.
OVERHEAD = 64
#: Rows of one length that are numbered together.
NUMBERED = 512


@dataclass
class Plan:
    """``runs``: (length, first rank, pieces, first bin, pieces per bin, offset in the bin), in order of length and rank.

    ``bins``: (first bin, bins, tokens in each, capacity after downsizing)."""

    runs: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)
    bins: list[tuple[int, int, int, int]] = field(default_factory=list)
    cost: int = 0


def _fitting(length: int, capacities: Sequence[int]) -> int:
    return capacities[bisect_left(capacities, length)]


def _planned(histogram: Mapping[int, int], capacities: Sequence[int], largest: int, overhead: int) -> Plan:
    plan = Plan()
    open_bins: dict[int, list[tuple[int, int, int]]] = defaultdict(list)  # residual -> (first bin, bins, capacity)
    residuals: list[int] = []
    next_bin = 0
    left = sum(length * n for length, n in histogram.items())

    def keep(residual: int, first: int, bins: int, capacity: int) -> None:
        if bins:
            if not open_bins[residual]:
                insort(residuals, residual)
            open_bins[residual].append((first, bins, capacity))

    for length in sorted(histogram, reverse=True):
        n, rank = histogram[length], 0
        while rank < n:
            at = bisect_left(residuals, length)
            if at < len(residuals):
                residual = residuals[at]
                first, bins, capacity = open_bins[residual].pop()
                if not open_bins[residual]:
                    residuals.pop(at)
            else:
                allowed = [c for c in capacities if c >= length and c <= max(largest, _fitting(length, capacities))]
                capacity = min(allowed, key=lambda c: ((c + overhead) / min(c, left), c))
                residual, first = capacity, next_bin
                bins = -(-(n - rank) // (capacity // length))
                next_bin += bins
            each = residual // length
            full = min(bins, (n - rank) // each)
            if full:
                plan.runs.append((length, rank, full * each, first, each, capacity - residual))
                keep(residual - each * length, first, full, capacity)
                rank += full * each
                left -= full * each * length
            rest = min(n - rank, each - 1) if full < bins else 0
            if rest:
                plan.runs.append((length, rank, rest, first + full, rest, capacity - residual))
                keep(residual - rest * length, first + full, 1, capacity)
                rank += rest
                left -= rest * length
            keep(residual, first + full + bool(rest), bins - full - bool(rest), capacity)
    for residual, groups in open_bins.items():
        for first, bins, capacity in groups:
            size = _fitting(capacity - residual, capacities)
            plan.bins.append((first, bins, capacity - residual, size))
            plan.cost += bins * (size + overhead)
    plan.bins.sort()
    return plan


def plan_bins(histogram: Mapping[int, int], capacities: Sequence[int] = CAPACITIES, overhead: int = OVERHEAD) -> Plan:
    """The cheapest plan over all choices of the largest sequence length to open freely. Lengths are 1 to the longest."""
    capacities = sorted(capacities)
    return min((_planned(histogram, capacities, c, overhead) for c in capacities), key=lambda plan: plan.cost)


def with_token_counts(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``n_tokens`` of every document."""
    import pyarrow as pa

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = counter(tokenizer_file)(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(counts, pa.int64())], names=["id", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(count, f"id {rows.schema['id'].dataType.simpleString()}, n_tokens long")


def pack(
    sized: DataFrame, id_col: str = "id", tokens_col: str = "n_tokens", capacities: Sequence[int] = CAPACITIES,
    overhead: int = OVERHEAD,
) -> DataFrame:
    """Per piece: id, ``piece``, ``piece_start``, ``n_tokens``, ``bin_id``, ``bin_capacity``, ``bin_offset``."""
    import pandas as pd

    longest = max(capacities)
    pieces = stored(
        sized.select(
            F.col(id_col).alias("id"),
            F.coalesce(F.col(tokens_col), F.lit(0)).cast("long").alias("tokens"),
        ).select(
            "id", "tokens",
            F.explode(F.sequence(F.lit(0), F.greatest(F.floor((F.col("tokens") - 1) / longest), F.lit(0)))).alias("piece"),
        ).select(
            "id", F.col("piece").cast("int").alias("piece"), (F.col("piece") * longest).alias("piece_start"),
            F.least(F.col("tokens") - F.col("piece") * longest, F.lit(longest)).alias("length"),
            F.xxhash64("id", "piece").alias("deal"),
        ),
        "pieces",
    )
    # One row per length, ``longest`` at most.
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    parts = sized.sparkSession.createDataFrame(
        [(length, 1 + n // NUMBERED) for length, n in histogram.items()], "length long, parts int"
    )
    plan = plan_bins({length: n for length, n in histogram.items() if length}, capacities, overhead)
    runs = np.array(sorted(plan.runs), dtype=np.int64).reshape(-1, 6)
    bins = np.array(plan.bins, dtype=np.int64).reshape(-1, 4)

    dealt = pieces.join(F.broadcast(parts), "length").withColumn("part", F.expr("pmod(deal, parts)"))
    counts = dealt.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("length", "part").orderBy("id", "piece")
    ranked = (
        dealt.withColumn("place", F.row_number().over(inside)).join(starts, ["length", "part"])
        .select("id", "piece", "piece_start", "length", (F.col("start") + F.col("place") - 1).alias("rank"))
    )

    def placed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in frames:
            length, rank = x["length"].to_numpy(), x["rank"].to_numpy()
            filled = length > 0
            at = np.zeros(len(x), dtype=np.int64)
            if len(runs):
                at = _last_not_after(runs[:, 0], runs[:, 1], length, rank)
                _, first_rank, _, first_bin, each, offset = runs[at].T
                bin_id = first_bin + (rank - first_rank) // each
                capacity = bins[np.searchsorted(bins[:, 0], bin_id, side="right") - 1, 3]
                start = offset + (rank - first_rank) % each * length
            else:
                bin_id = capacity = start = at
            whole = lambda v: pd.Series(v).astype("Int64").where(pd.Series(filled))
            yield pd.DataFrame({
                "id": x["id"], "piece": x["piece"], "piece_start": x["piece_start"], "n_tokens": length,
                "bin_id": whole(bin_id), "bin_capacity": whole(capacity), "bin_offset": whole(start),
            })

    kind = sized.schema[id_col].dataType.simpleString()
    return ranked.mapInPandas(
        placed,
        f"id {kind}, piece int, piece_start long, n_tokens long, bin_id long, bin_capacity long, bin_offset long",
    ).withColumnRenamed("id", id_col)


def _last_not_after(lengths: np.ndarray, ranks: np.ndarray, length: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Index of the last of the sorted (length, rank) pairs that is not after each given pair."""
    low, high = np.searchsorted(lengths, length, "left"), np.searchsorted(lengths, length, "right")
    while (open_ := high - low > 1).any():
        middle = (low + high) // 2
        after = open_ & (ranks[np.minimum(middle, len(ranks) - 1)] > rank)
        high = np.where(after, middle, high)
        low = np.where(open_ & ~after, middle, low)
    return np.minimum(low, len(lengths) - 1)
