"""Set similarity join by chosen paths: MinHash near-duplicate documents on word shingles.

Every distinct shingle set is reduced to ``COORDINATES`` minwise hashes. A tree starts with all sets in its root. A node
selects ``BRANCHES`` coordinates, drawn from its own name, and each of its sets goes down one path per selected
coordinate, to the child named by the minwise value it has there. Two sets of similarity ``s`` stay together on a share
``s`` of the paths, so with two branches they are met somewhere in a tree with probability ``p``, the fixed point of
``p = 1 - (1 - s * p) ** 2``: 0.969 at 0.85, more above it. ``trees`` independent trees miss a pair with probability
``(1 - p) ** trees``, and the number of trees follows from the recall asked for (``trees_for``).

A node of up to ``SMALL`` sets is compared exhaustively. A larger one branches again, unless its sets agree so much that
its children together would hold no fewer pairs than it does (``ALIKE``): a group of near copies would only be written
over and over. Such a node, and one that is still large at ``deepest`` levels, is compared exhaustively too, hub by hub
(``linked_lists``), which takes as many rounds as it needs and leaves out pairs of sets that are one component already.
Nothing is capped: nodes of any size are compared whole, and every candidate is confirmed on the full sets.

The first ``FIRST_LEVELS`` levels are taken in one step, for their nodes are large in any corpus worth a join.

Shingles are compared by 64-bit hash, sets by the 64-bit sum and size of their mixed hashes.

Defined cases: null, empty and blank texts have the empty set and link with nothing; a text with fewer words than a
shingle has one shingle, its whole sequence; equal sets and repeated rows are one item from the start and fall into one
component; ties do not arise, because the smallest id names a component; a row without id is kept in the result and its
component is named by the smallest id in it, or null if there is none, and it counts as kept only in that last case; very
long texts are taken whole, each in the memory of one task; an empty table gives an empty result; only the id and text
columns are read, so other columns may have any name.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from degraus.llm.common import slices
from degraus.llm.components import linked_lists
from degraus.llm.jaccard_join import parity, set_id, shingle_sets
from degraus.session import discard, release, stored

#: Minwise hashes of a set, coordinates a node selects, sets of a node that needs no more branching.
COORDINATES, BRANCHES, SMALL = 64, 2, 32
FIRST_LEVELS, DEEPEST = 3, 10
#: A node whose pairs stay together on more than this share of the paths does not branch: its children would hold as many
#: pairs to compare as it does.
ALIKE = 1 / BRANCHES
#: Chance that a pair of just the least similarity is never met.
MOST_MISSED = 1e-6

STEP, ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def met_in_a_tree(similarity: float, branches: int = BRANCHES) -> float:
    """Chance that a tree, however deep, brings two sets of this similarity into one of its last nodes."""
    p = 1.0
    for _ in range(200):
        p = 1 - (1 - similarity * p) ** branches
    return p


def trees_for(percent: int, most_missed: float = MOST_MISSED) -> int:
    """Independent trees that miss a pair of ``percent`` similarity with at most this probability."""
    return max(1, math.ceil(math.log(most_missed) / math.log(1 - met_in_a_tree(percent / 100))))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * ODD
    x = (x ^ (x >> np.uint64(29))) * STEP
    return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=1)
def _functions() -> tuple[np.ndarray, np.ndarray]:
    """Random masks and odd factors of the minwise functions, the same in every worker."""
    rng = np.random.default_rng(13)
    drawn = rng.integers(0, 1 << 64, (2, COORDINATES), dtype=np.uint64)
    return drawn[0], drawn[1] | np.uint64(1)


def minwise(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Minwise hashes of sets that lie one after the other: a row of 32-bit values for each; empty sets have zeros."""
    masks, factors = _functions()
    found = np.zeros((len(bounds) - 1, COORDINATES), np.uint32)
    filled = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(filled):
        starts = bounds[filled]
        for i in range(COORDINATES):
            lows = np.minimum.reduceat((hashes ^ masks[i]) * factors[i], starts)
            found[filled, i] = (lows >> np.uint64(32)).astype(np.uint32)
    return found


def children(nodes: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The nodes that sets go to: ``nodes`` are those they are in, ``values`` their minwise hashes, row by row."""
    paths = np.empty((len(nodes), BRANCHES), np.uint64)
    rows = np.arange(len(nodes))
    drawn = _mixed(nodes + STEP)
    first = drawn % np.uint64(COORDINATES)
    for j in range(BRANCHES):
        # Selected coordinates differ: each lies a drawn, but smaller than full, circle further on.
        width = np.uint64((COORDINATES - 1) // max(1, BRANCHES - 1))
        at = first
        if j:
            at = (first + np.uint64(j - 1) * width + np.uint64(1) + _mixed(drawn + np.uint64(j)) % width) % np.uint64(
                COORDINATES
            )
        value = values[rows, at.astype(np.int64)].astype(np.uint64)
        paths[:, j] = _mixed(_mixed(nodes ^ (value * STEP)) + at * ODD + np.uint64(j))
    return paths


def _sets(texts: list[str | None], width: int):
    for run in slices((t or "" for t in texts), 1_000_000):
        yield len(run), *shingle_sets(run, width)


def _signed(width: int):
    """Id, size, parity and minwise hashes of the set of every document."""
    import pyarrow as pa

    def sign(batches):
        for batch in batches:
            row = 0
            for n, hashes, bounds in _sets(batch.column(1).to_pylist(), width):
                sets = [hashes[bounds[i] : bounds[i + 1]] for i in range(n)]
                with np.errstate(over="ignore"):
                    lows = minwise(hashes, bounds)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, n),
                    pa.array([set_id(x) for x in sets], pa.int64()),
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.array([parity(x) for x in sets], pa.list_(pa.int64())),
                    pa.array(list(lows.view(np.int32)), pa.list_(pa.int32())),
                ], names=["doc", "id", "n", "parity", "lows"])
                row += n

    return sign


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy().view(np.uint32).reshape(-1, COORDINATES)


def _planted(trees: int):
    """The nodes of every set after the first levels of all trees."""
    import pyarrow as pa

    def plant(batches):
        for batch in batches:
            values, ids = _matrix(batch.column(1)), batch.column(0).to_numpy()
            with np.errstate(over="ignore"):
                roots = _mixed(np.arange(1, trees + 1, dtype=np.uint64) * STEP)
                nodes, rows = np.repeat(roots, len(ids)), np.tile(np.arange(len(ids)), trees)
                for _ in range(FIRST_LEVELS):
                    nodes = children(nodes, values[rows]).reshape(-1)
                    rows = np.repeat(rows, BRANCHES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes.view(np.int64)), pa.array(ids[rows])], names=["key", "id"]
            )

    return plant


def _branched(batches):
    """One level more, with the node each set comes from."""
    import pyarrow as pa

    for batch in batches:
        above, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        with np.errstate(over="ignore"):
            nodes = children(above.view(np.uint64), _matrix(batch.column(2))).reshape(-1)
        yield pa.RecordBatch.from_arrays([
            pa.array(nodes.view(np.int64)), pa.array(np.repeat(ids, BRANCHES)), pa.array(np.repeat(above, BRANCHES)),
        ], names=["key", "id", "above"])


def _confirmed(width: int, percent: int):
    """Pairs whose whole sets link."""
    import pyarrow as pa

    def confirm(batches):
        for batch in batches:
            keep = []
            both = [t for pair in zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist()) for t in pair]
            left = None
            for n, hashes, bounds in _sets(both, width):
                for i in range(n):
                    own = hashes[bounds[i] : bounds[i + 1]]
                    if left is None:
                        left = own
                        continue
                    common = len(np.intersect1d(left, own, assume_unique=True))
                    keep.append(100 * common >= percent * (len(left) + len(own) - common))
                    left = None
            chosen = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(chosen), batch.column("b").filter(chosen)], names=["a", "b"]
            )

    return confirm


def last_nodes(sets: DataFrame, trees: int, deepest: int = DEEPEST, small: int = SMALL) -> DataFrame:
    """``(key, id)`` of the sets in every node that is compared: two sets or more in each.

    ``sets(id, lows)`` has one row per set. A level's nodes are counted; small ones are done, large ones branch. A node
    that its children would hardly thin out is done as well, at its own level.
    """
    nodes = stored(sets.select("id", "lows").mapInArrow(_planted(trees), "key long, id long"), "path-nodes")
    done = []
    for level in range(FIRST_LEVELS, deepest + 1):
        sizes = nodes.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
        sized = stored(nodes.join(sizes, "key").select("key", "id", "size"), "path-sized")
        last = level == deepest
        done.append(sized.where(F.lit(last) | (F.col("size") <= small)).select("key", "id"))
        large = sized.where(F.lit(not last) & (F.col("size") > small))
        if large.isEmpty():
            break
        discard(nodes)
        below = stored(
            large.select("key", "id").join(sets.select("id", "lows"), "id").select("key", "id", "lows")
            .mapInArrow(_branched, "key long, id long, above long"),
            "path-below",
        )
        # The chance that a set meets another one of its node in a child: pairs that stay together in all pairs.
        counts = below.groupBy("above", "key").agg(F.count("*").cast("double").alias("n"))
        alike = counts.groupBy("above").agg(
            (F.sum(F.col("n") * (F.col("n") - 1)) / (F.sum("n") * (F.sum("n") / BRANCHES - 1))).alias("share")
        ).where(F.col("share") > ALIKE).select("above")
        done.append(large.select("key", "id").join(alike.withColumnRenamed("above", "key"), "key", "left_semi"))
        nodes = below.join(alike, "above", "left_anti").select("key", "id")
    lists = done[0]
    for more in done[1:]:
        lists = lists.union(more)
    return stored(lists, "path-lists")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 85,
    most_missed: float = MOST_MISSED, deepest: int = DEEPEST,
) -> DataFrame:
    """Per document: id, ``n_shingles``, ``component_id`` (the smallest id that links reach) and ``kept``."""
    rows = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    signed = stored(
        rows.mapInArrow(
            _signed(width), f"doc {kind}, id long, n long, parity array<long>, lows array<int>"
        ),
        "path-signatures",
    )
    sets = stored(
        signed.where("n > 0").groupBy("id").agg(
            F.min("doc").alias("doc"), F.first("n").alias("n"), F.first("parity").alias("parity"),
            F.first("lows").alias("lows"),
        ),
        "path-sets",
    )
    spark = docs.sparkSession
    lists = last_nodes(sets, trees_for(percent, most_missed), deepest)
    release(spark)
    stand = stored(sets.drop("lows").join(lists.select("id").distinct(), "id", "left_semi"), "path-stand")
    members = stored(lists.join(stand.drop("doc"), "id"), "path-members")
    # What is wanted grows with the documents, so it is not broadcast where it happens to be small.
    wanted = stand.select(F.col("doc").alias("wanted")).distinct().hint("merge")
    texts = stored(
        rows.join(wanted, F.col("doc").eqNullSafe(F.col("wanted")), "left_semi").select("text")
        .mapInArrow(_named(width), "id long, text string").join(stand.select("id"), "id", "left_semi")
        .groupBy("id").agg(F.first("text").alias("text")),
        "path-texts",
    )

    def near(x, y):
        apart = sum((F.bit_count(x("parity")[i].bitwiseXOR(y("parity")[i])) for i in range(8)), F.lit(0))
        return (100 * F.least(x("n"), y("n")) >= percent * F.greatest(x("n"), y("n"))) & (
            (100 - percent) * (x("n") + y("n")) >= (100 + percent) * apart
        )

    def check(pairs: DataFrame) -> DataFrame:
        met = pairs.join(texts.withColumnsRenamed({"id": "a", "text": "ta"}), "a").join(
            texts.withColumnsRenamed({"id": "b", "text": "tb"}), "b"
        )
        return met.mapInArrow(_confirmed(width, percent), "a long, b long")

    labels = linked_lists(members, near, check)
    discard(texts, lists, stand)
    rooted = stored(
        sets.select("id", "doc").join(labels.withColumnRenamed("node", "id"), "id", "left")
        .select("id", "doc", F.coalesce("root", "id").alias("root")),
        "path-roots",
    )
    named = rooted.groupBy("root").agg(F.min("doc").alias("component"))
    of_set = rooted.join(named, "root").select("id", "component")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc"))
    return signed.select("doc", "id", "n").join(of_set, "id", "left").select(
        F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("doc").eqNullSafe(component).alias("kept"),
    )


def _named(width: int):
    """Texts with the id of their set."""
    import pyarrow as pa

    def name(batches):
        for batch in batches:
            row, texts = 0, batch.column(0)
            for n, hashes, bounds in _sets(texts.to_pylist(), width):
                ids = [set_id(hashes[bounds[i] : bounds[i + 1]]) for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), texts.slice(row, n)], names=["id", "text"]
                )
                row += n

    return name
