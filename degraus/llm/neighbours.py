"""Approximate nearest neighbours by cross-polytope hashing with multiprobe tables and exact reranking.

Vectors are brought to unit length for hashing and padded to a power of two. In each table a fast pseudo-rotation (three
rounds of random signs and a Hadamard transform) turns them, and the nearest signed axis is the bucket. A query probes,
in every table, the buckets of its ``probes`` largest coordinates; the vectors found there are compared with it in double
precision on the original values, block by block, and only the nearest of a block are passed on.

A bucket is dealt out over salts according to its size, so a bucket that a third of all rows fall into is read by many
tasks; its queries go to every salt. No pair of a query and a vector is ever written except the nearest of a block.

Defined cases: vectors that are null or zero, or hold null or non-finite components, take no part, neither as queries nor
as candidates; vectors are searched among those with as many components; a query whose probes find fewer than ``k`` is
compared with all of those, and gets all candidates if there are fewer; ties in distance go to the smaller id; equal
vectors of different ids are candidates each; repeated rows of an id and vector count once; a null id takes no part;
components of any finite size are compared without overflow; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from degraus.session import stored

TABLES, PROBES, ROUNDS, SEED = 12, 8, 3, 20
#: Vectors of a bucket that one task compares.
BLOCK = 2_000


@lru_cache(maxsize=4)
def signs(tables: int, size: int) -> np.ndarray:
    """Random signs of every table and round."""
    return np.random.default_rng(SEED).choice(np.array([-1.0, 1.0]), size=(tables, ROUNDS, size))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of rows whose length is a power of two, scaled to keep lengths."""
    n, size = x.shape
    half = 1
    while half < size:
        pairs = x.reshape(n, size // (2 * half), 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, size)
        half *= 2
    return x / np.sqrt(size)


def rotated(vectors: np.ndarray, table: int, tables: int = TABLES) -> np.ndarray:
    """Unit vectors (n, size) after the pseudo-rotation of a table."""
    for flip in signs(tables, vectors.shape[1])[table]:
        vectors = hadamard(vectors * flip)
    return vectors


def units(vectors: np.ndarray) -> np.ndarray:
    """Unit length, padded with zeros to a power of two."""
    size = 1 << max(1, vectors.shape[1] - 1).bit_length()
    padded = np.zeros((len(vectors), max(size, 2)))
    largest = np.abs(vectors).max(axis=1, keepdims=True)  # first scaled, so no square overflows or vanishes
    scaled = vectors / largest
    padded[:, : vectors.shape[1]] = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
    return padded


def buckets(turned: np.ndarray, probes: int) -> np.ndarray:
    """Signed axes in order of nearness: (n, probes), axis ``i`` as 2 i, or 2 i + 1 if negative."""
    both = np.stack([turned, -turned], axis=2).reshape(len(turned), -1)
    probes = min(probes, both.shape[1])
    if probes == 1:
        return both.argmax(axis=1)[:, None]
    top = np.argpartition(-both, probes - 1, axis=1)[:, :probes]
    return np.take_along_axis(top, np.argsort(-np.take_along_axis(both, top, 1), axis=1, kind="stable"), 1)


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _placed(tables: int, probes: int):
    """(table, bucket) rows of each vector: of the nearest axis, or of a query's probes. Vectors of another number of
    components have tables of their own."""

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            for n, alike in frame.groupby(frame["vector"].map(len)):
                turned_from = units(np.stack(alike["vector"].to_numpy()).astype(np.float64))
                for table in range(tables):
                    found = buckets(rotated(turned_from, table, tables), probes)
                    yield pd.DataFrame({
                        "table": n * tables + table, "bucket": found.reshape(-1),
                        "id": np.repeat(alike["id"].to_numpy(), found.shape[1]),
                        "vector": np.repeat(alike["vector"].to_numpy(), found.shape[1]),
                    })

    return place


def nearest_of_block(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query id, id and distance of the ``k`` nearest vectors to each query, the query's own id left out."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    # Squares of huge components would overflow; only then are all brought down, and the distances up again, by a power
    # of two, so that a distance is the same in every block.
    largest = max(np.abs(queries).max(initial=0.0), np.abs(vectors).max(initial=0.0))
    scale = 2.0 ** np.floor(np.log2(largest)) if largest > 1e100 else 1.0
    if scale != 1.0:
        queries, vectors = queries / scale, vectors / scale
    for at in range(0, len(queries), 128):
        q, own = queries[at : at + 128], query_ids[at : at + 128]
        # A first estimate by the product form, then the exact measure for those that may be among the nearest.
        rough = (q * q).sum(1)[:, None] + (vectors * vectors).sum(1)[None] - 2 * q @ vectors.T
        rough[own[:, None] == ids[None]] = np.inf
        take = min(k, len(ids))
        limit = np.partition(rough, take - 1, axis=1)[:, take - 1]
        slack = 1e-9 * (np.abs(limit) + (q * q).sum(1) + (vectors * vectors).sum(1).max()) + 1e-300
        for row in range(len(q)):
            near = np.flatnonzero((rough[row] <= limit[row] + slack[row]) & np.isfinite(rough[row]))
            distance = np.sqrt(((vectors[near] - q[row]) ** 2).sum(axis=1)) * scale
            best = np.lexsort((ids[near], distance))[:k]
            out.append((np.full(len(best), own[row]), ids[near][best], distance[best]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(column) for column in zip(*out, strict=True))


def nearest(
    vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
    tables: int = TABLES, probes: int = PROBES,
) -> DataFrame:
    """Of every query row: ``query_id``, ``rank`` from 1, id and ``score`` (distance) of the ``k`` nearest found."""
    clean = vectors.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    schema = "table int, bucket int, id long, vector array<double>"
    index = stored(clean.select("id", "vector").mapInPandas(_placed(tables, 1), schema), "index")
    asked = clean.where("asks").select("id", "vector").mapInPandas(_placed(tables, probes), schema)
    # At most tables * 2 * (padded size) rows for each number of components.
    salts = index.groupBy("table", "bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("salts"))
    dealt = index.join(F.broadcast(salts), ["table", "bucket"]).withColumn("salt", F.expr("pmod(xxhash64(id), salts)"))
    sent = asked.join(F.broadcast(salts), ["table", "bucket"]).withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts").cast("long") - 1))
    )

    def compare(own: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(others):
            return pd.DataFrame({"query_id": [], "id": [], "score": []})
        query_ids, ids, scores = nearest_of_block(
            own["id"].to_numpy(), np.stack(own["vector"].to_numpy()), others["other_id"].to_numpy(),
            np.stack(others["other_vector"].to_numpy()), k,
        )
        return pd.DataFrame({"query_id": query_ids, "id": ids, "score": scores})

    key = ["table", "bucket", "salt"]

    def best(sent: DataFrame, dealt: DataFrame) -> DataFrame:
        asking = sent.select(*key, "id", "vector").groupBy(*key)
        held = dealt.select(*(F.col(c).alias(f"other_{c}") for c in (*key, "id", "vector"))).groupBy(
            *(f"other_{c}" for c in key)
        )
        found = asking.cogroup(held).applyInPandas(compare, "query_id long, id long, score double")
        # The same vector comes from many tables; tables * probes * k rows of a query at most.
        every = F.sort_array(F.collect_list(F.struct("score", "id")))
        once = found.groupBy("query_id", "id").agg(F.min("score").alias("score"))
        return once.groupBy("query_id").agg(F.slice(every, 1, k).alias("hits"))

    hits = stored(best(sent, dealt), "hits")
    full = hits.where(F.size("hits") >= k)
    short = clean.where("asks").select("id", "vector").join(
        full.select(F.col("query_id").alias("id")), "id", "left_anti"
    )
    if not short.isEmpty():
        # Every vector is in one bucket of the first table; these queries go to all of them.
        first = salts.where(F.col("table") % tables == 0)
        everywhere = short.withColumn("table", F.size("vector") * tables).join(F.broadcast(first), "table").withColumn(
            "salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts").cast("long") - 1))
        )
        hits = full.union(best(everywhere, dealt.where(F.col("table") % tables == 0)))
    return hits.select("query_id", F.posexplode("hits").alias("place", "hit")).select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("hit.id").alias(id_col), F.col("hit.score").alias("score")
    )
