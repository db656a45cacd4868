"""Jaccard join of documents on word shingles: light sets by enumerated subsets, heavy sets by inverted lists.

A set links with another when ``100 * intersection >= percent * union``. Equal sets are one item from the start.

* Light sets (at most ``boundary`` shingles): for every size a partner may have, all subsets of the overlap that a link
  needs are enumerated. Two light sets share such a subset exactly if they link.
* Heavy sets: the space of hashes is cut into one block more than the shingles in which two linked sets of that size
  class can differ, so at least one block is equal in both. The contents of a block, not a single shingle, is the token
  of the inverted lists: a passage or word pair that thousands of documents share makes no list of its own, only sets
  that agree in a whole block meet. Lists are scanned hub by hub (``linked_lists``) and pairs are verified on whole sets.
* The boundary is the size up to which enumerating costs no more rows than scanning and verifying. Sets whose partner may stand on the other side of the boundary take part in the inverted lists too.

Shingles are compared by 64-bit hash, sets by the 64-bit sum and size of their mixed hashes.

Defined cases: null, empty and blank texts have the empty set and link with nothing; a text with fewer words than a
shingle has one shingle, its whole sequence; repeated rows and equal sets fall into one component; ties do not arise,
because the smallest id names a component; null ids are kept and named by the component's smallest id, if it has any;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from degraus.llm.components import linked_lists
from degraus.llm.common import slices
from degraus.session import discard, release, stored

SEED, STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
#: Beyond this size the costs need no comparing: subsets grow by powers, tokens in proportion.
MOST_LIGHT = 24
#: Cuts of a set that has many empty blocks.
CUTS = 5
#: Bytes of a text that are hashed at once, and the length from which a word is hashed by itself: both bound memory.
BLOCK = 1 << 20


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of ``x``."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * STEP
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=8)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    base = int(SEED)
    inverse = pow(base, -1, 1 << 64)
    with np.errstate(over="ignore"):
        up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, base, dtype=np.uint64)]), dtype=np.uint64)
        down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, inverse, dtype=np.uint64)]), dtype=np.uint64)
    return up, down


def _word_hashes(lower: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Hashes of the words that begin and stop at these bytes, block by block."""
    found = np.empty(len(starts), np.uint64)
    long_words = np.flatnonzero(stops - starts > BLOCK)
    up, down = _powers(2 * BLOCK)
    first = 0
    while first < len(starts):
        if stops[first] - starts[first] > BLOCK:
            digest = hashlib.blake2b(lower[starts[first] : stops[first]].tobytes(), digest_size=8).digest()
            found[first] = np.frombuffer(digest, np.uint64)[0]
            first += 1
            continue
        # Words that begin within a block of the first one and are none of the long ones.
        last = int(np.searchsorted(starts, starts[first] + BLOCK))
        if len(long_words):
            last = min([last, *long_words[long_words > first][:1]])
        begin, low, high = int(starts[first]), starts[first:last], stops[first:last]
        block = lower[begin : int(high[-1])].astype(np.uint64) + np.uint64(1)
        sums = np.append(np.uint64(0), np.cumsum(block * up[: len(block)]))
        found[first:last] = _mixed((sums[high - begin] - sums[low - begin]) * down[low - begin] + (high - low).astype(np.uint64))
        first = last
    return found


def shingle_sets(texts: list[str | None], width: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, one text after the other, and the bounds of each."""
    data = [("" if t is None else t).encode("utf-8", "surrogatepass") + b" " for t in texts]
    joined = np.frombuffer(b"".join(data), dtype=np.uint8)
    ends = np.cumsum([len(x) for x in data])
    if not len(joined):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    lower = np.where((joined >= 65) & (joined <= 90), joined + 32, joined)
    blank = (joined == 32) | ((joined >= 9) & (joined <= 13))
    word = ~blank
    starts = np.flatnonzero(word & np.concatenate([[True], blank[:-1]]))
    stops = np.flatnonzero(blank & np.concatenate([[False], word[:-1]]))
    with np.errstate(over="ignore"):
        words = _word_hashes(lower, starts, stops)
        document = np.searchsorted(ends, starts, side="right")
        counts = np.bincount(document, minlength=len(texts))
        first = np.concatenate([[0], np.cumsum(counts)])
        hashes = words.copy()
        for k in range(1, width):
            hashes = _mixed(hashes * SEED + np.concatenate([words[k:], np.zeros(min(k, len(words)), np.uint64)])[: len(words)])
        # A shingle starts at every word that has enough words after it in its own text.
        whole = np.arange(len(words)) + width <= first[document + 1] if len(words) else np.zeros(0, bool)
        hashes, of = hashes[whole], document[whole]
        short = np.flatnonzero((counts > 0) & (counts < width))
        if len(short):
            one = []
            for d in short:
                h = np.uint64(counts[d])
                for w in words[first[d] : first[d + 1]]:
                    h = _mixed(np.array([h * SEED + w], dtype=np.uint64))[0]
                one.append(h)
            hashes, of = np.concatenate([hashes, np.array(one, np.uint64)]), np.concatenate([of, short])
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    hashes, of = hashes[new], of[new]
    return hashes, np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(texts)))])


def needed(a: int, b: int, percent: int) -> int:
    """Smallest intersection with which sets of these sizes link."""
    return -(-percent * (a + b) // (100 + percent))


def partners(size: int, percent: int) -> range:
    """Sizes that a linked set can have."""
    return range(-(-percent * size // 100), size * 100 // percent + 1)


@lru_cache(maxsize=100_000)
def _class_of(size: int, percent: int) -> tuple[int, int]:
    """Class of a size and the blocks of the class. A size at most 100/percent times as large is in it or the next."""
    low, k = 1, 0
    while True:
        high = max(low + 1, -(-low * 100 // percent))  # sizes low to high - 1
        if size < high:
            a = high - 1
            b = a * 100 // percent
            return k, max(a + x - 2 * needed(a, x, percent) for x in range(a, b + 1)) + 1
        low, k = high, k + 1


@lru_cache(maxsize=1_000)
def _blocks_of_class(k: int, percent: int) -> int:
    low = 1
    for _ in range(k):
        low = max(low + 1, -(-low * 100 // percent))
    return _class_of(low, percent)[1]


def light_cost(size: int, percent: int) -> int:
    """Subsets that a set of this size enumerates."""
    return sum(math.comb(size, min(needed(size, b, percent), size)) for b in partners(size, percent))


def heavy_cost(size: int, percent: int) -> int:
    """Tokens that a set of this size adds to inverted lists, and the shingles that its verification moves."""
    k, blocks = _class_of(size, percent)
    return blocks + (_blocks_of_class(k - 1, percent) if k else 0) + size


def chosen_boundary(percent: int) -> int:
    """The size up to which enumerating costs no more than scanning. Costs add up over sets, so sizes are told apart."""
    size = 0
    while size < MOST_LIGHT and light_cost(size + 1, percent) <= heavy_cost(size + 1, percent):
        size += 1
    return size


def _block_tokens(hashes: np.ndarray, k: int, percent: int) -> Iterator[np.ndarray]:
    """Tokens of the blocks of class ``k``.

    An empty block is equal in too many sets to be a token, so there are ``spare`` blocks more than needed. Linked sets
    whose equal blocks are all empty then both have more than ``spare`` empty blocks; such sets are cut anew by another
    hash as well, and only the last of several cuts keeps its empty blocks.
    """
    least = _blocks_of_class(k, percent)
    spare = 2 + least // 16
    blocks = least + spare
    edge = np.arange(blocks, dtype=np.uint64) * np.uint64((1 << 64) // blocks)
    for cut in range(CUTS):
        dealt = hashes if cut == 0 else np.sort(_mixed(hashes + np.uint64(cut) * STEP))
        at = np.append(np.searchsorted(dealt, edge), len(dealt))
        total = np.append(np.uint64(0), np.cumsum(_mixed(dealt ^ SEED), dtype=np.uint64))
        place = np.arange(blocks, dtype=np.uint64) + np.uint64(k * CUTS + cut + 1) * SEED
        tokens = _mixed(total[at[1:]] - total[at[:-1]] + _mixed(place))
        filled = at[1:] > at[:-1]
        if cut == CUTS - 1:
            yield tokens
            return
        yield tokens[filled]
        if blocks - filled.sum() <= spare:
            return


def keys_of(hashes: np.ndarray, percent: int, boundary: int) -> list[np.ndarray]:
    """List keys of a set, as arrays of 64-bit hashes."""
    size, keys = len(hashes), []
    with np.errstate(over="ignore"):
        if 0 < size <= boundary:
            for other in partners(size, percent):
                if other <= boundary:
                    tag = np.uint64(min(size, other) * 1009 + max(size, other))
                    subsets = np.array(list(combinations(hashes, needed(size, other, percent))), dtype=np.uint64)
                    keys.append(_mixed(_mixed(subsets).sum(axis=1, dtype=np.uint64) + tag * SEED))
        if size and (size > boundary or max(partners(size, percent)) > boundary):
            k, _ = _class_of(size, percent)
            for own in (k, k - 1):
                if own >= 0:
                    keys += _block_tokens(hashes, own, percent)
    return keys


def set_id(hashes: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        return int(_mixed(np.array([_mixed(hashes).sum(dtype=np.uint64) + np.uint64(len(hashes)) * SEED]))[0].view(np.int64))


def parity(hashes: np.ndarray) -> np.ndarray:
    """For each of 512 cells whether it holds an odd number of shingles. Two sets differ in at least as many shingles
    as their parities differ in cells."""
    cells = np.bincount((hashes >> np.uint64(7)).astype(np.int64) & 511, minlength=512) & 1
    return np.packbits(cells.astype(np.uint8)).view(np.int64)


def _runs(texts: list[str | None], width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """First row and sets of each run of texts."""
    row = 0
    for run in slices((t or "" for t in texts), 1_000_000):
        hashes, bounds = shingle_sets(run, width)
        yield row, [hashes[bounds[i] : bounds[i + 1]] for i in range(len(run))]
        row += len(run)


def _listed(width: int, percent: int, boundary: int):
    """Keys and id of every set."""
    import pyarrow as pa

    def listed(batches):
        for batch in batches:
            for _, sets in _runs(batch.column(0).to_pylist(), width):
                keys = [np.concatenate(k) if (k := keys_of(x, percent, boundary)) else np.zeros(0, np.uint64) for x in sets]
                ids = np.repeat([set_id(x) for x in sets], [len(k) for k in keys])
                flat = np.concatenate(keys).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(flat), pa.array(ids.astype(np.int64))], names=["key", "id"]
                )

    return listed


def _signatures(width: int):
    """Id, size and parity of the set of every document."""
    import pyarrow as pa

    def signed(batches):
        for batch in batches:
            for row, sets in _runs(batch.column(1).to_pylist(), width):
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, len(sets)),
                    pa.array([set_id(x) for x in sets], pa.int64()),
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array([parity(x) for x in sets], pa.list_(pa.int64())),
                ], names=["doc", "id", "n", "parity"])

    return signed


def _named_texts(width: int):
    """Texts with the id of their set."""
    import pyarrow as pa

    def named(batches):
        for batch in batches:
            for row, sets in _runs(batch.column(0).to_pylist(), width):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([set_id(x) for x in sets], pa.int64()), batch.column(0).slice(row, len(sets))],
                    names=["id", "text"],
                )

    return named


def _linked_pairs(width: int, percent: int):
    """Pairs whose whole sets link."""
    import pyarrow as pa

    def linked(batches):
        for batch in batches:
            a, b = batch.column("ta").to_pylist(), batch.column("tb").to_pylist()
            keep = np.zeros(len(a), bool)
            for (row, left), right in zip(_runs(a, width), _same_runs(a, b, width), strict=True):
                for i, (x, y) in enumerate(zip(left, right, strict=True)):
                    n = len(np.intersect1d(x, y, assume_unique=True))
                    keep[row + i] = 100 * n >= percent * (len(x) + len(y) - n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(pa.array(keep)), batch.column("b").filter(pa.array(keep))], names=["a", "b"]
            )

    return linked


def _same_runs(a: list[str], b: list[str], width: int) -> Iterator[list[np.ndarray]]:
    """Sets of ``b``, in the runs that ``a`` is cut into."""
    row = 0
    for run in slices((t or "" for t in a), 1_000_000):
        hashes, bounds = shingle_sets(b[row : row + len(run)], width)
        yield [hashes[bounds[i] : bounds[i + 1]] for i in range(len(run))]
        row += len(run)


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, percent: int = 90
) -> DataFrame:
    """Per document: id, ``n_shingles`` and ``component_id``, the smallest id that links reach."""
    boundary = chosen_boundary(percent)
    rows = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind, spark = rows.schema["doc"].dataType.simpleString(), docs.sparkSession
    signed = stored(
        rows.mapInArrow(_signatures(width), f"doc {kind}, id long, n long, parity array<long>"), "signatures"
    )
    # One document stands for each set.
    stand = stored(
        signed.groupBy("id").agg(F.min("doc").alias("doc"), F.first("n").alias("n"), F.first("parity").alias("parity")),
        "stand",
    )
    # Most keys belong to one set and are of no more use. Keys and ids are dealt out once, and both sides of the join read
    # that; the filter, which drops nothing, is what the join would add to one side, so that the sides stay the same.
    listed = (
        rows.select("text").mapInArrow(_listed(width, percent, boundary), "key long, id long").where("key is not null")
        .repartition("key")
    )
    shared = (
        listed.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last"))
        .where("first <> last").select("key", "first")
    )
    members = stored(listed.join(shared.hint("shuffle_hash"), "key").distinct(), "members")
    release(spark)

    def near(x, y):
        apart = sum((F.bit_count(x("parity")[i].bitwiseXOR(y("parity")[i])) for i in range(8)), F.lit(0))
        return (
            (100 * F.least(x("n"), y("n")) >= percent * F.greatest(x("n"), y("n")))
            & ((100 - percent) * (x("n") + y("n")) >= (100 + percent) * apart)
        )

    read: list[DataFrame] = []

    def check(pairs: DataFrame) -> DataFrame:
        discard(*read)
        read.clear()
        if pairs.isEmpty():
            return pairs
        # Far more sets share a key than have a pair to check, so texts are looked up for each round's pairs alone.
        ends = stored(
            pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(stand.select("id", "doc"), "id"),
            "ends",
        )
        # What is wanted grows with the documents, so it is not broadcast where it happens to be small.
        wanted = ends.select(F.col("doc").alias("wanted")).distinct().hint("merge")
        texts = stored(
            rows.join(wanted, F.col("doc").eqNullSafe(F.col("wanted")), "left_semi").select("text")
            .mapInArrow(_named_texts(width), "id long, text string")
            .join(ends.select("id"), "id", "left_semi")
            .groupBy("id").agg(F.first("text").alias("text")),
            "texts",
        )
        discard(ends)
        release(spark)
        read.append(texts)
        met = pairs.join(texts.withColumnsRenamed({"id": "a", "text": "ta"}), "a").join(
            texts.withColumnsRenamed({"id": "b", "text": "tb"}), "b"
        )
        return met.mapInArrow(_linked_pairs(width, percent), "a long, b long")

    labels = linked_lists(members, near, check, stand.drop("doc"))
    discard(*read)
    rooted = stored(
        stand.where("n > 0").select("id", F.col("doc").alias("low"))
        .join(labels.withColumnRenamed("node", "id"), "id", "left")
        .select("id", "low", F.coalesce("root", "id").alias("root")),
        "classes",
    )
    discard(stand)
    named = rooted.groupBy("root").agg(F.min("low").alias("component"))
    of_set = rooted.join(named, "root").select("id", "component")
    return (
        signed.select("doc", "id", "n").join(of_set, "id", "left")
        .select(F.col("doc").alias(id_col), F.col("n").alias("n_shingles"),
                F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc")).alias("component_id"))
    )


def first_of_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits: int) -> DataFrame:
    """``docs`` without the documents whose component has a smaller id; same columns. Repeated rows of one id and text
    count as one and stay."""
    found = jaccard_components(docs, id_col, text_col, **limits)
    gone = (
        found.where(~F.col(id_col).eqNullSafe(F.col("component_id"))).select(F.col(id_col).alias("__gone")).distinct()
    )
    return docs.join(gone, docs[id_col].eqNullSafe(gone["__gone"]), "left_anti")
