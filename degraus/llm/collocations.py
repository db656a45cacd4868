"""Phrase collocations by FM-indexes: what occurs together far more often than its parts by themselves.

Documents are dealt into shards of bounded size where they lie, without moving a text. A shard holds the words of one
language as ids, pieces kept apart by a break. It is indexed once words that are too rare everywhere are known: they are
breaks too, for no candidate holds them. The index is an FM-index in both directions: the Burrows-Wheeler transforms of
the shard's ids and of their reverse, sorted as deep as the longest phrase. A phrase is a pair of intervals, one in each
index, and grows by a word on the left or on the right: the words that the transform holds in its interval are its
extensions, how often they stand there are their counts, and the last-to-first mapping gives their intervals.

Counts are summed across shards. Phrases of two words go first; those that are frequent over all shards go back to each
shard that holds them, as places in its own list. From there it grows phrases of three words, which come back likewise,
and then all longer ones, whose counts a task sums over its shards before they go across. A phrase is counted if the
phrase without its first word, extended to the left, and the phrase without its last, extended to the right, are the same
interval, so both of them are frequent.

A language's scores are exact integers (decimal products of up to 38 digits). A candidate goes if a phrase with one more
word is as frequent: if any longer one is, then so is one with a single word more.

Defined cases: a null language is ``und``; null, empty and blank texts, and texts of break characters, have no words;
repeated rows count as often as they stand there; ties are broken by the phrase in byte order, so ranks are total; a very
long text is a shard of its own, held in the memory of one task as its row is; other columns are not read, so they may
have any name; an empty table, or one without a frequent phrase, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from degraus.session import discard, release, stored

LONGEST, LEAST, MOST_RANKED = 5, 100, 2000
#: UTF-8 bytes after which a shard is closed; it ends with the text that reaches them.
SHARD_BYTES = 4_000_000
# Bytes that end a piece, and those between words.
BREAKS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
#: Words are numbered within so many buckets of a language's words, each of at most 2**23.
BUCKETS, PER_BUCKET = 256, 1 << 23


# --- Words -------------------------------------------------------------------------------------


def words_in_pieces(texts: list[bytes]):
    """Ids of the words of all texts from 1 on, 0 between pieces, and the words by id from 0 on, as an Arrow array."""
    import pyarrow as pa

    joined = b"\n".join([*texts, b""])
    lower = joined.lower()  # of bytes: A-Z alone
    kind = np.zeros(256, np.uint8)
    kind[list(BLANKS)], kind[list(BREAKS)] = 1, 2
    kinds = np.frombuffer(joined.translate(kind.tobytes()), np.uint8)
    visible = kinds == 0
    starts = np.flatnonzero(visible & ~np.append(False, visible[:-1]))
    ends = np.flatnonzero(~visible & np.append(False, visible[:-1]))
    if not len(starts):
        return np.zeros(0, np.int32), pa.array([], pa.string())
    # Words with the gaps after them, as one array whose every second value is a word.
    edges = np.empty(2 * len(starts) + 1, np.int64)
    edges[:-1:2], edges[1::2], edges[-1] = starts, ends, len(joined)
    coded = pa.Array.from_buffers(
        pa.large_string(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(lower)]
    ).take(pa.array(np.arange(0, len(edges) - 1, 2))).dictionary_encode()
    ids = coded.indices.to_numpy() + 1
    piece = np.searchsorted(np.flatnonzero(kinds == 2), starts)
    new_piece = np.append(False, piece[1:] != piece[:-1])
    at = np.arange(len(ids)) + np.cumsum(new_piece)
    sequence = np.zeros(int(at[-1]) + 1, np.int32)
    sequence[at] = ids
    return sequence, coded.dictionary.cast(pa.string())


def _kept(ids: np.ndarray):
    """An array of ids as one binary value: Spark then moves it whole, not number by number."""
    import pyarrow as pa

    return pa.array([ids.astype("<i4").tobytes()], pa.binary())


def _ids(value) -> np.ndarray:
    """The array that ``_kept`` made the value of."""
    return np.frombuffer(value.as_buffer(), "<i4")


def _shards(shard_bytes: int):
    """Shards of the texts of a task, per language: name, language, words, their counts, and the ids in order."""
    import pyarrow as pa
    from pyspark import TaskContext

    def deal(batches):
        task, number = TaskContext.get().partitionId(), 0
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def closed(lang: str):
            nonlocal number
            sequence, words = words_in_pieces(held.pop(lang))
            del sizes[lang]
            number += 1
            return pa.RecordBatch.from_arrays([
                pa.array([(task << 32) + number], pa.int64()), pa.array([lang]),
                pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words),
                pa.array([np.bincount(sequence, minlength=len(words) + 1)[1:]], pa.list_(pa.int64())),
                _kept(sequence),
            ], names=["shard", "lang", "words", "counts", "sequence"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                coded = text.as_buffer().to_pybytes()
                held.setdefault(lang, []).append(coded)
                sizes[lang] = sizes.get(lang, 0) + len(coded) + 1
                # All languages of a task share the bound, so many small ones take no more memory than a large one.
                if sum(sizes.values()) >= shard_bytes:
                    yield closed(max(sizes, key=sizes.get))
        for lang in list(held):
            yield closed(lang)
        pa.default_memory_pool().release_unused()

    return deal


# --- The index ---------------------------------------------------------------------------------


def _sorted(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order, with their places. Equal keys have rising places, and keep that order; nothing is negative."""
    bits = int(places.max(initial=0)).bit_length()
    if int(keys.max(initial=0)).bit_length() + bits > 63:
        order = np.argsort(keys, kind="stable")
        return keys[order], places[order]
    # Both fit into one number: sorting values is several times as fast as finding their order.
    both = np.sort((keys.astype(np.int64) << bits) | places)
    return both >> bits, (both & ((1 << bits) - 1)).astype(places.dtype)


def suffix_order(sequence: np.ndarray, depth: int) -> np.ndarray:
    """Places of a sequence, ordered by the next ``depth`` ids; what begins alike is in any order."""
    places = np.arange(len(sequence), dtype=np.int32)
    ranks, known = sequence.astype(np.int64), 1
    order = None if depth > 1 else _sorted(ranks, places)[1]
    while known < depth:
        step = min(known, depth - known)  # two overlapping halves order as deep as they reach together
        after = np.append(ranks[step:], np.zeros(step, np.int64))[: len(ranks)]
        keys, order = _sorted(ranks * (int(ranks.max(initial=0)) + 1) + after, places)
        known += step
        if known < depth:
            ranks = np.empty(len(keys), np.int64)
            ranks[order] = np.cumsum(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return order


class FMIndex:
    """The transform of a sequence of ids from 1 on with breaks of 0, and the mapping from last to first."""

    def __init__(self, transform: np.ndarray):
        self.transform = transform
        _, order = _sorted(transform, np.arange(len(transform), dtype=np.int32))
        self.last_to_first = np.empty(len(transform), np.int32)
        self.last_to_first[order] = np.arange(len(transform), dtype=np.int32)

    @classmethod
    def of(cls, sequence: np.ndarray, depth: int) -> FMIndex:
        order = suffix_order(sequence, depth)
        return cls(sequence[order - 1])  # before the first id stands the last one, which is a break

    def extensions(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
        """All extensions of disjoint intervals by a word: which interval, word, count, first place of the extended
        interval, and how many places of the old one hold smaller ids."""
        sizes = high - low
        base = int(self.transform.max(initial=0)) + 1
        place = np.arange(int(sizes.sum()), dtype=np.int32)
        place += np.repeat((low - (np.cumsum(sizes) - sizes)).astype(np.int32), sizes)
        keys, place = _sorted(np.repeat(np.arange(len(low)) * base, sizes) + self.transform[place], place)
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
        owner, word = np.divmod(keys[first], base)
        count = np.diff(np.append(first, len(keys)))
        smaller = first - (np.cumsum(sizes) - sizes)[owner]
        real = word > 0
        return owner[real], word[real], count[real], self.last_to_first[place[first[real]]], smaller[real]


class PhraseIndex:
    """An index of a sequence and one of its reverse. A phrase is a row of its low ends in both, and its count."""

    def __init__(self, forward: FMIndex, backward: FMIndex):
        self.forward, self.backward = forward, backward

    @classmethod
    def of(cls, sequence: np.ndarray, depth: int = LONGEST) -> PhraseIndex:
        """``sequence`` begins and ends with a break."""
        return cls(FMIndex.of(sequence, depth), FMIndex.of(sequence[::-1], depth))

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Low ends (the same in both directions) and counts of the words, with their ids."""
        counts = np.bincount(self.forward.transform)
        ids = np.flatnonzero(counts[1:]) + 1
        return (np.cumsum(counts) - counts)[ids], counts[ids], ids

    def to_the_left(self, low: np.ndarray, back: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
        """Phrases with one more word in front: of which phrase, the word, low ends in both directions, count."""
        owner, word, n, first, smaller = self.forward.extensions(low, low + count)
        return owner, word, first, back[owner] + smaller, n

    def to_the_right(self, low: np.ndarray, back: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
        """Phrases with one more word behind, as ``to_the_left``."""
        owner, word, n, first, smaller = self.backward.extensions(back, back + count)
        return owner, word, low[owner] + smaller, first, n

    def pairs(self) -> tuple[np.ndarray, ...]:
        """All phrases of two words: both ids, low ends, count."""
        low, count, ids = self.words()
        owner, word, first, back, n = self.to_the_left(low, low, count)
        return word, ids[owner], first, back, n

    def longer(
        self, ids: np.ndarray, low: np.ndarray, back: np.ndarray, count: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Phrases with one word more whose two parts of the old length are both among the given ones: ids (one row a
        phrase), low ends and counts, in order of the intervals."""
        owner, word, first, back_first, n = self.to_the_left(low, back, count)
        _, _, right_first, _, _ = self.to_the_right(low, back, count)
        # A phrase is the same interval either way, so one that both ways reach has two of the given parts.
        met = np.isin(first, right_first)
        order = np.flatnonzero(met)[np.argsort(first[met])]
        grown = np.column_stack([word, ids[owner]])[order]
        return grown, first[order], back_first[order], n[order]

    def grown(self, longest: int, *chosen: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids and counts of the phrases with one word more than those that were chosen last, and so on up to
        ``longest``. ``chosen`` has places among the pairs, then among the phrases of three words grown from those."""
        first, second, low, back, n = self.pairs()
        found = np.column_stack([first, second]), low, back, n
        for places in chosen[:-1]:
            found = self.longer(*(x[places] for x in found))
        found = tuple(x[chosen[-1]] for x in found)
        while found[0].shape[1] < longest and len(found[0]):
            found = self.longer(*found)
            yield found[0], found[3]


def _indexed(longest: int):
    """The index of every shard: ids of its frequent words, and both transforms."""
    import pyarrow as pa

    def index(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                shard, sequence, places, numbers = (batch.column(i)[row] for i in range(4))
                numbers = numbers.values.to_numpy()
                sequence = _ids(sequence)
                own = np.zeros(len(sequence) + 2, np.int32)  # more than any word's place in the shard
                own[places.values.to_numpy() + 1] = np.arange(1, len(numbers) + 1)
                ids = own[np.append(np.append(np.int32(0), sequence), np.int32(0))]
                # Neighbouring breaks are one.
                ids = ids[np.append(True, (ids[1:] != 0) | (ids[:-1] != 0))]
                found = PhraseIndex.of(ids if len(ids) > 1 else np.zeros(2, np.int32), longest)
                yield pa.RecordBatch.from_arrays([
                    pa.array([shard.as_py()], pa.int64()),
                    pa.array([numbers.astype(np.int32)], pa.list_(pa.int32())),
                    _kept(found.forward.transform), _kept(found.backward.transform),
                ], names=["shard", "numbers", "forward", "backward"])
                del found, own, ids
        pa.default_memory_pool().release_unused()

    return index


def _opened(batch, row: int) -> tuple[int, np.ndarray, PhraseIndex]:
    """Shard, numbers of its ids (0 for the break) and index of a stored row."""
    numbers = np.append(0, batch.column("numbers")[row].values.to_numpy().astype(np.int64))
    ways = [FMIndex(_ids(batch.column(name)[row])) for name in ("forward", "backward")]
    return batch.column("shard")[row].as_py(), numbers, PhraseIndex(*ways)


def _pairs(batches):
    """The two-word phrases of every shard: both words' numbers as one key, place in the shard's list, and count."""
    import pyarrow as pa

    for batch in batches:
        for row in range(batch.num_rows):
            shard, numbers, index = _opened(batch, row)
            first, second, _, _, n = index.pairs()
            keys = (numbers[first] << 32) | numbers[second]
            for at in range(0, len(keys), 1 << 18):
                part = slice(at, at + (1 << 18))
                size = len(keys[part])
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys[part]), pa.array(np.full(size, shard, np.int64)),
                    pa.array(np.arange(at, at + size, dtype=np.int32)), pa.array(n[part].astype(np.int64)),
                ], names=["key", "shard", "at", "n"])
            del index, first, second, n, keys
    pa.default_memory_pool().release_unused()


def _rows(ids: np.ndarray, *columns: tuple[str, np.ndarray]):
    """Batches of phrases, one row of ``ids`` each, with further columns."""
    import pyarrow as pa

    for at in range(0, len(ids), 1 << 17):
        part = slice(at, at + (1 << 17))
        flat = ids[part].astype(np.int32).ravel()
        bounds = np.arange(0, len(flat) + 1, ids.shape[1], dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat)), *(pa.array(c[part]) for _, c in columns)],
            names=["ids", *(name for name, _ in columns)],
        )


def _triples(batches):
    """Phrases of three words grown from the pairs ``two`` of every shard: words' numbers, place in the shard's list, and
    count."""
    import pyarrow as pa

    for batch in batches:
        for row in range(batch.num_rows):
            shard, numbers, index = _opened(batch, row)
            two = np.sort(batch.column("two")[row].values.to_numpy())
            for ids, counts in index.grown(3, two):
                size = len(ids)
                yield from _rows(
                    numbers[ids], ("shard", np.full(size, shard, np.int64)), ("at", np.arange(size, dtype=np.int32)),
                    ("n", counts.astype(np.int64)),
                )
            del index
    pa.default_memory_pool().release_unused()


def _summed(ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct phrases and the sums of their counts."""
    order = np.lexsort(ids.T)
    ids, counts = ids[order], counts[order]
    first = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]).any(axis=1))[: len(ids)])
    return ids[first], np.add.reduceat(counts, first) if len(first) else counts


def _longer(longest: int, most: int = 1 << 20):
    """Phrases of four words and more grown from the triples ``three``: words' numbers, and counts summed over the shards
    of the task, which hands on what it has at ``most`` phrases."""
    import pyarrow as pa

    def grow(batches):
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def handed_on():
            for parts in held.values():
                ids, counts = _summed(*(np.concatenate(x) for x in zip(*parts)))
                yield from _rows(ids, ("n", counts.astype(np.int64)))
            held.clear()

        for batch in batches:
            for row in range(batch.num_rows):
                _, numbers, index = _opened(batch, row)
                chosen = [np.sort(batch.column(c)[row].values.to_numpy()) for c in ("two", "three")]
                for ids, counts in index.grown(longest, *chosen):
                    held.setdefault(ids.shape[1], []).append((numbers[ids].astype(np.int32), counts))
                    size += len(ids)
                del index
                if size >= most:
                    yield from handed_on()
                    size = 0
        yield from handed_on()
        pa.default_memory_pool().release_unused()

    return grow


# --- Over all shards -----------------------------------------------------------------------------


def _numbered(words: DataFrame) -> DataFrame:
    """``words(lang, word, n)`` with a ``number`` of 31 bits each, counted within buckets."""
    bucket = F.pmod(F.xxhash64("lang", "word"), F.lit(BUCKETS)).cast("int")
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("lang", "word"))
    fits = F.when(F.col("place") < PER_BUCKET, F.col("bucket") * PER_BUCKET + F.col("place")).otherwise(
        F.raise_error(F.lit("more frequent words than a bucket has numbers")).cast("int")
    )
    return words.withColumn("bucket", bucket).withColumn("place", place).select("lang", "word", "n", fits.alias("number"))


def phrase_counts(
    docs: DataFrame, text_col: str, lang_col: str, longest: int, least: int, shard_bytes: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frequent words ``(lang, word, n, number)``, words of a language ``(lang, n)``, and counts ``(ids, a)`` of all
    frequent phrases of one word to ``longest`` words, whose ids are word numbers."""
    rows = docs.select(
        F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    shards = stored(
        rows.mapInArrow(
            _shards(shard_bytes),
            "shard long, lang string, words array<string>, counts array<long>, sequence binary",
        ),
        "phrase-shards",
    )
    sizes = stored(
        shards.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda n, x: n + x).alias("n"))
        .groupBy("lang").agg(F.sum("n").alias("n")),
        "phrase-sizes",
    )
    counted = shards.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w")).groupBy(
        "lang", F.col("w.words").alias("word")
    ).agg(F.sum("w.counts").alias("n"))
    words = stored(_numbered(counted.where(F.col("n") >= least)), "phrase-words")
    own = (
        shards.select("shard", "lang", F.posexplode("words").alias("place", "word"))
        .join(words.select("lang", "word", "number").hint("shuffle_hash"), ["lang", "word"])
        .groupBy("shard").agg(F.collect_list(F.struct("place", "number")).alias("w"))
        .select("shard", "w.place", "w.number")
    )
    index = stored(
        shards.select("shard", "sequence").join(own, "shard").mapInArrow(
            _indexed(longest), "shard long, numbers array<int>, forward binary, backward binary"
        ),
        "phrase-index",
    )
    discard(shards)
    release(docs.sparkSession)
    everywhere = F.sum("n").over(Window.partitionBy("key"))
    pairs = stored(
        index.mapInArrow(_pairs, "key long, shard long, at int, n long").withColumn("a", everywhere)
        .where(F.col("a") >= least).select("key", "shard", "at", "a"),
        "phrase-pairs",
    )
    release(docs.sparkSession)
    chosen = index.join(pairs.groupBy("shard").agg(F.collect_list("at").alias("two")), "shard")
    threes = stored(
        chosen.mapInArrow(_triples, "ids array<int>, shard long, at int, n long")
        .withColumn("a", F.sum("n").over(Window.partitionBy("ids"))).where(F.col("a") >= least)
        .select("ids", "shard", "at", "a"),
        "phrase-threes",
    )
    release(docs.sparkSession)
    chosen = chosen.join(threes.groupBy("shard").agg(F.collect_list("at").alias("three")), "shard")
    longer = (
        chosen.mapInArrow(_longer(longest), "ids array<int>, n long")
        .groupBy("ids").agg(F.sum("n").alias("a")).where(F.col("a") >= least)
    )
    two = pairs.select("key", "a").distinct().select(
        F.array(
            F.shiftright("key", 32).cast("int"), F.col("key").bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
        ).alias("ids"),
        "a",
    )
    one = words.select(F.array("number").alias("ids"), F.col("n").alias("a"))
    found = [one, two, threes.select("ids", "a").distinct(), longer]
    counts = stored(reduce(DataFrame.union, found[: min(longest, 4)]), "phrase-counts")
    discard(index, pairs, threes)
    return words, sizes, counts


def _exact(count: Column) -> Column:
    return count.cast("decimal(19,0)")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST, least: int = LEAST,
    most_ranked: int = MOST_RANKED, shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Each language's best phrases: ``lang, rank, phrase, a, l, r, n, score``.

    ``a`` counts the phrase, ``l`` and ``r`` its two parts at the cut with the lowest score ``floor(1000 a n / (l r))``,
    the first of those that tie; ``n`` all words of the language.
    """
    words, sizes, counts = phrase_counts(docs, text_col, lang_col, longest, least, shard_bytes)
    phrases = counts.where(F.size("ids") > 1)
    m = F.size("ids")
    inside = (
        phrases.where(m > 2)
        .select(F.explode(F.array(F.slice("ids", F.lit(1), m - 1), F.slice("ids", F.lit(2), m - 1))).alias("ids"), "a")
        .groupBy("ids").agg(F.max("a").alias("longer"))
    )
    left_over = phrases.join(inside, "ids", "left").where("longer is null or longer < a").select("ids", "a")
    named = (
        left_over.select("ids", "a", F.posexplode("ids").alias("at", "number"))
        .join(words.select("number", "lang", "word"), "number")
        .groupBy("ids", "a").agg(F.first("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("at", "word"))).alias("w"))
        .select("ids", "a", "lang", F.array_join("w.word", " ").alias("phrase"))
    )
    cuts = named.join(sizes, "lang").select(
        "*", F.explode(F.sequence(F.lit(1), m - 1)).alias("k")
    ).withColumns({"first": F.slice("ids", F.lit(1), F.col("k")), "rest": F.slice("ids", F.col("k") + 1, m - F.col("k"))})
    scored = (
        cuts.join(counts.select(F.col("ids").alias("first"), F.col("a").alias("l")), "first")
        .join(counts.select(F.col("ids").alias("rest"), F.col("a").alias("r")), "rest")
        .withColumn(
            "score",
            F.call_function(
                "div", F.lit(1000).cast("decimal(4,0)") * (_exact(F.col("a")) * _exact(F.col("n"))),
                _exact(F.col("l")) * _exact(F.col("r")),
            ),
        )
        .groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    )
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # A language's phrases are thinned out in many tasks before one ranks what is left of them.
    salt = F.pmod(F.xxhash64("phrase"), F.lit(64))
    thinned = scored.withColumn("salt", salt).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))
    ).where(F.col("rank") <= most_ranked).drop("salt", "rank")
    return (
        thinned.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long"))
        .where(F.col("rank") <= most_ranked).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
