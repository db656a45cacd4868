"""Near-duplicate lines by a segment-partition edit join, in DataFrame expressions only.

Two lines link if they are equal, or if their edit distance is at most what the length of the shorter one permits:
``least_chars`` has the characters needed for one edit, two edits and so on. Lines are joined once for each number of
edits, cut into one even segment more than that, by the least length of a range of lengths, so that all lines of a range
are cut alike; the front segments are counted from the start of a line, the others from its end. Within that distance one
segment of the one line stands unchanged in the other one, near its own place: as many edits away as segments lie between
it and its end of the line. A line gives keys (range, segment, text) for its segments and the places beside them, also
for the range below if a partner may be in it. The keys' lists go through ``linked_lists``, so a segment that many lines
share is not compared all against all, and pairs are verified by a banded bit-parallel edit distance. A line's class is
its component; the first line of a class, by (document id, line number), is kept.

Lines are compared exactly by text when verified; equal lines are found by 64-bit hash.

Defined cases: null and empty texts and blank lines have no lines here; equal lines within a text are duplicates too;
ties in (id, line number), which only repeated ids have, go by the hash of the text, and repeated rows share one
verdict; a null id sorts first; an empty table gives an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from degraus.llm.common import let, words_of
from degraus.llm.components import linked_lists
from degraus.session import discard, release, stored

EDITS, LEAST_CHARS = 2, 48
#: Least characters for one and for two edits, as the queries ask for: one edit in ten characters. In less, another
#: letter is another word.
NEAR_CHARS = (10, 20)


def _range(n: Column, edits: int, low: int) -> Column:
    """Least length of the range that ``n`` is in, from ``low`` on. No range is shorter than ``edits``, so a line and one
    by so many characters shorter are in the same or in neighbouring ones."""
    unit = 1 << max(1, (edits - 1).bit_length())
    width = F.when(n < 16 * unit, unit).when(n < 32 * unit, 2 * unit).otherwise(4 * unit)
    return F.greatest(n - n % width, F.lit(low))


def places(edits: int) -> list[tuple[int, int]]:
    """(segment, shift) of all keys of a line in one range.

    If two lines are at most ``edits`` apart, some segment ``i`` is unchanged with at most ``i`` edits before it and
    ``edits - i`` behind it. For two edits a shift by one to the left is enough for the segment in the middle: if it
    stands one place further right, an insertion lies before it; either the first segment is unchanged, or the middle of
    the other line stands one place further left here."""
    found = []
    for i in range(edits + 1):
        most = min(i, edits - i)
        found += [(i, shift) for shift in range(-most, 1 if edits <= 2 else most + 1)]
    return found


def _keys(line: Column, n: Column, edits: int, least: Column) -> list[Column]:
    """Keys of a line of ``n`` characters in the range from ``least`` on."""
    keys, parts = [], edits + 1
    for i, shift in places(edits):
        start, stop = (F.floor(least * j / parts).cast("int") for j in (i, i + 1))
        ahead = 0 if 2 * i <= edits else n - least
        text = F.substring(line, start + ahead + shift + 1, stop - start)
        keys.append(F.xxhash64(F.lit(edits), F.lit(i), least, text))
    return keys


def _keys_by_length(line: Column, n: Column, least: Sequence[int]) -> Column:
    """Keys of a line for every number of edits that it and a shorter or longer partner are permitted."""
    found = []
    for edits, (low, high) in enumerate(zip(least, [*least[1:], None], strict=True), 1):
        if high is not None and low >= high:
            continue
        # The shorter line of a pair is in the bounds of its number of edits, the longer one may be beyond them.
        inside = n >= low if high is None else (n >= low) & (n < high + edits)
        own, below = _range(n, edits, low), _range(F.greatest(n - edits, F.lit(low)), edits, low)
        found.append(F.when(inside, F.array(*_keys(line, n, edits, own))))
        found.append(F.when(inside & (below < own), F.array(*_keys(line, n, edits, below))))
    return F.flatten(F.filter(F.array(*found), lambda keys: keys.isNotNull()))


def _parity(items: Column, cell) -> Column:
    """64 bits: for each cell whether an odd number of items falls there; a negative cell is none."""

    def flipped(bits: Column, i: Column) -> Column:
        one = F.lit(1).cast("long")
        return bits.bitwiseXOR(let(cell(i), lambda c: F.when(c >= 0, F.call_function("shiftleft", one, c)).otherwise(0)))

    return F.aggregate(items, F.lit(0).cast("long"), flipped)


def line_parities(chars: Column) -> Column:
    """Three words of parity bits of an array of characters: its characters, and its neighbouring pairs in two words.

    An edit flips at most two bits of characters and four of pairs."""

    def of_char(i: Column) -> Column:
        return F.xxhash64(F.get(chars, i)).bitwiseAND(F.lit(63)).cast("int")

    def of_pair(word: int):
        def cell(i: Column) -> Column:
            dealt = F.xxhash64(F.get(chars, i), F.get(chars, i + 1)).bitwiseAND(F.lit(127)).cast("int") - 64 * word
            return let(dealt, lambda c: F.when(c < 64, c).otherwise(-1))

        return cell

    singles, pairs = F.sequence(F.lit(0), F.size(chars) - 1), F.sequence(F.lit(0), F.size(chars) - 2)
    return F.struct(
        _parity(singles, of_char).alias("chars"),
        _parity(pairs, of_pair(0)).alias("pairs"),
        _parity(pairs, of_pair(1)).alias("more_pairs"),
    )


def banded_distance(a: Column, b: Column, most: int) -> Column:
    """Edit distance of two arrays of characters whose sizes differ by ``most`` at most; larger than ``most`` if it is.

    One word per column holds the vertical differences of the ``2 * most + 1`` cells around the diagonal. The distance
    is followed down the lower edge of the band until the last character of ``a``, then along the bottom row.
    """
    width = 2 * most + 2
    full = (1 << width) - 1

    def bit(at: int) -> Column:
        return F.lit(1 << at).cast("long")

    def down(x: Column) -> Column:
        return F.call_function("shiftright", x, F.lit(1))

    def invert(x: Column) -> Column:
        return x.bitwiseXOR(F.lit(full).cast("long"))

    def step(state: Column, i: Column) -> Column:
        def same(here: Column) -> Column:
            marks = [
                F.when(F.get(a, i + shift) == here, bit(width - 1 - most + shift)).otherwise(F.lit(0).cast("long"))
                for shift in range(-most, most + 1)
            ]
            return reduce(add, marks)

        vp, vn = state["vp"], state["vn"]

        def columns(x: Column) -> Column:
            carry = (x.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseAND(F.lit(full).cast("long"))
            return let(carry.bitwiseOR(x).bitwiseOR(vn), moved)

        def moved(d0: Column) -> Column:
            hp = vn.bitwiseOR(invert(d0.bitwiseOR(vp)))
            hn = d0.bitwiseAND(vp)
            return let(F.struct(hp.alias("hp"), hn.alias("hn")), lambda h: advanced(d0, h["hp"], h["hn"]))

        def advanced(d0: Column, hp: Column, hn: Column) -> Column:
            past = i - (F.size(a) - most)  # columns since the band met the bottom row
            mask = F.call_function("shiftright", bit(width - 2), F.greatest(past, F.lit(0)))
            along = (
                F.when(hp.bitwiseAND(mask) != 0, 1).otherwise(0) - F.when(hn.bitwiseAND(mask) != 0, 1).otherwise(0)
            )
            diagonal = F.when(d0.bitwiseAND(bit(width - 1)) != 0, 0).otherwise(1)
            shifted = down(d0)
            return F.struct(
                hn.bitwiseOR(invert(shifted.bitwiseOR(hp))).alias("vp"),
                shifted.bitwiseAND(hp).alias("vn"),
                (state["d"] + F.when(past < 0, diagonal).otherwise(along)).alias("d"),
            )

        return let(let(F.get(b, i), same), columns)

    first = F.struct(
        F.lit(full ^ ((1 << (width - most - 1)) - 1)).cast("long").alias("vp"),
        F.lit(0).cast("long").alias("vn"),
        F.least(F.size(a), F.lit(most)).alias("d"),
    )
    return F.aggregate(F.sequence(F.lit(0), F.size(b) - 1), first, step)["d"]


def _common_start(a: Column, b: Column) -> Column:
    """Characters that two strings begin with alike, by bisection."""
    least = F.least(F.length(a), F.length(b))

    def longer(n: Column, power: Column) -> Column:
        more = n + power
        return F.when((more <= least) & (F.substring(a, 1, more) == F.substring(b, 1, more)), more).otherwise(n)

    return F.aggregate(F.array(*(F.lit(1 << e) for e in range(20, -1, -1))), F.lit(0), longer)


def _without_start(pair: Column) -> Column:
    """The strings ``a`` and ``b`` of a pair, reversed, without what they begin with alike."""
    n = _common_start(pair["a"], pair["b"])
    return let(
        n,
        lambda n: F.struct(
            F.reverse(F.substring(pair["a"], n + 1, F.length(pair["a"]))).alias("a"),
            F.reverse(F.substring(pair["b"], n + 1, F.length(pair["b"]))).alias("b"),
        ),
    )


def line_distance(a: Column, b: Column, most: int) -> Column:
    """Edit distance of two lines, as in ``banded_distance``. What both begin or end with cannot change it."""

    def middle(pair: Column) -> Column:
        sizes = F.length(pair["a"]), F.length(pair["b"])
        banded = let(
            F.split(pair["a"], ""), lambda x: let(F.split(pair["b"], ""), lambda y: banded_distance(x, y, most))
        )
        return F.when(F.abs(sizes[0] - sizes[1]) > most, most + 1).when(
            F.least(*sizes) == 0, F.greatest(*sizes)
        ).otherwise(banded)

    both = F.struct(a.alias("a"), b.alias("b"))
    return let(let(let(both, _without_start), _without_start), middle)


def line_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS,
    least_chars: int | Sequence[int] = LEAST_CHARS,
) -> DataFrame:
    """Per line with a word: ``doc``, ``text_hash``, ``line_no``, ``n_chars``, ``first_doc``, ``first_line``,
    ``first_hash`` (of the text that line is in), ``kept``.

    ``least_chars`` rises with the number of edits; a single number holds for all."""
    least = [least_chars] * edits if isinstance(least_chars, int) else list(least_chars)[:edits]
    edits = len(least)
    lines = docs.select(
        F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("text_hash"),
        F.posexplode(F.split(text_col, "\n")).alias("line_no", "line"),
    ).where(F.col("line").rlike(r"[^\x20\x09-\x0D]")).select(
        "doc", "text_hash", "line_no", "line", F.xxhash64("line").alias("id"), F.length("line").alias("n")
    )
    long_lines = lines.where(F.col("n") >= least[0])
    where = stored(lines.select("doc", "text_hash", "line_no", "id", F.col("n").alias("n_chars")), "line-places")

    keyed = long_lines.select(F.explode(_keys_by_length(F.col("line"), F.col("n"), least)).alias("key"), "id")
    same_key = Window.partitionBy("key")
    meeting = stored(
        keyed.withColumns({"low": F.min("id").over(same_key), "high": F.max("id").over(same_key)})
        .where("low <> high").select("key", "id").distinct(),
        "line-meeting",
    )
    release(docs.sparkSession)
    texts = stored(
        long_lines.select("id", "line").join(meeting.select("id").distinct(), "id", "left_semi")
        .groupBy("id").agg(F.first("line").alias("line"))
        .select("id", "line", F.length("line").alias("n"), let(F.split("line", ""), line_parities).alias("parity")),
        "line-texts",
    )
    members = stored(meeting.join(texts.select("id", "n", "parity"), "id"), "line-members")
    discard(meeting)

    def permitted(shorter: Column) -> Column:
        return reduce(add, (F.when(shorter >= chars, 1).otherwise(0) for chars in least))

    def near(x, y):
        def apart(word: str) -> Column:
            return F.bit_count(x("parity")[word].bitwiseXOR(y("parity")[word]))

        most = permitted(F.least(x("n"), y("n")))
        return (
            (F.abs(x("n") - y("n")) <= most)
            & (apart("chars") <= 2 * most)
            & (apart("pairs") + apart("more_pairs") <= 4 * most)
        )

    def check(pairs: DataFrame) -> DataFrame:
        both = pairs.join(texts.select(F.col("id").alias("a"), F.col("line").alias("la")), "a").join(
            texts.select(F.col("id").alias("b"), F.col("line").alias("lb")), "b"
        )
        # Few bytes but much work: keep them in as many tasks as any shuffle has.
        tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return both.repartition(tasks).where(
            line_distance(F.col("la"), F.col("lb"), edits) <= permitted(F.least(F.length("la"), F.length("lb")))
        ).select("a", "b")

    labels = linked_lists(members, near, check)
    discard(texts)
    classed = stored(
        where.join(labels.select(F.col("node").alias("id"), "root"), "id", "left")
        .withColumn("root", F.coalesce("root", "id")).drop("id"),
        "line-classes",
    )
    discard(where, labels)
    firsts = classed.groupBy("root").agg(F.min(F.struct("doc", "line_no", "text_hash")).alias("first"))
    return classed.join(firsts, "root").select(
        "doc", "text_hash", "line_no", "n_chars",
        F.col("first.doc").alias("first_doc"), F.col("first.line_no").alias("first_line"),
        F.col("first.text_hash").alias("first_hash"),
        F.struct("doc", "line_no", "text_hash").eqNullSafe(F.col("first")).alias("kept"),
    )


def _without(text: Column, repeated: Column) -> Column:
    """A text without the lines of these numbers."""
    kept = let(
        repeated,
        lambda gone: F.array_join(F.filter(F.split(text, "\n"), lambda line, i: ~F.array_contains(gone, i)), "\n"),
    )
    return F.when(repeated.isNull(), text).otherwise(kept)


def shingles(text: Column, width: int) -> Column:
    """Distinct word shingles of a text by hash, cut as in ``jaccard_join``."""

    def cut(words: Column) -> Column:
        whole = F.transform(
            F.sequence(F.lit(0), F.size(words) - width), lambda i: F.xxhash64(F.slice(words, i + 1, F.lit(width)))
        )
        return F.when(F.size(words) >= width, F.array_distinct(whole)).when(
            F.size(words) > 0, F.array(F.xxhash64(words))
        ).otherwise(F.array().cast("array<long>"))

    return let(words_of(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), cut)


def _proven_copies(
    docs: DataFrame, losses: DataFrame, id_col: str, text_col: str, width: int, percent: int
) -> DataFrame:
    """``(doc, text_hash)`` of documents in ``losses`` that are ``torn`` and, whole, link with what is left of one
    document of a smaller id that is not: the one with most of their repeated lines."""
    torn = losses.where(F.col("torn") & F.col("copied").isNotNull()).select("doc", "text_hash", "copied.*")
    wanted = torn.select("doc", "text_hash").union(torn.select("first_doc", "first_hash")).distinct()
    texts = stored(
        docs.select(F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
        .join(wanted, ["doc", "text_hash"], "left_semi").dropDuplicates(["doc", "text_hash"])
        .join(losses.select("doc", "text_hash", "repeated", "torn"), ["doc", "text_hash"], "left"),
        "line-copies",
    )
    left = texts.where("torn is null or not torn").select(
        F.col("doc").alias("first_doc"), F.col("text_hash").alias("first_hash"),
        shingles(_without(F.col("text"), F.col("repeated")), width).alias("theirs"),
    )
    own = texts.select("doc", "text_hash", shingles(F.col("text"), width).alias("own"))
    both = torn.join(own, ["doc", "text_hash"]).join(left, ["first_doc", "first_hash"]).select(
        "doc", "text_hash", F.size("own").alias("m"), F.size("theirs").alias("n"),
        F.size(F.array_intersect("own", "theirs")).alias("common"),
    )
    return both.where(
        (F.col("common") > 0) & (100 * F.col("common") >= percent * (F.col("m") + F.col("n") - F.col("common")))
    ).select("doc", "text_hash")


def drop_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_lost_percent: int = 50, width: int = 5,
    percent: int = 80, **limits: int | Sequence[int],
) -> DataFrame:
    """``docs`` without the lines that repeat an earlier one; same columns, documents without any line left go.

    A document that would lose more than ``most_lost_percent`` of its characters is not torn up but left whole if it is
    a proven copy: its ``width``-word shingles and those of one document with a smaller id, as that one leaves here, have
    a Jaccard similarity of ``percent`` or more. Document-level deduplication at these limits removes it.
    """
    key = ["doc", "text_hash"]
    earlier = F.when(
        (F.col("first_doc") < F.col("doc")) & (F.col("lost") > 0), F.struct("lost", "first_doc", "first_hash")
    )
    losses = stored(
        line_classes(docs, id_col, text_col, **limits)
        .groupBy(*key, "first_doc", "first_hash")
        .agg(
            F.collect_list(F.when(~F.col("kept"), F.col("line_no"))).alias("repeated"),
            F.sum("n_chars").alias("chars"),
            F.sum(F.when(~F.col("kept"), F.col("n_chars")).otherwise(0)).alias("lost"),
        )
        .groupBy(*key)
        .agg(
            F.flatten(F.collect_list("repeated")).alias("repeated"),
            F.max(earlier).alias("most"), F.sum("chars").alias("chars"), F.sum("lost").alias("lost"),
        )
        .where(F.size("repeated") > 0)
        .select(
            *key, "repeated", (100 * F.col("lost") > most_lost_percent * F.col("chars")).alias("torn"),
            F.when(F.col("most").isNotNull(), F.struct("most.first_doc", "most.first_hash")).alias("copied"),
        ),
        "line-losses",
    )
    whole = _proven_copies(docs, losses, id_col, text_col, width, percent)
    lost = losses.join(whole, key, "left_anti").select(
        F.col("doc").alias("__doc"), F.col("text_hash").alias("__hash"), F.col("repeated").alias("__repeated")
    )
    return (
        docs.join(
            lost, docs[id_col].eqNullSafe(lost["__doc"]) & (F.xxhash64(docs[text_col]) == lost["__hash"]), "left"
        )
        .withColumn(text_col, _without(F.col(text_col), F.col("__repeated")))
        .where(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"))
        .select(*docs.columns)
    )
