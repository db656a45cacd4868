"""Token counts with a digest cache: every distinct text is encoded once per tokenizer version.

The cache is a Parquet table ``(digest, n_tokens)`` below ``version=<digest of the tokenizer file>``. Documents are joined
to it on the SHA-256 of their text; what is missing is reduced to one row per digest, encoded in Python workers, and
appended. The counts do not depend on what the cache holds.

Normalisation of content: null becomes the empty text, nothing else, because any other change could change a count.

Defined cases: null and empty texts have 0 bytes and 0 tokens; equal texts share a digest and are encoded once; an
empty table gives an empty result and leaves the cache as it is. Only the id and text columns are read. A cache that two
runs filled at once may hold a digest twice with the same count; it is read once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from degraus.llm.common import path_exists, slices

#: Chunks remembered by a worker, the longest one it remembers, and new chunks encoded as one text; the first two only
#: bound memory.
REMEMBERED, LONGEST, JOINED = 1_000_000, 64, 256


def chunk_bounds(data: np.ndarray) -> np.ndarray:
    """Places of the blanks of UTF-8 bytes that begin a chunk: a visible character stands on either side.

    The pre-tokenizer never joins anything across such a blank: it may only begin a piece, so the chunks cut there are
    encoded independently. Of characters outside ASCII only those count as visible whose lead byte no white space has;
    a blank that is not cut changes no count.
    """
    at = np.flatnonzero(data[1:-1] == 32) + 1
    before, after = data[at - 1], data[at + 1]
    # Lead byte of the character before the blank, if it has two or three bytes; longer ones are no white space.
    tail = (before & 0xC0) == 0x80
    lead = np.where(tail, data[at - 2], before)
    lead = np.where((lead & 0xC0) == 0x80, data[at - 3], lead)
    visible = [
        ((x > 32) & (x < 127)) | ((x >= 0x80) & (x != 0xC2) & ((x < 0xE1) | (x > 0xE3))) for x in (lead, after)
    ]
    return at[visible[0] & visible[1]]


class ChunkCounter:
    """Token counts of whole texts by the tokenizers library, remembering the counts of blank-separated chunks."""

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(tokenizer_file)
        self._known: dict[bytes, int] = {}
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        # Fixed value: byte-level vocabularies write the blank as this letter.
        self._begins = np.zeros(max(vocabulary.values()) + 1, bool)
        self._begins[[i for token, i in vocabulary.items() if token.startswith("Ġ")]] = True

    def __call__(self, texts: Sequence[str]) -> list[int]:
        counts = []
        for run in slices(texts):
            counts += self._counted(run)
        return counts

    def _counted(self, texts: list[str]) -> list[int]:
        import pyarrow as pa

        known = self._known
        if len(known) > REMEMBERED:
            known.clear()
        # A line break after each text keeps the texts apart; it belongs to none of them.
        coded = [text.encode() for text in texts]
        sizes = np.array([len(x) for x in coded])
        joined = b"\n".join([*coded, b""])
        ends = np.cumsum(sizes + 1) - 1
        starts = ends - sizes
        bounds = np.sort(
            np.concatenate([starts, ends, chunk_bounds(np.frombuffer(joined, np.uint8))]), kind="stable"
        )
        bounds = bounds[np.append(True, bounds[1:] != bounds[:-1])]
        offsets = np.append(bounds, len(joined)).astype(np.int64)
        chunks = pa.Array.from_buffers(
            pa.large_binary(), len(bounds), [None, pa.py_buffer(offsets), pa.py_buffer(joined)]
        ).dictionary_encode()
        distinct = chunks.dictionary.to_pylist()
        new = [chunk for chunk in distinct if chunk not in known]
        known.update(zip(new, self._encoded([chunk.decode() for chunk in new]), strict=True))
        counts = np.fromiter(map(known.__getitem__, distinct), np.int64, len(distinct))
        sums = np.append(0, np.cumsum(counts[chunks.indices.to_numpy()]))
        for chunk in new:
            if len(chunk) > LONGEST:
                del known[chunk]
        return (sums[np.searchsorted(bounds, ends)] - sums[np.searchsorted(bounds, starts)]).tolist()

    def _encoded(self, chunks: list[str]) -> list[int]:
        """Counts of distinct chunks. Those that begin with their only blank and end visibly are encoded many at a time:
        each of them begins at the next token with a blank."""
        counts = dict.fromkeys(chunks, 0)
        plain = [c for c in chunks if c[:1] == " " and c.count(" ") == 1 and c == c.rstrip()]
        runs = [plain[at : at + JOINED] for at in range(0, len(plain), JOINED)]
        rest = set(chunks).difference(plain)
        for run, found in zip(runs, self._ids(["".join(run) for run in runs]), strict=True):
            ids = np.array(found)
            begins = np.append(np.flatnonzero(self._begins[ids]), len(ids))
            if len(begins) == len(run) + 1 and begins[0] == 0:
                counts.update(zip(run, np.diff(begins).tolist(), strict=True))
            else:
                rest.update(run)
        single = list(rest)
        counts.update(zip(single, map(len, self._ids(single)), strict=True))
        return list(counts.values())

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


_counters: dict[str, ChunkCounter] = {}


def counter(tokenizer_file: str) -> ChunkCounter:
    """The worker's counter of a tokenizer, kept between tasks."""
    if tokenizer_file not in _counters:
        _counters[tokenizer_file] = ChunkCounter(tokenizer_file)
    return _counters[tokenizer_file]


def tokenizer_version(tokenizer_file: str) -> str:
    with open(tokenizer_file, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def _encode_misses(tokenizer_file: str):
    import pyarrow as pa

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = counter(tokenizer_file)(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(counts, pa.int64())], names=["digest", "n_tokens"]
            )

    return encode


def token_counts(
    docs: DataFrame, *keep: str, tokenizer_file: str, cache: str, text_col: str = "text", most_tokens: int = 1024
) -> DataFrame:
    """The ``keep`` columns, ``n_bytes``, ``n_tokens``, ``over_limit`` and ``digest`` of every document."""
    spark = docs.sparkSession
    table = f"{cache.rstrip('/')}/version={tokenizer_version(tokenizer_file)}"
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.unhex(F.sha2(text, 256))
    schema = "digest binary, n_tokens long"

    content = docs.select(digest.alias("digest"), text.alias("text"))
    misses = content
    if path_exists(spark, table):
        stored = spark.read.schema(schema).parquet(table)
        misses = content.join(stored, "digest", "left_anti")
    # Copies meet in the map tasks first, so a text that a third of all rows share leaves each task once.
    distinct = misses.groupBy("digest").agg(F.first("text").alias("text"))
    distinct.mapInArrow(_encode_misses(tokenizer_file), schema).write.mode("append").parquet(table)

    counts = spark.read.schema(schema).parquet(table).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    sized = docs.select(*keep, digest.alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"))
    return (
        sized.join(counts, "digest")
        .select(*keep, "n_bytes", "n_tokens", (F.col("n_tokens") > most_tokens).alias("over_limit"), "digest")
    )
