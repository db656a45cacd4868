"""SentencePiece models on the tokenizers library: encoding and decoding, with parity held against sentencepiece.

The model protobuf is read field by field; from its pieces, scores and settings the normaliser, the metaspace marker, the
model (unigram scores, or merges ordered by score for a BPE model), byte fallback and the decoder are rebuilt. Batches of
distinct chunks are encoded by the library's threads, and its ids are the result. Every distinct chunk is also encoded by
sentencepiece as a check; only where the two differ, the ids of sentencepiece count instead and the chunk is reported.

If no piece holds the marker behind another character, pieces never reach across a blank between two visible characters;
texts are then cut there (not beside a literal marker), each chunk is encoded and decoded once per worker, and a text
comes back if all its chunks do, for decoding puts the blanks back where it was cut. Otherwise texts are encoded whole.

Defined cases: null counts as the empty text; the empty text has no ids and decodes to itself; characters outside the
vocabulary become bytes, or the unknown id where the model has no bytes; repeated rows are encoded one by one; texts of
any length are encoded whole; an empty table gives an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from degraus.llm.common import slices
from degraus.llm.token_counts import chunk_bounds

# Field numbers and piece types of the model format.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE = 1, 2, 3, 4, 6
UNIGRAM, BPE = 1, 2
MARK = "▁"

#: Chunks remembered in the younger half of a worker's memory, the longest one it remembers (both only bound memory),
#: and new chunks encoded as one text.
REMEMBERED, LONGEST, JOINED = 500_000, 64, 256


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and raw values of a protobuf message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size, at = (8, at) if kind == 1 else (4, at) if kind == 5 else _varint(data, at)
            value = data[at : at + size]
            at += size
        yield key >> 3, value


@dataclass(frozen=True)
class PieceModel:
    """What a model file says. Defaults of the format hold for fields that are not written."""

    pieces: list[tuple[str, float, int]]
    kind: int
    byte_fallback: bool
    charsmap: bytes
    dummy_prefix: bool
    remove_extra_blanks: bool
    escape_blanks: bool

    @classmethod
    def load(cls, path: str) -> PieceModel:
        with open(path, "rb") as f:
            message = list(fields(f.read()))
        pieces = []
        for value in (v for n, v in message if n == PIECES):
            piece = dict(fields(value))
            score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
            pieces.append((piece[1].decode(), score, piece.get(3, NORMAL)))
        trainer = dict(next((fields(v) for n, v in message if n == TRAINER), ()))
        norm = dict(next((fields(v) for n, v in message if n == NORMALIZER), ()))
        return cls(
            pieces, trainer.get(3, UNIGRAM), bool(trainer.get(35, 0)), norm.get(2, b""), bool(norm.get(3, 1)),
            bool(norm.get(4, 1)), bool(norm.get(5, 1)),
        )

    @property
    def unknown(self) -> int:
        return next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)

    @property
    def can_be_cut(self) -> bool:
        """Whether no piece holds the marker behind another character, and blanks stay as they are."""
        return self.dummy_prefix and not self.remove_extra_blanks and not self.charsmap and all(
            MARK not in text.lstrip(MARK) for text, _, kind in self.pieces if kind in (NORMAL, USER_DEFINED)
        )


def rebuilt(model: PieceModel):
    """The model as a tokenizer of the tokenizers library."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    ids = {text: i for i, (text, _, _) in enumerate(model.pieces)}
    if model.kind == UNIGRAM:
        core = models.Unigram([(t, s) for t, s, _ in model.pieces], model.unknown, byte_fallback=model.byte_fallback)
    elif model.kind == BPE:
        joined = {t: s for t, s, kind in model.pieces if kind in (NORMAL, USER_DEFINED)}
        merges = [
            (-score, ids[text[:i]], ids[text[i:]], text[:i], text[i:])
            for text, score in joined.items()
            for i in range(1, len(text))
            if text[:i] in joined and text[i:] in joined
        ]
        core = models.BPE(
            ids, [(a, b) for *_, a, b in sorted(merges)], unk_token=model.pieces[model.unknown][0], fuse_unk=True,
            byte_fallback=model.byte_fallback, cache_capacity=0,
        )
    else:
        raise ValueError(f"model type {model.kind} is not unigram or BPE")
    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.remove_extra_blanks:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARK if model.escape_blanks else " "))
    if model.escape_blanks:
        steps.append(normalizers.Replace(" ", MARK))
    tokenizer = Tokenizer(core)
    if steps:
        tokenizer.normalizer = normalizers.Sequence(steps)
    parts = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model.dummy_prefix:
        parts.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(parts)
    return tokenizer


@dataclass(frozen=True)
class Encoded:
    """Ids of some texts, one after the other; ``bounds`` has where those of each text begin and end. Per text: how many
    of its chunks the libraries encode differently, and whether its ids decode to it again."""

    ids: np.ndarray
    bounds: np.ndarray
    differing: np.ndarray
    restored: np.ndarray


class PieceCodec:
    """Encodes and decodes whole texts; keeps the ids of chunks it has seen and counts chunks without parity.

    Texts are cut on their bytes, and Arrow gives the distinct chunks of a run. New ones are encoded, held against
    sentencepiece and decoded once. Remembered chunks stand in two halves: when the younger is full it becomes the older
    one, whose chunks move over when they are met again, so common chunks stay and rare ones go.
    """

    def __init__(self, path: str):
        import sentencepiece

        # One worker encodes its distinct chunks in the library's threads.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        self.model = PieceModel.load(path)
        self._tokenizer = rebuilt(self.model)
        self._reference = sentencepiece.SentencePieceProcessor(model_file=path)
        self._young: dict[bytes, bytes] = {}
        self._old: dict[bytes, bytes] = {}
        # Chunks the libraries encode differently, and chunks whose ids do not decode to them; most texts have none.
        self._differing: set[bytes] = set()
        self._unlike: set[bytes] = set()
        # Pieces that sentencepiece does not decode to their own text.
        self._spoken = {
            i: " ⁇ " if kind == UNKNOWN else ""
            for i, (_, _, kind) in enumerate(self.model.pieces) if kind in (UNKNOWN, CONTROL)
        }
        self._begins = np.array([text.startswith(MARK) for text, _, _ in self.model.pieces])

    def encode(self, texts: Sequence[str]) -> list[tuple[list[int], int]]:
        """Ids of every text, and how many of its chunks the two libraries encode differently."""
        found = []
        for run in slices(texts):
            coded = self.encode_run(run)
            found += [
                (coded.ids[low:high].tolist(), int(n))
                for low, high, n in zip(coded.bounds[:-1], coded.bounds[1:], coded.differing, strict=True)
            ]
        return found

    def encode_run(self, texts: Sequence[str]) -> Encoded:
        """Encode texts that fit in memory together."""
        import pyarrow as pa

        if len(self._young) > REMEMBERED:
            self._old, self._young = self._young, {}
            held = self._old.keys()
            self._differing &= held
            self._unlike &= held
        # A line break after each text keeps the texts apart; it belongs to none of them.
        coded = [text.encode() for text in texts]
        sizes = np.array([len(x) for x in coded], np.int64)
        joined = b"\n".join([*coded, b""])
        ends = np.cumsum(sizes + 1) - 1
        cuts = chunk_bounds(np.frombuffer(joined, np.uint8)) if self.model.can_be_cut else np.zeros(0, np.int64)
        starts = np.sort(np.concatenate([ends - sizes, cuts + 1]), kind="stable")
        stops = np.sort(np.concatenate([ends, cuts]), kind="stable")
        # Chunks with the blank or line break after each, as one array whose every second value is a chunk.
        edges = np.empty(2 * len(starts) + 1, np.int64)
        edges[:-1:2], edges[1::2], edges[-1] = starts, stops, len(joined)
        chunks = pa.Array.from_buffers(
            pa.large_binary(), 2 * len(starts), [None, pa.py_buffer(edges), pa.py_buffer(joined)]
        ).take(pa.array(np.arange(0, 2 * len(starts), 2))).dictionary_encode()
        distinct, places = chunks.dictionary.to_pylist(), chunks.indices.to_numpy()
        values = self._values(distinct)
        lengths = np.fromiter(map(len, values), np.int64, len(values)) // 4
        flat = np.frombuffer(b"".join(values), "<i4")
        # Ids of every chunk in order: each takes its stretch of the distinct chunks' ids.
        counts = lengths[places]
        after = np.cumsum(counts)
        begin = (np.cumsum(lengths) - lengths)[places] - (after - counts)
        ids = flat[np.repeat(begin, counts) + np.arange(int(after[-1]) if len(after) else 0)]
        first = np.searchsorted(starts, ends - sizes)  # every text has a chunk, be it empty
        bounds = np.append(np.append(0, after)[first], len(ids))

        def per_text(marked: set[bytes]) -> np.ndarray:
            if not marked:
                return np.zeros(len(texts), np.int64)
            hit = np.fromiter((c in marked for c in distinct), np.int64, len(distinct))[places]
            return np.diff(np.append(0, np.cumsum(hit))[np.append(first, len(places))])

        result = Encoded(ids, bounds, per_text(self._differing), per_text(self._unlike) == 0)
        for chunk in distinct:
            if len(chunk) > LONGEST:
                self._young.pop(chunk, None)
                self._differing.discard(chunk)
                self._unlike.discard(chunk)
        return result

    def _values(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of distinct chunks as bytes, remembered or new."""
        young, old = self._young, self._old
        new = []
        for chunk in chunks:
            if chunk not in young:
                if chunk in old:
                    young[chunk] = old[chunk]
                else:
                    new.append(chunk)
        words = [chunk.decode() for chunk in new]
        plain = [w for w in words if MARK not in w and w.split() == [w]] if self.model.can_be_cut else []
        plain = plain[: len(plain) // JOINED * JOINED]
        rest = set(words).difference(plain)
        for at in range(0, len(plain), JOINED):
            if not self._learn_together(plain[at : at + JOINED]):
                rest.update(plain[at : at + JOINED])
        self._learn(list(rest))
        return [young[chunk] for chunk in chunks]

    def _learn_together(self, words: list[str]) -> bool:
        """Encode words as one text: each begins at the next piece with a marker. False if they must be taken one by
        one, because the libraries differ, or the pieces or the decoded text do not fall apart into these words."""
        text = " ".join(words)
        own = self._tokenizer.encode(text, add_special_tokens=False).ids
        ids = np.array(own, np.int32)
        begins = np.append(np.flatnonzero(self._begins[ids]), len(ids))
        if len(begins) != len(words) + 1 or begins[0] != 0:
            return False
        if own != self._reference.encode([text], num_threads=1)[0] or self.decode(own).split(" ") != words:
            return False
        data = ids.astype("<i4").tobytes()
        self._young.update(
            (word.encode(), data[4 * low : 4 * high]) for word, low, high in zip(words, begins[:-1], begins[1:])
        )
        return True

    def _learn(self, texts: list[str]) -> None:
        """Encode texts one by one and note those that differ, or that do not come back."""
        ours = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        theirs = self._reference.encode(texts, num_threads=1)
        for text, own, other in zip(texts, ours, theirs, strict=True):
            # The library keeps the marker of an empty text; it has no ids here.
            ids, coded = own.ids if text else [], text.encode()
            if ids != other:
                self._differing.add(coded)
                ids = [int(i) for i in other]
            if self.decode(ids) != text:
                self._unlike.add(coded)
            self._young[coded] = np.array(ids, "<i4").tobytes()

    def decode(self, ids: Sequence[int]) -> str:
        """The text of a sequence of ids; ids that form no valid text decode with replacement characters."""
        if self._spoken.keys().isdisjoint(ids):
            text = self._tokenizer.decode(ids, skip_special_tokens=False)
        else:
            text = self._tokenizer.decoder.decode(self._said(ids))
        # The library replaces all of a run of bytes if one is bad, sentencepiece only the bad ones.
        return self._reference.decode(list(ids)) if "\ufffd" in text else text

    def _said(self, ids: Sequence[int]) -> list[str]:
        said = [piece for i in ids if (piece := self._spoken.get(i, self.model.pieces[i][0]))]
        if self.model.dummy_prefix and said and said[0].startswith(" "):
            said[0] = " " + said[0]  # only a marker is stripped at the start
        return said


_codecs: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    """The worker's codec of a model, kept between tasks."""
    if path not in _codecs:
        _codecs[path] = PieceCodec(path)
    return _codecs[path]


def encoded(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, ``ids``, and ``n_differing`` chunks that the two libraries encode differently."""
    import pyarrow as pa

    def encode(batches):
        for batch in batches:
            row = 0
            for run in slices(batch.column(1).to_pylist()):
                found = codec(model_file).encode_run(run)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, len(run)),
                    pa.ListArray.from_arrays(pa.array(found.bounds.astype(np.int32)), pa.array(found.ids.astype(np.int32))),
                    pa.array(found.differing, pa.int64()),
                ], names=["id", "ids", "n_differing"])
                row += len(run)

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(encode, f"id {kind}, ids array<int>, n_differing long").withColumnRenamed("id", id_col)


def decoded(coded: DataFrame, model_file: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: id and ``text``; null ids decode to null."""
    import pyarrow as pa

    def decode(batches):
        for batch in batches:
            texts = [None if ids is None else codec(model_file).decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    rows = coded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(decode, f"id {kind}, text string").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, ``n_bytes``, ``n_ids``, ``ids_crc32`` (of the ids as 32-bit little-endian integers),
    ``n_differing``, and ``restored``: whether decoding the ids gives the text again."""
    import pyarrow as pa

    def check(batches):
        for batch in batches:
            row = 0
            for run in slices(batch.column(1).to_pylist()):
                found = codec(model_file).encode_run(run)
                data, bounds = memoryview(found.ids.astype("<i4").tobytes()), 4 * found.bounds
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, len(run)),
                    pa.array([len(t.encode()) for t in run], pa.int64()),
                    pa.array(np.diff(found.bounds), pa.int64()),
                    pa.array(
                        [zlib.crc32(data[low:high]) for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist())],
                        pa.int64(),
                    ),
                    pa.array(found.differing, pa.int64()),
                    pa.array(found.restored),
                ], names=["id", "n_bytes", "n_ids", "ids_crc32", "n_differing", "restored"])
                row += len(run)

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        check, f"id {kind}, n_bytes long, n_ids long, ids_crc32 long, n_differing long, restored boolean"
    ).withColumnRenamed("id", id_col)
