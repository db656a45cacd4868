"""Language of a text by a byte-level convolutional network, trained and applied in numpy.

Bytes are embedded, filters of several widths slide over them, each filter keeps its largest response in the window
(max pooling), and a softmax layer gives the languages. A text is cut into windows of fixed length that together cover
all of it; its language is the one of the largest mean probability over its windows.

Training reads a bounded sample: at most ``PER_LANGUAGE`` labelled documents of each language, chosen by the hash of
their id, one window of each at a place the same hash chooses. The rows to learn from are named by the caller.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; texts shorter than a window are padded;
ties go to the first language in alphabetical order; repeated rows are predicted one by one; rows without a label are
not learned from; with no labelled row at all every text is ``und``; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from degraus.llm.common import slices

WINDOW, WIDTHS, FILTERS, EMBEDDING = 256, (2, 3, 4), 12, 8
PER_LANGUAGE, SALTS = 600, 16
PASSES, BATCH, RATE = 14, 64, 0.01
NONE = "und"
#: Windows that go through the network at once.
STRIP = 32


@dataclass
class ByteNetwork:
    """``embedding`` (257, E); per width a kernel (width * E, F) and bias; ``out`` (widths * F, languages) and bias.

    Code 256 is padding."""

    languages: list[str]
    embedding: np.ndarray
    kernels: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def fresh(cls, languages: Sequence[str], seed: int = 11) -> ByteNetwork:
        rng = np.random.default_rng(seed)
        scaled = lambda *shape: (rng.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)
        zeros = lambda n: np.zeros(n, np.float32)
        return cls(
            list(languages), rng.normal(size=(257, EMBEDDING)).astype(np.float32) * np.float32(0.5),
            [scaled(w * EMBEDDING, FILTERS) for w in WIDTHS], [zeros(FILTERS) for _ in WIDTHS],
            scaled(len(WIDTHS) * FILTERS, len(languages)), zeros(len(languages)),
        )

    @property
    def weights(self) -> list[np.ndarray]:
        return [self.embedding, *self.kernels, *self.biases, self.out, self.out_bias]

    def tables(self) -> list[list[tuple[int, bool, np.ndarray]]]:
        """Per width the responses that parts of a filter add: (place, whether of a pair of bytes, responses by code)."""
        found = []
        for kernel, width in zip(self.kernels, WIDTHS, strict=True):
            single = [self.embedding @ part for part in np.split(kernel, width)]
            parts = [
                (k, True, (single[k][:, None] + single[k + 1][None]).reshape(-1, FILTERS)) for k in range(0, width - 1, 2)
            ]
            found.append(parts + ([(width - 1, False, single[-1])] if width % 2 else []))
        return found

    def probabilities(self, codes: np.ndarray, tables: list[list[tuple[int, bool, np.ndarray]]]) -> np.ndarray:
        """Of windows (n, WINDOW) of byte codes."""
        pairs = codes[:, :-1] * 257 + codes[:, 1:]
        pooled = []
        for parts, bias, width in zip(tables, self.biases, WIDTHS, strict=True):
            n = codes.shape[1] - width + 1
            total = None
            for place, paired, table in parts:
                part = table.take((pairs if paired else codes)[:, place : place + n], axis=0, mode="clip")
                total = part if total is None else np.add(total, part, out=total)
            pooled.append(np.maximum(total.max(axis=1) + bias, 0))
        return _softmax(np.concatenate(pooled, axis=1) @ self.out + self.out_bias)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def window_codes(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all windows of all texts, and the text of each window. The last window of a text is padded."""
    counts = np.array([max(1, -(-len(t) // WINDOW)) for t in texts], np.int64)
    codes = np.full((int(counts.sum()), WINDOW), 256, np.int16)
    flat, at = codes.reshape(-1), 0
    for text, n in zip(texts, counts, strict=True):
        flat[at : at + len(text)] = np.frombuffer(text, np.uint8)
        at += int(n) * WINDOW
    return codes, np.repeat(np.arange(len(texts)), counts)


def trained(codes: np.ndarray, labels: np.ndarray, languages: Sequence[str]) -> ByteNetwork:
    """Fit by Adam on cross entropy; the gradient of max pooling goes to the place that held the maximum."""
    net = ByteNetwork.fresh(languages)
    rng = np.random.default_rng(5)
    first, second = [np.zeros_like(w) for w in net.weights], [np.zeros_like(w) for w in net.weights]
    share = np.bincount(labels, minlength=len(languages)).astype(np.float32)
    weight = (len(labels) / (len(languages) * np.maximum(share, 1)))[labels]
    step = 0
    for _ in range(PASSES):
        order = rng.permutation(len(codes))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            x, n = codes[rows].astype(np.int64), len(rows)
            embedded = net.embedding[x]
            pooled, places, inputs = [], [], []
            for kernel, bias, width in zip(net.kernels, net.biases, WIDTHS, strict=True):
                seen = np.concatenate([embedded[:, k : WINDOW - width + 1 + k] for k in range(width)], axis=2)
                response = seen @ kernel
                place = response.argmax(axis=1)
                pooled.append(np.take_along_axis(response, place[:, None], 1)[:, 0] + bias)
                places.append(place)
                inputs.append(seen)
            hidden = np.concatenate(pooled, axis=1)
            active = np.maximum(hidden, 0)
            error = _softmax(active @ net.out + net.out_bias)
            error[np.arange(n), labels[rows]] -= 1
            error *= (weight[rows] / n)[:, None]
            back = (error @ net.out.T) * (hidden > 0)
            g_embedding = np.zeros_like(net.embedding)
            g_kernels, g_biases = [], []
            for j, (kernel, width) in enumerate(zip(net.kernels, WIDTHS, strict=True)):
                g = back[:, j * FILTERS : (j + 1) * FILTERS]
                at_max = np.take_along_axis(inputs[j], places[j][:, :, None], 1)  # (n, F, width * E)
                g_kernels.append(np.einsum("nf,nfe->ef", g, at_max))
                g_biases.append(g.sum(axis=0))
                to_input = (g[:, :, None] * kernel.T[None]).reshape(n, FILTERS, width, EMBEDDING)
                bytes_at = x[np.arange(n)[:, None, None], places[j][:, :, None] + np.arange(width)]
                np.add.at(g_embedding, bytes_at, to_input)
            gradients = [g_embedding, *g_kernels, *g_biases, active.T @ error, error.sum(axis=0)]
            step += 1
            for w, g, m, v in zip(net.weights, gradients, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def train_on(docs: DataFrame, learn: Column, id_col: str, text_col: str, lang_col: str) -> ByteNetwork | None:
    """The network of the rows that ``learn`` names; null if none has a label.

    The sample is drawn per language in two steps, so a language that most rows have does not meet in one task."""
    deal = F.xxhash64(id_col, text_col)
    start = F.pmod(deal, F.greatest(F.length(text_col) - WINDOW, F.lit(0)) + 1).cast("int") + 1
    rows = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(lang_col).alias("lang"), deal.alias("deal"), F.substring(F.col(text_col), start, F.lit(WINDOW)).alias("window"),
        F.pmod(F.xxhash64("lang", deal), F.lit(SALTS)).alias("salt"),
    )
    for keys in (["lang", "salt"], ["lang"]):
        order = Window.partitionBy(*keys).orderBy("deal", "window")
        rows = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= PER_LANGUAGE).drop("place")
    sample = rows.select("lang", "deal", "window").toPandas().sort_values(["lang", "deal"])
    if not len(sample):
        return None
    languages = sorted(sample["lang"].unique())
    texts = [t.encode()[:WINDOW] for t in sample["window"]]
    codes, _ = window_codes(texts)
    return trained(codes, np.array([languages.index(x) for x in sample["lang"]]), languages)


def predicted(texts: Sequence[str], net: ByteNetwork, tables: list) -> tuple[np.ndarray, np.ndarray]:
    """Index of the best language of each text, and its mean probability."""
    best, score = np.zeros(len(texts), np.int64), np.zeros(len(texts))
    row = 0
    for run in slices(texts, 500_000):
        codes, owner = window_codes([t.encode() for t in run])
        total = np.zeros((len(run), len(net.languages)))
        for at in range(0, len(codes), STRIP):  # keeps the responses in the cache of a core
            part = net.probabilities(codes[at : at + STRIP].astype(np.intp), tables)
            np.add.at(total, owner[at : at + STRIP], part)
        mean = total / np.bincount(owner, minlength=len(run))[:, None]
        best[row : row + len(run)], score[row : row + len(run)] = mean.argmax(axis=1), mean.max(axis=1)
        row += len(run)
    return best, np.clip(score, 0, 1)


def with_language(
    docs: DataFrame, net: ByteNetwork | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: id, ``lang_pred`` and ``score``."""
    import pyarrow as pa

    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("lettered"),
    )
    if net is None:
        return rows.select(F.col("id").alias(id_col), F.lit(NONE).alias("lang_pred"), F.lit(0.0).alias("score"))

    def predict(batches):
        tables = net.tables()
        for batch in batches:
            best, score = predicted(batch.column(1).to_pylist(), net, tables)
            lettered = batch.column(2).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([
                batch.column(0),
                pa.array([net.languages[i] if ok else NONE for i, ok in zip(best, lettered, strict=True)]),
                pa.array(np.where(lettered, score, 0.0)),
            ], names=["id", "lang_pred", "score"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(predict, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """Train on the documents whose remainder of crc32(id) by 4 is not 2, and predict all: id, ``held_out``,
    ``lang_pred``, ``score``."""
    held_out = F.coalesce(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % 4 == 2, F.lit(False))
    net = train_on(docs, ~held_out, id_col, text_col, lang_col)
    return with_language(docs, net, id_col, text_col).select(id_col, held_out.alias("held_out"), "lang_pred", "score")
