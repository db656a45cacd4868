"""Personal data by a linear-chain conditional random field beside fixed patterns.

The patterns give the base spans. The field labels the words around anything that is no plain word: it is trained from a
small labelled table, its features are the shape of a word and of its neighbours, and it is decoded by Viterbi over
batches of equally padded windows in numpy. Spans that it adds where no base span stands are reported beside the base.

A plain word (letters and closing marks only) never carries personal data of these kinds, so windows are the words that
are not plain with ``AROUND`` words on either side, and their features come from the real neighbours in the text. The field
holds it as a rule that a plain word with plain words beside it is "none". The outermost words of a window are such words,
in the window and in the whole text, and so is every word outside, so decoding windows equals decoding whole texts.

Defined cases: null counts as the empty text; empty texts have no spans and the digest of the empty string; texts of any
length are decoded whole, window by window; spans never overlap a base span, ties in place go by kind in the order
email, ip, card, phone; repeated rows are searched one by one; an empty table gives an empty result. Only the id and
text columns are read; ``masked`` keeps all columns.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from degraus.llm.common import slices

KINDS = ("email", "ip", "card", "phone")

# The base patterns.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[int, int, str]

#: Words that are no plain words. Plain: letters, with marks of prose around them.
_ODD = re.compile(r"[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*|\((?:at|dot)\)|\[(?:at|dot)\]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
AROUND = 2
LABELS = ("none", *(f"{part}-{kind}" for kind in KINDS for part in ("first", "next")))
#: Rows of the labelled table, and passes over it.
TRAINING_ROWS, PASSES = 400, 12


def luhn(digits: str) -> bool:
    """Check digit of a card number: every second digit from the right is doubled."""
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns; matches that fail their check are dropped."""
    found = []
    if "@" in text:
        found += [(m.start(), m.end(), "email") for m in EMAIL.finditer(text)]
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
            found.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
                found.append((m.start(), m.end(), "phone"))
    return in_order(found)


def in_order(spans: Sequence[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def as_text(spans: Sequence[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


# --- The labelled table -----------------------------------------------------------------


def labelled_table(rows: int = TRAINING_ROWS, seed: int = 7) -> list[tuple[list[str], list[str]]]:
    """Words and labels of invented sentences: the kinds in forms the patterns know and in others, and look-alikes that
    are no personal data (versions, amounts, dates, keys, hashes, and numbers as long as a card's that fail its check:
    orders, accounts, times)."""
    rng = random.Random(seed)

    def number(n: int) -> str:
        return "".join(rng.choice("0123456789") for _ in range(n))

    def letters(least: int, most: int) -> str:
        return "".join(rng.choice("abcdeghilmnoprstuvwé") for _ in range(rng.randint(least, most)))

    def card_number() -> str:
        body = rng.choice("3456") + number(rng.choice([13, 14, 14, 14]))
        return next(body + d for d in "0123456789" if luhn(body + d))

    def unchecked(digits: str) -> str:
        """A number of the same length that is no card number."""
        return next(d for last in "0123456789" if not luhn(d := digits[:-1] + last))

    def grouped(digits: str) -> str:
        groups = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        return rng.choice([digits, " ".join(groups), "-".join(groups), ".".join(groups)])

    def email() -> str:
        user = letters(2, 8) + rng.choice([f".{number(2)}", number(rng.randint(1, 4)), ""])
        host = letters(3, 7) + rng.choice([f"{number(1)}.{letters(3, 7)}.com", f"{number(rng.randint(1, 4))}.de", ".org"])
        at, dot = rng.choice([("@", "."), (" (at) ", "."), (" [at] ", " [dot] "), (" (at) ", " (dot) ")])
        return f"{user}{at}{host.replace('.', dot)}" if at != "@" else f"{user}@{host}"

    def ip() -> str:
        return rng.choice([".", ".", ".", " . "]).join(str(rng.randint(0, 255)) for _ in range(4))

    def card() -> str:
        return grouped(card_number())

    def phone() -> str:
        a, b, c = number(3), number(3), number(4)
        return rng.choice([f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+49 {a} {b}{c}", f"tel:{a}-{b}-{c}"])

    def other() -> str:
        return rng.choice([
            f"{rng.randint(1, 9)}.{rng.randint(0, 9)}.", f"{rng.randint(1, 9)}.{rng.randint(0, 9)}.{rng.randint(0, 9)}",
            f"{number(rng.randint(1, 6))}", f"{number(2)}%", f"${number(3)}.{number(2)}", f"{rng.randint(1900, 2030)}",
            f"password={rng.getrandbits(64):016x}", f'"{rng.getrandbits(160):040x}"', f"{rng.randint(1, 28)}/12/2021",
            "AKIA" + letters(4, 6).upper().replace("É", "E") + number(3) + letters(4, 6).upper().replace("É", "E"),
            f"{number(2)}:{number(2)}", f"{letters(3, 6)}{number(1)}", f"#{number(4)}", f"2021-{number(2)}-{number(2)}",
            f"@{letters(3, 8)}", f"{number(1)}{letters(1, 2)}", f"{number(3)},{number(3)}", number(rng.randint(7, 13)),
            *(grouped(unchecked(number(rng.randint(14, 19)))) for _ in range(4)), f"#{unchecked(number(16))}",
            unchecked(f"20{number(2)}{rng.randint(10, 12)}{rng.randint(10, 28)}{number(6)}"), f"ID-{number(12)}",
        ])

    makers = {"email": email, "ip": ip, "card": card, "phone": phone}
    table = []
    for _ in range(rows):
        words, labels = [], []
        for _ in range(rng.randint(2, 4)):
            for _ in range(rng.randint(2, 6)):
                words.append(letters(1, 9) + rng.choice(["", "", "", ",", "."]))
                labels.append("none")
            kind = rng.choice([*KINDS, "other"])
            if kind == "other":
                parts = other().split(" ")
                words += parts
                labels += ["none"] * len(parts)
            elif kind == "card" and rng.random() < 0.2:  # one number after the other
                words += [card_number(), card_number()]
                labels += ["first-card"] * 2
            else:
                parts = makers[kind]().split(" ")
                parts[-1] += rng.choice(["", "", "", ".", ","])
                words += parts
                labels += [f"first-{kind}"] + [f"next-{kind}"] * (len(parts) - 1)
        table.append((words, labels))
    return table


# --- Features ---------------------------------------------------------------------------


@lru_cache(maxsize=200_000)
def shape(word: str) -> tuple[str, ...]:
    """Features of a word: its shape with run lengths, without them, and a few facts."""
    core = word.rstrip(".,;:!?\"')")
    plain = "".join("9" if c in "0123456789" else "a" if c.isalpha() else c for c in core)
    runs = re.findall(r"9+|a+|.", plain)
    digits = plain.count("9")
    if not digits and "@" not in plain and not re.search(r"[\[(](at|dot)[\])]", word):
        return ("plain",)
    exact = "".join(f"9{len(r)}" if r[0] == "9" else "a" if r[0] == "a" else r for r in runs)[:24]
    loose = "".join(r[0] for r in runs)[:16]
    small = "small" if all(len(r) <= 3 and int(r) <= 255 for r in re.findall(r"[0-9]+", core)) else "large"
    return (
        "odd", f"exact {exact}", f"loose {loose}", f"digits {min(digits, 20)}", f"begins {plain[:1]}", small,
        f"word {core.lower()}" if not digits else f"dots {plain.count('.')} dashes {plain.count('-')}",
        "check" if 14 <= digits <= 19 and luhn(re.sub("[^0-9]", "", core)) else "no check",
    )


def joined(words: Sequence[str]) -> list[str]:
    """For every word of a run of groups of digits: whether the number that they make together passes its check."""
    found, run = [""] * len(words), []
    for i, word in enumerate([*words, ""]):
        digits = word.rstrip(".,;:!?")
        if digits and all(c in "0123456789" for c in digits):
            run.append((i, digits))
            if digits == word:
                continue
        if len(run) > 1:
            number = "".join(d for _, d in run)
            kind = "short" if len(number) < 14 else "long" if len(number) > 19 else "check" if luhn(number) else "no check"
            for k, _ in run:
                found[k] = f"joined {kind}"
        run = []
    return found


def features(words: Sequence[str], before: str | None = None, after: str | None = None) -> list[list[str]]:
    """Features of words in a row; ``before`` and ``after`` stand next to them in the text."""
    edge = ("edge",)
    own = [edge if before is None else shape(before), *(shape(w) for w in words), edge if after is None else shape(after)]
    found = []
    for i, together in enumerate(joined(words), 1):
        around = [*(f"before {f}" for f in own[i - 1][:4]), *(f"after {f}" for f in own[i + 1][:4])]
        found.append([*own[i], *around, *([together] if together else [])])
    return found


def settled(words: Sequence[str], before: str | None = None, after: str | None = None) -> list[bool]:
    """Whether a word is plain and has no other than plain words beside it, so that the rule makes it "none"."""
    plain = [w is None or shape(w) == ("plain",) for w in (before, *words, after)]
    return [all(plain[i - 1 : i + 2]) for i in range(1, len(words) + 1)]


def ruled(scores: np.ndarray, fixed: Sequence[bool]) -> np.ndarray:
    """Scores with every label but "none" ruled out where the rule holds."""
    scores[np.array(fixed, bool), 1:] = -1e9
    return scores


# --- The field --------------------------------------------------------------------------


class Field:
    """Weights of a linear-chain conditional random field over hashed-out feature names."""

    def __init__(self, index: dict[str, int], emission: np.ndarray, transition: np.ndarray):
        self.index, self.emission, self.transition = index, emission, transition

    def scores(self, words: Sequence[str], before: str | None = None, after: str | None = None) -> np.ndarray:
        rows = [[self.index[f] for f in fs if f in self.index] for fs in features(words, before, after)]
        return ruled(np.array([self.emission[r].sum(axis=0) for r in rows]), settled(words, before, after))

    def decode(
        self, windows: Sequence[Sequence[str]], flanks: Sequence[tuple[str | None, str | None]] | None = None
    ) -> list[np.ndarray]:
        """Best labels of every window, by Viterbi over batches of windows padded to one length. ``flanks`` has the words
        before and after each in its text."""
        best: list[np.ndarray] = [np.zeros(0, np.int64)] * len(windows)
        order = sorted(range(len(windows)), key=lambda i: len(windows[i]))
        for at in range(0, len(order), 256):
            batch = order[at : at + 256]
            longest = len(windows[batch[-1]])
            scores = np.zeros((len(batch), longest, len(LABELS)))
            for row, i in enumerate(batch):
                scores[row, : len(windows[i])] = self.scores(windows[i], *(flanks[i] if flanks else ()))
            lengths = np.array([len(windows[i]) for i in batch])
            value, back = scores[:, 0], np.zeros((longest, len(batch), len(LABELS)), np.int64)
            for t in range(1, longest):
                each = value[:, :, None] + self.transition
                back[t] = each.argmax(axis=1)
                moved = each.max(axis=1) + scores[:, t]
                inside = (t < lengths)[:, None]
                value = np.where(inside, moved, value)
                back[t] = np.where(inside, back[t], np.arange(len(LABELS)))
            label = value.argmax(axis=1)
            path = np.zeros((longest, len(batch)), np.int64)
            for t in range(longest - 1, -1, -1):
                path[t] = label
                label = back[t][np.arange(len(batch)), label]
            for row, i in enumerate(batch):
                best[i] = path[: len(windows[i]), row]
        return best


def train(table: Sequence[tuple[list[str], list[str]]], passes: int = PASSES, rate: float = 0.5, shrink: float = 1e-4) -> Field:
    """Fit the field by stochastic gradient on the log likelihood, with forward and backward sums in log space."""
    names = sorted({f for words, _ in table for fs in features(words) for f in fs})
    index = {name: i for i, name in enumerate(names)}
    emission, transition = np.zeros((len(names), len(LABELS))), np.zeros((len(LABELS), len(LABELS)))
    squares = np.full_like(emission, 1e-8), np.full_like(transition, 1e-8)
    coded = [
        (
            [np.array([index[f] for f in fs]) for fs in features(words)], settled(words),
            np.array([LABELS.index(x) for x in labels]),
        )
        for words, labels in table
    ]
    order = random.Random(1)
    for _ in range(passes):
        for rows, fixed, gold in order.sample(coded, len(coded)):
            scores = ruled(np.array([emission[r].sum(axis=0) for r in rows]), fixed)
            n = len(rows)
            ahead, behind = np.zeros_like(scores), np.zeros_like(scores)
            ahead[0] = scores[0]
            for t in range(1, n):
                ahead[t] = scores[t] + np.logaddexp.reduce(ahead[t - 1][:, None] + transition, axis=0)
            for t in range(n - 2, -1, -1):
                behind[t] = np.logaddexp.reduce(transition + scores[t + 1] + behind[t + 1], axis=1)
            total = np.logaddexp.reduce(ahead[-1])
            wrong = -np.exp(ahead + behind - total)
            wrong[np.arange(n), gold] += 1
            step = np.zeros_like(transition)
            for t in range(1, n):
                step -= np.exp(ahead[t - 1][:, None] + transition + scores[t] + behind[t] - total)
            np.add.at(step, (gold[:-1], gold[1:]), 1)
            for r, g in zip(rows, wrong, strict=True):
                squares[0][r] += g * g
                emission[r] += rate * (g / np.sqrt(squares[0][r]) - shrink * emission[r])
            squares[1][...] += step * step
            transition += rate * (step / np.sqrt(squares[1]) - shrink * transition)
    return Field(index, emission, transition)


@lru_cache(maxsize=1)
def default_field() -> Field:
    return train(labelled_table())


# --- Search -----------------------------------------------------------------------------


def _windows(text: str) -> Iterator[tuple[list[re.Match], str | None, str | None]]:
    """Runs of words around those that are not plain, whole words with their places, and the words beside each run."""
    last = -1
    run: list[int] = []
    odd = [m.start() for m in _ODD.finditer(text)]
    if not odd:
        return
    words = list(_WORD.finditer(text))
    starts = [m.start() for m in words]
    marks = np.searchsorted(starts, odd, side="right") - 1

    def closed():
        low, high = run[0], run[-1]
        return (
            words[low : high + 1], words[low - 1][0] if low else None,
            words[high + 1][0] if high + 1 < len(words) else None,
        )

    for mark in marks.tolist():
        low, high = max(mark - AROUND, last + 1), min(mark + AROUND, len(words) - 1)
        if run and mark - AROUND > last + 1:
            yield closed()
            run = []
        run += range(low, high + 1)
        last = max(last, high)
    if run:
        yield closed()


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """A span without the marks of prose at its ends."""
    while end > start and text[end - 1] in ".,;:!?\"'":
        end -= 1
    while end > start and text[start] in "\"'":
        start += 1
    return start, end


def found_spans(texts: Sequence[str], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text."""
    base = [base_spans(text) for text in texts]
    owners, windows, flanks = [], [], []
    for i, text in enumerate(texts):
        for run, before, after in _windows(text):
            owners.append((i, run))
            windows.append([m[0] for m in run])
            flanks.append((before, after))
    more: list[list[Span]] = [[] for _ in texts]
    for (i, run), path in zip(owners, field.decode(windows, flanks), strict=True):
        open_: list[int] | None = None
        kind = ""
        for m, label in [*zip(run, path, strict=True), (None, 0)]:
            name = LABELS[label]
            if open_ and name == f"next-{kind}" and m is not None:
                open_[1] = m.end()
                continue
            if open_:
                start, end = _trimmed(texts[i], *open_)
                if start < end:
                    more[i].append((start, end, kind))
                open_ = None
            if name != "none" and m is not None:
                kind, open_ = name.split("-")[1], [m.start(), m.end()]
    results = []
    for own, added in zip(base, more, strict=True):
        free = [a for a in added if all(a[1] <= b[0] or b[1] <= a[0] for b in own)]
        results.append((own, in_order([*own, *free])))
    return results


def _searched(field: Field):
    import pyarrow as pa

    def search(batches):
        for batch in batches:
            row = 0
            for run in slices(batch.column(1).to_pylist()):
                found = found_spans(run, field)
                counts = [[sum(s[2] == kind for s in base) for base, _ in found] for kind in KINDS]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, len(run)),
                        *(pa.array(c, pa.int64()) for c in counts),
                        pa.array([hashlib.sha256(as_text(base).encode()).hexdigest() for base, _ in found]),
                        pa.array([as_text(spans) for _, spans in found]),
                        pa.array([len(spans) - len(base) for base, spans in found], pa.int64()),
                    ],
                    names=["id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"],
                )
                row += len(run)

    return search


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", field: Field | None = None) -> DataFrame:
    """Per document: id, base spans by kind, ``base_sha256``, ``spans`` (all of them) and ``n_added`` by the field."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counts = ", ".join(f"n_{kind} long" for kind in KINDS)
    return rows.mapInArrow(
        _searched(field or default_field()),
        f"id {rows.schema['id'].dataType.simpleString()}, {counts}, base_sha256 string, spans string, n_added long",
    ).withColumnRenamed("id", id_col)


def mask(text: str, spans: Sequence[Span]) -> str:
    """The text with ``<KIND>`` in place of each span; overlapping spans are masked as one, by the first one's kind."""
    parts, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            parts += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def masked(docs: DataFrame, text_col: str = "text", field: Field | None = None) -> DataFrame:
    """``docs`` with every span of the text masked; null stays null, all other columns stay."""
    import pyarrow as pa

    model = field or default_field()
    at = docs.columns.index(text_col)

    def replace(batches):
        for batch in batches:
            row = 0
            for run in slices((t or "" for t in batch.column(at).to_pylist())):
                part = batch.slice(row, len(run))
                new = [mask(t, spans) for t, (_, spans) in zip(run, found_spans(run, model), strict=True)]
                texts = pa.array([None if v is None else n for v, n in zip(part.column(at).to_pylist(), new, strict=True)],
                                 pa.string())
                yield pa.RecordBatch.from_arrays(
                    [texts if i == at else c for i, c in enumerate(part.columns)], names=batch.schema.names
                )
                row += len(run)

    return docs.mapInArrow(replace, docs.schema)
