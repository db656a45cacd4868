"""Operators on one text at a time, held against plain versions."""

import hashlib
import random
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer, decoders

from degraus.llm import language, personal_data, quality_rules, sentence_pieces, token_counts

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, n_words string, size string, digest string, n_tokens int, kept int"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def prose(rng, n):
    parts = []
    for i in range(n):
        parts.append(rng.choice(["the", "house", "of", "é", "ßtraße", "runs", "日本", "42", "x"]) + str(rng.randint(0, 40)))
        parts.append(rng.choice([" ", " ", " ", "\n", ". ", "\t", "  "]))
    return "".join(parts) + "."


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    some = [None, "", " \n\t ", ".", "a", "a a a a a a", "one\n\none\n two \none", "Home | About | News | Help",
            "<|endoftext|> and <s>", "x" * 5_000, prose(rng, 30_000)]
    some += [prose(rng, rng.randint(1, 400)) for _ in range(40)]
    return [*some, *some[:12]]  # repeated rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    """Nulls in every column, repeated ids, and extra columns whose names the operators use themselves."""
    rows = [(None if i == 7 else i % 60, t, None, "w", None, "d", None, i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def plain_quality(text):
    w = words(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    seen = {}
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
    covered = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    n = len(w)
    return {
        "n_words": n, "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
        "base_failed": n < 50 or 100 * len(covered) > 50 * n,
    }


def test_quality_counts(docs, texts, nothing):
    got = {(r["doc_id"], r["kept_row"]): r for r in quality_rules.quality_rules(
        docs.withColumnRenamed("kept", "kept_row"), "doc_id", "kept_row").collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        row = got[(None if i == 7 else i % 60, i)]
        want = plain_quality(text)
        assert {k: row[k] for k in want} == want, text[:80]
        assert not (row["kept"] and row["base_failed"])
    assert quality_rules.quality_rules(nothing, "doc_id").count() == 0


def test_line_rules(spark):
    good = "\n".join(" ".join(f"w{(i * 9 + k) * 7}" for k in range(9)) + "." for i in range(12))
    junk = "Home | About | Contact | Help\nAccept all cookies.\nBUY!! NOW!! GO!!\nno mark at all here"
    rows = [(1, good), (2, f"{good}\n{junk}"), (3, "\n".join([good[:400], *(f"menu | item{i} | of | {i}" for i in range(60))]))]
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(
        spark.createDataFrame(rows, "doc_id long, text string"), "doc_id").collect()}
    assert got[1]["kept"] and got[1]["clean_text"] == good
    assert got[2]["kept"] and got[2]["clean_text"] == good
    assert (got[2]["n_navigation"], got[2]["n_boilerplate"], got[2]["n_punctuation"]) == (1, 1, 2)
    assert not got[3]["kept"] and not got[3]["base_failed"]


def test_token_counts_and_cache(spark, docs, texts, nothing, tmp_path):
    tokenizer = Tokenizer.from_file(BPE)
    want = sorted((len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for t in texts)
    cache = str(tmp_path / "cache")
    for _ in range(2):  # the second time everything is in the cache
        got = token_counts.token_counts(docs, "doc_id", tokenizer_file=BPE, cache=cache).collect()
        assert sorted((r["n_bytes"], r["n_tokens"]) for r in got) == want
        assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in got)
        stored = spark.read.parquet(cache)
        assert stored.count() == len({t or "" for t in texts})
    more = spark.createDataFrame([(1, "something new")], "doc_id long, text string")
    token_counts.token_counts(more, "doc_id", tokenizer_file=BPE, cache=cache).collect()
    assert spark.read.parquet(cache).count() == stored.count() + 1
    assert token_counts.token_counts(nothing, "doc_id", tokenizer_file=BPE, cache=str(tmp_path / "none")).count() == 0


def test_chunks_count_as_whole_texts():
    rng = random.Random(1)
    bits = [" ", "  ", "\n", "\t", "a", "B", "é", "1", "23", "'s", ".", "<|endoftext|>", "\x1c", "\x85", "​", "日", "😀"]
    some = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(3_000)]
    whole = Tokenizer.from_file(BPE).encode_batch(some, add_special_tokens=False)
    assert token_counts.ChunkCounter(BPE)(some) == [len(x.ids) for x in whole]


def test_pieces_round_trip_and_parity(docs, texts, nothing):
    reference = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = sorted(
        (len(ids), zlib.crc32(np.array(ids, "<i4").tobytes())) for ids in (reference.encode(t or "") for t in texts)
    )
    got = sentence_pieces.round_trip(docs, PIECES).collect()
    assert sorted((r["n_ids"], r["ids_crc32"]) for r in got) == want
    assert all(r["restored"] and r["n_differing"] == 0 for r in got)
    coded = sentence_pieces.encoded(docs, PIECES)
    back = sentence_pieces.decoded(coded, PIECES)
    assert sorted(r["text"] for r in back.collect()) == sorted(t or "" for t in texts)
    assert sentence_pieces.round_trip(nothing, PIECES).count() == 0


def test_pieces_of_odd_texts():
    rng = random.Random(2)
    bits = [" ", "  ", "\n", "a", "é", "1", "<s>", "<0x41>", "▁", "日", "😀", " the", "ing"]
    some = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(3_000)]
    own, reference = sentence_pieces.PieceCodec(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found = own.encode(some)
    assert [ids for ids, _ in found] == reference.encode(some)
    assert [own.decode(ids) for ids, _ in found] == [reference.decode(ids) for ids, _ in found]


def test_pieces_come_from_the_rebuilt_tokenizer():
    own, reference = sentence_pieces.PieceCodec(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    some = ["the house runs", "日本 😀", ""]

    class Checked:
        """Equal ids, of another type, so that it shows whose ids are given out; other ids for one chunk."""

        def encode(self, texts, **_):
            return [[5, 6] if t == "runs" else [np.int64(i) for i in reference.encode(t)] for t in texts]

    own._reference = Checked()
    assert own.model.can_be_cut
    (first, odd), *others = own.encode(some)
    assert (first, odd) == ([*reference.encode("the house"), 5, 6], 1)
    assert [(ids, n) for ids, n in others] == [(reference.encode(t), 0) for t in some[1:]]
    assert all(type(i) is int for ids in (first, *(ids for ids, _ in others)) for i in ids)


def test_pieces_are_decoded_by_the_rebuilt_tokenizer():
    own, reference = sentence_pieces.PieceCodec(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rng = random.Random(3)
    for _ in range(300):
        # Controls, unknown ids and bytes that form no text are among them.
        ids = [rng.choice([rng.randrange(3), rng.randrange(3, 259), rng.randrange(len(own.model.pieces))])
               for _ in range(rng.randint(0, 8))]
        ids = [i for i in ids if own.model.pieces[i][2] != sentence_pieces.BYTE] if rng.random() < 0.5 else ids
        assert own.decode(ids) == reference.decode(ids), ids
    ids = reference.encode("the house")
    own._tokenizer.decoder = decoders.Fuse()
    assert own.decode(ids) == "▁the▁house"


def written_model(path, byte_fallback, extra_blanks, seed):
    """A unigram model file, written field by field: a few pieces with scores, nothing is trained."""
    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    def field(number, value):
        if isinstance(value, bytes):
            return varint(number << 3 | 2) + varint(len(value)) + value
        if isinstance(value, float):
            return varint(number << 3 | 5) + struct.pack("<f", value)
        return varint(number << 3) + varint(int(value))

    rng = random.Random(seed)
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    pieces += [(f"<0x{i:02X}>", 0.0, 6) for i in range(256)] if byte_fallback else []
    words = ["▁", "▁the", "▁a", "the", "th", "he", "▁ab", "ab", "abc", "bc", "é", "日本", "ing", "▁b", *"abcdehint."]
    pieces += [(w, -round(rng.uniform(1, 9), 3), 1) for w in words]
    model = b"".join(field(1, field(1, t.encode()) + field(2, s) + field(3, k)) for t, s, k in pieces)
    model += field(2, field(3, 1) + field(35, byte_fallback))
    model += field(3, field(1, b"identity") + field(3, True) + field(4, not extra_blanks) + field(5, True))
    path.write_bytes(model)
    return str(path)


@pytest.mark.parametrize("byte_fallback", [True, False])
@pytest.mark.parametrize("extra_blanks", [True, False])
def test_unigram_pieces(tmp_path, byte_fallback, extra_blanks):
    """Scores decide; with and without bytes for what the vocabulary lacks, with blanks kept or collapsed."""
    for seed in range(3):
        file = written_model(tmp_path / f"{seed}.model", byte_fallback, extra_blanks, seed)
        own, reference = sentence_pieces.PieceCodec(file), sentencepiece.SentencePieceProcessor(model_file=file)
        assert own.model.kind == sentence_pieces.UNIGRAM and own.model.can_be_cut == extra_blanks
        rng = random.Random(seed)
        bits = ["the", "ab", "abc", "thing", "é", "日本", "😀", " ", " ", "  ", ".", "x", "bathe"]
        some = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 20))) for _ in range(600)]
        some.append(" ".join(rng.choice(["the", "abc", "thing", "bathe", "tin"]) + str(i) for i in range(700)))
        found = own.encode(some)
        assert [ids for ids, _ in found] == reference.encode(some)
        assert sum(n for _, n in found) == 0
        assert [own.decode(ids) for ids, _ in found] == [reference.decode(ids) for ids, _ in found]


def test_chunks_encoded_together_equal_single_ones():
    """Enough new chunks for runs of many; some with a marker or a break inside, which are taken one by one."""
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefghiéß日1") for _ in range(rng.randint(1, 9))) for _ in range(2_000)]
    words += ["a▁b", "x\ty", "\x00z", "▁", "q\u00a0r"]
    some = [" ".join(rng.choice(words) for _ in range(400)) for _ in range(20)] + ["", " lead", "trail ", "two  blanks"]
    own, reference = sentence_pieces.PieceCodec(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    together = []
    learn = own._learn_together
    own._learn_together = lambda words: together.append(learn(words)) or together[-1]
    coded = own.encode_run(some)
    assert together and all(together)
    assert [coded.ids[a:b].tolist() for a, b in zip(coded.bounds[:-1], coded.bounds[1:])] == reference.encode(some)
    assert coded.restored.tolist() == [reference.decode(ids) == t for t, ids in zip(some, reference.encode(some))]
    assert not coded.differing.any()


def test_remembered_chunks_move_on(monkeypatch):
    monkeypatch.setattr(sentence_pieces, "REMEMBERED", 5)
    own, reference = sentence_pieces.PieceCodec(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for i in range(20):
        some = [f"the house {i} runs", f"and {i} is {i + 1}"]
        assert [ids for ids, _ in own.encode(some)] == reference.encode(some)
        assert len(own._young) + len(own._old) <= 30
    assert b"the" in own._young or b"the" in own._old


def test_base_spans_and_digest(spark, docs, texts, nothing):
    text = ("Mail a.b@c.org or x@y; 10.0.0.1 and 300.1.1.1, card 4111 1111 1111 1111, not 4111 1111 1111 1112, "
            "call +1 (456) 555-2186 or +1 23.")
    base = personal_data.base_spans(text)
    assert [(text[s:e], k) for s, e, k in base] == [
        ("a.b@c.org", "email"), ("10.0.0.1", "ip"), ("4111 1111 1111 1111", "card"), ("+1 (456) 555-2186", "phone")]
    rows = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in personal_data.personal_data(rows).collect()}
    assert got[1]["base_sha256"] == hashlib.sha256(personal_data.as_text(base).encode()).hexdigest()
    assert (got[1]["n_email"], got[1]["n_ip"], got[1]["n_card"], got[1]["n_phone"]) == (1, 1, 1, 1)
    assert set(personal_data.as_text(base).split(",")) <= set(got[1]["spans"].split(","))
    assert got[2]["spans"] == got[3]["spans"] == "" and got[2]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert personal_data.personal_data(docs).count() == len(texts)
    assert personal_data.personal_data(nothing).count() == 0


def test_field_on_held_out_rows():
    field = personal_data.default_field()
    right = total = 0
    for some, labels in personal_data.labelled_table(150, seed=99):
        path = field.decode([some])[0]
        right += sum(personal_data.LABELS[i] == x for i, x in zip(path, labels))
        total += len(labels)
    assert right / total > 0.97


def test_viterbi_is_the_best_of_all_paths():
    field = personal_data.default_field()
    window = ["call", "456-555-2186.", "now"]
    scores, moves = field.scores(window), field.transition
    best = max(
        np.ndindex(*[len(personal_data.LABELS)] * 3),
        key=lambda p: scores[0, p[0]] + scores[1, p[1]] + scores[2, p[2]] + moves[p[0], p[1]] + moves[p[1], p[2]],
    )
    assert tuple(field.decode([window])[0]) == best


def test_field_adds_spans_and_mask(spark):
    text = "write to joe.12 (at) mail3.foo.com now or (456) 555-2186 please, version 2.0. of 2021"
    (base, spans), = personal_data.found_spans([text], personal_data.default_field())
    assert not base
    assert [(text[s:e], k) for s, e, k in spans] == [("joe.12 (at) mail3.foo.com", "email"), ("(456) 555-2186", "phone")]
    rows = spark.createDataFrame([(1, text, "k"), (2, None, None)], "doc_id long, text string, spans string")
    got = {r["doc_id"]: r["text"] for r in personal_data.masked(rows).collect()}
    assert got == {1: "write to <EMAIL> now or <PHONE> please, version 2.0. of 2021", 2: None}


def test_look_alikes_are_no_cards():
    """Numbers of a card's length that fail its check, whole or in groups, stay; those that pass are found."""
    rng = random.Random(5)
    field = personal_data.default_field()
    for _ in range(300):
        digits = "".join(rng.choice("0123456789") for _ in range(rng.randint(14, 19)))
        last = rng.choice([d for d in "0123456789" if not personal_data.luhn(digits[:-1] + d)])
        digits = digits[:-1] + last
        groups = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        number = rng.choice([digits, " ".join(groups), "-".join(groups), ".".join(groups)])
        text = f"order {number} was sent on {rng.randint(10, 28)}.{rng.randint(10, 12)}.2021, see #{rng.randint(1, 10**6)}"
        (base, spans), = personal_data.found_spans([text], field)
        assert not [s for s in spans if s[2] == "card"], text
    first, second = "4111111111111111", "5500005555555559"
    (base, spans), = personal_data.found_spans([f"cards {first} {second} both"], field)
    assert not base and [(s, e, k) for s, e, k in spans] == [(6, 22, "card"), (23, 39, "card")]


def test_field_on_rows_of_another_making():
    """Sentences written otherwise than the labelled table: most of what is there is found, nearly nothing else is."""
    rng = random.Random(8)
    pieces = [
        ("reach me under {} today", "212-555-{0:04d}", "phone"), ("Fax: {}", "(030) 555-{0:04d}", "phone"),
        ("my address is {} thanks", "max{0} (at) firma{0}.de", "email"), ("host {} answered", "10.{0} . 7.9", None),
        ("we sold {} units", "{0}", None), ("chapter {} begins", "3.{0}.1.", None), ("built {} ago", "{0} years", None),
        ("Version {} is out", "v{0}.2", None), ("isbn {} here", "978-3-16-1{0:05d}-0", None),
        ("score {} at home", "3:{0}", None), ("paid {} euro", "{0},50", None),
    ]
    wanted = found = hit = 0
    for _ in range(400):
        frame, form, kind = rng.choice(pieces)
        value = form.format(rng.randint(1000, 9999))
        text = frame.format(value)
        (_, spans), = personal_data.found_spans([text], personal_data.default_field())
        start = text.index(value)
        right = [s for s in spans if kind and s[2] == kind and s[0] < start + len(value) and start < s[1]]
        wanted += kind is not None
        hit += bool(right)
        found += len(spans) if kind != "skip" else 0
    assert hit / wanted > 0.9 and hit / found > 0.75, (hit, wanted, found)


def test_windows_decode_like_whole_texts(texts):
    field = personal_data.default_field()
    rng = random.Random(4)
    bits = ["plain", "words", "4111", "1111", "2.0", "a@b", "(at)", "x.12", "mail3.foo.com", "456-555-2186", "end."]
    some = [t or "" for t in texts] + [" ".join(rng.choice(bits[:2] * 6 + bits) for _ in range(60)) for _ in range(200)]
    for text in some:
        words = list(re.finditer(r"[^\x20\x09-\x0D]+", text))
        whole = field.decode([[m[0] for m in words]])[0] if words else []
        at, windowed = {m.start(): i for i, m in enumerate(words)}, [0] * len(words)
        for run, before, after in personal_data._windows(text):
            for m, label in zip(run, field.decode([[m[0] for m in run]], [(before, after)])[0]):
                windowed[at[m.start()]] = int(label)
        assert windowed == list(whole)


def test_language_on_held_out_rows(spark, nothing):
    rng = random.Random(6)
    vocabulary = {"aa": ["the", "thing", "of", "and", "ing"], "bb": ["der", "und", "ß", "schein"], "cc": ["les", "eaux", "é"]}
    rows = [(i, " ".join(rng.choice(vocabulary[k]) for _ in range(rng.randint(1, 500))), k)
            for i in range(600) for k in [rng.choice(list(vocabulary))]]
    rows += [(1000, None, "aa"), (1001, "", "aa"), (1002, "1234 .", "bb"), (1003, "the thing and", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in language.identify(docs).collect()}
    assert len(got) == len(rows)
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in got)
    held = [(got[i]["lang_pred"], k) for i, _, k in rows[:600] if got[i]["held_out"]]
    assert sum(a == b for a, b in held) / len(held) > 0.95
    for i in (1000, 1001, 1002):
        assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
    assert got[1003]["lang_pred"] == "aa" and all(0 <= r["score"] <= 1 for r in got.values())
    assert language.identify(nothing).count() == 0
    unlabelled = language.identify(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in unlabelled.collect()} == {"und"}


def test_fast_responses_equal_convolution():
    net = language.ByteNetwork.fresh(["x", "y"])
    codes, owner = language.window_codes([b"hello", b"z" * 600, b""])
    assert list(owner) == [0, 1, 1, 1, 2]
    embedded = net.embedding[codes]
    pooled = []
    for kernel, bias, width in zip(net.kernels, net.biases, language.WIDTHS):
        seen = np.concatenate([embedded[:, k : language.WINDOW - width + 1 + k] for k in range(width)], axis=2)
        pooled.append(np.maximum((seen @ kernel).max(axis=1) + bias, 0))
    want = language._softmax(np.concatenate(pooled, axis=1) @ net.out + net.out_bias)
    assert np.allclose(net.probabilities(codes.astype(int), net.tables()), want, atol=1e-4)
