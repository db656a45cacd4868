"""Phrase collocations, the filter audit and the chosen-path join, held against plain versions."""

import random
import re
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from degraus.llm import chosen_path, collocations, filter_audit

FOLDER = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def equals_sql(spark, name):
    mine = entry.queries()[name](spark, FOLDER).toPandas()
    con = duckdb.connect()
    for table in ("documents", "labels"):
        con.sql(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    theirs = con.sql(entry.oracle_sql()[name]).df()
    order = sorted(mine.columns)
    assert order == sorted(theirs.columns)
    mine, theirs = (x[order].astype(str).sort_values(order).reset_index(drop=True) for x in (mine, theirs))
    assert mine.equals(theirs)


# --- Phrases --------------------------------------------------------------------------------


def plain_phrases(docs, longest, least, most_ranked):
    """What ``collocations`` returns, by counting all phrases."""
    counts, sizes = {}, Counter()
    for text, lang in docs:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            own = counts.setdefault(lang or "und", Counter())
            sizes[lang or "und"] += len(words)
            for m in range(1, longest + 1):
                own.update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    found = []
    for lang, own in counts.items():
        phrases = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        inside = {
            p[i : i + m] for p, a in phrases.items() for m in range(2, len(p)) for i in range(len(p) - m + 1)
            if 100 * a >= 100 * own[p[i : i + m]]
        }
        ranked = []
        for p, a in phrases.items():
            if p in inside:
                continue
            score, _, left, right = min(
                (1000 * a * sizes[lang] // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p))
            )
            ranked.append((-score, -a, " ".join(p).encode(), left, right))
        found += [
            (lang, i, phrase.decode(), -a, left, right, sizes[lang], -score)
            for i, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:most_ranked], 1)
        ]
    return sorted(found, key=repr)


def invented(rng, n):
    words = ["the", "of", "Straße", "naïve", "x", "|", "日本", "it's", "A-B"]
    texts = []
    for _ in range(n):
        text = ""
        for _ in range(rng.randint(0, 40)):
            text += rng.choice(["new york city hall", *words, *words]) + rng.choice([" ", " ", " ", "\t", ", ", ".\n", "\r "])
        texts.append(text)
    return texts


@pytest.mark.parametrize("shard_bytes", [300, 16_000_000])
def test_phrases_equal_plain_counts(spark, shard_bytes):
    rng = random.Random(11)
    docs = [(t, rng.choice(["en", "de", None, "und"])) for t in invented(rng, 160)]
    docs += [(None, "en"), ("", None), (" .,;", "en"), ("Lone", "xx"), ("of of of of of of", "de"), docs[0], docs[0]]
    df = spark.createDataFrame([(*d, "w", 1) for d in docs], "text string, lang string, word string, n int").repartition(5)
    got = rows_of(collocations.collocations(df, least=6, most_ranked=50, shard_bytes=shard_bytes))
    assert got == plain_phrases(docs, 5, 6, 50)
    assert len(got) > 60


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_phrases_of_other_lengths(spark, longest):
    docs = [(t, "en") for t in invented(random.Random(longest), 60)]
    df = spark.createDataFrame(docs, "text string, lang string")
    assert rows_of(collocations.collocations(df, longest=longest, least=5, most_ranked=9)) == plain_phrases(docs, longest, 5, 9)


def test_phrases_without_candidates(spark):
    df = spark.createDataFrame([("a b c", "en"), (None, None)], "text string, lang string")
    assert collocations.collocations(df).count() == 0
    assert collocations.collocations(df.limit(0)).count() == 0


def test_one_very_long_text_and_ties(spark):
    docs = [("b a . " * 40_000 + "a c . " * 40_000, "en")]
    df = spark.createDataFrame(docs, "text string, lang string")
    assert rows_of(collocations.collocations(df)) == plain_phrases(docs, 5, 100, 2000)


def test_scores_beyond_64_bits():
    """Products of counts near a million million are exact."""
    a, n, left, right = 3 * 10**12, 10**13, 4 * 10**12, 5 * 10**12
    assert 1000 * a * n > 2**63 and left * right > 2**63
    spark = entry.SparkSession.getActiveSession()
    row = spark.range(1).select(*(F.lit(x).alias(c) for x, c in ((a, "a"), (n, "n"), (left, "l"), (right, "r"))))
    exact = F.call_function(
        "div", F.lit(1000).cast("decimal(4,0)") * (collocations._exact(F.col("a")) * collocations._exact(F.col("n"))),
        collocations._exact(F.col("l")) * collocations._exact(F.col("r")),
    )
    assert row.select(exact).first()[0] == 1000 * a * n // (left * right)


@pytest.mark.parametrize("most", [1, 1 << 20])
def test_a_task_sums_longer_phrases_over_its_shards(most):
    """Two shards that number their words differently; together each phrase is one row, unless a task must let go."""
    import pyarrow as pa

    rows, plain = [], Counter()
    for shard, (words, numbers) in enumerate([([1, 2, 3, 1, 2, 3, 1, 2], [7, 8, 9]), ([3, 1, 2, 3, 1, 2, 3], [7, 8, 9])]):
        index = collocations.PhraseIndex.of(np.array([0, *words, 0], np.int32))
        named = [numbers[w - 1] for w in words]
        for m in (4, 5):
            plain.update(tuple(named[i : i + m]) for i in range(len(named) - m + 1))
        pairs = len(index.pairs()[0])
        triples = next(index.grown(3, np.arange(pairs)))[0]
        rows.append({
            "shard": shard, "numbers": np.array(numbers, np.int32),
            "forward": index.forward.transform.astype("<i4").tobytes(),
            "backward": index.backward.transform.astype("<i4").tobytes(),
            "two": np.arange(pairs, dtype=np.int32), "three": np.arange(len(triples), dtype=np.int32),
        })
    batch = pa.RecordBatch.from_pylist(rows)
    got = [(tuple(r["ids"]), r["n"]) for b in collocations._longer(5, most)([batch]) for r in b.to_pylist()]
    summed = Counter()
    for ids, n in got:
        summed[ids] += n
    assert summed == plain
    assert (len(got) == len(plain)) == (most > 1)


@pytest.mark.parametrize("largest", [50, 1 << 60])
def test_keys_are_sorted_with_their_places(largest):
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 50, 400) * (largest // 50)
    places = np.arange(5, 405, dtype=np.int32)
    got = collocations._sorted(keys, places)
    assert list(zip(*(x.tolist() for x in got))) == sorted(zip(keys.tolist(), places.tolist()))


@pytest.mark.parametrize("seed", range(4))
def test_index_extends_to_both_sides(seed):
    """Intervals, counts and extensions of every phrase equal those read off the sequence."""
    rng = np.random.default_rng(seed)
    sequence = np.concatenate([[0], rng.integers(0, 5, 300), [0]]).astype(np.int32)
    plain = Counter()
    for m in range(1, 6):
        plain.update(
            tuple(map(int, sequence[i : i + m])) for i in range(len(sequence) - m + 1) if sequence[i : i + m].all()
        )
    index = collocations.PhraseIndex.of(sequence)
    low, count, ids = index.words()
    assert {(int(i),): int(n) for i, n in zip(ids, count)} == {p: n for p, n in plain.items() if len(p) == 1}
    phrases, back, names = low, low, ids[:, None]
    for m in range(2, 6):
        left = index.to_the_left(phrases, back, count)
        right = index.to_the_right(phrases, back, count)
        by_left = {
            (int(w), *map(int, names[o])): (int(f), int(b), int(n)) for o, w, f, b, n in zip(*left)
        }
        by_right = {
            (*map(int, names[o]), int(w)): (int(f), int(b), int(n)) for o, w, f, b, n in zip(*right)
        }
        assert by_left == by_right
        assert {p: x[2] for p, x in by_left.items()} == {p: n for p, n in plain.items() if len(p) == m}
        owner, word, phrases, back, count = left
        names = np.column_stack([word, names[owner]])
        order = np.argsort(phrases)
        phrases, back, count, names = phrases[order], back[order], count[order], names[order]


def test_phrases_equal_sql(spark):
    equals_sql(spark, "op11_collocations")


# --- Filters ----------------------------------------------------------------------------------


def plain_audit(docs, labels):
    """``docs(doc_id, text, source)``; rows of part, order, step and the seven counts."""
    firsts = {}
    for i, text, _ in docs:
        if i is not None:
            firsts[text or ""] = min(i, firsts.get(text or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows, parts = [], sorted({s or "" for _, _, s in docs})
    for part in parts:
        failing = []
        for i, text, source in docs:
            if (source or "") != part:
                continue
            t = text or ""
            words = re.findall(r"[^\x20\x09-\x0D]+", t)
            fails = {
                "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search("[#$%&*|]", t)),
                "E": i is not None and firsts[t] < i,
            }
            failing.append(({f for f, x in fails.items() if x}, i in good, i in toxic))
        shapley = Counter()
        steps = []
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                before = set(order[:k])
                removed = [x for x in failing if f in x[0] and not x[0] & before]
                shapley[f] += len(removed)
                steps.append((
                    part, "".join(order), k + 1, sum(not x[0] & {*before, f} for x in failing), len(removed),
                    sum(f in x[0] and bool(x[0] & before) for x in failing), sum(x[0] == {f} for x in failing),
                    sum(x[1] for x in removed), sum(x[2] for x in removed),
                ))
        rows += [(*s, shapley[s[1][s[2] - 1]]) for s in steps]
    return sorted(rows, key=repr)


AUDIT = "doc_id long, text string, source string, n long, mask int, part string, good boolean"


def audit_frames(spark, docs, labels):
    df = spark.createDataFrame([(*d, 7, 3, "p", True) for d in docs], AUDIT)
    marks = spark.createDataFrame([(*x, "m") for x in labels], "doc_id long, quality int, toxic int, mask string")
    return df, marks


def test_audit_equals_plain_counts(spark):
    rng = random.Random(12)
    vocabulary = [f"word{i}" for i in range(400)] + ["ÄÖ", "NATO", "a|b", "100%", "日本"]
    docs = []
    for i in range(150):
        some = rng.sample(vocabulary, rng.choice([3, 40, 400]))
        docs.append((i, " ".join(rng.choice(some) for _ in range(rng.choice([0, 1, 199, 200, 260]))), rng.choice("xyz")))
    docs += [(rng.randrange(300), docs[rng.randrange(20)][1], rng.choice(["x", None, ""])) for _ in range(80)]
    docs += [(None, docs[3][1], "x"), (None, None, None), (900, None, "y"), (901, "", None), (5, docs[5][1], "y"), docs[7], docs[7]]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 200, 2)] + [(4, 1, 1), (None, 1, 1)]
    got = rows_of(filter_audit.filter_audit(*audit_frames(spark, docs, labels)))
    assert got == plain_audit(docs, labels)


def test_audit_limits_are_strict(spark):
    two_hundred = " ".join(f"w{i}" for i in range(200))
    half = " ".join([f"w{i}" for i in range(100)] * 2)
    docs = [
        (1, two_hundred, "s"), (2, two_hundred[: two_hundred.rindex(" ")], "s"), (3, half, "s"), (4, half + " w1", "s"),
        (5, "A" + "a" * 49, "c"), (6, "AA" + "a" * 97, "c"), (7, "a\x0bb c\x85d", "c"),
    ]
    got = rows_of(filter_audit.filter_audit(*audit_frames(spark, docs, [(1, 1, 0)])))
    assert got == plain_audit(docs, [(1, 1, 0)])


def test_audit_of_copies_in_all_parts_and_of_nothing(spark):
    docs = [(i, "the same text", f"s{i % 3}") for i in range(600, 0, -1)] + [(0, "x " * 300_000, "long")]
    df, marks = audit_frames(spark, docs, [(600, 1, 1)])
    assert rows_of(filter_audit.filter_audit(df.repartition(7), marks)) == plain_audit(docs, [(600, 1, 1)])
    assert filter_audit.filter_audit(df.limit(0), marks).count() == 0
    assert filter_audit.filter_audit(df.where("source = 's1'"), marks.limit(0)).count() == 600


def test_audit_equals_sql(spark):
    equals_sql(spark, "op12_filter_audit")


# --- Chosen paths ---------------------------------------------------------------------------------


def shingles(text, width):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def plain_components(docs, width, percent):
    """Per row: size of the set, smallest id of its component, kept."""
    sets = [shingles(t, width) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    lows = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            lows[find(i)] = min(doc, lows.get(find(i), doc))
    found = []
    for i, (doc, _) in enumerate(docs):
        component = lows.get(find(i)) if sets[i] else doc
        found.append((doc, len(sets[i]), component, doc == component))
    return sorted(found, key=repr)


def families(rng, n):
    """Texts and copies with more and more words changed, around the least similarity."""
    texts = []
    for _ in range(n):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([1, 4, 5, 30, 120]))]
        texts.append(" ".join(words))
        for _ in range(rng.randrange(5)):
            changed = list(words)
            for _ in range(rng.randrange(1 + len(words) // 25)):
                changed[rng.randrange(len(changed))] = rng.choice(["new", "Neu", "w1"])
            texts.append(rng.choice([" ", "\n", "\t "]).join(changed))
    return texts


PATHS = "doc_id long, text string, id long, key string, root string, doc string, n int, lows string"


@pytest.mark.parametrize("percent, width", [(85, 5), (70, 3)])
def test_paths_equal_all_pairs(spark, percent, width):
    rng = random.Random(percent)
    texts = families(rng, 70)
    docs = list(zip(rng.sample(range(10_000), len(texts)), texts))
    docs += [(20_000, None), (20_001, ""), (20_002, " \n"), (20_003, "two words"), (20_004, "Two  Words"), docs[0], docs[9]]
    docs += [(None, texts[0]), (None, "only without an id"), (docs[3][0], texts[20])]
    df = spark.createDataFrame([(*d, None, "k", "r", "d", 1, "l") for d in docs], PATHS)
    got = rows_of(chosen_path.near_duplicates(df, width=width, percent=percent))
    assert got == plain_components(docs, width, percent)


def test_a_large_group_and_a_passage_that_many_share(spark):
    """Nodes that branching does not thin out, and large nodes of texts that only share a passage."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(90)]
    docs = []
    for i in range(150):
        words = list(base)
        words[rng.randrange(90)] = f"x{i}"
        docs.append((i, " ".join(words)))
    passage = [f"p{i}" for i in range(60)]
    docs += [(1000 + i, " ".join([*passage, *(f"q{i}_{k}" for k in range(40))])) for i in range(150)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    assert rows_of(chosen_path.near_duplicates(df)) == plain_components(docs, 5, 85)


def test_recall_of_trees(spark):
    """Pairs of just the least similarity are met in all trees together, whatever the depth."""
    assert chosen_path.trees_for(85) == 4
    rng = np.random.default_rng(3)
    sets, bounds, n = [], [0], 400
    for _ in range(n):
        common = rng.integers(0, 1 << 63, 170, dtype=np.uint64)
        for _ in range(2):
            sets.append(np.sort(np.concatenate([common, rng.integers(0, 1 << 63, 15, dtype=np.uint64)])))
            bounds.append(bounds[-1] + 185)
    lows = chosen_path.minwise(np.concatenate(sets), np.array(bounds))
    rows = [(i, [int(v) for v in x.view(np.int32)]) for i, x in enumerate(lows)]
    df = spark.createDataFrame(rows, "id long, lows array<int>")
    lists = chosen_path.last_nodes(df, chosen_path.trees_for(85), small=1, deepest=6)
    pairs = lists.groupBy("key").agg(F.collect_set("id").alias("ids")).collect()
    met = {i // 2 for r in pairs for i in r["ids"] if i ^ 1 in r["ids"]}
    assert len(met) == n


def test_paths_of_long_and_of_no_texts(spark):
    long_text = " ".join(f"v{i % 977}x{i // 31}" for i in range(200_000))
    docs = [(2, long_text), (1, long_text + " more"), (3, "short")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows_of(chosen_path.near_duplicates(df)) == [
        (1, 199_997, 1, True), (2, 199_996, 1, False), (3, 1, 3, True)]
    assert chosen_path.near_duplicates(df.limit(0)).count() == 0
