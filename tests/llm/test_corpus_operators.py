"""Operators over whole tables, held against plain versions."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from degraus.llm import components, jaccard_join, line_dedup, neighbours, packing, queries, shards

SCHEMA = "doc_id long, text string, id string, key string, size string, bin string, shard string"


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, None, "k", None, "b", None) for i, t in zip(ids, texts)], SCHEMA)


def groups_of(n, linked):
    """Smallest member reachable by links, for 0 to n - 1."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            a, b = find(i), find(j)
            if a != b and linked(i, j):
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(rng, text, n):
    text = list(text)
    for _ in range(n):
        at, kind = rng.randrange(len(text) or 1), rng.random()
        if kind < 0.4 and text:
            text[at] = rng.choice("abcé")
        elif kind < 0.7 and text:
            text.pop(at)
        else:
            text.insert(at, rng.choice("abß"))
    return "".join(text)


# --- Components -------------------------------------------------------------------------


def test_connected_chain_star_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100 + i, 200) for i in range(30)] + [(500, 500), (7, 3)]
    got = {r["node"]: r["root"] for r in components.connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in [*range(100, 130), 200]}, 500: 500}


def test_a_list_that_a_third_of_the_rows_share_without_linking(spark):
    """Every pair that could link is checked, whichever members are hubs, and each only once; chains join lists."""
    n = 700
    rows = [(1, i, i) for i in range(n)] + [(10 + i // 2, i, i) for i in range(2 * n)]
    links = {(a, a + 1) for a in range(0, 2 * n - 1) if a % 7 in (0, 1, 4) and (a + 1 < n or a % 2 == 0)}
    checked = spark.sparkContext.accumulator(0)

    def check(pairs):
        def keep(batches):
            for batch in batches:
                checked.add(batch.num_rows)
                yield batch.filter([p in links for p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())])

        return pairs.mapInArrow(keep, "a long, b long")

    members = spark.createDataFrame(rows, "key long, id long, v long").repartition(9)
    labels = components.linked_lists(members, lambda x, y: F.abs(x("v") - y("v")) <= 3, check)
    got = {r["node"]: r["root"] for r in labels.collect()}
    want = {}
    for a, b in sorted(links):
        want.setdefault(a, a)
        want[b] = want[a]
    assert got == want
    assert checked.value <= 3 * n + 2 * n


def test_joined_by_new_links(spark):
    def frame_of(pairs):
        return spark.createDataFrame(pairs, "a long, b long")

    labels = components.joined_by(None, frame_of([(5, 9), (20, 21), (30, 31)]))
    labels = components.joined_by(labels, frame_of([(9, 21), (40, 2), (31, 31)]))
    labels = components.joined_by(labels, frame_of([(40, 30)]))
    assert {r["node"]: r["root"] for r in labels.collect()} == {
        5: 5, 9: 5, 20: 5, 21: 5, 30: 2, 31: 2, 40: 2, 2: 2}


# --- Shards and packing -------------------------------------------------------------------


def test_longest_first():
    placed = shards.longest_first([(1, 5), (2, 5), (3, 4), (4, 3), (5, 3)], 2)
    loads = [sum(s for i, s in [(1, 5), (2, 5), (3, 4), (4, 3), (5, 3)] if placed[i] == k) for k in (0, 1)]
    assert sorted(loads) == [9, 11]


def test_shards_hold_groups_and_balance(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("abé") for _ in range(rng.randint(0, 300))) for _ in range(400)]
    texts += ["copy of one text"] * 300 + [None, None, "", ""]
    ids = [*range(len(texts) - 3), None, None, 5]
    rows = shards.shard_by_bytes(frame(spark, texts, ids)).collect()
    assert len(rows) == len(texts)
    assert sorted((r["size"], r["text_crc32"]) for r in rows) == sorted(
        (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for t in texts)
    by_text, loads, slots = {}, [0] * 8, [[] for _ in range(8)]
    for r in rows:
        by_text.setdefault((r["size"], r["text_crc32"]), set()).add(r["shard"])
        loads[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "bytes" and r["grown_shard"] is None
    assert all(len(s) == 1 for key, s in by_text.items() if key[0] > 1)  # null and empty are two groups of one size
    assert max(loads) - min(loads) <= max(301, sum(loads) // 100) or max(loads) == 300 * 17
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    assert shards.shard_by_bytes(frame(spark, []).limit(0)).count() == 0


def one_by_one(lengths, capacity):
    """Plain best fit, longest first, with one bin size."""
    open_bins = []
    for length in sorted(lengths, reverse=True):
        fitting = [i for i, left in enumerate(open_bins) if left >= length]
        if fitting:
            i = min(fitting, key=lambda i: open_bins[i])
            open_bins[i] -= length
        else:
            open_bins.append(capacity - length)
    return len(open_bins)


@pytest.mark.parametrize("seed", range(6))
def test_plan_in_bulk_equals_best_fit(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(1, 100) for _ in range(rng.randint(1, 300))]
    histogram = {x: lengths.count(x) for x in set(lengths)}
    plan = packing._planned(histogram, [100], 100, 4)
    assert sum(n for _, n, *_ in plan.bins) == one_by_one(lengths, 100)
    best = packing.plan_bins(histogram, (25, 50, 100), 4)
    assert best.cost <= plan.cost


def test_packing_places_every_token_once(spark):
    rng = random.Random(3)
    sizes = [rng.choice([0, 1, 17, 512, 700, 8192, 8193, 30_000, rng.randint(1, 9_000)]) for _ in range(300)]
    sized = spark.createDataFrame([(None if i == 5 else i, n, "x") for i, n in enumerate([*sizes, None])],
                                  "id long, n_tokens long, bin_id string")
    rows = packing.pack(sized).collect()
    assert sum(r["n_tokens"] for r in rows) == sum(sizes)
    taken = {}
    for r in rows:
        if r["n_tokens"] == 0:
            assert r["bin_id"] is None
            continue
        taken.setdefault((r["bin_id"], r["bin_capacity"]), []).append((r["bin_offset"], r["n_tokens"]))
    assert len({b for b, _ in taken}) == len(taken)
    for (_, capacity), spans in taken.items():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
        content = sum(n for _, n in spans)
        assert capacity == next(c for c in packing.CAPACITIES if c >= content)
    assert packing.pack(sized.limit(0)).count() == 0


# --- Jaccard join ---------------------------------------------------------------------------


def shingles(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return set() if not w else {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))}


def near_texts(seed, most=25):
    rng = random.Random(seed)
    texts = [None, "", " \n", "a", "A", "a b", "a  B\n", "x " * 3_000]
    for _ in range(90):
        base = [rng.choice("a b c d e f g h é ß Q".split()) + str(rng.randint(0, 30))
                for _ in range(rng.choice([3, 8, 12, 14, 20, 25, 40, 100, 300]))]
        for _ in range(rng.randint(1, 4)):
            c = list(base)
            for _ in range(rng.randint(0, 1 + len(base) // most)):
                c[rng.randrange(len(c))] = f"x{rng.randint(0, 9)}"
            texts.append("\t".join(c).upper() if rng.random() < 0.2 else " ".join(c))
    return texts


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80)])
def test_jaccard_components(spark, width, percent):
    texts = near_texts(percent)
    sets = [shingles(t, width) for t in texts]
    want = groups_of(
        len(texts),
        lambda i, j: bool(sets[i] and sets[j]) and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]),
    )
    got = {r["doc_id"]: r for r in jaccard_join.jaccard_components(
        frame(spark, texts), width=width, percent=percent).collect()}
    assert [got[i]["n_shingles"] for i in range(len(texts))] == [len(s) for s in sets]
    assert [got[i]["component_id"] for i in range(len(texts))] == want
    kept = jaccard_join.first_of_components(frame(spark, texts), width=width, percent=percent)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want))


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(5)
    for percent in (80, 90):
        boundary = jaccard_join.chosen_boundary(percent)
        for size in [*range(1, 40), 150, 600]:
            a = np.sort(rng.integers(0, 1 << 63, size).astype(np.uint64) * np.uint64(2))
            for other in jaccard_join.partners(size, percent):
                n = min(jaccard_join.needed(size, other, percent), size, other)
                if 100 * n < percent * (size + other - n):
                    continue
                kept = rng.permutation(a)[:n]
                b = np.sort(np.concatenate([kept, rng.integers(0, 1 << 63, other - n).astype(np.uint64)]))
                keys = [set(np.concatenate(jaccard_join.keys_of(x, percent, boundary)).tolist()) for x in (a, b)]
                assert keys[0] & keys[1], (percent, size, other)


def test_jaccard_of_repeated_rows_and_nothing(spark):
    rows = frame(spark, ["one two three four", "one two three four", "one two three four", None], [3, 3, None, None])
    got = sorted((r["doc_id"] is None, r["n_shingles"], r["component_id"]) for r in
                 jaccard_join.jaccard_components(rows).where("n_shingles > 0").collect())
    assert got == [(False, 2, 3), (False, 2, 3), (True, 2, 3)]
    assert jaccard_join.jaccard_components(frame(spark, []).limit(0)).count() == 0


def test_a_list_of_unlinked_members_is_compared_whole(spark):
    """One key for all, and links only between neighbours: hubs of several rounds are needed."""
    members = spark.createDataFrame([(1, i) for i in range(70)], "key long, id long")
    got = components.linked_lists(
        members, lambda x, y: F.lit(True), lambda pairs: pairs.where((F.col("b") - F.col("a") == 1) & (F.col("a") % 10 != 9))
    )
    assert {r["node"]: r["root"] for r in got.collect()} == {i: i // 10 * 10 for i in range(70)}


def test_facts_given_apart_from_the_lists(spark):
    """The same components as with facts in every row, for lists of two and for one that needs hubs of several rounds."""
    pairs = [(1, i) for i in range(70)] + [(i, j) for i in range(70, 90, 2) for j in (i, i + 1)]
    rows = spark.createDataFrame(pairs, "key long, id long")
    facts = spark.createDataFrame([(i, i // 10) for i in range(90)], "id long, n long")
    firsts = rows.groupBy("key").agg(F.min("id").alias("first"))
    plain, apart = (
        components.linked_lists(
            m, lambda x, y: x("n") == y("n"), lambda p: p.where((F.col("b") - F.col("a") == 1) & (F.col("a") % 8 != 0)), f
        ).collect()
        for m, f in ((rows.join(facts, "id"), None), (rows.join(firsts, "key"), facts))
    )
    assert {(3, 1), (8, 1), (71, 70)} <= {*map(tuple, apart)} and 72 not in {r["node"] for r in apart}
    assert sorted(map(tuple, plain)) == sorted(map(tuple, apart))


def test_sets_that_share_a_key_by_chance_move_ids_alone(spark, monkeypatch):
    """Neither the facts nor the texts of sets that meet in lists of two, but are far apart, are stored for each key."""
    rng = random.Random(3)
    texts = []
    for i in range(60):
        shared = [f"s{i}x{k}" for k in range(25)]
        texts += [" ".join([f"w{rng.randrange(10**9)}" for _ in range(40)] + shared) for _ in range(2)]
    tables = []

    def noted(df, label, store=components.stored):
        tables.append(found := store(df, label))
        return found

    monkeypatch.setattr(jaccard_join, "discard", lambda *_: None)
    monkeypatch.setattr(components, "discard", lambda *_: None)
    for module in (jaccard_join, components):
        monkeypatch.setattr(module, "stored", noted)
    got = jaccard_join.jaccard_components(frame(spark, texts), width=5, percent=80).collect()
    assert all(r["component_id"] == r["doc_id"] for r in got) and len(got) == len(texts)
    kept = {c: sum(t.count() for t in tables if {*c} <= {*t.columns}) for c in (("key", "id"), ("key", "parity"), ("text",))}
    assert kept[("key", "id")] > 40
    assert kept[("key", "parity")] == kept[("text",)] == 0


# --- Lines ----------------------------------------------------------------------------------


def test_banded_distance(spark):
    rng = random.Random(5)
    pairs = [("", ""), ("a", ""), ("ab", "ba"), ("abc", "abc")]
    for _ in range(400):
        a = "".join(rng.choice("abcdé ") for _ in range(rng.choice([1, 2, 3, 5, 20, 70])))
        pairs.append((a, edited(rng, a, rng.randint(0, 4))))
    df = spark.createDataFrame(pairs, "a string, b string")
    for most in (1, 2, 3):
        got = df.select("a", "b", line_dedup.line_distance(F.col("a"), F.col("b"), most).alias("d")).collect()
        assert all(min(r["d"], most + 1) == min(distance(r["a"], r["b"]), most + 1) for r in got)


def test_line_classes(spark):
    rng = random.Random(8)
    base = ["".join(rng.choice("abcdé ") for _ in range(rng.choice([5, 47, 48, 50, 60, 90, 200]))) for _ in range(60)]
    lines = base + [edited(rng, b, rng.randint(0, 4)) for b in base for _ in range(2)]
    texts = ["\n".join(rng.choice(lines) for _ in range(rng.randint(1, 6))) for _ in range(100)]
    texts += [None, "", " \n\n", "y" * 20_000]
    places = [(i, k, x) for i, t in enumerate(texts) for k, x in enumerate((t or "").split("\n")) if x.strip(" \t\r\n\x0b\x0c")]
    distinct = sorted({x for *_, x in places})
    group = groups_of(
        len(distinct),
        lambda i, j: min(len(distinct[i]), len(distinct[j])) >= 48 and abs(len(distinct[i]) - len(distinct[j])) <= 2
        and distance(distinct[i], distinct[j]) <= 2,
    )
    of = dict(zip(distinct, group))
    first = {}
    for i, k, x in places:
        first.setdefault(of[x], (i, k))
    got = {(r["doc"], r["line_no"]): r for r in line_dedup.line_classes(frame(spark, texts)).collect()}
    assert {p: (r["first_doc"], r["first_line"]) for p, r in got.items()} == {(i, k): first[of[x]] for i, k, x in places}
    assert all(r["kept"] == ((r["first_doc"], r["first_line"]) == p) for p, r in got.items())
    assert line_dedup.line_classes(frame(spark, []).limit(0)).count() == 0


def test_short_lines_near_copies(spark):
    rng = random.Random(12)
    base = ["".join(rng.choice("abcdé ") for _ in range(rng.choice([6, 9, 10, 11, 13, 18, 19, 20, 21, 22, 30, 47, 48])))
            for _ in range(80)]
    lines = sorted({x for b in base for x in [b, *(edited(rng, b, rng.randint(1, 3)) for _ in range(2))] if x.strip()})
    lines += ["Thwhesnd esator whshing and hewh.", "Thwhesnd, esator whshing and hewh."]

    def permitted(n):
        return (n >= 10) + (n >= 20)

    group = groups_of(
        len(lines), lambda i, j: distance(lines[i], lines[j]) <= permitted(min(len(lines[i]), len(lines[j])))
    )
    rows = line_dedup.line_classes(frame(spark, lines), least_chars=line_dedup.NEAR_CHARS).collect()
    assert {r["doc"]: r["first_doc"] for r in rows} == dict(enumerate(group))
    assert group[-1] == group[-2] == len(lines) - 2


@pytest.mark.parametrize(("n", "edits", "most"), [(15, 1, 4), (24, 2, 8), (33, 2, 8), (66, 2, 8), (200, 2, 6), (70, 3, 12)])
def test_near_lines_share_one_of_few_keys(spark, n, edits, most):
    """Every pair within the edits, at the edges of the ranges of lengths too; a line has four keys a range."""
    rng = random.Random(n)
    low, pairs = (20 if n > 20 else 10), []
    for k in range(400):
        a = "".join(rng.choice("abé") for _ in range(n - 3 + k % 7))
        b = edited(rng, a, rng.randint(1, edits))
        if distance(a, b) <= edits and min(len(a), len(b)) >= low:
            pairs.append((a, b))
    keys = {
        end: line_dedup._keys_by_length(F.col(end), F.length(end), [1 << 20] * (edits - 1) + [low]) for end in "ab"
    }
    rows = spark.createDataFrame(pairs, "a string, b string").select(*(keys[end].alias(end) for end in "ab")).collect()
    assert len(rows) > 250
    assert all(set(r["a"]) & set(r["b"]) for r in rows)
    assert max(len(r["a"]) for r in rows) <= 2 * len(line_dedup.places(edits))
    assert sum(len(r["a"]) for r in rows) / len(rows) <= most


def test_op8_finds_near_copies_of_short_lines(spark, tmp_path):
    frame(spark, ["Copyright 2019 by A. Writer", "Copyright 2024 by A. Writer"]).write.parquet(
        str(tmp_path / "documents.parquet"))
    got = queries.REGISTRY["op8_line_dedup"](spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"], r["class_doc_id"], r["kept"]) for r in got) == [(0, 0, True), (1, 0, False)]


def test_drop_repeated_lines(spark):
    rng = random.Random(9)

    def line(n=80):
        return "".join(rng.choice("abcdefgh ") for _ in range(n))

    passage, own = line(300), [line(400) for _ in range(4)]
    near = edited(rng, passage, 1)
    texts = [f"{own[0]}\n{passage}", f"{near}\n\n{own[1]}", f"{own[2]}\n{passage}\n{own[3]}", f"{own[0]}\n{passage}", None, ""]
    got = {r["doc_id"]: r["text"] for r in line_dedup.drop_repeated_lines(frame(spark, texts)).collect()}
    # The whole copy is left for document-level deduplication.
    assert got == {0: texts[0], 1: f"\n{own[1]}", 2: f"{own[2]}\n{own[3]}", 3: texts[3]}


def test_only_proven_copies_keep_repeated_lines(spark):
    rng = random.Random(10)

    def line(words=12):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(words))

    passage, own, ten = line(30), [line(12) for _ in range(3)], [line(30) for _ in range(20)]
    texts = [
        f"{own[0]}\n{passage}",
        f"{own[1]}\n{passage}",  # over half repeats, but it is no copy of a document
        "\n".join(ten), "\n".join([*ten[:19], own[2]]),  # one line of twenty differs: a copy
        passage,  # nothing is left of it
        "\n".join([*ten[:10], passage]),  # lines of two documents
    ]
    docs = frame(spark, texts)
    cleaned = line_dedup.drop_repeated_lines(docs)
    got = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    assert got == {0: texts[0], 1: own[1], 2: texts[2], 3: texts[3]}
    after = {r["doc_id"]: r["text"] for r in jaccard_join.first_of_components(cleaned, width=5, percent=80).collect()}
    lines = [x for t in after.values() for x in t.split("\n")]
    assert set(after) == {0, 1, 2} and len(lines) == len(set(lines))


def test_shingles_are_those_of_the_jaccard_join(spark):
    texts = ["", " \n", "A b", "a B\tc d e", "a b c d e a b c d e É", "x " * 50]
    got = frame(spark, texts).select("doc_id", F.size(line_dedup.shingles(F.col("text"), 5)).alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in got} == {i: len(shingles(t, 5)) for i, t in enumerate(texts)}


# --- Neighbours -----------------------------------------------------------------------------


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 64))
    assert np.allclose(np.linalg.norm(neighbours.rotated(x, 3), axis=1), np.linalg.norm(x, axis=1))


def test_probes_are_in_order_of_nearness():
    turned = np.array([[0.1, -0.9, 0.4, 0.2]])
    assert neighbours.buckets(turned, 3).tolist() == [[3, 4, 6]] and neighbours.buckets(turned, 1).tolist() == [[3]]


def test_neighbours_recall_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1_500, 48)).astype(np.float32).astype(float)
    x[1_000:1_400] = x[0]  # a hot vector
    rows = [(i, [float(v) for v in row], 1) for i, row in enumerate(x)]
    rows += [(2_000, None, 1), (2_100, [0.0] * 48, 1), (2_200, [float("nan")] + [1.0] * 47, 1),
             (2_300, [None] + [1.0] * 47, 1), (2_400, [float("inf")] + [1.0] * 47, 1), (None, [1.0] * 48, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, bucket int")
    got = neighbours.nearest(df, F.col("vec_id") % 100 == 0).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert sorted(found) == list(range(0, 1_500, 100))
    hits = 0
    for q, mine in found.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        want = [i for i in np.lexsort((np.arange(len(x)), d)) if i != q][:10]
        hits += len(set(want) & {i for i, _ in mine})
        assert len(mine) == 10 and mine == sorted(mine, key=lambda t: (t[1], t[0]))
        assert all(abs(d[i] - s) < 1e-9 for i, s in mine)
    assert [i for i, _ in found[0]] == list(range(1_000, 1_010))
    assert hits / (10 * len(found)) >= 0.9
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    few = df.where("vec_id in (0, 3)")
    assert [(r["query_id"], r["vec_id"]) for r in neighbours.nearest(few, F.col("vec_id") == 0, probes=96).collect()] == [(0, 3)]


def test_neighbours_of_other_lengths_and_of_huge_components(spark):
    """Each length among its own; components whose squares overflow; repeated rows; columns named like those in between."""
    rng = np.random.default_rng(7)
    x = {i: rng.normal(size=8 if i % 2 else 5) for i in range(40)}
    x |= {i: rng.normal(size=3) * 1e200 for i in range(100, 104)}
    rows = [(i, [float(v) for v in row], 0, "b", 1.0, True) for i, row in x.items()]
    df = spark.createDataFrame(
        rows + rows[:5], "vec_id long, embedding array<double>, table int, bucket string, score double, asks boolean")
    found = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 10 < 2, k=4, probes=16).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert sorted(found) == [i for i in x if i % 10 < 2]
    for q, mine in found.items():
        d = {i: float(np.sqrt((((v - x[q]) / 1e150) ** 2).sum()) * 1e150) if q >= 100 else float(np.linalg.norm(v - x[q]))
             for i, v in x.items() if i != q and len(v) == len(x[q])}
        want = sorted(d.items(), key=lambda t: (t[1], t[0]))[:4]
        assert [i for i, _ in mine] == [i for i, _ in want]
        assert np.allclose([s for _, s in mine], [s for _, s in want], rtol=1e-9)


@pytest.mark.parametrize("n", [10, 25])
def test_neighbours_of_small_tables_are_whole(spark, n):
    """With the probes of the query itself."""
    x = np.random.default_rng(n).normal(size=(n, 64))
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, embedding array<double>")
    found = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 5 == 0).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    assert sorted(found) == list(range(0, n, 5))
    for q, mine in found.items():
        assert [rank for rank, _ in mine] == list(range(1, min(10, n - 1) + 1))
        if n <= 10:
            d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
            assert [i for _, i in mine] == [int(i) for i in np.argsort(d) if i != q]
