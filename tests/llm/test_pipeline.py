"""The stages one after the other, and the registry."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from degraus.llm import line_dedup, quality_rules
from degraus.session import stored

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, FOLDER), "stage")
        found.append(docs)
    return found


def test_stages_keep_the_columns_and_only_shrink(steps):
    for before, after in zip(steps[:-2], steps[1:-1]):
        assert after.columns == before.columns
        assert after.count() <= before.count()
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "n-gram Jaccard join", "PII", "best-fit packing"]


def test_no_line_repeats_after_line_dedup(steps):
    """Only whole copies may still repeat lines."""
    repeated = line_dedup.line_classes(steps[2]).where("not kept").groupBy("doc").sum("n_chars")
    sizes = {r["doc_id"]: r["n_chars"] for r in steps[2].collect()}
    assert all(2 * r["sum(n_chars)"] > 0.9 * sizes[r["doc"]] for r in repeated.collect())


def test_no_near_copies_after_the_join(steps):
    texts = [r["text"].lower().split() for r in steps[3].collect()]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in texts]
    assert not [
        1 for i in range(len(sets)) for j in range(i)
        if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]


def test_masks_and_packs_everything(steps):
    assert not steps[4].where("text rlike '[A-Za-z0-9]@[a-z0-9]+[.]'").count()
    assert {r["doc_id"] for r in steps[5].collect()} == {r["doc_id"] for r in steps[4].collect()}


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, FOLDER), "stage")
        assert docs.count() == 0


def test_columns_that_clash_with_those_in_between(spark):
    """Every stage gives the same documents whatever the other columns are called, and keeps them."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 60")
    names = ["n_words", "kept", "clean_text", "digest", "id", "key", "root", "quality_0", "a", "b", "doc", "line", "text_hash"]
    more = docs.select("*", *(F.lit(i).alias(n) for i, n in enumerate(names)))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        plain, odd = (stored(stage(spark, d, FOLDER), "stage") for d in (docs, more))
        assert odd.columns == more.columns
        assert sorted(map(tuple, odd.select(*docs.columns).collect())) == sorted(map(tuple, plain.collect()))
        assert {tuple(r) for r in odd.select(*names).collect()} == {tuple(range(len(names)))}
        docs, more = plain, odd
    packed = [corpus_pipeline.STAGES[-1][1](spark, d, FOLDER).select("doc_id").collect() for d in (docs, more)]
    assert sorted(packed[0]) == sorted(packed[1])


def test_quality_beside_columns_of_the_same_names(spark):
    docs = spark.createDataFrame([(1, "a word. " * 60, 5, False)], "doc_id long, text string, n_words int, kept boolean")
    row = quality_rules.with_quality(docs, "found").first()
    assert (row["n_words"], row["kept"], row["found"]["n_words"], row["found"]["base_failed"]) == (5, False, 120, True)
    with pytest.raises(ValueError):
        quality_rules.quality_rules(docs, "doc_id", "kept")
    with pytest.raises(ValueError):
        quality_rules.with_quality(docs, "kept")


def test_registered_queries():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {x.split("_")[0] for x in names if x.startswith("op")}
    assert "pipeline" in names


def test_quality_rules_equal_sql(spark):
    mine = entry.queries()["op1_quality_rules"](spark, FOLDER).toPandas()
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{FOLDER}/documents.parquet'")
    theirs = con.sql(entry.oracle_sql()["op1_quality_rules"]).df()
    order = sorted(mine.columns)
    assert order == sorted(theirs.columns)
    mine, theirs = (x[order].sort_values("doc_id").reset_index(drop=True) for x in (mine, theirs))
    assert mine.astype(str).equals(theirs.astype(str))
