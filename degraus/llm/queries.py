"""One query per operator, each over its whole table with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from degraus.llm import (
    chosen_path,
    collocations,
    filter_audit,
    jaccard_join,
    language,
    line_dedup,
    neighbours,
    packing,
    personal_data,
    quality_rules,
    sentence_pieces,
    shards,
    token_counts,
)
from degraus.llm.common import read
from degraus.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]
BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def with_workers(fn: Query) -> Query:
    """Let Python workers import this package from where the driver has it; on a cluster it is installed or shipped."""

    def run(spark: SparkSession, *args) -> DataFrame:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        path = spark.sparkContext.environment.get("PYTHONPATH", "")
        if root not in path.split(os.pathsep):
            spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, path]))
        return fn(spark, *args)

    return run


def op1_quality_rules(spark, sf):
    return quality_rules.quality_rules(read(spark, sf, "documents"), "doc_id").drop("clean_text")


def op2_token_counts(spark, sf):
    """The cache is new for every call, so the query's work does not depend on earlier runs."""
    cache = scratch_dir(spark, "token-cache")
    return token_counts.token_counts(
        read(spark, sf, "documents"), "doc_id", tokenizer_file=BPE, cache=cache
    ).drop("digest")


def op3_shards(spark, sf):
    return shards.shard_by_bytes(read(spark, sf, "documents"))


def op4_packing(spark, sf):
    sized = packing.with_token_counts(read(spark, sf, "documents"), BPE)
    return packing.pack(sized).withColumnRenamed("id", "doc_id")


def op5_personal_data(spark, sf):
    return personal_data.personal_data(read(spark, sf, "documents"))


def op6_neighbours(spark, sf):
    return neighbours.nearest(read(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_language(spark, sf):
    return language.identify(read(spark, sf, "documents"))


def op8_line_dedup(spark, sf):
    return line_dedup.line_classes(read(spark, sf, "documents"), least_chars=line_dedup.NEAR_CHARS).select(
        F.col("doc").alias("doc_id"), "line_no", "n_chars",
        F.col("first_doc").alias("class_doc_id"), F.col("first_line").alias("class_line_no"), "kept",
    )


def op9_jaccard_join(spark, sf):
    return jaccard_join.jaccard_components(read(spark, sf, "documents"))


def op10_sentence_pieces(spark, sf):
    return sentence_pieces.round_trip(read(spark, sf, "documents"), PIECES)


def op11_collocations(spark, sf):
    return collocations.collocations(read(spark, sf, "documents"))


def op12_filter_audit(spark, sf):
    return filter_audit.filter_audit(read(spark, sf, "documents"), read(spark, sf, "labels"))


def op13_chosen_path(spark, sf):
    return chosen_path.near_duplicates(read(spark, sf, "documents"))


REGISTRY: dict[str, Query] = {
    fn.__name__: with_workers(fn)
    for fn in (
        op1_quality_rules, op2_token_counts, op3_shards, op4_packing, op5_personal_data, op6_neighbours, op7_language,
        op8_line_dedup, op9_jaccard_join, op10_sentence_pieces, op11_collocations, op12_filter_audit, op13_chosen_path,
    )
}
