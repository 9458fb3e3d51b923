"""The queries of this subpackage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, jaccard, licenses, mixing, neighbours, packing, periods, pii, repeats, secrets, topk, toxicity, whitening
from tidemark.llm.common import QUERIES, REFERENCE_SQL, query, table

__all__ = ["QUERIES", "REFERENCE_SQL"]


def tokenizer_path() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


@query("op1_neighbours")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return neighbours.search(vectors, neighbours.every_twentieth(vectors))


@query("op2_toxicity")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    offsets = F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))
    return toxicity.spans(docs, model).select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        F.concat_ws(",", offsets).alias("spans"),
    )


@query("op3_pii")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digest(table(spark, folder, "documents"))


@query("op4_repeats")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.digest(table(spark, folder, "documents"))


@query("op5_jaccard")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.classes(table(spark, folder, "documents"))


@query("op6_topk")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return topk.search(vectors, neighbours.every_twentieth(vectors))


@query("op7_bpe")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digest(table(spark, folder, "documents"), tokenizer_path())


@query("op8_secrets")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digest(table(spark, folder, "documents"))


@query("op9_licenses")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.report(table(spark, folder, "documents"))


@query("op10_packing")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer_path())


@query("op11_periods")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return periods.digest(table(spark, folder, "documents"), periods.repeated_tail)


@query("op12_whitening")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.report(table(spark, folder, "embeddings"))


@query("op13_mixing", mixing.REFERENCE)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))
