"""The training-data pipeline: five stages over ``documents``.

Each stage takes what its predecessor returned and decides on all of it.  All but the last return the columns they got;
``doc_id`` and ``text`` are needed, ``n_chars`` is kept true to the text where it exists, every other column passes through.
Null and empty texts stay, unless a later document of the same kind makes them copies: they are never copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import jaccard, packing, pii, repeats, toxicity
from tidemark.llm.common import importable, table
from tidemark.llm.queries import tokenizer_path
from tidemark.staging import stage


def _with_text(docs: DataFrame, text: Column) -> DataFrame:
    """Replace the text, and its length where the documents have it."""
    columns = docs.columns
    out = docs.withColumn("text", text)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[f"`{c}`" for c in columns])


def _ordered(kind: T.DataType) -> bool:
    return isinstance(kind, (T.NumericType, T.StringType, T.BinaryType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold; the model learns from the labelled rows at hand."""
    importable(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.score_column(model) < toxicity.THRESHOLD)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that with the smallest id, null ids last; texts without words all stay.

    Rows are told apart by id and text, so an id may repeat or be null; of rows equal in both one stays, the least by the
    columns that have an order.
    """
    importable(spark)
    rows = docs.withColumn("__key", jaccard.row_key())
    gone = stage(jaccard.surplus(docs), "gone")
    # Only texts whose key falls into a cell of a copy's key are shuffled.
    near, far = repeats.only_of(rows, gone.select(F.col("key").alias("__gone")), "__key", "__cell")
    out = near.join(gone, near["__key"] == gone["key"], "left_anti").unionByName(far)
    again = gone.where("again").select("key")
    if not again.isEmpty():
        same, _ = repeats.only_of(rows, again, "__key", "__cell")
        order = [F.col(f"`{f.name}`") for f in docs.schema if f.name not in ("doc_id", "text") and _ordered(f.dataType)]
        place = F.row_number().over(Window.partitionBy("__key").orderBy(*(order or [F.lit(1)])))
        first = same.withColumn("__place", place).where("__place = 1").drop("__place")
        out = out.unionByName(first.join(again, first["__key"] == again["key"], "left_semi"))
    return out.drop("__key")


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings that occur elsewhere too."""
    importable(spark)
    found = repeats.with_removals(docs)
    return _with_text(found, repeats.kept_text(F.col("text"), F.col(repeats.REMOVED))).drop(repeats.REMOVED)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by the name of its kind."""
    importable(spark)
    return _with_text(docs, pii.masked_text(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in training sequences."""
    importable(spark)
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("repeats", drop_repeats),
    ("personal_data", mask_personal_data),
    ("packing", pack),
]

# The stages learn, cluster and pack: beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
