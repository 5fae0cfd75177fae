"""From raw documents to encoded training text: quality, lines, near-duplicates, mixture, pieces.

Each stage works on all rows its predecessor kept, reads the columns of documents and returns just
those. Null texts are empty and fall to the base rules; null ids, null sources, ties, repeated rows,
very long texts and empty tables pass through as each operator states. ``run`` applies them in order, written and read
again between stages, so a lost executor costs at most one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.llm.line_labels import keep_good, train_field
from forumlens.llm.line_spread import drop_spread_lines
from forumlens.llm.mixture import mix_sources
from forumlens.llm.near_duplicates import near_duplicates
from forumlens.llm.pieces import encode_texts
from forumlens.llm.words import WORD
from forumlens.session import staged


COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _with_text(docs: DataFrame, text) -> DataFrame:
    return docs.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the base rules and the line labels keep, unchanged; trained on the labelled documents of ``sf_dir``, if any."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    known = docs if labels.isEmpty() else spark.read.parquet(f"{sf_dir}/documents.parquet")
    return keep_good(docs.select(*COLUMNS), train_field(known, labels))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines spread over many sources; rows whose every word went are copies and go too."""
    cut = drop_spread_lines(docs.select(*COLUMNS))
    left = cut.where((F.col("n_removed") == 0) | F.col("kept_text").rlike(WORD))
    text = F.when(F.col("n_removed") == 0, F.col("text")).otherwise(F.col("kept_text"))
    return _with_text(left, text).select(*COLUMNS)


def near_duplicate_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five words a shingle, similarity of at least 0.8."""
    docs = docs.select(*COLUMNS)
    kept = near_duplicates(docs).where("first").select(F.col("doc_id").alias("_kept"), F.col("text_sum").alias("_of")).distinct()
    summed = docs.withColumn("_sum", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("_kept")) & (F.col("_sum") == F.col("_of"))
    # Rows repeated under one id are one document.
    return summed.join(kept, same, "left_semi").dropDuplicates(["doc_id", "_sum"]).drop("_sum")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as far, as the mix of sources takes their words."""
    mixed = mix_sources(docs.select(*COLUMNS)).documents()
    return _with_text(mixed, F.col("text")).select(*COLUMNS)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text, one row per document of the mix."""
    return encode_texts(docs).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_dedup", near_duplicate_groups),
    ("mixture", mixture),
    ("pieces", pieces),
]

# A trained model, sketches and keyed permutations have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
