"""Post tables, corpora, checkpoints and flat files."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumlens.session import has_table

POST = T.StructType(
    [
        T.StructField("post_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("post_date", T.DateType()),
        T.StructField("n_comments", T.IntegerType()),
        T.StructField("comments", T.ArrayType(T.StringType())),
        T.StructField("category", T.StringType()),
    ]
)

def read_posts(spark: SparkSession, path: str, tags: Sequence[str]) -> DataFrame:
    """Posts of the wanted tags; the tag is the partition column, so other tags are never read."""
    posts = spark.read.schema(POST).option("ignoreMissingFiles", "true").parquet(path)
    found = posts.where(F.col("category").isin(list(tags)))
    present = {r["category"] for r in found.select("category").distinct().collect()}
    for tag in tags:
        if tag not in present:
            warnings.warn(f"no posts stored for tag {tag!r}", stacklevel=2)
    if not present:
        raise ValueError("no posts found; load some first")
    return found.withColumn("tag", F.col("category"))


def write_posts(df: DataFrame, path: str) -> None:
    """One folder per category; only the categories present in ``df`` are replaced."""
    (
        df.select(*[f.name for f in POST.fields])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("category")
        .parquet(path)
    )


def write_corpus(df: DataFrame, path: str) -> None:
    """Text, metadata and vector of a post stay in one row, so nothing is aligned by position."""
    df.select("post_id", "tag", "text", "post_date", F.col("embedding").cast("array<float>")).write.mode(
        "overwrite"
    ).parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.csv(path, schema=schema, header=True, multiLine=True, escape='"')


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True, escape='"', quoteAll=True)


def read_entities(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, lines: bool = False
) -> DataFrame:
    """A JSON list of records per file, or one record per line (``lines``), which splits across tasks."""
    return spark.read.json(path, schema=schema, multiLine=not lines)


def read_pairs(spark: SparkSession, path: str, bound: int = 10_000) -> list[tuple[str, str]]:
    """Ordered (key, label) pairs of a JSON object, such as an emoticon dictionary, for expressions.

    The order of the file decides, since an earlier pair may be part of a later one. A file of more
    than ``bound`` pairs is refused: the pairs become part of the plan.
    """
    parsed = spark.read.text(path, wholetext=True).select(F.map_entries(F.from_json("value", "map<string,string>")).alias("e"))
    rows = parsed.select(F.explode("e").alias("e")).select("e.key", "e.value").limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"more than {bound} pairs in {path}")
    return [(r["key"], r["value"]) for r in rows]


def read_whole_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: (path, value)."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")


def checkpointed(spark: SparkSession, path: str, step: Callable[[], DataFrame], reuse: bool = True) -> DataFrame:
    """Read a stage table if it was written completely, else compute and write it."""
    if reuse and has_table(spark, path):
        return spark.read.parquet(path)
    step().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
