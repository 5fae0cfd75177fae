"""Line de-duplication across sites by distinct-site spread.

A HyperLogLog sketch of the sites is kept per line hash and merged by aggregation. Lines whose
estimate lies near the threshold get an exact distinct count; the others are decided by the sketch.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.llm.words import WORD
from forumlens.session import staged

MIN_SITES = 10
LG_K = 12
# Estimates within this share of the threshold are counted exactly: over ten standard errors of the sketch.
BAND = 0.2


def _hashes(line: Column) -> list[Column]:
    return [F.xxhash64(line).alias("h"), F.hash(line).alias("g")]


def _has_word(line: Column) -> Column:
    return line.rlike(WORD)


def line_sites(docs: DataFrame, key: str, text: str, site: str) -> DataFrame:
    """(k, s, site, h, g) for every distinct line with a word of every row; a null site is a site of its own."""
    lines = F.array_distinct(F.split(F.coalesce(F.col(text), F.lit("")), "\n"))
    rows = docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))).alias("k"),
        F.xxhash64(text).alias("s"),
        F.coalesce(F.concat(F.lit("="), F.col(site).cast("string")), F.lit("")).alias("site"),
        # The outer form keeps the optimizer from splitting every text again for a size filter.
        F.explode_outer(lines).alias("line"),
    )
    return rows.where(_has_word(F.col("line"))).select("k", "s", "site", *_hashes(F.col("line")))


def spread_lines(sites: DataFrame, min_sites: int = MIN_SITES, band: float = BAND, lg_k: int = LG_K) -> DataFrame:
    """(h, g, first) of the lines on at least ``min_sites`` sites, with the smallest key they occur under."""
    sketched = sites.groupBy("h", "g").agg(F.hll_sketch_agg("site", F.lit(lg_k)).alias("sketch"), F.min("k").alias("first"))
    guessed = sketched.select("h", "g", "first", F.hll_sketch_estimate("sketch").alias("guess"))
    guessed = staged(guessed.where(F.col("guess") >= min_sites * (1 - band)), "guessed")
    sure = guessed.where(F.col("guess") > min_sites * (1 + band)).select("h", "g", "first")
    near = guessed.where(F.col("guess") <= min_sites * (1 + band)).select("h", "g", "first")
    pairs = sites.join(near, ["h", "g"]).select("h", "g", "first", "site").distinct()
    exact = pairs.groupBy("h", "g", "first").agg(F.count("*").alias("n")).where(F.col("n") >= min_sites)
    return sure.unionByName(exact.select("h", "g", "first"))


def _among(h: Column, g: Column, gone_h: Column, gone_g: Column) -> Column:
    """Which lines are among those gone: one set per text, since built-in functions would search the list for every line."""

    @F.pandas_udf("array<boolean>")
    def found(h: pd.Series, g: pd.Series, gone_h: pd.Series, gone_g: pd.Series) -> pd.Series:
        out = []
        for lines_h, lines_g, a, b in zip(h, g, gone_h, gone_g):
            gone = set(zip(a, b)) if a is not None else set()
            out.append(None if a is None else [x in gone for x in zip(lines_h, lines_g)])
        return pd.Series(out, dtype=object)

    return found(h, g, gone_h, gone_g)


def drop_spread_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", site: str = "source",
    min_sites: int = MIN_SITES, band: float = BAND, lg_k: int = LG_K,
) -> DataFrame:
    """Remove lines that occur on at least ``min_sites`` distinct sites from all rows but those of the smallest key.

    All input columns come back, with ``kept_text``, ``n_lines`` and ``n_removed`` added under names
    that replace any columns called so. Lines are split at line feeds and compared whole; a line
    without a word is never removed. A null text counts as one empty line and its kept text is "";
    a null site is a site of its own; a null key counts as the smallest. Rows that share a key share
    its decisions, so repeated rows stay alike. The first occurrence stays, so no line is lost to
    the corpus, however many copies of a document there are. An empty table gives no rows.
    """
    sites = staged(line_sites(docs, key, text, site), "lines")
    spread = staged(spread_lines(sites, min_sites, band, lg_k), "spread")
    hits = sites.join(spread, ["h", "g"]).where("k > first").select("k", "s", "h", "g").distinct()
    # By key and text, so that rows of one key do not meet the lines of each other.
    per_row = hits.groupBy("k", "s").agg(F.collect_list(F.struct("h", "g")).alias("gone"))
    kept_columns = [c for c in docs.columns if c not in ("kept_text", "n_lines", "n_removed")]
    # The input row travels as one value, so its column names cannot clash with those used here.
    row = F.col("row")
    own = F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))).alias("k")
    rows = docs.select(own, F.xxhash64(text).alias("s"), F.struct(*[F.col(c) for c in kept_columns]).alias("row"), F.col(text).alias("t"))
    met = rows.join(per_row, ["k", "s"], "left").select(
        "row", "gone", F.split(F.coalesce("t", F.lit("")), "\n").alias("lines")
    )
    hashes = [F.when(F.col("gone").isNotNull(), F.transform("lines", part)) for part in (lambda x: F.xxhash64(x), lambda x: F.hash(x))]
    met = met.withColumn("hit", _among(*hashes, F.col("gone.h"), F.col("gone.g")))
    keep = F.filter(F.col("lines"), lambda x, i: ~(_has_word(x) & F.get("hit", i)))
    left = met.withColumn("kept", F.when(F.col("gone").isNull(), F.col("lines")).otherwise(keep))
    return left.select(
        *[row.getField(c).alias(c) for c in kept_columns],
        F.concat_ws("\n", "kept").alias("kept_text"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_removed"),
    )
