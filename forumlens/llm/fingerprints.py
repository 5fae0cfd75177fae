"""Document fingerprints: bottom-k sketches of shingle hashes, in DataFrame operations only.

A sketch keeps the k smallest of a text's distinct 64-bit shingle hashes. Two sketches of disjoint
or overlapping parts merge into the sketch of the whole, and a pair of sketches estimates
resemblance, containment and the number of distinct shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumlens.functions.vectors import let
from forumlens.llm.words import word_array
from forumlens.session import staged

K = 128
SHINGLE = 5
DIGITS = 16


def shingle_hashes(words: Column, size: int = SHINGLE) -> Column:
    """Distinct hashes of all runs of ``size`` words, ascending; a shorter text is one shingle, no word none.

    ``words`` must be a plain column: it is read once per array element.
    """
    n = F.size(words)

    def at(i: Column) -> Column:
        return F.xxhash64(*[F.get(words, i + j) for j in range(size)])

    runs = F.transform(F.sequence(F.lit(0), n - size), at)
    hashes = F.when(n >= size, runs).when(n > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<bigint>"))
    return hashes


def bottom(hashes: Column, k: int = K) -> Column:
    """The k smallest distinct hashes, ascending."""
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two sketched parts."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity: share of the union's k smallest hashes found in both; 1 for two empty sketches.

    Exact while the union holds at most k hashes.
    """

    def share(union: Column) -> Column:
        both = F.size(F.array_intersect(F.array_intersect(union, a), b))
        return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))

    return let(merged(a, b, k), share)


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k hashes, else (k - 1) / share of the hash range used."""
    used = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / used)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has too; 1 for an empty a."""
    size_a, size_b = distinct_count(a, k), distinct_count(b, k)
    union = distinct_count(merged(a, b, k), k)
    shared = F.greatest(F.lit(0.0), F.least(size_a, size_b, size_a + size_b - union))
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(shared / size_a)


def to_text(a: Column) -> Column:
    """Fixed-width hexadecimal digits of the hashes, in order."""
    return F.concat_ws("", F.transform(a, lambda h: F.lpad(F.hex(h), DIGITS, "0")))


def merge_groups(sketches: DataFrame, keys: list[str], sketch: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per group. A group may hold a third of all rows: distinct hashes are combined before
    the shuffle, ranked first inside a slice of the group by hash, and only k per slice meet."""
    one = sketches.select(*keys, F.explode(sketch).alias("_h")).distinct()
    sliced = one.withColumn("_slice", F.pmod(F.xxhash64("_h"), F.lit(64)))
    inner = Window.partitionBy(*keys, "_slice").orderBy("_h")
    few = sliced.withColumn("_r", F.row_number().over(inner)).where(F.col("_r") <= k)
    return few.groupBy(*keys).agg(F.slice(F.sort_array(F.collect_list("_h")), 1, k).alias(sketch))


def next_keys(keys: DataFrame) -> DataFrame:
    """(key, next key) over distinct keys in ascending order, the last followed by the first.

    Keys are ranged, each range is sorted alone, and the first key of every range answers for the
    last of the range before.
    """
    ranged = keys.distinct().repartitionByRange("k").withColumn("r", F.spark_partition_id())
    ranged = staged(ranged, "ranges")
    heads = ranged.groupBy("r").agg(F.min("k").alias("head"))
    ring = Window.orderBy("r")
    everyone = Window.partitionBy()
    heads = heads.select("r", F.coalesce(F.lead("head").over(ring), F.min("head").over(everyone)).alias("after"))
    inside = ranged.withColumn("n", F.lead("k").over(Window.partitionBy("r").orderBy("k")))
    return inside.join(heads, "r").select("k", F.coalesce("n", "after").alias("n"))


def edited_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K, size: int = SHINGLE) -> DataFrame:
    """Fingerprint of every text, of its edited form, and their likeness to each other and to the next text.

    The edited form replaces the last floor(n/2) code points by the first as many (or all) of the
    next document's, in ascending order of the key, the last followed by the first. Columns: key,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, and the number
    of distinct shingles and the containment of the text in its edited form.

    A null text counts as empty; an empty or blank text has an empty fingerprint, and two empty ones
    are alike (1.0). Rows that share a key are all kept; they follow and precede as one document
    whose text is the smallest of theirs. A null key sorts before all others. Other columns are not
    read. An empty table gives no rows.
    """
    lowest = F.lit(-(2**63)).cast("long")
    rows = docs.select(F.coalesce(F.col(key).cast("long"), lowest).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    # What the document before asks for: the longest replacement among rows of its key.
    asked = rows.select("k", F.floor(F.length("t") / 2).alias("half")).groupBy("k").agg(F.max("half").alias("half"))
    asked = staged(asked, "asked")
    after = next_keys(asked.select("k"))
    asked = after.join(asked, "k").select(F.col("n").alias("k"), F.col("k").alias("to"), "half")

    def sketched(df: DataFrame, source: str, name: str) -> DataFrame:
        held = df.withColumn("w", word_array(F.col(source)))
        kept = [c for c in df.columns if c != name]
        held = held.select(*kept, shingle_hashes(F.col("w"), size).alias("h"))
        return held.select(*kept, bottom(F.col("h"), k).alias(name))

    # Texts are shuffled by key once and read for both joins; sketches are made after it, so that
    # only the heads sent to the document before carry one.
    heads = sketched(rows.join(asked, "k"), "t", "s")
    sent = heads.select("to", F.struct(F.substring("t", F.lit(1), F.col("half")).alias("head"), "s").alias("next"))
    sent = sent.groupBy(F.col("to").alias("k")).agg(F.min("next").alias("next"))
    length = F.length("t")
    half = F.floor(length / 2)
    edited = F.concat(F.substring("t", F.lit(1), length - half), F.substring("next.head", F.lit(1), half))
    met = rows.join(sent, "k").select("k", "t", length.cast("long").alias("n_chars"), F.col("next.s").alias("after"), edited.alias("e"))
    made = sketched(met, "t", "s")
    made = sketched(made.withColumn("edited_sha256", F.sha2(F.encode("e", "UTF-8"), 256)), "e", "es")
    made = made.withColumn("key", F.when(F.col("k") != lowest, F.col("k")))
    return made.select(
        F.col("key").alias(key),
        "n_chars",
        "edited_sha256",
        to_text(F.col("s")).alias("fingerprint"),
        to_text(F.col("es")).alias("edited_fingerprint"),
        resemblance(F.col("s"), F.col("es"), k).alias("near_edited"),
        resemblance(F.col("s"), F.col("after"), k).alias("near_next"),
        distinct_count(F.col("s"), k).alias("n_distinct"),
        containment(F.col("s"), F.col("es"), k).alias("kept_in_edited"),
    )
