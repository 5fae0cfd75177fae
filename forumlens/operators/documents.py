"""Document-level text jobs: lemmas, name removal, case splitting, chunking."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.functions import text as tx
from forumlens.operators.rows import exploded, pos_exploded
from forumlens.operators.sizing import broadcast_if_small

# A dictionary of this many short rows is a few megabytes.
DICTIONARY_ROWS = 200_000


def lemmatise(df: DataFrame, key: str, tokens: str, lemmas: DataFrame) -> DataFrame:
    """Replace tokens by their lemma from a (token, lemma) table; unlisted tokens stay.

    Distinct tokens meet the dictionary in an inner join, so only listed ones travel, and come back
    as one short map per document; the tokens themselves stay where they are. A dictionary within
    the size bound is broadcast, a larger one joins by shuffle. Of several lemmas the smallest holds.
    """
    known = lemmas.where("token is not null and lemma is not null").groupBy("token").agg(F.min("lemma").alias("lemma"))
    spread = exploded(df, [key], F.array_distinct(tokens), "token")
    listed = spread.join(broadcast_if_small(known, DICTIONARY_ROWS), "token").select(key, "token", "lemma")
    maps = listed.groupBy(key).agg(F.map_from_entries(F.collect_set(F.struct("token", "lemma"))).alias("_map"))
    replaced = F.transform(tokens, lambda t: F.coalesce(F.try_element_at("_map", t), t))
    empty = F.array().cast("array<string>")
    return df.join(maps, key, "left").withColumn(tokens, F.coalesce(replaced, empty)).drop("_map")


def author_names(posts: DataFrame, order: str, category: str = "category", author: str = "author") -> DataFrame:
    """Lower-case names per category with the position of their first post as precedence."""
    name = F.array_join(tx.words(F.lower(F.col(author))), " ")
    return (
        posts.select(F.col(category).alias("category"), name.alias("name"), F.col(order).alias("_o"))
        .where(F.col("name") != "")
        .groupBy("category", "name")
        .agg(F.min("_o").alias("precedence"))
    )


def _gram_of(tokens: str, n: int) -> Callable[[Column], Column]:
    def gram(i: Column) -> Column:
        joined = F.array_join(F.slice(tokens, i + 1, n), " ")
        return F.struct(i.alias("pos"), F.lit(n).alias("n"), joined.alias("gram"))

    return gram


def covered_spans(df: DataFrame, key: str, names: DataFrame) -> DataFrame:
    """Per document, the leftmost non-overlapping name spans (pos, n), earliest-listed name first.

    Only n-gram lengths that occur among the names are built, and the n-grams meet the names in
    an equi-join on (category, gram): no alternation pattern, no pairing of names with documents.
    """
    sized = names.select("category", F.col("name").alias("gram"), "precedence", F.size(F.split("name", " ")).alias("n"))
    listed = broadcast_if_small(sized, DICTIONARY_ROWS)
    lengths = sorted(r["n"] for r in listed.select("n").distinct().collect())
    schema = "array<struct<pos:int,n:int,gram:string>>"
    grams = F.array().cast(schema)
    for n in lengths:
        last = F.size("tokens") - n
        at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        grams = F.concat(grams, F.transform(at, _gram_of("tokens", n)).cast(schema))
    hits = (
        exploded(df, [key, "category"], grams, "g")
        .select(key, "category", "g.*")
        .join(listed.drop("n"), ["category", "gram"])
        .groupBy(key)
        .agg(F.sort_array(F.collect_list(F.struct("pos", "precedence", "n"))).alias("hits"))
    )
    if lengths == [1]:
        # One-word names cannot overlap, and a position matches one name at most.
        return hits.select(key, F.transform("hits", lambda h: F.struct(h["pos"].alias("pos"), h["n"].alias("n"))).alias("spans"))
    start = F.struct(F.lit(0).alias("next"), F.array().cast("array<struct<pos:int,n:int>>").alias("kept"))

    def take(acc: Column, h: Column) -> Column:
        taken = F.struct(
            (h["pos"] + h["n"]).alias("next"),
            F.concat(acc["kept"], F.array(F.struct(h["pos"].alias("pos"), h["n"].alias("n")))).alias("kept"),
        )
        return F.when(h["pos"] >= acc["next"], taken).otherwise(acc)

    return hits.select(key, F.aggregate("hits", start, take)["kept"].alias("spans"))


def _between_spans(words: str, spans: str, filler: Callable[[Column], Column] | None = None) -> Column:
    """The words outside the sorted spans, each span replaced by ``filler``; linear in the text."""

    def part(k: Column) -> Column:
        here, before = F.get(spans, k), F.get(spans, k - 1)
        start = F.coalesce(before["pos"] + before["n"], F.lit(0))
        gap = F.slice(words, start + 1, F.coalesce(here["pos"], F.size(words)) - start)
        if filler is None:
            return gap
        return F.when(here.isNull(), gap).otherwise(F.concat(gap, F.array(filler(here))))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(spans)), part))


def remove_names(df: DataFrame, key: str, text: str, names: DataFrame) -> DataFrame:
    """Delete author names of the same category as whole words or phrases."""
    docs = df.withColumn("tokens", tx.words(F.col(text)))
    spans = covered_spans(docs, key, names)
    left = F.when(F.col("spans").isNull(), F.col("tokens")).otherwise(_between_spans("tokens", "spans"))
    return docs.join(spans, key, "left").withColumn(text, F.array_join(left, " ")).drop("tokens", "spans")


def mask_people(df: DataFrame, key: str, text: str, names: DataFrame, mask: str = "[PATIENT]") -> DataFrame:
    """Listed names become the mask (null text becomes ''), then shaped identifiers do.

    ``names`` carries (category, name, precedence); trailing punctuation does not hide a name.
    """
    docs = df.withColumn("_words", tx.words(F.coalesce(F.col(text), F.lit(""))))
    bare = F.transform("_words", lambda w: F.regexp_replace(F.lower(w), r"(?U)^\W+|\W+$", ""))
    docs = docs.withColumn("tokens", bare)
    spans = covered_spans(docs, key, names)

    def masked(span: Column) -> Column:
        last = F.get("_words", span["pos"] + span["n"] - 1)
        return F.concat(F.lit(mask), F.regexp_extract(last, r"(?U)(\W*)$", 1))

    replaced = F.when(F.col("spans").isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(
        F.array_join(_between_spans("_words", "spans", masked), " ")
    )
    out = docs.join(spans, key, "left").withColumn(text, tx.mask_identifiers(replaced, mask))
    return out.drop("_words", "tokens", "spans")


def preprocess(
    df: DataFrame,
    key: str,
    text: str,
    to: str,
    *,
    regex: bool = False,
    lower: bool = False,
    stop: Sequence[str] = (),
    lemmas: DataFrame | None = None,
    as_tokens: bool = False,
) -> DataFrame:
    """Clean, lower, drop stop words and lemmatise, in that order; text or tokens out."""
    value = F.col(text)
    if regex:
        value = tx.heavy_clean(value)
    if lower:
        value = F.lower(value)
    if not (as_tokens or stop or lemmas is not None):
        return df.withColumn(to, value)
    out = df.withColumn(to, tx.remove_stop_words(tx.tokenize(value), stop))
    if lemmas is not None:
        out = lemmatise(out, key, to, lemmas)
    return out if as_tokens else out.withColumn(to, F.array_join(to, " "))


def topic_documents(df: DataFrame, key: str, text: str, stop: Sequence[str], lemmas: DataFrame) -> DataFrame:
    """Light and lemmatised variants side by side; rows with either one empty are dropped.

    The lemmatised text is made from the light one, so the patterns run once, and it is empty
    whenever the light one is, so one filter (which stays above the join) covers both.
    """
    base = df.where(F.col(text).isNotNull() & (tx.strip(F.col(text)) != ""))
    light = preprocess(base, key, text, "text_light", regex=True, lower=True)
    both = preprocess(light, key, "text_light", "text_lemma", stop=stop, lemmas=lemmas)
    return both.where(F.col("text_lemma") != "")


# Layout of the case collection.
CASE_START = r"CASE \d+\.\d+"
READING_LIST = r"Suggested Reading"
DEGREE = r"\b(Ph\.?D\.?|M\.?D\.?|M\.?A\.?|D\.?O\.?)\b"


def split_cases(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row per numbered case: title, description, discussion and diagnosis."""
    body = F.regexp_replace(F.col(text), rf"(?is){READING_LIST}.*?(?={CASE_START}|\z)", "")
    parts = F.filter(F.split(body, rf"(?={CASE_START})"), lambda p: p.rlike(rf"^{CASE_START}"))
    cases = pos_exploded(df, [key], parts, "case_no", "part")
    content = tx.strip(F.regexp_replace("part", rf"^{CASE_START}", ""))
    cases = cases.select(key, "case_no", F.split(content, "\n").alias("lines"))
    is_text = F.transform(
        "lines", lambda x, i: (i >= 1) & (tx.strip(x) != "") & ~tx.strip(x).rlike(DEGREE)
    )
    start = F.array_position(is_text, F.lit(True)).cast("int")
    rest = F.when(start > 0, F.array_join(F.slice("lines", start, F.size("lines")), "\n")).otherwise("")
    cases = cases.select(key, "case_no", tx.strip(F.element_at("lines", 1)).alias("case"), rest.alias("rest"))
    by_discussion = F.split("rest", r"Discussion\s*\n", 2)
    after = tx.strip(F.coalesce(F.get(by_discussion, 1), F.lit("")))
    cases = cases.select(
        key, "case_no", "case", tx.strip(F.get(by_discussion, 0)).alias("description"), after.alias("after")
    )
    by_diagnosis = F.split("after", r"Diagnos[ei]s?\s*\n", 2)
    listed = tx.strip(F.coalesce(F.get(by_diagnosis, 1), F.lit("")))
    listed = F.regexp_replace(listed, r"-\s*\n\s*", "")
    listed = F.regexp_replace(listed, r"(?<!•)\n(?!•)", " ")
    bullets = F.filter(F.transform(F.split(listed, "\n"), tx.strip), lambda x: x.startswith("•"))
    return cases.select(
        key,
        "case_no",
        "case",
        tx.flatten_lines(F.col("description")).alias("description"),
        tx.flatten_lines(tx.strip(F.get(by_diagnosis, 0))).alias("discussion"),
        tx.flatten_lines(F.array_join(bullets, " ")).alias("diagnosis"),
    )


def chunk_words(df: DataFrame, key: str, text: str, size: int = 200, overlap: int = 40) -> DataFrame:
    """Word windows; the last one is the first that reaches the end of the text."""
    step = size - overlap
    last = F.ceil(F.greatest(F.size("_w") - size, F.lit(0)) / step).cast("int")
    starts = F.when(F.size("_w") > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    chunks = F.transform(starts, lambda i: F.array_join(F.slice("_w", i * step + 1, size), " "))
    cut = df.withColumn("_w", tx.words(F.col(text)))
    return pos_exploded(cut, [c for c in df.columns if c != text], chunks, "chunk_no", "content")


# Text cut up at a time.
BYTES_AT_ONCE = 1 << 20
SEPARATORS = ("\n\n", "\n", ". ", " ", "")


def _pieces(text: str, size: int, separators: Sequence[str]) -> list[str]:
    """Cut at the coarsest separator present, finer ones only inside parts that stay too long."""
    usable = [s for s in separators if s == "" or s in text]
    if len(text) <= size or not usable:
        return [text]
    sep, finer = usable[0], usable[1:]
    if sep == "":
        return list(text)
    head, *tail = text.split(sep)
    parts = ([head] if head else []) + [sep + t for t in tail]
    return [p for part in parts for p in (_pieces(part, size, finer) if len(part) > size else [part])]


def char_chunks(text: str, size: int, overlap: int, separators: Sequence[str] = SEPARATORS) -> list[str]:
    """Greedy chunks of whole pieces, each starting with up to ``overlap`` characters of the last."""
    chunks: list[str] = []
    held: list[str] = []
    total = 0
    for piece in _pieces(text, size, separators):
        if held and total + len(piece) > size:
            chunks.append("".join(held).strip())
            while held and (total > overlap or total + len(piece) > size):
                total -= len(held.pop(0))
        held.append(piece)
        total += len(piece)
    chunks.append("".join(held).strip())
    return [c for c in chunks if c]


def chunk_chars(df: DataFrame, key: str, text: str, size: int = 1000, overlap: int = 200) -> DataFrame:
    """Overlapping character chunks that prefer paragraph, line and sentence borders.

    Recursion per text is not expressible as a column, so this is one Arrow-batched map; it is
    narrow, and chunk ids are (document, chunk number) rather than a global counter. A batch is
    cut up, and its chunks handed on, some ``BYTES_AT_ONCE`` at a time.
    """
    kept = [f for f in df.schema.fields if f.name != text]
    names = [f.name for f in kept]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", chunk_no int, content string"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(names))
            filled = pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64).cumsum()
            borders = [0, *(np.flatnonzero(np.diff(filled // BYTES_AT_ONCE)) + 1).tolist(), batch.num_rows]
            for low, high in zip(borders[:-1], borders[1:]):
                lists = [char_chunks(t, size, overlap) if t else [] for t in texts.slice(low, high - low).to_pylist()]
                owner = pa.array(np.repeat(np.arange(low, high), [len(c) for c in lists]))
                number = pa.array([i for c in lists for i in range(len(c))], pa.int32())
                content = pa.array([c for chunks in lists for c in chunks], pa.string())
                columns = [*[batch.column(i).take(owner) for i in range(len(names))], number, content]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "chunk_no", "content"])

    return df.select(*names, text).mapInArrow(cut, schema)
