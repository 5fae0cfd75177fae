"""Filter interaction audit: what each filter removes in every order, from one pass over the bytes.

A table gives every byte its class, and a second table the output of a transducer for (state, class):
a word begins, a word ends, a capital, a symbol, a code point. The state after a byte is told by its class
alone, so the tables run over a whole chunk at once. Word spans go into an open-addressing hash
table, where spans that meet are compared byte for byte before they count as equal. Documents
then shrink to counts per part and set of failed filters, from which all orders follow.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumlens.llm.words import byte_slices, mixed

CHUNK_BYTES = 4 << 20
# Spans over so many bytes are hashed and compared whole, shorter ones eight bytes at a time, all at once.
LONG = 256
FILTERS = "ABCDE"
MIN_WORDS = 200
SYMBOLS = b"#$%&*|"

# Classes of bytes; a trail byte continues a character of UTF-8.
BLANK, PLAIN, CAPITAL, SYMBOL, TRAIL = range(5)
CLASS = np.full(256, PLAIN, np.uint8)
CLASS[[0x20, *range(0x09, 0x0E)]] = BLANK
CLASS[ord("A") : ord("Z") + 1] = CAPITAL
CLASS[list(SYMBOLS)] = SYMBOL
CLASS[0x80:0xC0] = TRAIL

# States: outside and inside a word. Outputs are flags.
OUTSIDE, INSIDE = 0, 1
BEGINS, ENDS, IS_CAPITAL, IS_SYMBOL, IS_CHARACTER = 1, 2, 4, 8, 16
NEXT = np.array([OUTSIDE, INSIDE, INSIDE, INSIDE, INSIDE], np.uint8)
OUTPUT = np.zeros((2, 5), np.uint8)
OUTPUT[:, CAPITAL] |= IS_CAPITAL
OUTPUT[:, SYMBOL] |= IS_SYMBOL
OUTPUT[:, :TRAIL] |= IS_CHARACTER
OUTPUT[OUTSIDE, PLAIN:] |= BEGINS
OUTPUT[INSIDE, BLANK] |= ENDS


def transduce(raw: np.ndarray) -> np.ndarray:
    """Output flags of every byte; the run starts outside a word."""
    read = CLASS[raw]
    state = np.empty(len(read), np.uint8)
    state[:1] = OUTSIDE
    state[1:] = NEXT[read[:-1]]
    return OUTPUT.ravel()[state * np.uint8(5) + read]


def _eights(raw: np.ndarray) -> np.ndarray:
    """The eight bytes at every place as one number; zeros follow the text."""
    padded = np.r_[raw, np.zeros(8, np.uint8)]
    return np.ndarray((len(raw) + 1,), "<u8", padded, strides=(1,))


def _part(eights: np.ndarray, start: np.ndarray, size: np.ndarray, ahead: int) -> np.ndarray:
    """Bytes [ahead, ahead + 8) of every span as a number, without those past its end."""
    left = np.minimum(size - ahead, 8)
    return eights[start + ahead] << ((8 - left) * 8).astype(np.uint64)


def span_hashes(raw: np.ndarray, eights: np.ndarray, start: np.ndarray, size: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Hash of the bytes of every span and its group."""
    out = mixed(_part(eights, start, size, 0) + (size.astype(np.uint64) << np.uint64(56)) + mixed(group.astype(np.uint64)))
    at, ahead = np.flatnonzero((size > 8) & (size <= LONG)), 8
    while len(at):
        out[at] = mixed(out[at] * np.uint64(0xD1342543DE82EF95) + _part(eights, start[at], size[at], ahead))
        ahead += 8
        at = at[size[at] > ahead]
    for i in np.flatnonzero(size > LONG):
        out[i] = np.uint64(xxhash.xxh3_64_intdigest(raw[start[i] : start[i] + size[i]])) ^ out[i]
    return out


def _equal(raw: np.ndarray, eights: np.ndarray, size: np.ndarray, start: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether spans a and b hold the same bytes."""
    same = size[a] == size[b]
    for i in np.flatnonzero(same & (size[a] > LONG)):
        x, y, n = start[a[i]], start[b[i]], size[a[i]]
        same[i] = np.array_equal(raw[x : x + n], raw[y : y + n])
    at, ahead = np.flatnonzero(same & (size[a] <= LONG)), 0
    while len(at):
        x, y = a[at], b[at]
        same[at] = _part(eights, start[x], size[x], ahead) == _part(eights, start[y], size[y], ahead)
        ahead += 8
        at = at[same[at] & (size[x] > ahead)]
    return same


def distinct_spans(raw: np.ndarray, start: np.ndarray, size: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Which spans are the first of their bytes in their group, found by a verified hash table.

    The table has open addressing and a load of at most one half. All spans try their slot at once:
    the smallest span takes a free slot, spans equal to its holder are done, the others try the next slot.
    """
    n = len(start)
    if not n:
        return np.empty(0, bool)
    eights = _eights(raw)
    bits = max(1, (2 * n - 1).bit_length())
    slot = (span_hashes(raw, eights, start, size, group) >> np.uint64(64 - bits)).astype(np.int64)
    holder = np.full(1 << bits, n, np.int64)
    first = np.zeros(n, bool)
    open_ = np.arange(n)
    while len(open_):
        at = slot[open_]
        free = holder[at] == n
        # Assigned from the last to the first, so the smallest span stays.
        claim = open_[free][::-1]
        holder[slot[claim]] = claim
        held = holder[at]
        own = held == open_
        first[open_[own]] = True
        rest = ~own
        same = np.zeros(len(open_), bool)
        x, y = open_[rest], held[rest]
        same[rest] = (group[x] == group[y]) & _equal(raw, eights, size, start, x, y)
        open_ = open_[rest & ~same]
        slot[open_] = (slot[open_] + 1) & ((1 << bits) - 1)
    return first


def text_counts(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """Words, distinct words, capitals, code points and symbols of every text; null counts as empty."""
    raw, offsets = byte_slices(texts)
    sizes = np.diff(offsets)
    n = len(sizes)
    # A blank after every text ends its last word.
    spaced = np.full(len(raw) + n, 0x20, np.uint8)
    spaced[np.arange(len(raw)) + np.repeat(np.arange(n), sizes)] = raw
    flags = transduce(spaced)
    borders = offsets + np.arange(n + 1)
    begin, end = np.flatnonzero(flags & BEGINS), np.flatnonzero(flags & ENDS)
    owner = np.searchsorted(borders, begin, side="right") - 1
    first = distinct_spans(spaced, begin, end - begin, owner)
    per = lambda which: np.diff(np.searchsorted(np.flatnonzero(flags & which), borders))
    blanks = per(IS_CHARACTER) - 1
    return np.bincount(owner, minlength=n), np.bincount(owner[first], minlength=n), per(IS_CAPITAL), blanks, per(IS_SYMBOL)


COUNTS = ["n_words", "n_distinct", "n_capitals", "n_chars", "n_symbols"]


def count_texts(docs: DataFrame, keep: Sequence[str | Column], text: str = "text") -> DataFrame:
    """The kept columns, the counts of :func:`text_counts` and the sha256 of every whole text (null: of the empty one)."""
    rows = docs.select(*keep, F.col(text).alias("_t"))
    kept = rows.columns[:-1]
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = byte_slices(batch.column(len(kept)))
            start = 0
            while start < batch.num_rows:
                end = min(max(start + 1, int(np.searchsorted(offsets, offsets[start] + CHUNK_BYTES))), batch.num_rows)
                part = batch.slice(start, end - start)
                raw, own = byte_slices(part.column(len(kept)))
                data = memoryview(raw)
                digests = [hashlib.sha256(data[a:b]).digest() for a, b in zip(own[:-1].tolist(), own[1:].tolist())]
                counts = [pa.array(c, pa.int64()) for c in text_counts(part.column(len(kept)))]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *counts, pa.array(digests, pa.binary())], names=[*kept, *COUNTS, "digest"])
                start = end

    return rows.mapInArrow(run, f"{types}, {', '.join(f'{c} bigint' for c in COUNTS)}, digest binary")


def failed_rules() -> Column:
    """Bits of the filters A to D that the counts fail."""
    fails = [
        F.col("n_words") < MIN_WORDS,
        100 * F.col("n_distinct") < 50 * F.col("n_words"),
        100 * F.col("n_capitals") > 2 * F.col("n_chars"),
        F.col("n_symbols") > 0,
    ]
    bits = [F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)]
    return (bits[0] + bits[1] + bits[2] + bits[3]).cast("int")


def failed_filters(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source"
) -> DataFrame:
    """Documents per part, set of failed filters and label: part, failed (bits of A to E), good, toxic, n.

    E fails where a smaller key has the same text. Null keys are smaller than all others, and equal
    to each other. Documents are counted by (key, part, text) first, then by (text, part), so neither
    repeated rows nor a group of copies meets in one task. A document is good or toxic if any label of its key says so.
    """
    counted = count_texts(docs, [F.col(key).alias("k"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part")], text)
    rows = counted.groupBy("k", "part", "digest", failed_rules().alias("failed")).agg(F.count("*").alias("n"))
    said = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")
    )
    # Null keys meet no label; their second key, the text, keeps them from going to one task of the join.
    # The labels' second key is an empty string made from a column, since a constant would be folded away.
    rows = rows.withColumn("own", F.when(F.col("k").isNull(), F.hex("digest")).otherwise(F.lit("")))
    said = said.withColumn("_own", F.substring(F.col("_k").cast("string"), 1, 0))
    known = rows.join(said, (F.col("k") == F.col("_k")) & (F.col("own") == F.col("_own")), "left").fillna(0, ["good", "toxic"])
    classes = known.groupBy("digest", "part", "failed", "good", "toxic").agg(F.sum("n").alias("n"), F.min(F.struct("k", "n")).alias("least"))
    # A text has at most one class per part and label. The rows of the smallest key pass E; all others of the text fail it.
    first = F.min(F.struct(F.col("least.k").alias("k"))).over(Window.partitionBy("digest"))
    pass_e = F.when(F.col("least.k").eqNullSafe(F.col("first.k")), F.col("least.n")).otherwise(0)
    met = classes.withColumn("first", first)
    split = F.explode(F.array(F.struct(F.col("failed").alias("f"), pass_e.alias("c")), F.struct((F.col("failed") + 16).alias("f"), (F.col("n") - pass_e).alias("c"))))
    return (
        met.select("part", "good", "toxic", split.alias("s"))
        .groupBy("part", F.col("s.f").alias("failed"), "good", "toxic")
        .agg(F.sum("s.c").alias("n"))
    )


def _bits(letters: Column) -> Column:
    """The bits of an array of filter letters, added."""
    values = F.array(*[F.lit(1 << i) for i in range(len(FILTERS))])
    return F.aggregate(letters, F.lit(0), lambda s, x: s + F.get(values, F.instr(F.lit(FILTERS), x) - 1))


def audit_filters(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """What every filter removes at every step of every order, per part; 600 rows a part.

    Filters: A fewer than 200 words; B distinct words under half of all; C more than 2 % capitals
    A-Z; D any of ``#$%&*|``; E the text stands under a smaller key too, wherever. Columns: part, filter_order, step,
    and counts of documents: kept, removed, redundant (failing, but gone before), unique_fails (failing
    nothing else), good_lost and toxic_lost (removed, by label), shapley (removed, summed over all orders).
    A null part is the empty string and a null text is empty; see :func:`failed_filters` for keys and repeated
    rows. Other columns are not read. An empty table gives no rows.
    """
    sums = [F.sum(F.col("n") * x).alias(c) for c, x in (("n", F.lit(1)), ("good", F.col("good")), ("toxic", F.col("toxic")))]
    tally = failed_filters(docs, labels, key, text, part).groupBy("part", "failed").agg(*sums)
    # At most 32 sets of failed filters a part.
    cells = tally.groupBy("part").agg(F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("cells"))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    steps = cells.select("part", "cells", F.explode(orders).alias("filter_order"))
    steps = steps.select("*", F.posexplode(F.split("filter_order", "")).alias("at", "letter"))
    steps = steps.withColumns({
        "bit": _bits(F.array("letter")), "before": _bits(F.slice(F.split("filter_order", ""), F.lit(1), F.col("at"))),
    })

    def counted(field: str, wanted) -> Column:
        take = lambda s, c: s + F.when(wanted(c["failed"]), c[field]).otherwise(0)
        return F.aggregate("cells", F.lit(0).cast("bigint"), take)

    fails = lambda m: m.bitwiseAND(F.col("bit")) != 0
    earlier = lambda m: m.bitwiseAND(F.col("before")) != 0
    gone = lambda m: fails(m) & ~earlier(m)
    # Of the filters that a document fails, each stands first in the same number of orders.
    times = lambda m: F.floor(F.lit(factorial(len(FILTERS))) / F.bit_count(m))
    share = F.aggregate("cells", F.lit(0).cast("bigint"), lambda s, c: s + F.when(fails(c["failed"]), c["n"] * times(c["failed"])).otherwise(0))
    return steps.select(
        "part",
        "filter_order",
        (F.col("at") + 1).alias("step"),
        counted("n", lambda m: ~fails(m) & ~earlier(m)).alias("kept"),
        counted("n", gone).alias("removed"),
        counted("n", lambda m: fails(m) & earlier(m)).alias("redundant"),
        counted("n", lambda m: m == F.col("bit")).alias("unique_fails"),
        counted("good", gone).alias("good_lost"),
        counted("toxic", gone).alias("toxic_lost"),
        share.alias("shapley"),
    )
