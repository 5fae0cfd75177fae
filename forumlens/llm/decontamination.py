"""Benchmark decontamination: suffix arrays over the training words, searched for every test suffix.

A word is a run of ASCII letters, digits and non-ASCII characters, lower-cased from A to Z. Test
words are numbered in order of their bytes; all other words are 0, which also ends every text, so a
suffix is compared up to its first 0. Each shard of documents sorts the suffixes that begin with a
test word: several words are packed into one number, and ties are resolved by ranks that double
their reach. Every suffix of every test item is then looked up by binary search. The range of
suffixes that share a whole window with it gives all places of the window, and the last range that
is not empty gives the longest verbatim match and where it lies.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.llm.passages import ranges_of, runs_of
from forumlens.llm.words import byte_slices, worker_cache
from forumlens.session import staged

WINDOW = 10
# Text of documents in a shard, text of test items broadcast at a time, and words of a test piece.
SHARD_BYTES = 8 << 20
BLOCK_BYTES = 16 << 20
PIECE_WORDS = 1024

# Everything but digits, letters and bytes of non-ASCII characters becomes a blank; A-Z become a-z.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


@dataclass
class Tokens:
    """Numbered words of some texts back to back, a 0 after each text."""

    ids: np.ndarray
    first: np.ndarray
    n_words: np.ndarray

    @classmethod
    def of(cls, texts: list[list[bytes]], numbers: dict[bytes, int]) -> Tokens:
        n_words = np.array([len(t) for t in texts], np.int64)
        first = np.cumsum(n_words + 1) - (n_words + 1)
        ids = np.zeros(int((n_words + 1).sum()), np.int64)
        flat = np.fromiter((numbers.get(w, 0) for t in texts for w in t), np.int64, int(n_words.sum()))
        ids[ranges_of(first, n_words)] = flat
        return cls(ids, first, n_words)


class SuffixArray:
    """Sorted suffixes that begin with a numbered word, up to ``depth`` words each."""

    def __init__(self, tokens: Tokens, bits: int, depth: int) -> None:
        self.tokens, self.bits = tokens, bits
        self.width = 62 // bits
        self.depth = depth
        padded = np.r_[tokens.ids, np.zeros(depth + 2 * self.width, np.int64)]
        n = len(tokens.ids)
        keys = np.zeros(n + depth + self.width, np.int64)
        alive = np.ones(len(keys), bool)
        for i in range(self.width):
            word = np.where(alive, padded[i : i + len(keys)], 0)
            alive &= word > 0
            keys = keys << bits | word
        # Keys of the words at a place: nothing after their first 0.
        self.keys = keys
        self.order = self._sorted(np.flatnonzero(tokens.ids))

    def _sorted(self, places: np.ndarray) -> np.ndarray:
        order = places[np.argsort(self.keys[places], kind="stable")]
        rank = np.zeros(len(self.keys), np.int64)
        lead = self.keys[order]
        first, size = runs_of(lead)
        rank[order] = np.repeat(first + 1, size)
        # A key that ends in 0 holds a whole suffix; runs of other equal keys go on.
        whole = np.ones(len(self.keys), bool)
        whole[order] = (lead & ((1 << self.bits) - 1)) == 0
        open_runs = (size > 1) & ~whole[order[first]]
        reach = self.width
        while open_runs.any() and reach < self.depth:
            first, size = first[open_runs], size[open_runs]
            at = ranges_of(first, size)
            own = np.repeat(first, size)
            members = order[at]
            ahead = rank[members + reach]
            by = np.lexsort((ahead, own))
            members, ahead, own = members[by], ahead[by], own[by]
            order[at] = members
            new = np.r_[True, (own[1:] != own[:-1]) | (ahead[1:] != ahead[:-1])]
            run = np.flatnonzero(new)
            first, size = at[run], np.diff(np.r_[run, len(at)])
            rank[members] = np.repeat(first + 1, size)
            whole[members] = whole[members + reach]
            open_runs = (size > 1) & ~whole[members[run]]
            reach *= 2
        return order

    def _bound(self, low: np.ndarray, high: np.ndarray, ahead: int, wanted: np.ndarray) -> np.ndarray:
        """Per query the first place in [low, high) whose key ``ahead`` words on is not below the wanted one."""
        low, high = low.copy(), high.copy()
        while True:
            at = np.flatnonzero(low < high)
            if not len(at):
                return low
            mid = (low[at] + high[at]) // 2
            less = self.keys[self.order[mid] + ahead] < wanted[at]
            low[at[less]] = mid[less] + 1
            high[at[~less]] = mid[~less]

    def windows(self, other: SuffixArray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of the suffixes here that begin with the ``sizes`` words at ``starts`` of another text."""
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), len(self.order), np.int64)
        for ahead in range(0, int(sizes.max(initial=0)), self.width):
            at = np.flatnonzero((sizes > ahead) & (low < high))
            rest = self.bits * np.maximum(self.width - (sizes[at] - ahead), 0)
            least = other.keys[starts[at] + ahead] >> rest
            low[at], high[at] = (
                self._bound(low[at], high[at], ahead, least << rest),
                self._bound(low[at], high[at], ahead, (least + 1) << rest),
            )
        return low, high

    def longest(self, other: SuffixArray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words of the longest match of every suffix at ``starts`` of another text, and a place here (-1: none)."""
        length, place = np.zeros(len(starts), np.int64), np.full(len(starts), -1, np.int64)
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), len(self.order), np.int64)
        at = np.flatnonzero(low < high)
        for ahead in range(0, self.depth, self.width):
            wanted = other.keys[starts[at] + ahead]
            left = self._bound(low[at], high[at], ahead, wanted)
            # The neighbours on both sides of the wanted key agree with it the longest.
            for near in (left, left - 1):
                inside = (near >= low[at]) & (near < high[at])
                there = self.order[np.where(inside, near, low[at])]
                agreed = self._common(self.keys[there + ahead], wanted)
                better = inside & (agreed > 0) & (ahead + agreed > length[at])
                length[at[better]] = ahead + agreed[better]
                place[at[better]] = there[better]
            right = self._bound(left, high[at], ahead, wanted + 1)
            low[at], high[at] = left, right
            at = at[(left < right) & ((wanted & ((1 << self.bits) - 1)) > 0)]
            if not len(at):
                break
        return length, place

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Leading words that two keys share; a 0 is none."""
        out, same = np.zeros(len(a), np.int64), np.ones(len(a), bool)
        full = (1 << self.bits) - 1
        for i in reversed(range(self.width)):
            x = a >> (self.bits * i) & full
            same &= (x > 0) & (x == (b >> (self.bits * i) & full))
            out += same
        return out


class TestItems:
    """Test items of one block: numbered words, their windows, and the names of the items."""

    __test__ = False

    def __init__(self, rows: list[tuple[str | None, str]], window: int) -> None:
        self.names = [r[0] for r in rows]
        texts = [r[1].encode().split() for r in rows]
        self.numbers = {w: i + 1 for i, w in enumerate(sorted({w for t in texts for w in t}))}
        tokens = Tokens.of(texts, self.numbers)
        self.bits = max(1, len(self.numbers).bit_length())
        self.depth = max([window, *map(len, texts)])
        self.array = SuffixArray(tokens, self.bits, self.depth)
        # A window starts at every word with enough words after it; a short item is one window.
        self.size_of = np.minimum(tokens.n_words, window)
        counts = np.where(tokens.n_words > 0, tokens.n_words - self.size_of + 1, 0)
        self.start = ranges_of(tokens.first, counts)
        self.item = np.repeat(np.arange(len(rows)), counts)
        self.size = self.size_of[self.item]
        self.suffixes = ranges_of(tokens.first, tokens.n_words)


def shard_matches(items: TestItems, texts: list[bytes]) -> tuple[list[int], list[np.ndarray], list[np.ndarray], list[list[str]], list[tuple[int, int]]]:
    """Per text: words, first and size of every hit run, names of the items met, longest match and its first word."""
    tokens = Tokens.of([words_of(t) for t in texts], items.numbers)
    shard = SuffixArray(tokens, items.bits, items.depth)
    low, high = shard.windows(items.array, items.start, items.size)
    met = np.flatnonzero(low < high)
    # Equal windows have equal ranges; each range is read once.
    order = met[np.lexsort((items.size[met], low[met]))]
    first, copies = runs_of(low[order] * (int(items.size.max(initial=1)) + 1) + items.size[order])
    one = order[first]
    places = shard.order[ranges_of(low[one], (high - low)[one])]
    which = np.repeat(np.arange(len(one)), (high - low)[one])
    sizes = items.size[one][which]
    step = np.zeros(len(tokens.ids) + 1, np.int64)
    np.add.at(step, places, 1)
    np.add.at(step, places + sizes, -1)
    hit = np.cumsum(step[:-1]) > 0
    edge = np.diff(np.r_[False, hit, False].astype(np.int8))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    owner = np.searchsorted(tokens.first, begin, side="right") - 1
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    text_of = np.searchsorted(tokens.first, places, side="right") - 1
    # The longest match of a text starts where a window does.
    heads = np.unique(places)
    length, _ = items.array.longest(shard, heads)
    head_text = np.searchsorted(tokens.first, heads, side="right") - 1
    head_cuts = np.searchsorted(head_text, np.arange(len(texts) + 1))
    by_text = np.lexsort((which, text_of))
    place_cuts = np.searchsorted(text_of[by_text], np.arange(len(texts) + 1))
    names: dict[bytes, list[str]] = {}
    runs_first, runs_size, found, longest = [], [], [], []
    for i in range(len(texts)):
        own = slice(cuts[i], cuts[i + 1])
        runs_first.append(begin[own] - tokens.first[i])
        runs_size.append(end[own] - begin[own])
        if cuts[i] == cuts[i + 1]:
            found.append([])
            longest.append((0, -1))
            continue
        ranges = np.unique(which[by_text[place_cuts[i] : place_cuts[i + 1]]])
        # Copies meet the same windows, so their names are looked up once.
        known = ranges.tobytes()
        if known not in names:
            members = np.unique(items.item[order[ranges_of(first[ranges], copies[ranges])]])
            names[known] = sorted({items.names[m] for m in members if items.names[m] is not None})
        found.append(names[known])
        own = slice(head_cuts[i], head_cuts[i + 1])
        best = int(np.argmax(length[own]))
        longest.append((int(length[own][best]), int(heads[own][best] - tokens.first[i])))
    return tokens.n_words.tolist(), runs_first, runs_size, found, longest


def longest_in_shard(items: TestItems, texts: list[bytes]) -> list[tuple[int, int, int, int]]:
    """Per item with any match in the shard: (item, words, text, first word) of its longest verbatim match."""
    tokens = Tokens.of([words_of(t) for t in texts], items.numbers)
    shard = SuffixArray(tokens, items.bits, items.depth)
    length, place = shard.longest(items.array, items.suffixes)
    item = np.searchsorted(items.array.tokens.first, items.suffixes, side="right") - 1
    order = np.lexsort((items.suffixes, -length, item))
    best = order[runs_of(item[order])[0]]
    best = best[length[best] > 0]
    text = np.searchsorted(tokens.first, place[best], side="right") - 1
    return list(zip(item[best].tolist(), length[best].tolist(), text.tolist(), (place[best] - tokens.first[text]).tolist()))


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[pa.Array], list[bytes]]]:
    """Key columns and texts, a shard at a time; the text is the last column and null counts as empty."""
    held: list[pa.RecordBatch] = []
    texts: list[bytes] = []
    size = 0
    for batch in batches:
        raw, offsets = byte_slices(batch.column(batch.num_columns - 1))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + SHARD_BYTES - size))
            end = min(max(end, start + 1), batch.num_rows)
            held.append(batch.slice(start, end - start).select(range(batch.num_columns - 1)))
            texts += [raw[offsets[i] : offsets[i + 1]].tobytes() for i in range(start, end)]
            size += int(offsets[end] - offsets[start])
            start = end
            if size >= SHARD_BYTES:
                yield pa.Table.from_batches(held).combine_chunks().columns, texts
                held, texts, size = [], [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().columns, texts


def _pieces(benchmark: DataFrame, key: str, text: str, window: int) -> DataFrame:
    """(name, words): items as their words joined by blanks, long ones in pieces that share ``window - 1`` words."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(PIECE_WORDS, 2 * window)
        for batch in batches:
            names, parts = [], []
            for name, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of((t or "").encode())
                for i in range(0, max(1, len(words) - window + 1), step):
                    if words:
                        names.append(name)
                        parts.append(b" ".join(words[i : i + step + window - 1]).decode())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(parts, pa.string())], names=["name", "words"])

    return benchmark.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t")).mapInArrow(cut, "name string, words string")


def test_blocks(benchmark: DataFrame, key: str, text: str, window: int, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[str | None, str]]]:
    """The test items in blocks of at most about ``block_bytes``, one at a time; repeated pieces once.

    A piece goes to a block by its hash; blocks are doubled until the largest is within the bound.
    """
    pieces = staged(_pieces(benchmark, key, text, window).distinct(), "test-items")
    size = F.octet_length("words") + F.coalesce(F.octet_length("name"), F.lit(0)) + 16
    place = F.xxhash64("name", "words")
    n = max(1, -(-(pieces.agg(F.sum(size)).first()[0] or 0) // block_bytes))
    while n > 1:
        largest = pieces.groupBy(F.pmod(place, F.lit(n)).alias("b")).agg(F.sum(size).alias("s")).agg(F.max("s")).first()[0]
        if largest <= 1.25 * block_bytes:
            break
        n *= 2
    for b in range(n):
        own = pieces.where(F.pmod(place, F.lit(n)) == b) if n > 1 else pieces
        rows = own.orderBy("words", "name").collect()
        if rows:
            yield [tuple(r) for r in rows]


test_blocks.__test__ = False


def _broadcast(spark, rows: list[tuple[str | None, str]], window: int):
    """A function for tasks that gives the items of a block; a worker keeps those of one block."""
    held, name = spark.sparkContext.broadcast(rows), uuid.uuid4().hex

    def items() -> TestItems:
        kept = worker_cache("test-items", dict)
        if name not in kept:
            kept.clear()
            kept[name] = TestItems(held.value, window)
        return kept[name]

    return items


ROW = "n_words bigint, first array<int>, size array<int>, names array<string>, longest bigint, longest_at bigint"


def _found(rows: DataFrame, items, kind: str) -> DataFrame:
    """One row per document and block of test items: words, hit runs, names of the items met, longest match."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (key, digest), texts in _shards(batches):
            n_words, first, size, names, longest = shard_matches(items(), texts)
            yield pa.RecordBatch.from_arrays(
                [
                    key.combine_chunks(), digest.combine_chunks(), pa.array(n_words, pa.int64()),
                    pa.array(first, pa.list_(pa.int32())), pa.array(size, pa.list_(pa.int32())), pa.array(names, pa.list_(pa.string())),
                    pa.array([x[0] for x in longest], pa.int64()), pa.array([x[1] for x in longest], pa.int64()),
                ],
                names=["k", "digest", "n_words", "first", "size", "names", "longest", "longest_at"],
            )

    return rows.mapInArrow(run, f"k {kind}, digest binary, {ROW}")


def _words_in(runs) -> F.Column:
    """Words in the union of [first, first + size) ranges, sorted by their first word."""
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end"))
    step = lambda s, r: F.struct(
        (s["n"] + F.greatest(r["first"] + r["size"] - F.greatest(r["first"], s["end"]), F.lit(0))).cast("bigint").alias("n"),
        F.greatest(s["end"], r["first"] + r["size"]).alias("end"),
    )
    return F.aggregate(runs, zero, step)["n"]


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Words of every document that lie in an occurrence of a test window, and the test items met.

    Columns: key, n_words, n_hit, n_items, items (ids as strings, sorted), contaminated (n_hit > 0), longest
    (words of the longest verbatim match of at least a window; 0 without) and longest_at (its first
    word, the first of equals; -1 without). A window is ``window`` consecutive words of an item; an
    item of fewer words, but not none, is one window. Null and empty texts have no words. Matches
    never cross documents or items. Items of one id are one item; an item without id still marks
    words but is not listed. Matches are not followed over the pieces of an item of more than
    ``PIECE_WORDS`` words, which concerns ``longest`` alone. Null keys, ties and repeated rows are kept, one
    row each; other columns are not read; an empty table gives no rows, an empty benchmark no hits.

    Documents are read in place, shard by shard, and not shuffled. Test items are broadcast in
    blocks of bounded size, one pass over the documents each; only with several blocks are the
    results of a document brought together, by key and text digest.
    """
    kind = docs.schema[key].dataType.simpleString()
    spark = docs.sparkSession
    # The digest only tells rows apart where several blocks meet again.
    blocks = list(map(lambda rows: _broadcast(spark, rows, window), test_blocks(benchmark, item, item_text, window, block_bytes)))
    several = len(blocks) > 1
    body = F.coalesce(F.col(text), F.lit(""))
    digest = F.unhex(F.sha2(body, 256)) if several else F.lit(None).cast("binary")
    rows = docs.select(F.col(key).alias("k"), digest.alias("digest"), F.col(text).alias("t"))
    if not blocks:
        blocks = [lambda: TestItems([], window)]
    runs = F.zip_with("first", "size", lambda f, s: F.struct(f.alias("first"), s.alias("size")))
    found = _found(rows, blocks[0], kind).withColumn("runs", runs)
    if several:
        for items in blocks[1:]:
            found = found.unionByName(_found(rows, items, kind).withColumn("runs", runs))
        found = (
            found.groupBy("k", "digest")
            .agg(
                (F.count("*") / len(blocks)).cast("int").alias("copies"),
                F.first("n_words").alias("n_words"),
                F.array_sort(F.array_distinct(F.flatten(F.collect_set("runs")))).alias("runs"),
                F.array_sort(F.array_distinct(F.flatten(F.collect_set("names")))).alias("names"),
                F.max(F.struct("longest", (-F.col("longest_at")).alias("at"))).alias("best"),
            )
            .select("k", "n_words", "runs", "names", F.col("best.longest").alias("longest"), (-F.col("best.at")).alias("longest_at"),
                    F.explode(F.sequence(F.lit(1), F.col("copies"))))
        )
    hit = found.withColumn("n_hit", _words_in(F.col("runs")))
    return hit.select(
        F.col("k").alias(key), "n_words", "n_hit", F.size("names").cast("bigint").alias("n_items"), F.col("names").alias("items"),
        (F.col("n_hit") > 0).alias("contaminated"), "longest", "longest_at",
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, without a word inside a test window; see :func:`benchmark_hits`.

    Rows are dropped by key and text digest, so of several texts under one key only those hit go.
    """
    marked = docs.select(F.struct(F.col(key).alias("key"), F.xxhash64(text).alias("sum")).alias("_id"), F.col(text).alias("_text"))
    gone = benchmark_hits(marked, benchmark, key="_id", text="_text", **options).where("contaminated")
    gone = gone.select(F.col("_id.key").alias("_gone_key"), F.col("_id.sum").alias("_gone_sum")).distinct()
    same = docs[key].eqNullSafe(gone["_gone_key"]) & (F.xxhash64(docs[text]) == gone["_gone_sum"])
    return docs.join(gone, same, "left_anti")


def longest_matches(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per test item id (as string) with any word in common: words of its longest verbatim match, document and first word.

    Each shard reports one match an item, merged by an aggregate; of equally long matches it is that of the
    smallest key among those reported. Items without id or words are left out.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    parts = None
    for block in test_blocks(benchmark, item, item_text, window, block_bytes):
        items = _broadcast(docs.sparkSession, block, window)

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            for (key_of,), texts in _shards(batches):
                held = longest_in_shard(items(), texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([items().names[m[0]] for m in held], pa.string()), pa.array([m[1] for m in held], pa.int64()),
                        key_of.combine_chunks().take(pa.array([m[2] for m in held], pa.int64())), pa.array([m[3] for m in held], pa.int64()),
                    ],
                    names=["name", "n", "k", "at"],
                )

        part = rows.mapInArrow(run, f"name string, n bigint, k {kind}, at bigint")
        parts = part if parts is None else parts.unionByName(part)
    if parts is None:
        parts = docs.sparkSession.createDataFrame([], f"name string, n bigint, k {kind}, at bigint")
    best = parts.where("name is not null").groupBy("name").agg(F.min(F.struct((-F.col("n")).alias("n"), "k", "at")).alias("b"))
    return best.select(F.col("name").alias(item), (-F.col("b.n")).alias("n_words"), F.col("b.k").alias(key), F.col("b.at").alias("first_word"))


def items_digest(items) -> F.Column:
    return F.sha2(F.encode(F.array_join(items, ","), "UTF-8"), 256)
