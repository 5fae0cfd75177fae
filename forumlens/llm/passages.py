"""Substring de-duplication over words by super-k-mer partitioning.

A window is a run of consecutive words of one document. Its minimiser is the smallest hash of its
short word runs, so equal windows have equal minimisers. Consecutive windows that share one travel
as a single packed string to the minimiser's bucket, where sorting finds equal windows exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.llm.words import WordHashes, byte_slices, hashed, mixed, window_hashes, worker_cache
from forumlens.session import staged

WINDOW = 13
GRAM = 3
# Text that one task packs at a time, and packed text that one bucket should hold.
CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 6 << 20
MIN_BUCKETS = 96
LOWEST = -(2**63)
LEVEL = 3
# Counting rounds for crowded minimisers; in data without any there is one.
ROUNDS = 4
TOP = np.uint64(1 << 63)
NONE = np.empty(0, np.uint64)


def ranges_of(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of every range, one range after the other."""
    total = int(counts.sum())
    if not total:
        return np.empty(0, np.int64)
    before = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, counts)


def runs_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First positions and lengths of runs of equal neighbours."""
    if not len(keys):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return first, np.diff(np.r_[first, len(keys)])


def packed_numbers(columns: np.ndarray) -> bytes:
    """Columns of one length, compressed: the first as differences, all by planes of bytes."""
    table = np.concatenate([np.diff(columns[:1], prepend=0), columns[1:]])
    return zstandard.compress(np.ascontiguousarray(table.view(np.uint8).reshape(-1, 8).T).tobytes(), LEVEL)


def unpacked_numbers(data: bytes, columns: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    table = np.ascontiguousarray(planes.T).view("<i8").reshape(columns, -1)
    return np.concatenate([np.cumsum(table[:1], axis=1), table[1:]])


class Parcels:
    """What a task sends to its buckets, held back until it fills blobs that compress well."""

    SCHEMA = "bucket int, kind int, meta binary, text binary"
    HELD_BYTES = 40 << 20

    def __init__(self, first: int = 0) -> None:
        self.held: dict[tuple[int, int], tuple[list, list]] = {}
        self.size = 0
        self.turn = int(mixed(np.array([first], np.uint64))[0])

    def settle(self, buckets: int, columns: list[np.ndarray]) -> None:
        """Settled runs of one chunk. They need no grouping, so chunks take the buckets in turn."""
        self.add(self.turn % buckets, 1, columns)
        self.turn += 1

    def add(self, bucket: int, kind: int, columns: list[np.ndarray], text: bytes = b"") -> None:
        numbers, texts = self.held.setdefault((bucket, kind), ([], []))
        numbers.append(np.stack(columns).astype("<i8"))
        texts.append(text)
        self.size += len(text) + numbers[-1].nbytes

    def batches(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        if not self.held or (self.size < self.HELD_BYTES and not last):
            return
        keys = list(self.held)
        metas = [packed_numbers(np.concatenate(self.held[k][0], axis=1)) for k in keys]
        texts = [zstandard.compress(b"".join(self.held[k][1]), LEVEL) if k[1] == 0 else b"" for k in keys]
        self.held, self.size = {}, 0
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[i] for k in keys], pa.int32()) for i in (0, 1)] + [pa.array(metas, pa.binary()), pa.array(texts, pa.binary())],
            names=["bucket", "kind", "meta", "text"],
        )


def text_sum(text: bytes) -> int:
    """Tells apart the texts of rows that share a key: the number that Spark's xxhash64 gives."""
    value = xxhash.xxh64_intdigest(text, seed=42)
    return value - (1 << 64) if value >> 63 else value


class Words:
    """Words of some texts back to back: byte borders, hashes, and the text each belongs to."""

    def __init__(self, texts: list[bytes], table: WordHashes) -> None:
        self.raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        blank = (self.raw == 32) | ((self.raw >= 9) & (self.raw <= 13))
        turn = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        if not blank[0]:
            turn = np.r_[0, turn]
        self.begin, self.end = turn[0::2], turn[1::2]
        self.hashes = hashed(self.raw.tobytes().split(), table)
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        borders = np.cumsum(sizes)
        self.text = np.searchsorted(borders, self.begin, side="right")
        self.first = np.searchsorted(self.begin, borders - sizes)


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are among the sorted known ones."""
    if len(known) <= 8:
        return np.any([values == k for k in known], axis=0) if len(known) else np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def ordered_grams(grams: np.ndarray, passed: np.ndarray) -> np.ndarray:
    """Gram hashes below TOP; those passed over as minimisers come after all others, from TOP on."""
    grams = grams >> np.uint64(1)
    return np.where(among(grams, passed), grams | TOP, grams) if len(passed) else grams


def window_keys(least: np.ndarray, own: np.ndarray, alone: np.ndarray) -> np.ndarray:
    """Minimiser of every window, or from TOP on the window's own hash, if its minimiser is passed over or alone."""
    single = (least >= TOP) | among(least, alone)
    return np.where(single, own | TOP, least) if single.any() else least


def crowded(rows: DataFrame, pack, bound: int, total: int, chunk: int = CHUNK_BYTES, around=None) -> tuple[np.ndarray, np.ndarray]:
    """Minimisers to pass over, and those whose windows go by their own hash, so that no other one has over
    twice ``bound`` bytes of packed windows.

    ``pack(parcels, keys, texts, splits)`` gives a chunk's minimisers and bytes. A chunk reports those above
    its share of the bound, which leaves out at most ``bound`` bytes of any minimiser. Minimisers passed over
    may crowd the windows at another one, so the count is repeated until none is found. With
    ``around(keys, texts, passed)``, the parts of a chunk whose windows hold a minimiser passed over, only those are counted
    again: their bytes as they go now less those of the first count.
    """
    passed, alone = NONE, NONE
    if 3 * total <= bound:
        return passed, alone
    base = None
    for left in reversed(range(ROUNDS)):
        again = base is not None

        def count(batches: Iterator[pa.RecordBatch], passed=passed, again=again) -> Iterator[pa.RecordBatch]:
            for keys, texts in text_chunks(batches, 0, chunk):
                share = sum(map(len, texts))
                if again:
                    keys, texts = around(keys, texts, passed)
                    if not texts:
                        continue
                least, sizes = pack(keys, texts, (passed, NONE))
                if again:
                    before, less = pack(keys, texts, (NONE, NONE))
                    least, sizes = np.r_[least, before], np.r_[sizes, -less]
                order = np.argsort(least, kind="stable")
                first, _ = runs_of(least[order])
                if len(first):
                    sums = np.add.reduceat(sizes[order], first)
                    many = np.abs(sums) * total > bound * share
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(least[order][first][many].astype(np.int64)), pa.array(sums[many])], names=["least", "size"]
                    )

        # Keys from TOP on are negative here: own hashes, which nothing splits further.
        sums = rows.select("k", "t").mapInArrow(count, "least bigint, size bigint").where("least >= 0")
        summed = (sums.unionByName(base) if again else sums).groupBy("least").agg(F.sum("size").alias("size"))
        if around is not None and not again:
            summed = base = staged(summed, "minimisers")
        found = summed.where(F.col("size") > bound).collect()
        new = np.setdiff1d(np.array([r["least"] for r in found], np.uint64), passed)
        if not len(new):
            break
        if left:
            passed = np.union1d(passed, new)
        else:
            alone = new
    return passed, alone


def text_chunks(batches: Iterator[pa.RecordBatch], least: int = 0, size_of_chunk: int = CHUNK_BYTES) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Keys and texts of (key, text) rows, about one chunk at a time; texts under ``least`` bytes are left out."""
    keys: list[np.ndarray] = []
    texts: list[bytes] = []
    size = 0
    for batch in batches:
        k = batch.column(0).to_numpy()
        raw, offsets = byte_slices(batch.column(1))
        for i in range(len(k)):
            if offsets[i + 1] - offsets[i] < least:
                continue
            keys.append(k[i : i + 1])
            texts.append(raw[offsets[i] : offsets[i + 1]].tobytes())
            size += len(texts[-1])
            if size >= size_of_chunk:
                yield np.concatenate(keys), texts
                keys, texts, size = [], [], 0
    if texts:
        yield np.concatenate(keys), texts


def super_kmers(words: Words, window: int, gram: int, splits: tuple = (NONE, NONE)) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of windows and key (see :func:`window_keys`) of every run of windows that share it."""
    grams = ordered_grams(window_hashes(words.hashes, gram), splits[0])
    span = window - gram + 1
    n = len(words.hashes) - window + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    least = grams[:n].copy()
    for i in range(1, span):
        np.minimum(least, grams[i : i + n], out=least)
    at = np.flatnonzero(words.text[:n] == words.text[window - 1 :])
    if not len(at):
        return at, at, np.empty(0, np.uint64)
    key = least[at]
    if len(splits[0]) or len(splits[1]):
        key = window_keys(key, window_hashes(words.hashes, window)[at], splits[1])
    new = np.r_[True, (np.diff(at) != 1) | (key[1:] != key[:-1]) | (words.text[at[1:]] != words.text[at[:-1]])]
    first = np.flatnonzero(new)
    return at[first], np.diff(np.r_[first, len(at)]), key[first]


def run_hashes(hashes: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Hash of the word sequence of every run."""
    factor = np.uint64(0x9E3779B97F4A7C15 | 1)
    inverse = np.uint64(pow(int(factor), -1, 1 << 64))
    powers = np.cumprod(np.full(len(hashes) + 1, factor, np.uint64))
    back = np.cumprod(np.full(len(hashes) + 1, inverse, np.uint64))
    sums = np.r_[np.uint64(0), np.cumsum(hashes * powers[:-1])]
    return mixed((sums[starts + counts] - sums[starts]) * back[starts] + counts.astype(np.uint64))


def pack_chunk(
    parcels: Parcels | None, keys: np.ndarray, texts: list[bytes], table: WordHashes, window: int, gram: int, buckets: int,
    splits: tuple = (NONE, NONE),
) -> tuple[np.ndarray, np.ndarray]:
    """Add a chunk to the parcels: kind 0 holds super-k-mers, kind 1 settled windows. Gives the keys and bytes
    of the super-k-mers that travel, which without parcels is all.

    Of equal super-k-mers only that of the smallest key travels (and repeats under that key): windows
    of the others are known to start under a smaller key too. So a passage that a third of all
    documents share reaches its bucket once per chunk.
    """
    words = Words(texts, table)
    start, count, least = super_kmers(words, window, gram, splits)
    if not len(start):
        return NONE, start
    n_words = count + window - 1
    same = run_hashes(words.hashes, start, n_words)
    owner = words.text[start]
    key = keys[owner]
    sums = np.array([text_sum(t) for t in texts], np.int64)[owner]
    place = start - words.first[owner]
    order = np.lexsort((key, same))
    first, size = runs_of(same[order])
    smallest = np.empty(len(order), np.int64)
    smallest[order] = np.repeat(key[order][first], size)
    travel = np.flatnonzero(key == smallest)
    sizes = words.end[start[travel] + n_words[travel] - 1] + 1 - words.begin[start[travel]]
    if parcels is None:
        return least[travel], sizes
    settled = np.flatnonzero(key > smallest)
    if len(settled):
        parcels.settle(buckets, [c[settled] for c in (key, sums, place, count)])
    sent = least[travel], sizes
    bucket = (mixed(least[travel]) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    travel, bucket = travel[order], bucket[order]
    first, size = runs_of(bucket)
    for f, s in zip(first, size):
        own = travel[f : f + s]
        begin, end = words.begin[start[own]], words.end[start[own] + n_words[own] - 1] + 1
        text = words.raw[ranges_of(begin, end - begin)].tobytes()
        parcels.add(int(bucket[f]), 0, [c[own] for c in (key, sums, place, count)], text)
    return sent


def equal_windows(ids: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the windows that begin at ``starts`` with equal ones together, and first and size of each group.

    Windows are sorted by hash and neighbours of equal hash compared word by word; should a hash
    mislead, the windows are sorted by their words.
    """
    named = mixed(ids.astype(np.uint64) + np.uint64(1))
    hashes = window_hashes(named, window)[starts]
    order = np.argsort(hashes, kind="stable")
    first, size = runs_of(hashes[order])
    same = np.ones(len(order), bool)
    same[first] = False
    at = np.flatnonzero(same)
    a, b = starts[order[at]], starts[order[at - 1]]
    if any((ids[a + i] != ids[b + i]).any() for i in range(window)):
        columns = [ids[starts + i] for i in range(window)]
        order = np.lexsort(columns)
        differs = np.zeros(len(order) - 1, bool)
        for c in columns:
            differs |= c[order][1:] != c[order][:-1]
        first = np.flatnonzero(np.r_[True, differs])
        size = np.diff(np.r_[first, len(order)])
    return order, first, size


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def bucket_marks(table: pa.Table, window: int) -> pa.Table:
    """Runs of windows of one bucket that also start under a smaller key: key, text sum, first word, windows."""
    done, metas, texts = [], [], []
    for kind, meta, text in zip(table["kind"].to_pylist(), table["meta"].to_pylist(), table["text"].to_pylist()):
        numbers = unpacked_numbers(meta, 4)
        if kind:
            done.append(numbers)
        else:
            metas.append(numbers)
            texts.append(zstandard.decompress(text))
    if metas:
        key, sums, place, count = np.concatenate(metas, axis=1)
        known = _Ids()
        words = b"".join(texts).split()
        ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        del words, known, texts
        n_words = count + window - 1
        begin = np.cumsum(n_words) - n_words
        starts = ranges_of(begin, count)
        owner = np.repeat(np.arange(len(count)), count)
        order, first, size = equal_windows(ids, starts, window)
        least = np.empty(len(order), np.int64)
        least[order] = np.repeat(np.minimum.reduceat(key[owner][order], first), size)
        hit = np.flatnonzero(least < key[owner])
        if len(hit):
            new = np.r_[True, (np.diff(hit) != 1) | (owner[hit[1:]] != owner[hit[:-1]])]
            f = np.flatnonzero(new)
            own = owner[hit[f]]
            at = place[own] + starts[hit[f]] - begin[own]
            done.append(np.stack([key[own], sums[own], at, np.diff(np.r_[f, len(hit)])]))
    every = np.concatenate(done, axis=1) if done else np.empty((4, 0), np.int64)
    return pa.table({"k": every[0], "sum": every[1], "first": every[2].astype(np.int32), "n": every[3].astype(np.int32)})


def drop_repeated_passages(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Remove every word covered by a window that also starts in a row with a smaller key.

    Columns: key, n_words, n_removed, kept (the other words joined by one space). Windows are judged
    on the input and never cross documents. A null text has no words; a text shorter than a window
    keeps all. A null key counts as smaller than all others. Rows with the same key never remove
    each other's words, so repeated rows share one fate; each input row gives one output row. Other
    columns are not read. An empty table gives no rows.
    """
    rows = docs.select(
        F.col(key).alias("key"), F.coalesce(F.col(key).cast("long"), F.lit(LOWEST)).alias("k"), F.col(text).alias("t")
    )
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    # Packed windows take about three times the text.
    buckets = max(MIN_BUCKETS, -(-3 * total // bucket_bytes))

    def sized(keys: np.ndarray, texts: list[bytes], splits: tuple) -> tuple[np.ndarray, np.ndarray]:
        return pack_chunk(None, keys, texts, worker_cache("words", WordHashes), window, gram, buckets, splits)

    splits = crowded(rows, sized, bucket_bytes, total)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = worker_cache("words", WordHashes)
        parcels = Parcels(TaskContext.get().partitionId())
        for keys, texts in text_chunks(batches):
            pack_chunk(parcels, keys, texts, table, window, gram, buckets, splits)
            yield from parcels.batches()
        yield from parcels.batches(last=True)

    packed = rows.select("k", "t").mapInArrow(pack, Parcels.SCHEMA)
    marks = packed.groupBy("bucket").applyInArrow(
        lambda table: bucket_marks(table, window), "k bigint, sum bigint, first int, n int"
    )
    # By key and text, so that rows of one key do not meet the marks of each other; equal marks of equal texts collapse.
    per_row = marks.groupBy("k", "sum").agg(F.collect_set(F.struct("first", "n")).alias("marks"))
    met = rows.withColumn("sum", F.xxhash64("t")).join(per_row, ["k", "sum"], "left").select("key", "t", "marks")
    kind = met.schema["key"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            if isinstance(lists, pa.ChunkedArray):
                lists = lists.combine_chunks()
            parts = lists.flatten()
            first, n = (parts.field(i).to_numpy() for i in range(2))
            border = np.r_[0, np.cumsum(np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64))]
            raw, offsets = byte_slices(batch.column(1))
            counts, removed, kept = [], [], []
            for i in range(batch.num_rows):
                t = raw[offsets[i] : offsets[i + 1]].tobytes()
                words = t.split()
                own = slice(border[i], border[i + 1])
                if border[i + 1] > border[i]:
                    begin = first[own]
                    step = np.zeros(len(words) + 1, np.int64)
                    np.add.at(step, begin, 1)
                    np.add.at(step, begin + n[own] + window - 1, -1)
                    gone = np.cumsum(step)[:-1] > 0
                    left = [words[j] for j in np.flatnonzero(~gone)]
                else:
                    left = words
                counts.append(len(words))
                removed.append(len(words) - len(left))
                kept.append(b" ".join(left))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["key", "n_words", "n_removed", "kept"],
            )

    return met.mapInArrow(cut, f"key {kind}, n_words bigint, n_removed bigint, kept string").withColumnRenamed("key", key)
