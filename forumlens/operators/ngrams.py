"""Counts of n-grams: documents pack runs of words per bucket, buckets count them.

A document's runs of up to n words go to the bucket of their first two words, where shorter n-grams are their
prefixes; single words go by themselves. A chunk of documents numbers its words, so that a run is one number,
counts equal runs by sorting, and sends every bucket one parcel: the words it needs and the runs as their numbers.
A bucket numbers the words of its parcels anew and sorts. Words are compared as they are; hashes only choose buckets.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

# Tokens that a task packs at a time; texts and documents (their keys travel along) that one bucket should hold parts of.
CHUNK_BYTES = 8 << 20
BUCKET_BYTES = 6 << 20
BUCKET_ROWS = 500_000
MIN_BUCKETS = 48
CODEC = "zstd"


class _Numbers(dict):
    """Numbers values in the order in which they are met, from ``first`` on."""

    def __init__(self, first: int) -> None:
        self.first = first

    def __missing__(self, value) -> int:
        number = self[value] = len(self) + self.first
        return number


def _frozen(value):
    """A key as a value that can be looked up."""
    if isinstance(value, dict):
        return tuple(map(_frozen, value.values()))
    return tuple(map(_frozen, value)) if isinstance(value, list) else value


def _sorted(code: np.ndarray, most: int) -> np.ndarray:
    """Stable order of codes below ``most``; sorting a number made of code and place is faster than an argsort."""
    bits = len(code).bit_length()
    if most << bits > 1 << 63:
        return np.argsort(code, kind="stable")
    return np.sort((code << bits) | np.arange(len(code))) & ((1 << bits) - 1)


def _codes(words: Sequence[np.ndarray], n: int) -> tuple[np.ndarray, int]:
    """One number per row of words 0 .. n - 1, and its bound; its order is that of the rows, so prefixes stay together.

    Numbers too large to be sorted along with their places are replaced by their ranks.
    """
    code, most = words[0].astype(np.int64), n
    for w in words[1:]:
        if most * n << len(code).bit_length() > 1 << 63:
            order = _sorted(code, most)
            rank = np.empty(len(code), np.int64)
            rank[order] = np.cumsum(_starts(code[order]))
            code, most = rank, len(code) + 1
        code = code * n + w
        most *= n
    return code, most


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where any of the columns differs from the row before."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def _runs(ids: np.ndarray, row: np.ndarray, key: np.ndarray, n_max: int, n_words: int) -> tuple[np.ndarray, ...]:
    """Distinct runs of a chunk per key: words (n_max rows, 0 past the end), key, tf, and firsts.

    ``ids`` number the words from 1, and rows are sorted by key. firsts has a row per length 2 .. n_max: in how many
    documents the run is the first with its prefix of that length; for a single word the first row has its documents.
    """
    table = np.zeros((n_max, len(ids)), np.int32)
    table[0] = ids
    for i in range(1, n_max):
        table[i, :-i] = np.where(row[i:] == row[:-i], ids[i:], 0)
    out = []
    for lengths in ([1], range(2, n_max + 1)):
        if not lengths:
            continue
        words = table[:1] if lengths == [1] else table[:, table[1] != 0]
        at = slice(None) if lengths == [1] else table[1] != 0
        code, most = _codes(words, n_words + 1)
        # Equal runs keep the order of documents, and so of keys.
        order = _sorted(code, most)
        words, code, r, k = words[:, order], code[order], row[at][order], key[at][order]
        firsts = np.zeros((max(1, n_max - 1), len(code)), np.int32)
        for length in lengths:
            same = np.cumsum(_starts(*words[:length]))
            if length == lengths[-1]:
                firsts[length - min(lengths)] = _starts(same, r)
            else:
                rows = int(r.max(initial=0)) + 1
                met = same * rows + r
                by = _sorted(met, (int(same[-1]) + 1) * rows if len(same) else 1)
                firsts[length - min(lengths), by[_starts(met[by])]] = 1
        begin = np.flatnonzero(_starts(code, k)) if len(code) else np.zeros(0, np.int64)
        size = np.diff(np.r_[begin, len(code)])
        full = np.zeros((n_max, len(begin)), np.int32)
        full[: len(words)] = words[:, begin]
        sums = np.add.reduceat(firsts, begin, axis=1) if len(begin) else firsts
        out.append((full, k[begin].astype(np.int32), size.astype(np.int32), sums))
    return tuple(np.concatenate([o[i] for o in out], axis=-1) for i in range(4))


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[_starts(values)]


def _mixed(x: np.ndarray) -> np.ndarray:
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def _packed_table(table: np.ndarray) -> bytes:
    """Numbers compressed by planes of bytes."""
    planes = np.ascontiguousarray(table.astype("<i4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), CODEC, asbytes=True)


def _unpacked_table(data: bytes, rows: int, columns: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 * rows * columns, CODEC, asbytes=True), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").reshape(columns, rows)


def _parcels(keys: pa.Array, number: np.ndarray, texts: list[bytes], n_max: int, across: list[int], buckets: int) -> pa.RecordBatch:
    """The parcels of a chunk: texts of words between blanks, each with the number of its key."""
    order = np.argsort(number, kind="stable")
    split = [texts[i].split(b" ") if texts[i] else [] for i in order.tolist()]
    sizes = np.array([len(s) for s in split], np.int64)
    known = _Numbers(1)
    ids = np.fromiter(map(known.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
    del split
    row = np.repeat(np.arange(len(sizes)), sizes)
    words, key, tf, firsts = _runs(ids, row, number[order][row], n_max, len(known))
    vocabulary = list(known)
    lead = np.fromiter(chain([0], map(zlib.crc32, vocabulary)), np.uint64, len(vocabulary) + 1)
    of_key = [zlib.crc32(repr([_frozen(k)[i] for i in across]).encode()) for k in keys.to_pylist()]
    second = lead[words[1]] if n_max > 1 else np.uint64(0)
    spot = lead[words[0]] + second * np.uint64(0x9E3779B97F4A7C15) + np.array(of_key, np.uint64)[key] * np.uint64(0xC2B2AE3D27D4EB4F)
    bucket = (_mixed(spot) % np.uint64(buckets)).astype(np.int64)
    n_grams = tf * np.maximum(sum((w != 0).astype(np.int32) for w in words) - 1, 1)
    order = _sorted(bucket, buckets)
    bucket, n_grams = bucket[order], n_grams[order]
    table = np.concatenate([words, key[None], tf[None], firsts])[:, order]
    first = np.flatnonzero(_starts(bucket))
    number_of, key_of = np.zeros(len(vocabulary) + 1, np.int32), np.zeros(len(keys), np.int32)
    rows: list[tuple] = []
    held: list[np.ndarray] = []
    for i, j in zip(first.tolist(), [*first[1:].tolist(), len(order)]):
        own = table[:, i:j].copy()
        used = _distinct(own[:n_max].ravel())
        # 0 stays 0, whether or not a run ends early.
        used = used[used > 0]
        number_of[used] = np.arange(1, len(used) + 1)
        own[:n_max] = number_of[own[:n_max]]
        own_keys = _distinct(own[n_max])
        key_of[own_keys] = np.arange(len(own_keys))
        own[n_max] = key_of[own[n_max]]
        text = b" ".join([vocabulary[x - 1] for x in used.tolist()])
        held.append(own_keys)
        grams = np.bincount(own[n_max], n_grams[i:j]).astype(np.int64)
        rows.append((int(bucket[i]), j - i, len(text), pa.compress(text, CODEC, asbytes=True), _packed_table(own), grams))
    offsets = pa.array(np.cumsum([0, *map(len, held)]), pa.int32())
    none = np.zeros(0, np.int64)
    columns = [
        pa.array([r[0] for r in rows], pa.int32()), pa.ListArray.from_arrays(offsets, keys.take(pa.array(np.concatenate([none, *held])))),
        pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([none, *[r[5] for r in rows]]))),
        pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int32()),
        pa.array([r[3] for r in rows], pa.binary()), pa.array([r[4] for r in rows], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["bucket", "keys", "grams", "n", "size", "words", "runs"])


def _packed(n_max: int, across: list[int]):
    """Rows of (key, words between blanks, number of buckets) to parcels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, keys, numbers, texts, size, buckets = _Numbers(0), [], [], [], 0, 1

        def parcels() -> pa.RecordBatch:
            return _parcels(pa.concat_arrays(keys), np.array(numbers), texts, n_max, across, buckets)

        for batch in batches:
            if not batch.num_rows:
                continue
            buckets = batch.column(2)[0].as_py()
            for i, (key, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist())):
                if not text:
                    continue
                n = len(known)
                numbers.append(known[_frozen(key)])
                if len(known) > n:
                    # Copied: a view would hold the whole batch.
                    keys.append(batch.column(0).take(pa.array([i])))
                texts.append(text)
                size += len(text)
                if size >= CHUNK_BYTES:
                    yield parcels()
                    known, keys, numbers, texts, size = _Numbers(0), [], [], [], 0
        if texts:
            yield parcels()

    return run


def packed_runs(docs: DataFrame, keys: Sequence[str], tokens: Column, text: str, n_max: int, across: Sequence[str]) -> DataFrame:
    """Parcels (bucket, keys, grams, ..): runs of ``tokens`` per bucket of (across, first two words); ``grams`` holds the
    number of n-grams of each of the parcel's keys.

    Buckets are as many as the texts and documents need.
    """
    wanted = F.greatest(
        F.lit(MIN_BUCKETS), F.ceil(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)) / BUCKET_BYTES), F.ceil(F.count("*") / BUCKET_ROWS)
    )
    buckets = docs.agg(wanted.cast("int")).scalar()
    rows = docs.select(F.struct(*keys).alias("key"), F.array_join(tokens, " ").alias("words"), buckets.alias("buckets"))
    schema = StructType([
        StructField("bucket", IntegerType()), StructField("keys", ArrayType(rows.schema["key"].dataType)), StructField("grams", ArrayType(LongType())),
        StructField("n", IntegerType()), StructField("size", IntegerType()), StructField("words", BinaryType()), StructField("runs", BinaryType()),
    ])
    return rows.mapInArrow(_packed(n_max, [list(keys).index(a) for a in across]), schema)


def _counted(n_max: int, across: list[int], names: list[str]):
    """All parcels of a bucket to its n-grams."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        of_word, of_key, of_across = _Numbers(1), _Numbers(0), _Numbers(0)
        held = pa.concat_arrays(table["keys"].chunks)
        key_rows = held.flatten()
        frozen = [_frozen(k) for k in key_rows.to_pylist()]
        # Keys of one total are neighbours.
        route = {k: of_across[tuple(k[i] for i in across)] for k in frozen}
        for k in sorted(route, key=route.__getitem__):
            of_key[k]
        key_at = np.zeros(len(of_key), np.int64)
        numbers = np.array([of_key[k] for k in frozen], np.int64)
        key_at[numbers] = np.arange(len(frozen))
        group = np.array([route[k] for k in of_key], np.int64)
        border = np.cumsum([0, *held.value_lengths().to_pylist()])
        parts = []
        for i, (n, size, words, runs) in enumerate(zip(*[table[c].to_pylist() for c in ("n", "size", "words", "runs")])):
            part = _unpacked_table(runs, n, n_max + 2 + max(1, n_max - 1))
            text = pa.decompress(words, size, CODEC, asbytes=True).split(b" ")
            lookup = np.array([0, *map(of_word.__getitem__, text)], np.int32)
            part[:n_max] = lookup[part[:n_max]]
            part[n_max] = numbers[border[i] : border[i + 1]][part[n_max]]
            parts.append(part)
        whole = np.concatenate(parts, axis=1)
        del parts, table
        words, key, tf, firsts = whole[:n_max], whole[n_max], whole[n_max + 1], whole[n_max + 2 :]
        vocabulary = pa.array(list(of_word), pa.binary()).cast(pa.string())
        single = words[1] == 0 if n_max > 1 else np.ones(len(tf), bool)
        found = []
        for length in range(1, n_max + 1):
            own = np.flatnonzero(single if length == 1 else words[length - 1] != 0)
            if not len(own):
                continue
            w = words[:length, own]
            # The key as a last word: sorted by term, then by key.
            code, _ = _codes(w, len(of_word) + 1)
            both, most = _codes([*w, key[own]], max(len(of_word) + 1, len(of_key)))
            order = _sorted(both, most)
            own, w, k = own[order], w[:, order], key[own][order]
            new = _starts(code[order])
            first = np.flatnonzero(new | _starts(k))
            total_of = np.flatnonzero(new[first] | _starts(group[k[first]]))
            sums = np.add.reduceat(tf[own].astype(np.int64), first)
            total = np.repeat(np.add.reduceat(sums, total_of), np.diff(np.r_[total_of, len(first)]))
            df = np.add.reduceat(firsts[max(0, length - 2)][own].astype(np.int64), first)
            term = [vocabulary.take(pa.array(w[i, first] - 1)) for i in range(length)]
            found.append((key_at[k[first]], term[0] if length == 1 else pc.binary_join_element_wise(*term, " "), sums, df, total))
        columns = key_rows.take(pa.array(np.concatenate([f[0] for f in found]))).flatten()
        columns += [pa.concat_arrays([f[1] for f in found]), *[pa.array(np.concatenate([f[i] for f in found])) for i in (2, 3, 4)]]
        return pa.Table.from_arrays(columns, names=names)

    return run


def counted_runs(parcels: DataFrame, keys: Sequence[str], n_max: int, across: Sequence[str]) -> DataFrame:
    """(keys, term, tf, df, _total): all n-grams of the parcels; ``_total`` is the tf of the term over all keys alike in ``across``."""
    fields = list(parcels.schema["keys"].dataType.elementType.fields)
    schema = StructType([*fields, StructField("term", StringType()), *[StructField(c, LongType()) for c in ("tf", "df", "_total")]])
    count = _counted(n_max, [list(keys).index(a) for a in across], schema.names)
    return parcels.repartition("bucket").groupBy("bucket").applyInArrow(count, schema)
