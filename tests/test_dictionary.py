"""Large ordered dictionaries against the fold they stand for."""

import random
import time

import pytest

from forumlens.functions import text as tx
from forumlens.functions.dictionary import OrderedPairs, replace_large


def fold(text, pairs, pad):
    for k, v in pairs:
        if k:
            text = text.replace(k, f" {v} " if pad else v)
    return text


@pytest.mark.parametrize("pad", [True, False])
@pytest.mark.parametrize("letters", ["ab", "ab :", "abcdefgh"])
def test_equal_to_the_fold(letters, pad):
    rng = random.Random(letters)
    word = lambda n: "".join(rng.choice(letters) for _ in range(rng.randint(0, n)))
    for _ in range(300):
        # Prefixes, repeated keys, empty keys and values, values that complete later keys.
        pairs = [(word(4), word(5)) for _ in range(rng.randint(1, 30))]
        text = word(60)
        if len(fold(text, pairs, pad)) < 50_000:
            assert OrderedPairs(pairs, pad).apply(text) == fold(text, pairs, pad)


def test_column_and_nulls(spark):
    pairs = [(f"k{i}", f"k{i + 1}") for i in range(500)]
    texts = ["k0 k499", "", None, "k1k1", "nothing"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r["v"] for r in df.select("i", replace_large(df["t"], pairs).alias("v")).orderBy("i").collect()]
    assert got == [None if t is None else fold(t, pairs, True) for t in texts]
    same = [r["v"] for r in df.select("i", tx.replace_in_order(df["t"], pairs).alias("v")).orderBy("i").collect()]
    assert got == same
    assert [r["v"] for r in df.select("i", replace_large(df["t"], []).alias("v")).orderBy("i").collect()] == texts


def test_time_does_not_grow_with_the_pairs():
    rng = random.Random(1)
    text = " ".join("".join(rng.choice("abcdef") for _ in range(6)) for _ in range(3000))
    few = [("abc", "x"), ("def", "y")]

    def seconds(pairs):
        compiled = OrderedPairs(pairs, True)
        return min(_timed(compiled, text) for _ in range(5))

    many = few + [(f"zz{i}", "v") for i in range(20_000)]
    assert OrderedPairs(many, True).apply(text) == fold(text, few, True)
    assert seconds(many) < 5 * seconds(few) + 0.01


def _timed(compiled, text):
    start = time.perf_counter()
    compiled.apply(text)
    return time.perf_counter() - start
