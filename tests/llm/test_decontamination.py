"""Benchmark windows in documents against brute force, and suffix arrays against plain sorting."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from forumlens.llm import decontamination as dc
from tests.llm import fixtures as fx

SPLIT = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_words(text):
    return SPLIT.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


test_words.__test__ = False


def brute(docs, items, window=10):
    out, wanted = [], {}
    for name, body in items:
        b = test_words(body)
        n = min(window, len(b))
        for i in range(len(b) - n + 1 if n else 0):
            wanted.setdefault(n, {}).setdefault(tuple(b[i : i + n]), set()).add(name)
    for key, text, _ in docs:
        w = test_words(text)
        hit, names = [False] * len(w), set()
        for n, of in wanted.items():
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in of:
                    hit[i : i + n] = [True] * n
                    names |= {str(x) for x in of[tuple(w[i : i + n])] if x is not None}
        out.append((key, len(w), sum(hit), len(names), sorted(names), any(hit)))
    return sorted(out, key=fx.sort_key)


def items():
    texts = [t for _, t, _ in fx.texts()]
    words = test_words(texts[0])
    return [
        (1, texts[0]), (2, " ".join(words[3:20]).upper()), (2, " ".join(words[3:20]).upper()), (10, texts[1] + " tail of its own"),
        (11, "two words"), (12, "one"), (13, ""), (14, None), (None, texts[2]), (15, "ha " * 11), (16, "ha " * 4), (17, "nowhere at all"),
        (18, " ".join(test_words(texts[-6])[:3000]) if len(test_words(texts[-6])) > 3000 else texts[3]), (3, texts[0]), (19, "É" * 250), (20, "é" * 250),
    ]


COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items", "contaminated"]


@pytest.mark.parametrize("block_bytes", [1 << 20, 600])
def test_hits_match_brute_force(spark, block_bytes, monkeypatch):
    rows = fx.texts()
    bench = spark.createDataFrame(items(), "item_id long, text string").withColumn("k", F.lit(1))
    if block_bytes < 1000:
        assert len(list(dc.test_blocks(bench, "item_id", "text", 10, block_bytes))) > 1
    got = dc.benchmark_hits(fx.frame(spark, rows), bench, block_bytes=block_bytes)
    assert fx.collected(got, COLUMNS) == brute(rows, items())


def test_nothing(spark):
    bench = spark.createDataFrame(items(), "item_id long, text string")
    assert dc.benchmark_hits(fx.empty(spark), bench).count() == 0
    got = dc.benchmark_hits(fx.frame(spark, fx.texts()), bench.limit(0))
    assert {(r["n_hit"], r["n_items"], r["contaminated"], r["longest"]) for r in got.collect()} == {(0, 0, False, 0)}


def test_affected_rows_go(spark):
    rows = fx.texts()
    bench = spark.createDataFrame(items(), "item_id long, text string")
    docs = fx.frame(spark, rows)
    left = dc.decontaminate(docs, bench)
    assert left.columns == docs.columns
    clean = [(k, t) for (k, t, _) in rows if not brute([(k, t, None)], items())[0][-1]]
    assert fx.collected(left, ["doc_id", "text"]) == sorted(clean, key=fx.sort_key)


def test_suffixes_are_sorted_and_found():
    rng = np.random.default_rng(4)
    # Few words make long ties; some words are unknown.
    texts = [[b"w%d" % x for x in rng.integers(0, 4, n)] for n in (0, 1, 5, 200, 80)]
    texts += [texts[3][20:120], texts[3], [b"w1"] * 90]
    numbers = {b"w1": 1, b"w2": 2, b"w3": 3}
    tokens = dc.Tokens.of(texts, numbers)
    depth = 200
    array = dc.SuffixArray(tokens, 2, depth)

    def suffix(ids, at):
        out = []
        while ids[at]:
            out.append(int(ids[at]))
            at += 1
        return out

    got = [suffix(tokens.ids, p) for p in array.order]
    assert got == sorted(got) and sorted(array.order.tolist()) == np.flatnonzero(tokens.ids).tolist()
    test = dc.SuffixArray(dc.Tokens.of([texts[3][10:70], [b"w3"] * 12 + [b"w2"], [b"w2", b"w2", b"w1"]], numbers), 2, depth)
    starts = np.flatnonzero(test.tokens.ids)
    length, place = array.longest(test, starts)
    for s, n, p in zip(starts, length, place):
        mine = suffix(test.tokens.ids, s)
        common = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert n == max(common(mine, g) for g in got) == common(mine, suffix(tokens.ids, p))
        for size in (1, 3, 10, 40):
            if len(mine) >= size:
                low, high = array.windows(test, np.array([s]), np.array([size]))
                assert [i for i, g in enumerate(got) if g[:size] == mine[:size]] == list(range(low[0], high[0]))


def test_longest_matches(spark):
    rows = fx.texts()
    bench = spark.createDataFrame(items(), "item_id long, text string")
    got = {r["item_id"]: r for r in dc.longest_matches(fx.frame(spark, rows), bench).collect()}
    assert got["17"]["n_words"] < 3 if "17" in got else True
    for name, text in items():
        w = test_words(text)
        if name in (1, 10, 15, 16, 11, 20):
            best = max(
                n for n in range(1, len(w) + 1)
                if any(f" {' '.join(w[i : i + n])} " in f" {' '.join(test_words(t))} " for _, t, _ in rows for i in range(len(w) - n + 1))
            )
            assert got[str(name)]["n_words"] == best
            r = got[str(name)]
            assert any(
                " ".join(test_words(t)[r["first_word"] : r["first_word"] + best]) in " ".join(w) for k, t, _ in rows if k == r["doc_id"]
            )


def test_long_items_go_in_pieces(spark, monkeypatch):
    rng = np.random.default_rng(9)
    body = " ".join(f"v{x}" for x in rng.integers(0, 500, 5000))
    docs = spark.createDataFrame([(1, body, None), (2, body[200:9000], None), (3, "v1 v2 v3", None)], "doc_id long, text string, source string")
    bench = spark.createDataFrame([(7, body)], "item_id long, text string")
    got = fx.collected(dc.benchmark_hits(docs, bench, block_bytes=8000), COLUMNS)
    assert got == brute([tuple(r) for r in docs.collect()], [(7, body)])
