"""Filter audit against a plain run of every order, and the byte transducer against regular expressions."""

import collections
import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from forumlens.llm import filter_audit as fa
from tests.llm import fixtures as fx


def audit(rows, labels):
    """Applies the filters in every order, document by document."""
    rows = [(k, t or "", s or "") for k, t, s in rows]
    low = lambda k: (k is not None, k or 0)
    first = {}
    for k, t, _ in rows:
        first[t] = min(first.get(t, low(k)), low(k))
    fails = []
    for k, t, s in rows:
        w = fx.words(t)
        fails.append({
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": first[t] < low(k),
        })
    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, x in labels if x == 1 and k is not None}
    out, shapley = {}, collections.Counter()
    for part in {s for _, _, s in rows}:
        own = [(k, f) for (k, _, s), f in zip(rows, fails) if s == part]
        for order in itertools.permutations("ABCDE"):
            left, gone = own, []
            for i, x in enumerate(order):
                cut = [r for r in left if r[1][x]]
                left = [r for r in left if not r[1][x]]
                shapley[part, x] += len(cut)
                unique = sum(1 for _, f in own if f[x] and sum(f.values()) == 1)
                out[part, "".join(order), i + 1] = [
                    len(left), len(cut), sum(f[x] for _, f in gone), unique, sum(k in good for k, _ in cut), sum(k in toxic for k, _ in cut),
                ]
                gone += cut
    return sorted((*at, *row, shapley[at[0], at[1][at[2] - 1]]) for at, row in out.items())


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def rows():
    out = fx.texts()
    out += [(k, "short copy", f"s{k % 3}") for k in range(100, 130)] + [(101, "short copy", "s2")] * 3
    return out + [(200, "word " * 300, "s1"), (201, "Big Words " * 150, None), (None, "short copy", "s1"), (202, "", "s0"), (203, "a|b", "s0")]


def test_every_order_matches_brute_force(spark):
    labels = [(k, k % 2, k % 5 == 0) for k in range(0, 210, 3)] + [(3, 1, 1), (3, 0, 0), (None, 1, 1), (100, None, None)]
    said = spark.createDataFrame([(k, q, int(x) if x is not None else None) for k, q, x in labels], "doc_id long, quality int, toxic int")
    got = fa.audit_filters(fx.frame(spark, rows()), said.withColumn("n", F.lit(1)))
    assert fx.collected(got, COLUMNS) == audit(rows(), labels)
    none = fa.audit_filters(fx.frame(spark, rows()), said.limit(0))
    assert fx.collected(none, COLUMNS) == audit(rows(), [])
    assert fa.audit_filters(fx.empty(spark), said).count() == 0


def test_counts_of_texts():
    texts = [t for _, t, _ in rows()] + ["x" * 700 + " " + "x" * 700 + " " + "x" * 699 + "y", "12345678 123456789 12345678", "é é É\x0b\x00 \x00"]
    got = np.stack(fa.text_counts(pa.array(texts)), axis=1).tolist()
    for text, counts in zip(texts, got):
        w, t = fx.words(text), text or ""
        assert counts == [len(w), len(set(w)), len(re.findall("[A-Z]", t)), len(t), len(re.findall(r"[#$%&*|]", t))]


def test_spans_of_one_hash_are_told_apart(monkeypatch):
    # Every span has the same hash: the bytes alone decide.
    monkeypatch.setattr(fa, "span_hashes", lambda raw, eights, start, size, group: np.zeros(len(start), np.uint64))
    texts = ["a b a c b a", "a b", "b" * 300 + " " + "b" * 300 + " " + "b" * 299 + "c", "", None]
    assert fa.text_counts(pa.array(texts))[1].tolist() == [3, 2, 2, 0, 0]
