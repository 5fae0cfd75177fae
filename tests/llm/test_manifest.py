"""Merkle manifest against a plain tree built by hand."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from forumlens.llm import manifest as mf
from forumlens.llm.queries import QUERIES
from tests.llm import fixtures as fx


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes):
    """Root of a list, and per place its siblings level by level as (before, after)."""
    paths, owners = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, held = [], []
        for i in range(0, len(nodes), 8):
            run = nodes[i : i + 8]
            for j in range(len(run)):
                for o in owners[i + j]:
                    paths[o].append(("".join(run[:j]), "".join(run[j + 1 :])))
            above.append(h("".join(run)))
            held.append([o for own in owners[i : i + 8] for o in own])
        nodes, owners = above, held
    return (nodes[0] if nodes else None), paths


def fold(leaf, path):
    for left, right in path:
        leaf = h(left + leaf + right)
    return leaf


def brute(rows, tamper):
    """``rows`` are (doc_id, source, lang, n_chars, text); ``tamper`` gives the observed row."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf_of(row), row))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: (sorted(groups[g], key=lambda r: r[:3]), None) for g in order}
    trees = {g: (own, climb([r[2] for r in own])) for g, (own, _) in trees.items()}
    root, upper = climb([trees[g][1][0] for g in order])
    out = []
    for g, above in zip(order, upper):
        own, (subroot, paths) = trees[g]
        for (_, _, leaf, row), path in zip(own, paths):
            path = path + above
            found = fold(leaf_of(tamper(row)), path)
            out.append((row[0], leaf, subroot, root, h("".join(a + b for a, b in path)), found, found == root))
    return sorted(out, key=fx.sort_key)


def lowered(row):
    if row[0] is None or row[4] is None or zlib.crc32(str(row[0]).encode()) % 3:
        return row
    return (*row[:4], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row[4]))


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def observed():
    tampered = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 0
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return {"text": F.when(tampered, low).otherwise(F.col("text"))}


def table(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    # Extra columns carry names that the operator uses inside.
    return docs.withColumns({"g": F.lit("x"), "k": F.lit(1), "node": F.lit("y"), "pos": F.lit(2), "n": F.lit(3), "block": F.lit(4)})


def corpus(sizes, seed=1):
    rng = random.Random(seed)
    rows = []
    for lang, n in sizes.items():
        for _ in range(n):
            text = rng.choice([None, "", "plain", "Title Case É", "UPPER " * rng.randint(1, 9)])
            rows.append((rng.randint(0, 10**6), rng.choice([None, "a", "é"]), lang, rng.choice([None, 7]), text))
    return rows


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 2, None: 1}, {"en": 1300, "de": 513, None: 9, "": 8, "é": 1, "z": 64}, {f"l{i}": 1 for i in range(20)}])
def test_every_row_matches_brute_force(spark, sizes):
    rows = corpus(sizes)
    if len(rows) > 100:
        rows += rows[:5] * 3 + [(None, None, "en", None, None)] * 2 + [(rows[0][0], "b", "en", 1, "T")]
    got = mf.merkle_manifest(table(spark, rows), observed())
    assert fx.collected(got, COLUMNS) == brute(rows, lowered)


def test_untouched_rows_verify(spark):
    rows = corpus({"en": 70, "fr": 9})
    got = mf.merkle_manifest(table(spark, rows)).collect()
    assert len(got) == 79 and all(r["verified"] and r["folded_root"] == r["root"] for r in got)
    # Any field counts.
    other = mf.merkle_manifest(table(spark, rows), {"source": F.lit("changed")}).collect()
    assert not any(r["verified"] for r in other) and {r["root"] for r in other} == {r["root"] for r in got}
    assert mf.merkle_manifest(table(spark, rows).limit(0), observed()).count() == 0


def test_versions_share_untouched_nodes():
    leaves = [h(str(i)) for i in range(300)]
    tree = mf.PersistentTree(leaves, 3)
    before = len(tree.digests)
    versions = {i: tree.changed(tree.top, i, h(f"new {i}")) for i in (0, 7, 8, 299)}
    assert len(tree.digests) == before + 4 * (1 + 3)
    for i, top in versions.items():
        changed = list(leaves)
        changed[i] = h(f"new {i}")
        assert tree.digests[top] == climb(changed)[0]
        old, new = set(tree.children[tree.top]), set(tree.children[top])
        assert len(new - old) == 1
    # A version of a version; the first tree is unchanged.
    twice = tree.changed(versions[0], 9, h("again"))
    changed = [h("new 0"), *leaves[1:9], h("again"), *leaves[10:]]
    assert tree.digests[twice] == climb(changed)[0] and tree.digests[tree.top] == climb(leaves)[0]


def test_registered_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert fx.collected(QUERIES["op12_merkle_manifest"](spark, sf), COLUMNS) == brute(rows, lowered)
