"""Sharding, mixing, and the pipeline."""

import collections
import random
import time
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from forumlens.llm import mixture, shards
from forumlens.llm.queries import ORACLES, QUERIES
from tests.compare import connect, differences
from tests.llm import fixtures as fx

SMALL = "/root/testdata/sf0.001"


def checked_shards(df, rows, n):
    got = df.collect()
    size = lambda t: len((t or "").encode()) + 1
    crc = lambda t: zlib.crc32((t or "").encode())
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == collections.Counter(
        (k, size(t), crc(t)) for k, t, _ in rows
    )
    total, largest = collections.Counter(), max(size(t) for _, t, _ in rows)
    slots = collections.defaultdict(list)
    for r in got:
        total[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(0 <= s < n for s in slots) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    mean = sum(total.values()) / n
    assert all(abs(total[s] - mean) <= largest for s in range(n))


def test_shards_of_awkward_rows(spark):
    rows = fx.texts()
    checked_shards(shards.shard_by_bytes(fx.frame(spark, rows), 4), rows, 4)
    assert shards.shard_by_bytes(fx.empty(spark)).count() == 0


def test_shards_split_one_key_that_holds_most_rows(spark):
    rng = random.Random(1)
    rows = [(7, "x" * rng.randint(0, 300), "s") for _ in range(1500)] + [(i, "y" * rng.randint(0, 300), "s") for i in range(500)]
    checked_shards(shards.shard_by_bytes(fx.frame(spark, rows), 16), rows, 16)


def test_permutations(spark):
    for n in (1, 2, 7, 64, 1000):
        df = spark.range(n).select("id", F.lit(n).cast("long").alias("n"), F.lit(5).cast("long").alias("seed"))
        df = df.withColumn("p", mixture.permuted(F.col("id"), F.col("n"), F.col("seed")))
        df = df.withColumn("back", mixture.permuted(F.col("p"), F.col("n"), F.col("seed"), inverse=True))
        rows = df.collect()
        assert sorted(r["p"] for r in rows) == list(range(n)) and all(r["back"] == r["id"] for r in rows)


def targets_by_resharing(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    left, open_, target = float(sum(sizes.values())), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total >= 3 * sizes[s]}
        if not over:
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
        open_ -= over
        left = sum(sizes.values()) - sum(target.values())
    return {**target, **{s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}}


@pytest.mark.parametrize("block", [1, 7, 128])
def test_mix_meets_its_targets(spark, block):
    rows = fx.texts()
    rows += [(1000 + i, "w " * (3 * i), "tiny" if i < 3 else "big") for i in range(40)]
    mix = mixture.mix_sources(fx.frame(spark, rows), block=block)
    got = mix.shares().collect()
    assert collections.Counter((r["doc_id"], r["source"], r["size"]) for r in got) == collections.Counter(
        (k, s, len(fx.words(t))) for k, t, s in rows
    )
    sizes, taken, target = collections.Counter(), collections.Counter(), {}
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    want = targets_by_resharing(sizes)
    for s in sizes:
        assert abs(target[s] - want[s]) < 1e-6 * max(1, want[s])
        assert abs(taken[s] - want[s]) <= 0.5 + 1e-6
        assert {r["source_size"] for r in got if r["source"] == s} == {sizes[s]}
    slots = mix.slots.collect()
    assert len({(r["shard"], r["slot"]) for r in slots}) == len(slots)
    assert sum(r["words"] for r in slots) == sum(taken.values())
    again = fx.collected(mixture.mix_sources(fx.frame(spark, rows).repartition(7), block=block).shares(), ["doc_id", "size", "taken"])
    distinct = {x for x in again if [y[:2] for y in again].count(x[:2]) == 1}
    assert distinct <= {(r["doc_id"], r["size"], r["taken"]) for r in got}


def test_mixed_documents_hold_the_words_taken(spark):
    rows = fx.texts() + [(1000 + i, f"only {i} words here", "tiny") for i in range(5)]
    frame = fx.frame(spark, rows)
    mix = mixture.mix_sources(frame, block=16)
    out = mix.documents()
    assert out.columns == frame.columns
    taken, held = collections.Counter(), collections.Counter()
    for r in mix.shares().collect():
        taken[r["doc_id"], r["source"]] += r["taken"]
    texts = collections.defaultdict(set)
    for k, t, s in rows:
        texts[k, s] |= set(fx.words(t))
    for r in out.collect():
        w = fx.words(r["text"])
        held[r["doc_id"], r["source"]] += len(w)
        assert set(w) <= texts[r["doc_id"], r["source"]]
    assert +held == +taken


def test_mix_of_many_equal_rows(spark):
    """A row repeated 30,000 times is bunches of bounded size; words come from the right places of its copies."""
    copies, others = 30_000, [(200 + i, f"a{i} b{i} c{i}", "s0") for i in range(50)] + [(100, "x " * 4000, "s1")]
    hot = spark.range(copies).select(F.lit(7).alias("doc_id"), F.lit("one two three four five six seven").alias("text"), F.lit("s1").alias("source"))
    docs = hot.unionByName(spark.createDataFrame(others, "doc_id int, text string, source string"))
    mixture.mix_sources(docs.where("doc_id > 7"), block=16).documents().count()  # classes are loaded and compiled
    begin = time.time()
    mix = mixture.mix_sources(docs, block=16)
    assert mix.places.agg(F.max("_copies")).first()[0] <= mixture.BUNCH_ROWS
    shares = mix.shares().where("doc_id = 7").groupBy("taken").count().collect()
    out = mix.documents().where("doc_id = 7").collect()
    assert time.time() - begin < 20
    assert sum(r["count"] for r in shares) == copies and max(r["taken"] for r in shares) <= 21
    held = [fx.words(r["text"]) for r in out]
    assert sum(map(len, held)) == sum(r["taken"] * r["count"] for r in shares)
    # Position by position against the stream of copies written out.
    line = "one two three four five six seven".split()
    bunches = mix.pieces.where("_key = 7 and _n > 0").groupBy("_bunch").agg(
        F.sort_array(F.collect_list(F.struct("_from", "_n"))).alias("r")).collect()
    want = collections.Counter(" ".join(line[(f + j) % 7] for f, n in b["r"] for j in range(n)) for b in bunches)
    passes = mix.pieces.where("_key = 7").first()["_passes"]
    got = collections.Counter(r["text"] for r in out)
    got[" ".join(line)] -= passes * copies
    assert +got == want


def test_mix_of_nothing(spark):
    mix = mixture.mix_sources(fx.empty(spark))
    assert mix.shares().count() == 0 and mix.slots.count() == 0 and mix.documents().count() == 0
    blank = mixture.mix_sources(fx.frame(spark, [(1, " ", "a"), (2, None, None)]))
    assert [tuple(r) for r in blank.shares().select("size", "target", "taken").collect()] == [(0, 0.0, 0)] * 2


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, con, key):
    if key in ORACLES:
        assert differences(spark, con, QUERIES[key], ORACLES[key], SMALL) == ""
    else:
        assert QUERIES[key](spark, SMALL).count() == 200


def test_pipeline_on_awkward_rows(spark, tmp_path):
    fx.frame(spark, fx.texts()).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(i % 5 > 0), 0) for i in range(30)] + [(None, 1, 0), (2, None, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert docs.count() > 0 and corpus_pipeline.run(spark, str(tmp_path)).count() > 0


def test_pipeline_of_nothing(spark, tmp_path):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = fx.empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.count() == 0


def test_pipeline_keeps_one_of_each_group_and_clean_documents(spark):
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    good = stages["quality_rules"](spark, docs, SMALL)
    kept = stages["near_dedup"](spark, good, SMALL)
    rows = [(r["doc_id"], r["text"], None) for r in good.collect()]
    from tests.llm.test_duplicates import brute_components

    want = {r[2] for r in brute_components(rows)}
    assert {r["doc_id"] for r in kept.collect()} == want
