"""Topic operators against brute force and known results."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from forumlens.operators import clusters, coherence, ngrams, sweep, topics


def test_ngrams_and_document_frequency(spark):
    df = spark.createDataFrame([("a", "The cat sat, the cat"), ("a", "cat x")], "category string, text string")
    got = {r["term"]: (r["tf"], r["df"]) for r in topics.ngram_counts(df, ["category"], "text", ["the"]).collect()}
    assert got["cat"] == (3, 2)
    assert got["cat sat"] == (1, 1) and got["cat sat cat"] == (1, 1) and got["sat cat"] == (1, 1)
    assert "x" not in got and "the" not in got and len(got) == 5


def brute_coherence(docs, lists, window):
    windows = []
    for doc in docs:
        tokens = doc.split()
        windows += [set(tokens[i : i + window]) for i in range(max(1, len(tokens) - window + 1))]
    n = len(windows)
    p = lambda *ws: sum(all(w in s for w in ws) for s in windows) / n

    def npmi(a, b):
        pa, pb, pab = p(a), p(b), p(a, b)
        return 0.0 if pa == 0 or pb == 0 else math.log((pab + 1e-12) / (pa * pb)) / -math.log(pab + 1e-12)

    out = []
    for words in lists:
        m = np.array([[npmi(a, b) for b in words] for a in words])
        t = m.sum(axis=0)
        sizes = [np.linalg.norm(r) * np.linalg.norm(t) for r in m]
        out.append(float(np.mean([r @ t / s if s else 0.0 for r, s in zip(m, sizes)])))
    return out


@pytest.mark.parametrize("window", [3, 10, 110])
def test_coherence_equals_explicit_windows(spark, window):
    rnd = random.Random(window)
    docs = [" ".join(rnd.choice("abcdefgh") for _ in range(rnd.choice([1, 2, 9, 30, 130]))) for _ in range(25)] + [""]
    lists = [["a", "b", "c", "d"], ["e", "f"], ["a", "zz", "h"]]
    df = spark.createDataFrame([(i, "k", d) for i, d in enumerate(docs)], "doc_id int, category string, text string").repartition(3)
    words = spark.createDataFrame([("k", i, w) for i, w in enumerate(lists)], "category string, topic int, words array<string>")
    got = {r["topic"]: r["coherence"] for r in coherence.coherence_cv(df, words, "doc_id", "text", window).collect()}
    assert [got[i] for i in range(3)] == pytest.approx(brute_coherence(docs, lists, window), abs=1e-9)


def test_pair_coherence(spark):
    lists = [["a", "b", "c"], ["b", "c", "d"], ["x", "y", "b"], ["q"]]
    keywords = spark.createDataFrame([(i, w) for i, w in enumerate(lists)], "node int, words array<string>")
    pairs = spark.createDataFrame([(0, 1), (0, 2), (3, 3)], "src int, dst int")
    got = {(r["src"], r["dst"]): r["coherence"] for r in coherence.pair_coherence(pairs, keywords).collect()}
    docs = [" ".join(w) for w in lists]
    union = lambda i, j: list(dict.fromkeys(lists[i] + lists[j]))
    assert got[0, 1] == pytest.approx(brute_coherence(docs, [union(0, 1)], 110)[0], abs=1e-9)
    assert got[0, 2] == pytest.approx(brute_coherence(docs, [union(0, 2)], 110)[0], abs=1e-9)
    assert got[3, 3] == 0.0


def test_class_tfidf(spark):
    rows = [("k", 0, "a", 4), ("k", 0, "b", 1), ("k", 1, "a", 2), ("k", 1, "c", 8)]
    counts = spark.createDataFrame(rows, "category string, topic int, term string, tf bigint")
    got = {(r["topic"], r["term"]): r["weight"] for r in topics.class_tfidf(counts).collect()}
    assert got[0, "a"] == pytest.approx(math.sqrt(4 / 5) * math.log(1 + 7 / 6))
    assert got[1, "c"] == pytest.approx(math.sqrt(8 / 10) * math.log(1 + 7 / 8))


def test_mmr_prefers_diverse_terms(spark):
    rows = [("k", 0, "a", 3.0, [1.0, 0.0]), ("k", 0, "a2", 2.0, [0.999, 0.01]), ("k", 0, "b", 1.0, [0.6, 0.8])]
    candidates = spark.createDataFrame(rows, "category string, topic int, term string, weight double, vector array<double>")
    centre = spark.createDataFrame([("k", 0, [1.0, 0.2])], "category string, topic int, centroid array<double>")
    chosen = lambda diversity: [r["term"] for r in topics.mmr_terms(candidates, centre, diversity, 2).orderBy("rank").collect()]
    assert chosen(0.0) == ["a", "a2"]
    assert chosen(0.7) == ["a2", "b"] or chosen(0.7) == ["a", "b"]


def test_silhouette_equals_the_library(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(120, 6))
    rows = [("k", int(i % 4), [float(v) for v in row]) for i, row in enumerate(x)]
    df = spark.createDataFrame(rows, "category string, topic int, embedding array<double>")
    mine = clusters.silhouette_cosine(df).first()["silhouette"]
    prepared = df.select(array_to_vector("embedding").alias("features"), F.col("topic").cast("double").alias("prediction"))
    assert mine == pytest.approx(ClusteringEvaluator(distanceMeasure="cosine").evaluate(prepared), abs=1e-9)
    assert clusters.silhouette_cosine(df.where("topic = 1")).first()["silhouette"] == 0.0


def test_planted_clusters_and_noise(spark):
    """Three tight groups, one of them with most rows in a single cell, and scattered points."""
    rnd = random.Random(4)
    rows = [(i, "k", [0.05 + rnd.uniform(-0.02, 0.02), 0.05 + rnd.uniform(-0.02, 0.02)]) for i in range(400)]
    rows += [(400 + i, "k", [2 + rnd.uniform(-0.1, 0.1), 2 + rnd.uniform(-0.1, 0.1)]) for i in range(60)]
    rows += [(500 + i, "k", [-3 + rnd.uniform(-0.1, 0.1), 1 + rnd.uniform(-0.1, 0.1)]) for i in range(50)]
    rows += [(600 + i, "k", [10.0 + 3 * i, -10.0 - 3 * i]) for i in range(20)]
    df = spark.createDataFrame(rows, "id int, category string, reduced array<double>")
    got = {r["id"]: r["topic"] for r in clusters.density_clusters(df, 0.2, 5, 20, dims=2).collect()}
    assert {got[i] for i in range(400)} == {0}
    assert {got[i] for i in range(400, 460)} == {1}
    assert {got[i] for i in range(500, 550)} == {2}
    assert {got[i] for i in range(600, 620)} == {-1}
    assert Counter(r["topic"] for r in clusters.density_clusters(df, 0.2, 5, 55, dims=2).collect())[-1] == 70


def test_connected_components_of_a_long_chain(spark):
    nodes = spark.range(60).select(F.format_string("%03d", "id").alias("id"))
    chain = [(f"{i:03d}", f"{i + 1:03d}") for i in range(59) if i != 30]
    edges = spark.createDataFrame(chain + [(b, a) for a, b in chain], "src string, dst string")
    got = {r["id"]: r["component"] for r in clusters.connected_components(nodes, edges).collect()}
    assert {got[f"{i:03d}"] for i in range(31)} == {"000"} and {got[f"{i:03d}"] for i in range(31, 60)} == {"031"}


def test_rounds_of_components_do_not_square_the_size_estimate(spark):
    """Planning the ninth round of a flow over 0.1 GB took minutes."""
    edges = [(i, i + 1) for i in range(100)]
    edges = spark.createDataFrame(edges + [(b, a) for a, b in edges], "src long, dst long")
    out = clusters.connected_components(spark.range(101), edges)
    assert {r["component"] for r in out.collect()} == {0}
    assert out._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 1 << 64


def test_membership_and_reassignment(spark):
    df = spark.createDataFrame([(1, "k", -1, [1.0, 0.0]), (2, "k", 1, [1.0, 0.0]), (3, "k", -1, [1.0, 1.0])], "id int, category string, topic int, embedding array<double>")
    centres = spark.createDataFrame([("k", 0, [0.0, 1.0]), ("k", 1, [1.0, 0.0]), ("k", -1, [5.0, 5.0])], "category string, topic int, centroid array<double>")
    out = {r["id"]: r for r in clusters.reassign_outliers(clusters.membership_probs(df, centres), 0.6).collect()}
    odds = math.exp(1 / clusters.TEMPERATURE)
    assert out[1]["probs"] == pytest.approx([1 / (1 + odds), odds / (1 + odds)])
    assert (out[1]["new_topic"], out[2]["new_topic"], out[3]["new_topic"]) == (1, 1, -1)


def test_grid_and_seeded_sample(spark):
    configs = sweep.grid(spark)
    assert configs.count() == 420
    assert {r["config"] for r in configs.collect()} == set(range(420))
    once = [r["config"] for r in sweep.sampled(configs).collect()]
    again = [r["config"] for r in sweep.sampled(configs.repartition(7)).collect()]
    assert once == again and len(set(once)) == 100
    assert once != [r["config"] for r in sweep.sampled(configs, seed=1).collect()]


def test_category_settings_with_defaults(spark):
    found = spark.createDataFrame([("Anxiety",), ("Other",)], "category string")
    settings = spark.createDataFrame(topics.CATEGORY_SETTINGS, topics.SETTINGS_SCHEMA)
    got = {r["category"]: r["max_df"] for r in topics.category_config(found, settings, {"min_df": 1, "max_df": 0.9}).collect()}
    assert got == {"Anxiety": 0.5, "Other": 0.9}


def test_sweep_counts_follow_moved_documents(spark):
    rows = [(1, "k", "x y", 0), (2, "k", "aa bb", 0), (3, "k", "aa cc", 1), (4, "k", "cc", 1), (5, "k", "dd aa", 1)]
    docs = spark.createDataFrame(rows, "doc_id int, category string, text string, cell int")
    labels = spark.createDataFrame([(0, "k", 0, 7), (0, "k", 1, -1), (1, "k", 0, -1), (1, "k", 1, 3)], "shape int, category string, cell int, topic int")
    moved = spark.createDataFrame([(3, 0, 7), (2, 1, 3)], "doc_id int, shape int, new_topic int")
    per_cell = topics.ngram_counts(docs, ["category", "cell"], "text")
    got = sweep.topic_term_counts(docs, per_cell, labels, moved, [])
    direct = (
        docs.join(labels, ["category", "cell"]).join(moved, ["doc_id", "shape"], "left")
        .withColumn("topic", F.coalesce("new_topic", "topic"))
    )
    direct = topics.ngram_counts(direct, ["shape", "category", "topic"], "text").drop("df")
    rows_of = lambda df: sorted(map(tuple, df.select("shape", "topic", "term", "tf").collect()))
    assert rows_of(got) == rows_of(direct)


def test_sweep_scores_every_configuration(spark):
    rng = np.random.default_rng(8)
    centres = np.eye(6)[:3]
    rows = []
    for i in range(150):
        v = centres[i % 3] + rng.normal(scale=0.05, size=6)
        rows.append((i, "ab"[i % 2], " ".join(f"w{i % 3}{rng.integers(6)}" for _ in range(12)), [float(x) for x in v]))
    docs = spark.createDataFrame(rows, "doc_id int, category string, text string, embedding array<double>")
    configs = sweep.grid(spark, [0.5, 1.0], [10, 40], [5])
    scores = sweep.parameter_sweep(docs, configs, eps=0.3, dims=2).collect()
    assert {(r["category"], r["config"]) for r in scores} == {(c, n) for c in "ab" for n in range(4)}
    by = {(r["category"], r["config"]): r for r in scores}
    # Three groups of 25 per category: found with clusters of 10, lost with clusters of 40.
    assert by["a", 0]["silhouette"] > 0.8 and by["a", 1]["silhouette"] == 0.0
    assert all(r["combined_score"] == pytest.approx((r["coherence"] + r["diversity"] + r["silhouette"]) / 3) for r in scores)


@pytest.mark.parametrize("n_max", [1, 2, 3, 4])
def test_ngram_counts_equal_a_plain_count(spark, n_max):
    rnd = random.Random(n_max)
    texts = [" ".join(rnd.choice(["aa", "ab", "abc", "b_1", "éé"]) for _ in range(rnd.choice([0, 1, 2, 3, 4, 9, 40]))) for _ in range(30)]
    rows = [(i % 2, i % 3 or None, t) for i, t in enumerate(texts)] + [(0, 1, None)]
    docs = spark.createDataFrame(rows, "category int, topic int, text string")
    tf, df = Counter(), Counter()
    for c, t, text in rows:
        w = (text or "").split()
        grams = [" ".join(w[i : i + n]) for n in range(1, n_max + 1) for i in range(len(w) - n + 1)]
        tf.update((c, t, g) for g in grams)
        df.update((c, t, g) for g in set(grams))
    got = topics.ngram_counts(docs, ["category", "topic"], "text", n_max=n_max).collect()
    assert {(r["category"], r["topic"], r["term"]): (r["tf"], r["df"]) for r in got} == {k: (n, df[k]) for k, n in tf.items()}
    assert len(got) == len(tf)
    # The weights without written counts are the weights of the counts.
    plain = topics.class_tfidf(spark.createDataFrame(got)).collect()
    weights = topics.document_tfidf(docs, "text", n_max=n_max)
    key = lambda r: (r["category"], r["topic"], r["term"], r["tf"])
    assert {key(r): r["weight"] for r in weights.collect()} == pytest.approx({key(r): r["weight"] for r in plain})
    plan = weights._jdf.queryExecution().toString().split("== Initial Plan ==")[0]
    # Documents travel as runs of words once; no second shuffle for the totals.
    assert plan.count("Exchange hashpartitioning") == 1 and "REPARTITION_BY_COL" in plan


@pytest.mark.parametrize("n_max", [1, 3, 5])
def test_parcels_of_many_chunks_give_a_plain_count(monkeypatch, n_max):
    """Several chunks, keys in any order and repeated, lists and nulls in keys, and codes too large to be sorted with their places."""
    monkeypatch.setattr(ngrams, "CHUNK_BYTES", 900)
    rnd = random.Random(n_max)
    rows = [({"a": rnd.choice(["x", "y", None]), "b": [rnd.randrange(2)]}, " ".join(f"w{int(rnd.expovariate(0.2))}" for _ in range(rnd.choice([0, 1, 2, 30])))) for _ in range(90)]
    kind = pa.struct([("a", pa.string()), ("b", pa.list_(pa.int64()))])
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows]), pa.array([3] * len(rows), pa.int32())], names=["key", "words", "buckets"])
    parcels = pa.Table.from_batches(list(ngrams._packed(n_max, [0])(iter([batch.slice(0, 40), batch.slice(40)]))))
    tf, df, total, sizes = Counter(), Counter(), Counter(), Counter()
    for key, text in rows:
        w, k = text.split(), ngrams._frozen(key)
        grams = [" ".join(w[i : i + n]) for n in range(1, n_max + 1) for i in range(len(w) - n + 1)]
        tf.update((k, g) for g in grams)
        df.update((k, g) for g in set(grams))
        total.update((k[0], g) for g in grams)
        sizes[k] += len(grams)
    stated, got = Counter(), {}
    for keys, grams in zip(parcels["keys"].to_pylist(), parcels["grams"].to_pylist()):
        for k, n in zip(keys, grams):
            stated[ngrams._frozen(k)] += n
    for bucket in set(parcels["bucket"].to_pylist()):
        own = parcels.filter(pa.array([b == bucket for b in parcels["bucket"].to_pylist()]))
        for r in ngrams._counted(n_max, [0], ["a", "b", "term", "tf", "df", "total"])(own).to_pylist():
            k = ((r["a"], tuple(r["b"])), r["term"])
            assert k not in got
            got[k] = (r["tf"], r["df"], r["total"])
    assert len(parcels) > 6 and +stated == +sizes
    assert got == {k: (n, df[k], total[k[0][0], k[1]]) for k, n in tf.items()}
    wide = np.array([5, 2**40, 5, 7, 2**40])
    assert ngrams._sorted(wide, 2**62).tolist() == ngrams._sorted(wide, 2**41).tolist() == [0, 2, 3, 1, 4]
    code, most = ngrams._codes([wide, wide[::-1], wide], 2**41)
    assert ngrams._sorted(code, most).tolist() == [2, 0, 3, 4, 1] and most < 2**63


def test_top_terms_keep_few_rows_before_they_sort(spark):
    rows = [("a", t, f"{i:03d}", round(1.0 - (i // 7) / 50, 3) + i % 2 * 1e-14, i) for t in (None, 1) for i in range(200)]
    weights = spark.createDataFrame(rows, "category string, topic int, term string, weight double, tf int").repartition(7)
    out = topics.top_terms(weights, k=10)
    assert {(r["topic"], r["term"], r["tf"], r["rank"]) for r in out.collect()} == {(t, f"{i:03d}", i, i + 1) for t in (None, 1) for i in range(10)}
    assert out.columns == [*weights.columns, "rank"]
    assert "partial_collect_top_k" in out._jdf.queryExecution().toString()


def test_windows_of_a_long_text_are_counted_in_parts(spark, monkeypatch):
    rnd = random.Random(3)
    tokens = [rnd.choice("abcdefgh") for _ in range(700)]
    at = [(i, "abc".index(w)) for i, w in enumerate(tokens) if w in "abc"]
    pos, word = (np.array(c) for c in zip(*at))
    for cells in (1, 7, 1 << 20):
        monkeypatch.setattr(coherence, "CELLS", cells)
        got = coherence._joint_windows(pos, word, 3, len(tokens), 5)
        sets = [set(tokens[i : i + 5]) for i in range(len(tokens) - 4)]
        assert got.tolist() == [[sum(a in s and b in s for s in sets) for b in "abc"] for a in "abc"]


def test_a_pair_of_words_is_counted_once_for_all_topics(spark):
    docs = spark.createDataFrame([(1, "k", "a b c a"), (1, "k", "a b c a"), (2, "k", "b d"), (3, None, "a b")], "doc_id int, category string, text string")
    lists = spark.createDataFrame([("k", t, ["a", "b"] if t < 50 else ["c", "d"]) for t in range(52)], "category string, topic int, words array<string>")
    counted = coherence.window_counts(docs, lists, "doc_id", "text")
    plan = counted._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "MapInArrow" in plan and "Generate explode_outer" not in plan
    got = {(r["topic"], r["w1"], r["w2"]): r["n"] for r in counted.collect()}
    assert got[0, "a", "a"] == 1 and got[49, "a", "b"] == 1 and got[7, "b", "b"] == 2 and got[51, "c", "c"] == 1
    assert (51, "c", "d") not in got and len(got) == 50 * 3 + 2 * 2
