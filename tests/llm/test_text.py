"""Quality rules, pieces, fingerprints, preferences."""

import collections
import hashlib
import itertools
import random
import re
from array import array

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from forumlens.llm import fingerprints as fp
from forumlens.llm import line_labels as ll
from forumlens.llm.pieces import PieceModel, default_model, encode_texts
from forumlens.llm.preferences import format_preferences
from tests.llm import fixtures as fx

SF = "/root/testdata/sf0.01"


def base_counts(text):
    w = fx.words(text)
    at = collections.defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i : i + 8])].append(i)
    again = bytearray(len(w))
    for places in at.values():
        if len(places) > 1:
            for i in places:
                again[i : i + 8] = b"\1" * 8
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if fx.words(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 20 or 100 * sum(again) > 30 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, sum(again), failed


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_counts_match_brute_force(spark):
    rows = fx.texts()
    field = ll.Field(np.zeros((ll.OFFSETS[-1], 2)), np.zeros((2, 2)))
    got = fx.collected(ll.label_lines(fx.frame(spark, rows), field), ["doc_id", *COUNTS])
    assert got == sorted([(k, *base_counts(t)) for k, t, _ in rows], key=fx.sort_key)
    assert ll.label_lines(fx.empty(spark), field).count() == 0
    assert ll.keep_good(fx.empty(spark), field).count() == 0
    kept = fx.collected(ll.keep_good(fx.frame(spark, rows), field, min_share=0.0), ["doc_id", "text"])
    assert kept == sorted([(k, t) for k, t, _ in rows if not base_counts(t)[-1]], key=fx.sort_key)


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(3)
    field = ll.Field(rng.normal(size=(ll.OFFSETS[-1], 2)), rng.normal(size=(2, 2)))
    n_lines = np.array([1, 4, 0, 7, 2])
    top = np.diff(ll.OFFSETS)
    features = rng.integers(0, top, (n_lines.sum(), len(top))).astype(np.int8)
    got, scores, at = ll.viterbi(field, features, n_lines), field.scores(features.astype(np.int64)), 0
    for n in n_lines:
        best = max(
            itertools.product((0, 1), repeat=int(n)),
            key=lambda p: sum(scores[at + i, s] for i, s in enumerate(p)) + sum(field.move[a, b] for a, b in zip(p, p[1:])),
        )
        assert tuple(got[at : at + n]) == best
        at += n


def test_training_raises_the_likelihood_of_a_planted_chain():
    rng = np.random.default_rng(5)
    n_lines = np.full(60, 12)
    state = (np.repeat(rng.integers(0, 2, 60 * 3), 4)).astype(np.int64)
    features = np.zeros((len(state), len(ll.BUCKETS)), np.int8)
    features[:, 1] = np.where(rng.random(len(state)) < 0.8, state * 4, (1 - state) * 4)
    field = ll.fit_field(features, n_lines, state)
    alone = (features[:, 1] == 4 * state).mean()
    assert (ll.viterbi(field, features, n_lines) == state).mean() > alone + 0.03
    assert field.move[0, 0] > field.move[0, 1] and field.move[1, 1] > field.move[1, 0]


def test_held_out_documents_are_judged_as_labelled(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    field = ll.train_field(docs, labels.where("doc_id % 2 = 0"))
    held = ll.label_lines(docs, field).join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed")
    right = held.select(F.avg(((F.col("quality") > 0) == F.col("kept")).cast("double"))).first()[0]
    clean = held.where("quality = 1").select(F.avg(F.col("kept").cast("double"))).first()[0]
    assert right > 0.95 and clean > 0.98


def test_training_without_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    field = ll.train_field(fx.frame(spark, fx.texts()), labels)
    assert not field.emit.any()


def test_base_rules_alone_decide_without_both_classes(spark):
    rows = fx.texts()
    docs = fx.frame(spark, rows)
    want = sorted([(k, t) for k, t, _ in rows if not base_counts(t)[-1]], key=fx.sort_key)
    for labels in ([], [(0, 1), (1, 1)], [(0, 0), (1, 0)], [(10**12, 0), (10**12 + 1, 1)]):
        field = ll.train_field(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
        assert fx.collected(ll.keep_good(docs, field), ["doc_id", "text"]) == want


def test_labels_of_other_documents_take_no_place_in_the_sample(spark):
    docs = fx.frame(spark, fx.texts())
    own = [(i, int(i < 6)) for i in range(12)]
    fit = lambda labels: ll.train_field(docs, spark.createDataFrame(labels, "doc_id long, quality int"), sample=20)
    alone = fit(own)
    assert alone.emit.any()
    assert np.array_equal(fit(own + [(i, 0) for i in range(10**6, 10**6 + 400)]).emit, alone.emit)


def test_pipeline_keeps_clean_documents_of_other_inputs(spark):
    """The stage trains on the documents table, not on its input."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    clean = docs.join(labels.where("quality = 1"), "doc_id", "left_semi").withColumn("doc_id", F.col("doc_id") + 10**9)
    assert corpus_pipeline.quality(spark, clean, SF).count() > 0.9 * clean.count()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=default_model())


def test_pieces_equal_the_library(spark, library):
    rows = fx.texts()
    got = encode_texts(fx.frame(spark, rows)).collect()
    want = []
    for k, t, _ in rows:
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        want.append((k, len(ids), array("I", ids).tobytes(), library.decode(ids)))
    assert sorted(((r[0], r[1], bytes(r[2]), r[3]) for r in got), key=fx.sort_key) == sorted(want, key=fx.sort_key)
    assert encode_texts(fx.empty(spark)).count() == 0


def test_pieces_on_random_strings(library):
    model, rng = PieceModel(default_model()), random.Random(9)
    parts = ["a", "ab", "the", "in", "▁", " ", "  ", "\n", "\t", "é", "🙂", "\x00", "ü", "ing", "。", "中", "aa", "<s>", "<0x0A>", "22", "//", "===="]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(5000)] + [" " * n + "x" for n in range(40)] + ["a" * n for n in range(40)]
    ids = library.encode(texts, add_bos=False, add_eos=False)
    packed = model.encode_many(texts, bos=False, eos=False)
    assert [list(array("I", p)) for p in packed] == ids
    assert [model.decode(p) for p in packed] == [library.decode(i) for i in ids]


def test_prefix_table_holds_the_last_piece_of_every_prefix(library):
    model = PieceModel(default_model())
    text = "▁thereadingsofunbelievable"
    last = model.prefix_table(text)
    for n in range(1, len(text) + 1):
        piece = library.id_to_piece(library.encode(text[1:n] if n > 1 else "", add_bos=False)[-1]) if n > 1 else "▁"
        assert model.text[last[n]] == piece


def jaccard(a, b):
    return 1.0 if not a | b else len(a & b) / len(a | b)


def test_fingerprints_of_small_texts_are_exact(spark):
    rows = [(k, t, s) for k, t, s in fx.texts() if k is None or len(fx.words(t)) < 100]
    seen, unique = set(), []
    for r in rows:
        if r[0] not in seen:
            unique.append(r)
            seen.add(r[0])
    order = sorted(unique, key=lambda r: -(2**63) if r[0] is None else r[0])
    want = []
    for i, (k, t, _) in enumerate(order):
        t, after = t or "", order[(i + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        s, e, n = (frozenset(tuple(fx.words(x)[j : j + 5]) for j in range(max(1, len(fx.words(x)) - 4))) if fx.words(x) else frozenset() for x in (t, edited, after))
        want.append((k, len(t), hashlib.sha256(edited.encode()).hexdigest(), round(jaccard(s, e), 9), round(jaccard(s, n), 9), float(len(s))))
    got = fp.edited_fingerprints(fx.frame(spark, unique), k=1024).withColumns(
        {c: F.round(c, 9) for c in ("near_edited", "near_next", "n_distinct")}
    )
    assert fx.collected(got, ["doc_id", "n_chars", "edited_sha256", "near_edited", "near_next", "n_distinct"]) == sorted(want, key=fx.sort_key)
    assert fp.edited_fingerprints(fx.empty(spark)).count() == 0


def test_fingerprints_keep_every_row_and_agree_on_equal_texts(spark):
    rows = fx.texts()
    got = fp.edited_fingerprints(fx.frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by_chars = collections.defaultdict(set)
    for r in got:
        if r["doc_id"] == 3:
            by_chars[r["n_chars"]].add(r["fingerprint"])
    assert all(len(v) == 1 for v in by_chars.values())


def test_sketches_merge_and_estimate(spark):
    rows = [(g, [random.Random(f"{g}{i}{j}").getrandbits(64) - 2**63 for j in range(50)]) for g in ("a", "b") for i in range(40)]
    rows += [("b", r[1]) for r in rows[:20]]
    df = spark.createDataFrame(rows, "g string, h array<bigint>").select("g", fp.bottom(F.col("h")).alias("sketch"))
    merged = {r["g"]: r["sketch"] for r in fp.merge_groups(df, ["g"]).collect()}
    exact = {g: {h for x, hs in rows if x == g for h in hs} for g in ("a", "b")}
    for g in ("a", "b"):
        assert merged[g] == sorted(exact[g])[: fp.K]
    both = spark.createDataFrame([(merged["a"], merged["b"])], "a array<bigint>, b array<bigint>")
    a, b = F.col("a"), F.col("b")
    r = both.select(fp.resemblance(a, b).alias("j"), fp.containment(a, b).alias("c"), fp.distinct_count(b).alias("n")).first()
    assert abs(r["j"] - 1000 / 4000) < 0.12 and abs(r["c"] - 1000 / 2000) < 0.3 and abs(r["n"] - 3000) < 1000


def talk(pair, *turns):
    return [(pair, i, r, t, 7) for i, (r, t) in enumerate(turns)]


def test_preferences(spark):
    u, a = "user", "assistant"
    chosen = [*talk(1, (u, "q"), (a, "x"), (u, "r"), (a, "good")), *talk(2, (u, "q"), (a, "same")), *talk(3, (u, None), (None, "n")), *talk(5, (u, "only"))]
    rejected = [*talk(1, (u, "q"), (a, "x"), (u, "r"), (a, "bad"), (u, "more")), *talk(2, (u, "q"), (a, "same")), *talk(3, (u, None), (None, "n"), (a, "tail")), *talk(4, (a, "only"))]
    schema = "pair long, turn long, role string, text string, pos int"
    df = format_preferences(spark.createDataFrame(chosen, schema), spark.createDataFrame(rejected, schema), ["pair"])
    got = collections.defaultdict(lambda: collections.defaultdict(list))
    for r in df.orderBy("pair", "part", "pos").collect():
        got[r["pair"]][r["part"]].append((r["pos"], r["rendered"], r["start"], r["masked"]))
    show = lambda r, t: f"<|{r}|>\n{t}<|end|>\n"
    assert [x[1] for x in got[1]["prompt"]] == [show(u, "q"), show(a, "x"), show(u, "r")]
    assert [(x[1], x[3]) for x in got[1]["chosen"]] == [(show(a, "good"), False)]
    assert [(x[1], x[3]) for x in got[1]["rejected"]] == [(show(a, "bad"), False), (show(u, "more"), True)]
    assert set(got[2]) == {"prompt"} and all(x[3] for x in got[2]["prompt"])
    assert len(got[3]["prompt"]) == 2 and [x[1] for x in got[3]["rejected"]] == [show(a, "tail")]
    assert set(got[4]) == {"rejected"} and set(got[5]) == {"chosen"}
    for parts in got.values():
        for name in ("chosen", "rejected"):
            whole = "".join(x[1] for x in parts["prompt"] + parts[name])
            assert all(whole[x[2] :].startswith(x[1]) for x in parts["prompt"] + parts[name])
    none = spark.createDataFrame([], schema)
    assert format_preferences(none, none, ["pair"]).count() == 0


def test_preferences_number_long_gappy_talks(spark):
    turns = [(1, 5 * i - 7, "user" if i % 2 else "assistant", f"t{i}", 0) for i in range(3000)]
    schema = "pair long, turn long, role string, text string, pos int"
    a = spark.createDataFrame(turns, schema)
    b = spark.createDataFrame([*turns[:2500], (1, 99999, "assistant", "end", 0)], schema)
    out = format_preferences(a, b, ["pair"]).groupBy("part").agg(F.count("*").alias("n"), F.min("pos").alias("lo"), F.max("pos").alias("hi"))
    assert {tuple(r) for r in out.collect()} == {("prompt", 2500, 0, 2499), ("chosen", 500, 2500, 2999), ("rejected", 1, 2500, 2500)}


def test_lines_of_mixed_documents_get_both_labels(spark):
    """Clean documents with a block of lines from bad ones inside: lines are told apart, and the document stays."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    field = ll.train_field(docs, labels.where("doc_id % 2 = 0"))
    held = docs.join(labels.where("doc_id % 2 = 1"), "doc_id").select("doc_id", "text", "quality").orderBy("doc_id").collect()
    lines = {q: [[x for x in r["text"].split("\n") if len(x.split()) >= 8] for r in held if r["quality"] == q] for q in (0, 1)}
    bad = [x for some in lines[0] for x in some]
    rows, truth = [], {}
    for i, good in enumerate(x for x in lines[1] if len(x) >= 4):
        middle = [bad[(3 * i + j) % len(bad)] for j in range(2)]
        middle = [" ".join(x.split()[:12]) for x in middle]
        text = good[:2] + middle + good[2:]
        rows.append((i, "\n".join(text)))
        truth[i] = [1, 1, 0, 0] + [1] * (len(good) - 2)
    got = ll.label_lines(spark.createDataFrame(rows, "doc_id long, text string"), field).collect()
    right = [int(a == b) for r in got for a, b in zip(r["states"], truth[r["doc_id"]])]
    planted = [1 - a for r in got for a, b in zip(r["states"], truth[r["doc_id"]]) if not b]
    both = [0 < r["n_content_lines"] < r["n_lines"] for r in got]
    assert len(rows) > 50
    assert np.mean(right) > 0.9 and np.mean(planted) > 0.7 and np.mean(both) > 0.7, (np.mean(right), np.mean(planted), np.mean(both))
    assert np.mean([r["content_share"] >= ll.MIN_SHARE for r in got]) > 0.95


def test_states_agree_with_labels_of_documents():
    rng = np.random.default_rng(11)
    field = ll.Field(rng.normal(size=(ll.OFFSETS[-1], 2)), rng.normal(size=(2, 2)))
    n_lines = rng.integers(1, 9, 40)
    features = rng.integers(0, np.diff(ll.OFFSETS), (n_lines.sum(), len(ll.BUCKETS))).astype(np.int8)
    words, label = rng.integers(0, 20, n_lines.sum()), rng.integers(0, 2, 40)
    state = ll.agreeing_states(field, features, n_lines, words, label)
    owner = np.repeat(np.arange(40), n_lines)
    free = ll.viterbi(field, features, n_lines)
    for d in range(40):
        own = owner == d
        share = lambda s: (s[own] * words[own]).sum() / max(1, words[own].sum())
        assert (share(state) >= ll.MIN_SHARE) == bool(label[d]) or not words[own].any()
        if (share(free) >= ll.MIN_SHARE) == bool(label[d]):
            assert (state[own] == free[own]).all()
