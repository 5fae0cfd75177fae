"""Near-duplicates, repeated strings, repeated passages and spread lines against brute force."""

import collections
import hashlib
import random

import numpy as np
import pytest

import corpus_pipeline
from forumlens.llm import near_duplicates as nd
from forumlens.llm import passages, suffixes
from forumlens.llm.components import components
from forumlens.llm.line_spread import drop_spread_lines
from tests.llm import fixtures as fx


def lowest(key):
    return -(2**63) if key is None else key


def brute_components(rows, n=5, percent=80):
    sets = [(lowest(k), fx.shingles(t, n)) for k, t, _ in rows]
    parent = {k: k for k, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    back = lambda x: None if x == -(2**63) else x
    return [(back(k), len(s), back(root(k) if s else k), (root(k) if s else k) == k) for k, s in sets]


def test_near_duplicates_match_brute_force(spark):
    rows = fx.texts()
    got = fx.collected(nd.near_duplicates(fx.frame(spark, rows)), ["doc_id", "n_shingles", "component_id", "kept"])
    assert got == sorted(brute_components(rows), key=fx.sort_key)


def test_near_duplicates_of_a_chain_and_a_crowd(spark):
    """Links that pass through third documents, and a crowd of variants whose smallest is linked to few."""
    rng = random.Random(2)
    base = fx.prose(rng, 80, 500)
    rows, now = [], list(base)
    for i in range(30):
        rows.append((i, " ".join(now), "s"))
        now = list(now)
        now[rng.randrange(80)] = f"step{i}"
    for i in range(60):
        w = list(base)
        for j in range(rng.randint(0, 8)):
            w[rng.randrange(80)] = f"v{i}x{j}"
        rows.append((100 + i, " ".join(w), "s"))
    rng.shuffle(rows)
    got = fx.collected(nd.near_duplicates(fx.frame(spark, rows)), ["doc_id", "n_shingles", "component_id", "kept"])
    assert got == sorted(brute_components(rows), key=fx.sort_key)


def test_near_duplicates_without_ids_link_by_text_alone(spark):
    """Unrelated texts without id link nothing; of near copies without id one stays."""
    rng = random.Random(12)
    a, b = fx.prose(rng, 80, 500), fx.prose(rng, 80, 500)
    near = lambda w, i: " ".join([*w[:-1], f"other{i}"])
    rows = [(None, " ".join(a), "s"), (None, " ".join(b), "s"), (None, near(a, 0), "s"), (5, near(a, 1), "s"), (6, near(b, 2), "s")]
    rows += [(7, " ".join(fx.prose(rng, 80, 500)), "s"), (7, " ".join(fx.prose(rng, 80, 500)), "s")]
    rows += [(8, near(rows[5][1].split(), 3), "s"), (8, near(rows[6][1].split(), 4), "s")]
    found = nd.near_duplicates(fx.frame(spark, rows)).collect()
    assert collections.Counter(r["doc_id"] for r in found if r["kept"]) == {None: 2, 7: 2}
    assert {r["doc_id"]: r["component_id"] for r in found} == {None: None, 5: None, 6: None, 7: 7, 8: 7}
    rows.append((7, near(rows[5][1].split(), 5), "s"))
    left = corpus_pipeline.near_duplicate_groups(spark, fx.frame(spark, rows), "")
    assert sorted((r["doc_id"] or 0) for r in left.collect()) == [0, 0, 7, 7]


def test_index_finds_every_pair_within_reach():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 16, (400, nd.POSITIONS), dtype=np.uint16)
    b = a.copy()
    for row in b:
        at = rng.permutation(nd.POSITIONS)[: rng.integers(0, nd.REACH + 1)]
        row[at] ^= 1
    assert (nd.index_keys(a) == nd.index_keys(b)).any(1).all()


def test_near_duplicates_without_rows(spark):
    assert nd.near_duplicates(fx.empty(spark)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 100), (7, 7), (103, 102), (100, 101)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100, 103: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_strings(rows, length=200):
    raw = [(k, (t or "").encode()) for k, t, _ in rows]
    seen = collections.Counter(t[i : i + length] for _, t in raw for i in range(len(t) - length + 1))
    out = []
    for k, t in raw:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((k, len(t), sum(gone), spans, bytes(b for b, g in zip(t, gone) if not g)))
    return sorted(out, key=fx.sort_key)


def test_repeated_strings_match_brute_force(spark):
    rows = fx.texts()
    got = suffixes.drop_repeated_strings(fx.frame(spark, rows))
    got = sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in got.collect()), key=fx.sort_key)
    assert got == brute_strings(rows)
    assert suffixes.drop_repeated_strings(fx.empty(spark)).count() == 0


def test_repeated_strings_at_borders(spark):
    """199 equal bytes stay, 200 go; a match never runs over the end of a text."""
    rng = random.Random(4)
    s = "".join(rng.choice("abcd") for _ in range(200))
    rows = [(1, "x" + s, "a"), (2, "y" + s + "z", "a"), (3, s[:199], "b"), (4, s[:100], "b"), (5, s[100:], "b")]
    rows += [(6, "q" * 201, "c"), (7, "r" * 200, "c")]
    got = suffixes.drop_repeated_strings(fx.frame(spark, rows))
    got = sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in got.collect()), key=fx.sort_key)
    assert got == brute_strings(rows)


@pytest.mark.parametrize("letters", [1, 2, 4, 26])
@pytest.mark.parametrize("block", [64, 1 << 19])
def test_suffix_blocks_match_counting(letters, block, monkeypatch):
    monkeypatch.setattr(suffixes, "BLOCK", block)
    rng = random.Random(letters)
    draw = lambda n: bytes(rng.randrange(97, 97 + letters) for _ in range(n))
    base = draw(600)
    for _ in range(4):
        parts = [base[(a := rng.randint(0, 300)) : a + rng.randint(1, 500)] if rng.random() < 0.6 else draw(rng.randint(1, 300)) for _ in range(6)]
        text = b"".join(parts) + b"\0" * 200
        starts = np.arange(len(text) - 200)
        seen = collections.Counter(text[s : s + 200] for s in starts)
        want = np.array([seen[text[s : s + 200]] > 1 for s in starts], bool)
        assert (suffixes.repeated_windows(np.frombuffer(text, np.uint8), starts) == want).all()


def test_difference_cover_has_every_difference():
    for period in (4, 9, 16, 32, 64):
        cover = suffixes.difference_cover(period)
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def brute_passages(rows, n=13):
    first = {}
    for k, t, _ in rows:
        w = fx.words(t)
        for i in range(len(w) - n + 1):
            s = tuple(w[i : i + n])
            first[s] = min(first.get(s, lowest(k)), lowest(k))
    out = []
    for k, t, _ in rows:
        w = fx.words(t)
        gone = bytearray(len(w))
        for i in range(len(w) - n + 1):
            if first[tuple(w[i : i + n])] < lowest(k):
                gone[i : i + n] = b"\1" * n
        out.append((k, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=fx.sort_key)


def test_repeated_passages_match_brute_force(spark):
    rows = fx.texts()
    got = fx.collected(passages.drop_repeated_passages(fx.frame(spark, rows)), ["doc_id", "n_words", "n_removed", "kept"])
    assert got == brute_passages(rows)
    assert passages.drop_repeated_passages(fx.empty(spark)).count() == 0


def test_windows_of_equal_hash_fall_back_to_words(monkeypatch):
    monkeypatch.setattr(passages, "window_hashes", lambda h, size: np.zeros(max(0, len(h) - size + 1), np.uint64))
    ids = np.array([1, 2, 3, 1, 2, 3, 1, 2, 4])
    order, first, size = passages.equal_windows(ids, np.arange(7), 3)
    groups = sorted(sorted(order[f : f + s].tolist()) for f, s in zip(first, size))
    assert groups == [[0, 3], [1, 4], [2, 5], [6]]


def crowd(module, n=120):
    """A phrase of small hash that every document holds in other surroundings, some copies, and a shared passage."""
    rng = random.Random(8)
    drawn = ["".join(rng.choice("abcdefgh") for _ in range(16)) for _ in range(1000)]
    if module is suffixes:
        first = lambda t: suffixes.segments([t.encode()], 16, 16)[4][0]
    else:
        drawn = [f"{t[:4]} {t[4:9]} {t[9:]}" for t in drawn]
        first = lambda t: passages.super_kmers(passages.Words([t.encode()], passages.WordHashes()), 3, 3)[2][0]
    phrase, shared = min(drawn, key=first).split(), fx.prose(rng, 40, 300)
    rows = []
    for i in range(n):
        w = fx.prose(rng, 30, 3000) + phrase + fx.prose(rng, 30, 3000)
        rows.append((i, " ".join(w + shared if i % 10 == 0 else w), "s"))
    return rows + [(n + i, rows[i][1], "s") for i in range(3)]


@pytest.mark.parametrize("rounds", [1, 4])
@pytest.mark.parametrize("module", [suffixes, passages])
def test_a_minimiser_in_many_surroundings_is_split(spark, module, rounds, monkeypatch):
    monkeypatch.setattr(passages, "ROUNDS", rounds)
    rows, bound = crowd(module), 3000
    docs = [(k, t.encode()) for k, t, _ in rows]
    keys, raw = np.array([k for k, _ in docs]), [t for _, t in docs]
    pack = (
        (lambda k, t, s: suffixes.pack_chunk(None, k, t, 96, suffixes.LENGTH, suffixes.GRAM, s))
        if module is suffixes
        else (lambda k, t, s: passages.pack_chunk(None, k, t, passages.WordHashes(), passages.WINDOW, passages.GRAM, 96, s))
    )

    def fullest(splits):
        least, sizes = pack(keys, raw, splits)
        _, group = np.unique(least, return_inverse=True)
        return np.bincount(group, sizes).max()

    frame = spark.createDataFrame([(k, t) for k, t, _ in rows], "k long, t string")
    splits = passages.crowded(frame, pack, bound, sum(map(len, raw)))
    before, after = fullest((passages.NONE, passages.NONE)), fullest(splits)
    print(f"fullest minimiser of {module.__name__}: before {before:.0f} bytes, after {after:.0f}")
    assert before > 2 * bound >= after
    if module is suffixes:
        got = suffixes.drop_repeated_strings(fx.frame(spark, rows), bucket_bytes=bound)
        got = sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in got.collect()), key=fx.sort_key)
        assert got == brute_strings(rows)
    else:
        got = passages.drop_repeated_passages(fx.frame(spark, rows), bucket_bytes=bound)
        assert fx.collected(got, ["doc_id", "n_words", "n_removed", "kept"]) == brute_passages(rows)


@pytest.mark.parametrize("module", [suffixes, passages])
def test_settled_runs_of_a_hot_document_spread_over_buckets(module):
    """Chunks that repeat one document do not all send their settled runs to one bucket."""
    raw = " ".join(fx.prose(random.Random(6), 200, 400)).encode()
    parcels = passages.Parcels()
    for chunk in range(24):
        keys = [100 * chunk + i for i in range(4)]
        if module is suffixes:
            suffixes.pack_chunk(parcels, keys, [raw] * 4, 96, suffixes.LENGTH, suffixes.GRAM)
        else:
            passages.pack_chunk(parcels, np.array(keys), [raw] * 4, passages.WordHashes(), passages.WINDOW, passages.GRAM, 96)
    runs = [sum(n.shape[1] for n in held[0]) for (_, kind), held in parcels.held.items() if kind == 1]
    assert sum(runs) > 24 and max(runs) * 12 <= sum(runs)


def test_marks_of_one_key_are_told_apart_by_64_bits(spark):
    texts = ["", "one", "é" * 50, " ".join(fx.prose(random.Random(1), 300))]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("t", "xxhash64(t) h")
    assert {r["t"]: r["h"] for r in frame.collect()} == {t: passages.text_sum(t.encode()) for t in texts}
    rng = random.Random(3)
    shared, tail = fx.prose(rng, 60, 400), fx.prose(rng, 60, 400)
    rows = [(None, " ".join(shared + fx.prose(rng, 40, 400)), "s") for _ in range(20)] + [(None, " ".join(shared + tail), "s")] * 20
    got = suffixes.drop_repeated_strings(fx.frame(spark, rows))
    assert sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in got.collect()), key=fx.sort_key) == brute_strings(rows)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" in plan


def brute_lines(rows, min_sites):
    sites, first = collections.defaultdict(set), {}
    for k, t, s in rows:
        for line in (t or "").split("\n"):
            if fx.words(line):
                sites[line].add(s)
                first[line] = min(first.get(line, lowest(k)), lowest(k))
    out = []
    for k, t, _ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (fx.words(x) and len(sites[x]) >= min_sites and lowest(k) > first[x])]
        out.append((k, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=fx.sort_key)


@pytest.mark.parametrize("min_sites", [2, 10, 40])
def test_spread_lines_match_brute_force(spark, min_sites):
    rows = fx.texts()
    for i in range(200, 260):
        shared = [f"on {j} sites" for j in (9, 10, 11, 39, 40, 41, 55) if i - 200 < j]
        rows.append((i, "\n".join([*shared, f"own line {i}", "", shared[0] if shared else ""]), f"site{i}"))
    frame = fx.frame(spark, rows)
    cut = drop_spread_lines(frame, min_sites=min_sites)
    assert cut.columns == [c for c in frame.columns if c != "n_removed"] + ["kept_text", "n_lines", "n_removed"]
    assert fx.collected(cut, ["doc_id", "n_lines", "n_removed", "kept_text"]) == brute_lines(rows, min_sites)
    assert drop_spread_lines(fx.empty(spark)).count() == 0


def test_digest_of_kept_bytes_may_cut_characters(spark):
    text = "é" * 150
    got = suffixes.drop_repeated_strings(fx.frame(spark, [(1, text, "a"), (2, "x" + text, "a")])).collect()
    assert {r["doc_id"]: hashlib.sha256(bytes(r["kept"])).hexdigest() for r in got} == {
        1: hashlib.sha256(b"").hexdigest(), 2: hashlib.sha256(b"x").hexdigest()
    }


def test_only_windows_around_passed_minimisers_are_counted_again(spark):
    """The parts of texts that a later round of counting reads are the windows that hold what is passed over, no other."""
    rnd = np.random.default_rng(3)
    common = b"0123456789abcdef"
    texts = [rnd.integers(97, 123, n).astype(np.uint8).tobytes() for n in (150, 200, 230, 900, 5_000)]
    for i, places in ((1, [0]), (2, [214]), (3, [10, 300, 310, 890]), (4, [2_000, 4_984])):
        for p in places:
            texts[i] = texts[i][:p] + common + texts[i][p + 16 :]
            texts[i] = texts[i][: [150, 200, 230, 900, 5_000][i]]
    whole = np.frombuffer(common, np.uint8)
    passed = suffixes._gram_hashes(*suffixes._rolling(whole), 16) >> np.uint64(1)
    keys, parts = suffixes.windows_around(np.arange(5), texts, passed, 200, 16)
    windows = lambda t: [t[i : i + 200] for i in range(len(t) - 199)]
    want = sorted((k, w) for k, t in enumerate(texts) for w in windows(t) if common in w)
    assert sorted((k, w) for k, t in zip(keys.tolist(), parts) for w in windows(t)) == want and want
    assert [len(t) for t in suffixes.windows_around(np.arange(5), texts, np.array([1], np.uint64), 200, 16)] == [0, 0]

    # The later rounds come to the same sums, so to the same choice.
    docs = [" ".join(rnd.choice(["the end of it", "and so", f"{rnd.integers(9_999)} of", "once more"], 12)) * 3 for _ in range(400)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "k long, t string").repartition(3)
    total = sum(map(len, docs))
    pack = lambda keys, texts, splits: suffixes.pack_chunk(None, keys, texts, 4, 200, 16, splits)
    around = lambda keys, texts, passed: suffixes.windows_around(keys, texts, passed, 200, 16)
    plain, part = (passages.crowded(frame, pack, 9_000, total, 1 << 20, a) for a in (None, around))
    assert len(plain[0]) and np.array_equal(plain[0], part[0]) and np.array_equal(plain[1], part[1])
