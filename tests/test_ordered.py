"""Order-dependent columns against plain loops, with buckets far smaller than the sequences."""

import random

import pytest
from pyspark.sql import functions as F

from forumlens.operators import conversation as cv
from forumlens.operators import evaluation, ordered

SCHEMA = "conv_id int, turn bigint, role string, text string"


@pytest.fixture(scope="module")
def talks(spark):
    """One conversation holds most rows; repeats are frequent."""
    rnd = random.Random(3)
    rows = []
    for conv, length in ((1, 120), (2, 7), (3, 1), (4, 33)):
        for turn in range(length):
            role = rnd.choice(["user", "user", "assistant", "system"])
            rows.append((conv, turn, role, rnd.choice(["a", "b"]) if role == "user" else "w " * rnd.randint(1, 60)))
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(5)


def by_conv(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


@pytest.mark.parametrize("width", [13, 16, 4096])
def test_recent_history(talks, width):
    rows, df = talks
    got = {(r["conv_id"], r["turn"]): r["history"] for r in cv.recent_history(df, width=width).collect()}
    for conv, turns in by_conv(rows).items():
        for i, (_, turn, _, _) in enumerate(turns):
            assert got[conv, turn] == "\n".join(f"{t[2]}: {t[3]}" for t in turns[max(0, i - 12) : i])
    assert len(got) == len(rows)


def test_history_summary(talks):
    rows, df = talks
    got = {(r["conv_id"], r["turn"]): r["history_summary"] for r in cv.history_summary(df, width=5).collect()}
    for conv, turns in by_conv(rows).items():
        for i, (_, turn, _, _) in enumerate(turns):
            expected = "Conversation history summary: " + " ".join(f"{t[2]}: {t[3][:50]}..." for t in turns[max(0, i - 4) : i])
            assert got[conv, turn] == (expected if i else "No prior history.")


@pytest.mark.parametrize("width", [1, 4, 4096])
def test_repeat_counts(talks, width):
    rows, df = talks
    got = {(r["conv_id"], r["turn"]): r["repeats"] for r in cv.repeat_counts(df, width=width).collect()}
    expected = {}
    for conv, turns in by_conv(rows).items():
        last, count = None, 0
        for _, turn, role, text in turns:
            if role == "user":
                count = count + 1 if text == last else 0
                last = text
                expected[conv, turn] = count
    assert got == expected


def test_repeats_of_the_fixture_case(spark):
    df = spark.createDataFrame([(1, i, "user", t) for i, t in enumerate("aaaba")], SCHEMA)
    assert [r["repeats"] for r in cv.repeat_counts(df).orderBy("turn").collect()] == [0, 1, 2, 0, 0]


@pytest.mark.parametrize(("budget", "width"), [(500.0, 8), (900.0, 12), (8192.0, 16)])
def test_kept_history(talks, budget, width):
    rows, df = talks
    out = cv.kept_history(df, F.lit(150.0), budget=budget, width=width, texts=True).collect()
    got = {(r["conv_id"], r["turn"]): (r["n_before"], r["n_kept"], r["first_kept"]) for r in out}
    said = {(r["conv_id"], r["turn"]): r["history"] for r in out}
    for conv, turns in by_conv(rows).items():
        for i, (_, turn, role, _) in enumerate(turns):
            if role != "user":
                continue
            history = turns[:i]
            while sum(len(t[3].split()) * 1.3 + 100 for t in history) + 150 > budget and len(history) > 2:
                history = history[2:]
            assert got[conv, turn] == (i, len(history), i - len(history))
            assert said[conv, turn] == "\n".join(f"{t[2]}: {t[3]}" for t in history)


def test_answers_are_compared_with_the_latest_question(spark):
    rows = [
        (1, 0, "assistant", [1.0, 0.0]),  # answers nothing
        (1, 3, "user", [1.0, 0.0]),
        (1, 4, "user", [0.0, 2.0]),
        (1, 9, "assistant", [0.0, 5.0]),
        (1, 10, "assistant", [3.0, 0.0]),
        (2, 1, "user", [1.0, 1.0]),
        (2, 2, "assistant", [0.0, 0.0]),  # a zero vector is like nothing
    ]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, embedding array<double>")
    got = {(r["conv_id"], r["turn"]): r["relevance"] for r in evaluation.answer_relevance(df).collect()}
    assert got == {(1, 9): 1.0, (1, 10): 0.0, (2, 2): 0.0}


def test_running_sum_and_previous_value(spark):
    rnd = random.Random(5)
    rows = [("k", i * 3 + rnd.randint(0, 2), rnd.randint(-5, 5)) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, at bigint, v int")
    got = ordered.running(df, ["k"], "at", {"s": ("sum", F.col("v")), "m": ("max", F.col("v"))}, width=7)
    got = ordered.previous_value(got, ["k"], "at", "v", "p", width=10).orderBy("at").collect()
    total, top, last = 0, None, None
    for (_, at, v), row in zip(rows, got):
        total, top = total + v, v if top is None else max(top, v)
        assert (row["at"], row["s"], row["m"], row["p"]) == (at, total, top, last)
        last = v
