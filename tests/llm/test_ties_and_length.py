"""Tied and repeated turns of recorded conversations, and texts of very many lines."""

import random
import time

from pyspark.sql import functions as F

from forumlens.llm.line_spread import drop_spread_lines
from forumlens.llm.preferences import conversation_pairs, format_preferences
from tests.llm import fixtures as fx


def order(row):
    return tuple((x is not None, x) for x in row)


def talk_rows():
    rng = random.Random(6)
    rows = []
    for c in range(24):
        rows += [(c, t, ["user", "assistant", None][t % 3 if c % 7 == 0 else t % 2], rng.choice(["yes", "no", "well", None])) for t in range(rng.randint(1, 7))]
        rows[-1] = (c, rows[-1][1], "assistant", f"end {c % 5}")
    # A user message with the number of the last answer, two answers at one turn, repeated rows, no number, no conversation.
    rows += [(r[0], r[1], "user", "late") for r in rows[5:40:3]] + [(r[0], r[1], "assistant", "other") for r in rows[4:60:5]] + rows[:9]
    return rows + [(2, None, "user", "when"), (3, None, "assistant", "unknown"), (None, 0, "user", "who"), (50, 0, "user", "yes"), (51, 0, "user", "yes")]


def brute_pairs(rows, after):
    talks = {}
    for c, t, r, x in rows:
        if c is not None:
            talks.setdefault(c, []).append((t, r, x))
    talks = {c: [m[1:] for m in sorted(ms, key=order)] for c, ms in talks.items()}
    last = {c: max((i for i, m in enumerate(ms) if m[0] == "assistant"), default=None) for c, ms in talks.items()}
    out = {}
    for c, other in after:
        if c in talks and other in talks and last[c] is not None and last[other] is not None:
            own = talks[c][: last[c] + 1]
            out[c, other, "answer"] = own, [*own[:-1], ("assistant", talks[other][last[other]][1])]
    groups = {}
    for c in sorted(talks):
        groups.setdefault(talks[c][0], []).append(c)
    for head, *rest in groups.values():
        for c in rest:
            out[head, c, "first_turn"] = talks[head], talks[c]
    return out


def test_pairs_of_tied_turns_match_brute_force(spark):
    rows = talk_rows()
    after = [(c, c + 1) for c in range(23)] + [(23, 0), (50, 51)]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumns({"pos": F.lit(1), "at": F.lit(2), "n": F.lit(3)})
    chosen, rejected = conversation_pairs(table.repartition(5), spark.createDataFrame(after, "conv_id long, other_id long"))
    want = brute_pairs(rows, after)
    for i, side in enumerate((chosen, rejected)):
        got = {}
        for r in side.orderBy("turn").collect():
            got.setdefault((r["conv_id"], r["other_id"], r["kind"]), []).append((r["role"], r["text"]))
        assert got == {k: v[i] for k, v in want.items() if v[i]}
    ids = ["conv_id", "other_id", "kind"]
    split = {}
    for r in format_preferences(chosen, rejected, ids).orderBy("pos").collect():
        split.setdefault(tuple(r[c] for c in ids), {}).setdefault(r["part"], []).append(r["rendered"])
    for k, (a, b) in want.items():
        show = lambda ms: [f"<|{r or ''}|>\n{x or ''}<|end|>\n" for r, x in ms]
        n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        parts = {"prompt": show(a[:n]), "chosen": show(a[n:]), "rejected": show(b[n:])}
        assert split[k] == {name: v for name, v in parts.items() if v}
    none = conversation_pairs(table.limit(0), spark.createDataFrame([], "conv_id long, other_id long"))
    assert none[0].count() == none[1].count() == 0


def test_texts_of_very_many_lines(spark):
    text = "\n".join(f"line {i}" for i in range(50_000))
    docs = spark.createDataFrame([(i, text + ("\nown" if i == 3 else ""), f"s{i}") for i in range(12)], "doc_id long, text string, source string")
    start = time.time()
    got = {r["doc_id"]: r for r in drop_spread_lines(docs.repartition(4)).select("doc_id", "kept_text", "n_lines", "n_removed").collect()}
    assert time.time() - start < 60
    assert got[0]["n_removed"] == 0 and got[0]["kept_text"] == text
    assert all(got[i]["n_removed"] == 50_000 and got[i]["kept_text"] == ("own" if i == 3 else "") for i in range(1, 12))
    assert fx.words(got[3]["kept_text"]) == ["own"]
