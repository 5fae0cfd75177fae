"""Small fixed cases of the text and date rules."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from forumlens.functions import dates
from forumlens.functions import text as tx
from forumlens.operators import documents as dm
from forumlens.operators import evaluation


@pytest.mark.parametrize(
    ("raw", "day"),
    [
        ("3 hours ago", "2024-05-15"), ("45 minutes ago", "2024-05-15"), ("monday", "2024-05-13"),
        ("Wednesday ", "2024-05-15"), ("2 weeks ago", "2024-05-01"), ("1 month ago", "2024-04-15"),
        ("3-4-2020", "2020-04-03"), ("31-02-2020", None), ("3 days ago", None), ("yesterday", None), ("", None),
    ],
)
def test_relative_dates(one, raw, day):
    got = one(raw, lambda t: dates.parse_relative_date(t, F.lit("2024-05-15").cast("date")))
    assert got == (dt.date.fromisoformat(day) if day else None)


def test_cutoff_keeps_undated(spark):
    rows = spark.createDataFrame([("2014-12-31",), ("2015-01-01",), (None,)], "d string")
    kept = rows.where(dates.on_or_after(F.col("d").cast("date"))).collect()
    assert {r["d"] for r in kept} == {"2015-01-01", None}


@pytest.mark.parametrize(("text", "n"), [("", 0), ("  ", 0), ("a b", 2), ("a b c", 3), (" a\n\tb ", 2)])
def test_word_count(one, text, n):
    assert one(text, tx.word_count) == n


def test_dictionary_order_matters(one):
    longer_last = [(":-", "A"), (":-)", "B")]
    assert one("x :-) y", lambda t: tx.emoticons_to_text(t, longer_last, [], [])) == "x  a ) y"
    assert one("x :-) y", lambda t: tx.emoticons_to_text(t, longer_last[::-1], [], [])) == "x  b  y"


def test_emoji_names_and_alias_removal(one):
    assert one("ok 😀", lambda t: tx.emoticons_to_text(t, [])) == "ok :grinning_face:"
    assert one("ok 😀 Smiley x_y", lambda t: tx.emoticons_without_aliases(t, [])).split() == ["ok", "x", "y"]


def test_light_clean(one):
    assert one("see http://a.b/c now ||| www.x.y ok", tx.light_clean) == "see now ok"


@pytest.mark.parametrize(
    ("raw", "clean"),
    [
        ("something", "sometng"), ("this", "ts"), ("children", "cldren"), ("r/abc x", "x"), ("@user x", "x"),
        ("a &amp; b", "a b"), ("42 x4", "x4"), ("<b>x</b>", "x"), ("don't", "do not"),
        ("x https://a.b/c?d y", "x y"),
    ],
)
def test_heavy_clean(one, raw, clean):
    assert one(raw, tx.heavy_clean) == clean


def test_heavy_clean_with_word_bounds(one):
    assert one("hi something etc", lambda t: tx.heavy_clean(t, word_bounds=True)) == "something"


@pytest.mark.parametrize(
    ("raw", "out"),
    [
        ("I don't", "I do not"), ("can't won't shan't", "cannot will not shall not"), ("it's Anna's", "it is Anna's"),
        ("they’ve I'm we'd you'll we're let's", "they have I am we would you will we are let us"), ("plain", "plain"),
    ],
)
def test_contractions(one, raw, out):
    assert one(raw, tx.expand_contractions) == out


def test_spaced_letters(one):
    assert one("p s y c h i a t r y and", tx.join_spaced_letters) == "psychiatry and"
    # The last letter joins only when a space follows it.
    assert one("p s y c h", tx.join_spaced_letters) == "psyc h"
    assert one("a b cd", tx.join_spaced_letters) == "ab cd"
    assert one("a bc d", tx.join_spaced_letters) == "a bc d"
    assert one("x  y\n\n z ", tx.flatten_lines) == "x y z"


@pytest.mark.parametrize(
    ("text", "n", "out"),
    [
        ("one two. three four five", 4, "one two."), ("one two three, four five", 4, "one two three,"),
        ("a, two three four five", 4, "a, two three four"), ("short one", 4, "short one"),
        (". two three four five", 4, ". two three four"),
    ],
)
def test_trim_to_sentence(one, text, n, out):
    assert one(text, lambda t: tx.trim_to_sentence(t, n)) == out


def test_query_variants(one):
    reply = "Here are three words\nStep one do this\nhow to cope now\nhow to cope now\nshort one\nmy own query here\nfeeling very lost today"
    got = one(reply, lambda t: tx.query_variants(F.lit("My own query here"), t))
    assert got == ["Here are three words", "how to cope now", "feeling very lost today"]
    few = one("only one good line", lambda t: tx.query_variants(F.lit("q"), t))
    assert few == ["q", "q coping strategies", "q emotional support"]


@pytest.mark.parametrize(("text", "value"), [("8.5/10", 8.5), ("great", 5.0), ("I say 7", 7.0), (None, 5.0)])
def test_first_number(one, text, value):
    assert one(text, tx.first_number) == value


@pytest.mark.parametrize(
    ("json", "title"),
    [('{"title":{"@value":"A b"}}', "A b"), ('{"title":"C"}', "C"), ("{}", "")],
)
def test_object_or_string(one, json, title):
    assert one(json, lambda t: tx.object_or_string(t, "title")) == title


def test_labels_joined(one):
    json = '{"exclusion":[{"label":{"@value":"x"}},{"label":"y"}]}'
    assert one(json, lambda t: tx.labels_joined(t, "exclusion")) == "x; y"
    assert one("{}", lambda t: tx.labels_joined(t, "exclusion")) == ""


def test_split_cases(spark):
    text = (
        "Preface\nCASE 1.1\n\nA Title\nJane Roe, M.D.\nJohn Doe, Ph.D.\nHe came in.\nSecond line.\nDiscussion\nIt was\nlong.\n"
        "Diagnoses\n• Major depres-\n  sive disorder\ncontinued\n• Anxiety\nSuggested Reading\nBook CASE\n"
        "CASE 1.2\nOther\nNo talk here."
    )
    rows = dm.split_cases(spark.createDataFrame([(1, text)], "id int, text string"), "id", "text").orderBy("case_no").collect()
    assert [r["case"] for r in rows] == ["A Title", "Other"]
    assert rows[0]["description"] == "He came in. Second line."
    assert rows[0]["discussion"] == "It was long."
    assert rows[0]["diagnosis"] == "• Major depressive disorder continued • Anxiety"
    assert (rows[1]["description"], rows[1]["discussion"], rows[1]["diagnosis"]) == ("No talk here.", "", "")


def test_char_chunks_keep_every_word_in_order():
    rnd = random.Random(7)
    text = "".join(rnd.choice(["word ", "other. ", "line\n", "para\n\n", "x" * 30 + " "]) for _ in range(400))
    chunks = dm.char_chunks(text, 100, 20)
    assert all(0 < len(c) <= 100 for c in chunks)
    position = 0
    for chunk in chunks:
        at = text.find(chunk, max(0, position - 40))
        assert at >= 0
        assert not text[position:at].strip()
        position = at + len(chunk)
    assert not text[position:].strip()
    assert dm.char_chunks("y" * 250, 100, 20)[0] == "y" * 100


def test_chunk_words_cover_the_text(spark):
    for n, expected in [(0, 0), (1, 1), (200, 1), (201, 2), (360, 2), (361, 3)]:
        df = spark.createDataFrame([(1, " ".join(str(i) for i in range(n)))], "id int, text string")
        rows = dm.chunk_words(df, "id", "text").orderBy("chunk_no").collect()
        assert len(rows) == expected
        if rows:
            assert rows[-1]["content"].split()[-1] == str(n - 1)
            assert all(len(r["content"].split()) <= 200 for r in rows)


def names(spark, *rows):
    return spark.createDataFrame(rows, "category string, name string, precedence int")


def test_remove_names(spark):
    docs = spark.createDataFrame(
        [(1, "a", "sad bird said hello to bird"), (2, "b", "sad bird"), (3, "a", "birdy stays"), (4, "c", "sad bird")],
        "id int, category string, text string",
    )
    listed = names(spark, ("a", "sad bird", 1), ("a", "hello", 2), ("b", "bird", 1))
    got = {r["id"]: r["text"] for r in dm.remove_names(docs, "id", "text", listed).collect()}
    assert got == {1: "said to bird", 2: "sad", 3: "birdy stays", 4: "sad bird"}


def test_remove_names_first_listed_wins_at_a_position(spark):
    docs = spark.createDataFrame([(1, "a", "x y z")], "id int, category string, text string")
    short_first = names(spark, ("a", "x", 1), ("a", "x y", 2), ("a", "y z", 3))
    long_first = names(spark, ("a", "x", 2), ("a", "x y", 1), ("a", "y z", 3))
    assert dm.remove_names(docs, "id", "text", short_first).first()["text"] == ""
    assert dm.remove_names(docs, "id", "text", long_first).first()["text"] == "z"


def test_mask_people(spark):
    docs = spark.createDataFrame(
        [(1, "a", "Anna Roe, met Bob. mail a.b@c.org"), (2, "a", None)], "id int, category string, text string"
    )
    listed = names(spark, ("a", "anna roe", 1), ("a", "bob", 2))
    got = {r["id"]: r["text"] for r in dm.mask_people(docs, "id", "text", listed).collect()}
    assert got == {1: "[PATIENT], met [PATIENT]. mail [PATIENT]", 2: ""}


def test_lemmatise_rebuilds_in_order(spark):
    docs = spark.createDataFrame([(1, ["cats", "run", "cats"]), (2, [])], "id int, tokens array<string>")
    lemmas = spark.createDataFrame([("cats", "cat")], "token string, lemma string")
    got = {r["id"]: r["tokens"] for r in dm.lemmatise(docs, "id", "tokens", lemmas).collect()}
    assert got == {1: ["cat", "run", "cat"], 2: []}


def test_distinct_n(spark):
    df = spark.createDataFrame([("q", "a b a b"), ("z", "one")], "g string, text string")
    got = {r["g"]: r["distinct_2"] for r in evaluation.distinct_n(df, ["g"], "text").collect()}
    assert got["q"] == pytest.approx(2 / 3)
    assert got["z"] == 0.0


def test_sentiment_negation(one):
    good = one("good", lambda t: evaluation.sentiment_score(t))
    bad = one("not good", lambda t: evaluation.sentiment_score(t))
    assert good == pytest.approx(1.9 / (1.9**2 + 15) ** 0.5)
    assert bad == pytest.approx(-1.9 * 0.74 / ((1.9 * 0.74) ** 2 + 15) ** 0.5)


def test_pairs_come_in_the_order_of_the_file(spark, tmp_path):
    from forumlens.sources.posts import read_pairs

    pairs = [(f"<{i % 7}{'=' * (i // 7)}>", f"label {i}") for i in range(300)] + [("(^", "cheek"), ("(^_^)", "happy"), ("^_^", "glad")]
    (tmp_path / "d.json").write_text(json.dumps(dict(pairs)))
    assert read_pairs(spark, str(tmp_path / "d.json")) == pairs
    text = "so (^_^) and ^_^ and <3===> end"
    want = text
    for k, v in pairs:
        want = want.replace(k, f" {v} ")
    got = spark.createDataFrame([(text,)], "t string").select(tx.replace_in_order(F.col("t"), read_pairs(spark, str(tmp_path / "d.json")))).first()[0]
    assert got.split() == want.split()
    with pytest.raises(ValueError, match="more than 5"):
        read_pairs(spark, str(tmp_path / "d.json"), bound=5)


def test_character_chunks_leave_in_bounded_batches(spark, monkeypatch):
    import pyarrow as pa

    rows = [(i, None if i % 7 == 0 else ("word %d. " % i) * (i * 3)) for i in range(60)] + [(None, "ends\n\nhere")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = sorted((k or -1, n, c) for k, t in rows for n, c in enumerate(dm.char_chunks(t, 100, 20) if t else []))
    got = dm.chunk_chars(df, "doc_id", "text", 100, 20)
    assert sorted((r["doc_id"] or -1, r["chunk_no"], r["content"]) for r in got.collect()) == want
    # One large batch comes out as many small ones.
    taken = {}
    monkeypatch.setattr(dm, "BYTES_AT_ONCE", 4096)
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, schema: taken.update(f=f))
    dm.chunk_chars(df, "doc_id", "text", 100, 20)
    whole = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in ((0, pa.int64()), (1, pa.string()))], names=["doc_id", "text"])
    out = list(taken["f"](iter([whole])))
    assert len(out) > 5 and max(b.nbytes for b in out) < 4 * 4096
    assert sorted((r["doc_id"] or -1, r["chunk_no"], r["content"]) for b in out for r in b.to_pylist()) == want
