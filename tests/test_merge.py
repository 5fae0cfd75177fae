"""Merging, sources and page parsing."""

import json

import pytest
from pyspark.sql import functions as F

from forumlens.operators import counts, merge
from forumlens.session import fresh_path
from forumlens.sources import html, posts


def test_existing_wins_and_first_tag_wins(spark):
    schema = "post_id string, tag string, at int"
    old = spark.createDataFrame([("1", "old", 0), ("2", "old", 1)], schema)
    new = spark.createDataFrame([("2", "new", 0), ("3", "b", 2), ("3", "a", 1)], schema)
    got = {r["post_id"]: r["tag"] for r in merge.merge_posts(old, new, "post_id", ["at"]).collect()}
    assert got == {"1": "old", "2": "old", "3": "a"}


def test_hot_key_is_combined_before_the_shuffle(spark):
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), "id")
    first = merge.dedup_first(rows, "k", ["id"])
    assert first.where("k = -1").first()["id"] == 0
    assert first.count() == 20_001
    plan = first._jdf.queryExecution().toString()
    assert "partial_min_by" in plan and "Window" not in plan


def test_read_posts_reports_missing_tags(spark):
    path = fresh_path(spark, "posts")
    schema = posts.POST
    posts.write_posts(spark.createDataFrame([("1", "t", "c", "a", None, 0, [], "x")], schema), path)
    with pytest.warns(UserWarning, match="'y'"):
        assert posts.read_posts(spark, path, ["x", "y"]).count() == 1
    with pytest.raises(ValueError), pytest.warns(UserWarning):
        posts.read_posts(spark, path, ["z"])


def test_json_list_and_checkpoint(spark, tmp_path):
    file = tmp_path / "e.json"
    file.write_text(json.dumps([{"code": "1", "t": "a"}, {"code": "2", "t": "b"}]))
    assert posts.read_entities(spark, str(file)).count() == 2
    path, calls = fresh_path(spark, "step"), []

    def step():
        calls.append(1)
        return spark.range(3)

    for reuse in (True, True, False):
        assert posts.checkpointed(spark, path, step, reuse=reuse).count() == 3
    assert len(calls) == 2


LISTING = """<html><div class="custom-message-list all-discussions">
<article><h3><a href="/t5">Tag</a> <a href="/t5/anx/td-p/123"> A <b>title</b></a></h3><p class="body-text">Body &amp; more<br>x</p>
<aside><div class="custom-tile-author-info"><a href="/u"><span> Ann </span></a></div>
<div class="custom-tile-category-content"><time> 2 weeks ago </time></div></aside><li class="custom-tile-replies"><b>7</b></li></article>
<article><h3><a href="/only-one">x</a></h3></article>
<article><h3><a>a</a><a href="/t5/anx/td-p/9">T</a></h3></div></article></div>
<a rel="next" href="https://x.org/page/2">Next</a></html>"""
THREAD = """<div class="lia-component-message-list-detail-with-inline-editors other"><div class="linear-message-list message-list">
<div><div class="lia-quilt-row lia-quilt-row-message-main">First <i>one</i></div></div><div>no main</div>
<div><div><div class="lia-quilt-row lia-quilt-row-message-main"><p>Second</div></div></div></div></div>"""


def test_listing_and_thread(spark):
    pages = spark.createDataFrame([(1, LISTING), (2, "<p>nothing"), (3, None)], "page_id int, html string")
    rows = html.listing_posts(pages).orderBy("post_id").collect()
    assert [r["post_id"] for r in rows] == ["123", "9"]
    first = rows[0].asDict()
    assert first["title"] == "A title" and first["content"] == "Body & more x" and first["author"] == "Ann"
    assert first["raw_date"] == "2 weeks ago" and first["n_comments"] == "7" and first["next_link"] == "https://x.org/page/2"
    assert rows[1]["n_comments"] == "0" and rows[1]["author"] == ""
    thread = spark.createDataFrame([(1, THREAD), (2, "<p>x")], "page_id int, html string")
    got = {r["page_id"]: r["comments"] for r in html.thread_comments(thread).collect()}
    assert got == {1: ["First one", "Second"], 2: []}


def test_page_fields(spark):
    page = '<title>A &amp; B</title><article><h1>H</h1><p>x<p>y<script>z</script></article><a rel="next" href="/rel">n</a>'
    row = html.page_fields(spark.createDataFrame([(1, "http://a/b/c?d=1", page)], "page_id int, url string, html string")).first()
    assert (row["post_id"], row["title"], row["heading"], row["body"]) == ("c?d=1", "A & B", "H", "H x y")
    assert row["next_link"] is None


def test_histogram_of_a_constant_group(spark):
    df = spark.createDataFrame([("a", 1.0)] * 3 + [("b", 0.0), ("b", 1.0), ("b", 0.5)], "g string, v double")
    got = {(r["g"], r["bin"]): r["n"] for r in counts.histogram(df, ["g"], "v").collect()}
    assert got == {("a", 11): 3, ("b", 1): 1, ("b", 11): 1, ("b", 20): 1}
