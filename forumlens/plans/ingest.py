"""Loading, cleaning and merging posts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.functions import text as tx
from forumlens.functions.dates import on_or_after, parse_relative_date
from forumlens.operators import counts, merge
from forumlens.plans.registry import documents, query, table
from forumlens.session import fresh_path
from forumlens.sources import html, posts

# Documents read as posts; some dates are missing.
POSTS_SQL = """posts AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS post_id, source AS title, text AS content,
         'User ' || CAST(doc_id % 97 AS VARCHAR) AS author,
         CASE WHEN doc_id % 11 <> 0 THEN CAST(DATE '2013-06-01' + CAST(doc_id * 37 % 4000 AS INTEGER) AS DATE) END AS post_date,
         CAST(n_chars % 50 AS INTEGER) AS n_comments, lang AS category
  FROM documents)"""


def posts_of(spark: SparkSession, d: str) -> DataFrame:
    day = F.date_add(F.lit("2013-06-01").cast("date"), (F.col("doc_id") * 37 % 4000).cast("int"))
    return table(spark, d, "documents").select(
        "doc_id",
        F.col("doc_id").cast("string").alias("post_id"),
        F.col("source").alias("title"),
        F.col("text").alias("content"),
        F.concat(F.lit("User "), (F.col("doc_id") % 97).cast("string")).alias("author"),
        F.when(F.col("doc_id") % 11 != 0, day).alias("post_date"),
        (F.col("n_chars") % 50).cast("int").alias("n_comments"),
        F.split("text", "\n").alias("comments"),
        F.col("lang").alias("category"),
    )


# RE2 has no Unicode \s: the wider class is spelled out.
WS = r"[\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
NOT_WS = WS.replace("[", "[^", 1)


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def sql_collapse(x: str) -> str:
    return sql_strip(f"regexp_replace({x}, '{WS}+', ' ', 'g')")


def sql_light(x: str) -> str:
    return sql_collapse(
        f"replace(regexp_replace({x}, 'https?://{NOT_WS}+|www\\.{NOT_WS}+', ' ', 'g'), '|||', ' ')"
    )


def sql_words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{WS}+'), lambda w: w <> '')"


FLAGSHIP_SQL = f"""
WITH cleaned AS (SELECT doc_id, lang, source, {sql_light('text')} AS model_text FROM documents),
ranked AS (SELECT *, row_number() OVER (PARTITION BY model_text ORDER BY doc_id) AS rn FROM cleaned),
kept AS (SELECT lang, source, model_text, len({sql_words('model_text')}) AS n_words FROM ranked WHERE rn = 1)
SELECT lang, source, count(*) AS posts, CAST(sum(n_words) AS BIGINT) AS words,
       round(avg(length(model_text)), 6) AS mean_chars
FROM kept WHERE n_words >= 3 GROUP BY lang, source"""


@query("flagship_clean_corpus", FLAGSHIP_SQL)
def flagship(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d).select("doc_id", "lang", "source", "text")
    cleaned = docs.select("doc_id", "lang", "source", tx.light_clean(F.col("text")).alias("model_text"))
    # The text is measured where it is cleaned; only its digest and numbers are shuffled.
    text = F.col("model_text")
    measured = cleaned.select(
        "doc_id", "lang", "source", F.sha2(text, 256).alias("digest"), tx.word_count(text).alias("n_words"), F.length(text).alias("chars")
    )
    kept = merge.dedup_first(measured, "digest", ["doc_id"]).where(F.col("n_words") >= 3)
    return kept.groupBy("lang", "source").agg(
        F.count("*").alias("posts"),
        F.sum("n_words").alias("words"),
        F.round(F.avg("chars"), 6).alias("mean_chars"),
    )


@query(
    "s1_read_posts",
    f"""WITH {POSTS_SQL}
    SELECT category AS tag, count(*) AS posts, count(post_date) AS dated, CAST(sum(n_comments) AS BIGINT) AS comments
    FROM posts WHERE category IN ('en', 'fr') GROUP BY category""",
)
def s1(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "posts")
    posts.write_posts(posts_of(spark, d), path)
    return posts.read_posts(spark, path, ["en", "fr"]).groupBy("tag").agg(
        F.count("*").alias("posts"), F.count("post_date").alias("dated"), F.sum("n_comments").alias("comments")
    )


@query(
    "s2_write_posts",
    f"""WITH {POSTS_SQL}
    SELECT category, count(*) AS posts, CAST(sum(length(content)) AS BIGINT) AS chars FROM posts GROUP BY category""",
)
def s2(spark: SparkSession, d: str) -> DataFrame:
    """Second write replaces one category only; the others must survive it."""
    path = fresh_path(spark, "posts")
    posts.write_posts(posts_of(spark, d), path)
    posts.write_posts(posts_of(spark, d).where(F.col("category") == "en"), path)
    stored = posts.read_posts(spark, path, ["en", "fr", "de", "es"])
    return stored.groupBy("category").agg(F.count("*").alias("posts"), F.sum(F.length("content")).alias("chars"))


@query(
    "s3_write_corpus",
    """SELECT CAST(vec_id AS VARCHAR) AS post_id, CAST(label AS VARCHAR) AS tag, md5(coalesce(text, '')) AS text_md5,
       CAST(DATE '2015-01-01' + CAST(vec_id % 3000 AS INTEGER) AS VARCHAR) AS post_date, len(embedding) AS dims,
       round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 6) AS total
       FROM embeddings LEFT JOIN documents ON doc_id = vec_id""",
)
def s3(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "corpus")
    texts = table(spark, d, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    vectors = table(spark, d, "embeddings").join(texts, "vec_id", "left").select(
        F.col("vec_id").cast("string").alias("post_id"),
        F.col("label").cast("string").alias("tag"),
        "text",
        F.date_add(F.lit("2015-01-01").cast("date"), (F.col("vec_id") % 3000).cast("int")).alias("post_date"),
        "embedding",
    )
    posts.write_corpus(vectors, path)
    total = F.aggregate("embedding", F.lit(0.0).cast("double"), lambda s, x: s + x.cast("double"))
    return spark.read.parquet(path).select(
        "post_id", "tag", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"), F.col("post_date").cast("string").alias("post_date"),
        F.size("embedding").cast("bigint").alias("dims"), F.round(total, 6).alias("total"),
    )


@query("s4_csv_round_trip", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def s4(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "csv")
    docs = table(spark, d, "documents")
    posts.write_csv(docs, path)
    return posts.read_csv(spark, path, docs.schema)


@query("s5_read_entities", "SELECT p_partkey AS entity_id, p_name AS fully_specified_name, p_type AS code FROM part")
def s5(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "entities")
    table(spark, d, "part").select(
        F.col("p_partkey").alias("entity_id"), F.col("p_name").alias("fully_specified_name"), F.col("p_type").alias("code")
    ).write.json(path)
    return posts.read_entities(spark, path, "entity_id bigint, fully_specified_name string, code string", lines=True)


@query("s6_read_whole_text", "SELECT count(*) AS lines, CAST(sum(length(p_name)) AS BIGINT) AS chars FROM part")
def s6(spark: SparkSession, d: str) -> DataFrame:
    """Files written by Spark, each read back as one row and split into its lines."""
    path = fresh_path(spark, "text")
    table(spark, d, "part").select("p_name").repartition(4).write.text(path)
    lines = posts.read_whole_text(spark, path).select(F.explode(F.split("value", "\n")).alias("line"))
    return lines.where(F.col("line") != "").agg(F.count("*").alias("lines"), F.sum(F.length("line")).alias("chars"))


def _sql_plain(x: str) -> str:
    out = f"regexp_replace({x}, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g')"
    out = f"regexp_replace({out}, '<[^>]*>', ' ', 'g')"
    for entity, char in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")]:
        out = f"replace({out}, '{entity}', '{char}')"
    return sql_collapse(out)


@query(
    "s7_html_extract",
    f"""SELECT page_id, url, list_last(string_split(url, '/')) AS post_id,
      {_sql_plain("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")} AS title,
      {_sql_plain("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")} AS heading,
      {_sql_plain("regexp_extract(html, '(?is)<article[^>]*>(.*?)</article>', 1)")} AS body,
      array_to_string(regexp_extract_all(html, '(?i)<a\\s[^>]*?href="([^"]*)"', 1), ' ') AS links,
      CASE WHEN starts_with(regexp_extract(regexp_extract(html, '(?i)(<a\\s[^>]*?rel="next"[^>]*>)', 1), 'href="([^"]*)"', 1), 'http')
        THEN regexp_extract(regexp_extract(html, '(?i)(<a\\s[^>]*?rel="next"[^>]*>)', 1), 'href="([^"]*)"', 1) END AS next_link
    FROM pages""",
)
def s7(spark: SparkSession, d: str) -> DataFrame:
    return html.page_fields(table(spark, d, "pages")).withColumn("links", F.array_join("links", " "))


@query(
    "s7_forum_listing",
    f"""SELECT page_id, '/t5/x/' || CAST(page_id AS VARCHAR) AS href, CAST(page_id AS VARCHAR) AS post_id,
      {_sql_plain("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")} AS title,
      {_sql_plain("regexp_extract(html, '(?is)<article[^>]*>(.*?)</article>', 1)")} AS content,
      'User' AS author, '2 weeks ago' AS raw_date, '0' AS n_comments, CAST(NULL AS VARCHAR) AS next_link
    FROM pages""",
)
def s7_listing(spark: SparkSession, d: str) -> DataFrame:
    """Stored pages rewritten into discussion lists by Spark, then parsed as such."""
    fields = html.page_fields(table(spark, d, "pages"))
    esc = lambda c: F.replace(F.replace(F.col(c), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    item = F.concat(
        F.lit('<article><h3><a href="#">tag</a><a href="/t5/x/'), F.col("page_id").cast("string"), F.lit('">'),
        esc("title"), F.lit('</a></h3><p class="body-text">'), esc("body"),
        F.lit('</p><aside><div class="custom-tile-author-info"><a><span>User</span></a></div>'
              '<div class="custom-tile-category-content"><time>2 weeks ago</time></div></aside></article>'),
    )
    listing = fields.select(
        "page_id", F.concat(F.lit('<div class="custom-message-list all-discussions">'), item, F.lit("</div>")).alias("html")
    )
    return html.listing_posts(listing)


@query(
    "s7_thread_comments",
    f"""SELECT page_id, {_sql_plain("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")} || ' ||| ' ||
      {_sql_plain("regexp_extract(html, '(?is)<article[^>]*>(.*?)</article>', 1)")} AS comments FROM pages""",
)
def s7_comments(spark: SparkSession, d: str) -> DataFrame:
    """Stored pages rewritten into threads of two messages by Spark, then parsed as such."""
    fields = html.page_fields(table(spark, d, "pages"))
    esc = lambda c: F.replace(F.replace(F.col(c), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    message = lambda c: F.concat(F.lit(f'<div><div class="{html.MESSAGE}">'), esc(c), F.lit("</div></div>"))
    thread = F.concat(
        F.lit(f'<div class="{html.THREAD}"><div class="{html.MESSAGES}">'), message("title"), message("body"), F.lit("</div></div>")
    )
    found = html.thread_comments(fields.select("page_id", thread.alias("html")))
    return found.select("page_id", F.array_join("comments", " ||| ").alias("comments"))


@query("s8_checkpointed", "SELECT lang, count(*) AS n FROM documents GROUP BY lang")
def s8(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "step")
    step = lambda: table(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("n"))
    posts.checkpointed(spark, path, step)
    return posts.checkpointed(spark, path, step, reuse=True)


@query(
    "p1_combine_text",
    f"""WITH {POSTS_SQL}, c AS (SELECT post_id, {sql_strip("coalesce(title, '') || ' ' || coalesce(content, '')")} AS combined_text FROM posts)
    SELECT * FROM c WHERE length(combined_text) > 0""",
)
def p1(spark: SparkSession, d: str) -> DataFrame:
    out = posts_of(spark, d).select("post_id", tx.combined(F.col("title"), F.col("content")).alias("combined_text"))
    return out.where(F.length("combined_text") > 0)


@query(
    "p2_min_words",
    f"""SELECT conv_id, turn, CAST(len({sql_words('text')}) AS INTEGER) AS n_words FROM conversations
    WHERE len({sql_words('text')}) >= 3""",
)
def p2(spark: SparkSession, d: str) -> DataFrame:
    counted = table(spark, d, "conversations").select("conv_id", "turn", tx.word_count(F.col("text")).alias("n_words"))
    return counted.where(F.col("n_words") >= 3)


@query(
    "p3_cutoff",
    f"""WITH {POSTS_SQL} SELECT post_id, CAST(post_date AS VARCHAR) AS post_date FROM posts
    WHERE post_date IS NULL OR post_date >= DATE '2015-01-01'""",
)
def p3(spark: SparkSession, d: str) -> DataFrame:
    kept = posts_of(spark, d).where(on_or_after(F.col("post_date"), "2015-01-01"))
    return kept.select("post_id", F.col("post_date").cast("string").alias("post_date"))


@query("p4_non_empty", f"SELECT doc_id FROM documents WHERE text IS NOT NULL AND {sql_strip('text')} <> ''")
def p4(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where(F.col("text").isNotNull() & (tx.strip(F.col("text")) != "")).select("doc_id")


@query(
    "p6_by_category",
    f"WITH {POSTS_SQL} SELECT category, count(*) AS posts, count(DISTINCT author) AS authors FROM posts GROUP BY category",
)
def p6(spark: SparkSession, d: str) -> DataFrame:
    """What a loop over labels does one by one, with the label as grouping key."""
    return posts_of(spark, d).groupBy("category").agg(
        F.count("*").alias("posts"), F.countDistinct("author").alias("authors")
    )


LANGUAGES = {"en": "English", "fr": "French", "de": "German", "es": "Spanish"}


@query(
    "p10_mapped_label",
    f"""WITH {POSTS_SQL} SELECT post_id, category AS tag,
    CASE category {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in LANGUAGES.items())} END AS label FROM posts""",
)
def p10(spark: SparkSession, d: str) -> DataFrame:
    picked = posts_of(spark, d).select("post_id", F.col("category").alias("tag"))
    return merge.mapped(picked, "tag", LANGUAGES, "label")


@query(
    "p11_entity_text",
    """SELECT p_partkey, concat_ws(' ', nullif(trim(p_name), ''), CASE WHEN p_size % 2 = 0 THEN p_type END, p_brand) AS content
    FROM part""",
)
def p11(spark: SparkSession, d: str) -> DataFrame:
    text = tx.entity_text(F.col("p_name"), F.when(F.col("p_size") % 2 == 0, F.col("p_type")), F.col("p_brand"))
    return table(spark, d, "part").select("p_partkey", text.alias("content"))


@query(
    "p12_missing_values",
    f"""WITH {POSTS_SQL} SELECT category, count(*) FILTER (WHERE post_date IS NULL) AS undated,
    count(*) FILTER (WHERE coalesce(CASE WHEN doc_id % 5 = 0 THEN NULL ELSE content END, '') = '') AS blank
    FROM posts GROUP BY category""",
)
def p12(spark: SparkSession, d: str) -> DataFrame:
    content = F.coalesce(F.when(F.col("doc_id") % 5 != 0, F.col("content")), F.lit(""))
    return posts_of(spark, d).groupBy("category").agg(
        F.count_if(F.col("post_date").isNull()).alias("undated"), F.count_if(content == "").alias("blank")
    )


@query(
    "j1_attach_posts",
    f"""WITH {POSTS_SQL} SELECT l.doc_id, l.toxic, p.author, p.category FROM labels l LEFT JOIN posts p ON p.doc_id = l.doc_id""",
)
def j1(spark: SparkSession, d: str) -> DataFrame:
    raw = posts_of(spark, d).select("doc_id", "author", "category")
    out = merge.attach(table(spark, d, "labels"), merge.union_all(raw, raw), "doc_id", ["author"])
    return out.select("doc_id", "toxic", "author", "category")


@query(
    "j2_unseen",
    "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def j2(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "lang")
    return merge.unseen(docs, table(spark, d, "labels"), "doc_id")


@query(
    "a1_dedup_first",
    """WITH r AS (SELECT doc_id, lang, source, md5(text) AS text_md5,
      row_number() OVER (PARTITION BY text ORDER BY source, doc_id) AS rn FROM documents)
    SELECT doc_id, lang, source, text_md5 FROM r WHERE rn = 1""",
)
def a1(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "text")
    return merge.dedup_text(docs, "text", ["source", "doc_id"]).select(
        "doc_id", "lang", "source", F.md5("text").alias("text_md5")
    )


@query(
    "a2_posts_per_year",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, trim(o_orderpriority) AS category, count(*) AS post_count
    FROM orders GROUP BY 1, 2""",
)
def a2(spark: SparkSession, d: str) -> DataFrame:
    return counts.posts_per_year(table(spark, d, "orders"), "o_orderdate", "o_orderpriority")


@query(
    "a7_distinct_values",
    f"WITH {POSTS_SQL} SELECT DISTINCT category, title FROM posts",
)
def a7(spark: SparkSession, d: str) -> DataFrame:
    """One row per distinct value: a list of all authors of a category need not fit one task."""
    return posts_of(spark, d).select("category", "title").distinct()


@query(
    "u1_union_frames",
    """SELECT doc_id, lang, 'old' AS batch, CAST(-1 AS INTEGER) AS toxic FROM documents
    UNION ALL SELECT doc_id, '', 'new', CAST(toxic AS INTEGER) FROM labels""",
)
def u1(spark: SparkSession, d: str) -> DataFrame:
    old = table(spark, d, "documents").select("doc_id", "lang", F.lit("old").alias("batch"))
    new = table(spark, d, "labels").select("doc_id", "toxic", F.lit("new").alias("batch"))
    both = merge.union_all(old, new.withColumn("toxic", F.col("toxic").cast("int")))
    return both.na.fill({"lang": "", "toxic": -1})


MERGE_SQL = f"""WITH {POSTS_SQL},
both_sides AS (
  SELECT 0 AS is_new, post_id, title, author, doc_id FROM posts WHERE doc_id % 3 <> 0
  UNION ALL SELECT 1, post_id, 'again', author, doc_id FROM posts WHERE doc_id % 3 <> 1),
r AS (SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY is_new, doc_id) AS rn FROM both_sides)
SELECT post_id, title, author, doc_id FROM r WHERE rn = 1"""


@query("u2_merge_posts", MERGE_SQL)
def u2(spark: SparkSession, d: str) -> DataFrame:
    rows = posts_of(spark, d).select("post_id", "title", "author", "doc_id")
    existing = rows.where(F.col("doc_id") % 3 != 0)
    new = rows.where(F.col("doc_id") % 3 != 1).withColumn("title", F.lit("again"))
    return merge.merge_posts(existing, new, "post_id", ["doc_id"])


DATE_TEXT = [
    "{n} hours ago", "{n} minutes ago", "Monday", " wednesday ", "{n} weeks ago", "{n} months ago",
    "{d}-{m}-2020", "yesterday", "{n} days ago", "sunday",
]


@query(
    "t1_relative_dates",
    """WITH raw AS (
      SELECT event_id, CAST(ts AS DATE) AS as_of, CASE event_id % 10
        WHEN 0 THEN CAST(event_id % 23 AS VARCHAR) || ' hours ago' WHEN 1 THEN CAST(event_id % 23 AS VARCHAR) || ' minutes ago'
        WHEN 2 THEN 'Monday' WHEN 3 THEN ' wednesday ' WHEN 4 THEN CAST(event_id % 23 AS VARCHAR) || ' weeks ago'
        WHEN 5 THEN CAST(event_id % 23 AS VARCHAR) || ' months ago'
        WHEN 6 THEN CAST(event_id % 31 AS VARCHAR) || '-' || CAST(event_id % 13 AS VARCHAR) || '-2020'
        WHEN 7 THEN 'yesterday' WHEN 8 THEN CAST(event_id % 23 AS VARCHAR) || ' days ago' ELSE 'sunday' END AS raw
      FROM events),
    t AS (SELECT *, lower(trim(raw)) AS x FROM raw)
    SELECT event_id, CAST(CASE
      WHEN regexp_matches(x, '[0-9]+\\s*(hour|minute|min)') THEN as_of
      WHEN x IN ('monday', 'wednesday', 'sunday') THEN as_of - CAST((isodow(as_of) - 1 -
        CASE x WHEN 'monday' THEN 0 WHEN 'wednesday' THEN 2 ELSE 6 END + 7) % 7 AS INTEGER)
      WHEN regexp_matches(x, '[0-9]+\\s*week') THEN as_of - 7 * CAST(regexp_extract(x, '([0-9]+)\\s*week', 1) AS INTEGER)
      WHEN regexp_matches(x, '[0-9]+\\s*month') THEN as_of - 30 * CAST(regexp_extract(x, '([0-9]+)\\s*month', 1) AS INTEGER)
      ELSE CAST(try_strptime(x, '%d-%m-%Y') AS DATE) END AS VARCHAR) AS post_date
    FROM t""",
)
def t1(spark: SparkSession, d: str) -> DataFrame:
    number = (F.col("event_id") % 23).cast("string")
    forms = []
    for form in DATE_TEXT:
        out = F.replace(F.lit(form), F.lit("{n}"), number)
        out = F.replace(out, F.lit("{d}"), (F.col("event_id") % 31).cast("string"))
        forms.append(F.replace(out, F.lit("{m}"), (F.col("event_id") % 13).cast("string")))
    raw = F.get(F.array(*forms), (F.col("event_id") % 10).cast("int"))
    day = parse_relative_date(raw, F.col("ts").cast("date"))
    return table(spark, d, "events").select("event_id", day.cast("string").alias("post_date"))


@query(
    "t22_year_and_comments",
    """SELECT doc_id, CAST(year(DATE '2013-06-01' + CAST(doc_id * 37 % 4000 AS INTEGER)) AS INTEGER) AS year,
      array_to_string(string_split(text, chr(10)), ' ||| ') AS comments,
      CAST(len(string_split(text, chr(10))) AS INTEGER) AS n_comments
    FROM documents WHERE doc_id % 11 <> 0""",
)
def t22(spark: SparkSession, d: str) -> DataFrame:
    dated = posts_of(spark, d).where(F.col("post_date").isNotNull())
    joined = dated.select("doc_id", F.year("post_date").alias("year"), F.array_join("comments", " ||| ").alias("comments"))
    return joined.withColumn("n_comments", F.size(F.split("comments", r" \|\|\| ")))
