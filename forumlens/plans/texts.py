"""Text rules over documents and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.functions import text as tx
from forumlens.operators import documents as dm
from forumlens.operators.rows import exploded
from forumlens.plans.ingest import sql_collapse, sql_light, sql_strip, sql_words
from forumlens.plans.registry import documents, query, table


def lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_list(values) -> str:
    return "[" + ", ".join(lit(v) for v in values) + "]"


# Short pieces that occur in the documents; the first is contained in the second.
PIECES = [("th", "Love"), ("the", "Joy"), ("ei", "Sadness"), ("ein", "Anger"), ("ou", "Joy")]


def sql_replace(x: str, pairs, pad: bool = True) -> str:
    for k, v in pairs:
        x = f"replace({x}, {lit(k)}, {lit(' ' + v + ' ' if pad else v)})"
    return x


def sql_emoticons(x: str, pad_emoji: bool = False) -> str:
    return sql_replace(sql_replace(sql_replace(x, PIECES), tx.EMOTICONS), tx.EMOJI, pad=pad_emoji)


WITH_SMILEYS = "text || ' :-) <3 😀 it_is: ok :('"


def with_smileys() -> F.Column:
    return F.concat(F.col("text"), F.lit(" :-) <3 😀 it_is: ok :("))


@query("t2_emoticons_to_text", f"SELECT doc_id, lower({sql_strip(sql_emoticons(WITH_SMILEYS))}) AS text FROM documents")
def t2(spark: SparkSession, d: str) -> DataFrame:
    return documents(spark, d).select("doc_id", tx.emoticons_to_text(with_smileys(), PIECES).alias("text"))


# 512 overlapping keys in order; what one puts in is a key of another.
LETTERS = "etaoinsr"
THREES = [(a + b + c, c + b + a) for a in LETTERS for b in LETTERS for c in LETTERS]


def sql_fold(x: str, pairs: list[tuple[str, str]]) -> str:
    """Pair after pair over one value."""
    table = ", ".join(f"{{'k': {lit(k)}, 'v': {lit(f' {v} ')}}}" for k, v in pairs)
    return f"list_reduce(list_prepend({{'k': '', 'v': {x}}}, [{table}]), lambda t, p: {{'k': '', 'v': replace(t.v, p.k, p.v)}}).v"


@query("t2_large_dictionary", f"SELECT doc_id, lower({sql_strip(sql_replace(sql_replace('x', tx.EMOTICONS), tx.EMOJI, pad=False))}) AS text FROM (SELECT doc_id, {sql_fold('text', THREES)} AS x FROM documents)")
def t2_large(spark: SparkSession, d: str) -> DataFrame:
    return documents(spark, d).select("doc_id", tx.emoticons_to_text(F.col("text"), THREES).alias("text"))


@query(
    "t3_emoticons_without_aliases",
    f"""WITH r AS (SELECT doc_id, regexp_replace({sql_emoticons(WITH_SMILEYS)},
      '(?i)(:[^:]+:|_|\\b({'|'.join(tx.ALIAS_WORDS)})\\b)', ' ', 'g') AS x FROM documents)
    SELECT doc_id, lower({sql_strip("translate(x, ':_', '  ')")}) AS text FROM r""",
)
def t3(spark: SparkSession, d: str) -> DataFrame:
    out = tx.emoticons_without_aliases(with_smileys(), PIECES)
    return documents(spark, d).select("doc_id", out.alias("text"))


@query("t4_light_clean", f"SELECT doc_id, {sql_light(lit('see http://a.b/c ||| ') + ' || text')} AS text FROM documents")
def t4(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat(F.lit("see http://a.b/c ||| "), F.col("text"))
    return documents(spark, d).select("doc_id", tx.light_clean(raw).alias("text"))


def sql_contractions(x: str) -> str:
    rules = [
        ("’", "''"),
        (r"(?i)\b(w)on''t\b", r"\1ill not"), (r"(?i)\b(c)an''t\b", r"\1annot"), (r"(?i)\b(sh)an''t\b", r"\1all not"),
        (r"(?i)(\w)n''t\b", r"\1 not"), (r"(?i)\b(let)''s\b", r"\1 us"),
        (r"(?i)\b(it|he|she|that|what|where|who|there|here|how|when|why)''s\b", r"\1 is"),
        (r"(?i)\b(i)''m\b", r"\1 am"), (r"(?i)(\w)''re\b", r"\1 are"), (r"(?i)(\w)''ve\b", r"\1 have"),
        (r"(?i)(\w)''ll\b", r"\1 will"), (r"(?i)(\w)''d\b", r"\1 would"),
    ]
    for pattern, value in rules:
        x = f"regexp_replace({x}, '{pattern}', '{value}', 'g')"
    return x


def sql_heavy(x: str) -> str:
    pattern = "(?i)" + "|".join(tx.HEAVY_ALTERNATIVES).replace("'", "''")
    return sql_collapse(f"regexp_replace({sql_collapse(sql_contractions(x))}, '{pattern}', '', 'g')")


HEAVY_PREFIX = "Something r/abc &amp; <b>this</b> @user #tag 42 children https://a.b/c it's etc. "


@query("t5_heavy_clean", f"SELECT doc_id, {sql_heavy(lit(HEAVY_PREFIX) + ' || text')} AS text FROM documents")
def t5(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat(F.lit(HEAVY_PREFIX), F.col("text"))
    return documents(spark, d).select("doc_id", tx.heavy_clean(raw).alias("text"))


CONTRACTED = "I'm sure they don't, can't and won't; it's what we'd do, they've said. Anna's dog. "


@query("t6_expand_contractions", f"SELECT doc_id, {sql_contractions(lit(CONTRACTED) + ' || text')} AS text FROM documents")
def t6(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat(F.lit(CONTRACTED), F.col("text"))
    return documents(spark, d).select("doc_id", tx.expand_contractions(raw).alias("text"))


def sql_tokens(x: str, least: int = 1) -> str:
    return f"regexp_extract_all({x}, '[\\p{{L}}\\p{{N}}_]{{{least},}}')"


@query(
    "t7_tokenize",
    f"""SELECT doc_id, CAST(len({sql_tokens('text')}) AS INTEGER) AS n_tokens,
    md5(array_to_string({sql_tokens('text')}, ' ')) AS tokens_md5 FROM documents""",
)
def t7(spark: SparkSession, d: str) -> DataFrame:
    tokens = documents(spark, d).select("doc_id", tx.tokenize(F.col("text")).alias("t"))
    return tokens.select("doc_id", F.size("t").alias("n_tokens"), F.md5(F.array_join("t", " ")).alias("tokens_md5"))


# A general stop list for the fixture languages, next to the fixed domain words.
SHORT_STOP = [
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "not", "of", "on", "or", "that",
    "the", "this", "to", "was", "with", "de", "la", "le", "les", "et", "en", "un", "une", "que", "qui", "die", "der",
    "das", "und", "zu", "el", "los", "y",
]
STOP = SHORT_STOP + tx.DOMAIN_STOP_WORDS


@query(
    "t8_remove_stopwords",
    f"""SELECT doc_id, md5(array_to_string(list_filter({sql_tokens('lower(text)')},
      lambda t: NOT list_contains({sql_list(STOP)}, t)), ' ')) AS tokens_md5 FROM documents""",
)
def t8(spark: SparkSession, d: str) -> DataFrame:
    kept = tx.remove_stop_words(tx.tokenize(F.lower("text")), STOP)
    return documents(spark, d).select("doc_id", F.md5(F.array_join(kept, " ")).alias("tokens_md5"))


def lemma_table(spark: SparkSession, d: str) -> DataFrame:
    """Corpus words ending in -ing, mapped to their stem."""
    tokens = exploded(documents(spark, d), [], tx.tokenize(F.lower("text")), "token")
    words = tokens.where(F.col("token").rlike("^[a-z]{2,}ing$")).distinct()
    return words.select("token", F.regexp_replace("token", "ing$", "").alias("lemma"))


SQL_LEMMA = "CASE WHEN regexp_matches(t, '^[a-z]{2,}ing$') THEN regexp_replace(t, 'ing$', '') ELSE t END"


@query(
    "t9_lemmatise",
    f"""SELECT doc_id, md5(array_to_string(list_transform({sql_tokens('lower(text)')}, lambda t: {SQL_LEMMA}), ' ')) AS lemmas_md5
    FROM documents""",
)
def t9(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d).select("doc_id", tx.tokenize(F.lower("text")).alias("tokens"))
    out = dm.lemmatise(docs, "doc_id", "tokens", lemma_table(spark, d))
    return out.select("doc_id", F.md5(F.array_join("tokens", " ")).alias("lemmas_md5"))


# Lemmas apply to words seen in the raw corpus only; -ing words made by cleaning stay as they are.
PREPARED_SQL = f"""
known AS (SELECT list(DISTINCT token) AS known FROM (SELECT unnest({sql_tokens('lower(text)')}) AS token FROM documents)
  WHERE regexp_matches(token, '^[a-z]{{2,}}ing$')),
light AS (
  SELECT doc_id, lang, source, lower({sql_heavy('text')}) AS text_light FROM documents
  WHERE text IS NOT NULL AND {sql_strip('text')} <> ''),
both_variants AS (
  SELECT *, array_to_string(list_transform(list_filter({sql_tokens('text_light')},
    lambda t: NOT list_contains({sql_list(STOP)}, t)),
    lambda t: CASE WHEN list_contains(known, t) THEN regexp_replace(t, 'ing$', '') ELSE t END), ' ') AS text_lemma
  FROM light, known)"""


def prepared(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d).select("doc_id", "lang", "source", "text")
    return dm.topic_documents(docs, "doc_id", "text", STOP, lemma_table(spark, d))


@query(
    "t10_preprocess",
    f"""WITH {PREPARED_SQL}
    SELECT doc_id, md5(text_light) AS light_md5, md5(text_lemma) AS lemma_md5 FROM both_variants
    WHERE text_light <> '' AND text_lemma <> ''""",
)
def t10(spark: SparkSession, d: str) -> DataFrame:
    return prepared(spark, d).select("doc_id", F.md5("text_light").alias("light_md5"), F.md5("text_lemma").alias("lemma_md5"))


@query(
    "p5_both_variants_kept",
    f"""WITH {PREPARED_SQL}
    SELECT lang, count(*) AS posts FROM both_variants WHERE text_light <> '' AND text_lemma <> '' GROUP BY lang""",
)
def p5(spark: SparkSession, d: str) -> DataFrame:
    return prepared(spark, d).groupBy("lang").agg(F.count("*").alias("posts"))


@query("t11_join_spaced_letters")
def t11(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat(F.lit("p s y c h i a t r y  and\n  "), F.col("text"))
    return documents(spark, d).select("doc_id", tx.flatten_lines(raw).alias("text"))


@query("t12_split_cases")
def t12(spark: SparkSession, d: str) -> DataFrame:
    """Two numbered cases per document, the second without a discussion."""
    text = F.format_string(
        "Front\nCASE 1.%d\nFirst title\nA. Author, M.D.\n%s\nDiscussion\nIt was long.\nDiagnoses\n• one-\n two\nmore\n• three\n"
        "Suggested Reading\nA book\nCASE 2.%d\nSecond title\n%s",
        F.col("doc_id"), F.col("text"), F.col("doc_id"), F.col("text"),
    )
    docs = documents(spark, d).select("doc_id", text.alias("text"))
    return dm.split_cases(docs, "doc_id", "text")


def benchmark_names(spark: SparkSession, d: str) -> DataFrame:
    """First words of the benchmark passages as names, listed for the English documents."""
    first = F.lower(F.get(tx.words(F.col("text")), 0))
    names = table(spark, d, "benchmark").select(F.lit("en").alias("category"), first.alias("author"), "item_id")
    return dm.author_names(names, "item_id")


SQL_NAMES = f"""names AS (SELECT list(DISTINCT lower(({sql_words('text')})[1])) AS names FROM benchmark)"""


@query(
    "j9_remove_names",
    f"""WITH {SQL_NAMES}
    SELECT doc_id, array_to_string(CASE WHEN lang = 'en' THEN list_filter({sql_words('text')},
      lambda w: NOT list_contains(names, w)) ELSE {sql_words('text')} END, ' ') AS text
    FROM documents, names""",
)
def j9(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d).select("doc_id", F.col("lang").alias("category"), "text")
    return dm.remove_names(docs, "doc_id", "text", benchmark_names(spark, d)).select("doc_id", "text")


def sql_mask(x: str) -> str:
    for pattern in tx.IDENTIFIER_PATTERNS:
        x = f"regexp_replace({x}, '{pattern}', '[PATIENT]', 'g')"
    return x


@query("t13_mask_identifiers", f"SELECT doc_id, {sql_mask('text')} AS text FROM documents")
def t13(spark: SparkSession, d: str) -> DataFrame:
    return documents(spark, d).select("doc_id", tx.mask_identifiers(F.col("text")).alias("text"))


EDGE = r"[^\p{L}\p{N}_]"


@query(
    "t13_mask_people",
    f"""WITH {SQL_NAMES}, w AS (SELECT doc_id, lang, text, names, {sql_words('text')} AS w FROM documents, names),
    m AS (SELECT *, list_transform(w, lambda x: CASE WHEN lang = 'en' AND list_contains(names, regexp_replace(lower(x), '^{EDGE}+|{EDGE}+$', '', 'g'))
      THEN '[PATIENT]' || regexp_extract(x, '({EDGE}*)$', 1) ELSE x END) AS shown FROM w)
    SELECT doc_id, {sql_mask("CASE WHEN list_count(list_filter(shown, lambda x: starts_with(x, '[PATIENT]'))) > 0 THEN array_to_string(shown, ' ') ELSE text END")} AS text FROM m""",
)
def t13_people(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d).select("doc_id", F.col("lang").alias("category"), "text")
    return dm.mask_people(docs, "doc_id", "text", benchmark_names(spark, d)).select("doc_id", "text")


@query("t14_chunk_chars")
def t14(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d).select("doc_id", F.col("source").alias("source_pdf"), "text")
    return dm.chunk_chars(docs, "doc_id", "text")


@query(
    "t15_chunk_words",
    f"""WITH w AS (SELECT doc_id, {sql_words('text')} AS w FROM documents),
    c AS (SELECT doc_id, w, unnest(range(0, CAST(1 + ceil(greatest(len(w) - 200, 0) / 160.0) AS BIGINT))) AS chunk_no
      FROM w WHERE len(w) > 0)
    SELECT doc_id, CAST(chunk_no AS INTEGER) AS chunk_no,
      array_to_string(list_slice(w, chunk_no * 160 + 1, chunk_no * 160 + 200), ' ') AS content FROM c""",
)
def t15(spark: SparkSession, d: str) -> DataFrame:
    return dm.chunk_words(documents(spark, d).select("doc_id", "text"), "doc_id", "text")


@query(
    "t16_trim_to_sentence",
    f"""WITH w AS (SELECT conv_id, turn, text, {sql_words('text')} AS w FROM conversations),
    c AS (SELECT *, array_to_string(list_slice(w, 1, 30), ' ') AS cut FROM w),
    p AS (SELECT *, regexp_extract(cut, '(?s)^(.+[.!?])', 1) AS sentence, regexp_extract(cut, '(?s)^(.*,)', 1) AS clause FROM c)
    SELECT conv_id, turn, CASE WHEN len(w) <= 30 THEN {sql_strip('text')} WHEN sentence <> '' THEN sentence
      WHEN length(clause) - 1 > length(cut) * 0.5 THEN clause ELSE cut END AS answer FROM p""",
)
def t16(spark: SparkSession, d: str) -> DataFrame:
    answer = tx.trim_to_sentence(F.col("text"), 30)
    return table(spark, d, "conversations").select("conv_id", "turn", answer.alias("answer"))


@query("t17_token_estimate", f"SELECT conv_id, turn, round(len({sql_words('text')}) * 1.3 + 100, 6)::DOUBLE AS tokens FROM conversations")
def t17(spark: SparkSession, d: str) -> DataFrame:
    tokens = F.round(tx.token_estimate(F.col("text")), 6)
    return table(spark, d, "conversations").select("conv_id", "turn", tokens.alias("tokens"))


@query(
    "t18_object_or_string",
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 2 THEN '' ELSE c_name END AS title,
      CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment || '; ' || c_name ELSE '' END AS index_terms FROM customer""",
)
def t18(spark: SparkSession, d: str) -> DataFrame:
    """Records whose title is an object, a plain string or missing, as JSON text made from customers."""
    as_object = F.to_json(F.struct(F.struct(F.col("c_name").alias("@value")).alias("title")))
    as_string = F.to_json(F.struct(F.col("c_name").alias("title")))
    terms = F.to_json(
        F.struct(
            F.array(
                F.struct(F.col("c_mktsegment").alias("label"), F.lit(None).cast("string").alias("code")),
                F.struct(F.col("c_name").alias("label"), F.lit("x").alias("code")),
            ).alias("indexTerm")
        )
    )
    kind = F.col("c_custkey") % 3
    title = F.when(kind == 0, as_object).when(kind == 1, as_string).otherwise(F.lit("{}"))
    listed = F.when(F.col("c_custkey") % 2 == 0, terms).otherwise(F.lit("{}"))
    return table(spark, d, "customer").select(
        "c_custkey", tx.object_or_string(title, "title").alias("title"), tx.labels_joined(listed, "indexTerm").alias("index_terms")
    )


@query(
    "t19_query_variants",
    f"""WITH l AS (SELECT doc_id, source AS q, list_transform(string_split(text, chr(10)), lambda x: {sql_strip('x')}) AS lines FROM documents),
    g AS (SELECT doc_id, q, list_filter(lines, lambda x: len({sql_words('x')}) > 2
        AND NOT regexp_matches(x, '(?i)^({'|'.join(tx.ECHO_OPENINGS)})') AND lower(x) <> lower(q)) AS good FROM l),
    u AS (SELECT doc_id, q, list_filter(good, lambda x, i: list_position(good, x) = i)[1:5] AS good FROM g),
    r AS (SELECT doc_id, CASE WHEN len(good) < 3 THEN [q, q || ' coping strategies', q || ' emotional support'] ELSE good END AS v FROM u)
    SELECT doc_id, array_to_string(v, ' | ') AS variants FROM r""",
)
def t19(spark: SparkSession, d: str) -> DataFrame:
    variants = tx.query_variants(F.col("source"), F.col("text"))
    return documents(spark, d).select("doc_id", F.array_join(variants, " | ").alias("variants"))


@query(
    "t20_first_number",
    """SELECT event_id, coalesce(try_cast(nullif(regexp_extract(CASE WHEN event_id % 4 = 0 THEN 'great'
      ELSE 'score ' || CAST(value AS VARCHAR) || '/10' END, '([0-9]+(?:\\.[0-9]+)?)', 1), '') AS DOUBLE), 5.0) AS score FROM events""",
)
def t20(spark: SparkSession, d: str) -> DataFrame:
    written = F.concat(F.lit("score "), F.col("value").cast("string"), F.lit("/10"))
    reply = F.when(F.col("event_id") % 4 == 0, F.lit("great")).otherwise(written)
    return table(spark, d, "events").select("event_id", tx.first_number(reply).alias("score"))


@query(
    "t21_sentiment_bucket",
    """SELECT CASE WHEN s > 0.05 THEN 'positive' WHEN s < -0.05 THEN 'negative' ELSE 'neutral' END AS sentiment, count(*) AS n
    FROM (SELECT round(l_tax * 5 - l_quantity / 100, 4) AS s FROM lineitem) GROUP BY 1""",
)
def t21(spark: SparkSession, d: str) -> DataFrame:
    score = F.round(F.col("l_tax") * 5 - F.col("l_quantity") / 100, 4)
    bucket = tx.sentiment_bucket(score).alias("sentiment")
    return table(spark, d, "lineitem").groupBy(bucket).agg(F.count("*").alias("n"))


@query("t23_label_slug", "SELECT p_partkey, lower(replace(p_name, ' ', '_')) AS slug FROM part")
def t23(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", tx.label_slug(F.col("p_name")).alias("slug"))


@query(
    "q1_hypothetical_document",
    f"""SELECT conv_id, turn, {sql_strip("replace(array_to_string(list_filter(list_transform(string_split('Document: ' || text, chr(10)), lambda x: " + sql_strip('x') + "), lambda x: x <> ''), ' '), 'Document:', '')")} AS hyde
    FROM conversations""",
)
def hyde(spark: SparkSession, d: str) -> DataFrame:
    reply = F.concat(F.lit("Document: "), F.col("text"))
    return table(spark, d, "conversations").select("conv_id", "turn", tx.hypothetical_document(reply).alias("hyde"))


@query(
    "q1_usable_rewrite",
    f"""SELECT conv_id, turn, CASE WHEN len({sql_words('r')}) < 2 THEN text ELSE {sql_strip('r')} END AS query
    FROM (SELECT *, coalesce(CASE turn % 3 WHEN 0 THEN 'one' WHEN 1 THEN ' two words ' END, '') AS r FROM conversations)""",
)
def rewrite(spark: SparkSession, d: str) -> DataFrame:
    rewritten = F.when(F.col("turn") % 3 == 0, "one").when(F.col("turn") % 3 == 1, " two words ")
    return table(spark, d, "conversations").select("conv_id", "turn", tx.usable_rewrite(F.col("text"), rewritten).alias("query"))
