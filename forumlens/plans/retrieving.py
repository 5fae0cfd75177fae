"""Vector search, re-ranking and context assembly."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens import flows
from forumlens.functions import text as tx
from forumlens.functions import vectors as vec
from forumlens.operators import clusters, conversation, counts, embedding, evaluation, retrieval, search, vector_index
from forumlens.plans.registry import documents, query, table
from forumlens.plans.ingest import sql_strip, sql_words
from forumlens.session import fresh_path

# Embeddings read as passages and, at the same time, as a batch of queries.
PASSAGES_SQL = """passages AS (
  SELECT vec_id AS passage_id, CASE WHEN label % 4 = 0 THEN 'general' ELSE 'c' || CAST(label % 4 AS VARCHAR) END AS category,
    'passage ' || CAST(vec_id % 60 AS VARCHAR) AS content,
    ['positive', 'neutral', 'negative', 'mixed'][CAST(vec_id % 4 AS INTEGER) + 1] AS sentiment,
    embedding::DOUBLE[] AS embedding FROM embeddings)"""
VARIANTS_SQL = """variants AS (
  SELECT vec_id // 3 AS query_id, CAST(vec_id % 3 AS INTEGER) AS variant_no,
    'c' || CAST((vec_id // 3) % 5 AS VARCHAR) AS asked, embedding::DOUBLE[] AS embedding FROM embeddings),
routed AS (SELECT query_id, variant_no, CASE WHEN asked IN (SELECT category FROM passages) THEN asked ELSE 'general' END AS category,
    embedding FROM variants)"""


def hits_sql(k: int = 10, key: str = "passage_id") -> str:
    return f"""{PASSAGES_SQL}, {VARIANTS_SQL},
scored AS (SELECT r.query_id, r.variant_no, p.*, round(list_dot_product(r.embedding, p.embedding), 9) AS score
  FROM routed r JOIN passages p ON r.category = p.category),
per_variant AS (SELECT *, row_number() OVER (PARTITION BY query_id, variant_no ORDER BY score DESC, passage_id) AS rn FROM scored),
pooled AS (SELECT *, row_number() OVER (PARTITION BY query_id, {key} ORDER BY score DESC, passage_id) AS best
  FROM per_variant WHERE rn <= {k}),
hits AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, passage_id) AS rank FROM pooled WHERE best = 1)"""


def passages(spark: SparkSession, d: str) -> DataFrame:
    category = F.when(F.col("label") % 4 == 0, "general").otherwise(F.concat(F.lit("c"), (F.col("label") % 4).cast("string")))
    mood = F.get(F.array(*[F.lit(x) for x in ("positive", "neutral", "negative", "mixed")]), (F.col("vec_id") % 4).cast("int"))
    return table(spark, d, "embeddings").select(
        F.col("vec_id").alias("passage_id"),
        category.alias("category"),
        F.concat(F.lit("passage "), (F.col("vec_id") % 60).cast("string")).alias("content"),
        mood.alias("sentiment"),
        "embedding",
    )


def variants(spark: SparkSession, d: str) -> DataFrame:
    query_id = F.floor(F.col("vec_id") / 3)
    return table(spark, d, "embeddings").select(
        query_id.alias("query_id"),
        (F.col("vec_id") % 3).cast("int").alias("variant_no"),
        F.concat(F.lit("c"), (query_id % 5).cast("string")).alias("category"),
        "embedding",
    )


def queries_of(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("query_id"), "embedding", "label")


TOP_SQL = """pairs AS (SELECT q.vec_id AS query_id, p.vec_id AS doc_id, p.label AS doc_label, q.label AS label,
    round(list_dot_product(q.embedding::DOUBLE[], p.embedding::DOUBLE[]), 9) AS score FROM embeddings q, embeddings p),
top AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM pairs)"""


@query(
    "v2_vector_math",
    """WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e, lead(embedding::DOUBLE[], 1, list_value(0.0)) OVER (ORDER BY vec_id) AS f FROM embeddings)
    SELECT vec_id, round(list_dot_product(e, list_reverse(e)), 6) AS dot, round(list_cosine_similarity(e, list_reverse(e)), 6) AS cosine,
      round(sqrt(list_dot_product(e, e)), 6) AS norm, 0.0::DOUBLE AS zero_cosine,
      round(e[1] / sqrt(list_dot_product(e, e)), 6) AS first_unit FROM v""",
)
def v2(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("embedding")
    return table(spark, d, "embeddings").select(
        "vec_id",
        F.round(vec.dot(e, F.reverse(e)), 6).alias("dot"),
        F.round(vec.cosine(e, F.reverse(e)), 6).alias("cosine"),
        F.round(vec.norm(e), 6).alias("norm"),
        vec.cosine(e, F.transform(e, lambda x: x * 0)).alias("zero_cosine"),
        F.round(F.get(vec.l2_normalize(e), 0), 6).alias("first_unit"),
    )


@query(
    "v3_top_inner_product",
    f"WITH {TOP_SQL} SELECT query_id, doc_id, score, CAST(rank AS INTEGER) AS rank FROM top WHERE rank <= 10",
)
def v3(spark: SparkSession, d: str) -> DataFrame:
    corpus = table(spark, d, "embeddings").withColumnRenamed("vec_id", "doc_id")
    return search.top_inner_product(queries_of(spark, d), corpus, 10)


@query(
    "j5_score_within_label",
    f"""WITH {TOP_SQL}, own AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS r FROM pairs WHERE label = doc_label)
    SELECT query_id, doc_id, score, CAST(r AS INTEGER) AS rank FROM own WHERE r <= 5""",
)
def j5(spark: SparkSession, d: str) -> DataFrame:
    corpus = table(spark, d, "embeddings").withColumnRenamed("vec_id", "doc_id")
    asked = queries_of(spark, d).withColumn("routes", F.array("label"))
    found = search.top_inner_product(asked, corpus, 5, route="label", routes="routes")
    return found


# Share of the exact neighbours that the approximate search has to find.
RECALL = 0.9


@query("v5_approximate_top")
def v5(spark: SparkSession, d: str) -> DataFrame:
    corpus = table(spark, d, "embeddings").withColumnRenamed("vec_id", "doc_id")
    model = search.fit_cells(corpus, 16)
    probes = search.probes_for(queries_of(spark, d), corpus, 10, model, RECALL)
    return search.approximate_top(queries_of(spark, d), corpus, 10, model, probes)


def list_indexed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, int, int]:
    """Exact corpus, found rows, rows of the corpus and candidates per query of the list index."""
    corpus = table(spark, d, "embeddings").withColumnRenamed("vec_id", "doc_id")
    index = vector_index.build_index(corpus, fresh_path(spark, "lists"))
    probes, candidates = vector_index.tuned(index, queries_of(spark, d), corpus, 10, RECALL)
    return corpus, vector_index.list_search(index, queries_of(spark, d), corpus, 10, probes, candidates), index.rows, candidates


@query("v5_list_index")
def v5_list(spark: SparkSession, d: str) -> DataFrame:
    return list_indexed(spark, d)[1]


@query(
    "v5_list_recall",
    """SELECT count(*) AS queries, least(10, count(*)) * count(*) AS found, TRUE AS recall_met, TRUE AS scores_exact FROM embeddings""",
)
def v5_recall(spark: SparkSession, d: str) -> DataFrame:
    """Recall of the list index over all queries against the exact search, and whether every score is exact."""
    corpus, found, _, _ = list_indexed(spark, d)
    exact = search.top_inner_product(queries_of(spark, d), corpus, 10).select("query_id", "doc_id", F.col("score").alias("_s"))
    both = found.join(exact, ["query_id", "doc_id"], "full")
    return both.agg(
        F.count_distinct("query_id").alias("queries"),
        F.count("score").alias("found"),
        (F.count_if(F.col("score").isNotNull() & F.col("_s").isNotNull()) >= RECALL * F.count("_s")).alias("recall_met"),
        F.coalesce(F.bool_and(F.col("score") == F.col("_s")), F.lit(True)).alias("scores_exact"),
    )


@query("v1_embed")
def v1(spark: SparkSession, d: str) -> DataFrame:
    """Hashed TF-IDF of word tokens, unit length."""
    docs = documents(spark, d).select("doc_id", "text")
    return embedding.tfidf_vectors(docs, "text", 256).select("doc_id", "embedding")


@query(
    "f2_model_hook",
    f"""SELECT conv_id, turn, CAST(length(text) AS DOUBLE) AS chars, CAST(len({sql_words('text')}) AS DOUBLE) AS words FROM conversations""",
)
def f2(spark: SparkSession, d: str) -> DataFrame:
    """The batch hook with a stand-in for a model: text length and word count."""

    def make_model():
        import numpy as np

        return lambda texts: np.array([[len(t), len(t.split())] for t in texts], dtype="float32")

    talk = table(spark, d, "conversations").select("conv_id", "turn", "text")
    out = embedding.model_vectors(talk, "text", make_model, normalize=False)
    return out.select("conv_id", "turn", *[F.get("embedding", i).cast("double").alias(n) for i, n in enumerate(("chars", "words"))])


@query("v6_reduce_dims")
def v6(spark: SparkSession, d: str) -> DataFrame:
    return clusters.reduce_dims(table(spark, d, "embeddings"), 5).select("vec_id", "reduced")


@query(
    "w6_top_per_group",
    """SELECT lang, doc_id, n_chars, CAST(rn AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS rn
    FROM documents) WHERE rn <= 5""",
)
def w6(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("lang", "doc_id", "n_chars")
    return counts.top_k(docs, ["lang"], [F.desc("n_chars"), F.asc("doc_id")], 5)


@query("o3_first_rows", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 10")
def o3(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "lang").orderBy("doc_id").limit(10)


def hits(spark: SparkSession, d: str, key: str = "passage_id", carry=("content", "sentiment", "embedding")) -> DataFrame:
    return retrieval.retrieve(variants(spark, d), passages(spark, d), 10, dedup_key=key, carry=carry)


@query(
    "a8_best_per_passage",
    f"""WITH {hits_sql()} SELECT query_id, passage_id, max(score) AS score, count(*) AS n_variants
    FROM per_variant WHERE rn <= 10 GROUP BY query_id, passage_id""",
)
def a8(spark: SparkSession, d: str) -> DataFrame:
    routed = retrieval.with_fallback_category(variants(spark, d), passages(spark, d)).withColumn("routes", F.array("category"))
    each = search.top_inner_product(
        routed, passages(spark, d), 10, query_keys=("query_id", "variant_no"), carry=("passage_id",), route="category", routes="routes"
    )
    return each.groupBy("query_id", "passage_id").agg(F.max("score").alias("score"), F.count("*").alias("n_variants"))


@query(
    "q1_variant_texts",
    f"""WITH s AS (SELECT conv_id, turn, text, 'key ' || CAST(turn AS VARCHAR) AS q,
        ['original', 'multi', 'hyde'][CAST(turn % 3 AS INTEGER) + 1] AS strategy FROM conversations),
    g AS (SELECT *, list_filter(list_transform(string_split(text, chr(10)), lambda x: {sql_strip('x')}), lambda x: len({sql_words('x')}) > 2
        AND NOT regexp_matches(x, '(?i)^({'|'.join(tx.ECHO_OPENINGS)})') AND lower(x) <> lower(q)) AS good FROM s),
    u AS (SELECT *, list_filter(good, lambda x, i: list_position(good, x) = i)[1:5] AS uniq FROM g),
    v AS (SELECT conv_id, turn, CASE strategy WHEN 'original' THEN [q]
        WHEN 'multi' THEN CASE WHEN len(uniq) < 3 THEN [q, q || ' coping strategies', q || ' emotional support'] ELSE uniq END
        ELSE [{sql_strip("replace(array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: " + sql_strip('x') + "), lambda x: x <> ''), ' '), 'Document:', '')")}] END AS v FROM u)
    SELECT conv_id, turn, CAST(i AS INTEGER) AS variant_no, v[i + 1] AS text FROM (SELECT conv_id, turn, v, unnest(range(0, len(v))) AS i FROM v)""",
)
def variant_texts(spark: SparkSession, d: str) -> DataFrame:
    """Every message as a model reply; the strategy changes with the turn."""
    strategy = F.get(F.array(*[F.lit(s) for s in ("original", "multi", "hyde")]), (F.col("turn") % 3).cast("int"))
    asked = table(spark, d, "conversations").select(
        "conv_id", "turn", F.concat(F.lit("key "), F.col("turn").cast("string")).alias("query"),
        F.col("text").alias("reply"), strategy.alias("strategy"),
    )
    return retrieval.variant_texts(asked, ["conv_id", "turn"])


@query(
    "q1_retrieve",
    f"""WITH {hits_sql()} SELECT query_id, passage_id, content, score, CAST(rank AS INTEGER) AS rank FROM hits WHERE rank <= 10""",
)
def q1(spark: SparkSession, d: str) -> DataFrame:
    found = hits(spark, d, carry=("content",))
    return found.select("query_id", "passage_id", "content", "score", "rank")


@query(
    "q2_retrieve_by_content",
    f"""WITH {hits_sql(key='content')} SELECT query_id, passage_id, content, score, CAST(rank AS INTEGER) AS rank FROM hits WHERE rank <= 10""",
)
def q2(spark: SparkSession, d: str) -> DataFrame:
    found = hits(spark, d, "content", carry=())
    return found.select("query_id", "passage_id", "content", "score", "rank")


@query(
    "p9_score_threshold",
    f"""WITH {hits_sql()} SELECT query_id, passage_id, score FROM hits WHERE rank <= 10 AND score > 0.7""",
)
def p9(spark: SparkSession, d: str) -> DataFrame:
    found = hits(spark, d, carry=()).where(F.col("score") > 0.7)
    return found.select("query_id", "passage_id", "score")


# Small enough that long histories of the fixture are cut.
CONTEXT_BUDGET = 1200.0
MOOD_SQL = "CASE sentiment WHEN 'positive' THEN 0 WHEN 'neutral' THEN 1 WHEN 'negative' THEN 2 ELSE 3 END"


@query(
    "o1_custom_order",
    f"""WITH {hits_sql()} SELECT query_id, passage_id, sentiment, CAST(row_number() OVER (PARTITION BY query_id
      ORDER BY {MOOD_SQL}, score DESC, passage_id) AS INTEGER) AS place FROM hits WHERE rank <= 10""",
)
def o1(spark: SparkSession, d: str) -> DataFrame:
    found = hits(spark, d, carry=("sentiment",)).drop("rank")
    order = [retrieval.sentiment_rank(F.col("sentiment")), F.desc("score"), F.asc("passage_id")]
    return counts.top_k(found, ["query_id"], order, 10, "place").select("query_id", "passage_id", "sentiment", "place")


@query(
    "q3_rerank_diverse",
    f"""WITH {hits_sql()},
    listed AS (SELECT query_id, list([{{'id': passage_id, 's': sentiment, 'score': score, 'e': embedding}}]
      ORDER BY {MOOD_SQL}, score DESC, passage_id) AS found FROM hits WHERE rank <= 10 GROUP BY query_id),
    kept AS (SELECT query_id, list_reduce(found, lambda acc, h: CASE WHEN len(list_filter(acc,
      lambda o: list_cosine_similarity(o.e, h[1].e) > 0.3)) > 0 THEN acc ELSE list_concat(acc, h) END) AS kept FROM listed)
    SELECT query_id, CAST(i AS INTEGER) AS rank, kept[i].id AS passage_id, kept[i].s AS sentiment, kept[i].score AS score
    FROM (SELECT query_id, kept, unnest(range(1, least(len(kept), 5) + 1)) AS i FROM kept)""",
)
def q3(spark: SparkSession, d: str) -> DataFrame:
    found = hits(spark, d, carry=("sentiment", "embedding"))
    return retrieval.rerank_diverse(found, limit=0.3)


@query(
    "q4_match_entities",
    f"""WITH {TOP_SQL} SELECT query_id, doc_id AS entity_id, score FROM top WHERE rank <= 4 AND score > 0.35""",
)
def q4(spark: SparkSession, d: str) -> DataFrame:
    entities = table(spark, d, "embeddings").withColumnRenamed("vec_id", "entity_id")
    found = retrieval.match_entities(queries_of(spark, d), entities, 4, 0.35)
    return found.select("query_id", "entity_id", "score")


@query(
    "q5_assemble_context",
    f"""WITH t AS (SELECT conv_id, turn, role, text, 'k' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS query_id,
        (conv_id * 7 + turn) % (SELECT count(*) FROM embeddings) AS vec_id FROM conversations),
    h AS (SELECT *, list(role || ': ' || left(text, 50) || '...') OVER (PARTITION BY conv_id ORDER BY turn RANGE BETWEEN 4 PRECEDING AND 1 PRECEDING) AS hist FROM t),
    u AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS nth, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM h WHERE role = 'user'),
    rep AS (SELECT *, nth - max(CASE WHEN before IS NULL OR before <> text THEN nth END) OVER (PARTITION BY conv_id ORDER BY turn) AS repeats FROM u),
    {TOP_SQL},
    moods AS (SELECT query_id, doc_id, score, ['positive', 'neutral', 'negative', 'mixed'][CAST(doc_id % 4 AS INTEGER) + 1] AS sentiment FROM top WHERE rank <= 10),
    listed AS (SELECT query_id, list([{{'id': doc_id, 'e': embedding::DOUBLE[]}}] ORDER BY {MOOD_SQL}, score DESC, doc_id) AS found
      FROM moods JOIN embeddings ON vec_id = doc_id GROUP BY query_id),
    picked AS (SELECT query_id, list_reduce(found, lambda acc, h: CASE WHEN len(list_filter(acc,
      lambda o: list_cosine_similarity(o.e, h[1].e) > 0.3)) > 0 THEN acc ELSE list_concat(acc, h) END)[1:5] AS picked FROM listed),
    ctx AS (SELECT query_id AS vec_id, array_to_string(list_transform(picked, lambda h: 'passage ' || CAST(h.id AS VARCHAR)), chr(10) || chr(10) || '---' || chr(10) || chr(10)) AS context FROM picked),
    ent AS (SELECT query_id AS vec_id, string_agg('Disorder Name: entity ' || CAST(doc_id AS VARCHAR) || chr(10) || 'Disorder Code: ' || CAST(doc_label AS VARCHAR) || chr(10) || 'Disorder symptoms: none',
      chr(10) || chr(10) ORDER BY rank) AS entity_notes FROM top WHERE rank <= 4 AND score > 0.35 GROUP BY query_id),
    given AS (SELECT rep.query_id, rep.conv_id, rep.turn, text, CASE WHEN hist IS NULL THEN 'No prior history.' ELSE 'Conversation history summary: ' || array_to_string(hist, ' ') END AS history_summary,
      coalesce(context, '') AS context, coalesce(entity_notes, '') AS entity_notes,
      CASE WHEN repeats <= 1 THEN '' ELSE replace('{retrieval.REPEAT_NOTE}', '{{times}}', CAST(repeats + 1 AS VARCHAR))
        || CASE WHEN repeats >= 2 THEN '{retrieval.REPEAT_MORE}' ELSE '' END END AS repetition_note
      FROM rep LEFT JOIN ctx ON rep.vec_id = ctx.vec_id LEFT JOIN ent ON rep.vec_id = ent.vec_id),
    c AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos, role || ': ' || text AS line,
      len({sql_words('text')}) * 1.3 + 100 AS cost FROM conversations),
    room AS (SELECT g.*, c.pos, {CONTEXT_BUDGET} - c.cost - 100 - 1.3 * len({sql_words("context || ' ' || entity_notes || ' ' || repetition_note")}) AS left_over
      FROM given g JOIN c ON c.conv_id = g.conv_id AND c.turn = g.turn),
    cuts AS (SELECT r.query_id, i.i AS drop_n FROM room r, (SELECT unnest(range(0, 100, 2)) AS i) i WHERE i.i <= r.pos AND (r.pos - i.i <= 2
      OR coalesce((SELECT sum(x.cost) FROM c x WHERE x.conv_id = r.conv_id AND x.pos < r.pos AND x.pos >= i.i), 0) <= r.left_over)),
    first_kept AS (SELECT query_id, min(drop_n) AS drop_n FROM cuts GROUP BY query_id)
    SELECT r.query_id, history_summary, context, entity_notes, repetition_note, r.pos - drop_n AS n_kept,
      coalesce((SELECT string_agg(x.line, chr(10) ORDER BY x.pos) FROM c x WHERE x.conv_id = r.conv_id AND x.pos < r.pos AND x.pos >= drop_n), '') AS history
    FROM room r JOIN first_kept USING (query_id)""",
)
def q5(spark: SparkSession, d: str) -> DataFrame:
    """Hits of every question re-ranked, and its history cut to what the context leaves of the budget."""
    vectors = table(spark, d, "embeddings")
    id_of = F.concat(F.lit("k"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))
    talk = table(spark, d, "conversations").withColumn("query_id", id_of)
    place = (F.col("conv_id") * 7 + F.col("turn")) % vectors.agg(F.count("*")).scalar()
    asked = talk.where(F.col("role") == "user").select("query_id", place.alias("vec_id")).join(vectors, "vec_id")
    mood = F.get(F.array(*[F.lit(x) for x in ("positive", "neutral", "negative", "mixed")]), (F.col("vec_id") % 4).cast("int"))
    corpus = vectors.select(
        F.col("vec_id").alias("passage_id"),
        F.col("vec_id").alias("entity_id"),
        F.concat(F.lit("passage "), F.col("vec_id").cast("string")).alias("content"),
        mood.alias("sentiment"),
        F.concat(F.lit("entity "), F.col("vec_id").cast("string")).alias("name"),
        F.col("label").cast("string").alias("code"),
        F.lit("none").alias("description"),
        "embedding",
    )
    found = search.top_inner_product(asked, corpus, 10, carry=("passage_id", "content", "sentiment", "embedding"))
    entities = retrieval.match_entities(asked, corpus, 4, 0.35, carry=("name", "code", "description"))
    return flows.question_context(talk, found, entities, limit=0.3, budget=CONTEXT_BUDGET)


@query(
    "q6_leaf_entities",
    """SELECT CAST(n_nationkey + 100 AS BIGINT) AS entity_id, CAST(n_regionkey AS BIGINT) AS parent_id, 'N' || CAST(n_nationkey AS VARCHAR) AS code, n_name AS title
    FROM nation""",
)
def q6(spark: SparkSession, d: str) -> DataFrame:
    """Regions as blocks, nations as leaves below one root."""
    region = table(spark, d, "region").select(
        F.col("r_regionkey").cast("bigint").alias("entity_id"), F.lit(-1).cast("bigint").alias("parent_id"),
        F.lit("").alias("code"), F.concat(F.lit("Block "), "r_name").alias("title"),
    )
    nation = table(spark, d, "nation").select(
        (F.col("n_nationkey") + 100).cast("bigint").alias("entity_id"), F.col("n_regionkey").cast("bigint").alias("parent_id"),
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("code"), F.col("n_name").alias("title"),
    )
    top = region.agg(F.min("parent_id").alias("entity_id")).select(
        "entity_id", F.lit(None).cast("bigint").alias("parent_id"), F.lit("06").alias("code"), F.lit("Chapter 6").alias("title")
    )
    return retrieval.leaf_entities(top.unionByName(region).unionByName(nation), top.select("entity_id"))


@query(
    "e1_ndcg",
    f"""WITH {TOP_SQL}, g AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY doc_id) AS given, rank AS ideal, score
      FROM top WHERE rank <= 10)
    SELECT query_id, round(CASE WHEN sum(score / log2(ideal + 1)) FILTER (WHERE ideal <= 5) > 0 THEN
      sum(score / log2(given + 1)) FILTER (WHERE given <= 5) / sum(score / log2(ideal + 1)) FILTER (WHERE ideal <= 5) ELSE 0 END, 6) AS ndcg
    FROM g GROUP BY query_id""",
)
def e1(spark: SparkSession, d: str) -> DataFrame:
    """The ten best hits of every query listed by id, judged by their similarity."""
    corpus = table(spark, d, "embeddings").withColumnRenamed("vec_id", "doc_id")
    listed = search.top_inner_product(queries_of(spark, d), corpus, 10)
    return evaluation.ndcg_at_k(listed, ["query_id"], "doc_id", "score").withColumn("ndcg", F.round("ndcg", 6))


SAID_SQL = """said AS (SELECT conv_id, turn, role, embedding::DOUBLE[] AS e,
    max(CASE WHEN role = 'user' THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn) AS asked
  FROM conversations JOIN embeddings ON vec_id = (conv_id * 7 + turn) % (SELECT count(*) FROM embeddings)),
relevant AS (SELECT a.conv_id, a.turn, list_cosine_similarity(q.e, a.e) AS relevance
  FROM said a JOIN said q ON q.conv_id = a.conv_id AND q.turn = a.asked AND q.role = 'user' WHERE a.role = 'assistant')"""


def said(spark: SparkSession, d: str) -> DataFrame:
    """Messages with vectors of the fixture in place of a model's."""
    vectors = table(spark, d, "embeddings").select("vec_id", "embedding")
    place = (F.col("conv_id") * 7 + F.col("turn")) % vectors.agg(F.count("*")).scalar()
    return table(spark, d, "conversations").withColumn("vec_id", place).join(vectors, "vec_id").drop("vec_id")


@query("e2_answer_relevance", f"WITH {SAID_SQL} SELECT conv_id, turn, round(relevance, 6) AS relevance FROM relevant")
def e2_answers(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.answer_relevance(said(spark, d)).withColumn("relevance", F.round("relevance", 6))


@query(
    "e2_semantic_relevance",
    f"""WITH {TOP_SQL} SELECT t.query_id, round(avg(list_cosine_similarity(q.embedding::DOUBLE[], p.embedding::DOUBLE[])), 6) AS relevance
    FROM top t JOIN embeddings q ON q.vec_id = t.query_id JOIN embeddings p ON p.vec_id = t.doc_id WHERE rank <= 5 GROUP BY t.query_id""",
)
def e2(spark: SparkSession, d: str) -> DataFrame:
    corpus = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    found = search.top_inner_product(queries_of(spark, d), corpus, 5, carry=("doc_id", "embedding"))
    pairs = found.join(queries_of(spark, d).withColumnRenamed("embedding", "asked").drop("label"), "query_id")
    out = evaluation.semantic_relevance(pairs, ["query_id"], "asked", "embedding")
    return out.withColumn("relevance", F.round("relevance", 6))
