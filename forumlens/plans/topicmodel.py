"""Topic modelling: vocabularies, topic words, coherence, clusters and quality scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.functions.text import words
from forumlens.operators import clusters, coherence, counts, density, embedding, graph, merge, topics
from forumlens.plans.registry import documents, query, table
from forumlens.plans.texts import SHORT_STOP, sql_list, sql_tokens, sql_words

# Documents with their language as category and their source as topic; source 0 plays the outliers.
TOPIC_DOCS_SQL = "topic_docs AS (SELECT doc_id, lang AS category, CAST(substr(source, 4) AS INTEGER) - 1 AS topic, text FROM documents)"

NGRAMS_SQL = f"""{TOPIC_DOCS_SQL},
toks AS (SELECT doc_id, category, topic, list_filter({sql_tokens('lower(text)', 2)}, lambda t: NOT list_contains({sql_list(SHORT_STOP)}, t)) AS t FROM topic_docs),
grams AS (SELECT doc_id, category, topic, unnest(list_concat(t, list_concat(
    list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]),
    list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2])))) AS term FROM toks)"""


def topic_docs(spark: SparkSession, d: str) -> DataFrame:
    topic = F.substring("source", 4, 9).cast("int") - 1
    return documents(spark, d).select("doc_id", F.col("lang").alias("category"), topic.alias("topic"), "text")


@query(
    "m1_ngram_counts",
    f"WITH {NGRAMS_SQL} SELECT category, term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM grams GROUP BY category, term",
)
def m1(spark: SparkSession, d: str) -> DataFrame:
    return topics.ngram_counts(topic_docs(spark, d), ["category"], "text", SHORT_STOP)


SETTINGS = [("en", 2, 0.4), ("fr", 3, 0.3), ("de", 2, 0.5)]
DEFAULTS = {"min_df": 4, "max_df": 0.9}
VOCABULARY_SQL = f"""{NGRAMS_SQL},
counted AS (SELECT category, term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM grams GROUP BY category, term),
sized AS (SELECT category, count(*) AS n_docs FROM topic_docs GROUP BY category),
config AS (SELECT s.category, s.n_docs, coalesce(c.min_df, 4) AS min_df, coalesce(c.max_df, 0.9) AS max_df FROM sized s
  LEFT JOIN (VALUES ('en', 2, 0.4), ('fr', 3, 0.3), ('de', 2, 0.5)) c(category, min_df, max_df) ON c.category = s.category),
unwanted AS (SELECT lang AS category, lower(({sql_words('text')})[1]) AS term FROM documents),
vocab AS (SELECT category, term FROM counted JOIN config USING (category) WHERE df >= min_df AND df <= max_df::DOUBLE * n_docs
  AND NOT EXISTS (SELECT 1 FROM unwanted u WHERE u.category = counted.category AND u.term = counted.term))"""


def settings(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SETTINGS, "category string, min_df int, max_df double")


def unwanted(spark: SparkSession, d: str) -> DataFrame:
    first = F.lower(F.get(words(F.col("text")), 0))
    return documents(spark, d).select(F.col("lang").alias("category"), first.alias("term")).distinct()


def vocabulary(spark: SparkSession, d: str) -> DataFrame:
    docs = topic_docs(spark, d)
    config = topics.category_config(docs, settings(spark), DEFAULTS)
    sized = docs.groupBy("category").agg(F.count("*").alias("n_docs"))
    return topics.vocabulary(topics.ngram_counts(docs, ["category"], "text", SHORT_STOP), sized, config, unwanted(spark, d))


@query("m2_vocabulary", f"WITH {VOCABULARY_SQL} SELECT category, term FROM vocab")
def m2(spark: SparkSession, d: str) -> DataFrame:
    return vocabulary(spark, d)


@query(
    "j8_unwanted_terms",
    f"""WITH {NGRAMS_SQL}, unwanted AS (SELECT lang AS category, lower(({sql_words('text')})[1]) AS term FROM documents)
    SELECT category, count(*) AS n_terms FROM (SELECT DISTINCT category, term FROM grams) g
    WHERE NOT EXISTS (SELECT 1 FROM unwanted u WHERE u.category = g.category AND u.term = g.term) GROUP BY category""",
)
def j8(spark: SparkSession, d: str) -> DataFrame:
    counted = topics.ngram_counts(topic_docs(spark, d), ["category"], "text", SHORT_STOP)
    left = counted.join(unwanted(spark, d), ["category", "term"], "left_anti")
    return left.groupBy("category").agg(F.count("*").alias("n_terms"))


@query(
    "m15_category_config",
    """SELECT s.category, CAST(coalesce(c.min_df, 4) AS INTEGER) AS min_df, coalesce(c.max_df, 0.9)::DOUBLE AS max_df
    FROM (SELECT DISTINCT lang AS category FROM documents) s
    LEFT JOIN (VALUES ('en', 2, 0.4), ('fr', 3, 0.3), ('de', 2, 0.5)) c(category, min_df, max_df) ON c.category = s.category""",
)
def m15(spark: SparkSession, d: str) -> DataFrame:
    return topics.category_config(topic_docs(spark, d), settings(spark), DEFAULTS)


WEIGHTS_SQL = f"""{NGRAMS_SQL},
tt AS (SELECT category, topic, term, count(*) AS tf FROM grams GROUP BY ALL),
pt AS (SELECT category, topic, sum(tf) AS n_words FROM tt GROUP BY ALL),
pm AS (SELECT category, floor(avg(n_words)) AS a FROM pt GROUP BY category),
tot AS (SELECT category, term, sum(tf) AS f FROM tt GROUP BY ALL),
weights AS (SELECT category, topic, term, tf, sqrt(tf / n_words) * ln(1 + a / f) AS weight
  FROM tt JOIN pt USING (category, topic) JOIN pm USING (category) JOIN tot USING (category, term)),
terms AS (SELECT category, topic, term, weight, rank FROM (SELECT *, row_number() OVER (PARTITION BY category, topic ORDER BY round(weight, 12) DESC, term) AS rank FROM weights)
  WHERE rank <= 10)"""


def weights(spark: SparkSession, d: str) -> DataFrame:
    return topics.document_tfidf(topic_docs(spark, d), "text", SHORT_STOP)


def terms(spark: SparkSession, d: str) -> DataFrame:
    return topics.top_terms(weights(spark, d))


@query("m6_class_tfidf", f"WITH {WEIGHTS_SQL} SELECT category, topic, term, round(weight, 6) AS weight, CAST(rank AS INTEGER) AS rank FROM terms")
def m6(spark: SparkSession, d: str) -> DataFrame:
    return terms(spark, d).select("category", "topic", "term", F.round("weight", 6).alias("weight"), "rank")


@query(
    "m6_class_tfidf_all_terms",
    f"WITH {WEIGHTS_SQL} SELECT category, topic, count(*) AS n_terms, round(sum(weight), 6) AS total FROM weights GROUP BY category, topic",
)
def m6_all(spark: SparkSession, d: str) -> DataFrame:
    return weights(spark, d).groupBy("category", "topic").agg(F.count("*").alias("n_terms"), F.round(F.sum("weight"), 6).alias("total"))


@query(
    "m8_topic_diversity",
    f"""WITH {WEIGHTS_SQL} SELECT category, round(count(DISTINCT term) FILTER (WHERE topic <> -1) / (count(DISTINCT topic) * 10), 6)::DOUBLE AS diversity
    FROM terms GROUP BY category""",
)
def m8(spark: SparkSession, d: str) -> DataFrame:
    return topics.topic_diversity(terms(spark, d)).withColumn("diversity", F.round("diversity", 6))


WORD_LISTS_SQL = f"""{WEIGHTS_SQL},
flat AS (SELECT category, topic, flatten(list(string_split(term, ' ') ORDER BY rank)) AS w FROM terms WHERE topic <> -1 GROUP BY category, topic),
word_lists AS (SELECT category, topic, list_filter(w, lambda x, i: list_position(w, x) = i) AS words FROM flat)"""


@query("m9_topic_word_lists", f"WITH {WORD_LISTS_SQL} SELECT category, topic, array_to_string(words, ' ') AS words FROM word_lists")
def m9(spark: SparkSession, d: str) -> DataFrame:
    return topics.topic_word_lists(terms(spark, d)).withColumn("words", F.array_join("words", " "))


COHERENCE_SQL = f"""{WORD_LISTS_SQL},
lists AS (SELECT category, topic, words[1:10] AS words FROM word_lists),
dtok AS (SELECT doc_id, category, {sql_words('text')} AS w FROM topic_docs),
total AS (SELECT category, sum(greatest(len(w) - 109, 1))::DOUBLE AS total FROM dtok GROUP BY category),
spread AS (SELECT doc_id, category, len(w) AS n, unnest(w) AS word, unnest(range(0, len(w))) AS pos FROM dtok),
vw AS (SELECT category, topic, unnest(words) AS word FROM lists),
occ AS (SELECT s.doc_id, s.category, v.topic, s.word, s.pos, greatest(s.pos - 109, 0) AS lo, least(s.pos, greatest(s.n - 110, 0)) AS hi
  FROM spread s JOIN vw v ON v.category = s.category AND v.word = s.word),
pw AS (SELECT DISTINCT a.doc_id, a.category, a.topic, a.word AS w1, b.word AS w2 FROM
  (SELECT DISTINCT doc_id, category, topic, word FROM occ) a JOIN (SELECT DISTINCT doc_id, category, topic, word FROM occ) b
  ON a.doc_id = b.doc_id AND a.topic = b.topic AND a.word <= b.word),
po AS (SELECT p.*, o.pos, o.lo, o.hi FROM pw p JOIN occ o ON o.doc_id = p.doc_id AND o.topic = p.topic AND o.word IN (p.w1, p.w2)),
pl AS (SELECT *, lag(hi) OVER (PARTITION BY doc_id, topic, w1, w2 ORDER BY pos) AS before FROM po),
pd AS (SELECT doc_id, category, topic, w1, w2, sum(greatest(hi - greatest(lo, coalesce(before, -1) + 1) + 1, 0)) AS n FROM pl GROUP BY ALL),
pb AS (SELECT e.category, e.topic, e.w1, e.w2, CASE WHEN e.w1 = e.w2 THEN e.n ELSE a.n + b.n - e.n END AS n FROM pd e
  JOIN pd a ON a.doc_id = e.doc_id AND a.topic = e.topic AND a.w1 = e.w1 AND a.w2 = e.w1 JOIN pd b ON b.doc_id = e.doc_id AND b.topic = e.topic AND b.w1 = e.w2 AND b.w2 = e.w2),
pc AS (SELECT category, topic, w1, w2, sum(n) AS n FROM pb GROUP BY ALL),
one AS (SELECT v.category, v.topic, v.word, coalesce(pc.n, 0) AS c FROM vw v LEFT JOIN pc ON pc.category = v.category AND pc.topic = v.topic AND pc.w1 = v.word AND pc.w2 = v.word),
grid AS (SELECT a.category, a.topic, a.word AS w1, b.word AS w2, a.c / total AS p1, b.c / total AS p2,
    CASE WHEN a.word = b.word THEN a.c ELSE coalesce(pc.n, 0) END / total AS p12
  FROM one a JOIN one b ON a.category = b.category AND a.topic = b.topic JOIN total t ON t.category = a.category
  LEFT JOIN pc ON pc.category = a.category AND pc.topic = a.topic AND pc.w1 = least(a.word, b.word) AND pc.w2 = greatest(a.word, b.word)),
cells AS (SELECT category, topic, w1, w2, CASE WHEN p1 = 0 OR p2 = 0 THEN 0 ELSE ln((p12 + 1e-12::DOUBLE) / (p1 * p2)) / -ln(p12 + 1e-12::DOUBLE) END AS v FROM grid),
ct AS (SELECT *, sum(v) OVER (PARTITION BY category, topic, w2) AS t FROM cells),
cr AS (SELECT category, topic, w1, sum(v * t) AS vt, sqrt(sum(v * v)) * sqrt(sum(t * t)) AS size FROM ct GROUP BY category, topic, w1),
coherent AS (SELECT category, topic, avg(CASE WHEN size > 0 THEN vt / size ELSE 0 END) AS coherence FROM cr GROUP BY category, topic)"""


@query("m10_coherence_cv", f"WITH {COHERENCE_SQL} SELECT category, topic, round(coherence, 6) AS coherence FROM coherent")
def m10(spark: SparkSession, d: str) -> DataFrame:
    lists = topics.topic_word_lists(terms(spark, d))
    out = coherence.coherence_cv(topic_docs(spark, d), lists, "doc_id", "text")
    return out.withColumn("coherence", F.round("coherence", 6))


@query(
    "m12_topic_info",
    f"""WITH {WEIGHTS_SQL}, n AS (SELECT category, topic, count(*) AS doc_count FROM topic_docs GROUP BY ALL),
    l AS (SELECT category, topic, list(term ORDER BY rank) AS t FROM terms GROUP BY ALL)
    SELECT category, topic, CAST(topic AS VARCHAR) || '_' || array_to_string(t[1:4], '_') AS name, doc_count, array_to_string(t, ', ') AS words FROM n JOIN l USING (category, topic)""",
)
def m12(spark: SparkSession, d: str) -> DataFrame:
    return topics.topic_info(topic_docs(spark, d), terms(spark, d))


# Vectors with a category, a topic (every seventh an outlier) and the text of the same id.
VECTOR_DOCS_SQL = """vector_docs AS (SELECT vec_id AS doc_id, 'c' || CAST(label % 4 AS VARCHAR) AS category,
    CASE WHEN vec_id % 7 = 0 THEN -1 ELSE CAST(label AS INTEGER) END AS topic, embedding::DOUBLE[] AS embedding FROM embeddings)"""


def vector_docs(spark: SparkSession, d: str) -> DataFrame:
    topic = F.when(F.col("vec_id") % 7 == 0, F.lit(-1)).otherwise(F.col("label").cast("int"))
    return table(spark, d, "embeddings").select(
        F.col("vec_id").alias("doc_id"),
        F.concat(F.lit("c"), (F.col("label") % 4).cast("string")).alias("category"),
        topic.alias("topic"),
        "embedding",
    )


@query("m7_mmr_terms")
def m7(spark: SparkSession, d: str) -> DataFrame:
    """Thirty candidates per topic over all documents and their TF-IDF vectors, ten chosen."""
    docs = embedding.tfidf_vectors(topic_docs(spark, d), "text", 256)
    weighted = topics.document_tfidf(docs, "text", SHORT_STOP)
    candidates = topics.top_terms(weighted, k=30)
    vectors = topics.term_vectors(docs, candidates, "text", SHORT_STOP)
    return topics.mmr_terms(
        candidates.drop("rank", "tf").join(vectors, ["category", "topic", "term"]),
        clusters.centroids(docs, ["category", "topic"]),
    )


CENTRES_SQL = f"""{VECTOR_DOCS_SQL},
dims AS (SELECT category, topic, unnest(embedding) AS x, unnest(range(1, len(embedding) + 1)) AS i FROM vector_docs),
means AS (SELECT category, topic, i, avg(x) AS x FROM dims GROUP BY category, topic, i),
centres AS (SELECT category, topic, list(x ORDER BY i) AS centroid FROM means GROUP BY category, topic)"""


@query("v4_centroids", f"WITH {CENTRES_SQL} SELECT category, topic, CAST(i AS INTEGER) AS dim, round(x, 6) AS x FROM means")
def v4(spark: SparkSession, d: str) -> DataFrame:
    out = clusters.centroids(vector_docs(spark, d), ["category", "topic"])
    dims = out.select("category", "topic", F.posexplode("centroid").alias("dim", "x"))
    return dims.select("category", "topic", (F.col("dim") + 1).alias("dim"), F.round("x", 6).alias("x"))


PROBS_SQL = f"""{CENTRES_SQL},
near AS (SELECT v.doc_id, v.category, v.topic, c.topic AS to_topic, list_cosine_similarity(v.embedding, c.centroid) AS s
  FROM vector_docs v JOIN centres c ON c.category = v.category WHERE c.topic <> -1),
probs AS (SELECT *, exp(s / 0.1::DOUBLE) / sum(exp(s / 0.1::DOUBLE)) OVER (PARTITION BY doc_id) AS p FROM near)"""


def with_probs(spark: SparkSession, d: str) -> DataFrame:
    docs = vector_docs(spark, d)
    return clusters.membership_probs(docs, clusters.centroids(docs, ["category", "topic"]))


@query("m4_membership_probs", f"WITH {PROBS_SQL} SELECT doc_id, to_topic AS topic, round(p, 6) AS p FROM probs")
def m4(spark: SparkSession, d: str) -> DataFrame:
    pairs = F.explode(F.arrays_zip("topic_ids", "probs")).alias("z")
    return with_probs(spark, d).select("doc_id", pairs).select("doc_id", F.col("z.topic_ids").alias("topic"), F.round("z.probs", 6).alias("p"))


# One category that holds all ten topics.
ONE_SQL = PROBS_SQL.replace("'c' || CAST(label % 4 AS VARCHAR) AS category", "'all' AS category")
MOVED_SQL = "best AS (SELECT doc_id, topic, max(p) AS p, arg_max(to_topic, p) AS likely FROM probs GROUP BY doc_id, topic)"


def moved(spark: SparkSession, d: str, threshold: float) -> DataFrame:
    docs = vector_docs(spark, d).withColumn("category", F.lit("all"))
    likely = clusters.membership_probs(docs, clusters.centroids(docs, ["category", "topic"]))
    return clusters.reassign_outliers(likely, threshold).select("doc_id", "topic", "new_topic")


@query(
    "m5_reassign_outliers",
    f"WITH {ONE_SQL}, {MOVED_SQL} SELECT doc_id, topic, CASE WHEN topic = -1 AND p >= 0.5 THEN likely ELSE topic END AS new_topic FROM best",
)
def m5(spark: SparkSession, d: str) -> DataFrame:
    return moved(spark, d, 0.5)


@query(
    "m5_reassign_outliers_060",
    f"WITH {ONE_SQL}, {MOVED_SQL} SELECT doc_id, topic, CASE WHEN topic = -1 AND p >= 0.6 THEN likely ELSE topic END AS new_topic FROM best",
)
def m5_060(spark: SparkSession, d: str) -> DataFrame:
    return moved(spark, d, 0.6)


@query(
    "m11_silhouette",
    f"""WITH {VECTOR_DOCS_SQL}, kept AS (SELECT * FROM vector_docs WHERE topic <> -1),
    pairs AS (SELECT a.doc_id, a.category, a.topic, b.topic AS other, 1 - list_cosine_similarity(a.embedding, b.embedding) AS dist
      FROM kept a JOIN kept b ON a.category = b.category AND a.doc_id <> b.doc_id),
    per AS (SELECT doc_id, category, topic, other, avg(dist) AS m FROM pairs GROUP BY ALL),
    ab AS (SELECT doc_id, category, min(m) FILTER (WHERE other = topic) AS a, min(m) FILTER (WHERE other <> topic) AS b FROM per GROUP BY doc_id, category)
    SELECT category, round(avg(coalesce((b - a) / greatest(a, b), 0)), 6) AS silhouette FROM ab GROUP BY category""",
)
def m11(spark: SparkSession, d: str) -> DataFrame:
    return clusters.silhouette_cosine(vector_docs(spark, d)).withColumn("silhouette", F.round("silhouette", 6))


EPS = 0.08
# A fixed projection of all 64 dimensions to two, the same numbers in both engines.
FACTORS = (37, 23)


def projected_sql(factor: int) -> str:
    return f"list_sum(list_transform(range(1, len(embedding) + 1), lambda i: embedding[i]::DOUBLE * (((i - 1) * {factor}) % 64 - 31.5::DOUBLE) / 147.0::DOUBLE))"


def projected(vector: str) -> Column:
    def axis(factor: int) -> Column:
        terms = F.transform(vector, lambda x, i: x.cast("double") * ((i * factor) % 64 - F.lit(31.5)) / F.lit(147.0))
        return F.aggregate(terms, F.lit(0.0), lambda s, t: s + t)

    return F.array(*[axis(f) for f in FACTORS])


# Cells of the projection; near cells are at most one step away in each.
CELLS_SQL = f"""pts AS (SELECT vec_id AS doc_id, 'c' || CAST(label % 4 AS VARCHAR) AS category,
    CAST(floor({projected_sql(37)} / ({EPS}::DOUBLE / sqrt(2::DOUBLE))) AS BIGINT) AS x, CAST(floor({projected_sql(23)} / ({EPS}::DOUBLE / sqrt(2::DOUBLE))) AS BIGINT) AS y FROM embeddings),
cells AS (SELECT category, x, y, count(*) AS n FROM pts GROUP BY ALL),
near AS (SELECT a.category, a.x, a.y, b.x AS bx, b.y AS by_, b.n FROM cells a JOIN cells b ON a.category = b.category AND abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1),
dense AS (SELECT category, x, y FROM near GROUP BY ALL HAVING sum(n) >= 8),
links AS (SELECT n.category, n.x, n.y, n.bx, n.by_ FROM near n JOIN dense d ON d.category = n.category AND d.x = n.x AND d.y = n.y
  JOIN dense e ON e.category = n.category AND e.x = n.bx AND e.y = n.by_),
reach AS (SELECT category, x, y, x AS rx, y AS ry FROM dense UNION
  SELECT r.category, r.x, r.y, l.bx, l.by_ FROM reach r JOIN links l ON l.category = r.category AND l.x = r.rx AND l.y = r.ry),
comp AS (SELECT category, x, y, min(category || '|' || CAST(rx AS VARCHAR) || ',' || CAST(ry AS VARCHAR)) AS component FROM reach GROUP BY category, x, y),
sizes AS (SELECT c.category, component, sum(n) AS size FROM comp c JOIN cells USING (category, x, y) GROUP BY ALL HAVING sum(n) >= 10),
numbered AS (SELECT category, component, row_number() OVER (PARTITION BY category ORDER BY size DESC, component) - 1 AS topic FROM sizes)"""


@query(
    "m3_density_clusters",
    f"""WITH RECURSIVE {CELLS_SQL}
    SELECT p.doc_id, p.category, CAST(coalesce(topic, -1) AS INTEGER) AS topic FROM pts p LEFT JOIN comp c USING (category, x, y) LEFT JOIN numbered n USING (category, component)""",
)
def m3(spark: SparkSession, d: str) -> DataFrame:
    points = vector_docs(spark, d).drop("topic").withColumn("reduced", projected("embedding"))
    return clusters.density_clusters(points, EPS, 8, 10, dims=2).select("doc_id", "category", "topic")


@query(
    "m3_density_clusters_by_category",
    f"""WITH RECURSIVE {CELLS_SQL.replace("HAVING sum(n) >= 8)", "HAVING sum(n) >= CASE category WHEN 'c1' THEN 12 ELSE 8 END)").replace(
        "HAVING sum(n) >= 10)", "HAVING sum(n) >= CASE c.category WHEN 'c1' THEN 14 WHEN 'c2' THEN 30 ELSE 10 END)")}
    SELECT p.doc_id, p.category, CAST(coalesce(topic, -1) AS INTEGER) AS topic FROM pts p LEFT JOIN comp c USING (category, x, y) LEFT JOIN numbered n USING (category, component)""",
)
def m3_by_category(spark: SparkSession, d: str) -> DataFrame:
    """Two categories with numbers of their own, one of them with one number only."""
    points = vector_docs(spark, d).drop("topic").withColumn("reduced", projected("embedding"))
    own = spark.createDataFrame([("c1", 12, 14), ("c2", None, 30)], "category string, min_samples int, min_cluster_size int")
    return clusters.density_clusters(points, EPS, 8, 10, dims=2, config=own).select("doc_id", "category", "topic")


@query("m3_density_hierarchy")
def m3_hierarchy(spark: SparkSession, d: str) -> DataFrame:
    """Most stable branches of the density tree of all points, with the strength of every membership."""
    points = vector_docs(spark, d).drop("topic").withColumn("reduced", projected("embedding"))
    return density.density_hierarchy(points, 5, 15).select("doc_id", "category", "topic", F.round("probability", 6).alias("probability"))


@query(
    "m15_merge_similar_topics",
    f"""WITH RECURSIVE {CENTRES_SQL.replace("'c' || CAST(label % 4 AS VARCHAR) AS category", "'all' AS category")},
    near AS (SELECT a.topic AS a, b.topic AS b FROM centres a JOIN centres b ON a.topic <> -1 AND b.topic <> -1
      AND list_cosine_similarity(a.centroid, b.centroid) >= 0.19),
    reach AS (SELECT topic, topic AS other FROM centres WHERE topic <> -1 UNION SELECT r.topic, n.b FROM reach r JOIN near n ON n.a = r.other),
    comp AS (SELECT topic, min(other) AS component FROM reach GROUP BY topic),
    sizes AS (SELECT component, count(*) AS n FROM vector_docs JOIN comp USING (topic) GROUP BY component),
    numbered AS (SELECT component, row_number() OVER (ORDER BY n DESC, component) - 1 AS merged FROM sizes)
    SELECT doc_id, topic, CAST(coalesce(merged, -1) AS INTEGER) AS merged_topic
    FROM vector_docs LEFT JOIN comp USING (topic) LEFT JOIN numbered USING (component)""",
)
def m15_merge(spark: SparkSession, d: str) -> DataFrame:
    docs = vector_docs(spark, d).withColumn("category", F.lit("all"))
    return clusters.merge_similar_topics(docs, 0.19).select("doc_id", "topic", "merged_topic")


@query("m3_density_clusters_reduced")
def m3_reduced(spark: SparkSession, d: str) -> DataFrame:
    """Five principal components; the radius comes from the data."""
    points = clusters.reduce_dims(vector_docs(spark, d).drop("topic"), 5)
    eps = clusters.choose_eps(points, [0.05 * 1.25**i for i in range(16)], 10, dims=5)
    return clusters.density_clusters(points, eps, 10, 20, dims=5).select("doc_id", "category", "topic")


@query(
    "m13_topic_similarity",
    f"""WITH {CENTRES_SQL}, n AS (SELECT category || '_' || CAST(topic AS VARCHAR) AS id, centroid FROM centres WHERE topic <> -1)
    SELECT a.id AS src, b.id AS dst, round(list_cosine_similarity(a.centroid, b.centroid), 6) AS similarity FROM n a JOIN n b ON a.id < b.id""",
)
def m13(spark: SparkSession, d: str) -> DataFrame:
    edges = topic_pairs(spark, d)
    return edges.select("src", "dst", F.round("original_sim", 6).alias("similarity"))


def topic_pairs(spark: SparkSession, d: str) -> DataFrame:
    centres = clusters.centroids(vector_docs(spark, d).where(F.col("topic") != -1), ["category", "topic"])
    nodes = centres.select(F.concat_ws("_", "category", F.col("topic").cast("string")).alias("id"), F.col("category").alias("label"), "centroid")
    return graph.similarity_edges(nodes)


# An edge belongs to the tree unless nearer edges already connect its ends.
@query(
    "m13_topic_hierarchy",
    f"""WITH RECURSIVE {CENTRES_SQL}, n AS (SELECT category || '_' || CAST(topic AS VARCHAR) AS id, centroid FROM centres WHERE topic <> -1),
    e AS (SELECT a.id AS src, b.id AS dst, round(1 - list_cosine_similarity(a.centroid, b.centroid), 9) AS d FROM n a JOIN n b ON a.id < b.id),
    reach AS (SELECT src AS es, dst AS ed, d AS dd, src AS node FROM e UNION
      SELECT r.es, r.ed, r.dd, CASE WHEN x.src = r.node THEN x.dst ELSE x.src END FROM reach r
      JOIN e x ON (x.src = r.node OR x.dst = r.node) AND (x.d < r.dd OR (x.d = r.dd AND (x.src < r.es OR (x.src = r.es AND x.dst < r.ed)))))
    SELECT CAST(row_number() OVER (ORDER BY d, src, dst) AS INTEGER) AS step, src, dst, d AS distance FROM e
    WHERE NOT EXISTS (SELECT 1 FROM reach r WHERE r.es = e.src AND r.ed = e.dst AND r.node = e.dst)""",
)
def m13_tree(spark: SparkSession, d: str) -> DataFrame:
    edges = topic_pairs(spark, d).withColumn("distance", F.round(1 - F.col("original_sim"), 9))
    return graph.single_linkage(edges, "distance")


@query(
    "j3_topic_docs",
    f"""WITH {TOPIC_DOCS_SQL} SELECT v.doc_id, v.topic, t.source, t.n_chars FROM topic_docs v JOIN documents t ON t.doc_id = v.doc_id""",
)
def j3(spark: SparkSession, d: str) -> DataFrame:
    """Topic information beside the original columns, by id instead of by position."""
    original = documents(spark, d).select("doc_id", "source", "n_chars")
    return topic_docs(spark, d).select("doc_id", "topic").join(original, "doc_id")


NAMES = [("en", 0, "Community Support"), ("en", 3, "Work Stress"), ("fr", 1, "Family Issues"), ("de", 2, "Sleep")]
NAMES_SQL = "names AS (SELECT * FROM (VALUES ('en', 0, 'Community Support'), ('en', 3, 'Work Stress'), ('fr', 1, 'Family Issues'), ('de', 2, 'Sleep')) n(category, topic, name))"


def topic_names(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(NAMES, "category string, topic int, name string")


@query(
    "j7_topic_names",
    f"""WITH {TOPIC_DOCS_SQL}, {NAMES_SQL} SELECT DISTINCT t.category, t.topic, coalesce(n.name, t.category || '_' || CAST(t.topic AS VARCHAR)) AS name
    FROM topic_docs t LEFT JOIN names n ON n.category = t.category AND n.topic = t.topic""",
)
def j7(spark: SparkSession, d: str) -> DataFrame:
    found = topic_docs(spark, d).select("category", "topic").distinct()
    fallback = F.concat_ws("_", "category", F.col("topic").cast("string"))
    return merge.named(found, topic_names(spark), ["category", "topic"], fallback)


@query(
    "a3_posts_per_year_by_topic",
    f"""WITH {TOPIC_DOCS_SQL}, {NAMES_SQL}, dated AS (SELECT *, year(DATE '2013-06-01' + CAST(doc_id * 37 % 4000 AS INTEGER)) AS y FROM topic_docs WHERE topic <> -1),
    n AS (SELECT category, y, topic, count(*) AS post_count FROM dated GROUP BY ALL)
    SELECT n.category, CAST(y AS INTEGER) AS year, coalesce(name, CAST(n.topic AS VARCHAR)) AS topic, post_count FROM n LEFT JOIN names m ON m.category = n.category AND m.topic = n.topic""",
)
def a3(spark: SparkSession, d: str) -> DataFrame:
    day = F.date_add(F.lit("2013-06-01").cast("date"), (F.col("doc_id") * 37 % 4000).cast("int"))
    return counts.posts_per_year_by_topic(topic_docs(spark, d).withColumn("day", day), "day", topic_names(spark))


@query(
    "a4_topic_counts",
    f"""WITH {TOPIC_DOCS_SQL}, n AS (SELECT category, topic, count(*) AS doc_count FROM topic_docs GROUP BY ALL)
    SELECT category, topic, doc_count, CAST(sum(CASE WHEN topic <> -1 THEN doc_count END) OVER (PARTITION BY category) AS BIGINT) AS total_docs FROM n""",
)
def a4(spark: SparkSession, d: str) -> DataFrame:
    return counts.topic_counts(topic_docs(spark, d)).drop("relative_size")


@query(
    "a5_relative_size",
    f"""WITH {TOPIC_DOCS_SQL}, n AS (SELECT category, topic, count(*) AS doc_count FROM topic_docs WHERE topic <> -1 GROUP BY ALL)
    SELECT category, topic, round(doc_count / sum(doc_count) OVER (PARTITION BY category), 6)::DOUBLE AS relative_size FROM n""",
)
def a5(spark: SparkSession, d: str) -> DataFrame:
    sized = counts.topic_counts(topic_docs(spark, d)).where(F.col("topic") != -1)
    return sized.select("category", "topic", F.round("relative_size", 6).alias("relative_size"))


@query(
    "p7_without_outliers",
    f"WITH {TOPIC_DOCS_SQL} SELECT doc_id, topic FROM topic_docs WHERE topic <> -1",
)
def p7(spark: SparkSession, d: str) -> DataFrame:
    return topic_docs(spark, d).where(F.col("topic") != -1).select("doc_id", "topic")
