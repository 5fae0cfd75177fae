"""Subtopic graph and its statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.functions.text import tokenize
from forumlens.operators import clusters, communities, counts, embedding, graph, stats, topics
from forumlens.operators.coherence import pair_coherence
from forumlens.operators.rows import exploded
from forumlens.plans.registry import documents, query, table
from forumlens.plans.texts import SHORT_STOP, sql_list, sql_tokens
from forumlens.plans.topicmodel import topic_docs
from forumlens.session import staged

# Forty subtopics: the ten labels, each split in four, with the label modulo 4 as category.
NODES_SQL = """node_docs AS (SELECT label * 4 + vec_id % 4 AS id, 'c' || CAST(label % 4 AS VARCHAR) AS label, embedding::DOUBLE[] AS e FROM embeddings),
node_dims AS (SELECT id, label, unnest(e) AS x, unnest(range(1, len(e) + 1)) AS i FROM node_docs),
node_means AS (SELECT id, label, i, avg(x) AS x FROM node_dims GROUP BY ALL),
nodes AS (SELECT id, label, list(x ORDER BY i) AS centroid FROM node_means GROUP BY id, label),
sims AS (SELECT a.id AS src, b.id AS dst, a.label AS label_u, b.label AS label_v, list_cosine_similarity(a.centroid, b.centroid) AS original_sim
  FROM nodes a JOIN nodes b ON a.id < b.id)"""
CUT = 0.15
KEPT_SQL = f"{NODES_SQL}, kept AS (SELECT * FROM sims WHERE original_sim >= {CUT})"


def node_docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(
        (F.col("label") * 4 + F.col("vec_id") % 4).alias("id"),
        F.concat(F.lit("c"), (F.col("label") % 4).cast("string")).alias("label"),
        "embedding",
    )


def nodes(spark: SparkSession, d: str) -> DataFrame:
    return clusters.centroids(node_docs(spark, d), ["id", "label"]).drop("n")


def sims(spark: SparkSession, d: str) -> DataFrame:
    return graph.similarity_edges(nodes(spark, d))


def kept(spark: SparkSession, d: str) -> DataFrame:
    return graph.above(sims(spark, d), "original_sim", CUT)


@query("j4_all_pairs", f"WITH {NODES_SQL} SELECT src, dst, label_u, label_v, round(original_sim, 6) AS original_sim FROM sims")
def j4(spark: SparkSession, d: str) -> DataFrame:
    return sims(spark, d).withColumn("original_sim", F.round("original_sim", 6))


@query(
    "j6_edge_labels",
    f"WITH {KEPT_SQL} SELECT src, dst, label_u, label_v FROM kept",
)
def j6(spark: SparkSession, d: str) -> DataFrame:
    bare = kept(spark, d).select("src", "dst")
    return graph.with_labels(bare, nodes(spark, d)).select("src", "dst", "label_u", "label_v")


@query(
    "p8_edge_threshold",
    f"WITH {KEPT_SQL} SELECT id, label FROM nodes WHERE id IN (SELECT src FROM kept UNION SELECT dst FROM kept)",
)
def p8(spark: SparkSession, d: str) -> DataFrame:
    return graph.connected_nodes(nodes(spark, d), kept(spark, d)).select("id", "label")


@query(
    "a6_value_summary",
    f"""WITH {NODES_SQL} SELECT round(min(original_sim), 6) AS min, round(max(original_sim), 6) AS max, round(avg(original_sim), 6) AS mean,
    round(stddev_pop(original_sim), 6) AS std, round(median(original_sim), 6) AS median FROM sims""",
)
def a6(spark: SparkSession, d: str) -> DataFrame:
    out = stats.value_summary(sims(spark, d), "original_sim")
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query(
    "a6_large_summary",
    """SELECT min(l_extendedprice) AS min, max(l_extendedprice) AS max, round(avg(l_extendedprice), 4) AS mean,
    round(stddev_pop(l_extendedprice), 4) AS std, round(median(l_extendedprice), 4) AS median FROM lineitem""",
)
def a6_large(spark: SparkSession, d: str) -> DataFrame:
    out = stats.value_summary(table(spark, d, "lineitem"), "l_extendedprice")
    return out.select("min", "max", *[F.round(c, 4).alias(c) for c in ("mean", "std", "median")])


@query(
    "a9_histogram",
    f"""WITH {NODES_SQL}, s AS (
      SELECT label_u AS category, 'intra' AS kind, original_sim AS v FROM sims WHERE label_u = label_v
      UNION ALL SELECT label_u, 'inter', original_sim FROM sims WHERE label_u <> label_v
      UNION ALL SELECT label_v, 'inter', original_sim FROM sims WHERE label_u <> label_v),
    b AS (SELECT *, min(v) OVER (PARTITION BY category, kind) AS lo, max(v) OVER (PARTITION BY category, kind) AS hi FROM s)
    SELECT category, kind, CAST(least(floor((v - lo) / (hi - lo) * 20) + 1, 20) AS INTEGER) AS bin, count(*) AS n FROM b GROUP BY ALL""",
)
def a9(spark: SparkSession, d: str) -> DataFrame:
    return counts.histogram(counts.intra_inter(sims(spark, d), "original_sim"), ["category", "kind"], "value")


@query(
    "g1_build_nodes",
    f"""WITH docs AS (SELECT doc_id, lang AS category, CAST(substr(source, 4) AS INTEGER) - 1 AS topic, text FROM documents),
    toks AS (SELECT category, topic, list_filter({sql_tokens('lower(text)', 2)}, lambda t: NOT list_contains({sql_list(SHORT_STOP)}, t)) AS t FROM docs),
    grams AS (SELECT category, topic, unnest(list_concat(t, list_concat(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]),
      list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2])))) AS term FROM toks),
    tt AS (SELECT category, topic, term, count(*) AS tf FROM grams GROUP BY ALL),
    pt AS (SELECT category, topic, sum(tf) AS n_words FROM tt GROUP BY ALL),
    pm AS (SELECT category, floor(avg(n_words)) AS a FROM pt GROUP BY category),
    tot AS (SELECT category, term, sum(tf) AS f FROM tt GROUP BY ALL),
    w AS (SELECT category, topic, term, sqrt(tf / n_words) * ln(1 + a / f) AS weight FROM tt JOIN pt USING (category, topic) JOIN pm USING (category) JOIN tot USING (category, term)),
    r AS (SELECT *, row_number() OVER (PARTITION BY category, topic ORDER BY round(weight, 12) DESC, term) AS rank FROM w),
    k AS (SELECT category, topic, string_agg(term, ', ' ORDER BY rank) AS keywords FROM r WHERE rank <= 10 GROUP BY ALL),
    n AS (SELECT category, topic, count(*) AS doc_count FROM docs WHERE topic <> -1 GROUP BY ALL)
    SELECT category || '_' || CAST(topic AS VARCHAR) AS id, category AS label, CASE WHEN topic = 4 THEN 'Work Stress' ELSE category || '_' || CAST(topic AS VARCHAR) END AS name,
      keywords, round(doc_count / sum(doc_count) OVER (PARTITION BY category), 6)::DOUBLE AS size, doc_count FROM n JOIN k USING (category, topic)""",
)
def g1(spark: SparkSession, d: str) -> DataFrame:
    docs = embedding.tfidf_vectors(topic_docs(spark, d), "text", 64)
    terms = topics.top_terms(topics.document_tfidf(docs, "text", SHORT_STOP))
    names = docs.where(F.col("topic") == 4).select("category", "topic", F.lit("Work Stress").alias("name")).distinct()
    out = graph.build_nodes(docs, terms, names)
    return out.select("id", "label", "name", "keywords", F.round("size", 6).alias("size"), "doc_count")


# Keyword lists: the ten most frequent words of the documents that share the last digit of their id.
KEYWORDS_SQL = f"""freq AS (SELECT doc_id % 40 AS node, t, count(*) AS n FROM (SELECT doc_id, unnest({sql_tokens('lower(text)', 2)}) AS t FROM documents) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY node ORDER BY n DESC, t) AS rank FROM freq),
keywords AS (SELECT node, list(t ORDER BY rank) AS words FROM ranked WHERE rank <= 10 GROUP BY node)"""
COHERENT_SQL = f"""{KEYWORDS_SQL},
n_lists AS (SELECT count(*)::DOUBLE AS n FROM keywords),
flat AS (SELECT node, unnest(words) AS w FROM keywords),
c1 AS (SELECT w, count(*) AS c FROM flat GROUP BY w),
c12 AS (SELECT a.w AS w1, b.w AS w2, count(*) AS c FROM flat a JOIN flat b ON a.node = b.node GROUP BY ALL),
united AS (SELECT s.src, s.dst, unnest(list_distinct(list_concat(a.words, b.words))) AS w FROM sims s JOIN keywords a ON a.node = s.src JOIN keywords b ON b.node = s.dst),
grid AS (SELECT u.src, u.dst, u.w AS w1, v.w AS w2, x.c / n AS p1, y.c / n AS p2, coalesce(z.c, 0) / n AS p12
  FROM united u JOIN united v ON v.src = u.src AND v.dst = u.dst JOIN c1 x ON x.w = u.w JOIN c1 y ON y.w = v.w LEFT JOIN c12 z ON z.w1 = u.w AND z.w2 = v.w, n_lists),
cells AS (SELECT src, dst, w1, w2, ln((p12 + 1e-12::DOUBLE) / (p1 * p2)) / -ln(p12 + 1e-12::DOUBLE) AS v FROM grid),
ct AS (SELECT *, sum(v) OVER (PARTITION BY src, dst, w2) AS t FROM cells),
cr AS (SELECT src, dst, w1, sum(v * t) AS vt, sqrt(sum(v * v)) * sqrt(sum(t * t)) AS size FROM ct GROUP BY src, dst, w1),
coherent AS (SELECT src, dst, avg(CASE WHEN size > 0 THEN vt / size ELSE 0 END) AS coherence FROM cr GROUP BY src, dst)"""


def keywords(spark: SparkSession, d: str) -> DataFrame:
    words = exploded(documents(spark, d), [(F.col("doc_id") % 40).alias("node")], tokenize(F.lower("text"), 2), "t")
    freq = words.groupBy("node", "t").agg(F.count("*").alias("n"))
    top = counts.top_k(freq, ["node"], [F.desc("n"), F.asc("t")], 10)
    ordered = F.sort_array(F.collect_list(F.struct("rank", "t")))
    return top.groupBy("node").agg(F.transform(ordered, lambda s: s["t"]).alias("words"))


@query("g2_pair_coherence", f"WITH {NODES_SQL}, {COHERENT_SQL} SELECT src, dst, round(coherence, 6) AS coherence FROM coherent")
def g2(spark: SparkSession, d: str) -> DataFrame:
    pairs = graph.all_pairs(nodes(spark, d), []).select("src", "dst")
    return pair_coherence(pairs, keywords(spark, d)).withColumn("coherence", F.round("coherence", 6))


EDGES_SQL = f"""{NODES_SQL}, {COHERENT_SQL},
edges AS (SELECT s.*, coherence, coherence * original_sim AS weight FROM sims s JOIN coherent c ON c.src = s.src AND c.dst = s.dst),
lim AS (SELECT min(original_sim) AS s0, max(original_sim) AS s1, min(coherence) AS c0, max(coherence) AS c1 FROM edges),
full_edges AS (SELECT edges.*, (original_sim - s0) / (s1 - s0) * ((coherence - c0) / (c1 - c0)) AS nor_weight FROM edges, lim)"""


def full_edges(spark: SparkSession, d: str) -> DataFrame:
    with_words = nodes(spark, d).join(keywords(spark, d).withColumnRenamed("node", "id"), "id")
    return graph.build_edges(with_words)


@query("g3_build_edges", f"WITH {EDGES_SQL} SELECT src, dst, round(original_sim, 6) AS original_sim, round(weight, 6) AS weight FROM full_edges")
def g3(spark: SparkSession, d: str) -> DataFrame:
    return full_edges(spark, d).select("src", "dst", F.round("original_sim", 6).alias("original_sim"), F.round("weight", 6).alias("weight"))


@query("g4_minmax_weights", f"WITH {EDGES_SQL} SELECT src, dst, round(nor_weight, 6) AS nor_weight FROM full_edges")
def g4(spark: SparkSession, d: str) -> DataFrame:
    return full_edges(spark, d).select("src", "dst", F.round("nor_weight", 6).alias("nor_weight"))


@query(
    "g5_graph_stats",
    f"""WITH {KEPT_SQL} SELECT (SELECT count(*) FROM (SELECT src FROM kept UNION SELECT dst FROM kept)) AS nodes, count(*) AS edges,
    round(count(*) / ((SELECT count(*) * (count(*) - 1) / 2 FROM nodes)), 6)::DOUBLE AS density FROM kept""",
)
def g5(spark: SparkSession, d: str) -> DataFrame:
    return graph.graph_stats(nodes(spark, d), kept(spark, d)).withColumn("density", F.round("density", 6))


def sql_mixing(edges: str, w: str, keys: str = "") -> str:
    k = f"{keys}, " if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    return f"""SELECT {k}sum(k) / 2 AS m, sum(inner_) AS within, sum(k * k) AS squares FROM (
      SELECT {k}label, sum(w) AS k, sum(inner_) AS inner_ FROM (
        SELECT {k}label_u AS label, {w} AS w, CASE WHEN label_u = label_v THEN {w} ELSE 0.0 END AS inner_ FROM {edges}
        UNION ALL SELECT {k}label_v, {w}, 0.0 FROM {edges}) GROUP BY {k}label) {group}"""


WEIGHTED_SQL = f"{EDGES_SQL}, kept AS (SELECT * FROM full_edges WHERE original_sim >= {CUT})"
SQL_WEIGHTS = {"none": "1.0::DOUBLE", "original_sim": "original_sim", "weight": "weight", "nor_weight": "nor_weight"}


def weighted_kept(spark: SparkSession, d: str) -> DataFrame:
    weights = full_edges(spark, d).select("src", "dst", "weight", "nor_weight")
    return staged(kept(spark, d).join(weights, ["src", "dst"]), "weighted")


def weightings() -> dict[str, Column | None]:
    return {name: None if name == "none" else F.col(name) for name in SQL_WEIGHTS}


@query(
    "g6_modularity",
    f"""WITH {WEIGHTED_SQL} """ + " UNION ALL ".join(
        f"""SELECT '{name}' AS weight, round(within / m - squares / (4 * m * m), 6)::DOUBLE AS modularity FROM ({sql_mixing('kept', w)})"""
        for name, w in SQL_WEIGHTS.items()
    ),
)
def g6(spark: SparkSession, d: str) -> DataFrame:
    edges = weighted_kept(spark, d)
    parts = [graph.modularity(edges, w).select(F.lit(name).alias("weight"), "modularity") for name, w in weightings().items()]
    return reduce(DataFrame.unionByName, parts).withColumn("modularity", F.round("modularity", 6))


@query(
    "g9_assortativity",
    f"""WITH {WEIGHTED_SQL}, r AS (""" + " UNION ALL ".join(
        f"""SELECT '{name}' AS weight, (within / m - squares / (4 * m * m)) / (1 - squares / (4 * m * m)) AS r FROM ({sql_mixing('kept', w)})"""
        for name, w in SQL_WEIGHTS.items()
    ) + """)
    SELECT weight, round(r, 6)::DOUBLE AS assortativity, CASE WHEN r > 0.3 THEN 'Strong assortative mixing' WHEN r > 0 THEN 'Weak assortative mixing'
      WHEN r = 0 THEN 'No assortativity' ELSE 'Disassortative mixing' END AS verdict FROM r""",
)
def g9(spark: SparkSession, d: str) -> DataFrame:
    edges = weighted_kept(spark, d)
    parts = [graph.assortativity(edges, w).select(F.lit(name).alias("weight"), "assortativity") for name, w in weightings().items()]
    return reduce(DataFrame.unionByName, parts).select("weight", F.round("assortativity", 6).alias("assortativity"), stats.assortativity_verdict(F.col("assortativity")).alias("verdict"))


@query(
    "g7_null_model_test",
    f"""WITH {KEPT_SQL}, ends AS (SELECT src AS id FROM kept UNION ALL SELECT dst FROM kept),
    deg AS (SELECT id, count(*) AS deg FROM ends GROUP BY id),
    stubs AS (SELECT id, unnest(range(1, deg + 1)) AS stub FROM deg),
    placed AS (SELECT trial, id, (row_number() OVER (PARTITION BY trial ORDER BY md5('42:' || CAST(trial AS VARCHAR) || ':' || CAST(id AS VARCHAR) || ':' || CAST(stub AS VARCHAR)), id, stub) - 1) // 2 AS pair
      FROM stubs, (SELECT unnest(range(0, 1000)) AS trial)),
    drawn AS (SELECT DISTINCT trial, src, dst FROM (SELECT trial, pair, min(id) AS src, max(id) AS dst FROM placed GROUP BY trial, pair) WHERE src <> dst),
    lab AS (SELECT trial, u.label AS label_u, v.label AS label_v FROM drawn JOIN nodes u ON u.id = src JOIN nodes v ON v.id = dst),
    q AS (SELECT trial, within / m - squares / (4 * m * m) AS q FROM ({sql_mixing('lab', '1.0::DOUBLE', 'trial')})),
    obs AS (SELECT within / m - squares / (4 * m * m) AS o FROM ({sql_mixing('kept', '1.0::DOUBLE')}))
    SELECT round(sum(q) / 1000, 6) AS null_mean, count(*) FILTER (WHERE round(q, 12) >= round(o, 12)) / 1000 AS p, round(any_value(o), 6) AS observed,
      CASE WHEN count(*) FILTER (WHERE round(q, 12) >= round(o, 12)) / 1000 < 0.05 THEN 'Significant' ELSE 'Not significant' END AS verdict FROM q, obs""",
)
def g7(spark: SparkSession, d: str) -> DataFrame:
    out = graph.null_model_test(nodes(spark, d).select("id", "label"), kept(spark, d), trials=1000)
    return out.select(F.round("null_mean", 6).alias("null_mean"), "p", F.round("observed", 6).alias("observed"), "verdict")


@query("g8_greedy_communities")
def g8(spark: SparkSession, d: str) -> DataFrame:
    return graph.greedy_communities(kept(spark, d), "original_sim")


@query("g8_mutual_communities")
def g8_mutual(spark: SparkSession, d: str) -> DataFrame:
    return graph.greedy_communities(kept(spark, d), "original_sim", exact=False)


@query("g8_level_communities")
def g8_levels(spark: SparkSession, d: str) -> DataFrame:
    return communities.level_communities(kept(spark, d), "original_sim")


@query("g10_community_crosstab")
def g10(spark: SparkSession, d: str) -> DataFrame:
    found = graph.greedy_communities(kept(spark, d), "original_sim", exact=False)
    return graph.community_crosstab(nodes(spark, d), found)


@query(
    "g11_split_intra_inter",
    f"""WITH {NODES_SQL} SELECT CASE WHEN label_u = label_v THEN 'intra' ELSE 'inter' END AS kind, count(*) AS n, round(avg(original_sim), 6) AS mean FROM sims GROUP BY 1""",
)
def g11(spark: SparkSession, d: str) -> DataFrame:
    return graph.split_intra_inter(sims(spark, d), "original_sim").withColumn("mean", F.round("mean", 6))


def sql_horner(terms: list[float]) -> str:
    out = f"{terms[0]!r}::DOUBLE"
    for t in terms[1:]:
        out = f"({out} * abs(z) + {t!r}::DOUBLE)"
    return out


def sql_mann_whitney(source: str) -> str:
    """``source`` yields (v, x): value and whether it belongs to the first sample."""
    return f"""pooled AS ({source}),
    per AS (SELECT v, count(*) AS n, count(*) FILTER (WHERE x) AS nx, count(*) FILTER (WHERE NOT x) AS ny FROM pooled GROUP BY v),
    rk AS (SELECT *, sum(n) OVER (ORDER BY v) - n + (n + 1) / 2.0 AS r FROM per),
    s AS (SELECT sum(nx)::DOUBLE AS n1, sum(ny)::DOUBLE AS n2, sum(nx * r)::DOUBLE AS r1, sum(ny * r)::DOUBLE AS r2, sum(n::DOUBLE * n * n - n) AS ties FROM rk),
    u AS (SELECT *, r1 - n1 * (n1 + 1) / 2 AS u_x, r2 - n2 * (n2 + 1) / 2 AS u_y, n1 + n2 AS nn FROM s),
    zz AS (SELECT *, n1 * n2 / 2 AS expected_u, sqrt(n1 * n2 / 12 * CASE WHEN ties > 0 THEN (nn * nn * nn - nn - ties) / (nn * (nn - 1)) ELSE nn + 1 END) AS std_u FROM u),
    mw AS (SELECT *, (u_x - expected_u - 0.5) / std_u AS z FROM zz),
    pp AS (SELECT *, CASE WHEN abs(z) > 37 THEN 0 WHEN abs(z) < 7.07106781186547 THEN exp(-z * z / 2) * {sql_horner(stats.HART_TOP)} / {sql_horner(stats.HART_BOTTOM)}
      ELSE exp(-z * z / 2) / (abs(z) + 1 / (abs(z) + 2 / (abs(z) + 3 / (abs(z) + 4 / (abs(z) + 0.65))))) / 2.506628274631 END AS tail FROM mw)"""


MW_COLUMNS = """CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2, r1 AS rank_sum_x, r2 AS rank_sum_y, u_x, u_y, least(u_x, u_y) AS u, expected_u,
    round(std_u, 4) AS std_u, round(z, 6) AS z, round(CASE WHEN z >= 0 THEN tail ELSE 1 - tail END, 6)::DOUBLE AS p"""
SIMS_MW_SQL = sql_mann_whitney("SELECT original_sim AS v, label_u = label_v AS x FROM sims")
LINES_MW_SQL = sql_mann_whitney("SELECT l_quantity AS v, l_returnflag = 'R' AS x FROM lineitem")


def rounded_test(df: DataFrame) -> DataFrame:
    places = {"std_u": 4, "z": 6, "p": 6}
    return df.select(*[F.round(c, places[c]).alias(c) if c in places else F.col(c) for c in df.columns])


@query("g12_mann_whitney", f"WITH {NODES_SQL}, {SIMS_MW_SQL} SELECT {MW_COLUMNS} FROM pp")
def g12(spark: SparkSession, d: str) -> DataFrame:
    return rounded_test(stats.mann_whitney(sims(spark, d), "original_sim", F.col("label_u") == F.col("label_v")))


def line_samples(spark: SparkSession, d: str) -> DataFrame:
    """Returned lines against all others."""
    return table(spark, d, "lineitem")


@query("g12_mann_whitney_large", f"WITH {LINES_MW_SQL} SELECT {MW_COLUMNS} FROM pp")
def g12_large(spark: SparkSession, d: str) -> DataFrame:
    return rounded_test(stats.mann_whitney(line_samples(spark, d), "l_quantity", F.col("l_returnflag") == "R"))


@query(
    "w1_average_ranks",
    """WITH per AS (SELECT l_extendedprice AS v, count(*) AS n FROM lineitem GROUP BY 1), r AS (SELECT v, sum(n) OVER (ORDER BY v) - n + (n + 1) / 2.0 AS r FROM per)
    SELECT l_orderkey, l_linenumber, l_partkey, r::DOUBLE AS avg_rank FROM lineitem JOIN r ON v = l_extendedprice""",
)
def w1(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return stats.average_ranks(lines, "l_extendedprice").drop("l_extendedprice")


@query(
    "g13_permutation_test",
    f"""WITH {NODES_SQL}, t AS (SELECT unnest(range(0, 2000)) AS trial),
    rk AS (SELECT trial, id, label, row_number() OVER (PARTITION BY trial ORDER BY id) AS a,
      row_number() OVER (PARTITION BY trial ORDER BY md5('42:' || CAST(trial AS VARCHAR) || ':' || CAST(id AS VARCHAR)), id) AS b FROM nodes, t),
    sh AS (SELECT x.trial, x.id, y.label FROM rk x JOIN rk y ON y.trial = x.trial AND y.a = x.b),
    dr AS (SELECT u.trial, original_sim AS v, u.label = w.label AS same FROM sims JOIN sh u ON u.id = src JOIN sh w ON w.id = dst AND w.trial = u.trial),
    df AS (SELECT trial, avg(v) FILTER (WHERE same) - avg(v) FILTER (WHERE NOT same) AS diff FROM dr GROUP BY trial),
    ob AS (SELECT avg(original_sim) FILTER (WHERE label_u = label_v) - avg(original_sim) FILTER (WHERE label_u <> label_v) AS o FROM sims)
    SELECT avg((round(diff, 12) >= round(o, 12))::INTEGER) AS p, round(avg(diff), 6) AS mean_shuffled, round(any_value(o), 6) AS observed,
      CASE WHEN avg((round(diff, 12) >= round(o, 12))::INTEGER) < 0.05 THEN 'Significant' ELSE 'Not significant' END AS verdict FROM df, ob""",
)
def g13(spark: SparkSession, d: str) -> DataFrame:
    edges = sims(spark, d).select("src", "dst", "original_sim")
    out = stats.permutation_test(nodes(spark, d).select("id", "label"), edges, "original_sim", trials=2000)
    return out.select("p", F.round("mean_shuffled", 6).alias("mean_shuffled"), F.round("observed", 6).alias("observed"), "verdict")


@query(
    "g14_cliffs_delta",
    f"""WITH {NODES_SQL}, d AS (SELECT avg(sign(a.original_sim - b.original_sim)) AS delta FROM sims a, sims b WHERE a.label_u = a.label_v AND b.label_u <> b.label_v)
    SELECT round(delta, 6)::DOUBLE AS delta, CASE WHEN delta > 0.474 THEN 'Large effect' WHEN delta > 0.33 THEN 'Medium effect' WHEN delta > 0.147 THEN 'Small effect'
      WHEN delta > 0 THEN 'Negligible positive effect' ELSE 'No or negative effect' END AS effect FROM d""",
)
def g14(spark: SparkSession, d: str) -> DataFrame:
    out = stats.cliffs_delta(sims(spark, d), "original_sim", F.col("label_u") == F.col("label_v"))
    return out.withColumn("delta", F.round("delta", 6))


@query(
    "g15_verdicts",
    """WITH o AS (SELECT o_orderkey, o_totalprice / 500000 AS x FROM orders)
    SELECT CASE WHEN x < 0.05 THEN 'Significant' ELSE 'Not significant' END AS p, CASE WHEN x > 0.474 THEN 'Large effect' WHEN x > 0.33 THEN 'Medium effect'
      WHEN x > 0.147 THEN 'Small effect' WHEN x > 0 THEN 'Negligible positive effect' ELSE 'No or negative effect' END AS effect,
      CASE WHEN x - 0.2 > 0.3 THEN 'Strong assortative mixing' WHEN x - 0.2 > 0 THEN 'Weak assortative mixing' WHEN x - 0.2 = 0 THEN 'No assortativity' ELSE 'Disassortative mixing' END AS mixing,
      count(*) AS n FROM o GROUP BY ALL""",
)
def g15(spark: SparkSession, d: str) -> DataFrame:
    x = F.col("o_totalprice") / 500000
    return table(spark, d, "orders").groupBy(
        stats.p_verdict(x).alias("p"), stats.delta_verdict(x).alias("effect"), stats.assortativity_verdict(x - 0.2).alias("mixing")
    ).agg(F.count("*").alias("n"))
