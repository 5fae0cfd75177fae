"""Conversation history and answer scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.functions import text as tx
from forumlens.operators import conversation, counts, evaluation
from forumlens.operators.rows import exploded
from forumlens.plans.registry import documents, query, table
from forumlens.plans.retrieving import SAID_SQL, said
from forumlens.plans.texts import sql_list, sql_tokens, sql_words


def talk(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "conversations")


def gappy(spark: SparkSession, d: str) -> DataFrame:
    """The same messages under turns that start at 5 and leave gaps."""
    return talk(spark, d).withColumn("turn", F.col("turn") * 3 + 5)


def gappy_sql(sql: str) -> str:
    return sql.replace("FROM conversations", "FROM (SELECT * REPLACE (turn * 3 + 5 AS turn) FROM conversations)")


W2_SQL = """SELECT conv_id, turn, coalesce(array_to_string(list(role || ': ' || text) OVER (PARTITION BY conv_id ORDER BY turn
      ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING), chr(10)), '') AS history FROM conversations"""
W3_SQL = """WITH h AS (SELECT conv_id, turn, list(role || ': ' || left(text, 50) || '...') OVER (PARTITION BY conv_id ORDER BY turn
      ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS h FROM conversations)
    SELECT conv_id, turn, CASE WHEN h IS NULL THEN 'No prior history.'
      ELSE 'Conversation history summary: ' || array_to_string(h, ' ') END AS history_summary FROM h"""
W5_SQL = f"""WITH c AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos, role,
      len({sql_words('text')}) * 1.3 + 100 AS cost FROM conversations),
    u AS (SELECT conv_id, turn, pos, cost, 900 - 150 - cost AS left_over FROM c WHERE role = 'user'),
    o AS (SELECT u.conv_id, u.turn, u.pos, i.i AS drop_n,
        coalesce((SELECT sum(h.cost) FROM c h WHERE h.conv_id = u.conv_id AND h.pos < u.pos AND h.pos >= i.i), 0) <= u.left_over AS fits,
        u.pos - i.i <= 2 AS short
      FROM u, (SELECT unnest(range(0, 12, 2)) AS i) i WHERE i.i <= u.pos)
    SELECT conv_id, turn, pos AS n_before, pos - min(drop_n) AS n_kept, min(drop_n) AS first_kept
    FROM o WHERE fits OR short GROUP BY conv_id, turn, pos"""


@query("w2_recent_history", W2_SQL)
def w2(spark: SparkSession, d: str) -> DataFrame:
    return conversation.recent_history(talk(spark, d)).select("conv_id", "turn", "history")


@query("w2_recent_history_gaps", gappy_sql(W2_SQL))
def w2_gaps(spark: SparkSession, d: str) -> DataFrame:
    return conversation.recent_history(gappy(spark, d)).select("conv_id", "turn", "history")


@query("w3_history_summary", W3_SQL)
def w3(spark: SparkSession, d: str) -> DataFrame:
    return conversation.history_summary(talk(spark, d)).select("conv_id", "turn", "history_summary")


@query("w3_history_summary_gaps", gappy_sql(W3_SQL))
def w3_gaps(spark: SparkSession, d: str) -> DataFrame:
    return conversation.history_summary(gappy(spark, d)).select("conv_id", "turn", "history_summary")


def kept(turns: DataFrame) -> DataFrame:
    prompt = F.lit(150.0) + tx.token_estimate(F.col("text"))
    return conversation.kept_history(turns, prompt, budget=900.0, width=4)


# The fixture has no immediate repeats, so messages are compared by a short code of theirs.
ASKED_SQL = """asked AS (SELECT conv_id, turn, role, CAST(length(text) % 2 AS VARCHAR) AS text FROM conversations)"""


def coded(spark: SparkSession, d: str) -> DataFrame:
    return talk(spark, d).withColumn("text", (F.length("text") % 2).cast("string"))


@query(
    "w4_repeat_counts",
    f"""WITH {ASKED_SQL}, u AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS nth,
        lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM asked WHERE role = 'user')
    SELECT conv_id, turn, nth - max(CASE WHEN before IS NULL OR before <> text THEN nth END) OVER (PARTITION BY conv_id ORDER BY turn) AS repeats FROM u""",
)
def w4(spark: SparkSession, d: str) -> DataFrame:
    return conversation.repeat_counts(coded(spark, d), width=4).select("conv_id", "turn", "repeats")


@query(
    "w5_kept_history",
    W5_SQL,
)
def w5(spark: SparkSession, d: str) -> DataFrame:
    return kept(talk(spark, d))


@query("w5_kept_history_gaps", gappy_sql(W5_SQL))
def w5_gaps(spark: SparkSession, d: str) -> DataFrame:
    return kept(gappy(spark, d))


@query(
    "e3_distinct_2",
    f"""WITH w AS (SELECT conv_id, {sql_words('text')} AS w FROM conversations WHERE role = 'assistant'),
    g AS (SELECT conv_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM w)
    SELECT c.conv_id, round(coalesce(count(DISTINCT g) / nullif(count(g), 0), 0), 6)::DOUBLE AS distinct_2
    FROM (SELECT DISTINCT conv_id FROM w) c LEFT JOIN g ON g.conv_id = c.conv_id GROUP BY c.conv_id""",
)
def e3(spark: SparkSession, d: str) -> DataFrame:
    answers = talk(spark, d).where(F.col("role") == "assistant")
    return evaluation.distinct_n(answers, ["conv_id"], "text").withColumn("distinct_2", F.round("distinct_2", 6))


@query(
    "a12_distinct_ratio",
    f"""WITH t AS (SELECT lang, unnest({sql_tokens('lower(text)')}) AS t FROM documents)
    SELECT lang, round(count(DISTINCT t) / count(*), 6)::DOUBLE AS distinct_ratio FROM t GROUP BY lang""",
)
def a12(spark: SparkSession, d: str) -> DataFrame:
    tokens = exploded(documents(spark, d), ["lang"], tx.tokenize(F.lower("text")), "t")
    return counts.distinct_ratio(tokens, ["lang"], "t").withColumn("distinct_ratio", F.round("distinct_ratio", 6))


VOWELS = "[aeiouyàâäéèêëíîïóôöúùûü]+"
FLESCH_SQL = f"""flesch AS (
  SELECT conv_id, turn, regexp_extract_all(text, '[\\p{{L}}]+') AS w, greatest(len(regexp_extract_all(text, '[.!?]+')), 1) AS s
  FROM conversations WHERE role = 'assistant'),
ease AS (SELECT conv_id, turn, 206.835::DOUBLE - 1.015::DOUBLE * (greatest(len(w), 1) / s) - 84.6::DOUBLE *
    (coalesce(list_sum(list_transform(w, lambda x: greatest(len(regexp_extract_all(lower(x), '{VOWELS}')), 1))), 0) / greatest(len(w), 1)) AS readability FROM flesch)"""


def answers_of(spark: SparkSession, d: str) -> DataFrame:
    return talk(spark, d).where(F.col("role") == "assistant")


@query("e4_readability", f"WITH {FLESCH_SQL} SELECT conv_id, turn, round(readability, 6) AS readability FROM ease")
def e4(spark: SparkSession, d: str) -> DataFrame:
    ease = F.round(evaluation.readability(F.col("text")), 6)
    return answers_of(spark, d).select("conv_id", "turn", ease.alias("readability"))


# Words of the fixture languages with made-up valences, and negations that precede them.
VALENCES = {"the": 1.5, "de": -0.5, "in": 0.25, "and": -1.0, "la": 0.75, "und": -0.25, "el": 0.5}
NEGATIONS = ["of", "le", "die", "que"]
SENTIMENT_SQL = f"""tokens AS (SELECT conv_id, turn, {sql_tokens('lower(text)')} AS t FROM conversations WHERE role = 'assistant'),
scored AS (SELECT conv_id, turn, coalesce(list_sum(list_transform(t, lambda w, i:
    (CASE w {' '.join(f"WHEN '{k}' THEN {v}" for k, v in VALENCES.items())} ELSE 0 END)::DOUBLE *
    CASE WHEN i > 1 AND list_contains({sql_list(NEGATIONS)}, t[i - 1]) THEN -0.74::DOUBLE ELSE 1 END)), 0) AS s FROM tokens),
moods AS (SELECT conv_id, turn, s / sqrt(s * s + 15) AS empathy FROM scored)"""


def mood(text: str = "text"):
    return evaluation.sentiment_score(F.col(text), VALENCES, NEGATIONS)


@query("e5_sentiment_score", f"WITH {SENTIMENT_SQL} SELECT conv_id, turn, round(empathy, 6) AS empathy FROM moods")
def e5(spark: SparkSession, d: str) -> DataFrame:
    return answers_of(spark, d).select("conv_id", "turn", F.round(mood(), 6).alias("empathy"))


@query("e5_sentiment_by_table", f"WITH {SENTIMENT_SQL} SELECT conv_id, turn, round(empathy, 6)::DOUBLE AS sentiment FROM moods")
def e5_table(spark: SparkSession, d: str) -> DataFrame:
    lexicon = spark.createDataFrame(list(VALENCES.items()), "token string, valence double")
    out = evaluation.sentiment_by_table(answers_of(spark, d), ["conv_id", "turn"], "text", lexicon, NEGATIONS)
    return out.withColumn("sentiment", F.round("sentiment", 6))


@query("e6_toxicity")
def e6(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d).select("doc_id", tx.tokenize(F.lower("text"), 2).alias("tokens"))
    labelled = docs.join(table(spark, d, "labels").select("doc_id", F.col("toxic").cast("double").alias("label")), "doc_id")
    model = evaluation.toxicity_model(labelled, "tokens", "label", 1 << 14)
    return evaluation.toxicity(docs, model).select("doc_id", F.round("toxicity", 4).alias("toxicity"))


PERPLEXITY_SQL = f"""tok AS (SELECT conv_id, turn, role, list_concat(['<s>'], {sql_tokens('lower(text)')}) AS t FROM conversations),
big AS (SELECT conv_id, turn, role, unnest(list_transform(range(1, len(t)), lambda i: {{'w1': t[i], 'w2': t[i + 1]}})) AS p FROM tok),
c12 AS (SELECT p.w1 AS w1, p.w2 AS w2, count(*) AS c12 FROM big GROUP BY 1, 2),
c1 AS (SELECT w1, sum(c12) AS c1 FROM c12 GROUP BY w1),
vocab AS (SELECT count(DISTINCT w2) AS v FROM c12),
perp AS (SELECT conv_id, turn, exp(-avg(ln((c12 + 1)::DOUBLE / (c1 + v)))) AS perplexity
  FROM big JOIN c12 ON c12.w1 = p.w1 AND c12.w2 = p.w2 JOIN c1 ON c1.w1 = p.w1, vocab WHERE role = 'assistant' GROUP BY conv_id, turn)"""


@query("e7_perplexity", f"WITH {PERPLEXITY_SQL} SELECT conv_id, turn, round(perplexity, 6) AS perplexity FROM perp")
def e7(spark: SparkSession, d: str) -> DataFrame:
    out = evaluation.bigram_perplexity(talk(spark, d), answers_of(spark, d), ["conv_id", "turn"], "text")
    return out.withColumn("perplexity", F.round("perplexity", 6))


@query(
    "e8_answer_variety",
    f"""WITH a AS (SELECT conv_id, turn, text, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM conversations WHERE role = 'assistant'),
    x AS (SELECT conv_id, turn, unnest({sql_tokens('lower(text)', 2)}) AS t, 1 AS a, 0 AS b FROM a WHERE before IS NOT NULL
      UNION ALL SELECT conv_id, turn, unnest({sql_tokens('lower(before)', 2)}), 0, 1 FROM a WHERE before IS NOT NULL),
    n AS (SELECT conv_id, turn, t, sum(a) AS a, sum(b) AS b FROM x GROUP BY ALL),
    w AS (SELECT *, CASE WHEN a > 0 AND b > 0 THEN 1.0::DOUBLE ELSE 1.0::DOUBLE + ln(1.5::DOUBLE) END AS w FROM n),
    s AS (SELECT conv_id, turn, sum(a * b * w * w) / nullif(sqrt(sum(a * a * w * w) * sum(b * b * w * w)), 0) AS similarity FROM w GROUP BY conv_id, turn)
    SELECT a.conv_id, a.turn, round(coalesce(similarity, 0), 6)::DOUBLE AS similarity, coalesce(similarity, 0) > 0.7 AS repetitive
    FROM a LEFT JOIN s ON s.conv_id = a.conv_id AND s.turn = a.turn WHERE before IS NOT NULL""",
)
def e8(spark: SparkSession, d: str) -> DataFrame:
    out = evaluation.answer_variety(answers_of(spark, d), ["conv_id"], "turn", "text")
    return out.withColumn("similarity", F.round("similarity", 6))


def answer_scores(spark: SparkSession, d: str) -> list[DataFrame]:
    """Readability, mood, judge score, variety of words, fluency and relevance of every answer."""
    answers = answers_of(spark, d)
    reply = F.concat(F.lit("rated "), (F.col("turn") + F.lit(0.5)).cast("string"))
    own = answers.select(
        "conv_id", "turn",
        evaluation.readability(F.col("text")).alias("readability"),
        mood().alias("empathy"),
        tx.first_number(reply).alias("helpfulness"),
    )
    fluency = evaluation.bigram_perplexity(talk(spark, d), answers, ["conv_id", "turn"], "text")
    return [own, evaluation.distinct_n(answers, ["conv_id", "turn"], "text"), fluency, evaluation.answer_relevance(said(spark, d))]


@query(
    "e9_scorecard",
    f"""WITH {FLESCH_SQL}, {SENTIMENT_SQL}, {PERPLEXITY_SQL}, {SAID_SQL},
    judged AS (SELECT conv_id, turn, coalesce(try_cast(nullif(regexp_extract('rated ' || CAST(turn + 0.5 AS VARCHAR), '([0-9]+(?:\\.[0-9]+)?)', 1), '') AS DOUBLE), 5.0) AS helpfulness
      FROM conversations WHERE role = 'assistant'),
    split AS (SELECT conv_id, turn, {sql_words('text')} AS w FROM conversations WHERE role = 'assistant'),
    varied AS (SELECT conv_id, turn, CASE WHEN len(w) < 2 THEN 0 ELSE
      len(list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])))::DOUBLE / (len(w) - 1) END AS distinct_2 FROM split)
    SELECT round(avg(readability), 6) AS avg_readability, round(avg(empathy), 6) AS avg_empathy, round(avg(helpfulness), 6) AS avg_helpfulness,
      round(avg(distinct_2), 6) AS avg_distinct_2, round(avg(perplexity), 6) AS avg_perplexity, round(avg(relevance), 6) AS avg_relevance
    FROM ease JOIN moods USING (conv_id, turn) JOIN perp USING (conv_id, turn) JOIN judged USING (conv_id, turn)
      JOIN varied USING (conv_id, turn) JOIN relevant USING (conv_id, turn)""",
)
def e9(spark: SparkSession, d: str) -> DataFrame:
    card = evaluation.scorecard(*answer_scores(spark, d), on=["conv_id", "turn"])
    return card.select(*[F.round(c, 6).alias(c) for c in card.columns])


@query("e9_scorecard_toxicity")
def e9_toxicity(spark: SparkSession, d: str) -> DataFrame:
    """The same averages and that of toxicity, by a model fitted on the labelled documents."""
    tokens = tx.tokenize(F.lower("text"), 2).alias("tokens")
    labels = table(spark, d, "labels").select("doc_id", F.col("toxic").cast("double").alias("label"))
    model = evaluation.toxicity_model(documents(spark, d).select("doc_id", tokens).join(labels, "doc_id"), "tokens", "label", 1 << 14)
    toxic = evaluation.toxicity(answers_of(spark, d).select("conv_id", "turn", tokens), model).select("conv_id", "turn", "toxicity")
    card = evaluation.scorecard(*answer_scores(spark, d), toxic, on=["conv_id", "turn"])
    return card.select(*[F.round(c, 4).alias(c) for c in card.columns])


@query(
    "a10_averages",
    """SELECT round(avg(l_quantity), 6) AS avg_l_quantity, round(avg(l_discount), 6) AS avg_l_discount, round(avg(l_tax), 6) AS avg_l_tax FROM lineitem""",
)
def a10(spark: SparkSession, d: str) -> DataFrame:
    out = counts.averages(table(spark, d, "lineitem"), ["l_quantity", "l_discount", "l_tax"])
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])
