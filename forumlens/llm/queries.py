"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.llm.decontamination import benchmark_hits, items_digest
from forumlens.llm.filter_audit import audit_filters
from forumlens.llm.fingerprints import edited_fingerprints, next_keys
from forumlens.llm.line_labels import label_lines, train_field
from forumlens.llm.line_spread import drop_spread_lines
from forumlens.llm.manifest import merkle_manifest
from forumlens.llm.mixture import mix_sources
from forumlens.llm.near_duplicates import near_duplicates
from forumlens.llm.passages import drop_repeated_passages
from forumlens.llm.pieces import encode_texts
from forumlens.llm.preferences import conversation_pairs, format_preferences
from forumlens.llm.shards import shard_by_bytes
from forumlens.llm.suffixes import drop_repeated_strings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def register(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query("op7_document_fingerprints")
def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(documents(spark, sf_dir))


@query("op9_mix_sources")
def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir)).shares()


@query("op10_pieces")
def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(documents(spark, sf_dir)).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


@query("op2_shard_by_bytes")
def op2_shard_by_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op6_repeated_passages")
def op6_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated_passages(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256")
    )


@query("op1_near_duplicates")
def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), shingle=4).drop("first", "text_sum")


@query("op4_quality_rules")
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    field = train_field(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return label_lines(docs, field).drop("states")


@query("op3_repeated_strings")
def op3_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated_strings(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


OP8_SQL = """
WITH lines AS (
  SELECT DISTINCT doc_id, source, line FROM (
    SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
spread AS (SELECT line, min(doc_id) AS first FROM lines GROUP BY line HAVING count(DISTINCT source) >= 10),
gone AS (SELECT l.doc_id, l.line FROM lines l JOIN spread s USING (line) WHERE l.doc_id > s.first),
per_doc AS (SELECT doc_id, list(line) AS gone FROM gone GROUP BY doc_id),
cut AS (
  SELECT d.doc_id, string_split(coalesce(d.text, ''), chr(10)) AS lines, coalesce(p.gone, []) AS gone
  FROM documents d LEFT JOIN per_doc p USING (doc_id)),
kept AS (SELECT doc_id, lines, list_filter(lines, lambda x: NOT list_contains(gone, x)) AS rest FROM cut)
SELECT doc_id, len(lines)::BIGINT AS n_lines, (len(lines) - len(rest))::BIGINT AS n_removed,
       sha256(array_to_string(rest, chr(10))) AS kept_sha256
FROM kept
"""


@query("op8_line_spread", OP8_SQL)
def op8_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_spread_lines(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256")
    )


OP5_SQL = """
WITH ids AS (SELECT DISTINCT conv_id FROM conversations),
after AS (
  SELECT conv_id, coalesce(lead(conv_id) OVER (ORDER BY conv_id), min(conv_id) OVER ()) AS other_id FROM ids),
answers AS (
  SELECT conv_id, max(turn) AS at, max_by(text, turn) AS said FROM conversations WHERE role = 'assistant' GROUP BY conv_id),
pairs AS (
  SELECT a.conv_id, a.other_id, 'answer' AS kind, o.at, b.said
  FROM after a JOIN answers o USING (conv_id) JOIN answers b ON b.conv_id = a.other_id),
opening AS (SELECT conv_id, min_by(role, turn) AS r, min_by(text, turn) AS t FROM conversations GROUP BY conv_id),
heads AS (SELECT r, t, min(conv_id) AS head FROM opening GROUP BY r, t),
stars AS (
  SELECT h.head AS conv_id, o.conv_id AS other_id, 'first_turn' AS kind
  FROM opening o JOIN heads h ON o.r = h.r AND o.t = h.t WHERE o.conv_id <> h.head),
sides AS (
  SELECT 'chosen' AS side, p.conv_id, p.other_id, p.kind, c.turn, c.role, c.text
  FROM pairs p JOIN conversations c USING (conv_id) WHERE c.turn <= p.at
  UNION ALL
  SELECT 'rejected', p.conv_id, p.other_id, p.kind, c.turn, c.role, CASE WHEN c.turn = p.at THEN p.said ELSE c.text END
  FROM pairs p JOIN conversations c USING (conv_id) WHERE c.turn <= p.at
  UNION ALL
  SELECT 'chosen', s.conv_id, s.other_id, s.kind, c.turn, c.role, c.text FROM stars s JOIN conversations c USING (conv_id)
  UNION ALL
  SELECT 'rejected', s.conv_id, s.other_id, s.kind, c.turn, c.role, c.text
  FROM stars s JOIN conversations c ON c.conv_id = s.other_id),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY side, conv_id, other_id, kind ORDER BY turn) - 1 AS pos,
         '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS rendered
  FROM sides),
summed AS (
  SELECT *, sum(length(rendered)) OVER (PARTITION BY side, conv_id, other_id, kind ORDER BY pos) AS stop FROM numbered),
split AS (
  SELECT coalesce(l.conv_id, r.conv_id) AS conv_id, coalesce(l.other_id, r.other_id) AS other_id,
         coalesce(l.kind, r.kind) AS kind,
         coalesce(min(CASE WHEN l.rendered IS DISTINCT FROM r.rendered THEN coalesce(l.pos, r.pos) END),
                  max(coalesce(l.pos, r.pos)) + 1) AS at
  FROM (SELECT * FROM numbered WHERE side = 'chosen') l
  FULL JOIN (SELECT * FROM numbered WHERE side = 'rejected') r
    ON l.conv_id = r.conv_id AND l.other_id = r.other_id AND l.kind = r.kind AND l.pos = r.pos
  GROUP BY 1, 2, 3)
SELECT s.conv_id, s.other_id, s.kind, CASE WHEN s.pos < t.at THEN 'prompt' ELSE s.side END AS part, s.pos, s.rendered,
       (s.stop - length(s.rendered))::BIGINT AS start, length(s.rendered)::BIGINT AS length,
       s.pos < t.at OR s.role <> 'assistant' AS masked
FROM summed s JOIN split t ON s.conv_id = t.conv_id AND s.other_id = t.other_id AND s.kind = t.kind
WHERE s.side = 'chosen' OR s.pos >= t.at
"""


@query("op5_preferences", OP5_SQL)
def op5_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    after = next_keys(talks.where("conv_id is not null").select(F.col("conv_id").alias("k"))).toDF("conv_id", "other_id")
    chosen, rejected = conversation_pairs(talks, after)
    return format_preferences(chosen, rejected, ["conv_id", "other_id", "kind"])


OP1_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE []::VARCHAR[] END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
twoway AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, e.b FROM reach r JOIN twoway e ON e.a = r.other),
component AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id),
classes AS (SELECT w, min(doc_id) AS class_id FROM words WHERE len(w) > 0 GROUP BY w)
SELECT c.doc_id, coalesce(z.n, 0)::BIGINT AS n_shingles, c.component_id, c.doc_id = c.component_id AS kept,
       coalesce(k.class_id, c.doc_id) AS class_id
FROM component c JOIN words w USING (doc_id) LEFT JOIN sizes z USING (doc_id) LEFT JOIN classes k ON k.w = w.w
"""
ORACLES["op1_near_duplicates"] = OP1_SQL

OP6_SQL = """
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i+12], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words)),
firsts AS (SELECT s, min(doc_id) AS first FROM windows GROUP BY s),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM windows JOIN firsts USING (s) WHERE doc_id > first),
kept AS (
  SELECT u.doc_id, string_agg(u.word, ' ' ORDER BY u.p) AS text, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM words) u
  LEFT JOIN gone g ON g.doc_id = u.doc_id AND g.p = u.p WHERE g.p IS NULL GROUP BY u.doc_id)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, (len(w.w) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM words w LEFT JOIN kept k USING (doc_id)
"""
ORACLES["op6_repeated_passages"] = OP6_SQL

OP13_SQL = """
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i+least(len(w), 10)-1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM item_words WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM item_windows),
places AS (
  SELECT doc_id, i, size, array_to_string(w[i:i+size-1], ' ') AS s
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc_words, sizes WHERE len(w) >= size)),
met AS (SELECT p.doc_id, p.i, p.size, w.item_id FROM places p JOIN item_windows w USING (size, s)),
hits AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM met) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM met WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(i.n, 0)::BIGINT AS n_items,
       sha256(coalesce(i.names, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hits h USING (doc_id) LEFT JOIN items i USING (doc_id)
"""


@query("op13_benchmark_hits", OP13_SQL)
def op13_benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = benchmark_hits(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", items_digest("items").alias("items_sha256"), "contaminated")


OP11_SQL = """
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
firsts AS (SELECT text, min(doc_id) AS first FROM texts GROUP BY text),
said AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
failed AS (
  SELECT t.part, coalesce(s.good, 0) AS good, coalesce(s.toxic, 0) AS toxic,
         (len(t.w) < 200)::INT + 2 * (100 * len(list_distinct(t.w)) < 50 * len(t.w))::INT
         + 4 * (100 * length(regexp_replace(t.text, '[^A-Z]', '', 'g')) > 2 * length(t.text))::INT
         + 8 * regexp_matches(t.text, '[#$%&*|]')::INT + 16 * (t.doc_id > f.first)::INT AS m
  FROM texts t JOIN firsts f USING (text) LEFT JOIN said s USING (doc_id)),
tally AS (SELECT part, m, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY part, m),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
  SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step-1]), 0)::INT AS before
  FROM orders, unnest(range(1, 6)) AS u(step)),
counted AS (
  SELECT p.part, s.filter_order, s.step::INT AS step, s.bit,
         sum(CASE WHEN m & (s.bit | s.before) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN m & s.bit <> 0 AND m & s.before = 0 THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN m & s.bit <> 0 AND m & s.before <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN m = s.bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN m & s.bit <> 0 AND m & s.before = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN m & s.bit <> 0 AND m & s.before = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM tally p, steps s GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM counted
"""


@query("op11_filter_audit", OP11_SQL)
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


OP12_SQL = """
WITH RECURSIVE field AS (
  SELECT doc_id, coalesce('+' || lang, '') AS g, text,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head
  FROM documents),
hashed AS (
  SELECT doc_id, g, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low, head,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
           lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
             lambda y, z: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384::BIGINT) ELSE y >> 1 END)), 4294967295::BIGINT) AS crc
  FROM field),
leaves AS (
  SELECT doc_id, g, leaf, CASE WHEN crc % 3 = 0 THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) ELSE leaf END AS seen,
         row_number() OVER (PARTITION BY g ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n
  FROM hashed),
tree AS (
  SELECT g, 0 AS level, pos, leaf AS h, n FROM leaves
  UNION ALL
  SELECT g, level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (min(n) + 7) // 8 FROM tree WHERE n > 1 GROUP BY g, level, pos // 8),
subroots AS (SELECT g, h AS subroot, level AS height, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1),
top AS (
  SELECT 0 AS level, pos, subroot AS h, n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (min(n) + 7) // 8 FROM top WHERE n > 1 GROUP BY level, pos // 8),
sides AS (
  SELECT a.g, a.level, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
         coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM tree a JOIN tree b ON a.g = b.g AND a.level = b.level AND a.pos // 8 = b.pos // 8 WHERE a.n > 1 GROUP BY ALL
  UNION ALL
  SELECT s.g, s.height + a.level, NULL, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), ''),
         coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '')
  FROM subroots s JOIN top a ON a.pos = s.pos // (8 ** a.level)::BIGINT JOIN top b ON a.level = b.level AND a.pos // 8 = b.pos // 8
  WHERE a.n > 1 GROUP BY s.g, s.height, a.level, a.pos),
steps AS (
  SELECT e.doc_id, s.level, s.l, s.r FROM leaves e JOIN sides s ON s.g = e.g AND (s.pos IS NULL OR s.pos = e.pos // (8 ** s.level)::BIGINT)),
fold AS (
  SELECT doc_id, 0 AS level, seen AS h FROM leaves
  UNION ALL
  SELECT f.doc_id, f.level + 1, sha256(s.l || f.h || s.r) FROM fold f JOIN steps s ON s.doc_id = f.doc_id AND s.level = f.level),
proofs AS (SELECT doc_id, sha256(string_agg(l || r, '' ORDER BY level)) AS p FROM steps GROUP BY doc_id),
ends AS (SELECT doc_id, max_by(h, level) AS h FROM fold GROUP BY doc_id)
SELECT e.doc_id, e.leaf, s.subroot, t.h AS root, coalesce(p.p, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = t.h AS verified
FROM leaves e JOIN subroots s USING (g) JOIN top t ON t.n = 1 JOIN ends f USING (doc_id) LEFT JOIN proofs p USING (doc_id)
"""


@query("op12_merkle_manifest", OP12_SQL)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    tampered = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 0
    text = F.when(tampered, F.translate("text", upper, lower)).otherwise(F.col("text"))
    return merkle_manifest(documents(spark, sf_dir), {"text": text})
