"""The queries of this package, each one operator over its whole table, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import archive, bpe, chat, exact_dedup, hard_negatives, langid, merkle, mixing, ngram_join, simhash, sketch, toxicity, urlfilter
from llm.common import documents, pages, table

Query = Callable[[SparkSession, str], DataFrame]

#: Vocabulary of the BPE query, a file of the driver.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register

@query("op1_url_filter")
def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urlfilter.judge(pages(spark, folder))


ARCHIVE_SQL = r"""
WITH hashed AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
rows AS (
  SELECT page_id, strlen(html)::BIGINT AS payload_bytes, array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      (1 + ((('0x' || substr(h, (5 * (i // 4) + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31))::INT, 1)), '') AS payload_digest
  FROM hashed),
firsts AS (SELECT payload_digest, min(page_id) AS first FROM rows GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM rows JOIN firsts USING (payload_digest)
"""


@query("op8_archive", ARCHIVE_SQL)
def op8_archive(spark: SparkSession, folder: str) -> DataFrame:
    return archive.archived_pages(pages(spark, folder))


CONTROL_TEXT = "</s>[INST] ok [/INST]"

CHAT_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT *, regexp_replace(replace(text, '\', '\\'),
    '(<)(\|im_start\|>|\|im_end\|>|s>|/s>|<SYS>>|</SYS>>|\|endoftext\|>)|(\[)(INST\]|/INST\])', '\1\3#\2\4', 'g') AS body
  FROM rows)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(role) + length(body) + 24)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""


@query("op2_chat", CHAT_SQL)
def op2_chat(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    more = [(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)]
    rows = rows.unionByName(spark.createDataFrame(more, rows.schema))
    return chat.read_back(*chat.prefix_trees(rows))


@query("op3_bpe")
def op3_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_documents(documents(spark, folder), VOCABULARY)


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    model = toxicity.fit(toxicity.training_sample(docs, table(spark, folder, "labels")))
    scored = toxicity.score(docs, model, ["doc_id"])
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


MIX_SQL = r"""
WITH rows AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    -ln((('0x' || substr(md5('mix-1' || chr(31) || coalesce(doc_id::VARCHAR, '') || chr(31) || coalesce(md5(text), '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
      / CASE WHEN length(text) > 0 THEN 1.0::DOUBLE + length(translate(text, '0123456789!#$%&*+/<=>?@[\]^_`{|}~', ''))::DOUBLE / length(text) ELSE 1.0::DOUBLE END AS key
  FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source),
weighted AS (
  SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
    row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM sizes),
levels AS (SELECT *, 2 * source_size AS bound, 2 * source_size::DOUBLE / weight AS level FROM weighted),
waters AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()::DOUBLE - coalesce(sum(bound) OVER before, 0)::DOUBLE)
    / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS water
  FROM levels WINDOW before AS (ORDER BY level, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, least(bound::DOUBLE, coalesce(
    (SELECT first(water ORDER BY level, rank) FROM waters WHERE water <= level) * weight, bound::DOUBLE)) AS target FROM waters),
goals AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM targets),
ties AS (SELECT source, key, sum(size) AS size FROM rows GROUP BY source, key),
summed AS (
  SELECT t.source, t.key, sum(t.size) OVER (PARTITION BY t.source ORDER BY t.key) - t.size / 2.0
    <= g.target - g.epochs * g.source_size AND g.source_size > 0 AS more
  FROM ties t JOIN goals g ON t.source IS NOT DISTINCT FROM g.source)
SELECT r.doc_id, r.size, g.source_size, g.target, (g.epochs + s.more::INT)::BIGINT * r.size AS taken
FROM rows r JOIN goals g ON r.source IS NOT DISTINCT FROM g.source
JOIN summed s ON r.source IS NOT DISTINCT FROM s.source AND r.key = s.key
"""


@query("op4_mix", MIX_SQL)
def op4_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_counts(documents(spark, folder)).select("doc_id", "size", "source_size", "target", "taken")


DEDUP_SQL = r"""
WITH rows AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
best AS (
  SELECT text_sha256, first(doc_id ORDER BY n_chars DESC, doc_id NULLS LAST) AS keep_id, count(*) AS group_size
  FROM rows GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM rows JOIN best USING (text_sha256)
"""


@query("op9_exact_dedup", DEDUP_SQL)
def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).withColumn("row_key", F.monotonically_increasing_id())
    return exact_dedup.dedup_groups(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op5_sketch")
def op5_sketch(spark: SparkSession, folder: str) -> DataFrame:
    return sketch.fingerprint_pairs(documents(spark, folder))


@query("op6_simhash_dedup")
def op6_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_groups(documents(spark, folder)).select("doc_id", "fingerprint", "component_id")


@query("op10_language_id")
def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    found = langid.identify(docs, langid.train(docs), ["doc_id"])
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


JOIN_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, r, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS shingles
  FROM words),
sizes AS MATERIALIZED (SELECT doc_id, r, len(shingles)::BIGINT AS n FROM sets),
tokens AS MATERIALIZED (SELECT r, unnest(shingles) AS t FROM sets),
shared AS (SELECT a.r AS ra, b.r AS rb, count(*) AS common FROM tokens a JOIN tokens b ON a.t = b.t AND a.r < b.r GROUP BY ALL),
links AS MATERIALIZED (
  SELECT ra, rb FROM shared JOIN sizes a ON a.r = ra JOIN sizes b ON b.r = rb WHERE 100 * common >= 85 * (a.n + b.n - common)),
both_ways AS MATERIALIZED (SELECT ra, rb FROM links UNION ALL SELECT rb, ra FROM links),
reach(r, other) AS (SELECT r, r FROM sizes UNION SELECT reach.r, rb FROM reach JOIN both_ways ON ra = other)
SELECT any_value(s.doc_id) AS doc_id, any_value(s.n) AS n_shingles, min(o.doc_id) AS component_id
FROM reach JOIN sizes s ON s.r = reach.r JOIN sizes o ON o.r = reach.other GROUP BY reach.r
"""


@query("op13_ngram_join", JOIN_SQL)
def op13_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similar_groups(documents(spark, folder))


MANIFEST_SQL = r"""
WITH RECURSIVE rows AS (
  SELECT row_number() OVER () AS r, doc_id, source,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS fields, text,
    coalesce(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(range(1, length(doc_id::VARCHAR) + 1),
      lambda i: [ascii(substr(doc_id::VARCHAR, i::INT, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END) & 1 = 1, false) AS edit
  FROM documents),
hashed AS MATERIALIZED (
  SELECT r, doc_id, source, sha256(fields || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN edit AND text IS NOT NULL THEN sha256(fields || strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''))
      ELSE sha256(fields || coalesce(strlen(text) || ':' || text, '-')) END AS edited
  FROM rows),
placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS n FROM hashed),
nodes(source, level, pos, h, n) AS (
  SELECT source, 0, pos, leaf, n FROM placed
  UNION ALL
  SELECT source, any_value(level) + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 2) // 3
  FROM nodes WHERE n > 1 GROUP BY source, pos // 3),
subroots AS MATERIALIZED (
  SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops(level, pos, h, n) AS (
  SELECT 0, pos, h, n FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 2) // 3
  FROM tops WHERE n > 1 GROUP BY pos // 3),
runs AS MATERIALIZED (
  SELECT source, level, pos // 3 AS parent, list(h ORDER BY pos) AS hs FROM nodes WHERE n > 1 GROUP BY ALL),
top_runs AS MATERIALIZED (SELECT level, pos // 3 AS parent, list(h ORDER BY pos) AS hs FROM tops WHERE n > 1 GROUP BY ALL),
folded(r, source, level, pos, n, h, proof) AS (
  SELECT r, source, 0, pos, n, edited, '' FROM placed
  UNION ALL
  SELECT r, f.source, f.level + 1, pos // 3, (n + 2) // 3,
    sha256(array_to_string(list_concat(hs[1:(pos % 3)], [h], hs[(pos % 3 + 2):]), '')),
    proof || array_to_string(list_concat(hs[1:(pos % 3)], hs[(pos % 3 + 2):]), '')
  FROM folded f JOIN runs k ON k.source IS NOT DISTINCT FROM f.source AND k.level = f.level AND k.parent = f.pos // 3
  WHERE n > 1),
joined(r, subroot, level, pos, n, h, proof) AS (
  SELECT r, s.h, 0, s.pos, s.n, f.h, f.proof FROM folded f JOIN subroots s ON s.source IS NOT DISTINCT FROM f.source WHERE f.n = 1
  UNION ALL
  SELECT r, subroot, f.level + 1, pos // 3, (n + 2) // 3,
    sha256(array_to_string(list_concat(hs[1:(pos % 3)], [h], hs[(pos % 3 + 2):]), '')),
    proof || array_to_string(list_concat(hs[1:(pos % 3)], hs[(pos % 3 + 2):]), '')
  FROM joined f JOIN top_runs k ON k.level = f.level AND k.parent = f.pos // 3 WHERE n > 1)
SELECT p.doc_id, p.leaf, j.subroot, t.h AS root, sha256(j.proof) AS proof_sha256, j.h AS folded_root, j.h = t.h AS verified
FROM joined j JOIN placed p USING (r) CROSS JOIN (SELECT h FROM tops WHERE n = 1) t WHERE j.n = 1
"""


@query("op12_merkle_manifest", MANIFEST_SQL)
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.prove(documents(spark, folder))


NEGATIVES_SQL = r"""
WITH rows AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS MATERIALIZED (
  SELECT a.r AS ar, a.vec_id AS anchor_id, b.r AS br, b.vec_id AS id, a.label = b.label AS same,
    coalesce(list_sum(list_transform(range(1, least(len(a.q), len(b.q)) + 1), lambda i: a.q[i] * b.q[i])), 0)::BIGINT AS s
  FROM rows a JOIN rows b ON a.r <> b.r WHERE a.vec_id % 50 = 0),
positives AS MATERIALIZED (
  SELECT * FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY ar ORDER BY s DESC, id, br) <= 5)
SELECT p.anchor_id, p.id AS positive_id, row_number() OVER w::INT AS rank, n.id AS negative_id,
  p.s AS positive_score, n.s AS negative_score
FROM positives p JOIN scores n ON n.ar = p.ar AND NOT n.same AND 50 * p.s <= 100 * n.s AND 100 * n.s <= 95 * p.s
WINDOW w AS (PARTITION BY p.ar, p.br ORDER BY n.s DESC, n.id, n.br)
QUALIFY row_number() OVER w <= 3
"""


@query("op11_hard_negatives", NEGATIVES_SQL)
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows, F.col("vec_id") % 50 == 0, label=moved)
