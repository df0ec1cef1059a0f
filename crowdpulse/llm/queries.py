"""One registered query for each corpus operator, over its whole table, and SQL twins where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdpulse.llm import langid, quality
from crowdpulse.llm.common import fold, read_table
from crowdpulse.llm.embed_dedup import embedding_components
from crowdpulse.llm.html_text import main_text
from crowdpulse.llm.line_dedup import dedup_lines
from crowdpulse.llm.mixing import mix
from crowdpulse.llm.neighbours import nearest
from crowdpulse.llm.nnls_packing import pack_by_least_squares
from crowdpulse.llm.packing import pack_documents
from crowdpulse.llm.phrases import collocations
from crowdpulse.llm.simhash import simhash_components
from crowdpulse.llm.token_links import token_links
from crowdpulse.llm.warc import read_warc, write_warc


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 5) == 0
    model = langid.fit(docs.filter(~held_out))
    return langid.predict(docs, model, F.col("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(read_table(spark, sf_dir, "pages"))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_components(read_table(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op5_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = write_warc(read_table(spark, sf_dir, "pages"))
    return read_warc(spark, index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    held_out = fold("doc_id", 3) == 1
    model = quality.fit(docs.filter(~held_out), labels.filter(~held_out))
    return quality.score(docs, model, F.col("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


def op11_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_by_least_squares(read_table(spark, sf_dir, "documents"))


def op12_token_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_links(read_table(spark, sf_dir, "documents"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))


OP4_SQL = """
WITH RECURSIVE usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(embedding, lambda c: c <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable AS a JOIN usable AS b
  ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) END >= 0.9
), reached AS (
  SELECT vec_id AS a, vec_id AS b FROM usable
  UNION
  SELECT r.a, l.b FROM reached AS r JOIN links AS l ON l.a = r.b
), counts AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
), components AS (
  SELECT a, min(b) AS component_id FROM reached GROUP BY a
)
SELECT v.vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(c.component_id, v.vec_id) AS component_id,
       coalesce(v.vec_id = coalesce(c.component_id, v.vec_id), false) AS kept
FROM embeddings AS v LEFT JOIN counts ON counts.a = v.vec_id LEFT JOIN components AS c ON c.a = v.vec_id
"""

OP5_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         (('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, 'text:' || md5(coalesce(text, '')))), 1, 13))::BIGINT + 0.5::DOUBLE)
           / 4503599627370496.0::DOUBLE AS u
  FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM sized GROUP BY source
), caps AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap FROM per
), filled AS (
  SELECT *, row_number() OVER o AS place,
         (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
           / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM caps WINDOW o AS (ORDER BY cap / weight, encode(source) NULLS LAST)
), targets AS (
  SELECT source, source_size,
         least(cap, coalesce((SELECT arg_min(level, place) FROM filled WHERE level * weight <= cap) * weight, cap)) AS target
  FROM filled
), expected AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target, d.u,
         least(CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END, 2.0::DOUBLE) AS e
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), placed AS (
  SELECT *, floor(e)::BIGINT AS certain, e - floor(e) AS p,
         CASE WHEN e - floor(e) > 0 THEN (u / (1 - u)) / ((e - floor(e)) / (1 - (e - floor(e)))) END AS q
  FROM expected
), ranked AS (
  SELECT source, q, sum(size) AS size, min(need) AS need,
         coalesce(sum(sum(size)) OVER (PARTITION BY source ORDER BY q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done
  FROM (SELECT *, target - sum(certain * size) OVER (PARTITION BY source) AS need FROM placed) WHERE q IS NOT NULL
  GROUP BY source, q
), cut AS (
  SELECT source, max(q) AS last FROM ranked WHERE 2 * done + size < 2 * need GROUP BY source
)
SELECT p.doc_id, p.size, p.source_size, p.target, (p.certain + coalesce(p.q <= c.last, false)::INT) * p.size AS taken,
       p.certain + coalesce(p.q <= c.last, false)::INT AS copies
FROM placed p LEFT JOIN cut c ON p.source IS NOT DISTINCT FROM c.source
"""

OP8_SQL = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), held AS (
  SELECT payload_digest, payload_bytes, max(page_id) AS latest FROM payloads WHERE payload_bytes >= 1000 GROUP BY ALL
)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN p.page_id < h.latest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.page_id < h.latest THEN h.latest END AS refers_to
FROM payloads p LEFT JOIN held h ON p.payload_digest = h.payload_digest AND p.payload_bytes = h.payload_bytes
"""

OP9_SQL = r"""
WITH lines AS (
  SELECT doc_id, coalesce(text, '') AS text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), holders AS (
  SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key
), marked AS (
  SELECT k.doc_id, k.pos, k.line, coalesce(h.first < k.doc_id, false) AS dropped
  FROM keyed k LEFT JOIN holders h ON h.key = k.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP13_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), numbered AS (
  SELECT lang, row_number() OVER () AS p, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), worded AS (
  SELECT lang, p, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM numbered
), edges AS (
  SELECT lang, a, lead(a) OVER o AS b, lead(a, 2) OVER o AS c FROM worded WINDOW o AS (PARTITION BY p ORDER BY i)
), grams AS (
  SELECT lang, 1 AS m, a AS phrase, count(*) AS f FROM edges GROUP BY ALL
  UNION ALL SELECT lang, 2, a || ' ' || b, count(*) FROM edges WHERE b IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, a || ' ' || b || ' ' || c, count(*) FROM edges WHERE c IS NOT NULL GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE m = 1 GROUP BY lang
), candidates AS (
  SELECT lang, m, phrase, string_split(phrase, ' ') AS w, f AS a FROM grams WHERE m > 1 AND f >= 10
), cut AS (
  SELECT lang, m, phrase, a, k, array_to_string(w[1 : k], ' ') AS lhs, array_to_string(w[k + 1 : m], ' ') AS rhs
  FROM candidates, (VALUES (1), (2)) AS cuts(k) WHERE k < m
), scored AS (
  SELECT c.*, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cut c JOIN grams x ON x.lang = c.lang AND x.phrase = c.lhs JOIN grams y ON y.lang = c.lang AND y.phrase = c.rhs
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT lang, array_to_string(w[i : i + 1], ' ') AS phrase, max(a) AS longer
  FROM candidates, (VALUES (1), (2)) AS starts(i) WHERE m = 3 GROUP BY ALL
), kept AS (
  SELECT b.* FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
  WHERE i.longer IS NULL OR 100 * i.longer < 50 * b.a
)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM kept k JOIN totals t ON t.lang = k.lang QUALIFY rank <= 2000
"""

QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_html_text": op3_html_text,
    "op4_embedding_near_dedup": op4_embedding_near_dedup,
    "op5_pareto_mix": op5_pareto_mix,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_warc": op8_warc,
    "op9_line_dedup": op9_line_dedup,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_nnls_packing": op11_nnls_packing,
    "op12_token_links": op12_token_links,
    "op13_phrase_collocations": op13_phrase_collocations,
}

ORACLE_SQL = {
    "op4_embedding_near_dedup": OP4_SQL,
    "op5_pareto_mix": OP5_SQL,
    "op8_warc": OP8_SQL,
    "op9_line_dedup": OP9_SQL,
    "op13_phrase_collocations": OP13_SQL,
}
