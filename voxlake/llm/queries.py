"""The registered queries of the operators, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.llm import ann, audit, bpe, hard_negatives, langid, lines, mixing, near_dups, rans, secret_scan, simhash, suffix_dedup, url_rules
from voxlake.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_line_spread(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = lines.dedup_lines(read_table(spark, folder, "documents"), removed_col="lines_removed")
    return cleaned.select("doc_id", "text", F.col("lines_removed").cast("long").alias("lines_removed"))


SQL["op1_line_spread"] = f"""
WITH rows AS (
  SELECT doc_id, source, string_split(text, chr(10)) AS parts FROM documents),
lines AS (
  SELECT doc_id, source, unnest(range(len(parts))) AS place, unnest(parts) AS raw FROM rows),
bare AS (SELECT *, trim(raw, ' ' || chr(9) || chr(13)) AS line FROM lines),
wide AS (
  SELECT line FROM bare WHERE line <> '' GROUP BY line
  HAVING count(DISTINCT coalesce('=' || source, '')) >= {lines.MIN_SITES}),
judged AS (
  SELECT b.*, w.line IS NOT NULL AND row_number() OVER (PARTITION BY b.line ORDER BY doc_id, place) > 1 AS gone
  FROM bare b LEFT JOIN wide w ON b.line = w.line),
kept AS (
  SELECT doc_id, string_agg(raw, chr(10) ORDER BY place) FILTER (WHERE NOT gone) AS text,
    count(*) FILTER (WHERE gone) AS lines_removed
  FROM judged GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
  coalesce(k.lines_removed, 0) AS lines_removed
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""


@query
def op2_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read_table(spark, folder, "embeddings")
    return ann.nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0))


SITES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


@query
def op3_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    pages = read_table(spark, folder, "pages").select("page_id", "url")
    mined = url_rules.mine(url_rules.labelled_urls(pages, read_table(spark, folder, "labels")))
    return url_rules.judge(pages, mined, SITES).select("page_id", "host", "path", "rule", "verdict", "mined")


@query
def op4_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


@query
def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.compare_with_edits(read_table(spark, folder, "documents"))


@query
def op6_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_dups.classes(read_table(spark, folder, "documents")).select("doc_id", "class_id")


@query
def op7_prefix_bpe(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents")
    path = public_tokenizers.path(bpe.VOCABULARY)
    return bpe.encode(documents, path, public_tokenizers.PATTERN, with_ids=False)


@query
def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents")
    return langid.identify(documents, langid.fit(documents))


@query
def op9_rans_files(spark: SparkSession, folder: str) -> DataFrame:
    return rans.written_and_read(read_table(spark, folder, "documents"), public_tokenizers.path(rans.VOCABULARY))


@query
def op10_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents")
    return secret_scan.scan(documents, secret_scan.fit(documents))


@query
def op11_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = suffix_dedup.without_repeats(read_table(spark, folder, "documents"))
    return cleaned.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


SQL["op11_suffix_dedup"] = f"""
WITH bytes AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
places AS (SELECT doc_id, h, unnest(range(n - {suffix_dedup.LENGTH - 1})) AS i FROM bytes WHERE n >= {suffix_dedup.LENGTH}),
windows AS (SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, {2 * suffix_dedup.LENGTH})) AS s FROM places),
repeats AS (
  SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1),
opens AS (
  SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + {suffix_dedup.LENGTH}, true) AS first FROM repeats),
numbered AS (SELECT doc_id, i, sum(first::INT) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM opens),
spans AS (
  SELECT doc_id, min(i) AS low, max(i) + {suffix_dedup.LENGTH} AS high FROM numbered GROUP BY doc_id, span),
cuts AS (
  SELECT doc_id, low, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS kept_from FROM spans
  UNION ALL SELECT b.doc_id, n, coalesce(max(high), 0) FROM bytes b LEFT JOIN spans s ON b.doc_id = s.doc_id GROUP BY b.doc_id, n),
kept AS (
  SELECT c.doc_id, string_agg(substr(h, 2 * kept_from + 1, 2 * (low - kept_from)), '' ORDER BY low) AS k
  FROM cuts c JOIN bytes b ON c.doc_id = b.doc_id GROUP BY c.doc_id),
removed AS (SELECT doc_id, sum(high - low) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT b.doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(k)) AS kept_sha256
FROM bytes b JOIN kept k ON b.doc_id = k.doc_id LEFT JOIN removed r ON b.doc_id = r.doc_id
"""


@query
def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit.interactions_of(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


SQL["op12_filter_audit"] = r"""
WITH bare AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body FROM documents),
counted AS (SELECT *, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS words FROM bare),
said AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
failed AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (CASE WHEN len(words) < 100 THEN 1 ELSE 0 END)
    | (CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END)
    | (CASE WHEN 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 10 * length(body) THEN 4 ELSE 0 END)
    | (CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 8 ELSE 0 END)
    | (CASE WHEN counted.doc_id > min(counted.doc_id) OVER (PARTITION BY body) THEN 16 ELSE 0 END) AS mask
  FROM counted LEFT JOIN said ON counted.doc_id = said.doc_id),
masks AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY part, mask),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS b),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE (a.b | b.b | c.b | d.b | e.b) = 31),
steps AS (
  SELECT filter_order, s AS step, bits[s] AS own, list_sum(bits[1:s]) - bits[s] AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS s)),
told AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN mask & (own::INT | before::INT) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & before::INT = 0 AND mask & own <> 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & before::INT <> 0 AND mask & own <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & before::INT = 0 AND mask & own <> 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & before::INT = 0 AND mask & own <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM masks, steps GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
  redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
  toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM told
"""


@query
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = read_table(spark, folder, "embeddings").withColumn("label", label)
    return hard_negatives.mine(vectors, vectors.where(F.col("vec_id") % 100 == 0))


SQL["op13_hard_negatives"] = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_inner_product(a.vec, b.vec)::BIGINT AS score
  FROM whole a, whole b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.other)::INT AS rank,
  n.other AS negative_id, positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON p.anchor_id = n.anchor_id AND NOT n.same
  AND 30 * positive_score <= 100 * n.score AND 100 * n.score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.other) <= 10
"""
