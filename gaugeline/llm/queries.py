"""The registered queries of the operators and the SQL that they are held against."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, embeddings, langid, mixing, neardup, packing, phrases, pii, quality, token_counts, token_files, topk, urls
from .common import bounded_sample, held_out, scratch_root

#: Labelled documents that the quality model is fitted on, at most.
FIT_ROWS = 4000
#: (verdict, host, path)
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").withColumn("held_out", held_out(F.col("doc_id")))
    labels = table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1))
    labels = labels.select("doc_id", F.col("quality").alias("label"), F.xxhash64("doc_id").alias("h"))
    # FIT_ROWS rows of two numbers, whatever the input
    chosen = F.broadcast(bounded_sample(labels, "h", FIT_ROWS))
    model = quality.fit(documents.join(chosen, "doc_id").select("text", "label"), max_rows=FIT_ROWS)
    return quality.score_quality(documents, model).select("doc_id", "held_out", "score", "predicted")


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").withColumn("held_out", held_out(F.col("doc_id")))
    model = langid.fit(documents.filter(~F.col("held_out")).select("text", "lang"))
    return langid.identify(documents, model).select("doc_id", "held_out", "lang_pred", "score")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"), RULES).select("page_id", "host", "path", "rule", "verdict")


def op6_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings")).select("vec_id", "n_links", "component_id", "kept")


def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(table(spark, sf_dir, "documents"), pii.fit())

    def joined(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    # the counts are of the base spans, like the digest; what the network adds is in ``spans``
    kinds = F.transform("base_spans", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(joined("base_spans"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op9_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path())
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_root(spark)}/token-files-{uuid.uuid4().hex}"
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path("word_bpe_49k.json"), end_id=2)
    return token_files.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"), digest=True)


QUERIES = {f.__name__: f for f in (op1_quality, op2_near_duplicates, op3_mix_sources, op4_language, op5_url_filter, op6_near_vectors, op7_pack, op8_personal_data, op9_top_products, op10_token_counts, op11_token_files, op12_phrases, op13_alignment)}

ORACLE_SQL = {
    "op3_mix_sources": r"""
WITH d AS (
  SELECT doc_id, source, COALESCE(LEN(REGEXP_EXTRACT_ALL(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || SUBSTR(MD5(COALESCE(doc_id::VARCHAR, '') || ':' || COALESCE(text, '')), 1, 15))::BIGINT AS h
  FROM documents),
s AS (SELECT source, SUM(size)::DOUBLE AS n FROM d GROUP BY source),
w AS (
  SELECT *, 2 * n AS most, CASE (ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight
  FROM s),
r AS (
  SELECT *, SUM(n) OVER () * 1.5::DOUBLE AS total,
         SUM(most) OVER upto - most AS below, SUM(weight) OVER () - SUM(weight) OVER upto + weight AS rest
  FROM w WINDOW upto AS (ORDER BY most / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
k AS (SELECT *, (total - below) * weight >= most * rest AS capped FROM r),
t AS (
  SELECT source, n, CASE WHEN capped THEN most ELSE LEAST((total - COALESCE(SUM(most) FILTER (capped) OVER (), 0)) * weight / SUM(weight) FILTER (NOT capped) OVER (), most) END AS target
  FROM k),
b AS (SELECT *, CASE WHEN n > 0 THEN FLOOR(target / n)::BIGINT ELSE 0 END AS base FROM t),
g AS (
  SELECT d.*, n, target, base, target - base * n AS budget,
         COALESCE(SUM(size) OVER (PARTITION BY d.source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS upto,
         SUM(size) OVER (PARTITION BY d.source, h) AS tied, COUNT(*) OVER (PARTITION BY d.source, h) AS ties
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source),
p AS (
  SELECT *, CASE WHEN upto <= budget THEN 1.0::DOUBLE WHEN upto - tied > budget OR tied = 0 THEN 0.0::DOUBLE
    WHEN ties = 1 THEN FLOOR((budget - (upto - tied)) / tied + 0.5) ELSE (budget - (upto - tied)) / tied END AS part
  FROM g)
SELECT doc_id, size, n::BIGINT AS source_size, target, (base * size + FLOOR(size * part + 0.5))::BIGINT AS taken FROM p
""",
    "op12_phrases": r"""
WITH pieces AS (
  SELECT lang, REGEXP_EXTRACT_ALL(piece, '[^\x20\x09]+') AS ws
  FROM (SELECT COALESCE(lang, 'und') AS lang, UNNEST(REGEXP_SPLIT_TO_ARRAY(TRANSLATE(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
grams AS (
  SELECT lang, m, UNNEST([ARRAY_TO_STRING(ws[i:i + m - 1], ' ') FOR i IN RANGE(1, LEN(ws) - m + 2)]) AS phrase
  FROM pieces, (SELECT UNNEST(RANGE(1, 6)) AS m) WHERE LEN(ws) >= m),
f AS (SELECT lang, m, phrase, COUNT(*) AS c FROM grams GROUP BY lang, m, phrase),
total AS (SELECT lang, SUM(c)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
cand AS (SELECT lang, m, phrase, c AS a, STRING_SPLIT(phrase, ' ') AS ws FROM f WHERE m > 1 AND c >= 100),
cuts AS (SELECT *, UNNEST(RANGE(1, m)) AS k FROM cand),
scored AS (
  SELECT x.lang, x.m, x.phrase, x.a, x.k, p.c AS l, q.c AS r, n, ((1000::HUGEINT * x.a * n) // (p.c::HUGEINT * q.c))::BIGINT AS score
  FROM cuts x JOIN total USING (lang)
    JOIN f p ON p.lang = x.lang AND p.phrase = ARRAY_TO_STRING(x.ws[1:x.k], ' ')
    JOIN f q ON q.lang = x.lang AND q.phrase = ARRAY_TO_STRING(x.ws[x.k + 1:x.m], ' ')),
least AS (SELECT * FROM scored QUALIFY ROW_NUMBER() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_parts AS (
  SELECT lang, UNNEST([ARRAY_TO_STRING(ws[i:i + s - 1], ' ') FOR i IN RANGE(1, m - s + 2)]) AS phrase, a AS longer
  FROM cand, (SELECT UNNEST(RANGE(2, 5)) AS s) WHERE s < m),
kept AS (SELECT * FROM least x WHERE NOT EXISTS (SELECT 1 FROM inner_parts i WHERE i.lang = x.lang AND i.phrase = x.phrase AND 100 * i.longer >= 100 * x.a))
SELECT lang, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, ENCODE(phrase)) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000
""",
}
