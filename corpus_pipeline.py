"""Corpus pipeline: language, near-duplicates, personal data, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.llm import langid, mixing, neardup, packing, pii
from gaugeline.llm.common import columns_of, free_name, held_out, materialize
from gaugeline.llm.queries import tokenizer_path

#: A document is rejected where no language reaches this probability, or where it has no letters.
LEAST_LANGUAGE_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose language is told with a probability of LEAST_LANGUAGE_SCORE or more.

    The network learns from the rows with a language whose id isn't held out. A null
    ``lang`` of a kept document becomes the predicted language.
    """
    model = langid.fit(docs.filter(~held_out(F.col("doc_id"))).select("text", "lang"))
    lang, score = free_name(docs, "told_lang"), free_name(docs, "told_score")
    told = langid.identify(docs, model, lang_col=lang, score_col=score)
    kept = told.filter((F.col(lang) != langid.UND) & (F.col(score) >= LEAST_LANGUAGE_SCORE))
    return kept.withColumn("lang", F.coalesce("lang", lang)).select(*columns_of(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    own, kept = free_name(docs, "near_class"), free_name(docs, "near_kept")
    return neardup.near_duplicates(docs, keep_columns=True, class_col=own, kept_col=kept).filter(F.col(kept)).select(*columns_of(docs))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts by the name of its kind; ``n_chars`` follows."""
    base, spans = free_name(docs, "base_spans"), free_name(docs, "spans")
    clean = pii.redact(pii.find_spans(docs, pii.fit(), base_col=base, spans_col=spans), spans_col=spans)
    n_chars = F.when(F.size(spans) > 0, F.length("text")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType)).select(*columns_of(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat each document as often as the mix takes it; documents that it doesn't take go."""
    return mixing.mixed_rows(docs).select(*columns_of(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents into sequences of 2048 tokens: one row per piece with its ids."""
    return packing.pack(docs, tokenizer_path())


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mixture", mixture), ("packing", packed)]

#: SQL cannot express the network stages; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialize(docs, f"stage-{name}")
    return docs
