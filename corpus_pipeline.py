"""Corpus pipeline: documents to training tokens in five stages.

1. ``quality``     documents that the quality classifier rejects go;
2. ``line_dedup``  recurring lines go from all but their first document, and
                   documents that lose all their words go;
3. ``near_dedup``  one document of each group of near duplicates stays;
4. ``mixing``      documents are repeated or left out by the rates that bring
                   the domains to their target shares;
5. ``bpe``         the texts become token ids, checked by decoding them.

Each function takes (spark, docs, sf_dir) and works on all rows of ``docs``.
Stages 1 to 4 return the columns of ``docs``; ``n_chars`` follows the text.
Null texts count as empty, and empty tables pass through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promo_engine.llm import bpe, common, line_templates, mixing, ngram_join, quality
from promo_engine.llm.queries import RANKS
from promo_engine.sources.tables import read_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.ship_package(spark)
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_templates.strip_recurring(docs, rule=line_templates.every_recurring_line)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(
        F.length("text").cast(docs.schema["n_chars"].dataType)))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.ship_package(spark)
    return ngram_join.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.ship_package(spark)
    return mixing.mixed(docs, read_table(spark, sf_dir, "labels"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, ids_sha256, decoded_sha256`` of every row."""
    common.ship_package(spark)
    return bpe.encode_digest(docs, RANKS, public_tokenizers.PATTERN, with_ids=True)


STAGES = [("quality", quality_stage), ("line_dedup", line_stage), ("near_dedup", near_stage),
          ("mixing", mixing_stage), ("bpe", bpe_stage)]

#: A classifier, a fitted mix and a tokenizer are not expressible in SQL; the tests hold the stages
#: against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written before the next one reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.cut_lineage(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
