"""The corpus pipeline: rules, quality classifier, near-dedup, mixing, token ids.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the one
before it kept; :func:`run` writes each stage's rows as Parquet into the shared
folder and reads them back for the next.

In every stage ids may be null, repeated or of any type, texts and sources null,
texts empty or very long, rows repeated, and further columns of any name pass
through all stages but the last; an empty table gives an empty result.  Null and
empty texts have no words: the rules reject them, and a stage called on its
own keeps one of them as near-duplicates, takes none into the mix, and gives them no tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import bpe, mixing, quality, queries, rules, simhash
from ledgerlens.llm.common import prepare, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base check and every quality rule."""
    prepare(spark)
    return rules.passing(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    prepare(spark)
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    prepare(spark)
    return simhash.simhash_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often, and as far, as the mix takes them."""
    prepare(spark)
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and decoded documents."""
    prepare(spark)
    return queries.digests(docs.select("doc_id", "text"), bpe.lexicon_of(docs, queries.VOCABULARY))


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("token_ids", token_ids),
]

#: The classifier, the fingerprints' XXH64 and the token merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs
