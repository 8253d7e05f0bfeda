"""From raw documents to packed training sequences.

Each stage works on all that its predecessor kept and takes effect: rejected
documents go, one document of each near-duplicate group stays, personal data is
masked, sources are repeated towards their target weights, and what is left is
packed.  Stages are written as Parquet under the cluster's shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fluvia.llm import common, jaccard, mixing, packing, pii, rules


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised rules keep."""
    common.small_reads(spark)
    return rules.kept_rows(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, 0.75)."""
    return jaccard.kept_rows(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data masked; ``n_chars`` follows where it changed the text."""
    return pii.redacted(docs, length="n_chars")


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by Poisson counts and shuffled."""
    number, key = common.free_names(docs, "copy", "shuffle_key")
    return mixing.mixed(docs, number=number, key=key).drop(number, key)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard", ngram_jaccard),
    ("pii", personal_data),
    ("mixing", source_mixing),
    ("packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Fitted stages (expectation-maximisation, hashing of shingles, token ids) have no SQL form.
ORACLE_SQL = None
