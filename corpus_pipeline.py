"""Training-corpus pipeline: quality, near-duplicates, benchmark leaks, personal data, segmentation.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` and calls one operator of ``candlewick.llm``; all but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from candlewick.llm import decontaminate, gumbel_segmentation, pii_bootstrap, quality_rules, simhash_bktree
from candlewick.llm.common import prepare, read_table, staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, fitted on this stage's own documents, does not reject."""
    model = quality_rules.fit(docs, read_table(prepare(spark), sf_dir, "labels"))
    return quality_rules.keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (4-word shingles, 4 bits)."""
    prepare(spark)
    return simhash_bktree.drop_near_duplicates(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, copied or edited."""
    return decontaminate.drop_contaminated(docs, read_table(prepare(spark), sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind in brackets, n_chars renewed."""
    prepare(spark)
    return pii_bootstrap.redact(docs)


def segmentation(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with two sampled segmentations each and whether both decode to the text."""
    prepare(spark)
    return gumbel_segmentation.sample_segmentations(docs)


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_leaks),
    ("PII", personal_data),
    ("SentencePiece encoding and decoding", segmentation),
]

#: Fitted models, components and alignments have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written as Parquet and read by the next."""
    docs = read_table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.split(" ")[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
