"""The corpus pipeline: quality, near duplicates, benchmark passages, mixture, token files.

Each stage takes the documents its predecessor kept and returns documents, but for the
last, which returns the token files' digest.  ``run`` writes every stage's result under
``spark.checkpoint.dir`` and reads it back for the next, so a lost executor repeats at
most one stage's tasks.  Tables that later stages do not read are deleted as soon as the
result made from them is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txstream.llm import chosen_path, decontaminate, mixing, quality, token_files
from txstream.llm.queries import END_ID, table, tokenizer_path
from txstream.session import materialize, scratch_path, settled, temporary_tables  # noqa: F401


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier keeps."""
    return quality.filter_quality(docs, table(spark, sf_dir, "labels"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate group."""
    return chosen_path.keep_one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    return mixing.mix(docs)


def token_id_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Huffman-coded token files of the mixture; their digest, read back."""
    folder = scratch_path(spark, "pipeline-token-files")
    token_files.write_token_files(docs, folder, tokenizer_path(), END_ID)
    return token_files.read_token_files(spark, folder)


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", mixing_sources),
    ("token-ID / binary output", token_id_output),
]

# The classifier is trained and the ids come from a tokenizer: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    def result(i: int) -> DataFrame:
        docs = settled(spark, lambda: result(i - 1), f"pipeline-{i - 1}") if i else table(spark, sf_dir, "documents")
        return STAGES[i][1](spark, docs, sf_dir)

    with temporary_tables(spark):      # the last stage's result reads its token files only
        return result(len(STAGES) - 1)
