"""From raw documents to packed training batches, in five stages.

A stage takes a session, the documents that its predecessor kept, and the folder of tables; it returns the documents
that it keeps, the last one the packed matrices. Stages are written and read again in between.

All stages but the last return the columns of their documents, also where these have names that operators use; null
ids and texts, empty and very long texts and repeated rows are rows like any others, and an empty table gives an empty
result. What each stage does with them is said below.
"""

from pyspark.sql import DataFrame, SparkSession

from stagedoor.llm import decontaminate, mixing, packing, quality, simhash
from stagedoor.llm.common import table
from stagedoor.session import settle

SHINGLE_WORDS = 3


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is within their language's limit.

    Texts that are null or have nothing to score, and those of a null language or one without a limit, stay. Without
    labels everything stays. Equal rows share their fate.
    """
    return quality.accepted(docs, quality.trusted_ids(table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates.

    Equal rows are near duplicates of each other, and so are all texts without a word, null ones included.
    """
    return simhash.one_of_each(docs, shingle=SHINGLE_WORDS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark passages do not contaminate.

    Null and empty texts stay, and everything does if the benchmark is empty. Items without an id count.
    """
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them, none more than twice.

    Null is a source. Documents without words are taken once unless their source takes nothing or all twice.
    """
    return mixing.mixed_documents(docs)


def token_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Matrices of token ids.

    Null and empty texts are an end mark, a null id stays null. No documents give no matrices.
    """
    return packing.packed(docs, packing.public_vocabulary())


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing to target weights", source_mixing),
    ("token-ID output", token_packing),
]

# Perplexities, fingerprints, rounding and tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed matrices of the folder's documents; every stage is written below the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = settle(stage(spark, docs, sf_dir), f"stage{i}")
    return docs
