import os

import pytest

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def folder():
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables here")
    return FOLDER


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture
def docs(spark):
    """Hand-made documents: rows of (doc_id, text, lang, source)."""

    def make(*rows):
        rows = [(*r, *("en", "src0")[len(r) - 2 :]) for r in rows]
        return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")

    return make


# Columns that documents may carry and operators make too.
CLASHING = [
    "row", "fp", "text_key", "fingerprint", "component_id", "sha", "keep_id", "maybe", "words", "hash", "slot", "shard",
    "size", "spread", "target", "copies", "_id", "_text", "_maybe", "trusted", "gram", "id", "n", "value", "bucket",
]


@pytest.fixture
def with_clashes():
    from pyspark.sql import functions as F

    return lambda df: df.select("*", *(F.lit("x").alias(c) for c in CLASHING))
