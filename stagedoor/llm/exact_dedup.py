"""Exact duplicates behind a two-pass Bloom filter, in DataFrame functions only.

First pass: every text's digest sets ``hashes`` cells of a bit table, and a cell is kept if two
rows or more set it. Second pass: a row whose cells are all kept may have a twin; only such rows are
grouped by digest. Any other row is certainly unique and goes straight to the result.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagedoor.llm.common import SPACE_CLASS, bit_table, filter_bits, with_bits
from stagedoor.session import settle

def normalised(text: Column) -> Column:
    """White space runs as one space, null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_CLASS, " ")


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, sha): SHA-256 of the normalised text, as 32 bytes."""
    sha = F.unhex(F.sha2(normalised(F.col(text)).cast("binary"), 256))
    return docs.select(F.col(doc_id).alias("doc_id"), sha.alias("sha"))


def _cells(sha: Column, hashes: int, bits: int) -> list[Column]:
    """``hashes`` cell numbers from disjoint parts of the digest."""
    part = [F.conv(F.hex(F.substring(sha, 1 + 7 * i, 7)), 16, 10) for i in range(hashes)]
    return [F.pmod(p.cast("bigint"), F.lit(bits)) for p in part]


def repeated_cells(keys: DataFrame, hashes: int, bits: int) -> DataFrame:
    """(bucket, bitmap) of the cells that two rows or more have set.

    Cells are counted before they are shuffled, so a text with very many copies is a few rows.
    """
    cell = F.explode(F.array_distinct(F.array(*_cells(F.col("sha"), hashes, bits)))).alias("cell")
    twice = keys.select(cell).groupBy("cell").count().filter("count > 1")
    return bit_table(twice, "cell")


def exact_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    *,
    hashes: int = 3,
    bits_per_row: int = 16,
    max_bits: int = 1 << 28,
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of ``docs``.

    Of rows with equal normalised text the one with the smallest doc_id stays.

    - Null texts are empty texts, and equal to each other and to empty ones.
    - A null doc_id stays only if its whole group has no other id; then keep_id is null.
    - Rows that repeat a doc_id and its text count in group_size and are marked alike.
    - An empty table gives an empty result; columns other than the two named are not read.

    ``max_bits`` (32 MiB by default) bounds what is broadcast. Beyond some 17 million rows a filter
    of that size lets more unique rows through to the grouping; results don't change.
    """
    keys = settle(digests(docs, doc_id, text), "digests")
    bits = filter_bits(keys.count(), bits_per_row, max_bits)
    cells = settle(repeated_cells(keys, hashes, bits), "cells")
    # False only for a digest that no other row has. What is broadcast has ``bits`` / 8 bytes at most.
    tested = with_bits(keys, cells, _cells(F.col("sha"), hashes, bits), "maybe")
    alone = tested.filter("not maybe").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("n"), "sha"
    )
    some = tested.filter("maybe").select("doc_id", "sha")
    # Written before it is joined, so that both sides are shuffled and a hot text's part can be split.
    groups = settle(
        some.groupBy("sha").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("n")), "groups"
    )
    grouped = some.join(groups, "sha").select("doc_id", "keep_id", "n", "sha")
    return alone.union(grouped).select(
        "doc_id",
        "keep_id",
        F.col("n").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
