"""Snapshots that tell what changed since the last one from digests, before any row is read.

Rows lie in folders by the hash of their key. Every slot of a hash has an order-free digest of its rows: how
many there are, and sums of two hashes of each. Digests of slots add up to those of a folder, and these to that
of the snapshot, so a comparison goes down from one row to the slots that differ, and reads these only.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagedoor.operators.relational import changed_rows
from stagedoor.session import settle

FOLDERS, SLOTS = 64, 64
_FOLDER, _SLOT = "_folder", "_slot"
_DIGEST = ["n", "one", "other"]
_LAYOUT = f"{_FOLDER} int, {_SLOT} int, n bigint, one decimal(38,0), other decimal(38,0)"


def _placed(df: DataFrame, key: list[str]) -> DataFrame:
    hashed = F.xxhash64(*(F.col(f"`{k}`") for k in key))
    slot = F.pmod(hashed, F.lit(FOLDERS * SLOTS)).cast("int")
    return df.select("*", F.floor(slot / SLOTS).cast("int").alias(_FOLDER), (slot % SLOTS).alias(_SLOT))


def _row_hash(df: DataFrame, seed: int) -> Column:
    # Null and its neighbours must not look alike, so whether a field is null is hashed too.
    parts = [x for c in df.columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return F.xxhash64(F.lit(seed), *parts).cast("decimal(20,0)")


def digests(df: DataFrame, key: list[str]) -> DataFrame:
    """(folder, slot, n, one, other) of every slot that has rows."""
    placed = _placed(df, key).select(_FOLDER, _SLOT, _row_hash(df, 1).alias("a"), _row_hash(df, 2).alias("b"))
    kind = "decimal(38,0)"
    return placed.groupBy(_FOLDER, _SLOT).agg(
        F.count("*").alias("n"), F.sum("a").cast(kind).alias("one"), F.sum("b").cast(kind).alias("other")
    )


def write_snapshot(df: DataFrame, key: list[str], path: str) -> None:
    """Rows by folder, and their digests, which are written last."""
    rows = _placed(df, key).hint("rebalance", F.col(_FOLDER))
    rows.write.mode("overwrite").partitionBy(_FOLDER).parquet(f"{path}/rows")
    digests(df, key).coalesce(1).write.mode("overwrite").parquet(f"{path}/digests")


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/rows").drop(_FOLDER, _SLOT)


def _stored_digests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_LAYOUT).parquet(f"{path}/digests")


def _differing(before: DataFrame, after: DataFrame, level: list[str]) -> DataFrame:
    """Keys of one level of the tree whose digests differ, those of one side only included."""
    signed = before.select(*level, *(-F.col(c).cast("decimal(38,0)") for c in _DIGEST)).toDF(*level, *_DIGEST)
    both = signed.union(after.select(*level, *(F.col(c).cast("decimal(38,0)") for c in _DIGEST)))
    sums = [F.sum(c).alias(c) for c in _DIGEST]
    return both.groupBy(*level).agg(*sums).filter(" OR ".join(f"{c} <> 0" for c in _DIGEST)).select(*level)


def differing_slots(spark: SparkSession, before: str, after: str) -> DataFrame:
    """(folder, slot) that differ between two snapshots; reads their digests only, from the root down."""
    one, other = _stored_digests(spark, before), _stored_digests(spark, after)
    folders = [r[0] for r in _differing(one, other, [_FOLDER]).collect()]  # FOLDERS rows at most
    inside = F.col(_FOLDER).isin(folders) if folders else F.lit(False)
    return _differing(one.filter(inside), other.filter(inside), [_FOLDER, _SLOT])


def changed_since(spark: SparkSession, before: str, after: str) -> DataFrame:
    """Rows whose number of copies differs between two snapshots, with that difference; only differing slots are read."""
    slots = settle(differing_slots(spark, before, after), "differing")
    folders = sorted(r[0] for r in slots.select(_FOLDER).distinct().collect())

    def rows(path: str) -> DataFrame:
        table = spark.read.parquet(f"{path}/rows")
        pruned = table.filter(F.col(_FOLDER).isin(folders) if folders else F.lit(False))
        return pruned.join(slots, [_FOLDER, _SLOT], "left_semi").drop(_FOLDER, _SLOT)

    return changed_rows(rows(before), rows(after))
