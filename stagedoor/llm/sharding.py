"""Shards by a lookup table that the shards have filled in turns.

Every shard has its own permutation of a prime number of slots, given by an offset and a step. Shards
take turns claiming the next slot of their permutation that is still free, until none is. A document's
key names a slot, the table the shard: one lookup, whatever the number of shards, and hardly any
document moves when a shard comes or goes.
"""

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagedoor.llm.common import unused

# A prime, and much larger than the number of shards: shares differ by about shards / slots.
SLOTS = 65537


def _is_prime(n: int) -> bool:
    return n > 2 and n % 2 == 1 and all(n % d for d in range(3, int(n**0.5) + 1, 2))


def fill(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The index of the shard that owns each slot."""
    if not shards or len(set(shards)) < len(shards) or len(shards) > slots:
        raise ValueError("shards need distinct names, at least one and no more than slots")
    if not _is_prime(slots):
        raise ValueError("the number of slots must be an odd prime")
    at = [xxhash.xxh64_intdigest(s, seed=1) % slots for s in shards]
    step = [xxhash.xxh64_intdigest(s, seed=2) % (slots - 1) + 1 for s in shards]
    table, free = [-1] * slots, slots
    while free:
        for i in range(len(shards)):
            while table[at[i]] >= 0:
                at[i] = (at[i] + step[i]) % slots
            table[at[i]] = i
            free -= 1
            if not free:
                break
    return table


def lookup_table(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    rows = [(slot, shards[i]) for slot, i in enumerate(fill(shards, slots))]
    return spark.createDataFrame(rows, "slot int, shard string")


def slot_of(key: Column, text: Column, slots: int = SLOTS) -> Column:
    """The slot of a key; rows without a key spread by their text."""
    by_key = F.xxhash64(key.cast("string"))
    return F.pmod(F.when(key.isNull(), F.xxhash64(text)).otherwise(by_key), F.lit(slots)).cast("int")


def shard_documents(
    docs: DataFrame,
    shards: list[str],
    key: str = "doc_id",
    text: str = "text",
    *,
    slots: int = SLOTS,
) -> DataFrame:
    """(key, slot, shard), one row per row of ``docs``.

    - The slot is the key's XXH64 (as text) modulo ``slots``; a null key takes its text's hash, and a
      row without either one fixed slot.
    - Rows with one key share a shard; texts, empty or very long, don't matter otherwise.
    - An empty table gives an empty result; columns other than the two named are not read.

    The table has ``slots`` rows, set by a parameter and not by the data, so it is broadcast: nothing
    is shuffled, and no key can be hot.
    """
    placed = docs.select(
        F.col(key).alias("doc_id"), slot_of(F.col(key), F.col(text), slots).alias("slot")
    )
    table = lookup_table(docs.sparkSession, shards, slots)
    return placed.join(F.broadcast(table), "slot").select("doc_id", "slot", "shard")


def write_shards(
    docs: DataFrame,
    shards: list[str],
    path: str,
    key: str = "doc_id",
    text: str = "text",
    *,
    slots: int = SLOTS,
) -> None:
    """Whole rows of ``docs`` as Parquet, in a folder ``shard=<name>`` for each shard that has rows.

    The folder column replaces a column ``shard`` of ``docs``. Rows are dealt to a shard's folder by the
    tasks that read them, so a large shard is written by many tasks.
    """
    at, slot, shard = (unused(docs, n) for n in ("_at", "_slot", "_shard"))
    table = lookup_table(docs.sparkSession, shards, slots).toDF(slot, shard)
    rows = docs.withColumn(at, slot_of(F.col(key), F.col(text), slots))
    rows = rows.join(F.broadcast(table), F.col(at) == F.col(slot))
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "shard"]
    rows.select(*rest, F.col(shard).alias("shard")).write.partitionBy("shard").parquet(path)
