"""Near duplicates by SimHash fingerprints that differ in two bits at most.

Fingerprints are 64 bits over hashed word shingles. To find those within two bits, a fingerprint is cut
into two segments: of two differing bits one segment holds at most one. Every segment is indexed under
its 32 one-wildcard variants (the segment with one bit blanked, and which), so two fingerprints within
two bits meet under an equal variant, and what meets is verified.

A variant that only two fingerprints share is that pair. A variant that more share is refined instead of
being expanded into pairs: its fingerprints are indexed again by their own 65 neighbours, the values
within one bit. Two values within two bits have a neighbour in common, and two values with a common neighbour
are within two bits, so linking all of a neighbour's owners to the least of them keeps the
links of the whole group, in rows that grow with its members and not with their square.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from stagedoor.llm.common import MAX_BITS as MAX_FILTER_BITS
from stagedoor.llm.common import bit_table, components, filter_bits, keys_of, unused, with_bits, without
from stagedoor.session import settle

BITS = 64
MAX_BITS = 2
HASH_SEED = 42
# Shingles whose bits are unpacked at once; bounds memory for very long texts.
CHUNK = 1 << 15
# Fingerprints whose variants one task makes, about.
TASK_FINGERPRINTS = 25_000


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The fingerprint of a UTF-8 text as a signed 64-bit number.

    Words are runs without ASCII white space, A-Z in lower case. Fewer words than a shingle are
    one shingle, no words (or null) the fingerprint zero. A bit is set if over half the hashes set it.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    plain = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, CHUNK):
        spans = zip(starts[at : min(n, at + CHUNK)].tolist(), last[at : at + CHUNK].tolist(), strict=True)
        hashes = np.array([xxh64_intdigest(plain[a:b], HASH_SEED) for a, b in spans], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    """(doc_id, text_key, fp), one row per row of ``docs``; ``text_key`` is a hash of the text."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            fps = [fingerprint(t.as_py(), shingle) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fps, pa.int64())],
                names=["doc_id", "text_key", "fp"],
            )

    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.xxhash64(text).alias("text_key"),
        F.col(text).cast("binary").alias("text"),
    )
    return rows.mapInArrow(batches, "doc_id long, text_key long, fp long")


def _power(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)


def variants(fps: DataFrame) -> DataFrame:
    """(variant, fp): 64 rows a fingerprint, the blanked bit's number above the rest of its segment."""
    bit = F.col("bit")
    half = F.shiftrightunsigned(F.col("fp"), 32)
    segment = F.when(bit < 32, F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))).otherwise(half)
    blank = F.bitwise_not(_power(F.pmod(bit, F.lit(32))))
    numbered = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))).alias("bit"))
    key = segment.bitwiseAND(blank).bitwiseOR(F.shiftleft(bit.cast("bigint"), 32))
    return numbered.select(key.alias("variant"), "fp")


def _apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _neighbours(fps: DataFrame) -> DataFrame:
    """(at, fp): a fingerprint under each value within one bit of it."""
    flips = F.concat(
        F.array(F.lit(0).cast("bigint")),
        F.transform(
            F.sequence(F.lit(0), F.lit(BITS - 1)), _power
        ),
    )
    return fps.select("fp", F.explode(flips).alias("flip")).select(
        F.col("fp").bitwiseXOR(F.col("flip")).alias("at"), "fp"
    )


def _members_of(index: DataFrame, crowds: DataFrame) -> DataFrame:
    """Fingerprints under the variants in ``crowds``; a bounded bit table keeps most others out of the shuffle."""
    bits = filter_bits(crowds.count(), 16, MAX_FILTER_BITS)
    cell = F.pmod(F.xxhash64("variant"), F.lit(bits))
    table = settle(bit_table(crowds.select(cell.alias("cell")), "cell"), "crowd-bits")
    some = with_bits(index, table, [cell], "_maybe").filter("_maybe").drop("_maybe")
    return settle(some.join(crowds, "variant", "left_semi").select("fp").distinct(), "members")


def links(fps: DataFrame) -> DataFrame:
    """(a, b): verified links between distinct fingerprints, enough to connect all within two bits."""
    # A fingerprint becomes 64 rows: dealt out first, so that no task makes more than some millions.
    index = variants(fps.repartition(1 + fps.count() // TASK_FINGERPRINTS, "fp"))
    shared = settle(
        index.groupBy("variant")
        .agg(F.min("fp").alias("a"), F.max("fp").alias("b"), F.count("*").alias("n"))
        .filter("n > 1"),
        "variants",
    )
    pairs = shared.filter("n = 2").select("a", "b")
    crowds = shared.filter("n > 2").select("variant")
    members = _members_of(index, crowds)
    near = _neighbours(members)
    least = near.groupBy("at").agg(F.min("fp").alias("a"), F.count("*").alias("n")).filter("n > 1")
    stars = near.join(least, "at").select("a", F.col("fp").alias("b"))
    found = pairs.union(stars).filter(F.col("a") != F.col("b")).filter(_apart("a", "b") <= MAX_BITS)
    return found.distinct()


def _members(docs: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    """(doc_id, text_key, fp, root, component_id), one row per row of ``docs``; ``root`` names the component."""
    rows = settle(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    fps = settle(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = components(links(fps.select("fp")))
    rooted = fps.join(roots, fps["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = settle(rooted, "rooted")
    # Written before it is joined, so that a hot component's part of the join can be split.
    ids = settle(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "ids")
    labels = settle(rooted.join(ids, "root").select("fp", "root", "component_id"), "labels")
    return rows.join(labels, "fp")


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    *,
    shingle: int = 3,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs``.

    ``fingerprint`` is 16 lower-case hex digits; ``component_id`` the smallest doc_id that can be reached by
    links, the row's own included.

    - Null, empty and blank texts have fingerprint zero and are linked like any other.
    - A null doc_id takes part in links and never is a component_id, unless no other id is there: then null.
    - Rows that repeat an id or a text are each returned.
    - An empty table gives an empty result; columns other than the two named are not read.

    Copies meet as one fingerprint before anything is indexed. ``max_bits`` other than two would need
    another number of segments and is refused.
    """
    if max_bits != MAX_BITS or shingle < 1:
        raise ValueError(f"the index is built for {MAX_BITS} bits and shingles of a word or more")
    return _members(docs, doc_id, text, shingle).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, shingle: int = 3) -> DataFrame:
    """The document with the smallest id of each component, with the columns of ``docs``.

    Of rows that share that id, or of a component without ids, the one with the least hash of its text stays;
    of equal rows one stays.
    """
    members = settle(_members(docs, doc_id, text, shingle), "members")
    first = members.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    stays = settle(
        first.groupBy("root").agg(F.min("text_key").alias("stays"), F.count("*").alias("n")), "stays"
    )
    id_key = F.xxhash64(F.col("doc_id").cast("string")).alias("_id")
    decided = members.join(stays, "root").withColumn(
        "stay", F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_key") == F.col("stays"))
    )
    gone = decided.filter("not stay").select(id_key, F.col("text_key").alias("_text"))
    # Rows that may be equal are taken out too, and one of each put back.
    repeated = settle(
        decided.filter("stay and n > 1").select(id_key, F.col("text_key").alias("_text")).distinct(), "repeated"
    )
    kept = without(docs, gone.union(repeated), doc_id, text)
    if repeated.isEmpty():
        return kept
    names = [unused(docs, "_id"), unused(docs, "_text")]
    keys = [k.alias(n) for k, n in zip(keys_of(F.col(doc_id), F.col(text)), names, strict=True)]
    again = docs.select("*", *keys).join(repeated.toDF(*names), names, "left_semi")
    return kept.union(again.dropDuplicates(names).select(*(f"`{c}`" for c in docs.columns)))
