"""What several corpus operators share."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagedoor.session import settle

# ASCII white space, as the contracts of the operators define words.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
WORD_CLASS = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is.

    ``lower`` does just that for texts of ASCII characters only, and is the faster of the two.
    """
    upper, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, upper, small)
    )


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as make it no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


# Bits in a bitmap of Spark's bitmap functions; fixed value.
BITMAP_BITS = 32768


def filter_bits(rows: int, bits_per_row: int, max_bits: int) -> int:
    """A power of two of at least ``bits_per_row`` bits a row, between one bitmap and ``max_bits``."""
    bits = BITMAP_BITS
    while bits < rows * bits_per_row and bits * 2 <= max_bits:
        bits *= 2
    return bits


def bit_table(cells: DataFrame, cell: str) -> DataFrame:
    """(bucket, bitmap) of the cells that ``cells`` names: a bit set in rows of 4 KiB."""
    return cells.groupBy((F.col(cell) / BITMAP_BITS).cast("bigint").alias("bucket")).agg(
        F.bitmap_construct_agg(F.col(cell) % BITMAP_BITS).alias("bitmap")
    )


def _is_set(bitmap: Column, cell: Column) -> Column:
    bit = (cell % BITMAP_BITS).cast("int")
    byte = F.conv(F.hex(F.substring(bitmap, F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10)
    return F.coalesce(F.getbit(byte.cast("bigint"), bit % 8) == 1, F.lit(False))


def with_bits(rows: DataFrame, table: DataFrame, cells: list[Column], name: str) -> DataFrame:
    """``rows`` with a column ``name``: whether all ``cells`` are set in a :func:`bit_table`.

    The table is broadcast; it has at most an eighth of a byte for each cell number there can be.
    """
    out = rows.withColumn(name, F.lit(True))
    for i, cell in enumerate(cells):
        bucket, bits = unused(rows, f"_bucket{i}"), unused(rows, f"_bits{i}")
        side = table.select(F.col("bucket").alias(bucket), F.col("bitmap").alias(bits))
        hit = (cell / BITMAP_BITS).cast("bigint") == F.col(bucket)
        out = out.join(F.broadcast(side), hit, "left").withColumn(
            name, F.col(name) & _is_set(F.col(bits), cell)
        )
    return out.select(*(f"`{c}`" for c in rows.columns), name)


# Bits of the table that says which rows may be dropped; 32 MiB are broadcast at most.
MAX_BITS = 1 << 28


def keys_of(doc_id: Column, text: Column) -> list[Column]:
    """Two hashes that stand for a document: of its id, as text, and of its text. Nulls have hashes too."""
    return [F.xxhash64(doc_id.cast("string")).alias("_id"), F.xxhash64(text).alias("_text")]


def without(docs: DataFrame, dropped: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The rows of ``docs`` whose keys are not in ``dropped``, which has the columns of :func:`keys_of`.

    A bit table of the keys lets most other rows pass where they are; those that may be named, and
    only those, are shuffled to find out.
    """
    gone = settle(dropped.select("_id", "_text").distinct(), "dropped")
    bits = filter_bits(gone.count(), 16, MAX_BITS)

    def cell(one: str, other: str) -> Column:
        return F.pmod(F.col(one).bitwiseXOR(F.col(other)), F.lit(bits))

    table = settle(bit_table(gone.select(cell("_id", "_text").alias("cell")), "cell"), "dropped-bits")
    names = [unused(docs, "_id"), unused(docs, "_text")]
    maybe = unused(docs, "_maybe")
    keys = [k.alias(n) for k, n in zip(keys_of(F.col(doc_id), F.col(text)), names, strict=True)]
    tested = with_bits(docs.select("*", *keys), table, [cell(*names)], maybe)
    columns = [f"`{c}`" for c in docs.columns]
    passed = tested.filter(~F.col(maybe)).select(*columns)
    gone = gone.toDF(*names)
    return passed.union(tested.filter(maybe).join(gone, names, "left_anti").select(*columns))


def _minimum_of_neighbours(links: DataFrame) -> DataFrame:
    """Written, so that the join with it shuffles both sides and a hot node's part can be split."""
    return settle(links.groupBy("a").agg(F.min("b").alias("low")), "low")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are linked to the least of its neighbourhood."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = _minimum_of_neighbours(both).select("a", F.least("a", "low").alias("low"))
    return (
        both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = _minimum_of_neighbours(down)
    moved = down.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(low.select("a", F.col("low").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of every connected component, for nodes with an edge.

    ``edges`` has two columns of one integer type; direction, loops and repeats don't matter, rows
    with a null are ignored. Large-star and small-star steps alternate until nothing changes, each
    round a written table, so rounds grow with the logarithm of a component's width and no lineage
    builds up. Minima are combined before they are shuffled, and a node with very many edges is a
    skewed join key that adaptive execution splits.
    """
    a, b = edges.columns
    links = settle(
        edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a != b").distinct(), "links"
    )
    seen = None
    while True:
        state = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen:
            break
        seen = state
        links = settle(
            _small_star(_large_star(links)).filter("a != b").distinct(), "links"
        )
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
