"""A Merkle manifest of a dataset: one tree a source, and one over the sources.

Every node carries the half-open interval of leaf ranks that it covers, so intervals of a tree nest. A node
of level l begins at a multiple of ``fanout ** l``, which is its bucket: nodes meet their parent by an
equality join on tree and bucket one level up, with interval containment as the further condition. A parent has at
most ``fanout`` children there, however large its tree is. Within a parent, the children whose intervals
end at or before a node's, or begin at or after it, are its siblings to the left and to the right; they are
what a proof lists. Trees grow upwards, one written table a level; paths of siblings are handed down again.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagedoor.llm.common import lower_ascii
from stagedoor.operators.numbering import numbered
from stagedoor.session import settle

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# One row in so many is tampered with when a manifest is tried out.
TAMPERED_ONE_IN = 5

_STEP = "array<struct<left: string, right: string>>"


def field(value: Column) -> Column:
    """A value as it enters a hash: ``-`` if null, else its bytes in UTF-8, a colon, and itself."""
    written = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(written).cast("string"), F.lit(":"), written), F.lit("-"))


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of ``parts`` in a row."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_of(*values: Column) -> Column:
    return digest(*map(field, values))


def parents(nodes: DataFrame, level: int, fanout: int = FANOUT) -> DataFrame:
    """The nodes above ``nodes``, with their children: (tree, height, lo, hi, digest, children).

    ``nodes`` are those of one level in every tree whose height is beyond it. A parent's bucket is its
    interval's beginning divided by ``fanout ** level``.
    """
    bucket = F.floor(F.col("lo") / fanout**level).cast("bigint")
    child = F.struct("lo", "hi", "digest")
    grouped = nodes.groupBy("tree", "height", bucket.alias("bucket")).agg(
        F.array_sort(F.collect_list(child)).alias("children")
    )
    return grouped.select(
        "tree", "height", "bucket",
        F.element_at("children", 1)["lo"].alias("lo"),
        F.element_at("children", -1)["hi"].alias("hi"),
        F.sha2(F.array_join(F.transform("children", lambda c: c["digest"]), "").cast("binary"), 256).alias("digest"),
        "children",
    )


def siblings(children: Column, lo: Column, hi: Column) -> Column:
    """Digests left and right of the child [lo, hi) within its parent: the parent's interval less its own."""

    def joined(keep):
        return F.array_join(F.transform(F.filter(children, keep), lambda c: c["digest"]), "")

    return F.struct(
        joined(lambda c: c["hi"] <= lo).alias("left"), joined(lambda c: c["lo"] >= hi).alias("right")
    )


def with_heights(leaves: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """(tree, size, height): how many leaves a tree has, and how many levels above them."""
    sizes = leaves.groupBy("tree").agg(F.count("*").alias("size"))
    # The least height whose power of the fanout covers the size; whole numbers only.
    powers = F.array(*(F.lit(fanout**h).cast("decimal(38,0)") for h in range(64) if fanout**h < 1 << 63))
    return sizes.withColumn("height", F.size(F.filter(powers, lambda p: p < F.col("size"))))


def grow(leaves: DataFrame, fanout: int = FANOUT) -> tuple[list[DataFrame], DataFrame]:
    """Trees over ``leaves`` (tree, rank, digest): tables of the levels from 1 up, and (tree, size, height, top).

    ``leaves`` is read several times. Each level has one row for ``fanout`` rows below.
    """
    heights = settle(with_heights(leaves, fanout), "heights")
    tallest = heights.agg(F.max("height")).first()[0] or 0
    same = F.col("l.tree").eqNullSafe(F.col("h.tree"))
    placed = leaves.alias("l").join(heights.alias("h"), same).select(
        "l.tree", "h.height", F.col("l.rank").alias("lo"), (F.col("l.rank") + 1).alias("hi"), "l.digest"
    )
    below, levels = placed, []
    for level in range(1, tallest + 1):
        below = settle(parents(below.filter(F.col("height") >= level), level, fanout), f"level{level}")
        levels.append(below)
    tops = placed.filter("height = 0").select("tree", "digest")
    for level, nodes in enumerate(levels, 1):
        tops = tops.union(nodes.filter(F.col("height") == level).select("tree", "digest"))
    tops = tops.select(F.col("tree").alias("_tree"), F.col("digest").alias("top"))
    found = heights.join(tops, F.col("tree").eqNullSafe(F.col("_tree"))).drop("_tree")
    return levels, settle(found, "tops")


def hand_down(levels: list[DataFrame], paths: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """(tree, lo, hi, children, path): nodes of level 1 with the siblings of all their ancestors, nearest first.

    ``paths`` (tree, path) says what lies above the top of each tree; a path is an array of (left, right).
    """
    above = None
    for level in range(len(levels), 0, -1):
        nodes = levels[level - 1]
        at_top = nodes.filter(F.col("height") == level).alias("n").join(
            paths.alias("p"), F.col("n.tree").eqNullSafe(F.col("p.tree"))
        )
        here = at_top.select("n.tree", "n.lo", "n.hi", "n.children", "p.path")
        if above is not None:
            # The bucket of the parent, one level up; containment is what makes it an ancestor.
            bucket = F.floor(F.col("n.lo") / fanout ** (level + 1)).cast("bigint")
            inside = (F.col("a.lo") <= F.col("n.lo")) & (F.col("n.hi") <= F.col("a.hi"))
            lower = nodes.filter(F.col("height") > level).alias("n").join(
                above.alias("a"),
                F.col("n.tree").eqNullSafe(F.col("a.tree")) & (bucket == F.floor(F.col("a.lo") / fanout ** (level + 1)).cast("bigint")) & inside,
            )
            step = siblings(F.col("a.children"), F.col("n.lo"), F.col("n.hi"))
            path = F.concat(F.array(step), F.col("a.path"))
            here = here.union(lower.select("n.tree", "n.lo", "n.hi", "n.children", path.alias("path")))
        above = settle(here, f"paths{level}")
    return above


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its way up give."""
    return F.aggregate(path, leaf, lambda below, s: digest(s["left"], below, s["right"]))


def manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = FIELDS,
    doc_id: str = "doc_id",
    source: str = "source",
    *,
    tampered: Column | None = None,
    fanout: int = FANOUT,
) -> DataFrame:
    """(doc_id, source, leaf, subroot, root, path, presented), one row per row of ``docs``.

    A leaf is the hash of ``fields``. Leaves of a source ascend by id; every ``fanout`` nodes in a row
    become one, up to the source's subroot; subroots in order of their source, null first, are the leaves of the
    last tree. ``path`` lists the digests left and right of a document's ancestors from the leaf to the
    root, and :func:`folded` makes a root of it. ``presented`` is the leaf that someone else claims: that of ``tampered``,
    which is a leaf computed otherwise, or the leaf itself where that is null.

    - A null source is a source, in first place; a null id comes before all others. Null and empty
      fields have hashes of their own.
    - Rows of equal ids are ordered by leaf; equal rows are leaves of their own, with equal hashes.
    - A source of one document has its leaf as subroot, a table of one source has its subroot as root.
    - An empty table gives an empty result. Columns other than ``fields``, id and source are not read.
    - Texts of any length are hashed whole, once, where they are; only hashes are shuffled.
    """
    leaf = leaf_of(*(F.col(f"`{f}`") for f in fields))
    hashed = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("tree"), leaf.alias("digest"),
        F.coalesce(tampered if tampered is not None else F.lit(None).cast("string"), leaf).alias("presented"),
    )
    hashed = settle(hashed, "leaves")
    order = [F.col("doc_id").asc_nulls_first(), F.col("digest")]
    leaves = settle(numbered(hashed, order, ["tree"], "rank"), "ranked")
    levels, sources = grow(leaves.select("tree", "rank", "digest"), fanout)

    ranked = numbered(sources.select("tree", "top"), [F.col("tree").asc_nulls_first()], name="rank")
    ranked = settle(ranked.withColumnRenamed("tree", "source"), "sources")
    one = F.lit("all").alias("tree")
    upper, whole = grow(ranked.select(one, "rank", F.col("top").alias("digest")), fanout)
    root = whole.select(F.col("top").alias("root")).first()
    root = F.lit(root.root if root else None).cast("string")
    nothing = F.array().cast(_STEP)
    if upper:
        above = hand_down(upper, whole.select("tree", nothing.alias("path")), fanout)
        paths = _to_children(above).join(ranked.select("source", "rank", "top"), F.col("lo") == F.col("rank"))
        paths = settle(paths.select(F.col("source").alias("tree"), "top", "path"), "source-paths")
    else:
        paths = ranked.select(F.col("source").alias("tree"), "top", nothing.alias("path"))

    columns = [F.col("l.doc_id"), F.col("l.tree").alias("source"), F.col("l.digest").alias("leaf"), F.col("p.top").alias("subroot"), root.alias("root")]
    lone = sources.filter("height = 0").select("tree")
    alone = leaves.alias("l").join(lone.alias("o"), F.col("l.tree").eqNullSafe(F.col("o.tree")), "left_semi")
    alone = alone.join(paths.alias("p"), F.col("l.tree").eqNullSafe(F.col("p.tree")))
    out = alone.select(*columns, F.col("p.path").alias("path"), "l.presented")
    if levels:
        runs = hand_down(levels, paths.select("tree", "path"), fanout)
        tops = sources.select(F.col("tree").alias("_tree"), F.col("top"))
        runs = runs.join(tops, F.col("tree").eqNullSafe(F.col("_tree"))).drop("_tree").alias("p")
        bucket = F.floor(F.col("l.rank") / fanout).cast("bigint") == F.floor(F.col("p.lo") / fanout).cast("bigint")
        inside = (F.col("p.lo") <= F.col("l.rank")) & (F.col("l.rank") < F.col("p.hi"))
        met = leaves.alias("l").join(runs, F.col("l.tree").eqNullSafe(F.col("p.tree")) & bucket & inside)
        step = siblings(F.col("p.children"), F.col("l.rank"), F.col("l.rank") + 1)
        out = out.union(met.select(*columns, F.concat(F.array(step), F.col("p.path")).alias("path"), "l.presented"))
    return out


def _to_children(runs: DataFrame) -> DataFrame:
    """(tree, lo, digest, path): the leaves of trees, from their nodes of level 1."""
    each = runs.select("tree", "children", "path", F.explode("children").alias("c"))
    step = siblings(F.col("children"), F.col("c.lo"), F.col("c.hi"))
    return each.select("tree", "c.lo", "c.digest", F.concat(F.array(step), F.col("path")).alias("path"))


def proof_digest(path: Column) -> Column:
    """The hash of all siblings on a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)


def verified(manifested: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): each row's claim held against the root."""
    up = folded(F.col("presented"), F.col("path"))
    out = manifested.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), up.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def lower_case_tampering(one_in: int = TAMPERED_ONE_IN) -> Column:
    """The leaf of a document whose text lost its capitals, for one id in ``one_in`` by CRC-32; else null."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % one_in == 0
    values = [lower_ascii(F.col(f)) if f == "text" else F.col(f) for f in FIELDS]
    return F.when(hit, leaf_of(*values))
