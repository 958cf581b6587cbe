"""Sources mixed to target weights by entropy balancing.

Every document gets a rate between 0 and ``most`` (2), its weight in the mix. Of all rates that give each source
its target of words, entropy balancing takes those nearest to taking every document once, in the entropy that is
bounded on both sides. The dual is convex with one multiplier a source, and its stationary point tilts the rates
of documents exponentially in their words: rate / (most - rate) = exp(multiplier * size / mean size), so what a
source has too much of is taken from its long documents first, and what it lacks is added by them. Newton steps find
the multipliers, each one an aggregate over documents by source. Rates then become whole copies, with the rounding
error carried from document to document within blocks that are dealt by hash.
"""

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagedoor.llm.common import WORD_CLASS, unused
from stagedoor.operators.numbering import numbered
from stagedoor.session import settle

# Weights of sources in code point order, repeating, and the whole as a share of all sizes.
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_CLASS)), F.lit(0)).cast("bigint")


def spread_of(doc_id: Column, text: Column) -> Column:
    return F.xxhash64(doc_id.cast("string"), text)


def source_targets(
    units: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """(source, n_docs, n_units, source_size, target): one row a source, targets at most ``most`` sizes.

    The excess of sources above their limit is shared out again by weight until none is above. Sources are
    numbered by ranges of their names, so their number has no bound.
    """
    by_source = units.groupBy("source").agg(
        F.count("*").alias("n_docs"),
        F.sum("times").alias("n_units"),
        F.sum(F.col("size") * F.col("times")).alias("source_size"),
    )
    placed = numbered(settle(by_source, "source-sizes"), [F.col("source").asc_nulls_last()])
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    table = settle(placed.withColumn("weight", weight).drop("place"), "sources")
    whole = table.agg(F.sum("source_size")).first()[0] or 0
    limit = F.col("source_size") * F.lit(float(most))
    level, full = None, -1
    while True:
        # Sources that a level would lift above their limit stay at it; the rest share what is left.
        above = F.lit(False) if level is None else F.col("weight") * F.lit(level) > limit
        n, used, rest = table.agg(
            F.coalesce(F.count_if(above), F.lit(0)),
            F.coalesce(F.sum(F.when(above, limit)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)),
        ).first()
        if n == full or not rest:
            break
        level, full = (share * whole - used) / rest, n
    target = F.least(F.col("weight") * F.lit(level or 0.0), limit)
    if level is None:
        target = F.lit(0.0)
    return table.select("source", "n_docs", "n_units", "source_size", target.cast("double").alias("target"))


def rate_of(tilt: Column, size: Column, mean: Column, most: float = MOST) -> Column:
    """The rate of a document: between 0 and ``most``, 1 where nothing tilts it, rounded so that reruns agree."""
    return F.round(F.lit(float(most)) / (1 + F.exp(-tilt * size / mean)), 9)


def tilts(units: DataFrame, targets: DataFrame, most: float = MOST, rounds: int = 60, close: float = 1e-6) -> DataFrame:
    """``targets`` with ``mean``, the mean size of a source's documents, ``tilt``, its multiplier, and ``edge``.

    Newton steps on the dual, all sources in one step. The gradient for a source is the words that its
    rates take less its target; the curvature is the sum of words * (size / mean) * rate * (1 - rate / most) over its
    documents. Both are summed as decimals, so they don't depend on the order of rows. As the gradient rises with the
    multiplier, every step narrows the interval that holds the solution; a step that would leave it, or is longer than
    the multiplier so far, is shortened. A source whose target is 0 or its limit has no finite multiplier: ``edge``
    is its rate, 0 or ``most``. Documents of one source and size have one rate, so they enter as one row with their number.
    """
    size, target = F.col("size"), F.col("target")
    ends = (target <= 0) | (target >= F.col("source_size") * F.lit(float(most)))
    edge = F.when(target <= 0, F.lit(0.0)).when(ends, F.lit(float(most)))
    grouped = units.groupBy("source", "size").agg(F.sum("times").alias("n"))
    sizes = settle(grouped.filter("size > 0").withColumnRenamed("source", "_source"), "sizes-by-source")
    none = F.lit(None).cast("double")
    state = targets.withColumn("mean", F.try_divide(F.col("source_size").cast("double"), "n_units")).select(
        "*", edge.alias("edge"), F.lit(0.0).alias("tilt"), none.alias("low"), none.alias("high"), F.lit(False).alias("done")
    )
    state = settle(state, "tilts")
    exact = "decimal(38,6)"
    for _ in range(rounds):
        open_ = state.filter("edge is null and not done")
        if open_.isEmpty():
            break
        words = F.col("n") * size
        share = size / F.col("mean")
        rate = rate_of(F.col("tilt"), size, F.col("mean"), most)
        met = sizes.join(open_.select("source", "tilt", "mean"), F.col("_source").eqNullSafe(F.col("source")))
        sums = met.groupBy("_source").agg(
            F.sum((words * rate).cast(exact)).cast("double").alias("taken"),
            F.sum((words * share * rate * (1 - rate / most)).cast(exact)).cast("double").alias("bend"),
        )
        gap = F.col("taken") - target
        tilt, low, high = F.col("tilt"), F.col("low"), F.col("high")
        newer_low = F.when(gap < 0, tilt).otherwise(low)
        newer_high = F.when(gap >= 0, tilt).otherwise(high)
        longest = F.greatest(F.lit(1.0), F.abs(tilt))
        newton = F.coalesce(F.try_divide(-gap, F.col("bend")), F.when(gap < 0, longest).otherwise(-longest))
        step = tilt + F.greatest(-longest, F.least(longest, newton))
        inside = F.coalesce(step > newer_low, F.lit(True)) & F.coalesce(step < newer_high, F.lit(True))
        after = F.when(inside, step).otherwise((newer_low + newer_high) / 2)
        found = F.coalesce(F.abs(gap) <= target * close, F.lit(True))
        moved = state.join(sums, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
        settled = F.col("edge").isNotNull() | F.col("done") | found
        state = settle(
            moved.select(
                *targets.columns, "mean", "edge", F.when(settled, tilt).otherwise(after).alias("tilt"),
                F.when(settled, low).otherwise(newer_low).alias("low"), F.when(settled, high).otherwise(newer_high).alias("high"),
                settled.alias("done"),
            ),
            "tilts",
        )
    return state.select(*targets.columns, "mean", "tilt", "edge")


def _copies(block: pd.DataFrame, most: float, whole: bool) -> pd.DataFrame:
    """Whole copies of one block's documents, large ones first, the error in words carried on.

    ``whole`` says that the block is the head of its source, whose other documents follow; else the block is
    on its own. A document is taken no more and no less often than leaves the documents after it a need that
    they can meet.
    """
    block = block.assign(all=block["size"] * block["times"]).sort_values(
        ["all", "spread", "doc_id"], ascending=[False, True, True], kind="stable"
    )
    sizes, rates = block.pop("all").tolist(), block["asked"].tolist()
    need = block["target"].iloc[0] if whole else sum(s * r for s, r in zip(sizes, rates, strict=True))
    rest = block["source_size"].iloc[0] if whole else sum(sizes)
    owed, copies = 0.0, []
    for size, rate in zip(sizes, rates, strict=True):
        if size <= 0:
            copies.append(min(int(rate + 0.5), int(most)))
            continue
        rest -= size
        owed += rate * size
        n = math.floor(owed / size + 0.5)
        n = min(max(n, math.ceil((need - most * rest) / size)), math.floor(need / size + 1e-6))
        n = max(0, min(int(most), n))
        owed, need = owed - n * size, need - n * size
        copies.append(n)
    return block.assign(copies=copies)


def mixed_units(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    *,
    weights: tuple = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    block_rows: int = 1000,
    heavy: int = 1000,
) -> DataFrame:
    """(doc_id, spread, source, size, times, source_size, target, rate, copies): each distinct document.

    ``spread`` is the hash of id and text, ``times`` the number of equal rows, ``copies`` what the mix takes
    of each of them. Documents of over 1 / ``heavy`` of their source, so fewer than ``heavy`` a source, are
    rounded first, and what they are off is shared out over the rates of the others. Those are cut into
    blocks of about ``block_rows`` by hash; a block is off its share by about its smallest document. So
    a source comes near its target at every size, and whatever its longest documents are.
    """
    row = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        spread_of(F.col(doc_id), F.col(text)).alias("spread"),
        F.col(source).alias("source"),
        size_of(F.col(text)).alias("size"),
    )
    units = settle(row.groupBy(*row.columns).agg(F.count("*").alias("times")), "sizes")
    rates = tilts(units, source_targets(units, weights, share, most), most)
    # A row a source: Spark broadcasts it where it measures it as small, and else splits the hot sources.
    tilted = units.join(
        rates.select(F.col("source").alias("_source"), "n_docs", "source_size", "target", "mean", "tilt", "edge"),
        F.col("source").eqNullSafe(F.col("_source")),
    ).drop("_source")
    # A source without words has no mean; its documents are taken once.
    own = F.coalesce("edge", rate_of(F.col("tilt"), F.col("size"), F.col("mean"), most), F.lit(1.0))
    joined = tilted.withColumn("rate", own).drop("mean", "tilt", "edge")
    words = F.col("size") * F.col("times")
    columns = [*units.columns, "source_size", "target", "rate"]

    def rounded(dealt: DataFrame, whole: bool) -> DataFrame:
        def round_block(block: pd.DataFrame) -> pd.DataFrame:
            return _copies(block, most, whole)

        done = ", ".join(f"{c} {kind}" for c, kind in [*dealt.dtypes, ("copies", "int")])
        return dealt.groupBy("source", "block").applyInPandas(round_block, done).select(*columns, "copies")

    is_heavy = words * heavy > F.col("source_size")
    asked = joined.withColumn("asked", F.col("rate")).withColumn("block", F.lit(0).cast("bigint"))
    first = settle(rounded(asked.filter(is_heavy).drop("n_docs"), True), "heavy")
    owed = settle(
        first.groupBy(F.col("source").alias("_source")).agg(
            F.sum(words * (F.col("rate") - F.col("copies"))).alias("owed"), F.sum(words).alias("done")
        ),
        "owed",
    )
    rest = joined.filter(~is_heavy).join(owed, F.col("source").eqNullSafe(F.col("_source")), "left")
    more = F.try_divide("owed", F.col("source_size") - F.col("done"))
    rate = F.round(F.col("rate") + F.coalesce(more, F.lit(0.0)), 9)
    blocks = F.greatest(F.lit(1), F.ceil(F.col("n_docs") / block_rows))
    dealt = rest.withColumn("asked", F.greatest(F.lit(0.0), F.least(F.lit(float(most)), rate))).withColumn(
        "block", F.pmod("spread", blocks)
    )
    return first.union(rounded(dealt.select(*columns, "asked", "block"), False))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """(doc_id, size, source, source_size, target, rate, copies), one row per row of ``docs``.

    ``copies`` of 0, 1 or 2 times ``size`` is what the mix takes. Options are those of :func:`mixed_units`.

    - A null text has size 0; documents of size 0 take the rounded rate as copies, and no words.
    - Null is a source of its own, in last place. A null doc_id is a document like any other.
    - Rows equal in id, source and text take equally many copies; other ties are rounded in an order by hash and id.
    - A source of size 0 has target 0. An empty table gives an empty result.
    - Columns other than those named are not read.
    """
    units = mixed_units(docs, doc_id, text, source, **options)
    each = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times")))
    return units.withColumn("_each", each).drop("_each", "times", "spread")


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as they are taken, with the columns of ``docs``, whatever their names.

    Rows equal in id, source and text are taken equally often, each as many times as :func:`mix` says. A
    document without words is taken by its rate, which is 1 unless its source takes nothing or all twice.
    An empty table gives an empty result.
    """
    names = [unused(docs, n) for n in ("_doc_id", "_spread", "_source", "_copies")]
    units = mixed_units(docs, doc_id, text, source, **options)
    taken = units.filter("copies > 0").select("doc_id", "spread", "source", "copies").toDF(*names)
    taken = settle(taken, "taken")
    of_id, of_text, of_source, copies = map(F.col, names)
    same = (
        F.col(doc_id).cast("bigint").eqNullSafe(of_id)
        & (spread_of(F.col(doc_id), F.col(text)) == of_text)
        & F.col(source).eqNullSafe(of_source)
    )
    each = F.explode(F.sequence(F.lit(1), copies)).alias(unused(docs, "_each"))
    columns = [f"`{c}`" for c in docs.columns]
    return docs.join(taken, same).select(*columns, each).select(*columns)
