"""Text quality as perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is one of characters, ``ORDER`` at a time, one for each language. Its counts are tables:

1. Tasks count the n-grams of their documents block by block; counts of trusted text are summed over all.
   What is gathered holds every n-gram of the corpus, whether trusted text has it or not.
2. Continuation counts, discounts, back-off weights and probabilities follow by grouping and joining, from
   single characters up to whole n-grams.
3. Tasks list, for each n-gram of a block, the block's documents that have it and how often. These postings
   are joined with the probabilities on the n-gram, so the model is spread over the cluster and never
   whole anywhere; the sums meet again by block and give each document's perplexity. The few n-grams that
   nearly every document has would be hot keys of that join; ``HOT_GRAMS`` of them, a bound, are broadcast.

A document is rejected if its perplexity is above a quantile of held-out trusted documents of its language.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagedoor.llm.common import without
from stagedoor.session import settle

ORDER = 4
QUANTILE = 0.995
# Characters counted at once; bounds a task's memory, whatever the length of texts.
BLOCK_CHARS = 1 << 21
BLOCK_DOCS = 1 << 14
# Trusted ids (16 bytes each) up to this many are broadcast, more are joined by a shuffle.
BROADCAST_IDS = 2_000_000
FOLDS = 5
# The most frequent n-grams of trusted text, of all languages together; some 5 MB in a task.
HOT_GRAMS = 1 << 15
# Stands before a text, so that its beginning has a context too.
BEGIN = "\x02"

NO_LANGUAGE = ""


def normalised(text: bytes | None) -> str:
    """Lower case, white space runs as one space; what isn't UTF-8 as a replacement character."""
    return " ".join((text or b"").decode("utf-8", "replace").lower().split())


def _pieces(rows: Iterator[tuple], order: int) -> Iterator[tuple[tuple, np.ndarray]]:
    """(row without its text, code points) with the context that n-grams need; long texts come in several pieces."""
    for *row, text in rows:
        text = normalised(text)
        points = np.frombuffer((BEGIN * (order - 1) + text).encode("utf-32-le", "replace"), np.uint32)
        for at in range(0, max(len(text), 1), BLOCK_CHARS):
            yield row, points[at : at + BLOCK_CHARS + order - 1]


def _blocks(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[list[tuple[tuple, np.ndarray]]]:
    rows = (
        row
        for batch in batches
        for at in range(0, batch.num_rows, 256)
        for row in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns), strict=True)
    )
    block, size = [], 0
    for piece in _pieces(rows, order):
        if block and (size + len(piece[1]) > BLOCK_CHARS + order or len(block) == BLOCK_DOCS):
            yield block
            block, size = [], 0
        block.append(piece)
        size += len(piece[1])
    if block:
        yield block


def _grams(points: list[np.ndarray], owners: np.ndarray, order: int) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (n-gram, owner) of a block, ordered: the n-grams, where each one's run begins, owners, counts.

    Characters are numbered within the block, so an n-gram and its owner mostly fit one integer and one sort
    groups them. Should they not fit, they are spread over as many integers as they need, and sorted by all.
    Of what is as long as the block, only the integers take eight bytes a character; all is changed in place.
    """
    letter = np.concatenate(points)
    uses = np.bincount(letter)
    alphabet = np.flatnonzero(uses)
    owner_bits = max(1, int(owners.max()).bit_length())
    bits = max(1, int(len(alphabet) - 1).bit_length())
    number = np.zeros(len(uses), np.uint32)
    number[alphabet] = np.arange(len(alphabet))
    letter = number[letter]
    sizes = np.array([len(p) for p in points])
    ends = np.cumsum(sizes)
    inside = np.ones(len(letter), bool)
    for i in range(order - 1):
        inside[(ends - sizes + i)[sizes > i]] = False
    inside = inside[order - 1 :]
    n = int(np.count_nonzero(inside))
    if not n:
        return [], np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.int64)
    # Integers of an n-gram, the first characters first, and where each character is: integer, shift.
    per = 64 // bits
    places = [(i // per, bits * (min(per, order - i // per * per) - 1 - i % per)) for i in range(order)]
    codes = [np.zeros(len(inside), np.uint64) for _ in range(places[-1][0] + 1)]
    for i, (k, shift) in enumerate(places):
        codes[k] |= letter[i : i + len(inside)] * np.uint64(1 << shift)
    owner = np.repeat(owners, sizes)[order - 1 :]
    fits = bits * (order - places[-1][0] * per) + owner_bits <= 64
    if fits:
        codes[-1] <<= np.uint64(owner_bits)
        codes[-1] |= owner
        keys = codes
    else:
        keys = [*codes, owner]
    del letter, owner, codes
    for i in range(len(keys)):
        keys[i] = keys[i][inside]
    del inside
    if len(keys) == 1:
        keys[0].sort()
    else:
        by_all = np.lexsort(keys[::-1])
        keys = [k[by_all] for k in keys]

    def begins(columns: list[np.ndarray]) -> np.ndarray:
        differ = np.ones(len(columns[0]), bool)
        np.not_equal(columns[0][1:], columns[0][:-1], out=differ[1:])
        for c in columns[1:]:
            differ[1:] |= c[1:] != c[:-1]
        return np.flatnonzero(differ)

    first = begins(keys)
    counts = np.diff(np.append(first, n))
    keys = [k[first] for k in keys]
    owner = (keys[-1] & np.uint64((1 << owner_bits) - 1)).astype(np.uint32)
    codes = [*keys[:-1], keys[-1] >> np.uint64(owner_bits)] if fits else keys[:-1]
    runs = begins(codes)
    mask = np.uint64((1 << bits) - 1)
    shown = np.stack([alphabet[((codes[k][runs] >> np.uint64(shift)) & mask).astype(np.int64)] for k, shift in places], axis=1)
    text = shown.astype("<u4").tobytes().decode("utf-32-le", "replace")
    return [text[i : i + order] for i in range(0, len(text), order)], runs, owner, counts


def _by_language(block: list[tuple[tuple, np.ndarray]]) -> Iterator[tuple[str, list[int]]]:
    lang = [row[0] for row, _ in block]
    for name in sorted(set(lang)):
        yield name, [i for i, x in enumerate(lang) if x == name]


_GRAMS = "lang string, gram string, n long"
_POSTINGS = "lang string, gram string, block long, owners binary, counts binary"


def count_grams(rows: DataFrame, order: int) -> DataFrame:
    """(lang, gram, n) of rows (lang, trains, text): all n-grams, n counting those of rows that train."""

    def counted(lang: str, pieces: list[tuple[tuple, np.ndarray]]) -> pa.RecordBatch:
        trains = np.array([bool(row[1]) for row, _ in pieces])
        grams, runs, owner, counts = _grams([points for _, points in pieces], trains.astype(np.uint32), order)
        n = np.add.reduceat(counts * owner, runs) if grams else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.string()), pa.array(n, pa.int64())],
            names=["lang", "gram", "n"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, order):
            for lang, members in _by_language(block):
                yield counted(lang, [block[i] for i in members])

    found = rows.select("lang", "trains", "text").mapInArrow(count, _GRAMS)
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


# ---- the model -------------------------------------------------------------------------------------


def _discounts(counts: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3) of one order, from how many n-grams have a count of 1, 2, 3 and 4."""
    n = [F.count_if(F.col("n") == i).alias(f"n{i}") for i in (1, 2, 3, 4)]
    table = counts.groupBy("lang").agg(*n)
    y = F.when(F.col("n1") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(0.5)

    def discount(i: int) -> Column:
        here, above = F.col(f"n{i}"), F.col(f"n{i + 1}")
        value = F.when(here > 0, i - (i + 1) * y * above / here).otherwise(0.5 * i)
        # Small corpora give counts of counts for which the estimate leaves its range.
        return F.least(F.greatest(value, F.lit(0.1)), F.lit(i - 0.05)).alias(f"d{i}")

    return table.select("lang", discount(1), discount(2), discount(3))


def _discount_of(n: Column) -> Column:
    return F.when(n == 1, F.col("d1")).when(n == 2, F.col("d2")).otherwise(F.col("d3"))


def model(grams: DataFrame, order: int) -> DataFrame:
    """(lang, gram, logp) of every n-gram in ``grams`` whose language has trusted text.

    Interpolated modified Kneser-Ney: counts at the highest order, numbers of different preceding characters
    below, three discounts an order, and back-off down to an even distribution over the language's
    characters, so every n-gram has a probability. n-grams of fewer characters are suffixes.
    """
    seen = {order: settle(grams.filter("n > 0"), f"seen{order}")}
    asked = {order: grams.select("lang", "gram")}
    for k in range(order - 1, 0, -1):
        shorter = F.substring("gram", 2, k).alias("gram")
        seen[k] = settle(seen[k + 1].groupBy("lang", shorter).agg(F.count("*").alias("n")), f"seen{k}")
        asked[k] = settle(asked[k + 1].select("lang", shorter).distinct(), f"asked{k}")
    size = asked[1].groupBy("lang").agg(F.count("*").alias("size"))
    lower = None
    for k in range(1, order + 1):
        d = _discounts(seen[k])
        context = F.substring("gram", 1, k - 1).alias("context")
        mass = [F.count_if(F.col("n") == i) for i in (1, 2)] + [F.count_if(F.col("n") > 2)]
        contexts = seen[k].groupBy("lang", context).agg(
            F.sum("n").alias("total"), *(m.alias(f"m{i}") for i, m in enumerate(mass, 1))
        )
        backoff = sum((F.col(f"d{i}") * F.col(f"m{i}") for i in (1, 2, 3)), F.lit(0.0)) / F.col("total")
        contexts = contexts.join(d, "lang").select("lang", "context", "total", backoff.alias("backoff"), "d1", "d2", "d3")
        q = asked[k].withColumn("context", F.substring("gram", 1, k - 1)).join(seen[k], ["lang", "gram"], "left")
        q = q.join(contexts, ["lang", "context"], "left")
        if lower is None:
            q = q.join(size, "lang").withColumn("lower", 1 / F.col("size")).filter("total is not null")
        else:
            below = lower.select("lang", F.col("gram").alias("shorter"), F.col("p").alias("lower"))
            q = q.withColumn("shorter", F.substring("gram", 2, k - 1)).join(below, ["lang", "shorter"])
        own = F.coalesce((F.col("n") - _discount_of(F.col("n"))) / F.col("total"), F.lit(0.0))
        p = own + F.coalesce("backoff", F.lit(1.0)) * F.col("lower")
        lower = settle(q.select("lang", "gram", p.alias("p")), f"p{k}")
    return lower.select("lang", "gram", F.log("p").alias("logp"))


# ---- scores ----------------------------------------------------------------------------------------


def hottest(grams: DataFrame, probabilities: DataFrame, most: int) -> dict[str, dict[str, float]]:
    """Log probabilities of the ``most`` most frequent n-grams, by language."""
    top = grams.filter("n > 0").orderBy(F.desc("n"), "lang", "gram").limit(most).select("lang", "gram")
    hot: dict[str, dict[str, float]] = {}
    for r in probabilities.join(F.broadcast(top), ["lang", "gram"]).collect():
        hot.setdefault(r.lang, {})[r.gram] = r.logp
    return hot


def postings(rows: DataFrame, order: int, hot: dict[str, dict[str, float]]) -> DataFrame:
    """n-grams of blocks with the documents that have them, and a row (gram null) naming a block's documents.

    What ``hot`` n-grams contribute is summed on the spot and stands in the row that names the documents.
    """
    shared = rows.sparkSession.sparkContext.broadcast(hot)

    def listed(lang: str, name: int, pieces: list[tuple[tuple, np.ndarray]]) -> pa.RecordBatch:
        known = shared.value.get(lang, {})
        grams, runs, owner, counts = _grams([points for _, points in pieces], np.arange(len(pieces), dtype=np.uint32), order)
        ends = np.append(runs[1:], len(owner))
        logp = np.array([known.get(g, np.nan) for g in grams], float)
        each = np.repeat(logp, ends - runs[: len(grams)])
        here = ~np.isnan(each)
        sums = np.bincount(owner[here], each[here] * counts[here], minlength=len(pieces))
        rare = np.flatnonzero(np.isnan(logp))
        small = owner.astype("<u2")
        few = counts.astype(np.uint8 if len(counts) == 0 or counts.max() < 256 else "<u4")
        spans = [(int(runs[g]), int(ends[g])) for g in rare]
        keys = np.array([row[1:3] for row, _ in pieces], "<i8")
        sizes = np.array([len(points) - order + 1 for _, points in pieces], "<i8")
        n = len(rare) + 1
        return pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * n, pa.string()),
                pa.array([None, *(grams[g] for g in rare)], pa.string()),
                pa.array([name] * n, pa.int64()),
                pa.array([keys.tobytes(), *(small[a:b].tobytes() for a, b in spans)], pa.binary()),
                pa.array([sizes.tobytes() + sums.astype("<f8").tobytes(), *(few[a:b].tobytes() for a, b in spans)], pa.binary()),
            ],
            names=["lang", "gram", "block", "owners", "counts"],
        )

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId(), 0
        for block in _blocks(batches, order):
            for lang, members in _by_language(block):
                yield listed(lang, (task << 32) + number, [block[i] for i in members])
                number += 1

    return rows.select("lang", "id", "text_key", "text").mapInArrow(post, _POSTINGS)


def _partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of log probabilities by block; blocks whose documents are named pass through."""
    sums: dict[tuple, np.ndarray] = {}
    size = 0

    def flush() -> pa.RecordBatch:
        keys = list(sums)
        out = pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()),
                pa.nulls(len(keys), pa.binary()), pa.nulls(len(keys), pa.binary()),
                pa.array([sums[k].astype("<f8").tobytes() for k in keys], pa.binary()),
            ],
            names=["lang", "block", "owners", "counts", "sums"],
        )
        sums.clear()
        return out

    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(6)]
        named = [i for i, g in enumerate(columns[1]) if g is None]
        if named:
            some = batch.take(pa.array(named))
            yield pa.RecordBatch.from_arrays(
                [some.column(0), some.column(2), some.column(3), some.column(4), pa.nulls(len(named), pa.binary())],
                names=["lang", "block", "owners", "counts", "sums"],
            )
        for lang, gram, block, who, often, logp in zip(*columns, strict=True):
            if gram is None or logp is None:
                continue
            owner = np.frombuffer(who, "<u2")
            count = np.frombuffer(often, np.uint8 if len(often) == len(owner) else "<u4")
            have = sums.get((lang, block))
            if have is None or len(have) <= owner[-1]:
                grown = np.zeros(int(owner[-1]) + 1)
                if have is not None:
                    grown[: len(have)] = have
                size += grown.nbytes - (0 if have is None else have.nbytes)
                sums[lang, block] = have = grown
            have[owner] += count * logp
        if size > 64 << 20:
            yield flush()
            size = 0
    if sums:
        yield flush()


_SUMS = "lang string, block long, owners binary, counts binary, sums binary"
_SCORES = "lang string, id long, text_key long, n long, logp double"


def _block_scores(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block's documents with their sums; documents of a language without a model have none."""
    total, named = np.zeros(0), None
    for batch in batches:
        for who, sizes, part in zip(*(batch.column(c).to_pylist() for c in ("owners", "counts", "sums")), strict=True):
            if part is None:
                keys = np.frombuffer(who, "<i8").reshape(-1, 2)
                named = keys, np.frombuffer(sizes, "<i8", len(keys))
                more = np.frombuffer(sizes, "<f8", len(keys), 8 * len(keys))
            else:
                more = np.frombuffer(part, "<f8")
            if len(more) > len(total):
                total, more = more.copy(), total
            total[: len(more)] += more
    ids, sizes = named
    logp = np.zeros(len(sizes))
    logp[: len(total)] = total
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([key[0].as_py()] * len(sizes), pa.string()), pa.array(ids[:, 0].copy(), pa.int64()),
            pa.array(ids[:, 1].copy(), pa.int64()), pa.array(sizes.copy(), pa.int64()),
            pa.array(np.where(logp == 0, np.nan, logp), pa.float64(), from_pandas=True),
        ],
        names=["lang", "id", "text_key", "n", "logp"],
    )


def keyed(docs: DataFrame, doc_id: str, text: str, lang: str) -> DataFrame:
    """(id, text_key, lang, text): a document is known by a hash of its id and one of its text."""
    return docs.select(
        F.xxhash64(F.col(doc_id).cast("string"), F.col(lang)).alias("id"),
        F.xxhash64(text).alias("text_key"),
        F.coalesce(F.col(lang), F.lit(NO_LANGUAGE)).alias("lang"),
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.col(text).cast("binary").alias("text"),
    )


def _held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids that labels call good, and never toxic or bad."""
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    by_id = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("trusted"))
    return by_id.agg(F.min(F.coalesce(good, F.lit(False))).alias("good")).filter("good").select("trusted")


def perplexities(
    docs: DataFrame, trusted: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", *, order: int = ORDER
) -> DataFrame:
    """(id, text_key, lang, n, perplexity, calibrates): each distinct document under its language's model.

    ``trusted`` has one column of ids. A fifth of the trusted documents, by hash, is not trained on;
    ``calibrates`` marks them.
    """
    ids = settle(trusted.select(F.col(trusted.columns[0]).alias("trusted")).distinct(), "trusted")
    side = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    rows = keyed(docs, doc_id, text, lang)
    marked = rows.join(side, rows["doc_id"] == F.col("trusted"), "left")
    trains = F.col("trusted").isNotNull() & ~_held_out(F.col("doc_id"))
    grams = settle(count_grams(marked.withColumn("trains", trains), order), "grams")
    probabilities = settle(model(grams, order), "model")
    lists = postings(rows, order, hottest(grams, probabilities, HOT_GRAMS))
    joined = lists.join(probabilities, ["lang", "gram"], "left").select("lang", "gram", "block", "owners", "counts", "logp")
    sums = joined.mapInArrow(_partial_sums, _SUMS)
    scored = sums.groupBy("lang", "block").applyInArrow(_block_scores, _SCORES)
    # Pieces of a long text meet here; rows that repeat a document leave its mean as it is.
    whole = scored.groupBy("lang", "id", "text_key").agg(F.sum("n").alias("n"), F.sum("logp").alias("logp"))
    calibrates = rows.join(side, rows["doc_id"] == F.col("trusted"), "left_semi").filter(_held_out(F.col("doc_id")))
    calibrates = settle(calibrates.select("lang", "id", "text_key").distinct(), "calibrates")
    perplexity = F.when(F.col("n") > 0, F.round(F.exp(-F.col("logp") / F.col("n")), 6))
    scores = settle(whole.select("lang", "id", "text_key", "n", perplexity.alias("perplexity")), "perplexities")
    flagged = scores.join(calibrates.withColumn("calibrates", F.lit(True)), ["lang", "id", "text_key"], "left")
    return flagged.withColumn("calibrates", F.coalesce("calibrates", F.lit(False)))


def thresholds(scores: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """(lang, threshold): the quantile of calibrating documents' perplexity, to a thousandth of its logarithm.

    Counted in bins of the logarithm, so a language of any size is some thousands of rows in a window.
    """
    used = scores.filter("calibrates and perplexity is not null")
    bins = used.groupBy("lang", F.ceil(F.log("perplexity") * 1000).alias("bin")).count()
    up_to = Window.partitionBy("lang").orderBy("bin")
    share = F.sum("count").over(up_to) / F.sum("count").over(Window.partitionBy("lang"))
    reached = bins.withColumn("share", share).filter(F.col("share") >= quantile)
    return reached.groupBy("lang").agg(F.exp(F.min("bin") / 1000).alias("threshold"))


def judged(
    docs: DataFrame,
    trusted: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    *,
    order: int = ORDER,
    quantile: float = QUANTILE,
) -> DataFrame:
    """(doc_id, lang, id, text_key, n_chars, perplexity, threshold, kept), one row per row of ``docs``.

    ``n_chars`` is the length after white space is normalised; perplexity is per character.

    - Null, empty and blank texts have no perplexity and are kept: nothing speaks against them.
    - Null is a language of its own. A language without trusted text has no model, and one without held-out
      trusted text no threshold; its documents are kept.
    - A null doc_id is never trusted. Rows that repeat a document get its judgement each; ties with the threshold are kept.
    - Very long texts are counted in pieces and judged whole. An empty table gives an empty result.
    - Columns other than those named are not read.
    """
    scores = perplexities(docs, trusted, doc_id, text, lang, order=order)
    limits = settle(thresholds(scores, quantile), "thresholds")
    verdicts = settle(
        scores.join(limits, "lang", "left").select(
            "lang", "id", "text_key", "n", "perplexity", "threshold",
            F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)).alias("kept"),
        ),
        "verdicts",
    )
    rows = keyed(docs, doc_id, text, lang).drop("text")
    out = rows.join(verdicts.withColumnRenamed("lang", "_lang"), ["id", "text_key"], "left")
    return out.select(
        "doc_id", F.nullif("lang", F.lit(NO_LANGUAGE)).alias("lang"), "id", "text_key",
        F.col("n").alias("n_chars"), "perplexity", "threshold", F.coalesce("kept", F.lit(True)).alias("kept"),
    )


def accepted(docs: DataFrame, trusted: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", **options) -> DataFrame:
    """The rows of ``docs`` that are kept, with the columns of ``docs``, whatever their names.

    Null, empty and blank texts stay, as do those of a language without a threshold. Rows that repeat an id and its
    text share their fate. An empty table gives an empty result; without trusted rows everything stays.
    """
    verdicts = judged(docs, trusted, doc_id, text, lang, **options)
    bad = verdicts.filter("not kept").select(
        F.xxhash64(F.col("doc_id").cast("string")).alias("_id"), F.col("text_key").alias("_text")
    )
    return without(docs, bad, doc_id, text)
