"""Benchmark passages in training text, found by winnowing; DataFrame functions only.

Every run of ``window`` words that a text shares with a benchmark item is to be found. Words are hashed,
``gram`` consecutive hashes make a gram, and of any ``window - gram + 1`` consecutive grams the least is
kept as a fingerprint. A shared run of ``window`` words holds the same grams on both sides, hence the same
least one: an equality join of fingerprints misses none. Every hit is then extended to the windows around it,
and these are compared word by word, so equal hashes alone contaminate nothing. Items shorter than a window
are matched whole, by length.

A fingerprint of a text asks only whether any item has it, and a window around it only which items have it:
positions of texts are never paired with positions of items, so rows grow with the words of both, however often a
word or a passage repeats.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagedoor.llm.common import bit_table, filter_bits, lower_ascii, with_bits, without
from stagedoor.session import settle

WINDOW = 13
GRAM = 8
# Bits of the table that says which texts have hits; 32 MiB are broadcast at most.
MAX_BITS = 1 << 28
# Fixed value: what separates words once A-Z are in lower case.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# A fingerprint holds 32 bits of hash above 31 bits of position.
_LOW = 0x7FFFFFFF


def words_of(text: Column) -> Column:
    """The words of a text as an array; null has none."""
    parts = F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS)
    return F.filter(parts, lambda w: w != "")


def _runs(words: Column, length: int, count: Column, value) -> Column:
    """``value(i)`` for every start i of ``length`` words, counted from 1; none if there are fewer."""
    starts = F.when(count >= length, F.sequence(F.lit(1), (count - length + 1).cast("int")))
    return F.coalesce(F.transform(starts, value), F.array().cast("array<bigint>"))


def _packed(value: Column, i: Column) -> Column:
    return F.shiftleft(value.bitwiseAND(F.lit(0xFFFFFFFF)), 31).bitwiseOR(i.cast("bigint"))


def fingerprints(words: Column, window: int = WINDOW, gram: int = GRAM) -> Column:
    """Winnowed grams of an array of words: packed values of gram hash and position from 1."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    count = F.size(words)

    def grams(h):
        return _runs(h, gram, F.size(h), lambda i: _packed(F.xxhash64(F.slice(h, i, gram)), i))

    def least(g):
        span = window - gram + 1
        return _runs(g, span, F.size(g), lambda i: F.array_min(F.slice(g, i, span)))

    # A one-element array binds an inner result to a name, so that it is computed once.
    bound = F.transform(F.array(hashes), lambda h: grams(h))
    chosen = F.element_at(F.transform(bound, lambda g: least(g)), 1)
    return F.when(count >= window, F.array_distinct(chosen))


def whole_runs(words: Column, lengths: list[int]) -> Column:
    """Packed values of every run of each of ``lengths`` words, for items shorter than a window."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def runs(h):
        return F.concat(*(_runs(h, n, F.size(h), hash_of(h, n)) for n in lengths))

    def hash_of(h, n):
        return lambda i: _packed(F.xxhash64(F.slice(h, i, n), F.lit(n)), i)

    return F.element_at(F.transform(F.array(hashes), lambda h: runs(h)), 1)


def _hash_of(packed: Column) -> Column:
    return F.shiftrightunsigned(packed, 31)


def _place_of(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit(_LOW)).cast("int")


def benchmark_items(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """(key, item, words, size): distinct items with words, and how many of them make a window.

    ``key`` numbers the distinct pairs of id and words; a null id is none to join by.
    """
    item = items.select(F.col(item_id).cast("string").alias("item"), words_of(F.col(text)).alias("words"))
    item = item.filter(F.size("words") > 0).distinct()
    size = F.least(F.size("words"), F.lit(window)).alias("size")
    # Numbered as it is written, so every later read sees the same keys.
    return settle(item.select(F.monotonically_increasing_id().alias("key"), "item", "words", size), "items")


def item_marks(item: DataFrame, window: int, gram: int) -> DataFrame:
    """(hash, size): distinct fingerprints of items, and the size of the windows that they stand for."""
    lengths = [n for (n,) in item.filter(F.col("size") < window).select("size").distinct().collect()]
    long = item.filter(F.size("words") >= window)
    found = long.select(F.explode(fingerprints(F.col("words"), window, gram)).alias("packed"), "size")
    for n in sorted(lengths):
        run = F.element_at(whole_runs(F.col("words"), [n]), 1)
        found = found.union(item.filter(F.size("words") == n).select(run.alias("packed"), "size"))
    return found.select(_hash_of(F.col("packed")).alias("hash"), "size").distinct()


def _run(words: Column, first: Column, size: Column) -> Column:
    """``size`` words from ``first`` on as text; no word holds a space."""
    return F.array_join(F.slice(words, first, size), " ")


def item_windows(item: DataFrame) -> DataFrame:
    """(item, run): the distinct windows of items, as text."""
    starts = F.sequence(F.lit(1), F.size("words") - F.col("size") + 1)
    runs = F.array_distinct(F.transform(starts, lambda i: _run(F.col("words"), i, F.col("size"))))
    return item.select("item", F.explode(runs).alias("run")).distinct()


def hit_windows(
    docs: DataFrame, item: DataFrame, runs: DataFrame, doc_id: str, text: str, window: int, gram: int
) -> DataFrame:
    """(doc_id, text_key, first, past, run): windows of documents that are in ``runs``.

    ``text_key`` tells texts that share a doc_id apart. Word positions count from 1, ``past`` is exclusive.
    """
    marks = settle(item_marks(item, window, gram), "benchmark-marks")
    short = [n for (n,) in marks.filter(F.col("size") < window).select("size").distinct().collect()]
    keyed = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_key"), words_of(F.col(text)).alias("words")
    )
    # ``words`` is bound by a lambda, so the text is split once.
    packed = F.coalesce(fingerprints(F.col("words"), window, gram), F.array().cast("array<bigint>"))
    if short:
        packed = F.concat(packed, whole_runs(F.col("words"), sorted(short)))
    places = keyed.select("doc_id", "text_key", F.explode(packed).alias("packed")).select(
        "doc_id", "text_key", _hash_of(F.col("packed")).alias("hash"), _place_of(F.col("packed")).alias("at")
    )
    # Marks are read from files whose size Spark knows: it broadcasts them below its threshold only.
    hits = settle(places.join(marks, "hash").select("doc_id", "text_key", "at", "size").distinct(), "hits")
    whole = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_key"), F.col(text).alias("text"))
    tried = _windows_around(whole, hits, window, gram)
    kept = settle(tried, "tried").join(runs.select("run").distinct(), "run", "left_semi")
    return kept.select("doc_id", "text_key", "first", (F.col("first") + F.col("size")).alias("past"), "run")


def _with_hits(whole: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``whole`` that may be named in ``keys``, and a few more.

    A bit table of text keys, ``MAX_BITS`` / 8 bytes at most, keeps texts without a hit out of the shuffle.
    """
    bits = filter_bits(keys.count(), 16, MAX_BITS)
    cell = F.pmod("text_key", F.lit(bits))
    table = settle(bit_table(keys.select(cell.alias("cell")), "cell"), "hit-bits")
    return with_bits(whole, table, [cell], "_maybe").filter("_maybe").drop("_maybe")


def _windows_around(whole: DataFrame, hits: DataFrame, window: int, gram: int) -> DataFrame:
    """(doc_id, text_key, first, size, run): every window of a text around its hits, once.

    A text's hits are at most a few for each of its words, so the lists here are of the order of the text itself.
    """
    reach = window - gram
    by_text = hits.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("at", "size")).alias("hits"))
    named = by_text.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "hits")
    some = _with_hits(whole, hits.select("text_key").distinct())
    both = some.join(named, some["doc_id"].eqNullSafe(F.col("_id")) & (some["text_key"] == F.col("_key")))
    # Texts of one key are equal; one of them stands for all.
    one = both.dropDuplicates(["doc_id", "text_key"])
    ready = one.select("doc_id", "text_key", "hits", words_of(F.col("text")).alias("words"))

    def around(h: Column) -> Column:
        # A window that holds the gram begins up to ``reach`` words before it; a short item begins where its mark is.
        starts = F.when(h["size"] < window, F.array(h["at"])).otherwise(F.sequence(F.greatest(h["at"] - reach, F.lit(1)), h["at"]))
        return F.transform(starts, lambda i: F.shiftleft(i.cast("bigint"), 32).bitwiseOR(h["size"].cast("bigint")))

    # Start and size in one number, as distinct numbers are found by hashing and distinct structs by comparing all.
    windows = F.array_distinct(F.flatten(F.transform("hits", around)))

    def first(w: Column) -> Column:
        return F.shiftright(w, 32).cast("int")

    def size(w: Column) -> Column:
        return w.bitwiseAND(F.lit(_LOW)).cast("int")

    inside = F.filter(windows, lambda w: first(w) + size(w) - 1 <= F.size("words"))
    runs = F.transform(
        inside, lambda w: F.struct(first(w).alias("first"), size(w).alias("size"), _run(F.col("words"), first(w), size(w)).alias("run"))
    )
    return ready.select("doc_id", "text_key", F.explode(runs).alias("w")).select("doc_id", "text_key", "w.*")


def contamination(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    *,
    window: int = WINDOW,
    gram: int = GRAM,
    share: int = 20,
) -> DataFrame:
    """(doc_id, text_key, n_words, n_hit, n_items, items_sha256, contaminated), one row per row of ``docs``.

    A word inside any occurrence of an item's window is hit; a text is contaminated if a word is hit
    and ``share`` times the hit words are at least all its words.

    - Null and empty texts have no words; items without words have no windows; items_sha256 is then that of ''.
    - An item of fewer words than a window is one window. Items with a null id are left out of the list
      of items, but their windows hit. Items that repeat an id count once.
    - Rows that repeat an id are kept apart by their text, equal rows get equal results, a null id is an id.
    - Empty tables give an empty result, or no hits. Columns other than those named are not read.

    Documents with hits only are read a second time; counts of the others come from the words alone.
    """
    item = benchmark_items(items, item_id, item_text, window)
    runs = settle(item_windows(item), "item-windows")
    found = settle(hit_windows(docs, item, runs, doc_id, text, window, gram), "hit-windows")
    state = F.struct(F.lit(0).alias("past"), F.lit(0).cast("bigint").alias("n"))

    def cover(s: Column, x: Column) -> Column:
        return F.struct(
            F.greatest(s["past"], x["past"]).alias("past"),
            (s["n"] + F.greatest(F.lit(0), x["past"] - F.greatest(s["past"], x["first"]))).alias("n"),
        )

    # A text's windows are at most one for each of its words and lengths, its items those that it shares words with.
    spans = F.array_sort(F.collect_set(F.struct("first", "past")))
    covered = found.groupBy("doc_id", "text_key").agg(spans.alias("spans"))
    shared = found.select("doc_id", "text_key", "run").distinct().join(runs.filter("item is not null"), "run")
    listed = shared.select("doc_id", "text_key", "item").distinct().groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_list("item")).alias("names")
    )
    named = listed.select(F.col("doc_id").alias("_named"), F.col("text_key").alias("_named_key"), "names")
    same = F.col("doc_id").eqNullSafe(F.col("_named")) & (F.col("text_key") == F.col("_named_key"))
    none = F.array().cast("array<string>")
    per_text = covered.join(named, same, "left").withColumn("names", F.coalesce("names", none))
    verdicts = settle(
        per_text.select(
            F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"),
            F.aggregate("spans", state, cover, lambda s: s["n"]).alias("hit"),
            F.size("names").cast("bigint").alias("n_items"),
            F.sha2(F.array_join("names", ",").cast("binary"), 256).alias("items_sha256"),
        ),
        "verdicts",
    )
    counted = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_key"),
        F.size(words_of(F.col(text))).cast("bigint").alias("n_words"),
    )
    joined = counted.join(
        verdicts, counted["doc_id"].eqNullSafe(F.col("_id")) & (counted["text_key"] == F.col("_key")), "left"
    )
    hit = F.coalesce("hit", F.lit(0).cast("bigint"))
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return joined.select(
        "doc_id", "text_key", "n_words", hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("bigint")).alias("n_items"),
        F.coalesce("items_sha256", nothing).alias("items_sha256"),
        ((hit > 0) & (hit * share >= F.col("n_words"))).alias("contaminated"),
    )


def decontaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with the columns of ``docs``, whatever their names.

    Rows that repeat an id and its text share their fate; rows of one id with different texts don't. Null and empty
    texts stay, a null id is an id like any other. Empty tables give an empty result, or all rows.
    """
    bad = contamination(docs, items, doc_id, text, **options).filter("contaminated")
    keys = bad.select(F.xxhash64(F.col("doc_id").cast("string")).alias("_id"), F.col("text_key").alias("_text"))
    return without(docs, keys, doc_id, text)
