"""Secrets in text, with multipart credentials linked; DataFrame functions only.

Three kinds of span are reported wherever they occur (base). Three weaker kinds are reported only beside
what completes them: an account name beside a secret, a bare key beside an access identifier or an
endpoint, an endpoint beside a secret. "Beside" is an interval join within a text: every span has a scope
that reaches ``reach`` characters to both sides. Text positions are cut into buckets, so the join is
one of equal buckets with the overlap as a further condition, and it keeps a candidate or not
instead of returning pairs.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagedoor.session import settle

# The base patterns and their least lengths, as contracted; order is the order of kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]+"
ACCESS_LEAST = 20
HEX = r"[0-9a-f]+"
HEX_LEAST = 24

# Weak kinds. A bare key has 32 characters or more, letters of both cases and digits.
ACCOUNT = r"""(?i)(?<![A-Za-z0-9_])(?:user(?:_?name)?|login|client_?id|account_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}"""
BARE_KEY = r"[A-Za-z0-9+/_-]{32,}={0,2}"
ENDPOINT = (
    r"""(?i)(?<![A-Za-z0-9_])(?:https?|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)"""
    r"""://[^\x00-\x20"'<>]+"""
)

KINDS = ("assign", "access", "hex", "account", "key", "endpoint")
BASE = KINDS[:3]
# What each kind is part of a credential as, and what completes a weak kind.
ROLES = {"assign": "secret", "hex": "secret", "key": "secret", "access": "id", "account": "id", "endpoint": "endpoint"}
COMPLETED_BY = {"account": ("secret",), "key": ("id", "endpoint"), "endpoint": ("secret",)}
REACH = 200


def _matches(text: Column, pattern: str, prefilter: str | None = None) -> Column:
    """Leftmost non-overlapping matches as an array of (gap, value): characters since the last one, and the match.

    Splitting by a pattern gives what lies between its matches, so lengths add up to positions. Texts
    without a match take neither pass.
    """
    outer = pattern.replace("(?i)", "(?i)(", 1) + ")" if pattern.startswith("(?i)") else f"({pattern})"
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    pairs = F.arrays_zip(gaps.alias("gap"), F.regexp_extract_all(text, F.lit(outer), F.lit(1)).alias("value"))
    return F.when(text.rlike(prefilter or pattern), pairs)


def candidates(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(row, doc_id, and a column of matches for each kind), one row per row of ``docs``."""
    value = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).alias("doc_id"),
        _matches(value, ASSIGN).alias("assign"),
        # A run of these characters that is too short can't hold a match that is long enough.
        _matches(value, rf"AKIA[A-Z0-9]{{{ACCESS_LEAST - 4},}}").alias("access"),
        _matches(value, rf"[0-9a-f]{{{HEX_LEAST},}}").alias("hex"),
        _matches(value, ACCOUNT).alias("account"),
        _matches(value, BARE_KEY).alias("key"),
        _matches(value, ENDPOINT).alias("endpoint"),
    )


def spans(found: DataFrame) -> DataFrame:
    """(row, kind, start, past): spans of all kinds that pass their own conditions."""
    kinds = F.array(*(F.struct(F.lit(k).alias("kind"), F.col(k).alias("m")) for k in KINDS))
    by_kind = found.select("row", F.explode(kinds).alias("k")).select("row", "k.kind", "k.m")
    each = by_kind.select("row", "kind", F.posexplode("m").alias("i", "m")).filter("m.value is not null")
    size = F.length("m.value")
    so_far = F.sum(F.col("m.gap") + size).over(Window.partitionBy("row", "kind").orderBy("i"))
    placed = each.select(
        "row", "kind", (so_far - size).alias("start"), so_far.alias("past"), F.col("m.value").alias("value")
    )
    kind, value = F.col("kind"), F.col("value")
    mixed = value.rlike("[a-z]") & value.rlike("[A-Z]") & value.rlike("[0-9]")
    right = (
        F.when(kind == "assign", F.length(F.regexp_extract(value, ASSIGN, 2)) >= ASSIGN_LEAST)
        .when(kind == "key", mixed)
        .otherwise(F.lit(True))
    )
    return placed.filter(right).drop("value")


def _in_buckets(spans: DataFrame, first: Column, past: Column, width: int) -> DataFrame:
    bucket = F.explode(F.sequence(F.floor(first / width), F.floor((past - 1) / width)))
    return spans.withColumn("bucket", bucket)


def linked(all_spans: DataFrame, reach: int = REACH) -> DataFrame:
    """(row, kind, start, past): weak spans that a complementary span completes.

    A weak span of the same role as a base span that it overlaps is the base span's, and left out.
    """
    role = F.element_at(F.create_map(*(F.lit(x) for pair in ROLES.items() for x in pair)), F.col("kind"))
    parts = all_spans.withColumn("role", role)
    weak = parts.filter(~F.col("kind").isin(*BASE))
    others = parts.select("row", *(F.col(c).alias(f"other_{c}") for c in ("kind", "role", "start", "past")))
    others = _in_buckets(others, F.col("other_start"), F.col("other_past"), reach)
    same_place = ["row", "bucket"]

    at_base = (
        (F.col("role") == F.col("other_role"))
        & F.col("other_kind").isin(*BASE)
        & (F.col("start") < F.col("other_past"))
        & (F.col("other_start") < F.col("past"))
    )
    equal = [F.col(f"w.{c}") == F.col(f"o.{c}") for c in same_place]
    touching = _in_buckets(weak, F.col("start"), F.col("past"), reach)
    taken = touching.alias("w").join(others.alias("o"), [*equal, at_base], "left_semi").drop("bucket").distinct()
    free = weak.join(taken, weak.columns, "left_anti")

    low, high = F.greatest(F.col("start") - reach, F.lit(0)), F.col("past") + reach
    completes = F.lit(False)
    for kind, roles in COMPLETED_BY.items():
        completes = completes | ((F.col("kind") == kind) & F.col("other_role").isin(*roles))
    within = (F.col("other_start") < high) & (F.col("other_past") > low)
    scoped = _in_buckets(free, low, high, reach)
    kept = scoped.alias("w").join(others.alias("o"), [*equal, completes, within], "left_semi")
    return kept.select("row", "kind", "start", "past").distinct()


def secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, reach: int = REACH) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans), one row per row of ``docs``.

    A span is written kind:start:end in code points, end exclusive; lists are ordered by start, then kind.

    - Null texts are empty, and empty texts have no spans: counts 0, an empty list, the SHA-256 of ''.
    - Null and repeated ids and repeated rows are kept apart, each row having its own spans.
    - An empty table gives an empty result; columns other than the two named are not read.
    """
    found = settle(candidates(docs, doc_id, text), "candidates")
    placed = settle(spans(found), "spans")
    base = placed.filter(F.col("kind").isin(*BASE))
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    label = F.concat_ws(":", "kind", "start", "past")
    listed = base.withColumn("base", F.lit(True)).unionByName(
        linked(placed, reach).withColumn("base", F.lit(False))
    )
    per_row = listed.groupBy("row").agg(
        *(F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in BASE),
        F.array_sort(F.collect_list(F.struct("start", order.alias("order"), label.alias("label"), "base"))).alias("all"),
    )
    base_labels = F.array_join(F.transform(F.filter("all", lambda s: s["base"]), lambda s: s["label"]), ",")
    all_labels = F.array_join(F.transform("all", lambda s: s["label"]), ",")
    counted = found.select("row", "doc_id").join(per_row, "row", "left")
    zero = F.lit(0).cast("bigint")
    return counted.select(
        "doc_id",
        *(F.coalesce(f"n_{k}", zero).alias(f"n_{k}") for k in BASE),
        F.sha2(F.coalesce(base_labels, F.lit("")).cast("binary"), 256).alias("base_sha256"),
        F.coalesce(all_labels, F.lit("")).alias("spans"),
    )
