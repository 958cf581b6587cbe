"""The corpus queries: each applies one operator to its whole table."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagedoor.llm import alignment, arc_warc, decontaminate, exact_dedup, language, merkle, mixing, packing, pii, quality, secret_scan, sharding, simhash
from stagedoor.llm.common import table
from stagedoor.session import fresh_path

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = [f"shard-{i:03d}" for i in range(64)]


def op1_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its fingerprint and its component of near duplicates."""
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page with its record in the WARC archives that its legacy archive is converted to.

    The old archives are files of both versions.
    """
    arc, warc = fresh_path(spark, "arc"), fresh_path(spark, "warc")
    arc_warc.write_arc(table(spark, folder, "pages"), arc)
    arc_warc.convert(spark, arc, warc)
    return arc_warc.read_warc(spark, warc).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op3_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its share of words in benchmark windows."""
    found = decontaminate.contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )
    return found.drop("text_key")


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its predicted language."""
    return language.identify(table(spark, folder, "documents"))


def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's slot and shard, of 64 shards."""
    return sharding.shard_documents(table(spark, folder, "documents"), SHARDS)


def op6_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the secrets in it."""
    return secret_scan.secrets(table(spark, folder, "documents"))


def op7_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Every segment of the packed documents, read back from the written matrices."""
    path = fresh_path(spark, "packed")
    packing.write_packed(table(spark, folder, "documents"), packing.public_vocabulary(), path)
    return packing.read_segments(spark, path)


def op8_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its perplexity, and whether it stays."""
    trusted = quality.trusted_ids(table(spark, folder, "labels"))
    return quality.judged(table(spark, folder, "documents"), trusted).drop("id", "text_key")


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the document that stays for its normalised text."""
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"))


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the words that the mix takes of it."""
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
        "source", "rate", "copies",
    )


def op11_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the personal data in it."""
    return pii.digest_columns(pii.personal_spans(table(spark, folder, "documents"), pii.train()))


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's place in the manifest, and whether its leaf, which may be tampered with, leads to the root."""
    return merkle.verified(merkle.manifest(table(spark, folder, "documents"), tampered=merkle.lower_case_tampering()))


def op13_cross_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's groups and links between a byte-level and a piece vocabulary."""
    return alignment.alignment(table(spark, folder, "documents"), alignment.public_vocabularies())


def queries() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (op1_simhash_near_dedup, op2_warc, op3_benchmark_decontamination, op4_language_id, op5_sharding, op6_secret_scans, op7_token_ids, op8_quality_classifier, op9_exact_dedup, op10_mixing, op11_pii, op12_merkle_manifest, op13_cross_tokenizer_alignment)
    }


def statements() -> dict[str, str]:
    """The same in DuckDB's SQL, where SQL can express it."""
    return {"op2_warc": _WARC, "op3_benchmark_decontamination": _DECONTAMINATION, "op6_secret_scans": _secrets(), "op9_exact_dedup": _EXACT_DEDUP, "op12_merkle_manifest": _merkle()}


_EXACT_DEDUP = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""

_WARC = """
WITH
p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
bits AS (SELECT page_id, strlen(html) AS payload_bytes,
           list_aggregate(list_transform(string_split(sha1(html), ''), lambda c: ['0000', '0001', '0010', '0011', '0100', '0101', '0110',
             '0111', '1000', '1001', '1010', '1011', '1100', '1101', '1110', '1111'][strpos('0123456789abcdef', c)]), 'string_agg', '') AS b
         FROM p),
digests AS (SELECT page_id, payload_bytes, list_aggregate(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
              CAST(1 + 16 * CAST(substr(b, 5 * k + 1, 1) AS INT) + 8 * CAST(substr(b, 5 * k + 2, 1) AS INT)
                + 4 * CAST(substr(b, 5 * k + 3, 1) AS INT) + 2 * CAST(substr(b, 5 * k + 4, 1) AS INT)
                + CAST(substr(b, 5 * k + 5, 1) AS INT) AS BIGINT), 1)), 'string_agg', '') AS payload_digest
            FROM bits),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS f FROM digests)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM f THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM f THEN f END AS refers_to
FROM firsts
"""

_DECONTAMINATION = r"""
WITH
d AS (SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item, least(len(w), 13) AS n, w[p : p + least(len(w), 13) - 1] AS run
       FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS p FROM i WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT r, n, p, w[p : p + n - 1] AS run
       FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, lengths WHERE len(w) >= n)),
hit AS (SELECT r, p, dw.n, item FROM dw JOIN iw ON dw.n = iw.n AND dw.run = iw.run),
covered AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM hit) GROUP BY r),
named AS (SELECT r, count(DISTINCT item) AS n_items, sha256(string_agg(DISTINCT item, ',' ORDER BY item)) AS h FROM hit GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""


def _merkle() -> str:
    """Levels, proofs and folding by recursion; the checksum bit by bit."""

    def leaf(text: str) -> str:
        values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
        return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"

    upper, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH RECURSIVE
d AS (SELECT row_number() OVER () AS r, doc_id, source, {leaf("text")} AS leaf, {leaf(f"translate(text, '{upper}', '{small}')")} AS lowered,
        xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
          lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) AS crc
      FROM documents),
leaves AS (SELECT *, CASE WHEN crc % 5 = 0 THEN lowered ELSE leaf END AS claimed,
             row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY source) AS n FROM d),
nodes AS (SELECT source, 0 AS level, place, leaf AS digest, n FROM leaves
  UNION ALL SELECT source, level + 1, place // 16, sha256(string_agg(digest, '' ORDER BY place)), (n + 15) // 16
            FROM nodes WHERE n > 1 GROUP BY source, level, place // 16, n),
subroots AS (SELECT source, digest, level AS height, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (SELECT 0 AS level, place, digest, n FROM subroots
  UNION ALL SELECT level + 1, place // 16, sha256(string_agg(digest, '' ORDER BY place)), (n + 15) // 16 FROM tops WHERE n > 1 GROUP BY level, place // 16, n),
root AS (SELECT digest FROM tops WHERE n = 1),
beside AS (
  SELECT r, level, coalesce(string_agg(digest, '' ORDER BY k.place) FILTER (k.place < l.place >> (4 * level)), '') AS a,
         coalesce(string_agg(digest, '' ORDER BY k.place) FILTER (k.place > l.place >> (4 * level)), '') AS b
  FROM leaves l JOIN nodes k ON k.source IS NOT DISTINCT FROM l.source AND k.n > 1 AND k.place // 16 = l.place >> (4 * level + 4) GROUP BY r, level
  UNION ALL
  SELECT r, height + level, coalesce(string_agg(k.digest, '' ORDER BY k.place) FILTER (k.place < s.place >> (4 * level)), ''),
         coalesce(string_agg(k.digest, '' ORDER BY k.place) FILTER (k.place > s.place >> (4 * level)), '')
  FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source JOIN tops k ON k.n > 1 AND k.place // 16 = s.place >> (4 * level + 4) GROUP BY r, height, level),
up AS (SELECT r, 0 AS level, claimed AS digest FROM leaves
  UNION ALL SELECT up.r, up.level + 1, sha256(a || digest || b) FROM up JOIN beside ON beside.r = up.r AND beside.level = up.level),
folded AS (SELECT r, arg_max(digest, level) AS folded_root FROM up GROUP BY r),
proofs AS (SELECT r, sha256(string_agg(a || b, '' ORDER BY level)) AS proof_sha256 FROM beside GROUP BY r)
SELECT doc_id, leaf, s.digest AS subroot, root.digest AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root,
       folded_root = root.digest AS verified
FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source JOIN folded USING (r) LEFT JOIN proofs USING (r), root
"""


def _secrets() -> str:
    """Positions from what lies between matches, as in the query; links by comparing spans of a text."""
    patterns = {
        "assign": secret_scan.ASSIGN, "access": "AKIA[A-Z0-9]{16,}", "hex": "[0-9a-f]{24,}",
        "account": secret_scan.ACCOUNT, "key": secret_scan.BARE_KEY, "endpoint": secret_scan.ENDPOINT,
    }
    rows = ",\n         ".join(
        "('{}', {}, '{}', '{}')".format(
            kind, i, secret_scan.ROLES[kind], p.replace("(?<![A-Za-z0-9_])", r"\b").replace("'", "''")
        )
        for i, (kind, p) in enumerate(patterns.items())
    )
    completes = " OR ".join(
        f"(w.kind = '{kind}' AND o.role IN ({', '.join(map(repr, roles))}))"
        for kind, roles in secret_scan.COMPLETED_BY.items()
    )
    assign, reach = secret_scan.ASSIGN.replace("'", "''"), secret_scan.REACH
    return f"""
WITH
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
kinds(kind, place, role, pattern) AS (VALUES {rows}),
found AS (SELECT r, kind, place, role, unnest(string_split_regex(t, pattern)) AS gap,
            unnest(regexp_extract_all(t, pattern, 0)) AS v, unnest(range(len(string_split_regex(t, pattern)))) AS i
          FROM d, kinds WHERE regexp_matches(t, pattern)),
placed AS (SELECT *, sum(len(gap) + len(v)) OVER (PARTITION BY r, kind ORDER BY i) AS past FROM found WHERE v IS NOT NULL),
spans AS (SELECT r, kind, place, role, past - len(v) AS start, past, place < 3 AS base FROM placed
          WHERE CASE kind WHEN 'assign' THEN len(regexp_extract(v, '{assign}', 2)) >= 6
            WHEN 'key' THEN regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]') AND regexp_matches(v, '[0-9]') ELSE true END),
weak AS (SELECT * FROM spans w WHERE NOT base AND NOT EXISTS (
    SELECT 1 FROM spans o WHERE o.r = w.r AND o.base AND o.role = w.role AND w.start < o.past AND o.start < w.past)),
kept AS (SELECT * FROM spans WHERE base UNION ALL SELECT * FROM weak w WHERE EXISTS (
    SELECT 1 FROM spans o WHERE o.r = w.r AND ({completes})
      AND o.start < w.past + {reach} AND o.past > greatest(w.start - {reach}, 0))),
listed AS (SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
             count(*) FILTER (kind = 'hex') AS n_hex,
             string_agg(kind || ':' || start || ':' || past, ',' ORDER BY start, place) FILTER (base) AS bases,
             string_agg(kind || ':' || start || ':' || past, ',' ORDER BY start, place) AS spans
           FROM kept GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(bases, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN listed USING (r)
"""
