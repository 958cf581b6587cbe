import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from stagedoor.llm import merkle, registry

COLUMNS = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def lowered(row):
    text = row[4] and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row[4])
    return (*row[:4], text)


def levels_of(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def path_of(levels, i):
    out = []
    for level in levels[:-1]:
        first = i // 16 * 16
        run = level[first : first + 16]
        out.append((run[: i - first], run[i - first + 1 :]))
        i //= 16
    return out


def by_hand(rows):
    sources = {}
    for row in rows:
        sources.setdefault(row[1], []).append(row)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        ordered = sorted(((r, leaf_of(r)) for r in sources[s]), key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[s] = ordered, levels_of([leaf for _, leaf in ordered])
    top = levels_of([trees[s][1][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        ordered, levels = trees[s]
        for i, (row, leaf) in enumerate(ordered):
            path = path_of(levels, i) + path_of(top, k)
            up = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                up = leaf_of(lowered(row))
            for left, right in path:
                up = h(*left, up, *right)
            proof = h(*(x for left, right in path for x in left + right))
            out.append((row[0], leaf, levels[-1][0], top[-1][0], proof, up, up == top[-1][0]))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, merkle.verified(merkle.manifest(df, tampered=merkle.lower_case_tampering())).collect()), key=str)


def test_whole_table_by_hand_and_in_sql(spark, folder, documents):
    rows = [tuple(r) for r in documents.select(*merkle.FIELDS).collect()]
    result = sorted(map(tuple, registry.op12_merkle_manifest(spark, folder).collect()), key=str)
    assert result == by_hand(rows)
    engine = duckdb.connect()
    engine.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    assert sorted(engine.execute(registry.statements()["op12_merkle_manifest"]).fetchall(), key=str) == result
    # Tampering shows where it changes something, and nowhere else.
    texts = {r[0]: r for r in rows}
    for r in result:
        same = zlib.crc32(str(r[0]).encode()) % 5 or lowered(texts[r[0]]) == texts[r[0]]
        assert r[6] == bool(same)


@pytest.mark.parametrize("sizes", [[1], [1] * 18, [300, 1, 17, 16, 257]])
def test_trees_of_all_shapes(spark, sizes):
    rows = [(1000 * s + i, f"s{s:02d}", "en", i, f"Text {i}") for s, n in enumerate(sizes) for i in range(n)]
    random.Random(0).shuffle(rows)
    assert found(spark.createDataFrame(rows, COLUMNS)) == by_hand(rows)


def test_edge_cases(spark, with_clashes):
    rows = [
        (1, None, None, None, None), (None, "a", "en", 3, "ABC"), (None, "a", "en", 3, "abc"), (5, "a", "en", 0, ""), (5, "a", "en", 0, ""),
        (5, "a", "en", 0, None), (-7, "a", "en", 0, "É"), (10, "é", "en", 4, "-"), (11, "Z", "en", 1, "1:x"), (12, "", "", 1, "L" * 300_000),
    ]
    df = spark.createDataFrame(rows, COLUMNS)
    assert found(with_clashes(df)) == by_hand(rows)
    assert found(df.limit(0)) == []


def test_another_fanout_and_extra_fields(spark):
    df = spark.range(50).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("x").alias("mark"))
    made = merkle.manifest(df, ("doc_id", "mark"), fanout=3)
    assert merkle.verified(made).filter("verified").count() == 50
    assert {len(r.path) for r in made.collect()} == {4}  # 3 ** 4 covers 50 leaves
    forged = merkle.manifest(df, ("doc_id", "mark"), fanout=3, tampered=F.when(F.col("doc_id") == 7, F.sha2(F.lit("x").cast("binary"), 256)))
    assert [r.doc_id for r in merkle.verified(forged).filter("not verified").collect()] == [7]
