import hashlib
import random
import re

import pytest

from stagedoor.llm import decontaminate

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def plain(documents, items, window=13):
    runs = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            runs.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    out = []
    for doc, text in documents:
        w, hit, names = words(text), set(), set()
        for n in {len(r) for r in runs}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in runs:
                    hit |= set(range(i, i + n))
                    names |= runs[tuple(w[i : i + n])]
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((str(doc), len(w), len(hit), len(names), digest, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out)


def found(df):
    return sorted(
        (str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()
    )


def table(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def test_documents_equal_brute_force(spark, folder, documents):
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    expected = plain([(r.doc_id, r.text) for r in documents.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert found(decontaminate.contamination(documents, items)) == expected
    assert any(row[5] for row in expected)


@pytest.mark.parametrize("seed", range(3))
def test_repetitive_words_equal_brute_force(spark, docs, seed):
    """Few different words, so windows overlap, repeat, tie, and items share them; short items as well."""
    rng = random.Random(seed)

    def text(n):
        return " ".join(rng.choice(["a", "B", "cé"]) for _ in range(n))

    items = [(i, text(rng.choice([1, 3, 12, 13, 14, 40]))) for i in range(8)]
    long = [(i, " ".join(f"w{rng.randint(0, 400)}" for _ in range(60))) for i in range(8, 16)]
    rows = [(i, text(rng.randint(0, 60))) for i in range(20)]
    for i in range(20, 60):
        w = words(rng.choice(long)[1])
        a = rng.randint(0, 50)
        rows.append((i, text(rng.randint(0, 30)) + " " + " ".join(w[a : a + rng.randint(8, 30)]) + " " + text(9)))
    benchmark = items[rng.randint(0, 4) :] + long
    result = decontaminate.contamination(docs(*rows), table(spark, benchmark))
    assert found(result) == plain(rows, benchmark)


def test_every_long_span_has_a_fingerprint_in_common(spark):
    from pyspark.sql import functions as F

    rng = random.Random(4)
    span = [f"s{rng.randint(0, 9)}" for _ in range(13)]
    rows = [(" ".join([*(f"x{rng.random()}" for _ in range(rng.randint(0, 20))), *span, "y", "z"]),) for _ in range(40)]
    df = spark.createDataFrame(rows, "text string").withColumn("w", F.split("text", " "))
    marks = df.select(F.transform(decontaminate.fingerprints(F.col("w")), lambda p: F.shiftrightunsigned(p, 31)).alias("m"))
    sets = [set(r.m) for r in marks.collect()]
    assert set.intersection(*sets)


def test_edge_cases(spark, docs, with_clashes):
    span = " ".join(f"w{i}" for i in range(13))
    rows = [
        (1, None), (2, ""), (3, "..."), (None, span), (4, span.upper()), (4, span), (4, "other text"), (5, span + " x" * 500),
        (6, f"{span} {span}"), (6, f"{span} {span}"), (7, span.rsplit(" ", 1)[0]), (8, "filler " * 30_000 + span),
    ]
    items = [(1, span), (1, span), (None, span), (2, None), (3, "---"), (10, span + " tail")]
    expected = plain(rows, [(i, t) for i, t in items if i is not None])
    result = decontaminate.contamination(with_clashes(docs(*rows)), table(spark, items))
    assert found(result) == expected
    assert found(decontaminate.contamination(docs(*rows), table(spark, []))) == plain(rows, [])
    assert decontaminate.contamination(docs(*rows).limit(0), table(spark, items)).collect() == []


def test_items_without_an_id_hit_by_their_own_text(spark, docs):
    """Long and short texts that only null ids have, one that an id has too, and an id with two texts."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(15)) for x in "abcd")
    rows = [(1, f"x {a} y"), (2, f"{b} tail"), (3, "one short item"), (4, f"{c} {a}"), (5, d), (6, "nothing of these"), (None, b)]
    items = [(None, a), (None, b), (None, "short item"), (7, c), (None, c), (7, d)]
    named = {r[0]: r[2:] for r in plain(rows, [(i, t) for i, t in items if i is not None])}
    hit = {r[0]: r[:3] for r in plain(rows, items)}
    expected = sorted((*hit[i], *named[i][1:3], hit[i][2] > 0 and 20 * hit[i][2] >= hit[i][1]) for i in hit)
    assert found(decontaminate.contamination(docs(*rows), table(spark, items))) == expected
    assert [r[2] for r in expected] == [15, 15, 2, 30, 15, 0, 15]
    kept = decontaminate.decontaminated(docs(*rows), table(spark, items))
    assert [r.doc_id for r in kept.collect()] == [6]


def test_decontaminated_keeps_clean_rows(spark, docs, with_clashes):
    span = " ".join(f"w{i}" for i in range(13))
    rows = with_clashes(docs((1, span), (2, "clean"), (None, span), (3, None), (2, "clean")))
    kept = decontaminate.decontaminated(rows, table(spark, [(1, span)]))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "2", "3"] and kept.columns == rows.columns


def test_repeated_words_and_shared_passages_stay_linear(spark, docs):
    """20,000 equal words against an item of 5,000, and one passage in every document and item."""
    import time

    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(1, "word " * 20_000), (2, "word " * 12), (3, "a b " * 5_000 + passage), *((i, f"x{i} {passage} y{i}") for i in range(10, 300))]
    items = [(1, "word " * 5_000), (2, "word"), *((i, f"u{i} {passage} v{i}") for i in range(10, 60))]
    started = time.monotonic()
    result = found(decontaminate.contamination(docs(*rows), table(spark, items)))
    assert time.monotonic() - started < 120
    assert result == plain(rows, items)
