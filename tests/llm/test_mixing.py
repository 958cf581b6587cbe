import itertools
import math
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stagedoor.llm import mixing


def plain_targets(sizes):
    """{source: target} by sharing out, capping, and sharing the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, limit = 1.5 * sum(sizes.values()), {s: 2.0 * sizes[s] for s in names}
    target, full = {}, set()
    while True:
        rest = total - sum(limit[s] for s in full)
        open_ = [s for s in names if s not in full]
        target = {s: limit[s] for s in full} | {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        above = {s for s in open_ if target[s] > limit[s]}
        if not above:
            return target
        full |= above


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(rows, result, close=0.02):
    out = result.collect()
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for i, text, _, source in rows:
        sizes[source] += words(text)
    for r in out:
        assert r["size"] * r.copies <= 2 * r["size"] and r.copies in (0, 1, 2)
        assert r.source_size == sizes[r.source]
        taken[r.source] += r["size"] * r.copies
        target[r.source] = r.target
    assert sorted((str(r.doc_id), r["size"]) for r in out) == sorted((str(i), words(t)) for i, t, *_ in rows)
    expected = plain_targets(sizes)
    for s, t in expected.items():
        assert target[s] == pytest.approx(t, rel=1e-9)
        assert abs(taken[s] - t) <= max(close * t, 2), s
    return sorted((str(r.doc_id), r["size"], r.copies) for r in out)


def test_whole_table(documents):
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in documents.collect()]
    first = check(rows, mixing.mix(documents), 0.05)
    assert check(rows, mixing.mix(documents.repartition(7)), 0.05) == first


def test_hot_source_in_many_blocks(docs, with_clashes):
    rng = random.Random(3)
    rows = [(i, "w " * int(rng.paretovariate(1.1)), "en", "hot" if i % 3 else f"s{i % 12}") for i in range(3_000)]
    rows += [(9_000, "long " * 40_000, "en", "hot"), (9_001, None, "en", None), (9_002, "a b", "en", None)]
    result = mixing.mix(with_clashes(docs(*rows)), block_rows=100)
    check(rows, result)


def test_edge_cases(docs):
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (None, "x y z", "en", "b"), (3, "w", None, "é"), (3, "w", None, "é"),
        (4, "p q", "en", ""), (5, " \t ", "en", "empty"), (6, "a b c d", "en", None),
    ]
    check(rows, mixing.mix(docs(*rows)), 1.0)
    assert mixing.mix(docs(*rows).limit(0)).collect() == []
    lone = mixing.mix(docs((1, None), (2, "")))
    assert [(r["size"], r.target) for r in lone.collect()] == [(0, 0.0), (0, 0.0)]


def test_rates_tilt_by_size_to_their_targets(docs):
    """Documents of a source have rates of their own, on one logistic curve, and expect the target."""
    rows = [(i, "w " * (i % 50 + 1), "en", f"s{i % 7}") for i in range(700)]
    by_source = defaultdict(list)
    for r in mixing.mix(docs(*rows)).collect():
        by_source[r.source].append((r["size"], r.rate, r.source_size, r.target))
    for found in by_source.values():
        size, target = found[0][2:]
        assert sum(s * rate for s, rate, *_ in found) == pytest.approx(target, rel=1e-4)
        if 0 < target < 2 * size:
            assert len({rate for _, rate, *_ in found}) > 5
            tilts = [math.log(rate / (2 - rate)) / s for s, rate, *_ in found if 0.01 < rate < 1.99]
            assert max(tilts) - min(tilts) <= 1e-5 * max(map(abs, tilts))
        else:
            assert {rate for _, rate, *_ in found} == {2.0 if target else 0.0}


def test_multipliers_equal_plain_bisection(docs):
    rng = random.Random(8)
    rows = [(i, "w " * int(rng.paretovariate(0.9)), "en", f"s{i % 5}") for i in range(600)]
    for source, found in itertools.groupby(sorted(mixing.mix(docs(*rows)).collect(), key=lambda r: r.source), key=lambda r: r.source):
        found = list(found)
        sizes, target = [r["size"] for r in found], found[0].target
        if target >= 2 * sum(sizes):
            continue
        mean, low, high = sum(sizes) / len(sizes), -1e4, 1e4
        for _ in range(200):
            middle = (low + high) / 2
            taken = sum(2 * s / (1 + math.exp(min(700, -middle * s / mean))) for s in sizes)
            low, high = (middle, high) if taken < target else (low, middle)
        for r in found:
            assert r.rate == pytest.approx(2 / (1 + math.exp(min(700, -low * r["size"] / mean))), abs=1e-4), source


def test_mixed_documents_are_repeated_as_taken(docs, with_clashes):
    rows = docs(*((i, "w " * (i % 9), "en", f"s{i % 4}") for i in range(200)), (None, "n n", "en", None), (5, "w " * 5, "en", "s1"))
    rows = with_clashes(rows)
    mixed = mixing.mixed_documents(rows)
    assert mixed.columns == rows.columns
    expected = mixing.mix(rows).groupBy("doc_id", "source").agg(F.sum("copies").alias("n")).filter("n > 0")
    got = mixed.groupBy("doc_id", "source").count()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, expected.collect())))
