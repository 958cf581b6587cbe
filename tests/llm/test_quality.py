import math
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from stagedoor.llm import quality


def norm(text):
    return " ".join((text or "").lower().split())


class Plain:
    """Interpolated modified Kneser-Ney by the book, for one language."""

    def __init__(self, trusted, everything, order):
        begin = quality.BEGIN * (order - 1)
        self.order = order

        def grams(texts):
            return Counter(g for t in texts for t in [begin + norm(t)] for g in (t[i : i + order] for i in range(len(t) - order + 1)))

        counts = {order: grams(trusted)}
        for k in range(order - 1, 0, -1):
            counts[k] = Counter(g[1:] for g in counts[k + 1])
        self.counts = counts
        self.letters = len({g[-1] for g in grams(everything)})
        self.totals, self.classes, self.discounts = {}, {}, {}
        for k, c in counts.items():
            total, classes = Counter(), defaultdict(lambda: [0, 0, 0])
            for g, n in c.items():
                total[g[:-1]] += n
                classes[g[:-1]][min(n, 3) - 1] += 1
            self.totals[k], self.classes[k] = total, classes
            n = Counter(c.values())
            y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
            self.discounts[k] = [
                min(max(i - (i + 1) * y * n[i + 1] / n[i] if n[i] else 0.5 * i, 0.1), i - 0.05) for i in (1, 2, 3)
            ]

    def p(self, gram):
        if not gram:
            return 1 / self.letters
        k, context = len(gram), gram[:-1]
        total = self.totals[k][context]
        below = self.p(gram[1:])
        if not total:
            return below
        n, d = self.counts[k][gram], self.discounts[k]
        own = (n - d[min(n, 3) - 1]) / total if n else 0.0
        return own + below * sum(x * y for x, y in zip(d, self.classes[k][context], strict=True)) / total

    def perplexity(self, text):
        text = norm(text)
        if not text:
            return None
        whole = quality.BEGIN * (self.order - 1) + text
        logs = [math.log(self.p(whole[i : i + self.order])) for i in range(len(text))]
        return math.exp(-sum(logs) / len(logs))


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = {"en": ["the", "cat", "sat", "on", "mats", "a"], "de": ["der", "hund", "saß", "auf", "matten"], None: ["x", "yy"]}
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "en", "de", None])
        rows.append((i, " ".join(rng.choice(words[lang]) for _ in range(rng.randint(0, 30))), lang))
    rows += [(1_000 + i, "".join(rng.choice("#$%&qx") for _ in range(60)), "en") for i in range(10)]
    return rows


@pytest.mark.parametrize("hot, order", [(0, 3), (20, 4), (1 << 15, 4)])
def test_perplexities_equal_the_book(spark, docs, monkeypatch, hot, order):
    monkeypatch.setattr(quality, "HOT_GRAMS", hot)
    rows = corpus(hot)
    trusted = [i for i, *_ in rows if i < 80]
    frame = spark.createDataFrame([(i,) for i in trusted], "i bigint")
    out = quality.judged(docs(*rows), frame, order=order).collect()
    models = {}
    for lang in ("en", "de", None):
        mine = [(i, t) for i, t, x in rows if x == lang]
        models[lang] = Plain([t for i, t in mine if i in trusted and not held(i)], [t for _, t in mine], order)
    texts = {i: (t, lang) for i, t, lang in rows}
    assert len(out) == len(rows)
    for r in out:
        text, lang = texts[r.doc_id]
        expected = models[lang].perplexity(text)
        assert r.lang == lang and r.n_chars == len(norm(text))
        assert r.perplexity == (None if expected is None else pytest.approx(expected, rel=1e-5, abs=2e-6))
    check_thresholds(out, trusted)


def check_thresholds(out, trusted):
    limits = {}
    for lang in {r.lang for r in out}:
        values = sorted(r.perplexity for r in out if r.lang == lang and r.doc_id in trusted and held(r.doc_id) and r.perplexity)
        bins = sorted(math.ceil(round(math.log(v) * 1000, 9)) for v in values)
        if bins:
            at = next(b for i, b in enumerate(bins) if (sum(x <= b for x in bins)) / len(bins) >= quality.QUANTILE)
            limits[lang] = math.exp(at / 1000)
    for r in out:
        assert r.threshold == (pytest.approx(limits[r.lang]) if r.lang in limits else None)
        assert r.kept == (r.perplexity is None or r.threshold is None or r.perplexity <= r.threshold)


@pytest.mark.parametrize("letters, documents, order", [(40, 30, 4), (5_200, 4_200, 4), (70_000, 9_000, 4), (70_000, 300, 7)])
def test_no_character_of_a_block_is_merged(letters, documents, order):
    rng = random.Random(letters)
    signs = rng.sample([i for i in range(0x3400, 0x110000) if not 0xD800 <= i < 0xE000], letters)
    texts = [[*([2] * (order - 1)), *rng.choices(signs[:9] if i % 2 else signs, k=30)] for i in range(documents)]
    texts[0] += signs
    grams, runs, owner, counts = quality._grams([np.array(t, np.uint32) for t in texts], np.arange(documents, dtype=np.uint32), order)
    assert len(set(grams)) == len(grams)
    which = np.searchsorted(runs, np.arange(len(owner)), side="right") - 1
    found = {(grams[g], int(o)): int(n) for g, o, n in zip(which, owner, counts, strict=True)}
    shown = ["".join(map(chr, t)) for t in texts]
    assert found == Counter((t[i : i + order], d) for d, t in enumerate(shown) for i in range(len(t) - order + 1))


def test_a_full_block_of_one_language_takes_little_memory():
    rng = np.random.default_rng(3)
    points = [np.append([2, 2, 2], rng.integers(0, 8, 2_000) + 97).astype(np.uint32) for _ in range(500)]
    tracemalloc.start()
    _, _, _, counts = quality._grams(points, np.arange(500, dtype=np.uint32), 4)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert counts.sum() == 1_000_000
    assert peak < 48 * counts.sum()


def test_many_characters_in_many_short_documents(spark, docs):
    """One block with so many of both that an n-gram and its document need more than 64 bits."""
    rng = random.Random(9)
    signs = [chr(0x4E00 + i) for i in range(5_200)]
    rows = [(i, signs[i % 5_200] + "".join(rng.choice(signs[:40]) for _ in range(4)) + signs[(i + 4_300) % 5_200], "zh") for i in range(4_300)]
    trusted = [i for i, *_ in rows if i % 3]
    out = quality.judged(docs(*rows).coalesce(1), spark.createDataFrame([(i,) for i in trusted], "i bigint")).collect()
    book = Plain([t for i, t, _ in rows if i % 3 and not held(i)], [t for _, t, _ in rows], quality.ORDER)
    assert len({c for _, t, _ in rows for c in t}) > 5_000 and len(out) == len(rows)
    for r in out:
        assert r.perplexity == pytest.approx(book.perplexity(rows[r.doc_id][1]), rel=1e-5)


def test_probabilities_add_up(spark, docs):
    grams = spark.createDataFrame([(a + b + c, "en", (i * 7) % 5) for i, (a, b, c) in enumerate((a, b, c) for a in "abc" for b in "abc" for c in "abc")], "gram string, lang string, n long")
    sums = defaultdict(float)
    for r in quality.model(grams.select("lang", "gram", "n"), 3).collect():
        sums[r.gram[:2]] += math.exp(r.logp)
    assert all(s == pytest.approx(1.0) for s in sums.values()) and len(sums) == 9


def test_whole_table_keeps_clean_rows_and_drops_junk(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    kept = {r.doc_id: r.kept for r in quality.judged(docs, quality.trusted_ids(labels)).collect()}
    good = [kept[r.doc_id] for r in labels.collect() if r.quality == 1 and r.toxic == 0]
    bad = [kept[r.doc_id] for r in labels.collect() if r.quality == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.5 * len(bad)


def test_edge_cases(spark, docs, with_clashes, monkeypatch):
    monkeypatch.setattr(quality, "BLOCK_CHARS", 500)
    rows = [(i, f"the cat sat on mat {i % 7}", "en") for i in range(60)]
    rows += [(60, None, "en"), (61, "", "en"), (62, " \n", None), (None, "the cat", "en"), (1, rows[1][1], "en"), (63, "xyz", "zz"), (64, "the cat sat " * 400, "en")]
    trusted = spark.createDataFrame([(i,) for i in range(50)], "i bigint")
    out = quality.judged(with_clashes(docs(*rows)), trusted, order=3).collect()
    assert len(out) == len(rows)
    by_id = {r.doc_id: r for r in out}
    assert all(by_id[i].kept and by_id[i].perplexity is None for i in (60, 61, 62, 63))
    book = Plain([t for i, t, x in rows[:60] if i < 50 and not held(i)] + [rows[1][1]] * (not held(1)), [t for _, t, x in rows if x == "en"], 3)
    assert by_id[64].perplexity == pytest.approx(book.perplexity(rows[-1][1]), rel=1e-5)
    assert quality.judged(docs(*rows).limit(0), trusted).collect() == []
    nobody = quality.judged(docs(*rows), trusted.limit(0)).collect()
    assert all(r.kept and r.perplexity is None for r in nobody)


def test_labels_that_disagree_are_not_trusted(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (3, 0, 0), (4, 1, 0), (4, 0, 0), (None, 1, 0), (5, 1, None), (6, None, 0)], "doc_id long, quality int, toxic int")
    assert sorted(r.trusted for r in quality.trusted_ids(labels).collect()) == [1, 5]
