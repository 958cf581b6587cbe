import random
import zlib

import numpy as np
import pytest

from stagedoor.llm import language


def plain_phrases(sample, text):
    """Greedy longest matches by looking the strings up in the sample."""
    count, at = 0, 0
    while at < len(text):
        end = at + 1
        while end < len(text) and text[at : end + 1] in sample:
            end += 1
        count, at = count + 1, end
    return count


def points(text):
    return np.array([ord(c) for c in text], np.uint32)


@pytest.mark.parametrize("letters", ["abc ", "".join(map(chr, range(0x4E00, 0x4E00 + 3_000)))])
@pytest.mark.parametrize("seed", range(2))
def test_phrases_equal_string_search(seed, letters, monkeypatch):
    """Texts longer than a piece too, over few letters and over thousands, some of which the sample lacks."""
    monkeypatch.setattr(language, "PIECE", 16)
    monkeypatch.setattr(language, "COLUMNS", 7)
    rng = random.Random(seed)
    pairs = [rng.choice(letters) + rng.choice(letters) for _ in range(400)]
    sample = "".join(rng.choice(pairs) for _ in range(4_000 if len(letters) > 100 else 200))
    parser = language.Parser(points(sample))
    assert len(parser.rare) == max(0, len(set(sample)) - language.DENSE)
    texts = ["".join(rng.choice([*pairs, "é", rng.choice(letters)]) for _ in range(rng.randint(0, 90))) for _ in range(50)]
    parsed = [t for t in texts if t]
    # The text as the parser is given it: letters, and single spaces for all else.
    shown = ["".join(map(chr, language.letters_of(t))) for t in parsed]
    bits, _ = language.entropies({"x": parser}, parsed)
    found = bits[:, 0] * np.array([len(t) for t in shown]) / np.log2(parser.size)
    assert np.rint(found).astype(int).tolist() == [plain_phrases(sample, t) for t in shown]


def test_letters():
    shown = "".join(map(chr, language.letters_of("  Hello, WÖRLD!! 42 x")))
    assert shown == "hello wörld x"
    assert len(language.letters_of("")) == 0


def test_long_texts_are_parsed_whole():
    parsers = {k: language.Parser(language.letters_of(v * 20)) for k, v in {"a": "lorem ipsum dolor ", "b": "quick brown fox "}.items()}
    text = "lorem ipsum " * 900 + "quick brown fox " * 1_600
    bits, has_letter = language.entropies(parsers, [text, None, "12"])
    assert bits[0].argmin() == 1 and has_letter.tolist() == [True, False, False]


def test_held_out_accuracy(spark):
    path = "/root/testdata/sf0.01/documents.parquet"
    docs = spark.read.parquet(path)
    labels = {r.doc_id: (r.lang, r.text) for r in docs.select("doc_id", "lang", "text").collect()}
    out = language.identify(docs).collect()
    assert sorted(r.doc_id for r in out) == sorted(labels)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.held_out]
    assert sum(r.lang_pred == labels[r.doc_id][0] for r in held) >= 0.97 * len(held) > 100


def test_labels_of_held_out_rows_and_ids_are_not_used(spark, documents):
    from pyspark.sql import functions as F

    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    masked = documents.withColumn("lang", F.when(~held, F.col("lang"))).withColumn("source", F.lit(None).cast("string"))
    assert sorted(language.identify(masked).collect()) == sorted(language.identify(documents).collect())


def test_edge_cases(docs, with_clashes):
    rows = [(i, "lorem ipsum dolor sit amet", "la") for i in range(20)] + [(i, "quick brown foxes jump", "en") for i in range(20, 40)]
    rows += [(50, None), (51, ""), (52, "12 34 --"), (None, "lorem ipsum"), (53, "dolor sit " * 50_000), (50, None), (54, "quick", None), (55, "ж")]
    out = language.identify(with_clashes(docs(*rows))).collect()
    assert len(out) == len(rows)
    found = {(r.doc_id, r.lang_pred) for r in out if (r.doc_id or 99) >= 50}
    assert {(50, "und"), (51, "und"), (52, "und"), (None, "la"), (53, "la"), (54, "en")} <= found
    assert all(r.score == 0 for r in out if r.lang_pred == "und")
    assert language.identify(docs(*rows).limit(0)).collect() == []
    unlabelled = docs((1, "text", None), (2, "more", None))
    assert {r.lang_pred for r in language.identify(unlabelled).collect()} == {"und"}
