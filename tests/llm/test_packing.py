import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stagedoor.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def vocabulary():
    return packing.public_vocabulary()


@pytest.mark.parametrize("seed", range(4))
def test_best_fit_equals_looking_at_every_row(seed):
    rng = random.Random(seed)
    sizes = [rng.randint(1, 50) for _ in range(300)] + [50, 1]
    rows, expected = [], [None] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [r for r in range(len(rows)) if rows[r] >= sizes[i]]
        if not fits:
            rows.append(50)
            fits = [len(rows) - 1]
        best = min(fits, key=lambda r: rows[r])
        expected[i] = rows[best]
        rows[best] -= sizes[i]
    places, used = packing.pack(sizes, 50)
    assert used == len(rows) and [50 - offset for _, offset in places] == expected
    free = defaultdict(set)
    for (row, offset), size in zip(places, sizes, strict=True):
        taken = set(range(offset, offset + size))
        assert max(taken) < 50 and not taken & free[row]
        free[row] |= taken


def rebuilt(matrices, vocabulary):
    """{(doc_id, ...): texts} from the matrices' binary columns alone."""
    bytes_of = {rank: token for token, rank in vocabulary.ranks().items()}
    texts, parts = [], defaultdict(dict)
    for m in matrices:
        ids = np.frombuffer(m.ids, f"<u{m.id_bytes}")
        assert len(ids) == m.n_rows * m.row_tokens and m.cu_seqlens[-1] == len(ids)
        assert m.position_resets == m.cu_seqlens[:-1] and {r * m.row_tokens for r in range(m.n_rows)} <= set(m.cu_seqlens)
        for doc, piece, pieces, a, b in zip(m.doc_ids, m.piece, m.pieces, m.cu_seqlens, m.cu_seqlens[1:], strict=False):
            if piece < 0:
                assert (ids[a:b] == vocabulary.end).all()
            elif pieces == 1:
                texts.append((doc, ids[a:b]))
            else:
                parts[doc, piece].setdefault("all", []).append((pieces, ids[a:b]))
    longest = defaultdict(list)
    for (doc, piece), found in sorted(parts.items(), key=lambda x: (str(x[0][0]), x[0][1])):
        longest[doc].append((piece, found["all"]))
    for doc, pieces in longest.items():
        copies = len(pieces[0][1])
        assert [p for p, _ in pieces] == list(range(pieces[0][1][0][0]))
        for c in range(copies):
            texts.append((doc, np.concatenate([found[c][1] for _, found in pieces])))
    out = []
    for doc, ids in texts:
        assert ids[-1] == vocabulary.end
        out.append((str(doc), b"".join(bytes_of[int(i)] for i in ids[:-1]).decode()))
    return sorted(out)


def test_documents_come_back_byte_by_byte(documents, vocabulary):
    matrices = packing.packed(documents, vocabulary).collect()
    assert rebuilt(matrices, vocabulary) == sorted((str(r.doc_id), r.text or "") for r in documents.collect())


def test_edge_cases(docs, with_clashes, vocabulary):
    rows = [
        (1, None), (2, ""), (None, "no id"), (3, "<|endoftext|> is text"), (4, "word " * 30_000), (5, "twice"), (5, "twice"), (6, "😀é\n\n  x"),
        (7, "x" * 20_000),
    ]
    for row_tokens in (16, 2_048):
        matrices = packing.packed(with_clashes(docs(*rows)), vocabulary, row_tokens=row_tokens).collect()
        assert rebuilt(matrices, vocabulary) == sorted((str(i), t or "") for i, t in rows)
    assert packing.packed(docs(*rows).limit(0), vocabulary).collect() == []


def test_segments_read_back(spark, docs, vocabulary, tmp_path):
    rows = docs((1, "a b c"), (2, None), (3, "word " * 9_000))
    packing.write_packed(rows, vocabulary, str(tmp_path / "out"))
    segments = packing.read_segments(spark, str(tmp_path / "out"))
    by_doc = segments.groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("k"), F.max("pieces").alias("p"))
    found = {r.doc_id: (r.n, r.k, r.p) for r in by_doc.collect()}
    assert found[2] == (1, 1, 1) and found[1][1:] == (1, 1) and found[3][1] == found[3][2] == -(-found[3][0] // 2_048)
    assert segments.filter("matrix_column + n_tokens > 2048").isEmpty()


def test_wide_ids(docs, vocabulary):
    wide = packing.Vocabulary(vocabulary.path, vocabulary.pattern, 70_000)
    (m,) = packing.packed(docs((1, "a b")), wide).collect()
    assert m.id_bytes == 4 and np.frombuffer(m.ids, "<u4")[-1] == 70_000
