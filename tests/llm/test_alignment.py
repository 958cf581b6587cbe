import collections
import hashlib
import tracemalloc

import numpy as np
import pytest

pytest.importorskip("tokenizers")
pytest.importorskip("sentencepiece")

from stagedoor.llm import alignment, registry  # noqa: E402

VOCABULARIES = alignment.public_vocabularies()


def encoders():
    import sentencepiece
    import tokenizers

    left = tokenizers.Tokenizer.from_file(VOCABULARIES[0])
    left.encode_special_tokens = True
    alphabet = alignment.byte_alphabet()
    right = sentencepiece.SentencePieceProcessor(model_file=VOCABULARIES[1])

    def pieces(text):
        a = left.encode(" " + text, add_special_tokens=False)
        b = right.encode(text)
        a_bytes = [bytes(alphabet[c] for c in left.id_to_token(i)) for i in a.ids]
        b_bytes = []
        for i in b:
            piece = right.id_to_piece(i)
            b_bytes.append(bytes([int(piece[3:5], 16)]) if right.is_byte(i) else piece.replace("▁", " ").encode())
        return list(zip(a.ids, a_bytes, strict=True)), list(zip(b, b_bytes, strict=True))

    return pieces


def by_hand(rows):
    """Groups by walking both sides at once; links and counts spelled out."""
    pieces, linked, out = encoders(), [], []
    for i, text in rows:
        a, b = pieces(text) if text else ([], [])
        whole = " ".encode() + (text or "").encode()
        if not text or b"".join(p for _, p in a) != whole or b"".join(p for _, p in b) != whole:
            out.append((i, 0, 0, [], ""))
            linked.append([])
            continue
        groups, x, y = [], 0, 0
        while x < len(a):
            ga, gb = [a[x]], [b[y]]
            x, y = x + 1, y + 1
            while (na := sum(len(p) for _, p in ga)) != (nb := sum(len(p) for _, p in gb)):
                if na < nb:
                    ga.append(a[x])
                    x += 1
                else:
                    gb.append(b[y])
                    y += 1
            groups.append(([t for t, _ in ga], [t for t, _ in gb]))
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, k)) for g, k in groups)
        out.append((i, len(a), len(b), groups, hashlib.sha256(text.encode()).hexdigest()))
        linked.append([(p, q) for g, k in groups for p in g for q in k])
    counts = collections.Counter(pair for links in linked for pair in set(links))
    most = collections.Counter()
    for (p, _), n in counts.items():
        most[p] = max(most[p], n)
    return sorted(
        (
            (i, n_a, n_b, len(groups), len(links), sum(counts[x] == most[x[0]] for x in links), sum(counts[x] for x in links), sha)
            for (i, n_a, n_b, groups, sha), links in zip(out, linked, strict=True)
        ),
        key=str,
    )


def found(df, **options):
    return sorted(map(tuple, alignment.alignment(df, VOCABULARIES, **options).collect()), key=str)


def test_whole_table(spark, folder, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert sorted(map(tuple, registry.op13_cross_tokenizer_alignment(spark, folder).collect()), key=str) == by_hand(rows)


@pytest.mark.parametrize("hot_pairs", [0, 3, 1 << 17])
def test_edge_cases(docs, with_clashes, hot_pairs):
    rows = [
        (1, None), (2, ""), (None, "Größe und Maß"), (None, None), (3, "a b c"), (3, "a b c"), (4, " "), (5, "  two  spaces \n\ttabs\r\n"),
        (6, "<|endoftext|> <s> </s> <unk> <0x41>"), (7, "▁mark"), (8, "日本語 の テキスト, كتاب 한국어 😀🏳️‍🌈"), (9, "x" * 5_000), (10, "word " * 20_000),
        (11, "é ﬁ  nbsp ​ zero"), (12, "don't we'll 1234567 3.14"), (13, "\x00\x01 control"), (14, "𝔘𝔫𝔦𝔠𝔬𝔡𝔢 \U0001e900"), (15, " leading"),
    ]
    assert found(with_clashes(docs(*rows)), hot_pairs=hot_pairs) == by_hand(rows)


def test_an_empty_table(docs):
    assert found(docs((1, "x")).limit(0)) == []


def test_groups_are_listed(docs):
    row = alignment.aligned(docs((1, "unbelievable tokenization")), VOCABULARIES).first()
    pieces = encoders()("unbelievable tokenization")
    groups = [[side.split(",") for side in g.split("|")] for g in row.groups.split(";")]
    assert [int(i) for g in groups for i in g[0]] == [i for i, _ in pieces[0]]
    assert [int(i) for g in groups for i in g[1]] == [i for i, _ in pieces[1]]
    assert sum(len(a) * len(b) for a, b in groups) == row.n_links == sum(row.times)


def test_both_encoders_agree_where_the_fast_one_is_used(documents):
    import tokenizers

    exact = tokenizers.Tokenizer.from_file(VOCABULARIES[0])
    exact.encode_special_tokens = True
    classes = "".join(map(chr, [*range(0x250), *range(0x2010, 0x2028)]))
    mixed = [a + b + c for a in "a1 .\n'" for b in classes for c in "z9 !\t"]
    texts = [r.text for r in documents.collect()] + mixed
    side = alignment.byte_level(VOCABULARIES[0])
    assert [ids.tolist() for ids in side.encode(texts)] == [exact.encode(" " + t, add_special_tokens=False).ids for t in texts]


def test_tokens_are_aligned_without_an_object_each():
    """Time goes with what is made for a token: some numbers in arrays, not entries of dictionaries."""
    n = 200_000
    rng = np.random.default_rng(1)
    lengths = np.array([1, 2, 3, 0])
    left = rng.integers(0, 3, n)
    right = np.concatenate([rng.permutation(left[at : at + 5]) for at in range(0, n, 5)])
    tracemalloc.start()
    found = alignment.align(left, right, lengths, lengths)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    ends = [np.cumsum(lengths[ids]).tolist() for ids in (left, right)]
    common = sorted(set(ends[0]) & set(ends[1]))
    assert found.left_cuts.tolist() == [0, *(np.searchsorted(ends[0], common) + 1)]
    assert found.right_cuts.tolist() == [0, *(np.searchsorted(ends[1], common) + 1)]
    assert peak < 80 * n


def test_tokens_without_bytes_belong_to_the_group_before():
    lengths = np.array([1, 2, 3, 0])
    found = alignment.align(np.array([0, 3, 1, 3]), np.array([2, 3, 3]), lengths, lengths)
    assert (found.left_cuts.tolist(), found.right_cuts.tolist()) == ([0, 4], [0, 3])
    found = alignment.align(np.array([3, 1, 3, 0]), np.array([1, 0, 3]), lengths, lengths)
    assert (found.left_cuts.tolist(), found.right_cuts.tolist()) == ([0, 3, 4], [0, 1, 3])


@pytest.mark.parametrize("at_once", [1, 3, 1 << 18])
def test_strings_are_joined_in_parts(monkeypatch, at_once):
    monkeypatch.setattr(alignment, "LAID_OUT", at_once)
    words = [b"", b"a", b"bc", "ß".encode(), b""]
    numbers = np.array([4, 1, 1, 0, 3, 2, 4, 2], np.uint32)
    strings = alignment.Strings(words)
    assert strings.joined(numbers) == b"".join(words[i] for i in numbers)
    assert strings.joined(numbers[:0]) == b"" == strings.joined(np.array([0, 4]))
