import random

import pytest
import xxhash

from stagedoor.llm import simhash
from stagedoor.llm.common import components


def plain_fingerprint(text, k=3):
    words = "".join(c.lower() if c.isascii() else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """{(doc_id, fp): smallest id reachable} by comparing all pairs."""
    fps = sorted({fp for _, fp in rows})
    root = {fp: fp for fp in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    least = {}
    for doc, fp in rows:
        r = find(fp)
        if doc is not None:
            least[r] = min(doc, least.get(r, doc))
    return sorted((str(d), f"{fp:016x}", str(least.get(find(fp)))) for d, fp in rows)


def found(df):
    return sorted((str(a), b, str(c)) for a, b, c in df.select("doc_id", "fingerprint", "component_id").collect())


def test_documents_equal_brute_force(documents):
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in documents.collect()]
    assert found(simhash.near_duplicates(documents)) == plain_components(rows)


def test_edge_cases(docs, with_clashes):
    rows = [
        (1, None), (2, ""), (3, " \n\t"), (None, ""), (4, "a b"), (5, "a  b"), (5, "a  b"), (6, "A B"), (7, "É b c"), (8, "é b c"),
        (None, "alone in its component and without an id"), (9, "x " * 70_000),
    ]
    expected = plain_components([(d, plain_fingerprint(t)) for d, t in rows])
    assert found(simhash.near_duplicates(with_clashes(docs(*rows)))) == expected
    assert simhash.near_duplicates(docs(*rows).limit(0)).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_links_connect_what_all_pairs_connect(spark, seed):
    """Dense clusters, so that many fingerprints share variants, and chains of two bits a step."""
    rng = random.Random(seed)
    fps = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(60):
            fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))))
    at = rng.getrandbits(64)
    for i in range(0, 60, 2):
        at ^= 3 << i
        fps.add(at)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"))
    pairs = links.collect()
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 2 for a, b in pairs)
    assert len(pairs) < 65 * len(fps)
    roots = {r.node: r.root for r in components(links).collect()}
    rows = [(i, f & (1 << 64) - 1) for i, f in enumerate(signed)]
    groups = {}
    for f, (i, _) in zip(signed, rows, strict=True):
        groups.setdefault(roots.get(f, f), []).append(i)
    mine = sorted((str(i), f"{rows[i][1]:016x}", str(min(g))) for g in groups.values() for i in g)
    assert mine == plain_components(rows)


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(100, 180)] + [(7, i) for i in range(200, 400)] + [(5, 5), (None, 3)]
    roots = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert {roots[i] for i in range(100, 181)} == {100}
    assert {roots[i] for i in range(200, 400)} == {7} and roots[7] == 7
    assert 5 not in roots and 3 not in roots


def test_one_of_each_keeps_one(docs, with_clashes):
    rows = docs((3, "a b c d"), (2, "a b c d"), (2, "a b c d"), (None, "q r s t"), (None, "q r s t"), (9, None))
    kept = simhash.one_of_each(with_clashes(rows))
    assert kept.columns == with_clashes(rows).columns
    kept = kept.select(rows.columns)
    assert sorted((str(r.doc_id), r.text) for r in kept.collect() if r.text) == [("2", "a b c d"), ("None", "q r s t")]
    assert kept.columns == ["doc_id", "text", "lang", "source"] and kept.count() == 3
