import hashlib
import re
from collections import defaultdict

import pytest

from stagedoor.llm import exact_dedup


def plain(rows):
    sha = [hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest() for _, t in rows]
    groups = defaultdict(list)
    for (i, _), h in zip(rows, sha, strict=True):
        groups[h].append(i)
    keep = {h: min((i for i in ids if i is not None), default=None) for h, ids in groups.items()}
    return sorted(
        (str(i), str(keep[h]), len(groups[h]), i == keep[h], h) for (i, _), h in zip(rows, sha, strict=True)
    )


def found(df):
    return sorted((str(a), str(b), c, d, e) for a, b, c, d, e in df.collect())


ROWS = [
    (4, "a b"), (2, "a  b"), (9, "a\t\nb"), (3, "a b "), (5, None), (6, ""), (1, " "), (None, " \n"), (None, "only null ids"),
    (None, "only null ids"), (7, "repeated"), (7, "repeated"), (8, "A b"), (10, "a b"), (11, "x" * 1_000_000),
]


@pytest.mark.parametrize("options", [{}, {"hashes": 1}, {"bits_per_row": 1, "max_bits": 32768}])
def test_brute_force(docs, with_clashes, options):
    rows = ROWS + [(i, f"text {i % 700}") for i in range(100, 1_200)]
    assert found(exact_dedup.exact_duplicates(with_clashes(docs(*rows)), **options)) == plain(rows)


def test_unique_rows_are_let_through(spark, docs):
    """A filter of 16 bits a row lets few unique digests into the grouping, and every repeated one."""
    from stagedoor.llm.common import with_bits

    rows = [(i, f"text {i}") for i in range(4_000)] + [(i, "twin") for i in range(4_000, 4_400)]
    keys = exact_dedup.digests(docs(*rows), "doc_id", "text")
    bits = exact_dedup.filter_bits(4_400, 16, 1 << 28)
    cells = exact_dedup.repeated_cells(keys, 3, bits)
    tested = with_bits(keys, cells, exact_dedup._cells(keys["sha"], 3, bits), "maybe")
    maybe = {r.doc_id for r in tested.filter("maybe").collect()}
    assert set(range(4_000, 4_400)) <= maybe and len(maybe) < 400 + 80


def test_empty(docs):
    assert exact_dedup.exact_duplicates(docs((1, "a")).limit(0)).collect() == []
