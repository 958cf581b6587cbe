from collections import Counter

import pytest
import xxhash

from stagedoor.llm import sharding

NAMES = [f"s{i}" for i in range(10)]


def plain_fill(names, slots):
    at = [xxhash.xxh64_intdigest(n, seed=1) % slots for n in names]
    step = [xxhash.xxh64_intdigest(n, seed=2) % (slots - 1) + 1 for n in names]
    order = [[(a + k * s) % slots for k in range(slots)] for a, s in zip(at, step, strict=True)]
    table = {}
    while len(table) < slots:
        for i, wanted in enumerate(order):
            if len(table) < slots:
                table[next(s for s in wanted if s not in table)] = i
    return [table[s] for s in range(slots)]


def test_fill_equals_turn_taking_by_the_letter():
    for names in (NAMES, NAMES[:1], NAMES[:3]):
        assert sharding.fill(names, 101) == plain_fill(names, 101)


def test_shares_are_even_and_few_slots_move():
    whole, less = sharding.fill(NAMES), sharding.fill(NAMES[:-1])
    counts = Counter(whole)
    assert max(counts.values()) - min(counts.values()) <= 1
    moved = sum(NAMES[a] != NAMES[b] for a, b in zip(whole, less, strict=True) if a != 9)
    assert moved < 0.1 * len(whole)


@pytest.mark.parametrize("names, slots", [([], 101), (["a", "a"], 101), (["a"], 100), (["a", "b", "c", "d"], 3)])
def test_refused(names, slots):
    with pytest.raises(ValueError):
        sharding.fill(names, slots)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_placement_equals_brute_force(docs, with_clashes):
    rows = [(i, f"t{i}") for i in range(300)] + [(5, "t5"), (5, "other"), (None, "x"), (None, None), (7, ""), (-3, "y" * 500_000)]
    table = sharding.fill(NAMES)

    def slot(i, text):
        key = text if i is None else str(i)
        return 42 % sharding.SLOTS if key is None else signed(xxhash.xxh64_intdigest(key, seed=42)) % sharding.SLOTS

    result = sharding.shard_documents(with_clashes(docs(*rows)), NAMES)
    expected = sorted((str(i), slot(i, t), NAMES[table[slot(i, t)]]) for i, t in rows)
    assert sorted((str(a), b, c) for a, b, c in result.collect()) == expected
    assert sharding.shard_documents(docs(*rows).limit(0), NAMES).collect() == []


def test_written_shards_hold_every_row(spark, docs, with_clashes, tmp_path):
    rows = with_clashes(docs(*((i, f"t{i}") for i in range(200))))
    sharding.write_shards(rows, NAMES, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    expected = {r.doc_id: r.shard for r in sharding.shard_documents(rows, NAMES).collect()}
    assert {r.doc_id: r.shard for r in back.collect()} == expected and back.count() == 200
