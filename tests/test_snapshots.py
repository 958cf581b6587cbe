import json

import pytest
from frames import rows
from pyspark.sql import functions as F

from stagedoor.operators.distinct import distinct_counts, distinct_slices, with_dense_ids
from stagedoor.operators.relational import changed_rows
from stagedoor.sinks import snapshots


def test_changes_are_found_by_digest(spark, tmp_path):
    data = [(i, f"v{i % 7}", None if i % 5 else i) for i in range(3_000)]
    df = spark.createDataFrame(data, "id bigint, v string, n bigint")
    changed = df.filter("id not in (7, 8)").withColumn("v", F.when(F.col("id") == 9, "new").otherwise(F.col("v")))
    changed = changed.union(spark.createDataFrame([(10, "v3", 10), (5_000, None, None)], df.schema))
    before, after, same = (str(tmp_path / n) for n in ("before", "after", "same"))
    for table, path in ((df, before), (changed, after), (df.repartition(3), same)):
        snapshots.write_snapshot(table, ["id"], path)
    assert rows(snapshots.read_snapshot(spark, before)) == rows(df)
    found = snapshots.changed_since(spark, before, after)
    assert sorted(map(str, found.collect())) == sorted(map(str, changed_rows(df, changed).collect()))
    assert snapshots.differing_slots(spark, before, after).count() <= 5
    assert snapshots.differing_slots(spark, before, same).count() == 0
    assert snapshots.changed_since(spark, before, same).collect() == []


def test_digests_see_nulls_repeats_and_moves(spark):
    def root(*data):
        df = spark.createDataFrame(list(data), "k int, a string, b string")
        return snapshots.digests(df, ["k"]).agg(F.sum("n"), F.sum("one"), F.sum("other")).first()

    tables = [[(1, "x", None)], [(1, None, "x")], [(1, "x", "")], [(1, "x", None)] * 2, [(2, "x", None)], []]
    assert len({tuple(root(*t)) for t in tables}) == len(tables)
    assert root((1, "x", None), (2, "y", "z")) == root((2, "y", "z"), (1, "x", None))


def test_an_empty_snapshot(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "id bigint, v string")
    snapshots.write_snapshot(df.limit(0), ["id"], str(tmp_path / "none"))
    snapshots.write_snapshot(df, ["id"], str(tmp_path / "one"))
    assert rows(snapshots.changed_since(spark, str(tmp_path / "one"), str(tmp_path / "one"))) == []
    assert snapshots.differing_slots(spark, str(tmp_path / "none"), str(tmp_path / "one")).count() == 1


@pytest.mark.parametrize("keys", [["m"], []])
def test_distinct_counts_add_up(spark, keys):
    data = [(i % 3, (i * 7_919) % 100_003) for i in range(20_000)] + [(1, None), (None, 5)]
    df = spark.createDataFrame(data, "m int, id bigint")
    slices = distinct_slices(df.withColumn("d", F.col("id") % 4), ["m", "d"], F.col("id"))
    expected = df.groupBy(*keys).agg(F.count_distinct("id").alias("distinct_count"))
    assert sorted(map(str, distinct_counts(slices, keys).collect())) == sorted(map(str, expected.collect()))
    assert distinct_counts(slices.limit(0), []).collect() in ([], [(0,)])


def test_dense_ids(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("c",)], "t string")
    found = {r.t: r.dense_id for r in with_dense_ids(df, "t").collect()}
    assert found == {"a": 0, "b": 1, "c": 2, None: None}


def test_fragments_make_the_document(spark, tmp_path):
    """The fragments end to end are the document that one task would write; empty lists included."""
    from stagedoor.catalog.queries import Season
    from stagedoor.sinks import fragments
    from stagedoor.sinks.documents import document

    folder = "/root/testdata/sf0.001"
    try:
        season = Season(spark, folder)
        season.source.table("orders")
    except Exception:
        pytest.skip("no test tables here")
    parts, out = season.spread_parts, str(tmp_path / "report")
    assert fragments.export_fragments(parts, out)
    fragments.assemble(spark, out, "data.json", str(tmp_path / "data.json"))
    assert json.loads((tmp_path / "data.json").read_text()) == document(season.parts)
    fragments.assemble(spark, out, "data.js", str(tmp_path / "data.js"))
    script = (tmp_path / "data.js").read_text()
    assert script.startswith(fragments.SCRIPT_NOTE) and script.endswith("};\n") or script.endswith("}\n;\n")
    # Something else under the same name is replaced as a whole.
    other = Season(spark, folder)
    other.__dict__["orders"] = season.orders.filter("false")
    assert fragments.export_fragments(other.spread_parts, out)
    fragments.assemble(spark, out, "data.json", str(tmp_path / "data.json"))
    again = json.loads((tmp_path / "data.json").read_text())
    assert again["daily"] == [] and again["totals"]["tickets_sold"] == 0
