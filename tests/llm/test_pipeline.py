import importlib

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from stagedoor.llm import decontaminate, mixing, packing, quality, registry, simhash
from stagedoor.session import fresh_path

pipeline = importlib.import_module("corpus_pipeline")


def rows(df):
    return sorted(tuple(map(str, r)) for r in df.collect())


@pytest.fixture(scope="module")
def kept(spark, folder):
    """What each stage returns, written and read again."""
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for _, stage in pipeline.STAGES:
        path = fresh_path(spark, "test-stage")
        stage(spark, docs, folder).write.parquet(path)
        out.append((docs, spark.read.parquet(path)))
        docs = out[-1][1]
    return out


def test_stages_return_the_columns_of_documents(kept, documents):
    assert all(after.dtypes == documents.dtypes for _, after in kept[:-1])
    assert len(pipeline.STAGES) == 5 and pipeline.ORACLE_SQL is None


def test_quality_stage(spark, folder, kept):
    before, after = kept[0]
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    verdicts = quality.judged(before, quality.trusted_ids(labels))
    expected = before.join(verdicts.filter("kept").select("doc_id"), "doc_id")
    assert rows(after) == rows(expected.select(before.columns)) and after.count() < before.count()


def test_near_dedup_stage(kept):
    before, after = kept[1]
    groups = simhash.near_duplicates(before)
    expected = before.join(groups.filter("doc_id = component_id").select("doc_id"), "doc_id")
    assert rows(after) == rows(expected.select(before.columns)) and after.count() < before.count()
    again = simhash.near_duplicates(after)
    assert again.select("component_id").distinct().count() == after.count()


def test_decontamination_stage(spark, folder, kept):
    before, after = kept[2]
    found = decontaminate.contamination(before, spark.read.parquet(f"{folder}/benchmark.parquet"))
    expected = before.join(found.filter("not contaminated").select("doc_id"), "doc_id")
    assert rows(after) == rows(expected.select(before.columns))


def test_mixing_stage(kept):
    before, after = kept[3]
    copies = mixing.mix(before).filter("copies > 0").select("doc_id", "copies")
    expected = before.join(copies, "doc_id").withColumn("i", F.explode(F.sequence(F.lit(1), "copies")))
    assert rows(after) == rows(expected.select(before.columns))


def test_packing_stage(kept):
    before, after = kept[4]
    segments = after.select(F.explode(F.arrays_zip("doc_ids", "piece")).alias("s")).select("s.*").filter("piece = 0")
    assert rows(segments.select("doc_ids")) == rows(before.select("doc_id"))
    assert sum(r.n_rows * r.row_tokens * r.id_bytes == len(r.ids) for r in after.collect()) == after.count()
    assert packing.public_vocabulary().end == 50256


def test_run_equals_the_stages(spark, folder, kept):
    again = pipeline.run(spark, folder)
    shown = ["n_rows", "ids", "doc_ids", "piece"]
    assert rows(again.select(shown)) == rows(kept[-1][1].select(shown))


@pytest.fixture(scope="module")
def odd_tables(spark, tmp_path_factory):
    """A folder of tables with nulls, empty and long texts, repeated rows, and columns that operators make too."""
    folder = str(tmp_path_factory.mktemp("odd"))
    prose = [f"the cat number {i} sat on mat {i * 7} and looked at bird {i % 5} for a long while" for i in range(60)]
    data = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(prose)]
    data += [
        (None, "a text without an id", "en", "s0", None), (None, None, None, None, None), (70, None, "en", "s1", 0), (71, "", None, "s1", 0),
        (72, prose[3], "en", "s2", 1), (72, prose[3], "en", "s2", 1), (73, "word " * 30_000, "en", "s0", 1), (74, prose[5] + " zebra", None, None, 2),
    ]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for name in ("fp", "copies", "_id", "_text", "size", "words", "place", "tilt", "run", "n"):
        docs = docs.withColumn(name, F.lit("x"))
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = spark.createDataFrame([(i, i % 4 and 1, 0) for i in range(60)] + [(None, None, None)], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(f"{folder}/labels.parquet")
    items = spark.createDataFrame([(1, prose[9]), (None, None), (None, prose[8])], "item_id bigint, text string")
    items.write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages_take_odd_rows(spark, odd_tables):
    docs = spark.read.parquet(f"{odd_tables}/documents.parquet")
    columns = docs.columns
    for _, stage in pipeline.STAGES[:-1]:
        after = stage(spark, docs, odd_tables)
        assert after.columns == columns
        path = fresh_path(spark, "odd-stage")
        after.write.parquet(path)
        docs = spark.read.parquet(path)
    packed = pipeline.STAGES[-1][1](spark, docs, odd_tables)
    assert packed.select(F.explode(F.arrays_zip("doc_ids", "piece")).alias("s")).filter("s.piece = 0").count() == docs.count() > 0


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_empty_tables(spark, odd_tables, tmp_path, stage):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{odd_tables}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    empty = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert pipeline.STAGES[stage][1](spark, empty, str(tmp_path)).collect() == []
    if stage in (0, 2):  # no labels, no benchmark: everything stays
        docs = spark.read.parquet(f"{odd_tables}/documents.parquet")
        assert pipeline.STAGES[stage][1](spark, docs, str(tmp_path)).count() == docs.count()


def test_equal_rows_share_their_fate(spark, odd_tables):
    docs = spark.read.parquet(f"{odd_tables}/documents.parquet")
    for name, stage in pipeline.STAGES[:3]:
        left = stage(spark, docs, odd_tables).filter("doc_id = 72").count()
        # Of near duplicates one row stays, which equal rows are for each other.
        assert left in ((0, 1) if "dedup" in name else (0, 2)), name


def test_registered():
    names = list(registry.queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]
    assert set(names) | {"pipeline"} <= set(contract.queries()) and set(registry.statements()) <= set(names)


@pytest.mark.parametrize("name", sorted(registry.statements()))
def test_query_equals_its_sql(spark, folder, name):
    engine = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        engine.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    cursor = engine.execute(registry.statements()[name])
    columns = [c[0] for c in cursor.description]
    result = registry.queries()[name](spark, folder)
    assert sorted(result.columns) == sorted(columns)
    assert sorted(tuple(map(repr, r)) for r in result.select(columns).collect()) == sorted(
        tuple(map(repr, r)) for r in cursor.fetchall()
    )


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.statements())))
def test_query_has_the_contracted_columns(spark, folder, name):
    contracted = {
        "op1": "doc_id fingerprint component_id", "op4": "doc_id held_out lang_pred score", "op10": "doc_id size source_size target taken",
        "op11": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
        "op13": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
    }
    own = {"op5": "doc_id slot shard", "op7": "doc_id piece pieces n_tokens ids_sha256", "op8": "doc_id perplexity threshold kept"}
    result, number = registry.queries()[name](spark, folder), name.split("_")[0]
    if number in contracted:
        columns = contracted[number].split()
        assert result.columns[: len(columns)] == columns
    else:
        assert set(own[number].split()) <= set(result.columns)
    assert not result.isEmpty()
