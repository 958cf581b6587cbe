import pytest
from frames import rows
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql.types import StringType, StructField, StructType

from stagedoor import schemas
from stagedoor.session import fresh_path
from stagedoor.sinks.tables import write_csv
from stagedoor.sources import files, query_tool

EVENT_HEADER = "event_id,event_name,genre,event_date,capacity,doors_time,show_time\n"
SCAN_HEADER = "scan_id,ticket_id,order_id,event_id,gate,scanned_at\n"


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_columns_follow_the_header(spark, tmp_path):
    text = "capacity,event_name,event_id,genre,event_date,show_time,doors_time,note\n" \
        '1200," Copper, ""Oak"" ",EV-02,folk,2025-07-02,20:00,19:00,n/a\n'  # fmt: skip
    table = files.csv_table(spark, put(tmp_path / "events.csv", text), schemas.RAW_EVENTS)
    row = table.first()
    assert (row.event_id, row.event_name, row.capacity) == ("EV-02", ' Copper, "Oak" ', 1200)
    assert table.columns[-1] == "note" and row.note is None


def test_missing_words_become_null(spark, tmp_path):
    text = EVENT_HEADER + "".join(f"{word},x,{word},2025-07-01,{word},a,b\n" for word in ("", "NA", "null", "nan"))
    table = files.csv_table(spark, put(tmp_path / "events.csv", text), schemas.RAW_EVENTS)
    assert table.filter("event_id IS NULL AND genre IS NULL AND capacity IS NULL").count() == 4


def test_increments(spark, tmp_path):
    base = put(tmp_path / "raw/events.csv", EVENT_HEADER + "EV-01,A,g,2025-07-01,1200,19:00,20:00\n")
    nights = tmp_path / "nights"

    def ids():
        table = files.csv_plus_increments(spark, base, str(nights), "events.csv", schemas.RAW_EVENTS)
        return rows(table, "event_id")

    assert ids() == [("EV-01",)]
    for n in (9, 10):
        put(nights / f"2025-07-{n:02d}/events.csv", EVENT_HEADER + f"EV-{n:02d},A,g,2025-07-09,1200,19:00,20:00\n")
    assert ids() == [("EV-01",), ("EV-09",), ("EV-10",)]


def test_scan_directory_and_manifest(spark, tmp_path):
    put(tmp_path / "ticket_scans_2025-07-01.csv", SCAN_HEADER + "S1,O1-T1,O1,E1,G,2025-07-01 19:00:00\n")
    put(tmp_path / "ticket_scans_2025-07-02.csv", SCAN_HEADER + "S2,O2-T1,O2,E1,G,2025-07-02 19:00:00\n")
    put(tmp_path / "ticket_scans_2025-07-03.csv", SCAN_HEADER)
    put(tmp_path / "notes.csv", "a,b\n")
    table = files.csv_directory(spark, str(tmp_path), schemas.RAW_SCANS)
    assert rows(table, "scan_id") == [("S1",), ("S2",)]
    manifest = files.ingest_manifest(spark, str(tmp_path))
    assert [r[0] for r in rows(manifest, "file_date")] == ["2025-07-01", "2025-07-02", "2025-07-03"]
    put(tmp_path / "ticket_scans_2025-07-04.csv", "ticket_id,scan_id,order_id,event_id,gate,scanned_at\nT,S,O,E,G,x\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.csv_directory(spark, str(tmp_path), schemas.RAW_SCANS).collect()


def test_csv_keeps_spaces_and_formats(spark, frames):
    raw = frames.raw_orders(
        ("O1", "E1", "2025-07-01 10:00:00", 'G"A', 2, 10.0, " SUMMER25", "completed"),
        ("O2", "E,1", "2025-07-01 10:00:00", "GA", 2, 7.5, None, "completed"),
    )
    path = fresh_path(spark, "csv")
    write_csv(raw, path)
    lines = sorted(r[0] for r in spark.read.text(path).collect())
    assert 'O1,E1,2025-07-01 10:00:00,"G""A",2,10.00, SUMMER25,completed' in lines
    assert rows(files.csv_table(spark, path, schemas.RAW_ORDERS)) == rows(raw)


def test_preview_and_tables(spark, frames):
    raw = frames.raw_orders(*[(f"O{i:02d}", "E", "x", "GA", 1, 1.0, None, "completed") for i in range(30)])
    assert rows(files.preview(raw, "order_id"), "order_id")[-1] == ("O09",)
    house = fresh_path(spark, "house")
    raw.write.parquet(f"{house}/raw_orders")
    files.register_tables(spark, house, ["raw_orders"])
    counted = files.adhoc_sql(spark, "SELECT COUNT(*) AS n FROM raw_orders -- all\n;")
    assert counted.first().n == 30


def test_adhoc_sql_only_reads(spark, frames):
    frames.raw_orders().createOrReplaceTempView("kept")
    for text in ("DROP VIEW kept", "CREATE TABLE t AS SELECT 1", "SELECT 1; SELECT 2"):
        with pytest.raises(ParseException):
            files.adhoc_sql(spark, text)
    with pytest.raises(ValueError):
        files.adhoc_sql(spark, "  ")
    with pytest.raises(AnalysisException):
        files.adhoc_sql(spark, "SELECT * FROM nowhere")
    assert files.adhoc_sql(spark, "WITH k AS (SELECT 1 AS n) SELECT * FROM k ORDER BY n").first().n == 1


def test_query_tool_statuses(tmp_path):
    assert query_tool.main([str(tmp_path), " "]) == 2
    assert query_tool.main([str(tmp_path / "none"), "SELECT 1"]) == 1


def test_headline(spark, tmp_path):
    text = '{\n "season": {"nights_scanned": 7},\n "totals": {"net": 335166.0}\n}\n'
    path = put(tmp_path / "data.json", text)
    assert files.payload_headline(spark, path) == "$335,166 net, 7 nights of scans"
    assert files.payload_headline(spark, str(tmp_path / "none.json")) == "refreshed data"
    assert files.payload_headline(spark, put(tmp_path / "bad.json", "{oops")) == "refreshed data"


def test_rows_that_do_not_fit_the_header(spark, tmp_path):
    layout = StructType([StructField(n, StringType()) for n in ("a", "b", "c")])
    (tmp_path / "short.csv").write_text('a,b,c\n1,2\n"x,y",2,3\n')
    assert rows(files.csv_table(spark, str(tmp_path / "short.csv"), layout)) == [("1", "2", None), ("x,y", "2", "3")]
    (tmp_path / "long.csv").write_text('a,b,c\n1,2,3\n"x,y",2,3,4\n')
    with pytest.raises(Exception, match="more fields than the header"):
        files.csv_table(spark, str(tmp_path / "long.csv"), layout).collect()
    (tmp_path / "lines.csv").write_text('a,b,c\n1,"two\nlines",3\n')
    broken = files.csv_table(spark, str(tmp_path / "lines.csv"), layout, multi_line=True)
    assert rows(broken) == [("1", "two\nlines", "3")]


def test_rejected_rows_are_kept_apart(spark, tmp_path):
    from stagedoor.operators.checks import BlockedByCheck, few_rows_rejected, gate
    from stagedoor.sources.files import csv_with_rejects, reject_counts

    folder = tmp_path / "orders"
    folder.mkdir()
    header = "order_id,event_id,ordered_at,tier,qty,unit_price_usd,promo_code,status\n"
    (folder / "a.csv").write_text(
        header + 'O1,E1,2025-07-01,GA,2,10.5,"A, ""B""",completed\nO2,E1,2025-07-01,GA,two,10.5,,completed\nO3,E1,2025-07-01,GA,2,10.5,,completed,more\n'
    )
    (folder / "b.csv").write_text(header + "O4,E1,2025-07-01,GA,1,free,,completed\nO5,E1\nO6,E1,2025-07-01,GA,NA,1,NULL,completed\n")
    good, bad = csv_with_rejects(spark, str(folder), schemas.RAW_ORDERS, str(tmp_path / "out"))
    assert rows(good, "order_id") == [("O1",), ("O5",), ("O6",)]
    assert good.filter("order_id = 'O1'").first().promo_code == 'A, "B"'
    assert rows(reject_counts(bad)) == [
        ("a.csv", "qty: not a bigint", 1), ("a.csv", "too many fields", 1), ("b.csv", "unit_price_usd: not a double", 1),
    ]
    assert {r.row.split(",")[0] for r in bad.collect()} == {"O2", "O3", "O4"}
    with pytest.raises(BlockedByCheck):
        gate(few_rows_rejected(good, bad))
    gate(few_rows_rejected(good, bad, at_most=0.5), few_rows_rejected(good.limit(0), bad.limit(0)))
