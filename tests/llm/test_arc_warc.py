import base64
import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from stagedoor.llm import arc_warc
from stagedoor.session import fresh_path

NASTY = [
    (7, "http://a/", "same body"), (3, "http://b/ c\nd", "same body"), (5, None, "same body"), (None, "http://n/", "same body"),
    (11, "http://c/", None), (10, "http://d/", ""), (20, "u", "WARC/1.1\r\n\r\nhttp://x 1 2 3 4\n"), (21, "u", "ÄÖ\r\n\r\n\n\n\r\n\r\n"),
    (22, "u", "long " * 200_000), (23, "", "X-Record-Key: 99\r\n"), (24, "u", "tail\n"), (24, "u", "tail\n"),
]


def converted(spark, pages, **options):
    arc, warc = fresh_path(spark, "arc"), fresh_path(spark, "warc")
    odd = F.coalesce(F.col("page_id") % 2 == 1, F.lit(True))
    arc_warc.write_arc(pages.filter(odd), f"{arc}/v1", 1)
    arc_warc.write_arc(pages.filter(~odd), f"{arc}/v2", 2)
    arc_warc.convert(spark, f"{arc}/*", warc, **options)
    return arc_warc.read_warc(spark, warc), warc


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def expected(rows, least=0):
    """Of equal payloads the smallest key is the response, a null one being the last."""
    first, out, seen = {}, [], set()
    for i, _, html in rows:
        if len((html or "").encode()) >= least:
            first[digest(html)] = min((i is None, i or 0), first.get(digest(html), (True, 0)))
    for i, _, html in rows:
        d, size = digest(html), len((html or "").encode())
        own = first.get(d) == (i is None, i or 0)
        response = size < least or own and d not in seen
        if own:
            seen.add(d)
        refers = None if response or first[d][0] else first[d][1]
        out.append((str(i), size, d, "response" if response else "revisit", str(refers)))
    return sorted(out)


def found(df):
    rows = df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    return sorted((str(a), b, c, d, str(e)) for a, b, c, d, e in rows)


@pytest.mark.parametrize("least", [0, 5, 1_000])
def test_round_trip(spark, with_clashes, least):
    pages = with_clashes(spark.createDataFrame(NASTY, "page_id bigint, url string, html string")).repartition(3)
    result, _ = converted(spark, pages, min_revisit_bytes=least)
    assert found(result) == expected(NASTY, least)


def test_whole_table_and_conversion_is_repeatable(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    result, _ = converted(spark, pages)
    assert found(result) == expected(rows)
    again = fresh_path(spark, "warc")
    arc_warc.write_arc(pages.repartition(5), again + "-arc")
    arc_warc.convert(spark, again + "-arc", again)
    again = arc_warc.read_warc(spark, again)
    assert sorted(result.collect()) == sorted(again.collect())


def test_empty_table(spark):
    result, _ = converted(spark, spark.createDataFrame([], "page_id bigint, url string, html string"))
    assert result.collect() == []


def test_files_hold_so_many_records(spark, monkeypatch):
    monkeypatch.setattr(arc_warc, "FILE_RECORDS", 4)
    rows = [(i, "u", f"page {i}") for i in range(11)]
    result, warc = converted(spark, spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1))
    assert found(result) == expected(rows)
    assert spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(warc).count() >= 3


def test_written_files_are_warc(spark):
    _, warc = converted(spark, spark.createDataFrame(NASTY[:3], "page_id bigint, url string, html string"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(warc).collect()
    records = [r for f in files for r in arc_warc.parse_warc(io.BytesIO(gzip.decompress(f.content)))]
    assert sorted(h["WARC-Type"] for h, _ in records) == ["response", "revisit", "revisit"]
    ids = {h["WARC-Record-ID"] for h, _ in records if h["WARC-Type"] == "response"}
    assert {h["WARC-Refers-To"] for h, _ in records if h["WARC-Type"] == "revisit"} == ids
    assert all(h["WARC-Date"] == "2008-04-30T20:48:25Z" and b.startswith(b"HTTP/1.1 200") for h, b in records)


def arc(version, *records, fields=None):
    body = f"{version} 0 x\n{fields or arc_warc.ARC_FIELDS.get(version, '')}\n".encode()
    out = b"filedesc://x 0.0.0.0 19960101000000 text/plain %d\n" % len(body) + body + b"\n"
    return io.BytesIO(out + b"".join(records))


def test_arc_versions_by_hand():
    one = arc(1, b"http://a 1.2.3.4 19970101010101 text/html 5\nab\ncd\n", b"http://b 1.2.3.4 - text/html 0\n\n")
    assert [(f["URL"], c) for _, f, c in arc_warc.parse_arc(one)] == [("http://a", b"ab\ncd"), ("http://b", b"")]
    two = arc(2, b"http://a 1.2.3.4 19970101010101 text/html 200 sum - 77 f.arc 3\nxyz\n")
    ((_, fields, content),) = arc_warc.parse_arc(two)
    assert fields["Result-code"] == "200" and fields["Filename"] == "f.arc" and content == b"xyz"


@pytest.mark.parametrize(
    "bad",
    [
        arc(1, b"http://a 1.2.3.4 19970101010101 text/html 50\nab\n"),
        arc(1, b"http://a 1.2.3.4 text/html 2\nab\n"),
        arc(1, b"http://a 1.2.3.4 19970101010101 text/html two\nab\n"),
        arc(9, b"http://a 1.2.3.4 19970101010101 text/html 2\nab\n"),
        io.BytesIO(b"http://a 1.2.3.4 19970101010101 text/html 2\nab\n"),
    ],
)
def test_damaged_arc_is_an_error(bad):
    with pytest.raises(ValueError):
        list(arc_warc.parse_arc(bad))


def test_dates():
    assert arc_warc.warc_date("20080430204825") == "2008-04-30T20:48:25Z"
    assert arc_warc.warc_date("20081430204825") == arc_warc.warc_date(None) == "1970-01-01T00:00:00Z"


def write_by_hand(path, version, *records):
    path.mkdir(exist_ok=True)
    (path / f"{len(list(path.iterdir()))}.arc.gz").write_bytes(gzip.compress(arc(version, *records).read()))


def by_hand(url, block, kind="text/html", date="19970101010101"):
    return b"%s 1.2.3.4 %s %s %d\n%s\n" % (url.encode(), date.encode(), kind.encode(), len(block), block)


def test_archives_that_others_wrote(spark, tmp_path):
    """A key late in a long header, records without keys, and what is no HTTP exchange."""
    http = b"HTTP/1.0 200 OK\r\n"
    late = http + b"X-Filler: " + b"f" * 2_000 + b"\r\nX-Record-Key: 5\r\n\r\nbody"
    write_by_hand(
        tmp_path / "arc", 1, by_hand("http://a", late), by_hand("http://b", http + b"X-Record-Key: 9\r\n\r\nbody"), by_hand("http://c", http + b"\r\nbody"),
        by_hand("http://d", http + b"\r\nother", date="19980101010101"), by_hand("dns:a", b"19970101 a 1.2.3.4\r\n\r\nbody", "text/dns"),
    )
    write_by_hand(tmp_path / "arc", 1, by_hand("http://e", http + b"\r\nother"), by_hand("dns:a", b"", "text/dns"))
    warc = str(tmp_path / "warc")
    arc_warc.convert(spark, str(tmp_path / "arc"), warc)
    rows = {(r.target_uri, r.payload_bytes): r for r in arc_warc.read_warc(spark, warc).collect()}
    kinds = {k: (r.page_id, r.record_type, r.refers_to) for k, r in rows.items()}
    assert kinds == {
        ("http://a", 4): (5, "response", None), ("http://b", 4): (9, "revisit", 5), ("http://c", 4): (None, "revisit", 5),
        ("http://d", 5): (None, "revisit", None), ("http://e", 5): (None, "response", None),
        ("dns:a", 26): (None, "resource", None), ("dns:a", 0): (None, "resource", None),
    }
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(warc).collect()
    records = [r for f in files for r in arc_warc.parse_warc(io.BytesIO(gzip.decompress(f.content)))]
    heads = {h["WARC-Target-URI"]: h for h, b in records if b or h["WARC-Type"] != "resource"}
    assert heads["http://d"]["WARC-Refers-To"] == heads["http://e"]["WARC-Record-ID"]
    assert heads["dns:a"]["Content-Type"] == "text/dns"


def test_large_pages_are_few_to_a_file(spark, monkeypatch):
    monkeypatch.setattr(arc_warc, "FILE_BYTES", 4 << 20)
    rows = [(i, "u", chr(65 + i % 26) * (1_500_000 if i < 12 else 100)) for i in range(60)]
    result, warc = converted(spark, spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1))
    assert found(result) == expected(rows)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(warc).collect()
    sizes = [len(gzip.decompress(f.content)) for f in files]
    assert max(sizes) < 8 << 20
