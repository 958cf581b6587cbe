"""The published document as fragments: written by all tasks, in an order that makes their concatenation the document.

Each section is a folder of text files whose names sort as their content does, a line for each element; the text
between sections has folders of its own. Beside them lies a manifest table with section, place and digest of every
element, which tells two exports apart without reading either.
"""

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagedoor.operators.numbering import numbered
from stagedoor.operators.relational import has_changed, side_by_side
from stagedoor.plans import growth
from stagedoor.plans.payload import PayloadParts
from stagedoor.session import list_names, opened, read_text, settle, write_text
from stagedoor.sinks.documents import SCRIPT_NOTE, SCRIPT_VARIABLE

DATA, MANIFEST = "data", "manifest"
_ELEMENT = "section string, place bigint, text string"


def _text(table: DataFrame) -> Column:
    return F.to_json(F.struct(*table.columns), {"ignoreNullFields": "false"})


def _single(table: DataFrame) -> DataFrame:
    return table.select(F.lit(0).cast("bigint").alias("place"), _text(table).alias("text"))


def _listed(table: DataFrame, *order: Column) -> DataFrame:
    keys = [k.alias(f"_k{i}") for i, k in enumerate(order)]
    keyed = settle(table.select(_text(table).alias("text"), *keys), "list")
    placed = numbered(keyed, [F.col(f"_k{i}") for i in range(len(keys))])
    return placed.select("place", "text")


def sections(parts: PayloadParts) -> dict[str, tuple[DataFrame, bool]]:
    """(place, text) of every section in publishing order, and whether it is a list."""
    levers = parts.levers
    amounts = growth.lever_amounts(levers).agg(F.sum("amount").alias("text"))
    listed = None
    for i, lever in enumerate(levers.values()):
        one = _single(lever).withColumn("place", F.lit(i).cast("bigint"))
        listed = one if listed is None else listed.union(one)
    out = {name: (_single(getattr(parts, name)), False) for name in ("season", "goal", "totals", "attribution", "derived")}
    out["events"] = _listed(parts.events, F.col("id")), True
    out["daily"] = _listed(parts.daily, F.col("date")), True
    out["campaigns"] = _listed(parts.campaigns, -F.col("rpd"), F.col("id")), True
    out["levers"] = listed, True
    whole = F.coalesce(F.col("text").cast("string"), F.lit("null"))
    out["levers_total"] = amounts.select(F.lit(0).cast("bigint").alias("place"), whole.alias("text")), False
    return out


def _elements(spark: SparkSession, parts: PayloadParts) -> DataFrame:
    """(section, place, text): all lines of the document; sections are numbered, text between them has even numbers."""
    between, content, number, closing = [], None, 0, ""
    for name, (table, is_list) in sections(parts).items():
        opening = f"{closing}{',' if number else '{'}{json.dumps(name)}: {'[' if is_list else ''}"
        between.append((f"{number:02d}-open", 0, opening))
        rows = table.select(F.lit(f"{number + 1:02d}-{name}").alias("section"), "place", "text")
        content = rows if content is None else content.union(rows)
        number, closing = number + 2, "]" if is_list else ""
    between.append((f"{number:02d}-close", 0, f"{closing}}}"))
    return content.union(spark.createDataFrame(between, _ELEMENT))


def stored_manifest(spark: SparkSession, out_dir: str) -> DataFrame | None:
    try:
        return spark.read.schema("section string, place bigint, digest string").parquet(f"{out_dir}/{MANIFEST}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def export_fragments(parts: PayloadParts, out_dir: str) -> bool:
    """Write the document below ``out_dir`` unless it is there already; says whether it wrote.

    No row, list or text of the document passes through one task or the driver; what the driver lists is file names.
    The manifest comes last, so an export that is cut short is not taken for a whole one.
    """
    parts.prepare()
    spark = parts.totals.sparkSession
    elements = settle(_elements(spark, parts), "elements")
    manifest = elements.select("section", "place", F.sha2(F.col("text").cast("binary"), 256).alias("digest"))
    before = stored_manifest(spark, out_dir)
    if before is not None and not has_changed(before, manifest):
        return False
    line = F.when(F.col("place") > 0, F.concat(F.lit(","), "text")).otherwise(F.col("text"))
    ordered = elements.repartitionByRange("section", "place").sortWithinPartitions("section", "place")
    ordered.select("section", line.alias("value")).write.mode("overwrite").partitionBy("section").text(f"{out_dir}/{DATA}")
    names = fragment_names(spark, out_dir)
    head, tail = f"{DATA}/script-head.txt", f"{DATA}/script-tail.txt"
    write_text(spark, f"{out_dir}/{head}", f"{SCRIPT_NOTE}{SCRIPT_VARIABLE} = ")
    write_text(spark, f"{out_dir}/{tail}", ";\n")
    files = {"data.json": names, "data.js": [head, *names, tail]}
    write_text(spark, f"{out_dir}/files.json", json.dumps(files, indent=1) + "\n")
    manifest.write.mode("overwrite").parquet(f"{out_dir}/{MANIFEST}")
    return True


def fragment_names(spark: SparkSession, out_dir: str) -> list[str]:
    """The fragments, in the order in which they make the document."""
    folders = [n for n in list_names(spark, f"{out_dir}/{DATA}") if n.startswith("section=")]
    return [
        f"{DATA}/{folder}/{name}" for folder in folders for name in list_names(spark, f"{out_dir}/{DATA}/{folder}") if name.startswith("part-")
    ]


def read_section(spark: SparkSession, out_dir: str, name: str, layout: str) -> DataFrame:
    """(position, element) of a section's fragments; the manifest says where an element belongs.

    A line that the manifest doesn't know, or that it has and no fragment holds, is missing on both sides of the join.
    """
    folder = next(n for n in list_names(spark, f"{out_dir}/{DATA}") if n.endswith(f"-{name}"))
    text = spark.read.text(f"{out_dir}/{DATA}/{folder}").select(F.regexp_replace("value", "^,", "").alias("text"))
    lines = text.withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))
    known = stored_manifest(spark, out_dir).filter(F.col("section") == folder.removeprefix("section="))
    met = lines.join(known, "digest")
    return met.select(F.col("place").alias("position"), F.from_json("text", layout).alias("element"))


def headline(spark: SparkSession, out_dir: str) -> DataFrame:
    """One row: net revenue and nights with scans of an exported document, from two of its sections."""
    net = read_section(spark, out_dir, "totals", "net double").select(F.format_number("element.net", 0).alias("net"))
    nights = read_section(spark, out_dir, "season", "nights_scanned bigint").select("element.nights_scanned")
    text = F.concat(F.lit("$"), F.col("net"), F.lit(" net, "), F.col("nights_scanned").cast("string"), F.lit(" nights of scans"))
    return side_by_side(net, nights).select(text.alias("headline"))


def listed_files(spark: SparkSession, out_dir: str) -> dict[str, list[str]]:
    """The fragments of ``data.json`` and of its script twin."""
    return json.loads(read_text(spark, f"{out_dir}/files.json"))


def assemble(spark: SparkSession, out_dir: str, name: str, target: str) -> None:
    """One file of the fragments, ``data.json`` or ``data.js``, copied end to end in small buffers."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    files = listed_files(spark, out_dir)[name]
    path, system = opened(spark, target)
    out = system.create(path, True)
    try:
        for file in files:
            part, home = opened(spark, f"{out_dir}/{file}")
            source = home.open(part)
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, conf, False)
            finally:
                source.close()
    finally:
        out.close()
