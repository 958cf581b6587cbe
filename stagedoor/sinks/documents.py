"""Writing the published document."""

import json

from stagedoor.plans.payload import PayloadParts, payload_json, payload_row
from stagedoor.session import read_text, write_text

# The variable and note of the script twin of the document.
SCRIPT_NOTE = "// Written by the document export; edits are lost on the next run.\n"
SCRIPT_VARIABLE = "window.BOXOFFICE_DATA"


def document(parts: PayloadParts) -> dict:
    """The document as nested Python values, sections and keys in publishing order.

    One row comes to the driver. The four levers, whose details differ, become one list here.
    """
    row = json.loads(payload_json(payload_row(parts)).first().document)
    levers = [row.pop(f"lever_{key}") for key in parts.levers]
    total = row.pop("levers_total")
    return {**row, "levers": levers, "levers_total": total}


def export_document(parts: PayloadParts, out_dir: str) -> list[str]:
    """Write ``data.json`` and its script twin and return the names of the files that changed.

    The same input gives the same bytes, and files that would stay the same are left alone. The
    folder may be in any file system that Spark knows.
    """
    spark = parts.totals.sparkSession
    text = json.dumps(document(parts), indent=2, ensure_ascii=False)
    files = {
        "data.json": f"{text}\n",
        "data.js": f"{SCRIPT_NOTE}{SCRIPT_VARIABLE} = {text};\n",
    }
    changed = [n for n, content in files.items() if read_text(spark, f"{out_dir}/{n}") != content]
    for name in changed:
        write_text(spark, f"{out_dir}/{name}", files[name])
    return changed


def export_sections(parts: PayloadParts, out_dir: str) -> list[str]:
    """The same as a folder of JSON lines for each section, written in parallel."""
    sections = {
        "season": parts.season,
        "goal": parts.goal,
        "totals": parts.totals,
        "attribution": parts.attribution,
        "derived": parts.derived,
        "events": parts.events.orderBy("id"),
        "daily": parts.daily.orderBy("date"),
        "campaigns": parts.campaigns.orderBy("rpd", "id", ascending=[False, True]),
        **{f"lever_{key}": lever for key, lever in parts.levers.items()},
    }
    for name, table in sections.items():
        table.write.mode("overwrite").option("ignoreNullFields", False).json(f"{out_dir}/{name}")
    return sorted(sections)
