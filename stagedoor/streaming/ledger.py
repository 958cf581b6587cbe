"""What batches wrote, made visible one batch at a time.

A batch writes its files below its own number, where no reader looks. One rename of a small entry then makes all
of them visible: a crash before it leaves nothing, one after it leaves everything, and a batch that is replayed
either overwrites what nobody saw or finds its entry and does nothing.

An entry lists which batch holds the current content of every slice of a table, so slices that a
batch didn't touch stay where they are.
"""

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from stagedoor.session import list_names, move, read_text, write_text


@dataclass(frozen=True)
class Entry:
    """A committed batch: ``slices[table][slice]`` is the batch that wrote the slice last; ``facts`` are small values."""

    batch: int = -1
    slices: dict[str, dict[str, int]] = field(default_factory=dict)
    facts: dict[str, float | str | None] = field(default_factory=dict)


class Ledger:
    """Committed batches below ``root``; batch numbers rise."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _entry_path(self, batch: int) -> str:
        return f"{self.root}/ledger/{batch:012d}.json"

    def batches(self) -> list[int]:
        names = list_names(self.spark, f"{self.root}/ledger")
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())

    def entry(self, batch: int) -> Entry:
        return Entry(**json.loads(read_text(self.spark, self._entry_path(batch))))

    def last(self) -> Entry:
        committed = self.batches()
        return self.entry(committed[-1]) if committed else Entry()

    def folder(self, table: str, batch: int) -> str:
        return f"{self.root}/{table}/batch={batch}"

    def commit(self, batch: int, slices: dict[str, list[str]], facts: dict[str, float | str | None]) -> Entry:
        """Make a batch visible that wrote the named slices of each table."""
        before = self.last()
        if batch <= before.batch:
            raise ValueError(f"batch {batch} comes after batch {before.batch}, which is committed")
        current = {table: dict(held) for table, held in before.slices.items()}
        for table, touched in slices.items():
            current.setdefault(table, {}).update(dict.fromkeys(touched, batch))
        entry = Entry(batch, current, facts)
        draft = f"{self.root}/drafts/{batch:012d}.json"
        write_text(self.spark, draft, json.dumps({"batch": batch, "slices": current, "facts": facts}))
        move(self.spark, draft, self._entry_path(batch))
        return entry

    def read(self, table: str, layout: str, key: str, only: list[str] | None = None) -> DataFrame:
        """The current slices of a table, or those in ``only``; no other folder is listed."""
        held = self.last().slices.get(table, {})
        paths = [
            f"{self.folder(table, batch)}/{key}={name}" for name, batch in held.items() if only is None or name in only
        ]
        if not paths:
            return self.spark.createDataFrame([], layout)
        return self.spark.read.schema(layout).parquet(*paths)
