import pytest

from stagedoor.sources.files import ingest_manifest
from stagedoor.streaming import drops

HEADER = "scan_id,ticket_id,order_id,event_id,gate,scanned_at\n"


class Folder:
    def __init__(self, spark, path):
        self.spark, self.scans, self.state = spark, path / "scans", str(path / "state")
        self.scans.mkdir()
        self.seen = []

    def drop(self, day, text=HEADER):
        (self.scans / f"ticket_scans_{day}.csv").write_text(text)

    def run(self, fail=False):
        self.seen = []

        def refresh(names):
            self.seen += sorted(r.file_name[13:23] for r in names.collect())
            if fail:
                raise RuntimeError("refresh failed")

        drops.process_drops(self.spark, str(self.scans), self.state, refresh)
        return self.seen


@pytest.fixture
def folder(spark, tmp_path):
    return Folder(spark, tmp_path)


def test_first_run_records_a_baseline(folder):
    folder.drop("2025-07-01")
    folder.drop("2025-07-02")
    assert folder.run() == []
    assert drops.cursor(folder.spark, folder.state) == "ticket_scans_2025-07-02.csv"
    folder.drop("2025-07-03")
    folder.drop("2025-07-04")
    assert folder.run() == ["2025-07-03", "2025-07-04"]
    assert folder.run() == []
    assert drops.cursor(folder.spark, folder.state) == "ticket_scans_2025-07-04.csv"


def test_empty_folder_then_a_header_only_file(folder):
    assert folder.run() == []
    folder.drop("2025-07-01")
    assert folder.run() == ["2025-07-01"]


def test_late_file_does_not_trigger_but_is_listed(folder):
    folder.drop("2025-07-05")
    folder.run()
    folder.drop("2025-07-03", HEADER + "S,O-T1,O,E,G,2025-07-03 19:00:00\n")
    assert folder.run() == []
    assert ingest_manifest(folder.spark, str(folder.scans)).count() == 2


def test_a_failed_refresh_is_repeated(folder):
    folder.run()
    folder.drop("2025-07-01")
    with pytest.raises(Exception, match="refresh failed"):
        folder.run(fail=True)
    assert folder.run() == ["2025-07-01"]
    assert folder.run() == []


def test_a_replayed_batch_ignores_its_own_log(folder):
    folder.run()
    folder.drop("2025-07-01")
    folder.run()
    last = drops.drop_log(folder.spark, folder.state).agg({"batch_id": "max"}).first()[0]
    assert drops.cursor(folder.spark, folder.state, before_batch=last) == ""
