import json

from assaymill.sources import snapshots
from assaymill.streaming import inbox


def write(path, *records):
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records))


def test_import_resumes_and_keeps_the_first(spark, tmp_path):
    src, table, ckpt = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "ck")
    src.mkdir()
    write(src / "1.jsonl", {"pmc_id": "A", "title": "one"}, "broken", {"title": "no id"})
    merge = inbox.first_per_key(table, ["pmc_id"])
    inbox.drain(inbox.triage_log(spark, str(src)), merge, ckpt)
    write(src / "2.jsonl", {"pmc_id": "A", "title": "two"}, {"pmc_id": "B", "title": "b"})
    inbox.drain(inbox.triage_log(spark, str(src)), merge, ckpt)
    inbox.drain(inbox.triage_log(spark, str(src)), merge, ckpt)
    assert {(r["pmc_id"], r["title"]) for r in snapshots.latest(spark, table).collect()} == {("A", "one"), ("B", "b")}


def test_last_status_wins(spark, tmp_path):
    merge = inbox.last_per_key(str(tmp_path / "t"), ["acc_id"], "offset")
    merge(spark.createDataFrame([(1, "verified", 0), (2, "verified", 1)], "acc_id int, status string, offset long"), 0)
    merge(spark.createDataFrame([(1, "not_in_text", 2)], "acc_id int, status string, offset long"), 1)
    assert {(r["acc_id"], r["status"]) for r in snapshots.latest(spark, str(tmp_path / "t")).collect()} == {(1, "not_in_text"), (2, "verified")}
