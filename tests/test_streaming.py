import os
import time
import uuid

import pytest

from siltworks.contracts import Contract
from siltworks.operators.projection import ROW_FAILED, check_contract
from siltworks.operators.quality import Gate
from siltworks.plans.bronze import write_bronze
from siltworks.plans.keyed import merge_delivery, merge_silver
from siltworks.sinks.audit import Run, audit_log
from siltworks.sinks.lake import Lake
from siltworks.sinks.versions import current, read_quarantine
from siltworks.sources.delimited import scan_delimited
from siltworks.streaming.ingest import read_new_files, stream_bronze, stream_keyed, stream_silver

ITEMS = Contract(name="items", columns="id INT NOT NULL, at DATE")


@pytest.fixture
def new_lake(spark, tmp_path):
    made = []

    def make():
        token = uuid.uuid4().hex[:8]
        lake = Lake(str(tmp_path / f"lake-{token}"), bronze=f"b_{token}", silver=f"s_{token}")
        lake.create_schemas(spark)
        made.append(lake)
        return lake

    yield make
    for lake in made:
        lake.drop_schemas(spark)


def put(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("ID^|~AT\n" + "".join(f"{x}\n" for x in lines))


def test_each_file_is_loaded_once(spark, tmp_path):
    landing, out = tmp_path / "landing", str(tmp_path / "out")

    def run():
        lines = read_new_files(spark, str(landing), ITEMS, archive_to=str(tmp_path / "archive"), max_bytes_per_trigger=1 << 20)
        stream_bronze(lines, out, str(tmp_path / "cp")).awaitTermination()
        return sorted(r["ID"] for r in spark.read.parquet(out).collect())

    put(landing, "a.txt", "1^|~2024-01-05", "2^|~")
    put(landing, "skipped.csv", "9^|~")
    assert run() == ["1", "2"]
    assert run() == ["1", "2"]
    put(landing, "b.TXT", "3^|~x")
    assert run() == ["1", "2", "3"]
    names = {r["input_file_name"] for r in spark.read.parquet(out).collect()}
    assert names == {"a.txt", "b.TXT"}


def test_old_files_are_loaded_too(spark, tmp_path):
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    for name, age_days in (("a.txt", 0), ("b.txt", 365), ("c.txt", 0)):
        put(landing, name, f"{name[0]}^|~")
        moment = time.time() - age_days * 86400
        os.utime(landing / name, (moment, moment))
        stream_bronze(read_new_files(spark, str(landing), ITEMS), out, str(tmp_path / "cp")).awaitTermination()
    assert sorted(r["ID"] for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_batches_are_logged_and_keep_what_failed(spark, tmp_path):
    token = uuid.uuid4().hex[:8]
    lake = Lake(str(tmp_path / "lake"), bronze=f"b_{token}", silver=f"s_{token}")
    lake.create_schemas(spark)
    landing = tmp_path / "landing"
    for name, line in (("a.txt", "x^|~bad"), ("b.txt", "1^|~2024-01-05")):
        put(landing, name, line)
        lines = read_new_files(spark, str(landing), ITEMS)
        stream_silver(lines, ITEMS, str(tmp_path / "out"), str(tmp_path / "cp"), lake=lake, run=Run("j", "r")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("batch").collect()
    assert [(r["id"], r["failed_columns"]) for r in got] == [(None, ["id", "at"]), (1, [])]
    assert tuple(got[0]["landed"]) == ("x", "bad") and got[1]["landed"] is None
    log = audit_log(spark, lake, lake.silver).collect()
    assert sorted((r["source_table"], r["record_count"], r["success"]) for r in log) == [("batch 0", 1, 1), ("batch 1", 1, 1)]
    lake.drop_schemas(spark)


def test_stream_gives_what_batch_gives(spark, tmp_path):
    landing = tmp_path / "landing"
    put(landing, "a.txt", "1^|~2024-01-05", "x^|~01/05/2024")
    put(landing, "b.txt", "3^|~nope", "^|~")
    lines = read_new_files(spark, str(landing), ITEMS)
    stream_silver(lines, ITEMS, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "out")).selectExpr("id", "at", "cast(dq_failed as boolean)")
    batch = check_contract(scan_delimited(spark, str(landing), ITEMS.source_schema), ITEMS)
    key = lambda r: str(tuple(r))
    assert sorted(map(key, streamed.collect())) == sorted(map(key, batch.select("id", "at", ROW_FAILED).collect()))


KEYED = Contract(name="items", columns="id INT NOT NULL, at DATE, n INT", unique_keys=(("id",),))


def keyed_run(spark, tmp_path, lake, **options):
    lines = read_new_files(spark, str(tmp_path / "landing"), KEYED)
    stream_keyed(lines, KEYED, str(tmp_path / "cp"), lake=lake, latest_by=["at"], **options).awaitTermination()
    return sorted((r["id"], str(r["at"]), r["n"]) for r in spark.table(lake.table(lake.silver, "items")).collect())


def put_keyed(tmp_path, name, *lines):
    (tmp_path / "landing").mkdir(exist_ok=True)
    (tmp_path / "landing" / name).write_text("ID^|~AT^|~N\n" + "".join(f"{x}\n" for x in lines))


def test_keys_repeated_over_batches_and_restarts_give_what_one_batch_gives(spark, tmp_path, new_lake):
    lake = new_lake()
    files = {
        "a.txt": ["1^|~2024-01-05^|~1", "2^|~2024-01-05^|~2", "x^|~2024-01-05^|~9"],
        "b.txt": ["1^|~2024-01-07^|~3", "2^|~2024-01-01^|~4", "3^|~^|~5", "1^|~2024-01-05^|~1"],
        "c.txt": ["1^|~2024-01-05^|~1", "3^|~2024-01-01^|~bad"],
        "d.txt": ["2^|~2024-01-05^|~2", "x^|~2024-01-05^|~9"],
    }
    for name, lines in files.items():
        put_keyed(tmp_path, name, *lines)
        got = keyed_run(spark, tmp_path, lake)
    seen = current(spark, lake, "items")
    assert keyed_run(spark, tmp_path, lake) == got and current(spark, lake, "items") == seen
    assert got == [(1, "2024-01-07", 3), (2, "2024-01-05", 2), (3, "None", 5)]
    # d.txt holds nothing that was not met before: three versions for four files.
    assert seen.number == 3
    aside = sorted(r["landed"]["id"] for r in read_quarantine(spark, lake, "items").collect())
    assert aside == ["3", "x"]
    other = new_lake()
    write_bronze(spark, other, "items", scan_delimited(spark, str(tmp_path / "landing"), KEYED.source_schema))
    merge_silver(spark, other, KEYED, latest_by=["at"])
    assert sorted((r["id"], str(r["at"]), r["n"]) for r in spark.table(other.table(other.silver, "items")).collect()) == got
    log = audit_log(spark, lake, lake.silver).collect()
    assert sorted(r["record_count"] for r in log if r["record_count"]) == [1, 3, 3] and all(r["success"] == 1 for r in log)


def test_a_refused_batch_stops_the_stream_and_is_taken_up_again(spark, tmp_path, new_lake):
    lake = new_lake()
    put_keyed(tmp_path, "a.txt", "1^|~2024-01-05^|~1")
    keyed_run(spark, tmp_path, lake, gate=Gate(True))
    put_keyed(tmp_path, "b.txt", "2^|~2024-01-05^|~2", "x^|~^|~")
    with pytest.raises(Exception, match="1 of 2 rows failed"):
        keyed_run(spark, tmp_path, lake, gate=Gate(True))
    assert [r["id"] for r in spark.table(lake.table(lake.silver, "items")).collect()] == [1]
    assert [r[0] for r in keyed_run(spark, tmp_path, lake, gate=Gate(True, max_pct=60.0))] == [1, 2]


def test_a_batch_that_was_published_before_a_crash_is_not_merged_twice(spark, tmp_path, new_lake):
    lake = new_lake()
    put_keyed(tmp_path, "a.txt", "1^|~2024-01-05^|~1", "x^|~^|~")

    def crash(*args, **kwargs):
        merge_delivery(*args, **kwargs)
        raise OSError("lost after publishing")

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr("siltworks.streaming.ingest.merge_delivery", crash)
        with pytest.raises(Exception, match="lost after publishing"):
            keyed_run(spark, tmp_path, lake)
    assert keyed_run(spark, tmp_path, lake) == [(1, "2024-01-05", 1)]
    assert read_quarantine(spark, lake, "items").count() == 1 and current(spark, lake, "items").number == 1
