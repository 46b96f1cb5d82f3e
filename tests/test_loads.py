import threading
import uuid
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from siltworks.contracts import Contract, Registry
from siltworks.operators.quality import Gate, GateRefused
from siltworks.plans.bronze import Outcome, load_all, load_bronze, merged_delta, run_tables, write_bronze
from siltworks.plans.runs import run_task_status
from siltworks.plans.silver import declare_silver, promote_all, promote_silver, write_clustered
from siltworks.sinks.audit import Run, append_audit, audit_log, compact_audit
from siltworks.sinks.lake import Lake, clustered, expire, load_folders
from siltworks.sources.ledger import file_ledger
from siltworks.sources.tables import tables_to_process

ITEMS = Contract(
    name="items",
    columns="id INT NOT NULL, price DECIMAL(6,2), tag STRING NOT NULL",
    defaults={"tag": "'none'"},
    cluster_by=("price", "id"),
)
RUN = Run("job", "run-1", "task", "1")


@pytest.fixture
def lake(spark, tmp_path):
    token = uuid.uuid4().hex[:8]
    lake = Lake(str(tmp_path / "lake"), bronze=f"b_{token}", silver=f"s_{token}")
    lake.create_schemas(spark)
    yield lake
    lake.drop_schemas(spark)


def land(tmp_path, *lines, name="items", file="a.txt"):
    folder = tmp_path / "landing" / name
    folder.mkdir(parents=True, exist_ok=True)
    (folder / file).write_text("ID^|~PRICE^|~TAG\n" + "".join(f"{x}\n" for x in lines))
    return str(tmp_path / "landing")


def rows(spark, lake, schema, name="items"):
    return sorted(tuple(r) for r in spark.table(lake.table(schema, name)).collect())


def test_bronze_load_is_logged(spark, lake, tmp_path):
    landing = land(tmp_path, "1^|~$2.50^|~a", "x^|~^|~")
    assert load_bronze(spark, lake, ITEMS, landing, RUN).total_rows == 2
    bronze = spark.table(lake.table(lake.bronze, "items"))
    assert bronze.columns == ["ID", "PRICE", "TAG", "ingest_ts", "input_file_name"]
    assert {r["input_file_name"] for r in bronze.collect()} == {"a.txt"}
    log = audit_log(spark, lake, lake.bronze).collect()
    assert [(r["job_run_id"], r["success"], r["record_count"], r["failure_reason"]) for r in log] == [("run-1", 1, 2, None)]
    assert log[0]["source_file_path"].endswith("/items/a.txt") and log[0]["end_time"] >= log[0]["start_time"]


def test_second_load_replaces_the_first(spark, lake, tmp_path):
    landing = land(tmp_path, "1^|~1^|~a")
    load_bronze(spark, lake, ITEMS, landing)
    land(tmp_path, "2^|~2^|~b", "3^|~3^|~c")
    load_bronze(spark, lake, ITEMS, landing)
    assert [r[0] for r in rows(spark, lake, lake.bronze)] == ["2", "3"]
    assert audit_log(spark, lake, lake.bronze).count() == 2


def test_failed_load_leaves_the_table_and_a_log_row(spark, lake, tmp_path):
    landing = land(tmp_path, "1^|~1^|~a")
    load_bronze(spark, lake, ITEMS, landing)
    land(tmp_path, "9^|~9^|~z", file="b.txt")
    with pytest.raises(ValueError):
        load_bronze(spark, lake, ITEMS, landing)
    assert [r[0] for r in rows(spark, lake, lake.bronze)] == ["1"]
    log = audit_log(spark, lake, lake.bronze).filter("success = 0").first()
    assert "expected one" in log["failure_reason"] and log["record_count"] == 0 and log["source_file_path"] is None
    assert load_bronze(spark, lake, ITEMS, landing, single_file=False).total_rows == 2


def test_bronze_keeps_columns_a_later_load_lacks(spark, lake):
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    write_bronze(spark, lake, "t", df)
    write_bronze(spark, lake, "t", df.select("a", F.lit("new").alias("c")))
    assert spark.table(lake.table(lake.bronze, "t")).columns == ["a", "c", "b"]
    assert rows(spark, lake, lake.bronze, "t") == [("1", "new", None)]


def test_empty_load(spark, lake, tmp_path):
    assert load_bronze(spark, lake, ITEMS, land(tmp_path)).total_rows == 0
    assert promote_silver(spark, lake, ITEMS).total_rows == 0
    assert rows(spark, lake, lake.silver) == []


def bronze(spark, lake, *values):
    write_bronze(spark, lake, "items", spark.createDataFrame(list(values), "ID string, PRICE string, TAG string"))


def test_promotion(spark, lake):
    bronze(spark, lake, ("1", "2.505", " a "), ("x", "1", ""))
    report = promote_silver(spark, lake, ITEMS, RUN)
    assert (report.total_rows, report.cast_error_rows, report.column_failures) == (2, 1, {"id": 1})
    got = spark.table(lake.table(lake.silver, "items"))
    assert [str(r["price"]) for r in got.orderBy("price").collect()] == ["1.00", "2.51"]
    # The declared shape survives any number of loads.
    promote_silver(spark, lake, ITEMS, RUN)
    again = Contract.from_table(spark, lake.table(lake.silver, "items"))
    assert again.required == ["id", "tag"] and again.defaults == {"tag": "'none'"}
    assert again.cluster_by == ITEMS.cluster_by


def test_refused_load_changes_nothing(spark, lake):
    bronze(spark, lake, ("1", "1", "a"))
    promote_silver(spark, lake, ITEMS, RUN, Gate(True))
    bronze(spark, lake, ("x", "1", "a"), ("2", "2", "b"))
    with pytest.raises(GateRefused):
        promote_silver(spark, lake, ITEMS, RUN, Gate(True, max_pct=40.0))
    assert [r[0] for r in rows(spark, lake, lake.silver)] == [1]
    log = audit_log(spark, lake, lake.silver).filter("success = 0").first()
    assert "1 of 2 rows" in log["failure_reason"] and log["record_count"] == 0
    promote_silver(spark, lake, ITEMS, RUN, Gate(True, max_pct=50.0))
    assert spark.table(lake.table(lake.silver, "items")).count() == 2


def test_defaults_are_filled_on_request(spark, lake):
    bronze(spark, lake, ("1", "1", " "))
    promote_silver(spark, lake, ITEMS)
    assert rows(spark, lake, lake.silver)[0][2] is None
    promote_silver(spark, lake, ITEMS, defaults=True)
    assert rows(spark, lake, lake.silver)[0][2] == "none"


@pytest.mark.parametrize("cluster", [False, True])
def test_quarantine(spark, lake, cluster):
    bronze(spark, lake, ("1", "1", "a"), ("x", "y", "b"))
    promote_silver(spark, lake, ITEMS, quarantine=True, cluster=cluster)
    assert [r[0] for r in rows(spark, lake, lake.silver)] == [1]
    aside = spark.table(lake.table(lake.silver, "items_dq_quarantine"))
    assert [(r["tag"], tuple(r["landed"]), r["failed_columns"]) for r in aside.collect()] == [("b", ("x", "y", "b"), ["id", "price"])]
    bronze(spark, lake, ("1", "1", "a"))
    promote_silver(spark, lake, ITEMS, quarantine=True)
    assert rows(spark, lake, lake.silver, "items_dq_quarantine") == []
    bronze(spark, lake, ("x", "1", "a"))
    promote_silver(spark, lake, ITEMS, quarantine=True)
    assert rows(spark, lake, lake.silver) == []
    # What an earlier load put aside is gone with the next plain one.
    promote_silver(spark, lake, ITEMS)
    assert not spark.catalog.tableExists(lake.table(lake.silver, "items_dq_quarantine"))


def test_defaults_are_not_written_over_failed_casts(spark, lake):
    contract = Contract(name="items", columns="id INT, ok BOOLEAN, n INT", defaults={"ok": "false", "n": "0"})
    write_bronze(spark, lake, "items", spark.createDataFrame([("1", "maybe", "bad"), ("2", " ", None)], "ID string, OK string, N string"))
    promote_silver(spark, lake, contract, defaults=True)
    assert rows(spark, lake, lake.silver) == [(1, None, None), (2, False, 0)]
    write_bronze(spark, lake, "items", spark.createDataFrame([("1",)], "ID string"))
    fresh = Contract(name="items", columns="id INT, ok BOOLEAN NOT NULL", defaults={"ok": "false"})
    lake.drop_schemas(spark)
    lake.create_schemas(spark)
    write_bronze(spark, lake, "items", spark.createDataFrame([("1",)], "ID string"))
    promote_silver(spark, lake, fresh, defaults=True)
    assert rows(spark, lake, lake.silver) == [(1, False)]


@pytest.mark.parametrize("single", [False, True])
def test_empty_folder_is_refused(spark, lake, tmp_path, single):
    load_bronze(spark, lake, ITEMS, land(tmp_path, "1^|~1^|~a"))
    (tmp_path / "later" / "items").mkdir(parents=True)
    with pytest.raises(FileNotFoundError):
        load_bronze(spark, lake, ITEMS, str(tmp_path / "later"), single_file=single)
    assert [r[0] for r in rows(spark, lake, lake.bronze)] == ["1"]
    log = audit_log(spark, lake, lake.bronze).filter("success = 0").collect()
    assert len(log) == 1 and "no .txt file" in log[0]["failure_reason"]


def test_new_files_are_loaded_once(spark, lake, tmp_path):
    def load():
        load_bronze(spark, lake, ITEMS, landing, single_file=False, only_new=True)
        return [r[0] for r in rows(spark, lake, lake.bronze)]

    landing = land(tmp_path, "1^|~1^|~a")
    assert load() == ["1"]
    land(tmp_path, "2^|~2^|~b", file="b.txt")
    land(tmp_path, file="header_only.txt")
    assert load() == ["2"]
    with pytest.raises(FileNotFoundError):
        load()
    land(tmp_path, "3^|~3^|~corrected", file="a.txt")
    with pytest.raises(ValueError, match="not merged yet"):
        load()
    assert [r[0] for r in rows(spark, lake, lake.bronze)] == ["2"]
    merged_delta(spark, lake.table(lake.bronze, "items"))
    assert load() == ["3"]
    assert file_ledger(spark, lake).count() == 4


def test_archive_below_the_folder_is_not_loaded(spark, lake, tmp_path):
    landing = land(tmp_path, "1^|~1^|~a")
    (tmp_path / "landing" / "items" / "archive").mkdir()
    (tmp_path / "landing" / "items" / "archive" / "old.txt").write_text("ID^|~PRICE^|~TAG\n9^|~9^|~z\n")
    assert load_bronze(spark, lake, ITEMS, landing).total_rows == 1


def test_malformed_lines_are_reported(spark, lake, tmp_path, caplog):
    landing = land(tmp_path, "1^|~1^|~a", "2", "3^|~3^|~c^|~surplus")
    report = load_bronze(spark, lake, ITEMS, landing)
    assert (report.total_rows, report.malformed_rows) == (3, 2) and "2 of 3 lines" in caplog.text
    assert rows(spark, lake, lake.bronze)[1][:3] == ("2", None, None)


def test_measured_failures_are_in_the_outcomes(spark, lake, caplog):
    bronze(spark, lake, ("x", "y", "a"), ("1", "z", "b"), ("2", "2", "c"))
    declare_silver(spark, lake, Registry([ITEMS]))
    out = promote_all(spark, lake, Registry([ITEMS]), RUN).first()
    assert (out["cast_error_rows"], round(out["cast_error_pct"], 3)) == (2, 66.667)
    assert [tuple(c) for c in out["top_columns"]] == [("price", 2), ("id", 1)]
    assert "2 of 3 rows failed a cast" in caplog.text


def test_error_of_a_load_is_not_hidden_by_its_log(spark, lake, tmp_path, monkeypatch):
    def broken(*_):
        raise OSError("log is down")

    monkeypatch.setattr("siltworks.sinks.audit.append_audit", broken)
    with pytest.raises(FileNotFoundError):
        (tmp_path / "none" / "items").mkdir(parents=True)
        load_bronze(spark, lake, ITEMS, str(tmp_path / "none"))
    with pytest.raises(OSError, match="log is down"):
        load_bronze(spark, lake, ITEMS, land(tmp_path, "1^|~1^|~a"))


def test_failed_redeclaration_keeps_the_table(spark, lake, monkeypatch):
    bronze(spark, lake, ("1", "1", "a"))
    promote_silver(spark, lake, ITEMS)
    changed = Contract(name="items", columns="id INT NOT NULL, price DECIMAL(8,2), tag STRING")
    monkeypatch.setattr(Contract, "create_table_sql", lambda *_: "CREATE TABLE not valid")
    with pytest.raises(Exception, match="(?i)syntax"):
        promote_silver(spark, lake, changed)
    assert [r[0] for r in rows(spark, lake, lake.silver)] == [1]


def test_log_days_are_pruned_and_compacted(spark, lake):
    for day in (1, 1, 1, 2, 3, 3):
        append_audit(spark, lake, lake.bronze, [RUN.row(start_time=datetime(2024, 1, day, 5), target_table=str(day), success=1)])
    log = lake.table(lake.bronze, "etl_log")
    plan = run_task_status(spark, log, "run-1", [date(2024, 1, 1)])
    assert plan.count() == 3 and "PartitionFilters: [isnotnull(run_date" in plan._jdf.queryExecution().toString()
    assert compact_audit(spark, lake, lake.bronze, date(2024, 1, 3)) == ["2024-01-01"]
    assert compact_audit(spark, lake, lake.bronze, date(2024, 1, 3)) == []
    assert sorted(r["target_table"] for r in audit_log(spark, lake, lake.bronze).collect()) == list("111233")
    assert spark.sql(f"SHOW PARTITIONS {log}").count() == 4


def test_unread_folders_are_listed_and_removed_on_request_only(spark, lake):
    for n in range(4):
        bronze(spark, lake, (str(n), "1", "a"))
    assert expire(spark, lake, keep=1).count() == 2
    assert expire(spark, lake, keep=1, delete=True).count() == 2
    assert load_folders(spark, lake).count() == 2 and expire(spark, lake, keep=0).count() == 1
    assert [r[0] for r in rows(spark, lake, lake.bronze)] == ["3"]


def test_more_bytes_make_more_clustered_files(spark, lake):
    contract = Contract(name="t", columns="k INT, v BIGINT", cluster_by=("k",))
    counts = []
    for n in (20_000, 40_000):
        # A third of the rows share one key.
        df = spark.range(0, n, 1, 4).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).cast("int").alias("k"), F.rand(1).alias("r"))
        staged, out = lake.new_location(lake.silver, "t"), lake.new_location(lake.silver, "t")
        df.select("k", (F.col("r") * 2**62).cast("long").alias("v")).write.parquet(staged)
        write_clustered(spark, contract, staged, out, 40_000)
        rows_of = spark.read.parquet(out).groupBy(F.col("_metadata.file_name")).count().collect()
        counts.append(len(rows_of))
        assert max(r["count"] for r in rows_of) < n / 3
    assert 1.7 <= counts[1] / counts[0] <= 2.3


def test_clustered_files_hold_separate_ranges_even_for_one_hot_key(spark, tmp_path):
    df = spark.range(0, 30000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("k"), F.col("id").alias("v")
    )
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled",)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        clustered(df, ("k",), 8).write.parquet(f"{tmp_path}/c")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = (
        spark.read.parquet(f"{tmp_path}/c")
        .groupBy(F.col("_metadata.file_name"))
        .agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.count("*").alias("n"))
        .orderBy("lo", "hi")
        .collect()
    )
    assert sum(r["n"] for r in files) == 30000
    assert all(a["hi"] <= b["lo"] for a, b in zip(files, files[1:]))
    # The key with a third of the rows is spread over several files.
    assert sum(r["lo"] <= 7 <= r["hi"] for r in files) >= 2
    assert max(r["n"] for r in files) < 10000


def test_run_tables_stops_at_the_first_error_or_collects(spark):
    seen, lock = [], threading.Lock()

    def load(name):
        with lock:
            seen.append(name)
        if name == "b":
            raise RuntimeError("no b")
        return Outcome(name, True, 1)

    with pytest.raises(RuntimeError, match="no b"):
        run_tables(spark, ["c", "b", "a"], load)
    assert seen == ["a", "b"]
    seen.clear()
    out = run_tables(spark, ["c", "b", "a"], load, fail_fast=False, parallel=3).collect()
    assert sorted(seen) == ["a", "b", "c"]
    assert [tuple(r)[:4] for r in out] == [("a", True, 1, None), ("b", False, 0, "no b"), ("c", True, 1, None)]


def test_all_tables(spark, lake, tmp_path):
    other = Contract(name="other", columns=ITEMS.columns, source_folder="OTHER")
    registry = Registry([ITEMS, other])
    landing = land(tmp_path, "1^|~1^|~a")
    land(tmp_path, "5^|~5^|~e", "6^|~6^|~f", name="OTHER")
    out = load_all(spark, lake, registry, landing, RUN, parallel=2)
    assert [tuple(r)[:3] for r in out.collect()] == [("items", True, 1), ("other", True, 2)]
    with pytest.raises(ValueError):
        tables_to_process(spark, lake)
    declare_silver(spark, lake, registry)
    audit_log(spark, lake, lake.silver)
    spark.sql(f"CREATE TABLE {lake.table(lake.silver, 'items_dq_quarantine')} (x INT) USING parquet")
    spark.sql(f"CREATE TABLE {lake.table(lake.silver, 'not_landed')} (x INT) USING parquet")
    spark.range(1).createOrReplaceTempView("only_a_view")
    assert tables_to_process(spark, lake) == ["items", "other"]
    assert tables_to_process(spark, lake, " ITEMS ") == ["items"]
    with pytest.raises(ValueError):
        tables_to_process(spark, lake, "nope")
    out = promote_all(spark, lake, registry, RUN)
    assert [tuple(r)[:3] for r in out.collect()] == [("items", True, 1), ("other", True, 2)]
    assert rows(spark, lake, lake.silver, "other")[0][0] == 5


def test_log_appends_at_the_same_time_are_all_kept(spark, lake):
    def add(i):
        append_audit(spark, lake, lake.bronze, [RUN.row(target_table=str(i))])

    threads = [threading.Thread(target=add, args=(i,)) for i in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(r["target_table"] for r in audit_log(spark, lake, lake.bronze).collect()) == [str(i) for i in range(8)]


def test_a_reader_during_compaction_sees_each_row_once(spark, lake, monkeypatch):
    def add(day, n):
        append_audit(spark, lake, lake.bronze, [RUN.row(start_time=datetime(2024, 1, day, 5), target_table=f"{day}-{n}", success=1)])

    for n in range(4):
        add(1, n)
    add(2, 0)
    log, run, seen = lake.table(lake.bronze, "etl_log"), type(spark).sql, []

    def watched(session, text, *args, **named):
        out = run(session, text, *args, **named)
        if text.startswith("ALTER"):
            with pytest.MonkeyPatch.context() as patch:
                patch.setattr(type(spark), "sql", run)
                names = sorted(r["target_table"] for r in audit_log(spark, lake, lake.bronze).collect())
                seen.append((names, run_task_status(spark, log, "run-1").count(), run_task_status(spark, log, "run-1", [date(2024, 1, 1)]).count()))
        return out

    everything = ["1-0", "1-1", "1-2", "1-3", "2-0"]
    with monkeypatch.context() as patch:
        patch.setattr(type(spark), "sql", watched)
        assert compact_audit(spark, lake, lake.bronze, date(2024, 1, 3)) == ["2024-01-01"]
    assert len(seen) == 5 and all(s == (everything, 5, 4) for s in seen), seen
    add(1, 4)  # late, to a day that is closed
    assert sorted(r["target_table"] for r in audit_log(spark, lake, lake.bronze).collect()) == sorted([*everything, "1-4"])
    # Cut short after the switch: hidden appends stay hidden, and the next run takes them out.
    with monkeypatch.context() as patch:

        def cut(session, text, *args, **named):
            if "DROP IF EXISTS PARTITION" in text:
                raise OSError("cut short")
            return run(session, text, *args, **named)

        patch.setattr(type(spark), "sql", cut)
        with pytest.raises(OSError):
            compact_audit(spark, lake, lake.bronze, date(2024, 1, 3))
    assert audit_log(spark, lake, lake.bronze).count() == run_task_status(spark, log, "run-1").count() == 6
    assert compact_audit(spark, lake, lake.bronze, date(2024, 1, 3)) == []
    assert spark.sql(f"SHOW PARTITIONS {log}").count() == 2 and audit_log(spark, lake, lake.bronze).count() == 6


def test_extracts_are_fetched_by_turns_and_discarded(spark, lake, tmp_path):
    """Each table's extract arrives before its load and is gone after it; that of a failed load stays."""
    registry = Registry([Contract(name=n, columns="id BIGINT NOT NULL, price DECIMAL(6,2), tag STRING") for n in ("a", "b", "c")])
    landing, seen = tmp_path / "landing", []

    def arrive(name):
        seen.append((name, sorted(f.parent.name for f in landing.glob("*/*.txt"))))
        land(tmp_path, f"1^|~1^|~{name}", name=name)
        if name == "b":
            land(tmp_path, "2^|~2^|~b", name=name, file="second.txt")

    out = load_all(spark, lake, registry, str(landing), RUN, fail_fast=False, before=arrive, discard=True)
    assert {r["table_name"]: (r["success"], r["record_count"]) for r in out.collect()} == {"a": (True, 1), "b": (False, 0), "c": (True, 1)}
    assert seen == [("a", []), ("b", []), ("c", ["b", "b"])]
    assert sorted(f.name for f in landing.glob("*/*.txt")) == ["a.txt", "second.txt"]
    assert [r[2] for r in rows(spark, lake, lake.bronze, "c")] == ["c"] and file_ledger(spark, lake).count() == 2


def test_an_extract_is_loaded_by_parts(spark, lake, tmp_path):
    """A part is in the landing at a time; the table is published, logged and entered in the ledger once, with all of them."""
    registry = Registry([Contract(name=n, columns="id BIGINT NOT NULL, price DECIMAL(6,2), tag STRING") for n in ("a", "b")])
    landing, seen = tmp_path / "landing", []

    def arrive(name):
        for part in range(3 if name == "a" else 0):
            table = lake.table(lake.bronze, name)
            seen.append((part, sorted(f.name for f in landing.glob("*/*.txt")), spark.catalog.tableExists(table)))
            land(tmp_path, f"{part}^|~1^|~a", f"{part}^|~1^|~a", "short", name=name, file=f"{part}.txt")
            yield part

    out = load_all(spark, lake, registry, str(landing), RUN, fail_fast=False, before=arrive, single_file=False, discard=True)
    found = {r["table_name"]: (r["success"], r["record_count"], r["malformed_rows"]) for r in out.collect()}
    assert found == {"a": (True, 9, 3), "b": (False, 0, None)}
    assert seen == [(0, [], False), (1, [], False), (2, [], False)] and not list(landing.glob("*/*.txt"))
    loaded = rows(spark, lake, lake.bronze, "a")
    assert sorted(r[0] for r in loaded) == sorted([*"001122", *["short"] * 3]) and {r[4] for r in loaded} == {"0.txt", "1.txt", "2.txt"}
    log = {r["target_table"].split("`")[3]: r for r in audit_log(spark, lake, lake.bronze).collect()}
    assert (log["a"]["success"], log["a"]["record_count"]) == (1, 9) and log["a"]["source_file_path"].endswith("/landing/a")
    assert "no .txt file" in log["b"]["failure_reason"] and file_ledger(spark, lake).count() == 3
    assert load_folders(spark, lake).where("name = 'a'").count() == 1


def test_a_load_that_fails_in_a_later_part_leaves_the_table(spark, lake, tmp_path):
    load_bronze(spark, lake, ITEMS, land(tmp_path, "1^|~1^|~a"), RUN)
    (tmp_path / "landing" / "items" / "a.txt").unlink()

    def fetch():
        yield land(tmp_path, "2^|~2^|~b", file="b.txt")
        raise OSError("source is down")

    for options in ({}, {"single_file": False}):
        with pytest.raises(ValueError, match="parts are files"):
            load_bronze(spark, lake, ITEMS, str(tmp_path / "landing"), RUN, parts=fetch(), **options)
    with pytest.raises(OSError, match="source is down"):
        load_bronze(spark, lake, ITEMS, str(tmp_path / "landing"), RUN, single_file=False, discard=True, parts=fetch())
    assert [r[0] for r in rows(spark, lake, lake.bronze)] == ["1"] and file_ledger(spark, lake).count() == 1
    assert audit_log(spark, lake, lake.bronze).where("failure_reason = 'source is down'").count() == 1
