import itertools
import random
import uuid
from datetime import datetime

import pytest

from siltworks.contracts import Contract
from siltworks.operators.quality import Gate, GateRefused
from siltworks.plans import keyed
from siltworks.plans.bronze import load_bronze, write_bronze
from siltworks.plans.keyed import merge_silver
from siltworks.plans.silver import promote_silver
from siltworks.sinks import versions
from siltworks.sinks.lake import Lake, expire
from siltworks.sinks.versions import current, read_quarantine, read_silver

ITEMS = Contract(
    name="items", columns="id INT NOT NULL, part STRING NOT NULL, at TIMESTAMP, price DECIMAL(8,2), note STRING", unique_keys=(("id", "part"),)
)
SOURCE = "ID string, PART string, AT string, PRICE string, NOTE string"


@pytest.fixture
def lake(spark, tmp_path):
    token = uuid.uuid4().hex[:8]
    lake = Lake(str(tmp_path / "lake"), bronze=f"b_{token}", silver=f"s_{token}")
    lake.create_schemas(spark)
    yield lake
    lake.drop_schemas(spark)


def merge(spark, lake, rows, **options):
    write_bronze(spark, lake, "items", spark.createDataFrame(rows, SOURCE))
    return merge_silver(spark, lake, ITEMS, **{"latest_by": ["at"], **options})


def held(spark, lake):
    return sorted((tuple(map(str, r)) for r in spark.table(lake.table(lake.silver, "items")).collect()))


def delivery(rng, n):
    out = []
    for _ in range(n):
        day = rng.randrange(1, 29)
        out.append((
            rng.choice(["7", str(rng.randrange(200)), "bad", "", "99999999999"]) if rng.random() < 0.4 else str(rng.randrange(200)),
            rng.choice(["a", "b", " "]), rng.choice([f"2024-01-{day:02d} 10:00:00", ""]), rng.choice(["1.5", "$2", "x", ""]), f"n{rng.randrange(3)}",
        ))
    return out


def best(rows):
    """The latest row of each key, and how many rows are put aside."""
    found, aside = {}, 0
    for id_, part, at, price, note in rows:
        number = int(id_) if id_.isdigit() and len(id_) < 9 else None
        if number is None or not part.strip() or price == "x":
            aside += 1
            continue
        row = (at or "", {"1.5": "1.50", "$2": "2.00", "": ""}[price], note)
        key = (number, part.strip())
        found[key] = max(found.get(key, row), row)
    shown = sorted((str(k), p, at or "None", price or "None", note) for (k, p), (at, price, note) in found.items())
    return shown, aside


def test_deliveries_in_any_order_are_one_load_of_all(spark, lake):
    rng = random.Random(3)
    parts = [delivery(rng, 150) for _ in range(3)]
    want, aside = best([r for p in parts for r in p])
    for order in ((0, 1, 2), (2, 0, 1)):
        for i in (*order, order[0]) if order[0] else order:  # one comes twice
            report = merge(spark, lake, parts[i], bucket_bytes=2000)
        assert held(spark, lake) == want
        assert sorted(tuple(map(str, r)) for r in read_silver(spark, lake, ITEMS).collect()) == want
        assert report.rows_total == len(want) and report.buckets > 1
        assert spark.table(lake.table(lake.silver, "items_dq_quarantine")).count() == aside + (best(parts[2])[1] if order[0] else 0)
        lake.drop_schemas(spark)
        lake.create_schemas(spark)


def test_only_touched_buckets_are_rewritten(spark, lake):
    rows = [(str(i), "a", "2024-01-01 00:00:00", "1", "x" * 50) for i in range(4000)]
    merge(spark, lake, rows, bucket_bytes=4000)
    before = current(spark, lake, "items")
    report = merge(spark, lake, [("17", "a", "2024-01-02 00:00:00", "2", "new"), ("18", "a", "2023-01-02 00:00:00", "2", "stale")], bucket_bytes=4000)
    after = current(spark, lake, "items")
    assert before.buckets == after.buckets >= 8 and 1 <= report.touched <= 2
    assert len(set(before.parts) & set(after.parts)) == len(before.parts) - report.touched
    assert 0 < report.bytes_rewritten < report.bytes_total / 3 and report.rows_total == 4000
    got = {r["id"]: r["note"] for r in spark.table(lake.table(lake.silver, "items")).where("id in (17, 18)").collect()}
    assert got == {17: "new", 18: "x" * 50}
    plan = spark.table(lake.table(lake.silver, "items"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


def test_buckets_grow_with_the_table(spark, lake):
    sizes = []
    for k in range(3):
        report = merge(spark, lake, [(str(i), "a", "", "1", uuid.uuid4().hex) for i in range(k * 1500, k * 1500 + 1500)], bucket_bytes=20_000)
        sizes.append(report.buckets)
        assert report.rows_total == 1500 * (k + 1)
    assert sizes[0] < sizes[2] and spark.table(lake.table(lake.silver, "items")).count() == 4500


def test_a_hot_key_is_one_row(spark, lake):
    rows = [("1", "a", f"2024-01-{d:02d} 00:00:00", "1", f"n{i}") for i in range(200) for d in (1, 2)] + [(str(i), "b", "", "1", "") for i in range(200)]
    assert merge(spark, lake, rows).rows_total == 201
    assert [r["note"] for r in spark.table(lake.table(lake.silver, "items")).where("id = 1 and part = 'a'").collect()] == ["n99"]


def test_without_latest_by_the_later_delivery_wins(spark, lake):
    merge(spark, lake, [("1", "a", "", "1", "z")], latest_by=[], delivered=datetime(2024, 1, 1))
    merge(spark, lake, [("1", "a", "", "1", "b"), ("1", "a", "", "1", "a")], latest_by=[], delivered=datetime(2024, 1, 2))
    assert held(spark, lake) == [("1", "a", "None", "1.00", "b")]
    merge(spark, lake, [("1", "a", "", "1", "old")], latest_by=[], delivered=datetime(2023, 1, 2))
    assert held(spark, lake) == [("1", "a", "None", "1.00", "b")]


def test_refused_failed_and_concurrent_merges_change_nothing(spark, lake, monkeypatch):
    merge(spark, lake, [("1", "a", "", "1", "x"), ("bad", "a", "", "1", "x")])
    before = held(spark, lake), spark.table(lake.table(lake.silver, "items_dq_quarantine")).count()
    with pytest.raises(GateRefused):
        merge(spark, lake, [("2", "a", "", "1", "x"), ("bad", "a", "", "1", "x")], gate=Gate(True))
    run, calls = type(spark).sql, []

    def failing(at):
        def sql(session, text, *args, **named):
            if text.lstrip().startswith(("ALTER", "CREATE", "DROP")) and "etl_log" not in text and "TBLPROPERTIES" not in text:
                calls.append(text)
                if len(calls) == at:
                    raise OSError("down")
            return run(session, text, *args, **named)

        return sql

    for at in itertools.count(1):
        write_bronze(spark, lake, "items", spark.createDataFrame([("2", "a", "", "1", "x"), ("worse", "a", "", "1", "x")], SOURCE))
        calls.clear()
        with monkeypatch.context() as patch:
            patch.setattr(type(spark), "sql", failing(at))
            try:
                merge_silver(spark, lake, ITEMS, latest_by=["at"])
            except OSError:
                pass
        now = held(spark, lake), spark.table(lake.table(lake.silver, "items_dq_quarantine")).count()
        if now != before:
            break
        assert len(calls) >= at and read_quarantine(spark, lake, "items").count() == 1, calls
    # Either after all calls, or where nothing is left to be done but to tidy up.
    assert now[1] == 2 and len(now[0]) == 2 and at >= 5

    enter = versions.enter

    def late(*args):
        monkeypatch.setattr(versions, "enter", enter)
        merge(spark, lake, [("3", "a", "", "1", "x")])
        return enter(*args)

    monkeypatch.setattr(versions, "enter", late)
    with pytest.raises(versions.LoadConflict):
        merge(spark, lake, [("4", "a", "", "1", "x")])
    assert [r[0] for r in held(spark, lake)] == ["1", "2", "3"]


def test_new_files_are_merged_and_never_replace(spark, lake, tmp_path):
    folder = tmp_path / "landing" / "items"
    folder.mkdir(parents=True)

    def load(name, *ids):
        (folder / name).write_text("ID^|~PART^|~AT^|~PRICE^|~NOTE\n" + "".join(f"{i}^|~a^|~^|~1^|~{name}\n" for i in ids))
        return load_bronze(spark, lake, ITEMS, str(tmp_path / "landing"), single_file=False, only_new=True)

    load("a.txt", 1, 2)
    merge_silver(spark, lake, ITEMS)
    load("b.txt", 2, 3)
    with pytest.raises(ValueError, match="only what was new"):
        promote_silver(spark, lake, ITEMS)
    with pytest.raises(ValueError, match="not merged yet"):
        load("c.txt", 4)
    merge_silver(spark, lake, ITEMS)
    load("c.txt", 4)
    merge_silver(spark, lake, ITEMS)
    assert [(r[0], r[4]) for r in held(spark, lake)] == [("1", "a.txt"), ("2", "b.txt"), ("3", "b.txt"), ("4", "c.txt")]
    with pytest.raises(ValueError, match="merged by key"):
        promote_silver(spark, lake, ITEMS, complete=True)
    expire(spark, lake, keep=0, delete=True)
    assert len(held(spark, lake)) == 4


def test_a_table_that_cannot_be_merged(spark, lake):
    write_bronze(spark, lake, "items", spark.createDataFrame([("1", "a", "", "1", "x")], SOURCE))
    with pytest.raises(ValueError, match="no unique key"):
        merge_silver(spark, lake, Contract(name="items", columns=ITEMS.columns))
    promote_silver(spark, lake, ITEMS)
    with pytest.raises(ValueError, match="published as a whole"):
        merge_silver(spark, lake, ITEMS)


def test_nothing_but_failing_rows_and_nothing_at_all(spark, lake):
    assert merge(spark, lake, [("bad", "a", "", "1", "x"), ("1", " ", "", "1", "x")]).rows_total == 0
    assert held(spark, lake) == []
    reasons = {r["landed"]["id"]: r["failed_columns"] for r in read_quarantine(spark, lake, "items").collect()}
    assert reasons == {"bad": ["id"], "1": ["part"]}
    write_bronze(spark, lake, "items", spark.createDataFrame([], SOURCE))
    assert merge_silver(spark, lake, ITEMS).touched == 0
    assert merge(spark, lake, [("1", "a", "", "1", "x")]).rows_total == 1
    assert keyed.key_of(ITEMS) == ["id", "part"]


def test_parts_no_version_reads_go_by_the_statement_not_one_by_one(spark, lake, monkeypatch):
    """Five merges of all keys leave the buckets of two that no version names; the catalog is asked once for many."""
    real, dropped = type(spark).sql, []

    def sql(self, text, *args, **more):
        if text.startswith("ALTER TABLE") and "__parts" in text and " DROP " in text:
            dropped.append(text.count("PARTITION ("))
        return real(self, text, *args, **more)

    monkeypatch.setattr(type(spark), "sql", sql)
    for k in range(5):
        rows = [(str(i), "a", f"2024-01-0{k + 1} 00:00:00", "1", uuid.uuid4().hex) for i in range(200)]
        report = merge(spark, lake, rows, bucket_bytes=2000)
    assert report.rows_total == 200 and report.buckets >= 4
    assert 1 <= len(dropped) <= 2 and sum(dropped) > len(dropped)
