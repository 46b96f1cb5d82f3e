from datetime import datetime

from pyspark.sql import functions as F

from siltworks.contracts import Contract
from siltworks.operators import constraints as c
from siltworks.operators.constraints import (
    fill_defaults,
    fk_orphans,
    not_null_audit,
    quarantined_rows,
    unique_key_violations,
    valid_rows,
)
from siltworks.operators.projection import check_contract, project_contract

CONTRACT = Contract(
    name="t",
    columns="id INT NOT NULL, tag STRING NOT NULL, n INT, at TIMESTAMP",
    defaults={"tag": "'blank'", "n": "0", "at": "current_timestamp()"},
)


def source(spark):
    return spark.createDataFrame(
        [("1", "a", "5", ""), ("x", " ", "", ""), ("3", None, "y", "2024-01-05")],
        "id string, tag string, n string, at string",
    )


def test_split_keeps_every_row(spark):
    checked = check_contract(source(spark), CONTRACT, keep_raw=True)
    good, bad = valid_rows(checked, CONTRACT).collect(), quarantined_rows(checked).collect()
    assert [r["id"] for r in good] == [1]
    assert [(r["id"], r["n"], r["failed_columns"]) for r in bad] == [("x", "", ["id"]), ("3", "y", ["n"])]


def test_filters_do_not_repeat_the_casts(spark):
    checked = check_contract(source(spark), CONTRACT)
    plan = valid_rows(checked, CONTRACT)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MM/dd/yyyy HH:mm:ss") == 1


def test_not_null_audit_counts_zero_too(spark):
    rows = not_null_audit(project_contract(source(spark), CONTRACT), CONTRACT).collect()
    assert [tuple(r) for r in rows] == [(3, "id", 1), (3, "tag", 2)]


def test_defaults(spark):
    now = datetime(2024, 1, 31, 6, 30)
    rows = fill_defaults(check_contract(source(spark), CONTRACT), CONTRACT, now).collect()
    assert [(r["tag"], r["n"], r["at"]) for r in rows] == [
        ("a", 5, now), ("blank", 0, now), ("blank", None, datetime(2024, 1, 5)),
    ]


def test_one_key_holding_a_third_of_the_rows(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    assert [tuple(r) for r in unique_key_violations(df, ["k"]).collect()] == [(-1, 3000)]
    parent = spark.range(9000).withColumnRenamed("id", "pk")
    assert [tuple(r) for r in fk_orphans(df, "k", parent, "pk").collect()] == [(-1, 3000)]


def test_missing_references_are_not_orphans(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,)], "pk long")
    assert [tuple(r) for r in fk_orphans(child, "k", parent, "pk").collect()] == [(2, 1)]


def test_child_is_reduced_before_the_join(spark):
    child, parent = spark.range(100).toDF("k"), spark.range(50).toDF("pk")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = fk_orphans(child, "k", parent, "pk")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # One exchange for the aggregate, reused by the join, and one for the parent.
    assert plan.count("Exchange hashpartitioning") == 2


def test_all_keys_in_one_pass(spark):
    df = spark.createDataFrame(
        [(1, "a", 1.5), (1, "a", 1.5), (1, "b", None), (2, None, 1.5), (2, None, 2.5), (None, "c", 9.0), (None, "c", 9.0)], "id int, part string, price double"
    )
    keys = [("id", "part"), ("price",), ("part", "price"), ("id",)]
    got = c.all_key_violations(df, keys)
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    want = {}
    for k in keys:
        for r in c.unique_key_violations(df.dropna(subset=list(k)), k).collect():
            want[",".join(k), tuple(str(r[x]) for x in k)] = r["n_rows"]
    assert {(r["key"], tuple(r["key_values"])): r["n_rows"] for r in got.collect()} == want and len(want) == 7
