"""Building the queries' text: a table of one row group is dealt out over tasks."""

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from siltworks.queries.inputs import LEAST_ROWS, MOST_PARTS, dirty, feed_parts, feed_sql, land_parts


def given(folder, n):
    """Orders in one row group; keys repeat, and some are missing."""
    keys = pa.array([None if i % 10 == 0 else i // 2 for i in range(n)], pa.int64())
    pq.write_table(pa.table({"o_orderkey": keys}), folder / "orders.parquet", row_group_size=max(1, n))
    return str(folder)


SQL = "select cast(o_orderkey as string) as o_orderkey from {orders}"


def test_one_row_group_is_made_text_of_in_several_tasks(spark, tmp_path):
    n = 3 * LEAST_ROWS
    text = dirty(spark, given(tmp_path, n), SQL)
    of_task = [r["count"] for r in text.groupBy(F.spark_partition_id()).count().collect()]
    assert len(of_task) == 3 and max(of_task) < 0.5 * n
    expected = sorted(str(i // 2) for i in range(n) if i % 10)
    rows = [r[0] for r in text.collect()]
    assert len(rows) == n and sorted(x for x in rows if x is not None) == expected


def test_few_rows_and_none_stay_in_their_task(spark, tmp_path):
    for n in (0, 1000):
        folder = tmp_path / str(n)
        folder.mkdir()
        text = dirty(spark, given(folder, n), SQL)
        assert text.count() == n
        assert "RoundRobin" not in text._jdf.queryExecution().toString()


def test_dealt_out_rows_stay_in_runs_of_their_order(spark, tmp_path):
    """Rows that lie side by side in the table do so in the text, but for the ends of runs: a shuffled order packs badly."""
    n = 3 * LEAST_ROWS
    text = dirty(spark, given(tmp_path, n), SQL).select(F.col("o_orderkey").cast("long").alias("k"), F.spark_partition_id().alias("p"))
    keys = [r["k"] for r in text.where("k is not null").collect()]
    assert len(keys) == sum(1 for i in range(n) if i % 10)
    assert sum(not 0 <= b - a <= 1 for a, b in zip(keys, keys[1:])) < 60


def test_a_scan_with_a_task_a_core_is_not_shuffled(spark, tmp_path):
    n = 10 * LEAST_ROWS
    folder = tmp_path / "orders.parquet"
    folder.mkdir()
    for i in range(16):
        pq.write_table(pa.table({"o_orderkey": pa.array(range(i * n, (i + 1) * n), pa.int64())}), folder / f"{i}.parquet")
    text = dirty(spark, str(tmp_path), SQL)
    assert "Exchange" not in text._jdf.queryExecution().executedPlan().toString() and text.count() == 16 * n


def orders(folder, at, n):
    """Orders with keys that are missing or repeat, whole rows too."""
    keys = [None if i % 10 == 0 else i // 4 for i in range(n)]
    rows = {"o_orderkey": pa.array(keys, pa.int64()), "o_orderstatus": pa.array(["P" if k is None else "FO"[k % 2] for k in keys])}
    pq.write_table(pa.table(rows), folder / f"{at}.parquet", row_group_size=10_000)


def test_parts_of_an_extract_have_each_row_once(spark, tmp_path):
    folder = tmp_path / "orders.parquet"
    folder.mkdir()
    for at, n in enumerate((60_000, 30_000, 100, 0)):
        orders(folder, at, n)
    columns, total = ["CONTRACT_NUM", "SUSPEND_TYPE"], 90_100
    whole = dirty(spark, str(tmp_path), feed_sql("suspend_contract")).toDF(*columns)
    parts = [p.toDF(*columns) for p in feed_parts(spark, str(tmp_path), "suspend_contract", 2 * total // 4 + 1)]
    counts = [p.count() for p in parts]
    assert len(parts) == 4 and sum(counts) == total and max(counts) < 0.5 * total
    together = parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])
    assert together.exceptAll(whole).count() == whole.exceptAll(together).count() == 0
    # Whatever the splits of the scan are.
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        again = list(feed_parts(spark, str(tmp_path), "suspend_contract", 2 * total // 4 + 1))
        assert [p.count() for p in again] == counts
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(list(feed_parts(spark, str(tmp_path), "suspend_contract", 1))) == MOST_PARTS
    assert len(list(feed_parts(spark, str(tmp_path), "suspend_contract"))) == 1


def test_an_empty_table_is_one_part_that_lands_a_header(spark, tmp_path):
    (tmp_path / "orders.parquet").mkdir()
    orders(tmp_path / "orders.parquet", 0, 0)
    folders = list(land_parts(spark, str(tmp_path), str(tmp_path / "landing"), "suspend_contract"))
    assert len(folders) == 1 and len(list((tmp_path / "landing").glob("*/*.txt"))) == 1
