import os
import shutil
import subprocess
import sys

import pytest
from pyspark.sql import SparkSession

from siltworks.queries import registry

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("left", [None, "siltworks/llm/__pycache__"])
def test_entry_works_without_the_training_data_operators(tmp_path, left):
    def left_out(folder, names):
        return [n for n in names if n in ("llm", "corpus_pipeline.py", ".git", "__pycache__")]

    shutil.copytree(ROOT, tmp_path / "repo", ignore=left_out)
    if left:
        (tmp_path / "repo" / left).mkdir(parents=True)
    code = "import __spark_entry__ as e; q = set(e.queries()); assert q == set(e.oracle_sql()) and 'silver_lineitem' in q; import bench"
    env = {**os.environ, "PYTHONPATH": str(tmp_path / "repo"), "PYTHONDONTWRITEBYTECODE": "1"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", env=env, check=True)


def test_queries_leave_the_session_as_it_was(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "64m")
    views = spark.catalog.listTables()
    try:
        registry.queries()["run_task_status"](spark, "/root/testdata/sf0.001").collect()
        assert spark.conf.get(key) == "64m" and SparkSession.getActiveSession() is not None
        assert spark.catalog.listTables() == views
    finally:
        spark.conf.set(key, before)


def test_no_registered_plan_deals_rows_out_again(spark):
    for name in ("quarantine_rows", "cast_all_types", "dq_metrics", "default_fill", "scan_delimited"):
        plan = registry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "RoundRobinPartitioning" not in plan, name
