"""Queries that write: extracts, Bronze and Silver tables, audit log, streams.

Each call works in a lake of its own below the session's shared folder and returns
what is stored there.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.contracts import Contract, Registry, declared
from siltworks.operators.constraints import fill_defaults
from siltworks.operators.projection import check_contract, project_contract, typed_columns
from siltworks.plans.bronze import load_all, load_bronze, write_bronze
from siltworks.plans.runs import run_report
from siltworks.plans.silver import (
    SPLIT_COLUMN,
    declare_silver,
    promote_all,
    promote_silver,
    write_checked,
)
from siltworks.queries.checks import blank, checked_names, checked_sql, columns_of
from siltworks.queries.constraints import RUN_TIME
from siltworks.queries.inputs import (
    EVENTS,
    EVENTS_DIRTY,
    FEEDS,
    LINEITEM,
    LINEITEM_DIRTY,
    dirty,
    feed_sql,
    land,
    land_feeds,
    land_parts,
    plain,
    scratch_lake,
    stored,
    table,
)
from siltworks.queries.typing import comparable
from siltworks.session import SHUFFLE_CLEANUP, scratch_dir
from siltworks.sinks.audit import Run, audit_log
from siltworks.sinks.lake import AUDIT_TABLE, LEDGER_TABLE, QUARANTINE_SUFFIX, publish_contract
from siltworks.sources.delimited import (
    INGEST_TS,
    INPUT_FILE_NAME,
    SEPARATOR,
    add_provenance,
    malformed_census,
    malformed_rows,
    scan_delimited,
    source_file_census,
    source_files,
)
from siltworks.sources.ledger import LEDGER_COLUMNS, new_files, record_files
from siltworks.sources.multiline import FILE, scan_multiline
from siltworks.sources.tables import tables_to_process
from siltworks.streaming.ingest import read_new_files, stream_bronze, stream_silver

RUN = Run("job", "2024-01-31", "load", "1")

# --- delimited text ---------------------------------------------------------------

EVENT_TEXT = """
select cast(event_id as string) as event_id, cast(ts as string) as ts,
  cast(user_id as string) as user_id, case event_type when 'view' then '' else event_type end as event_type,
  ' ' || cast(cast(value as decimal(18,2)) as string) || ' ' as value,
  case event_type when 'click' then 'a^|~"b"' else props end as props
from {events}
"""
_EVENT_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("event_id", "ts", "user_id", "event_type", "value", "props")]
)


def scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = land(dirty(spark, sf_dir, EVENT_TEXT), scratch_dir(spark, "scan"))
    return scan_delimited(spark, folder, _EVENT_SCHEMA)


# Every third event has line breaks, and quotes, inside a field.
BROKEN_LINES = """
select cast(event_id as string) as event_id,
  case event_id % 3 when 0 then event_type || chr(10) || '"q" ' || chr(10) || chr(10) || props when 1 then event_type else props end as note,
  cast(user_id as string) as user_id
from {events}
"""
_BROKEN_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("event_id", "note", "user_id")])


def scan_broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line breaks inside quotes, read in many splits of each file."""
    folder = land(dirty(spark, sf_dir, BROKEN_LINES), scratch_dir(spark, "broken"))
    size = spark.read.format("binaryFile").load(f"{folder}/*.txt").agg(F.sum("length")).first()[0]
    # A session of its own, so this setting is the query's alone.
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(max(2000, size // 24)))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    return scan_multiline(spark, folder, _BROKEN_SCHEMA).drop(FILE)


def provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = land(dirty(spark, sf_dir, EVENT_TEXT), scratch_dir(spark, "provenance"))
    stamped = add_provenance(scan_delimited(spark, folder, _EVENT_SCHEMA), RUN_TIME)
    return comparable(
        stamped.select("event_id", INGEST_TS, F.col(INPUT_FILE_NAME).endswith(".txt").alias("from_text_file"))
    )


CENSUS = ["order_status", "sin", "sin_limit", "suspend_contract"]


def census(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = land_feeds(spark, sf_dir, scratch_dir(spark, "census"), CENSUS)
    registry = declared()
    heads = {
        name: len("^|~".join(registry.lookup(name).source_schema.names)) + 1
        for name in [*CENSUS, "zone_price"]
    }
    # One header per file: how many files the writer made is its own affair.
    head = F.create_map(*[F.lit(x) for pair in heads.items() for x in pair])[F.col("table_name")]
    return source_file_census(spark, landing, list(heads)).select(
        "table_name",
        (F.col("verdict") != "missing").alias("landed"),
        (F.col("n_bytes") - F.col("n_files") * head).cast("bigint").alias("data_bytes"),
    )


# Every seventh order writes a line one field short, every eleventh one too long.
LINES = """
select cast(o_orderkey as string) || case when o_orderkey % 7 = 0 then '' else '^|~' || o_orderstatus end
  || case when o_orderkey % 7 = 0 then '' else '^|~' || o_orderpriority end
  || case when o_orderkey % 11 = 3 then '^|~surplus' else '' end as value
from {orders}
"""
_LINE_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("o_orderkey", "o_orderstatus", "o_orderpriority")]
)


def _raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _write_lines(spark, sf_dir, scratch_dir(spark, "lines"))
    return scan_delimited(spark, folder, _LINE_SCHEMA, keep_corrupt=True)


def _write_lines(spark: SparkSession, sf_dir: str, folder: str) -> str:
    # The first line of a file is taken for its header, so each line brings one along
    # as a line of its own only where a file starts: written by a header-only row.
    lines = dirty(spark, sf_dir, LINES)
    head = "^|~".join(_LINE_SCHEMA.names)
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    lines.select(
        F.when(first, F.concat(F.lit(head + "\n"), F.col("value"))).otherwise(F.col("value")).alias("value")
    ).write.option("extension", "txt").text(folder)
    return folder


def malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return malformed_rows(_raw_lines(spark, sf_dir)).withColumnRenamed("_corrupt_record", "line")


def malformed_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return malformed_census(_raw_lines(spark, sf_dir)).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_malformed").alias("n_malformed")
    )


def unseen_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per order status in the files the ledger does not know."""
    landing = scratch_dir(spark, "ledger")
    text = table(spark, sf_dir, "orders").select(
        "o_orderstatus", *[F.col(c).cast("string") for c in ("o_orderkey", "o_custkey")]
    )
    (
        text.write.partitionBy("o_orderstatus").option("sep", "^|~").option("header", "true")
        .option("extension", "txt").csv(landing)
    )
    files = source_files(spark, landing, below=True)
    # One status is loaded; of another the files were replaced since by larger ones.
    loaded = files.where("path like '%o_orderstatus=F/%'")
    replaced = files.where("path like '%o_orderstatus=O/%'").withColumn("length", F.col("length") - 1)
    lake = scratch_lake(spark, "ledger-lake")
    record_files(loaded.unionByName(replaced), lake, "orders", RUN.job_run_id, RUN_TIME)
    known = stored_log(spark, lake)
    lake.drop_schemas(spark)
    fresh = new_files(files, known).select(F.col("path").alias("file_path"))
    rows = (
        scan_delimited(
            spark, landing, T.StructType.fromDDL("o_orderkey STRING, o_custkey STRING, o_orderstatus STRING")
        )
        .groupBy("_metadata.file_path", "o_orderstatus")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        rows.join(fresh, "file_path", "left_semi")
        .groupBy("o_orderstatus")
        .agg(F.sum("n").alias("n_rows"))
    )


def stored_log(spark: SparkSession, lake) -> DataFrame:
    """A lake's ledger read by path, so it outlives its catalog entry."""
    return spark.read.parquet(f"{lake.root}/{lake.bronze}/{LEDGER_TABLE}").select(*LEDGER_COLUMNS.names)


def files_after_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of one folder, a file arriving in between: each row is in exactly one of them."""
    lake = scratch_lake(spark, "twice")
    contract = declared().lookup("suspend_contract")
    text = dirty(spark, sf_dir, feed_sql(contract.name))
    folder = f"{lake.root}/landing/{contract.folder}"
    first = F.col("suspend_type") == "2"
    parts = []
    for number, rows in enumerate((text.where(first), text.where(~first | F.col("suspend_type").isNull()))):
        _land_into(rows, folder)
        load_bronze(spark, lake, contract, f"{lake.root}/landing", RUN, single_file=False, only_new=True)
        parts.append(stored(spark, lake, lake.bronze, contract.name).withColumn("load", F.lit(number)))
    try:
        load_bronze(spark, lake, contract, f"{lake.root}/landing", RUN, single_file=False, only_new=True)
        raise AssertionError("nothing new was loaded")
    except FileNotFoundError:
        pass
    lake.drop_schemas(spark)
    rows = parts[0].unionByName(parts[1])
    return rows.select(F.col("CONTRACT_NUM").alias("contract_num"), F.col("SUSPEND_TYPE").alias("suspend_type"), "load")


def _land_into(df: DataFrame, folder: str) -> None:
    """Add an extract's files to a folder that may hold some."""
    (
        df.write.mode("append").option("sep", SEPARATOR).option("header", "true").option("extension", "txt")
        .option("emptyValue", "").csv(folder)
    )


def empty_landing_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder without a file: the load is refused, the old rows stay, and the log says so."""
    lake = scratch_lake(spark, "nothing")
    contract = declared().lookup("suspend_contract")
    landing = land_feeds(spark, sf_dir, f"{lake.root}/landing", [contract.name])
    load_bronze(spark, lake, contract, landing, RUN, single_file=False)
    # The folder is there, with a file of another kind.
    dirty(spark, sf_dir, feed_sql(contract.name)).limit(1).write.json(f"{lake.root}/elsewhere/{contract.folder}")
    for single in (True, False):
        try:
            load_bronze(spark, lake, contract, f"{lake.root}/elsewhere", RUN, single_file=single)
        except FileNotFoundError as refused:
            assert "no .txt file" in str(refused)
    log = audit_log(spark, lake, lake.bronze).groupBy("success").agg(
        F.count(F.lit(1)).alias("loads"), F.sum("record_count").alias("logged")
    )
    rows = stored(spark, lake, lake.bronze, contract.name).agg(F.count(F.lit(1)).alias("stored"))
    result = spark.createDataFrame(log.join(F.broadcast(rows)).collect(), "success int, loads bigint, logged bigint, stored bigint")
    lake.drop_schemas(spark)
    return result


def single_file_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default load: one file in the folder, archived files below it left alone."""
    lake = scratch_lake(spark, "single")
    contract = declared().lookup("sin")
    folder = f"{lake.root}/landing/{contract.folder}"
    land(dirty(spark, sf_dir, feed_sql(contract.name)).coalesce(1), folder)
    land(dirty(spark, sf_dir, feed_sql(contract.name)).coalesce(1), f"{folder}/archive")
    load_bronze(spark, lake, contract, f"{lake.root}/landing", RUN)
    rows = stored(spark, lake, lake.bronze, contract.name)
    lake.drop_schemas(spark)
    return rows.select(*[F.col(c).alias(c.lower()) for c in contract.source_schema.names])


def load_reports_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load counts lines with too few or too many fields while it writes."""
    lake = scratch_lake(spark, "malformed")
    contract = Contract(name="lines", columns="o_orderkey STRING, o_orderstatus STRING, o_orderpriority STRING")
    _write_lines(spark, sf_dir, f"{lake.root}/landing/lines")
    outcomes = load_all(spark, lake, Registry([contract]), f"{lake.root}/landing", RUN, single_file=False)
    lake.drop_schemas(spark)
    return outcomes.select("table_name", "record_count", "malformed_rows")


# --- Bronze -----------------------------------------------------------------------


def bronze_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads; the second lacks a column of the first, which stays as NULL."""
    lake = scratch_lake(spark, "overwrite")
    text = dirty(spark, sf_dir, EVENT_TEXT)
    write_bronze(spark, lake, "events", text)
    write_bronze(spark, lake, "events", text.drop("props"))
    result = stored(spark, lake, lake.bronze, "events")
    lake.drop_schemas(spark)
    return result


def bronze_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = scratch_lake(spark, "count")
    written = write_bronze(spark, lake, "lineitem", dirty(spark, sf_dir, LINEITEM_DIRTY))
    result = stored(spark, lake, lake.bronze, "lineitem").agg(
        F.lit(written.total_rows).cast("bigint").alias("observed"), F.count(F.lit(1)).alias("stored")
    )
    lake.drop_schemas(spark)
    return result


def bronze_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = scratch_lake(spark, "bronze")
    landing = land_feeds(spark, sf_dir, f"{lake.root}/landing", ["price_discount"])
    load_bronze(spark, lake, declared().lookup("price_discount"), landing, RUN, single_file=False)
    rows = stored(spark, lake, lake.bronze, "price_discount")
    result = rows.drop(INGEST_TS).withColumn(INPUT_FILE_NAME, F.col(INPUT_FILE_NAME).endswith(".txt"))
    lake.drop_schemas(spark)
    return result.toDF(*[c.lower() for c in result.columns])


def _loaded(spark: SparkSession, sf_dir: str, label: str, absent: tuple[str, ...] = ()):
    lake = scratch_lake(spark, label)
    names = [n for n in FEEDS if n not in absent]
    landing = f"{lake.root}/landing"

    def arrive(name: str) -> Iterator[str] | None:
        return land_parts(spark, sf_dir, landing, name) if name in names else None

    # The query's own session. What its loads shuffle is freed when a write ends, not when the driver collects garbage.
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    outcomes = load_all(
        spark, lake, declared(), landing, RUN, fail_fast=not absent, parallel=4, before=arrive, single_file=False, discard=True
    )
    spark.conf.unset(SHUFFLE_CLEANUP)
    return lake, outcomes


def load_all_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every declared table; one has no extract and is reported instead of stopping the rest."""
    lake, outcomes = _loaded(spark, sf_dir, "all", absent=("zone_price",))
    lake.drop_schemas(spark)
    return outcomes.select(
        "table_name", "success", "record_count", F.col("error").isNotNull().alias("has_error")
    )


def audit_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, _ = _loaded(spark, sf_dir, "audit", absent=("zone_price",))
    # By path, so it outlives its catalog entry.
    result = spark.read.parquet(f"{lake.root}/{lake.bronze}/{AUDIT_TABLE}")
    lake.drop_schemas(spark)
    return result.select(
        "job_id",
        "job_run_id",
        "task_id",
        "task_run_id",
        F.regexp_extract("target_table", r"`([^`]+)`$", 1).alias("target_table"),
        "success",
        F.col("failure_reason").isNotNull().alias("has_reason"),
        "record_count",
        (F.col("end_time") >= F.col("start_time")).alias("ended"),
    )


def to_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables both layers have, with the Bronze rows waiting in each."""
    lake, _ = _loaded(spark, sf_dir, "resolve", absent=("zone_price",))
    declare_silver(spark, lake, declared())
    spark.sql(f"CREATE TABLE {lake.table(lake.silver, 'sin' + QUARANTINE_SUFFIX)} (id INT) USING parquet")
    audit_log(spark, lake, lake.silver)
    counts = [
        stored(spark, lake, lake.bronze, name).agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows")
        )
        for name in tables_to_process(spark, lake)
    ]
    lake.drop_schemas(spark)
    result = counts[0]
    for df in counts[1:]:
        result = result.unionByName(df)
    return result


# --- Silver -----------------------------------------------------------------------


def _promoted(spark: SparkSession, sf_dir: str, label: str, **options):
    lake = scratch_lake(spark, label)
    write_bronze(spark, lake, LINEITEM.name, dirty(spark, sf_dir, LINEITEM_DIRTY))
    promote_silver(spark, lake, LINEITEM, RUN, **options)
    return lake


def silver_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze text in, typed rows out: cast, measured, staged, published and logged."""
    lake = _promoted(spark, sf_dir, "silver")
    result = stored(spark, lake, lake.silver, LINEITEM.name)
    lake.drop_schemas(spark)
    return result


def silver_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second publish replaces the first one's rows."""
    lake = scratch_lake(spark, "replace")
    contract = declared().lookup("suspend_contract")
    checked = check_contract(dirty(spark, sf_dir, feed_sql(contract.name)), contract)
    # The columns all landed, so only blank fields get a default.
    for frame in (checked, fill_defaults(checked, contract, RUN_TIME)):
        location = lake.new_location(lake.silver, contract.name)
        write_checked(frame, contract, location)
        publish_contract(spark, lake, lake.silver, contract, location)
    result = stored(spark, lake, lake.silver, contract.name)
    lake.drop_schemas(spark)
    return result


def clustered_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _promoted(spark, sf_dir, "clustered", cluster=True)
    result = stored(spark, lake, lake.silver, LINEITEM.name)
    lake.drop_schemas(spark)
    return result


def quarantine_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tables of a quarantining load, told apart by ``quarantined``; failing rows with their landed text."""
    lake = _promoted(spark, sf_dir, "quarantine", quarantine=True)
    names = LINEITEM.schema.names
    text = [F.col(f"landed.{c}").alias(f"landed_{c}") for c in names]
    nothing = [F.lit(None).cast("string").alias(f"landed_{c}") for c in names]
    valid = stored(spark, lake, lake.silver, LINEITEM.name).select(*names, F.lit(False).alias("quarantined"), *nothing)
    failing = stored(spark, lake, lake.silver, LINEITEM.name + QUARANTINE_SUFFIX)
    lake.drop_schemas(spark)
    return valid.unionByName(failing.select(*names, F.lit(True).alias("quarantined"), *text))


def promote_all_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, _ = _loaded(spark, sf_dir, "promote")
    declare_silver(spark, lake, declared())
    outcomes = promote_all(spark, lake, declared(), RUN, parallel=4)
    lake.drop_schemas(spark)
    top = F.array_join(F.transform("top_columns", lambda c: F.concat(c["column_name"], F.lit(":"), c["cast_failures"])), ",")
    return outcomes.select(
        "table_name", "success", "record_count", "cast_error_rows", "cast_error_pct", top.alias("top_columns")
    )


def run_report_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load all, promote all, then that run's report over both logs the engine wrote."""
    lake, _ = _loaded(spark, sf_dir, "report", absent=("zone_price",))
    declare_silver(spark, lake, declared())
    promote_all(spark, lake, declared(), Run("job", RUN.job_run_id, "promote", "2"), parallel=4)
    logs = [audit_log(spark, lake, schema) for schema in (lake.bronze, lake.silver)]
    days = [r[0] for r in logs[0].unionByName(logs[1]).select("run_date").distinct().collect()]
    report = run_report(logs, RUN.job_run_id, days)
    rows = report.select(
        "task_id", F.regexp_extract("target_table", r"`([^`]+)`$", 1).alias("table_name"), "status", "record_count",
        (F.length("failure_reason") > 0).alias("has_reason"), "total_tasks", "passed_tasks", "failed_tasks", "overall_status",
    )
    # The logs are read before their catalog entries go.
    result = spark.createDataFrame(rows.collect(), rows.schema)
    lake.drop_schemas(spark)
    return result


def contract_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared tables made from their DDL; SQL inserts rely on the column defaults."""
    lake = scratch_lake(spark, "ddl")
    declare_silver(spark, lake, declared())
    target = lake.table(lake.silver, "suspend_contract")
    spark.sql(
        f"INSERT INTO {target} (contract_num) SELECT 'GS-' || o_orderkey FROM {{orders}}",
        orders=table(spark, sf_dir, "orders"),
    )
    result = stored(spark, lake, lake.silver, "suspend_contract")
    lake.drop_schemas(spark)
    return result


# --- streams ----------------------------------------------------------------------

_STREAMED = Contract(name="events", columns="event_id BIGINT NOT NULL, ts TIMESTAMP, user_id INT")


def _landed_events(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_dir(spark, "stream")
    land(dirty(spark, sf_dir, EVENTS_DIRTY), f"{root}/landing")
    return root


def streamed_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over one folder: the second finds nothing new."""
    root = _landed_events(spark, sf_dir)
    for _ in range(2):
        lines = read_new_files(spark, f"{root}/landing", _STREAMED, ingest_time=RUN_TIME)
        stream_bronze(lines, f"{root}/bronze", f"{root}/checkpoint").awaitTermination()
    result = spark.read.schema(_STREAMED.source_schema).option("recursiveFileLookup", "true").parquet(f"{root}/bronze")
    return result.toDF(*[c.lower() for c in result.columns])


def streamed_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _landed_events(spark, sf_dir)
    lines = read_new_files(spark, f"{root}/landing", _STREAMED, ingest_time=RUN_TIME)
    stream_silver(lines, _STREAMED, f"{root}/silver", f"{root}/checkpoint").awaitTermination()
    rows = spark.read.parquet(f"{root}/silver")
    rows = rows.select(
        *_STREAMED.schema.names, F.col(SPLIT_COLUMN).cast("boolean").alias(SPLIT_COLUMN),
        F.array_join("failed_columns", ",").alias("failed_columns"), F.col("landed.ts").alias("landed_ts"),
    )
    return comparable(rows)


# --- checks -----------------------------------------------------------------------

_LINEITEM = checked_sql(plain(LINEITEM_DIRTY), LINEITEM)
_LINEITEM_LANDED = _LINEITEM.replace(
    " from (select ", " from (select " + ", ".join(f"src.{n} as landed_{n}" for n, _, _ in columns_of(LINEITEM)) + ", ", 1
)
_LINEITEM_COLUMNS = ", ".join(n for n, _, _ in columns_of(LINEITEM))
_EVENT_COLUMNS = "event_id, ts, user_id, nullif(event_type, '') as event_type, value"


def _feed_counts(where: str = "") -> str:
    rows = " union all ".join(
        f"select '{name}' as table_name, count(*) as n from {source}"
        for name, (source, _) in FEEDS.items()
    )
    return f"select * from ({rows}) {where}"


def _promoted_check(name: str) -> str:
    """Rows, failing rows and the ten columns that fail most, of a promoted feed."""
    contract = declared().lookup(name)
    flags = checked_names(contract)
    counts = ", ".join(f"cast(count(*) filter (where {c}__cast_fail) as bigint) as {c}" for c in flags)
    ordered = " union all ".join(
        f"select {i} as position, '{c}' as column_name, {c} as n from counted" for i, c in enumerate(flags)
    )
    top = (
        "coalesce((select string_agg(column_name || ':' || n, ',' order by n desc, position) from "
        f"(select * from ({ordered}) where n > 0 order by n desc, position limit 10)), '')"
    )
    return (
        f"select * from (with counted as (select count(*) as total, cast(count(*) filter (where __row_failed) as bigint) as failed, {counts} "
        f"from ({checked_sql(plain(feed_sql(name)), contract)})) "
        f"select '{name}' as table_name, true as success, total as record_count, failed as cast_error_rows, "
        f"case when total > 0 then failed / total * 100.0 else 0.0 end as cast_error_pct, {top} as top_columns from counted)"
    )


def _data_bytes(name: str) -> str:
    names = [n for n, _, _ in columns_of(declared().lookup(name))]
    fields = " + ".join(f"coalesce(strlen({n}), 0)" for n in names)
    return (
        f"select '{name}' as table_name, true as landed, "
        f"cast(sum({fields} + {3 * (len(names) - 1) + 1}) as bigint) as data_bytes "
        f"from ({plain(feed_sql(name))})"
    )


QUERIES = {
    "scan_delimited": (scan, f"select {_EVENT_COLUMNS}, props from ({plain(EVENT_TEXT)})"),
    "scan_multiline": (scan_broken_lines, plain(BROKEN_LINES)),
    "add_provenance": (
        provenance,
        "select cast(event_id as string) as event_id, timestamp '2024-01-31 06:30:00' as ingest_ts, "
        "true as from_text_file from events",
    ),
    "source_file_census": (
        census,
        " union all ".join(_data_bytes(n) for n in CENSUS)
        + " union all select 'zone_price', false, cast(0 as bigint)",
    ),
    "malformed_rows": (
        malformed,
        "select cast(o_orderkey as string) as o_orderkey, "
        "case when o_orderkey % 7 <> 0 then o_orderstatus when o_orderkey % 11 = 3 then 'surplus' end as o_orderstatus, "
        "case when o_orderkey % 7 <> 0 then o_orderpriority end as o_orderpriority, value as line "
        f"from (select *, {plain(LINES).split('select', 1)[1].rsplit('from', 1)[0]} from orders) "
        "where o_orderkey % 7 = 0 or o_orderkey % 11 = 3",
    ),
    "malformed_census": (
        malformed_count,
        "select count(*) as n_rows, cast(count(*) filter (where o_orderkey % 7 = 0 or o_orderkey % 11 = 3) as bigint) "
        "as n_malformed from orders",
    ),
    "new_files_after_load": (
        files_after_load,
        f"select contract_num as contract_num, nullif(suspend_type, '') as suspend_type, case when suspend_type = '2' then 0 else 1 end as load "
        f"from ({plain(feed_sql('suspend_contract'))})",
    ),
    "empty_landing_refused": (
        empty_landing_refused,
        "select cast(s as int) as success, cast(case s when 1 then 1 else 2 end as bigint) as loads, "
        "case s when 1 then n else 0 end as logged, n as stored "
        "from (select count(*) as n from orders), (values (0), (1)) v(s)",
    ),
    "single_file_load": (
        single_file_load,
        "select " + ", ".join(f"nullif({n}, '') as {n}" for n, _, _ in columns_of(declared().lookup("sin")))
        + f" from ({plain(feed_sql('sin'))})",
    ),
    "load_reports_malformed": (
        load_reports_malformed,
        "select 'lines' as table_name, count(*) as record_count, "
        "cast(count(*) filter (where o_orderkey % 7 = 0 or o_orderkey % 11 = 3) as bigint) as malformed_rows from orders",
    ),
    "run_report_end_to_end": (
        run_report_end_to_end,
        "with t as (select table_name, n, table_name <> 'zone_price' as ok from (" + _feed_counts() + ")), "
        "r as (select 'load' as task_id, table_name, ok, case when ok then n else 0 end as n from t "
        "union all select 'promote', table_name, true, n from t where ok) "
        "select task_id, table_name, case when ok then 'SUCCESS' else 'FAILED' end as status, n as record_count, "
        "not ok as has_reason, count(*) over () as total_tasks, cast(count(*) filter (where ok) over () as bigint) as passed_tasks, "
        "cast(count(*) filter (where not ok) over () as bigint) as failed_tasks, 'FAILED' as overall_status from r",
    ),
    "new_files": (
        unseen_files,
        "select o_orderstatus, count(*) as n_rows from orders where o_orderstatus <> 'F' group by 1",
    ),
    "bronze_overwrite": (
        bronze_overwrite,
        f"select event_id, ts, user_id, event_type, value, cast(null as string) as props from ({plain(EVENT_TEXT)})",
    ),
    "bronze_row_count": (
        bronze_row_count,
        "select count(*) as observed, count(*) as stored from lineitem",
    ),
    "bronze_load": (
        bronze_load,
        "select "
        + ", ".join(
            f"nullif({n}, '') as {n}" for n, _, _ in columns_of(declared().lookup("price_discount"))
        )
        + f", true as input_file_name from ({plain(feed_sql('price_discount'))})",
    ),
    "load_all_outcomes": (
        load_all_outcomes,
        "select table_name, table_name <> 'zone_price' as success, "
        "case when table_name = 'zone_price' then 0 else n end as record_count, "
        f"table_name = 'zone_price' as has_error from ({_feed_counts()})",
    ),
    "audit_append": (
        audit_append,
        "select 'job' as job_id, '2024-01-31' as job_run_id, 'load' as task_id, '1' as task_run_id, "
        "table_name as target_table, cast(table_name <> 'zone_price' as int) as success, "
        "table_name = 'zone_price' as has_reason, "
        "case when table_name = 'zone_price' then 0 else n end as record_count, true as ended "
        f"from ({_feed_counts()})",
    ),
    "tables_to_process": (
        to_process,
        f"select table_name, n as n_rows from ({_feed_counts()}) where table_name <> 'zone_price'",
    ),
    "silver_lineitem": (silver_lineitem, f"select {_LINEITEM_COLUMNS} from ({_LINEITEM})"),
    "silver_overwrite": (
        silver_overwrite,
        # A blank type gets the default, a bad one stays NULL.
        f"select contract_num, case when suspend_type__cast_fail then null else coalesce(suspend_type, 1) end as suspend_type "
        f"from ({checked_sql(plain(feed_sql('suspend_contract')), declared().lookup('suspend_contract'))})",
    ),
    "clustered_write": (clustered_write, f"select {_LINEITEM_COLUMNS} from ({_LINEITEM})"),
    "quarantine_write": (
        quarantine_write,
        f"select {_LINEITEM_COLUMNS}, __row_failed as quarantined, "
        + ", ".join(f"case when __row_failed then landed_{n} end as landed_{n}" for n, _, _ in columns_of(LINEITEM))
        + f" from ({_LINEITEM_LANDED})",
    ),
    "promote_all_outcomes": (
        promote_all_outcomes,
        " union all ".join(_promoted_check(n) for n in FEEDS),
    ),
    "contract_ddl": (
        contract_ddl,
        "select 'GS-' || cast(o_orderkey as string) as contract_num, cast(1 as int) as suspend_type from orders",
    ),
    "stream_bronze": (
        streamed_bronze,
        "select event_id, nullif(ts, '') as ts, user_id " f"from ({plain(EVENTS_DIRTY)})",
    ),
    "stream_silver": (
        streamed_silver,
        "select event_id, ts, user_id, __row_failed as dq_failed, "
        "concat_ws(',', case when event_id__cast_fail then 'event_id' end, case when ts__cast_fail then 'ts' end, "
        "case when user_id__cast_fail then 'user_id' end) as failed_columns, case when __row_failed then landed_ts end as landed_ts "
        f"from ({checked_sql(plain(EVENTS_DIRTY), EVENTS).replace(' from (select ', ' from (select nullif(src.ts, repeat(chr(32), 0)) as landed_ts, ', 1)})",
    ),
}
