"""Queries over tables that change more than once: deliveries merged by key, streams by key, loads at the same time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.contracts import Contract
from siltworks.plans.bronze import load_bronze, write_bronze
from siltworks.plans.keyed import merge_silver
from siltworks.plans.silver import promote_silver, quarantine_columns, write_quarantined
from siltworks.operators.projection import check_contract, raw_names
from siltworks.queries.checks import checked_sql, columns_of
from siltworks.queries.inputs import LINEITEM, LINEITEM_DIRTY, dirty, plain, scratch_lake, stored
from siltworks.queries.loads import RUN, _LINEITEM_COLUMNS, _LINEITEM_LANDED, _land_into
from siltworks.queries.typing import comparable
from siltworks.sinks.lake import QUARANTINE_SUFFIX, Lake, ddl
from siltworks.sinks.versions import LoadConflict, Part, Version, publish, read_quarantine, read_silver, settle
from siltworks.streaming.ingest import read_new_files, stream_keyed

STATES = Contract(
    name="order_states",
    columns="o_orderkey BIGINT NOT NULL, status STRING NOT NULL, changed TIMESTAMP, price DECIMAL(18,2)",
    unique_keys=(("o_orderkey",),),
)
_SHOWN = "cast(cast(o_totalprice as decimal(18,2)) as string)"
#: All orders, updates of some, then older states of others with a few orders that have no time at all, and the updates again.
DELIVERIES = (
    f"""select cast(o_orderkey as string) as o_orderkey, o_orderstatus as status, cast(cast(o_orderdate as date) as string) || ' 08:00:00' as changed,
        case o_orderkey % 9 when 0 then 'bad' else {_SHOWN} end as price from {{orders}}""",
    """select cast(o_orderkey as string) as o_orderkey, 'U' as status, '2100-01-01 00:00' as changed, '(1.50)' as price from {orders} where o_orderkey % 3 = 0""",
    """select cast(case when o_orderkey % 7 = 0 then -o_orderkey else o_orderkey end as string) as o_orderkey, 'L' as status,
        case when o_orderkey % 7 = 0 then '' else '01/01/1900 00:00' end as changed, '$2' as price from {orders} where o_orderkey % 7 = 0 or o_orderkey % 5 = 0""",
    """select cast(o_orderkey as string) as o_orderkey, 'U' as status, '2100-01-01 00:00' as changed, '(1.50)' as price from {orders} where o_orderkey % 3 = 0""",
)
_BUCKET_BYTES = 64 << 10


def _deliver(spark: SparkSession, sf_dir: str, lake: Lake, number: int) -> str:
    _land_into(dirty(spark, sf_dir, DELIVERIES[number]), f"{lake.root}/landing/{STATES.folder}")
    return f"{lake.root}/landing"


def _merged(spark: SparkSession, lake: Lake) -> DataFrame:
    """What is held, and what was put aside, of a merged table."""
    aside = read_quarantine(spark, lake, STATES.name).select("o_orderkey", F.col("landed.price").alias("landed_price")).distinct()
    rows = read_silver(spark, lake, STATES).withColumn("landed_price", F.lit(None).cast("string"))
    return comparable(rows.unionByName(aside, allowMissingColumns=True))


def keyed_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four deliveries of new files: the latest state of each key, and the rows put aside."""
    lake = scratch_lake(spark, "keyed")
    for number in range(len(DELIVERIES)):
        landing = _deliver(spark, sf_dir, lake, number)
        load_bronze(spark, lake, STATES, landing, RUN, single_file=False, only_new=True)
        merge_silver(spark, lake, STATES, RUN, latest_by=["changed"], bucket_bytes=_BUCKET_BYTES)
    result = _merged(spark, lake)
    lake.drop_schemas(spark)
    return result


def keyed_merge_touches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After all orders, a delivery for one key: how many rows there are, and whether one bucket alone was rewritten."""
    lake = scratch_lake(spark, "touched")
    text = dirty(spark, sf_dir, DELIVERIES[0]).where("price <> 'bad'")
    out = []
    # Small buckets at first, which are not doubled by the second delivery.
    one = text.where(F.col("o_orderkey") == "1").withColumn("status", F.lit("T"))
    for rows, size in ((text, 4 << 10), (one, 1 << 30)):
        write_bronze(spark, lake, STATES.name, rows)
        report = merge_silver(spark, lake, STATES, RUN, bucket_bytes=size)
        out.append((report.version, report.rows_total, report.touched, report.bytes_rewritten == report.bytes_total))
    states = read_silver(spark, lake, STATES).groupBy("status").agg(F.count("*").alias("n")).where("status = 'T'").first()["n"]
    lake.drop_schemas(spark)
    assert out[1][2] == 1
    return spark.createDataFrame([(v, n, states if v == 2 else 0, whole) for v, n, _, whole in out], "version int, n_rows bigint, changed bigint, all_rewritten boolean")


def streamed_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same deliveries as a stream that is stopped half way and started again."""
    lake = scratch_lake(spark, "stream-keyed")
    for numbers in ((0, 1), (2,), (3,)):
        for number in numbers:
            landing = _deliver(spark, sf_dir, lake, number)
        lines = read_new_files(spark, f"{landing}/{STATES.folder}", STATES)
        stream_keyed(
            lines, STATES, f"{lake.root}/checkpoint", lake=lake, run=RUN, latest_by=["changed"], bucket_bytes=_BUCKET_BYTES
        ).awaitTermination()
    result = _merged(spark, lake)
    lake.drop_schemas(spark)
    return result


def load_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of one table at once: the later is told, and table and quarantine are the first one's."""
    lake = scratch_lake(spark, "conflict")
    text = dirty(spark, sf_dir, LINEITEM_DIRTY)
    before = settle(spark, lake, LINEITEM.name)
    checked = check_contract(text, LINEITEM, keep_raw=True)
    valid, failing, _ = write_quarantined(checked, LINEITEM, lake.new_location(lake.silver, LINEITEM.name))
    write_bronze(spark, lake, LINEITEM.name, text.where("cast(l_orderkey as bigint) % 2 = 0"))
    promote_silver(spark, lake, LINEITEM, RUN, quarantine=True)
    late = Version(
        parts=(Part(valid),), columns=ddl(LINEITEM.schema), quarantine=(failing,),
        quarantine_columns=ddl(quarantine_columns(LINEITEM, raw_names(checked))),
    )
    told = False
    try:
        publish(spark, lake, LINEITEM, late, before.number)
    except LoadConflict:
        told = True
    assert told
    names = LINEITEM.schema.names
    aside = stored(spark, lake, lake.silver, LINEITEM.name + QUARANTINE_SUFFIX)
    rows = stored(spark, lake, lake.silver, LINEITEM.name).select(*names, F.lit(False).alias("quarantined"))
    lake.drop_schemas(spark)
    return rows.unionByName(aside.select(*names, F.lit(True).alias("quarantined")))


_ALL = " union all ".join(f"select *, {i} as delivery from ({plain(sql)})" for i, sql in enumerate(DELIVERIES))
_CHECKED = checked_sql(_ALL, STATES).replace("select *, (", "select *, landed_price, (", 1).replace(" from (select ", " from (select src.price as landed_price, ", 1)
_STATE_COLUMNS = ", ".join(n for n, _, _ in columns_of(STATES))
_MERGED = (
    f"select {_STATE_COLUMNS}, cast(null as string) as landed_price from (select *, row_number() over (partition by o_orderkey order by changed desc nulls last) as place "
    f"from ({_CHECKED}) where not __row_failed) where place = 1 "
    f"union all select distinct o_orderkey, cast(null as string), cast(null as timestamp), cast(null as decimal(18,2)), landed_price from ({_CHECKED}) where __row_failed"
)

QUERIES = {
    "silver_keyed_merge": (keyed_merge, _MERGED),
    "keyed_merge_touches": (
        keyed_merge_touches,
        "select cast(v as int) as version, n as n_rows, cast(case v when 2 then 1 else 0 end as bigint) as changed, v = 1 as all_rewritten "
        "from (select count(*) as n from orders where o_orderkey % 9 <> 0), (values (1), (2)) t(v)",
    ),
    "stream_keyed": (streamed_by_key, _MERGED),
    "load_conflict": (
        load_conflict,
        f"select {_LINEITEM_COLUMNS}, __row_failed as quarantined from ({_LINEITEM_LANDED}) where l_orderkey % 2 = 0",
    ),
}
