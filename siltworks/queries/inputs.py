"""Landed-looking text made from the given tables.

Each input is one SQL text both Spark and DuckDB run, so a query and its check start
from the same rows. Values are spoiled by rule, never at random. ``{name}`` stands for
a given table.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.contracts import Contract, declared
from siltworks.queries.checks import columns_of
from siltworks.session import scratch_dir
from siltworks.sinks.lake import Lake
from siltworks.sources.delimited import SEPARATOR

LINEITEM_DIRTY = """
select cast(l_orderkey as string) as l_orderkey, cast(l_linenumber as string) as l_linenumber,
  case l_orderkey % 8 when 0 then '' when 1 then '$' || p when 2 then '(' || p || ')' when 3 then '  '
    when 4 then 'N/A' when 5 then '9' || '99999999999999999' || p else p end as price,
  case l_orderkey % 6 when 0 then replace(d,'-','')
    when 1 then substr(d,6,2) || '/' || substr(d,9,2) || '/' || substr(d,1,4)
    when 2 then 'bad' else d end as shipdate,
  case l_orderkey % 5 when 0 then 'Y' when 1 then '0.0' when 2 then 'maybe' when 3 then 'TRUE' else 'f' end as flag
from (select *, cast(cast(l_extendedprice as decimal(18,2)) as string) as p,
             cast(cast(l_shipdate as date) as string) as d from {lineitem}) t
"""

LINEITEM = Contract(
    name="lineitem",
    columns="""l_orderkey BIGINT NOT NULL, l_linenumber INT NOT NULL, price DECIMAL(18,2),
        shipdate DATE, flag BOOLEAN""",
    cluster_by=("shipdate", "l_orderkey"),
    unique_keys=(("l_orderkey", "l_linenumber"),),
)

_MONTH_STYLE = """substr('JanFebMarAprMayJunJulAugSepOctNovDec',(cast(substr(d,6,2) as int)-1)*3+1,3)||'  '
      ||cast(cast(substr(d,9,2) as int) as string)||' '||substr(d,1,4)"""

EVENTS_DIRTY = f"""
select cast(event_id as string) as event_id,
  case event_id % 11 when 9 then exact when 10 then replace(exact,' ','T') else
  case event_id % 9 when 0 then d when 1 then replace(d,' ','T')
    when 2 then substr(d,6,2)||'/'||substr(d,9,2)||'/'||substr(d,1,4)||' '||substr(d,12,5)
    when 3 then {_MONTH_STYLE}||'  '
      ||cast(case when cast(substr(d,12,2) as int) % 12=0 then 12 else cast(substr(d,12,2) as int) % 12 end as string)
      ||substr(d,14,6)||':000'||case when cast(substr(d,12,2) as int)>=12 then 'PM' else 'AM' end
    when 4 then substr(d,1,10) when 5 then ' ' when 6 then 'bad' when 7 then substr(d,1,16) else '  '||d||' ' end end as ts,
  case event_id % 7 when 0 then cast(user_id as string)||'.00' when 1 then '+'||cast(user_id as string)
    when 2 then '99999999999' when 3 then '1.5' when 4 then '('||cast(user_id as string)||')'
    when 5 then '1,'||'000' else cast(user_id as string) end as user_id
from (select *, cast(ts as string) as exact, cast(date_trunc('second', ts) as string) as d from {{events}}) t
"""

EVENTS = Contract(
    name="events", columns="event_id BIGINT NOT NULL, ts TIMESTAMP, user_id INT"
)

# Every type the casts know, in upper and lower case names, with one column too many.
WIDE_DIRTY = f"""
select cast(l_orderkey as string) as L_ORDERKEY,
  case l_partkey % 11 when 0 then pk || '.000' when 1 then '+' || pk when 2 then pk || '.5'
    when 3 then '' when 4 then '1,234' else pk end as l_partkey,
  case l_suppkey % 7 when 0 then '(' || sk || ')' when 1 then '99999999999' when 2 then ' ' || sk || '  '
    when 3 then '1e3' else sk end as l_suppkey,
  case l_partkey % 13 when 0 then '300' when 1 then 'x' else cast(l_linenumber as string) end as l_linenumber,
  case l_suppkey % 9 when 0 then '70000' when 1 then '- 5' else cast(cast(l_quantity as int) as string) || '.0' end as l_quantity,
  case l_orderkey % 8 when 0 then '' when 1 then '$' || p when 2 then '(' || p || ')' when 3 then '($' || p || ')'
    when 4 then 'N/A' when 5 then '9' || '99999999999999999' || p else p end as l_extendedprice,
  case l_orderkey % 10 when 0 then '123.45' when 1 then substr(disc,2) when 2 then '.' when 3 then disc || '5'
    when 4 then '1.' else disc end as l_discount,
  case l_orderkey % 12 when 0 then 'NaN' when 1 then '1e5' when 2 then '$' || tax when 3 then '+' || tax
    when 4 then '-' || substr(tax,2) else tax end as l_tax,
  case l_orderkey % 12 when 5 then 'Infinity' else tax end as l_ratio,
  case l_orderkey % 4 when 0 then '' when 1 then ' ' || l_returnflag || '  ' else l_returnflag end as l_returnflag,
  case l_orderkey % 6 when 0 then case l_linestatus when 'O' then '1.0' else '0' end
    when 1 then case l_linestatus when 'O' then 'YES' else 'No' end when 2 then '2' when 3 then ' '
    else case l_linestatus when 'O' then 'true' else 'F' end end as l_linestatus,
  case l_orderkey % 10 when 0 then replace(d,'-','')
    when 1 then substr(d,6,2)||'/'||substr(d,9,2)||'/'||substr(d,1,4)
    when 2 then substr(d,6,2)||'-'||substr(d,9,2)||'-'||substr(d,1,4)
    when 3 then {_MONTH_STYLE} when 4 then {_MONTH_STYLE}||' 1:05:09:123PM'
    when 5 then d||' 10:00' when 6 then d||'T10:00:00.5' when 7 then 'garbage' when 8 then '2024-02-30'
    else d end as l_shipdate,
  case l_orderkey % 10 when 0 then d||' 10:20:30' when 1 then d||'T10:20:30'
    when 2 then substr(d,6,2)||'/'||substr(d,9,2)||'/'||substr(d,1,4)||' 23:59'
    when 3 then substr(d,6,2)||'/'||substr(d,9,2)||'/'||substr(d,1,4)
    when 4 then {_MONTH_STYLE}||' 12:00:00:000AM' when 5 then upper({_MONTH_STYLE})||' 11:05:09:120pm'
    when 6 then d||' 10:00:00.123' when 7 then d||'T10:00:00Z' when 8 then d||'T10:00:00.25'
    else d end as l_shipts,
  'surplus' as not_in_contract
from (select *, cast(l_partkey as string) as pk, cast(l_suppkey as string) as sk,
             cast(cast(l_extendedprice as decimal(18,2)) as string) as p,
             cast(cast(l_discount as decimal(18,2)) as string) as disc,
             cast(cast(l_tax as decimal(18,2)) as string) as tax,
             cast(cast(l_shipdate as date) as string) as d from {{lineitem}}) t
"""

WIDE = Contract(
    name="lineitem_wide",
    columns="""l_orderkey BIGINT NOT NULL, l_partkey BIGINT NOT NULL, l_suppkey INT NOT NULL,
        l_linenumber TINYINT, l_quantity SMALLINT, l_extendedprice DECIMAL(18,2) NOT NULL,
        l_discount DECIMAL(4,2), l_tax DOUBLE, l_ratio FLOAT, l_returnflag STRING NOT NULL,
        l_linestatus BOOLEAN NOT NULL, l_shipdate DATE, l_shipts TIMESTAMP""",
    defaults={"l_returnflag": "'blank'", "l_linestatus": "false", "l_discount": "0", "l_shipts": "current_timestamp()"},
    cluster_by=("l_shipdate", "l_orderkey"),
)

# The same source against a contract asking for columns it does not have.
WIDE_MISSING = Contract(
    name="lineitem_missing",
    columns="l_orderkey BIGINT NOT NULL, price DECIMAL(18,2), comment STRING, batch INT NOT NULL",
)

# Log rows: every event is a Bronze load, every order a Silver one.
BRONZE_LOG = """
select 'ingest' as job_id, cast(cast(ts as date) as string) as job_run_id, event_type as task_id,
  cast(event_id as string) as task_run_id,
  case when event_type = 'signup' and value < 10 then null else ts end as start_time,
  case when event_type = 'view' then null else ts + interval 90 seconds end as end_time,
  '/landing/' || event_type || '.txt' as source_file_path, cast(null as string) as source_table,
  'bronze.' || event_type as target_table,
  case when event_type = 'error' and value > 20 then 0 when value < 1 then null else 1 end as success,
  case when event_type = 'error' then 'bad ' || props end as failure_reason,
  case when value < 2 then null else user_id end as record_count
from {events}
"""

SILVER_LOG = """
select 'promote' as job_id, '2024-01-' || substr(cast(cast(o_orderdate as date) as string), 9, 2) as job_run_id,
  o_orderpriority as task_id, cast(o_orderkey as string) as task_run_id,
  o_orderdate as start_time, o_orderdate + interval 2 hours as end_time,
  cast(null as string) as source_file_path, 'bronze.' || o_orderstatus as source_table,
  'silver.' || o_orderstatus as target_table,
  case when o_totalprice > 499000 then 0 else 1 end as success,
  case when o_totalprice > 499000 then 'gate' end as failure_reason,
  o_custkey as record_count
from {orders}
"""

# Declared contracts, each fed from a given table: the table, and the source columns
# that get a value. The others are empty in the extract.
FEEDS = {
    "bpa_item": ("part", {
        "id": "cast(p_partkey as string)", "bpa_id": "cast(p_size as string)", "item_num": "p_name",
        "assnum": "case p_partkey % 5 when 0 then 'none' else cast(p_partkey as string) || '.0' end",
        "line_number": "p_brand", "stock_indicator": "case p_size % 2 when 0 then '0' else '1.0' end",
        "item_price": "'$' || cast(cast(p_retailprice as decimal(18,2)) as string)",
        "status": "case p_size % 3 when 0 then 'A' else '1' end", "mfr_name": "'  ' || p_type || ' '"}),
    "bpa_item_price": ("lineitem", {
        "id": "cast(l_orderkey as string)", "item_id": "cast(l_partkey as string)",
        "start_range": "cast(l_linenumber as string)",
        "end_range": "case l_linenumber when 3 then '99999999999' else '1,000' end",
        "discount_percent": "cast(cast(l_discount * 100 as int) as string)",
        "price": "'(' || cast(cast(l_extendedprice as decimal(18,2)) as string) || ')'"}),
    "contract_zone": ("customer", {
        "vend_id": "cast(c_custkey as string)", "contract_num": "c_name", "state": "c_mktsegment",
        "zone": "case c_nationkey when 7 then '100' else cast(c_nationkey as string) end",
        "mod_date": "case c_nationkey % 3 when 0 then 'Jan  5 2024 12:00:00:000AM' when 1 then '2024-01-05' else '1/5/2024 10:00' end"}),
    "gsin_hide_remove": ("events", {
        "gsin": "cast(event_id as string) || '.00'", "status": "event_type",
        "date_requested": "cast(ts as string)", "reason": "props",
        "requested_by": "cast(user_id as string)"}),
    "gsin_hide_remove_hist": ("events", {
        "gsin": "case event_type when 'view' then 'v' else cast(event_id as string) end",
        "status": "event_type", "contract_num": "cast(user_id as string)", "item_num": "''",
        "mfr_name": "event_type", "status_date": "cast(ts as string)", "reason": "props"}),
    "mp_product": ("part", {
        "mp_type_id": "cast(p_size as string)", "gsin": "cast(p_partkey as string)", "product_name": "p_name",
        "mfr_name": "p_brand", "source_type_id": "case p_size when 7 then '' else '2' end",
        "date_created": "case p_size % 2 when 0 then '01/05/2024 10:00:00' else '' end",
        "unspsc_source": "case p_size % 4 when 0 then '300' when 1 then '' else '3' end"}),
    "price_discount": ("lineitem", {
        "vend_id": "cast(l_suppkey as string)", "contract_num": "'GS-' || cast(l_orderkey as string)",
        "mfr_part": "cast(l_partkey as string)", "zone": "cast(l_linenumber as string)",
        "dollar_qty": "'$' || cast(cast(l_quantity as int) as string) || '.00'",
        "seq": "cast(l_linenumber as string)", "sale": "l_returnflag",
        "disc_price": "cast(cast(l_extendedprice as decimal(18,2)) as string)",
        "disc_pct": "cast(cast(l_discount * 10000 as decimal(18,2)) as string)",
        "mod_date": "cast(cast(l_shipdate as date) as string) || 'T01:02:03'",
        "mfr_name": "case l_linestatus when 'O' then '' else 'ACME' end"}),
    "sin_limit": ("supplier", {
        "vend_id": "cast(s_suppkey as string)", "contract_num": "s_name",
        "spec_item": "cast(s_nationkey as string)",
        "max_order": "cast(cast(s_acctbal as decimal(18,2)) as string)", "min_order": "'.5'",
        "mod_date": "'JAN 15 2024 1:05:09:123PM'"}),
    "suspend_contract": ("orders", {
        "contract_num": "'GS-' || cast(o_orderkey as string)",
        "suspend_type": "case o_orderstatus when 'P' then '' when 'F' then '2' else 'open' end"}),
    "zone_price": ("lineitem", {
        "vend_id": "cast(l_suppkey as string)", "contract_num": "cast(l_orderkey as string)",
        "mfr_part": "cast(l_partkey as string)", "zone": "cast(l_linenumber as string) || '.4'",
        "unit_price": "cast(cast(l_extendedprice as decimal(18,2)) as string)",
        "sale": "case l_returnflag when 'R' then 'Y' when 'A' then 'n' else 'x' end",
        "sale_price": "cast(cast(l_tax as decimal(18,2)) as string) || '9'",
        "sale_st_date": "cast(cast(l_shipdate as date) as string)",
        "prod_disc": "case l_linestatus when 'O' then '1' else '0.0' end"}),
    "sin": ("nation", {
        "sin_identity": "cast(n_nationkey as string)", "schedule_number": "n_name",
        "special_item_number": "cast(n_regionkey as string)",
        "sin_order": "cast(n_nationkey as string) || '.25'", "hide_in_elib": "' '"}),
    "order_status": ("orders", {
        "unique_id": "cast(o_orderkey as string)", "awd_unique_id": "cast(o_custkey as string)",
        "line_num": "case o_orderstatus when 'P' then '12.7' else '12.0' end",
        "bv_order_num": "cast(o_orderkey as string)", "contract_num": "'GS-' || cast(o_custkey as string)",
        "po_number_reqn_num": "'PO' || cast(o_orderkey as string)", "nsn_mfr_part": "o_orderpriority",
        "line_status": "o_orderstatus",
        "status_date": "cast(cast(o_orderdate as date) as string) || case o_custkey % 4 when 0 then ' 24:00' else ' 07:30' end",
        "quantity": "case o_custkey % 3 when 0 then '1,000' else '7' end",
        "date_created": "''", "display_flag": "case o_custkey % 5 when 0 then '' else '1' end"}),
    "item_xref_attributes": ("pages", {
        "contract_num": "cast(page_id as string)", "item_num": "'item'", "url_508": "url",
        "unid": "url", "eula_ind": "case page_id % 3 when 0 then 'T' when 1 then 'off' else '' end"}),
}


# The wide contracts: the table each is fed from, and a few source columns with values of their own.
FEEDS |= {
    "bpa_header": ("orders", {
        "bpa_number": "'BPA-' || cast(o_orderkey as string)", "contract_number": "'GS-' || cast(o_custkey as string)",
        "creation_time": "cast(cast(o_orderdate as date) as string) || ' 08:15:00'"}),
    "catalog_832": ("customer", {
        "vend_id": "cast(c_custkey as string)", "contract_num": "c_name", "agency_name": "c_mktsegment",
        "max_order": "cast(cast(c_acctbal as decimal(18,2)) as string)"}),
    "contracts": ("customer", {
        "contract_identity": "cast(c_custkey as string)", "contractor_name": "c_name",
        "schedule_number": "c_mktsegment", "special_item_number": "cast(c_nationkey as string)"}),
    "adv_product": ("part", {
        "oid": "cast(p_partkey as string) || '.00'", "prod_id": "cast(p_partkey as string)", "name": "p_name",
        "price": "'$' || cast(cast(p_retailprice as decimal(18,2)) as string)", "adv_manufacture_name": "p_brand"}),
    "item_xref": ("part", {
        "item_id": "cast(p_partkey as string)", "item_name": "p_name", "mfr_name": "p_brand", "item_type": "p_type",
        "item_price": "cast(cast(p_retailprice as decimal(18,2)) as string) || '25'"}),
    "product_file": ("part", {
        "vend_id": "cast(p_size as string)", "mfr_part": "cast(p_partkey as string)", "prod_name": "p_name",
        "mfr_name": "p_brand", "prod_desc1": "p_type"}),
}

# A whole number that tells a table's rows apart well enough to deal values out.
KEYS = {
    "part": "p_partkey", "lineitem": "(l_orderkey + l_linenumber)", "customer": "c_custkey", "events": "event_id",
    "supplier": "s_suppkey", "orders": "o_orderkey", "nation": "n_nationkey", "pages": "page_id",
}


def _dealt(kind: str, key: str, column: str, at: int) -> str:
    """Text for a column without a value of its own: all forms its type accepts, by turns."""
    kind = kind.lower()
    turn, small = f"({key} + {at}) % 4", f"cast({key} % 90 as string)"
    day = f"'2024-0' || cast({key} % 9 + 1 as string) || '-1' || cast({key} % 10 as string)"
    if kind == "string":
        return f"case {turn} when 0 then '' else '{column} ' || cast({key} as string) end"
    if kind == "boolean":
        return f"case {turn} when 0 then 'Y' when 1 then '0.0' when 2 then 'TRUE' else 'f' end"
    if kind == "timestamp":
        return f"case {turn} when 0 then {day} || ' 10:20:30' when 1 then {day} || 'T01:02:03' when 2 then '01/05/2024 10:00' else {day} end"
    if kind == "date":
        return f"case {turn} when 0 then {day} when 1 then '20240131' when 2 then '01/31/2024' else '01-31-2024' end"
    if kind in ("tinyint", "smallint", "int", "bigint") or kind.endswith(",0)"):
        return f"case {turn} when 0 then {small} || '.00' when 1 then '+' || {small} when 2 then '(' || {small} || ')' else {small} end"
    return f"case {turn} when 0 then '$' || {small} || '.25' when 1 then '-.5' when 2 then '(1.5)' else {small} end"


def feed_sql(name: str) -> str:
    """The extract of a declared contract: every source column, in file order, as text.

    Each typed column is blank in some rows and has a value that does not cast in others.
    """
    table, values = FEEDS[name]
    contract, key = declared().lookup(name), KEYS[table]

    def text(at: int, column: str, kind: str) -> str:
        value = values.get(column, _dealt(kind, key, column, at))
        if kind.lower() == "string":
            return value
        return f"case ({key} + {at}) % 10 when 5 then '' when 6 then 'bad' else {value} end"

    columns = ", ".join(
        f"{text(at, c, kind)} as {contract.source_name(c)}" for at, (c, kind, _) in enumerate(columns_of(contract))
    )
    return f"select {columns} from {{{table}}}"


TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a task that makes text of a table: at least so many, and at most where there are more tasks than cores.
LEAST_ROWS, MOST_ROWS = 25_000, 1_000_000
#: Rows in a row that stay together where a table is dealt out, as a power of two: in the order they are stored in they pack better.
TOGETHER = 12
#: Fields of an extract that are landed at a time, some 1.5 GB of text, and parts at most: each reads the table's columns once.
PART_FIELDS, MOST_PARTS = 200_000_000, 8


def rows_of_tasks(rows: DataFrame) -> tuple[int, int]:
    """Rows of a table, and of the task of its scan that has most, from the files' footers."""
    counts = rows.groupBy(F.spark_partition_id()).count().agg(F.sum("count"), F.max("count")).first()
    return counts[0] or 0, counts[1] or 0


def dealt_out(rows: DataFrame, total: int, most: int) -> DataFrame:
    """The same rows in as many tasks as they are worth; left as they are if the scan does that.

    A row group is read by one task, and text of dozens of columns is made of each of its rows there. The table's
    size in bytes says little about that, so it goes by rows: ``total``, and ``most`` in one task of the scan.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism

    def tasks(at_once: int) -> int:
        return max(-(-total // MOST_ROWS), min(-(-total // LEAST_ROWS), at_once))

    if most * tasks(cores) <= 2 * total:
        return rows
    number, task = "__number", F.pmod(F.shiftright("__number", TOGETHER), F.lit(tasks(3 * cores))).cast("int")
    numbered = rows.select("*", F.monotonically_increasing_id().alias(number))
    return numbered.repartitionById(tasks(3 * cores), task).drop(number)


def part_of(rows: DataFrame, part: int, parts: int) -> DataFrame:
    """One of several parts of a table that is read from Parquet files; each row is in exactly one of them.

    It goes by the row's place in its file, which no setting and no number of executors moves.
    """
    if parts == 1:
        return rows
    file, place = F.pmod(F.xxhash64("_metadata.file_name"), F.lit(parts)), F.shiftright("_metadata.row_index", TOGETHER)
    return rows.where(F.pmod(file + place, F.lit(parts)) == part)


def dirty(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    used = [t for t in TABLES if f"{{{t}}}" in sql]
    rows = {t: table(spark, sf_dir, t) for t in used}
    return spark.sql(sql, **{t: dealt_out(r, *rows_of_tasks(r)) for t, r in rows.items()})


def feed_parts(spark: SparkSession, sf_dir: str, name: str, fields: int = PART_FIELDS) -> Iterator[DataFrame]:
    """The text of a declared contract's extract, in as many parts as its ``fields`` ask for."""
    given, _ = FEEDS[name]
    rows = table(spark, sf_dir, given)
    total, most = rows_of_tasks(rows)
    parts = min(MOST_PARTS, max(1, -(-total * len(columns_of(declared().lookup(name))) // fields)))
    for part in range(parts):
        share = dealt_out(part_of(rows, part, parts), -(-total // parts), -(-most // parts))
        yield spark.sql(feed_sql(name), **{given: share})


def plain(sql: str) -> str:
    """The same input over the check tool's views."""
    return sql.format(**{t: t for t in TABLES})


def land(df: DataFrame, folder: str, mode: str = "errorifexists") -> str:
    """Write text columns as an extract: ``^|~`` fields, header line, ``.txt`` files."""
    (
        df.write.mode(mode)
        .option("sep", SEPARATOR)
        .option("header", "true")
        .option("extension", "txt")
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(folder)
    )
    return folder


def land_feeds(spark: SparkSession, sf_dir: str, landing: str, names: list[str]) -> str:
    for name in names:
        land(dirty(spark, sf_dir, feed_sql(name)), f"{landing}/{declared().lookup(name).folder}")
    return landing


def land_parts(spark: SparkSession, sf_dir: str, landing: str, name: str, fields: int = PART_FIELDS) -> Iterator[str]:
    """Land an extract part by part: each step adds the files of the next one."""
    folder = f"{landing}/{declared().lookup(name).folder}"
    for number, text in enumerate(feed_parts(spark, sf_dir, name, fields)):
        yield land(text, folder, "append" if number else "errorifexists")


def scratch_lake(spark: SparkSession, label: str) -> Lake:
    """A lake of its own for one query call, below the session's shared folder."""
    root = scratch_dir(spark, label)
    token = root.rsplit("-", 1)[-1][:12]
    lake = Lake(root, bronze=f"bronze_{token}", silver=f"silver_{token}")
    lake.create_schemas(spark)
    return lake


def stored(spark: SparkSession, lake: Lake, schema: str, name: str) -> DataFrame:
    """A published table read by path, so it outlives its catalog entry."""
    columns = spark.table(lake.table(schema, name)).schema
    return spark.read.schema(columns).parquet(lake.location(spark, schema, name))
