"""Where tables live, and how a finished load becomes the current one.

A load writes to a folder of its own and is then published by pointing the catalog
table at that folder. Readers see the old rows or the new ones, a failed load leaves
the table as it was, and nothing is overwritten while it is being read.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from operator import add, or_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.contracts import Contract
from siltworks.contracts.model import quote

# The internal table names a load never takes for data.
AUDIT_TABLE = "etl_log"
LEDGER_TABLE = "etl_files"
VERSIONS_TABLE = "etl_versions"
QUARANTINE_SUFFIX = "_dq_quarantine"
PARTS_SUFFIX = "__parts"


@dataclass(frozen=True)
class Lake:
    """A shared storage root and the two schemas kept below it."""

    root: str
    bronze: str = "bronze"
    silver: str = "silver"

    def table(self, schema: str, name: str) -> str:
        return f"`{schema}`.`{name}`"

    def new_location(self, schema: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{schema}/{name}/load-{uuid.uuid4().hex}"

    def create_schemas(self, spark: SparkSession) -> None:
        for schema in (self.bronze, self.silver):
            spark.sql(
                f"CREATE SCHEMA IF NOT EXISTS `{schema}` "
                f"LOCATION {quote(f'{self.root.rstrip("/")}/_schemas/{schema}')}"
            )

    def drop_schemas(self, spark: SparkSession) -> None:
        """Forget the tables. They are external, so their files stay."""
        for schema in (self.bronze, self.silver):
            spark.sql(f"DROP SCHEMA IF EXISTS `{schema}` CASCADE")

    def location(self, spark: SparkSession, schema: str, name: str) -> str:
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {self.table(schema, name)}")
        return rows.filter("col_name = 'Location'").first()["data_type"]


def publish_contract(
    spark: SparkSession, lake: Lake, schema: str, contract: Contract, location: str
) -> None:
    """Make ``location`` the rows of a contract table, creating or re-declaring it."""
    table = lake.table(schema, contract.name)
    if spark.catalog.tableExists(table) and _declares(spark, table, contract):
        _point_at(spark, table, location)
        return
    _replace(spark, lake, schema, contract.name, lambda new: contract.create_table_sql(new, location))


def publish_frame(
    spark: SparkSession, lake: Lake, schema: str, name: str, columns: T.StructType, location: str
) -> None:
    """Make ``location`` the rows of a table without a contract (Bronze, quarantine).

    Columns the table already had and the new load lacks are kept and read as NULL.
    """
    table = lake.table(schema, name)
    if spark.catalog.tableExists(table):
        had = spark.table(table).schema
        new = {f.name.lower() for f in columns}
        merged = T.StructType([*columns.fields, *[f for f in had if f.name.lower() not in new]])
        if [(f.name, f.dataType) for f in had] == [(f.name, f.dataType) for f in merged]:
            _point_at(spark, table, location)
            return
        columns = merged
    _replace(
        spark, lake, schema, name, lambda new: f"CREATE TABLE {new} ({ddl(columns)}) USING parquet LOCATION {quote(location)}"
    )


def ddl(columns: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)


def without_scheme(path: str) -> str:
    return re.sub(r"^[a-zA-Z0-9]+:/*", "/", path).rstrip("/")


def is_view(spark: SparkSession, table: str) -> bool:
    return spark.catalog.getTable(table).tableType == "VIEW"


def drop_entry(spark: SparkSession, lake: Lake, schema: str, name: str) -> None:
    """Take a table or view out of the catalog, if it is there; files stay until they expire."""
    table = lake.table(schema, name)
    if spark.catalog.tableExists(table):
        spark.sql(f"DROP {'VIEW' if is_view(spark, table) else 'TABLE'} IF EXISTS {table}")


def withdraw(spark: SparkSession, lake: Lake, schema: str, name: str) -> None:
    """Take a table out of the catalog; its files stay until they expire."""
    spark.sql(f"DROP TABLE IF EXISTS {lake.table(schema, name)}")


def _replace(spark: SparkSession, lake: Lake, schema: str, name: str, create) -> None:
    """Declare a table anew. It is created under another name first, so that an error there
    leaves the old one as it was."""
    table, new = lake.table(schema, name), lake.table(schema, f"{name}_{uuid.uuid4().hex[:12]}")
    spark.sql(create(new))
    try:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        raise


def _declares(spark: SparkSession, table: str, contract: Contract) -> bool:
    known = Contract.from_table(spark, table)
    same_references = set(known.foreign_keys) == set(contract.foreign_keys)
    return same_references and known.schema == contract.schema and all(
        getattr(known, part) == getattr(contract, part)
        for part in ("defaults", "source_names", "cluster_by", "unique_keys")
    )


def _point_at(spark: SparkSession, table: str, location: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET LOCATION {quote(location)}")
    spark.catalog.refreshTable(table)


#: Bytes of staged files that one clustered file is made from.
CLUSTER_FILE_BYTES = 256 << 20
#: Bytes of rows, as a sort holds them, that one clustered file is made from: files may be packed a hundredfold.
CLUSTER_TASK_BYTES = 1 << 30


def cluster_files(staged_bytes: int, target: int = CLUSTER_FILE_BYTES) -> int:
    """How many files a clustered write makes of staged files of this size."""
    return max(1, -(-staged_bytes // target))


def sorted_bytes(df: DataFrame) -> int:
    """Memory that a sort of all rows takes: eight bytes a column and 40 a row, and the text."""
    text = [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    lengths = [F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)).cast("long") for c in text]
    row = reduce(add, lengths, F.lit(8 * len(df.columns) + 40).cast("long"))
    return df.agg(F.coalesce(F.sum(row), F.lit(0))).first()[0]


def clustered(df: DataFrame, keys: tuple[str, ...], files: int) -> DataFrame:
    """Rows ordered across and within files by ``keys`` for min/max pruning on read.

    The row number spreads a key that alone holds more than a partition's worth over
    several partitions; ranges on the keys only would put all its rows in one task. The number of
    files is the caller's, from the data's size: the session's setting does not grow with it.
    """
    spread = "__spread"
    return (
        df.withColumn(spread, F.monotonically_increasing_id())
        .repartitionByRange(files, *[F.col(k) for k in keys], F.col(spread))
        .sortWithinPartitions(*keys)
        .drop(spread)
    )


def load_folders(spark: SparkSession, lake: Lake) -> DataFrame:
    """Every load's folder below the lake: schema, table, folder, bytes and last write."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    part = lambda i: F.regexp_extract("path", r"^(.*/([^/]+)/([^/]+)/load-[0-9a-f]{32})/", i)
    return (
        files.load(lake.root)
        .select(part(1).alias("folder"), part(2).alias("schema"), part(3).alias("name"), "length", "modificationTime")
        .where("folder <> ''")
        .groupBy("schema", "name", "folder")
        .agg(F.sum("length").alias("bytes"), F.max("modificationTime").alias("written"))
    )


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete files, and folders with what is in them."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for name in paths:
        path = hadoop(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def folders_in_use(spark: SparkSession, lake: Lake) -> list[str]:
    """Folders of all versions of Silver tables that are entered."""
    table = lake.table(lake.silver, VERSIONS_TABLE)
    if not spark.catalog.tableExists(table):
        return []
    spark.catalog.refreshTable(table)
    folders = F.concat(F.transform("parts", lambda p: p["folder"]), "quarantine")
    return [r[0] for r in spark.table(table).select(F.explode(folders)).distinct().collect()]


def expire(spark: SparkSession, lake: Lake, *, keep: int = 1, delete: bool = False) -> DataFrame:
    """Folders of loads no table reads any more, but for the ``keep`` newest of each table.

    Superseded, refused and failed loads stay on disk until someone asks for this; nothing
    in the package does. Folders of versions that are still entered count as read. Without ``delete`` the
    folders are only listed.
    """
    read = {without_scheme(folder) for folder in folders_in_use(spark, lake)}
    for schema in (lake.bronze, lake.silver):
        for row in spark.sql(f"SHOW TABLES IN `{schema}`").where("NOT isTemporary").collect():
            if not is_view(spark, lake.table(schema, row["tableName"])):
                read.add(without_scheme(lake.location(spark, schema, row["tableName"])))
    folder = F.regexp_replace("folder", r"^[a-zA-Z0-9]+:/*", "/")
    loads = load_folders(spark, lake)
    in_use = reduce(or_, [F.lit(at).startswith(folder) for at in sorted(read)], F.lit(False))
    newest = Window.partitionBy("schema", "name").orderBy(F.desc("written"), "folder")
    unused = loads.where(~in_use).withColumn("rank", F.row_number().over(newest)).where(F.col("rank") > keep).drop("rank")
    if delete:
        rows = unused.collect()  # folder names
        remove(spark, [row["folder"] for row in rows])
        return spark.createDataFrame(rows, unused.schema)
    return unused
