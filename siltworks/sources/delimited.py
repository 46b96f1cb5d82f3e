"""Delimited text extracts: scan, file listing, provenance, malformed lines."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The extract format.
SEPARATOR = "^|~"
ENCODING = "UTF-8"
FILE_PATTERN = "*.[tT][xX][tT]"
INGEST_TS = "ingest_ts"
INPUT_FILE_NAME = "input_file_name"

CORRUPT = "_corrupt_record"


def _local_path(path: str) -> str:
    return path.removeprefix("dbfs:")


def delimited_reader(reader, schema: T.StructType, *, keep_corrupt: bool = False, match_header: bool = False):
    """The extract's format on a batch or stream reader. The schema gains CORRUPT with ``keep_corrupt``."""
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    return (
        reader.schema(schema)
        .option("sep", SEPARATOR)
        .option("header", "true")
        .option("encoding", ENCODING)
        .option("mode", "PERMISSIVE")
        .option("maxCharsPerColumn", "-1")
        .option("enforceSchema", str(not match_header).lower())
        .option("columnNameOfCorruptRecord", CORRUPT)
        # A pruned scan would not notice missing or surplus fields.
        .option("columnPruning", str(not keep_corrupt).lower())
        .option("pathGlobFilter", FILE_PATTERN)
    )


def scan_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    *,
    keep_corrupt: bool = False,
    match_header: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """Read ``^|~`` text with a declared schema; columns bind by position.

    Short lines are padded with NULL and long ones cut. ``keep_corrupt`` adds
    ``_corrupt_record`` holding such a line as it was. ``match_header`` makes a header
    that differs from the schema an error. ``multi_line`` allows line breaks inside
    quotes but stops Spark from splitting files, so one file becomes one task.
    """
    reader = delimited_reader(spark.read, schema, keep_corrupt=keep_corrupt, match_header=match_header)
    paths = [path] if isinstance(path, str) else path
    return reader.option("multiLine", str(multi_line).lower()).csv([_local_path(p) for p in paths])


def source_files(spark: SparkSession, folder: str, *, below: bool = False) -> DataFrame:
    """The text files of a landing folder: path, bytes, modification time.

    Only the listing is read; the unselected content column is never loaded. A load takes
    the folder's own files, as the scan does; ``below`` lists the folders in it too.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", FILE_PATTERN)
        .option("recursiveFileLookup", str(below).lower())
        .load(_local_path(folder))
        .select("path", "length", "modificationTime")
    )


def landed_paths(files: DataFrame, folder: str, *, single: bool = False) -> list[str]:
    """Paths of a listing, sorted. None is an error, and so are several where one is wanted."""
    found = sorted(r["path"] for r in files.select("path").collect())
    if not found:
        raise FileNotFoundError(f"no .txt file to load in {folder}")
    if single and len(found) > 1:
        raise ValueError(f"expected one .txt file in {folder}, found {len(found)}: {found}")
    return found


def resolve_source_file(spark: SparkSession, folder: str) -> str:
    """The single text file of a folder; none or several is an error that names them all."""
    return landed_paths(source_files(spark, folder), folder, single=True)[0]


def source_file_census(spark: SparkSession, landing: str, tables: list[str]) -> DataFrame:
    """Files and bytes per table folder below ``landing``, with a verdict per table.

    ``missing`` and ``several`` are the two states a one-file-per-run load refuses.
    """
    folder = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    found = (
        source_files(spark, landing, below=True)
        .groupBy(folder.alias("table_name"))
        .agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"))
    )
    wanted = spark.createDataFrame([(t,) for t in tables], "table_name string")
    n = F.coalesce(F.col("n_files"), F.lit(0))
    return wanted.join(found, "table_name", "left").select(
        "table_name",
        n.alias("n_files"),
        F.coalesce(F.col("n_bytes"), F.lit(0)).alias("n_bytes"),
        F.when(n == 0, "missing").when(n == 1, "single").otherwise("several").alias("verdict"),
    )


def add_provenance(scan: DataFrame, ingest_time: datetime | None = None) -> DataFrame:
    """Add load time and source file name to a file scan.

    The name comes from the scan's own metadata, so it is right for every row when a
    folder holds several files. Pass the run's clock to make the load repeatable.
    """
    stamp = F.current_timestamp() if ingest_time is None else F.lit(ingest_time).cast("timestamp")
    return scan.withColumns({INGEST_TS: stamp, INPUT_FILE_NAME: F.col("_metadata.file_name")})


def malformed_rows(scan: DataFrame) -> DataFrame:
    """Lines whose field count is not the schema's, from a ``keep_corrupt`` scan."""
    return scan.filter(F.col(CORRUPT).isNotNull())


def malformed_census(scan: DataFrame) -> DataFrame:
    """Lines and malformed lines per file of a ``keep_corrupt`` scan."""
    # A query that needs only the corrupt column is refused, so a data column goes in too.
    first = next(c for c in scan.columns if c != CORRUPT)
    malformed = F.when(F.col(CORRUPT).isNotNull(), F.coalesce(F.col(first), F.lit("")))
    return scan.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(malformed).alias("n_malformed")
    )
