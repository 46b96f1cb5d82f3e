"""Sharding by extendible hashing: a directory of hash prefixes in which only oversized buckets split.

Each row has 60 hash bits. A bucket holds the rows with one prefix; it splits on one more bit as
long as it is over the byte limit and holds several rows. Rows are added up once at a depth
of a few bits beyond the average, which gives the sizes of all shallower buckets too;
only rows of buckets still too large are added up again, deeper. The directory has a
few entries per shard. Rows wholly alike have all bits in common: their bucket goes on in
pages, by the place of the row in a written table.

Defined cases: a null text has no bytes; a null doc_id is hashed as none; several rows with one
doc_id are hashed with their texts; a row above the limit is alone in its shard; an empty table
has no shards; further columns are not read, and ``write_shards`` keeps them.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltworks.llm.shared import documents, whole_row, written

BITS = 60
SHARD_BYTES = 16 << 20
#: Bits added up at once beyond the depth of an average shard.
AHEAD = 6


def hash_bits(doc_id: Column, text: Column) -> Column:
    """The first 60 bits of a digest of id and text."""
    content = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(content), 1, BITS // 4), 16, 10).cast("long")


def prefix(bits: Column | str, depth: int) -> Column:
    return F.shiftright(bits, BITS - depth)


def directory(rows: DataFrame, limit: int, ahead: int = AHEAD) -> list[tuple[int, DataFrame]]:
    """Directories by rising depth: cell (prefix at that depth), depth and start of its bucket, bytes, docs.

    ``rows`` has h and n_bytes. A cell without a bucket is in a later directory.
    """
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    depth = min(BITS, ceil(log2(max(1.0, total / limit))) + ahead)
    low, out = 0, []
    while True:
        cells = rows.groupBy(prefix("h", depth).alias("cell")).agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("docs"))
        cells = written(cells, "cells")
        # Sizes of the buckets of all depths above the cells.
        levels = F.explode(F.sequence(F.lit(low), F.lit(depth))).alias("depth")
        above = cells.select("cell", "bytes", "docs", levels)
        above = above.withColumn("at", F.expr(f"shiftright(cell, {depth} - depth)"))
        buckets = above.groupBy("depth", "at").agg(F.sum("bytes").alias("bucket_bytes"), F.sum("docs").alias("bucket_docs"))
        fits = (F.col("bucket_bytes") <= limit) | (F.col("bucket_docs") == 1) | (F.col("depth") == BITS)
        found = above.join(buckets.where(fits), ["depth", "at"])
        found = found.groupBy("cell").agg(F.min(F.struct("depth", "at", "bucket_bytes", "bucket_docs")).alias("b"))
        start = F.expr(f"shiftleft(b.at, {BITS} - b.depth)").alias("start")
        found = written(found.select("cell", "b.depth", start, F.col("b.bucket_bytes").alias("bytes"), F.col("b.bucket_docs").alias("docs")), "directory")
        out.append((depth, found))
        rest = cells.join(found, "cell", "leftanti").select("cell")
        if depth == BITS or rest.isEmpty():
            return out
        rows = written(rows.join(rest, prefix("h", depth) == F.col("cell")).select("h", "n_bytes"), "oversized")
        low, depth = depth + 1, min(BITS, depth + ahead)


def pages(rows: DataFrame, limit: int) -> DataFrame:
    """Rows of overfull buckets of wholly alike rows with their page: as many rows as the limit holds."""
    path_rows = written(rows, "overfull").select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("line"))
    files = path_rows.groupBy("start", "file").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("start").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("start", "file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    in_file = Window.partitionBy("start", "file").orderBy("line")
    number = F.row_number().over(in_file) - 1
    placed = path_rows.withColumn("number", number).join(files, ["start", "file"])
    per_page = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest("n_bytes", F.lit(1))))
    return placed.withColumn("page", F.floor((F.col("number") + F.col("before")) / per_page)).drop("file", "line", "number", "before")


def shards(docs: DataFrame, limit: int = SHARD_BYTES, ahead: int = AHEAD, carry: bool = False) -> DataFrame:
    """doc_id, n_bytes, shard (from 0 in hash order), depth, shard_bytes, shard_docs of every row.

    ``carry`` adds ``row``, a struct of all columns.
    """
    carried = [whole_row(docs).alias("row")] if carry else []
    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), hash_bits(F.col("doc_id"), text).alias("h"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), *carried,
    )
    rows = written(rows, "hashed")
    parts = None
    for depth, cells in directory(rows.select("h", "n_bytes"), limit, ahead):
        own = rows.join(cells.select("cell", "depth", "start", "bytes", "docs"), prefix("h", depth) == F.col("cell")).drop("cell")
        parts = own if parts is None else parts.unionByName(own)
    overfull = (F.col("depth") == BITS) & (F.col("bytes") > limit) & (F.col("docs") > 1)
    full = pages(parts.where(overfull), limit)
    placed = written(parts.where(~overfull).withColumn("page", F.lit(0).cast("long")).unionByName(full), "placed")
    # A row per shard is numbered in one window.
    sizes = placed.groupBy("start", "depth", "page").agg(F.sum("n_bytes").alias("shard_bytes"), F.count("*").alias("shard_docs"))
    sizes = sizes.withColumn("shard", (F.row_number().over(Window.orderBy("start", "page")) - 1).cast("long")).drop("depth")
    return placed.join(sizes, ["start", "page"]).select(
        "doc_id", "n_bytes", "shard", "depth", "shard_bytes", "shard_docs", *(["row"] if carry else [])
    )


def write_shards(docs: DataFrame, folder: str, limit: int = SHARD_BYTES) -> None:
    """All columns of the rows below ``folder``/_shard=N, a task and a file for each shard."""
    placed = shards(docs, limit, carry=True).select("row.*", F.col("shard").alias("_shard"))
    placed.repartition("_shard").write.partitionBy("_shard").parquet(folder)


def op7_extendible_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards(documents(spark, sf_dir))


SQL = f"""
with d as (
  select doc_id, cast(strlen(coalesce(text, '')) as bigint) as n_bytes,
    cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || ':' || coalesce(text, '')), 1, {BITS // 4}) as bigint) as h
  from documents
), l as (select d.*, g.depth, h >> ({BITS} - g.depth) as p from d, range(0, 41) g(depth)),
s as (select depth, p, sum(n_bytes) as b, count(*) as c from l group by depth, p),
f as (
  select l.doc_id, l.n_bytes, l.h, min(l.depth) as depth from l join s on l.depth = s.depth and l.p = s.p
  where s.b <= {SHARD_BYTES} or s.c = 1 group by l.doc_id, l.n_bytes, l.h
), w as (select *, (h >> ({BITS} - depth)) << ({BITS} - depth) as start from f)
select doc_id, n_bytes, cast(dense_rank() over (order by start) - 1 as bigint) as shard, cast(depth as integer) as depth,
  cast(sum(n_bytes) over (partition by start) as bigint) as shard_bytes, count(*) over (partition by start) as shard_docs
from w
"""

QUERIES = {"op7_extendible_hashing": (op7_extendible_hashing, SQL)}
