"""Exact length histogram: documents by encoded length, and what its suffix sums answer.

The histogram has a row per distinct length, however many documents there are, and workers add
up their own documents before anything is shuffled. Suffix sums over it give, for a context
limit: documents beyond it, all ids, and the ids left when each document is cut there.
Sums run in two levels (blocks of lengths, then lengths in a block), so no task sees all rows.

Defined cases: a null or empty text has length 0; rows with one doc_id each count; an empty
table gives no rows; further columns are not read, except those named in ``by``, whose nulls
are a group of their own. A column of ``by`` with a name that the histogram or its sums have themselves comes out
as ``by_`` and that name.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltworks.llm.shared import documents, written
from siltworks.llm.tokens import encode_documents, vocabulary

#: Lengths summed in one window.
BLOCK = 4096
_OWN = {"n_tokens", "n_docs", "docs_from", "tokens_from", "total_docs", "total_tokens", "truncated_tokens", "quantile"}


def named(by: Iterable[str]) -> list[str]:
    """What the columns of ``by`` are called in results."""
    return [f"by_{c}" if c in _OWN else c for c in by]


def length_histogram(docs: DataFrame, path: str | None = None, by: Iterable[str] = ()) -> DataFrame:
    """n_tokens, n_docs, for each group of ``by``."""
    by, path = list(by), path or vocabulary()
    groups = [F.col(c).cast("string").alias(f"by{i}") for i, c in enumerate(by)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, bounds = encode_documents(path, batch.column(0), None)
            table = pa.table([*batch.columns[1:], pa.array(np.diff(bounds))], [*batch.schema.names[1:], "n_tokens"])
            added = table.group_by(table.column_names).aggregate([([], "count_all")])
            yield from added.rename_columns([*table.column_names, "n_docs"]).to_batches()

    kinds = "".join(f"by{i} string, " for i in range(len(by)))
    counted = docs.select(F.col("text").cast("string").alias("text"), *groups).mapInArrow(work, f"{kinds}n_tokens long, n_docs long")
    keys = [F.col(f"by{i}").alias(c) for i, c in enumerate(named(by))]
    return counted.groupBy(*keys, "n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def suffix_sums(histogram: DataFrame, by: Iterable[str] = (), block: int = BLOCK) -> DataFrame:
    """For each length: documents and ids at this length or beyond, and the ids left when cutting there.

    ``docs_from`` and ``tokens_from`` count documents of this length or longer;
    ``truncated_tokens`` is the sum over all documents of min(length, n_tokens);
    ``quantile`` is the share of documents that are this long or shorter.
    """
    given = named(by)
    by = [f"_by{i}" for i in range(len(given))]
    histogram = histogram.withColumnsRenamed(dict(zip(given, by, strict=True)))
    h = histogram.withColumn("_block", F.floor(F.col("n_tokens") / block))
    ids = (F.col("n_tokens") * F.col("n_docs")).alias("ids")
    blocks = h.groupBy(*by, "_block").agg(F.sum("n_docs").alias("_docs"), F.sum(ids).alias("_ids"))
    beyond = Window.partitionBy(*by).orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    blocks = blocks.select(
        *[F.col(c).alias(f"_{c}") for c in by], F.col("_block").alias("_at"),
        F.coalesce(F.sum("_docs").over(beyond), F.lit(0)).alias("_docs_beyond"),
        F.coalesce(F.sum("_ids").over(beyond), F.lit(0)).alias("_ids_beyond"),
        F.sum("_docs").over(whole).alias("total_docs"), F.sum("_ids").over(whole).alias("total_tokens"),
    )
    match = F.col("_block") == F.col("_at")
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_{c}"))
    inside = Window.partitionBy(*by, "_block").orderBy(F.desc("n_tokens"))
    docs_from = F.sum("n_docs").over(inside) + F.col("_docs_beyond")
    tokens_from = F.sum(ids).over(inside) + F.col("_ids_beyond")
    out = h.join(blocks, match).withColumns({"docs_from": docs_from, "tokens_from": tokens_from})
    longer = F.col("docs_from") - F.col("n_docs")
    return out.select(
        *[F.col(c).alias(name) for c, name in zip(by, given, strict=True)], "n_tokens", "n_docs", "docs_from", "tokens_from", "total_docs", "total_tokens",
        (F.col("total_tokens") - F.col("tokens_from") + F.col("n_tokens") * F.col("docs_from")).alias("truncated_tokens"),
        ((F.col("total_docs") - longer) / F.col("total_docs")).alias("quantile"),
    )


def at_limits(histogram: DataFrame, limits: Iterable[int]) -> DataFrame:
    """For any context limits, met as a length or not: documents within it and ids left when cutting there."""
    found = []
    for n in sorted(set(limits)):
        cut = F.sum(F.least("n_tokens", F.lit(n)) * F.col("n_docs"))
        fit = F.sum(F.when(F.col("n_tokens") <= n, F.col("n_docs")).otherwise(0))
        found.append(F.struct(F.lit(n).cast("long").alias("n_limit"), fit.alias("docs_within"), cut.alias("truncated_tokens")))
    return histogram.agg(F.array(*found).alias("found")).select(F.inline("found"))


def length_quantiles(suffixes: DataFrame, shares: Iterable[float]) -> DataFrame:
    """The least length that holds at least these shares of the documents."""
    found = [
        F.struct(F.lit(float(q)).alias("share"), F.min(F.when(F.col("quantile") >= q, F.col("n_tokens"))).alias("n_tokens"))
        for q in sorted(set(shares))
    ]
    return suffixes.agg(F.array(*found).alias("found")).select(F.inline("found"))


def op2_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Written, because the sums read it twice and the texts should be encoded once.
    return suffix_sums(written(length_histogram(documents(spark, sf_dir)), "lengths"))


QUERIES = {"op2_length_histogram": (op2_length_histogram, None)}
