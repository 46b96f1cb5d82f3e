"""Exact top-k inner products by columnar branch and bound.

Vectors lie vertically, a row per dimension. For a block of candidates the products are summed
dimension block by block; after each, a candidate stays only if its sum plus the most that the
remaining dimensions can add (the product of the lengths of both remainders) reaches the
query's k-th best score so far, and the survivors are moved together.

Queries are taken in chunks of a fixed number of bytes, each sent to all workers; a worker keeps k
results per query while it reads its candidates, and the workers' results are ranked in Spark.

Defined cases: a vector that is null or holds a null, NaN or infinite component takes no part, nor
does a row without vec_id; rows that share the query's vec_id are its own; each query row is
answered by itself; a shorter vector counts as continued by zeros; scores beyond 64 bits are
held at the limit; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

K = 10
EVERY = 100
SCALE = 1024
#: Dimensions added up between two looks at the bounds.
DIMENSIONS = 16
#: Bytes of the queries sent to the workers at once.
CHUNK_BYTES = 16 << 20
#: Products held at once: queries of a tile times candidates of a batch.
TILE = 1 << 21

_EXACT = 2.0**53


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and v, the components as whole numbers, of the rows that take part."""
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(~odd)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("v"))


def matrix(column) -> np.ndarray:
    """List column as rows of whole numbers, shorter ones continued by zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat, width = column.flatten().to_numpy(zero_copy_only=False), int(sizes.max(initial=0))
    if len(sizes) * width == len(flat):
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def widened(rows: np.ndarray, width: int) -> np.ndarray:
    return np.pad(rows, ((0, 0), (0, width - rows.shape[1]))) if rows.shape[1] < width else rows


class Best:
    """The k best candidates of each query so far: score descending, then id ascending."""

    def __init__(self, n: int, k: int):
        self.k, self.scores, self.ids = k, [np.zeros(0, np.int64)] * n, [np.zeros(0, np.int64)] * n

    def least(self, query: int):
        """Score below which nothing counts any more."""
        return self.scores[query][-1] if len(self.scores[query]) == self.k else None

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores[query], scores]), np.concatenate([self.ids[query], ids])
        if len(scores) > 8 * self.k:  # only what reaches the k-th score need be sorted
            kth = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            ids, scores = ids[scores >= kth], scores[scores >= kth]
        order = np.lexsort((ids, ~scores))[: self.k]
        self.scores[query], self.ids[query] = scores[order], ids[order]


def search(best: Best, query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, step: int = DIMENSIONS) -> None:
    """Take a batch of candidates into the queries' best."""
    if not len(ids) or not len(query_ids):
        return
    width = max(queries.shape[1], rows.shape[1])
    queries, rows = widened(queries, width), widened(rows, width)
    top = float(np.abs(queries.astype(float)).max(initial=0)) * float(np.abs(rows.astype(float)).max(initial=0)) * max(1, width)
    if top >= _EXACT:  # sums a double can't hold: whole numbers of any size, no bounds
        large = rows.astype(object).T
        for q in range(len(query_ids)):
            scores = np.dot(queries[q].astype(object), large) if width else np.zeros(len(ids), object)
            other = ids != query_ids[q]
            held = np.array([min(max(int(x), -(2**63)), 2**63 - 1) for x in scores[other]], np.int64)
            best.add(q, held, ids[other])
        return
    vertical, q_rows = np.ascontiguousarray(rows.T, np.float64), queries.astype(np.float64)
    cuts = list(range(0, width, step)) + [width]
    # Lengths of what remains from each cut on; a little more than exact, so rounding drops nothing.
    beyond = lambda m, axis: [np.sqrt((m[c:] if axis == 0 else m[:, c:]).__pow__(2).sum(axis=axis)) * (1 + 1e-9) for c in cuts]
    rest, q_rest = beyond(vertical, 0), beyond(q_rows, 1)
    tile = max(1, TILE // len(ids))
    for low in range(0, len(query_ids), tile):
        first = q_rows[low : low + tile, : cuts[min(1, len(cuts) - 1)]] @ vertical[: cuts[min(1, len(cuts) - 1)]]
        for q in range(low, min(low + tile, len(query_ids))):
            sums, alive = first[q - low], None
            for c in range(1, len(cuts)):
                if c > 1:
                    block = vertical[cuts[c - 1] : cuts[c]]
                    sums = sums + q_rows[q, cuts[c - 1] : cuts[c]] @ (block if alive is None else block[:, alive])
                if (least := best.least(q)) is not None:
                    reach = sums + q_rest[c][q] * (rest[c] if alive is None else rest[c][alive])
                    stay = np.flatnonzero(reach >= least - 0.25)
                    sums, alive = sums[stay], stay if alive is None else alive[stay]
                    if not len(stay):
                        break
            mine = ids if alive is None else ids[alive]
            if len(mine):
                other = mine != query_ids[q]
                best.add(q, np.rint(sums[other]).astype(np.int64), mine[other])


def chunks(queries: DataFrame, max_bytes: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Query ids and vectors, at most ``max_bytes`` of components at once (one vector at least)."""
    ids, rows, held = [], [], 0

    def chunk():
        width = max(map(len, rows))
        return np.array(ids, np.int64), np.stack([np.pad(r, (0, width - len(r))) for r in rows])

    for row in queries.toLocalIterator():
        vector = np.array(row["v"], np.int64)
        if rows and held + vector.nbytes > max_bytes:
            yield chunk()
            ids, rows, held = [], [], 0
        ids.append(row["vec_id"])
        rows.append(vector)
        held += vector.nbytes
    if rows:
        yield chunk()


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, max_bytes: int = CHUNK_BYTES) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``queries`` its k best among ``vectors`` (both vec_id, v)."""
    spark, found = vectors.sparkSession, []
    for number, (query_ids, rows) in enumerate(chunks(queries, max_bytes)):
        sent = spark.sparkContext.broadcast((query_ids, rows))  # max_bytes at most

        def work(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            query_ids, rows = sent.value
            best = Best(len(query_ids), k)
            for batch in batches:
                search(best, query_ids, rows, batch.column(0).to_numpy(), matrix(batch.column(1)))
            sizes = [len(x) for x in best.ids]
            query = np.repeat(np.arange(len(query_ids), dtype=np.int32), sizes)
            out = [pa.array(query), pa.array(query_ids[query]), pa.array(np.concatenate(best.ids)), pa.array(np.concatenate(best.scores))]
            yield pa.RecordBatch.from_arrays(out, ["query", "query_id", "vec_id", "score"])

        local = vectors.select("vec_id", "v").mapInArrow(work, "query int, query_id long, vec_id long, score long")
        found.append(local.withColumn("chunk", F.lit(number)))
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    order = Window.partitionBy("chunk", "query").orderBy(F.desc("score"), "vec_id")
    ranked = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op6_branch_bound_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whole_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return top_k(vectors, vectors.where(F.col("vec_id") % EVERY == 0))


SQL = f"""
with v as (
  select vec_id, list_transform(embedding, lambda x: floor({SCALE} * cast(x as double))) as v from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.v, c.v) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % {EVERY} = 0
), r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as n from s)
select query_id, cast(n as integer) as rank, vec_id, score from r where n <= {K}
"""

QUERIES = {"op6_branch_bound_topk": (op6_branch_bound_topk, SQL)}
