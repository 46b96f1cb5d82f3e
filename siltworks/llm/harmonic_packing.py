"""Harmonic packing: pieces of documents into sequences of a fixed capacity.

Lengths fall into reciprocal-capacity classes. Class k holds pieces of ``capacity // k`` ids, so
k of them fill a sequence whatever else there is: a document is cut into whole sequences and
its rest, greedily, into class lengths (a length up to the square root of the capacity is a
class of its own, so nothing remains, and a rest takes three pieces on average). Each worker
numbers its pieces per class on its own; the only thing gathered is how many pieces each
worker has of each class. From these counts a piece's sequence and offset follow by
arithmetic: no piece is moved to be packed. At most one sequence per class stays unfilled
(63 classes at 1024), and these few are put together first-fit.

Defined cases: a null or empty text is the end id alone; a null doc_id is carried along; each
of several rows with one doc_id is a document; an empty table has no pieces; further columns
are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltworks.llm.shared import documents, written
from siltworks.llm.tokens import encode_documents, vocabulary

CAPACITY = 1024
END_ID = 0

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, worker int, rank long"


def class_lengths(capacity: int) -> list[int]:
    """All values of capacity // k, largest first: about twice the square root of the capacity."""
    root = isqrt(capacity)
    return sorted({capacity // k for k in range(1, root + 1)} | set(range(1, root + 1)), reverse=True)


def cut(n_ids: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of documents of these lengths: index of the document, start in it, length; in order."""
    lengths = np.array(class_lengths(capacity)[::-1])
    largest = lengths[np.searchsorted(lengths, np.arange(capacity + 1), "right") - 1]  # index 0 is not used
    whole = n_ids // capacity
    doc = np.repeat(np.arange(len(n_ids)), whole)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(whole) - whole, whole)
    out = [(doc, number * capacity, np.full(len(doc), capacity))]
    doc, start = np.arange(len(n_ids)), whole * capacity
    while len(doc := doc[(rest := (n_ids - start)[doc]) > 0]):
        size = largest[rest[rest > 0]]
        out.append((doc, start[doc], size))
        start[doc] += size
    doc, at, size = (np.concatenate(x) for x in zip(*out, strict=True))
    order = np.lexsort((at, doc))
    return doc[order], at[order], size[order]


def ranks(classes: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Running number of each piece in its class, going on from ``before``, which is updated."""
    order = np.argsort(classes, kind="stable")
    sorted_classes = classes[order]
    n = np.bincount(classes, minlength=len(before))
    first = np.cumsum(n) - n
    out = np.empty(len(classes), np.int64)
    out[order] = np.arange(len(classes)) - first[sorted_classes] + before[sorted_classes]
    before += n
    return out


def cut_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """One row per piece, numbered per worker and class. ``keep_ids`` adds the ids themselves."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker, before = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            ids, bounds = encode_documents(path, batch.column(1), end_id)
            n = np.diff(bounds)
            doc, start, length = cut(n, capacity)
            raw, low = memoryview(ids.astype("<u4").tobytes()), (bounds[doc] + start) * 4
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(low.tolist(), (low + length * 4).tolist(), strict=True)]
            out = [
                batch.column(0).take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(n[doc]),
                pa.array(np.full(len(doc), worker, np.int32)), pa.array(ranks(length, before)),
            ]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "worker", "rank"]
            if keep_ids:
                at = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                out.append(pa.ListArray.from_arrays(pa.array(at), pa.array(ids.astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names)

    columns = [F.col("doc_id").cast("long"), F.col("text").cast("string")]
    return docs.select(*columns).mapInArrow(work, PIECE + (", ids array<int>" if keep_ids else ""))


def combine_last(lengths: dict[int, int], capacity: int) -> dict[int, tuple[int, int]]:
    """First-fit decreasing of the classes' unfilled sequences: number of the sequence and offset there."""
    used: list[int] = []
    out = {}
    for kind, length in sorted(lengths.items(), key=lambda x: (-x[1], x[0])):
        at = next((i for i, n in enumerate(used) if n + length <= capacity), len(used))
        if at == len(used):
            used.append(0)
        out[kind] = (at, used[at])
        used[at] += length
    return out


def pack(spark: SparkSession, pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Sequence and offset of numbered pieces. ``pieces`` is read twice, so it should be a written table.

    One row per worker and class is gathered by class (63 of them per worker at 1024), and one
    row per class reaches the driver.
    """
    have = pieces.groupBy("worker", "length").agg((F.max("rank") + 1).alias("n"))
    by_worker = Window.partitionBy("length").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    have = have.withColumn("before", F.coalesce(F.sum("n").over(by_worker), F.lit(0)))
    totals = {r["length"]: r["n"] for r in have.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    last = combine_last({k: n % (capacity // k) * k for k, n in totals.items() if n % (capacity // k)}, capacity)
    rows, base = [], 0
    for k in sorted(totals, reverse=True):
        per = capacity // k
        rows.append((k, per, totals[k] // per, base, *last.get(k, (0, 0))))
        base += totals[k] // per
    kinds = spark.createDataFrame(rows, "length long, per long, full long, base long, last long, last_at long")
    number = F.col("rank") + F.col("before")
    filled = number < F.col("full") * F.col("per")
    sequence = F.when(filled, F.col("base") + F.floor(number / F.col("per"))).otherwise(F.lit(base) + F.col("last"))
    offset = F.when(filled, number % F.col("per") * F.col("length")).otherwise(
        F.col("last_at") + (number - F.col("full") * F.col("per")) * F.col("length")
    )
    kept = [c for c in pieces.columns if c not in ("worker", "rank")]
    counted = have.select("worker", "length", "before").join(F.broadcast(kinds), "length")  # as many rows as classes
    return pieces.join(counted, ["worker", "length"]).select(
        *kept, sequence.cast("long").alias("sequence_id"), offset.cast("long").alias("offset")
    )


def assemble(packed: DataFrame, capacity: int = CAPACITY, pad_id: int = END_ID) -> DataFrame:
    """Sequences as arrays of ids, from pieces packed with their ids: at most ``capacity`` ids meet in a group."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    ids = F.flatten(F.transform(parts, lambda p: p["ids"]))
    padding = F.array_repeat(F.lit(pad_id), (F.lit(capacity) - F.size(ids)).cast("int"))
    return packed.groupBy("sequence_id").agg(F.concat(ids, padding).alias("ids"), F.sum("length").alias("n_ids"))


def pack_documents(spark: SparkSession, docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Documents cut and packed: one row per piece."""
    pieces = written(cut_documents(docs, path or vocabulary(), capacity, keep_ids=keep_ids), "pieces")
    return pack(spark, pieces, capacity)


def op1_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark, documents(spark, sf_dir))


QUERIES = {"op1_harmonic_packing": (op1_harmonic_packing, None)}
