"""Token files: ids one after another, documents found through Elias-Fano encoded bounds.

A file holds a run of documents in ascending doc_id order: a header, the bounds of the documents
and their doc_ids as two Elias-Fano sequences, and the ids at two bytes each (four, if the
vocabulary needs it). A rising sequence of n numbers below u takes about 2 + log2(u / n) bits
a number: the low bits are packed side by side, the high bits are unary in a bit vector in
which ``select`` (a sample every 256 ones, then a count of bits) finds the i-th number, so a
document is read without decoding the others.

Files are rows of a Parquet table (``shard``, ``payload``): Spark commits them, so a
file of a lost or repeated task is never seen, and any store that Spark writes will do.

Defined cases: a null or empty text is the end id alone; rows without doc_id come first; rows
with one doc_id are documents of their own, ordered by their text's hash; an empty table gives
an empty set of files and no rows; further columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltworks.llm.shared import documents, save, shared_path
from siltworks.llm.tokens import encode_documents, encoder, vocabulary

END_ID = 0
#: Ids after which a new file begins. A longer document has a file of its own.
FILE_IDS = 1 << 20
SAMPLE = 256

_HEADER = struct.Struct("<4sBQQQq")  # mark, bytes per id, ids, documents, documents without doc_id, least doc_id
_SEQUENCE = struct.Struct("<QBQQ")  # numbers, low bits each, bytes of low bits, bytes of high bits


def _pack(values: np.ndarray, bits: int) -> np.ndarray:
    if not bits:
        return np.zeros(0, np.uint8)
    planes = (values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(planes.astype(np.uint8).ravel(), bitorder="little")


def encode_rising(values: np.ndarray) -> bytes:
    """Elias-Fano form of numbers (unsigned 64 bits) that never fall."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    bits = max(0, (int(values[-1]) // n).bit_length() - 1) if n else 0
    low = _pack(values & np.uint64((1 << bits) - 1), bits)
    high = np.zeros(0, np.uint8)
    if n:
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(ones[-1]) + 1, np.uint8)
        unary[ones] = 1
        high = np.packbits(unary, bitorder="little")
    return _SEQUENCE.pack(n, bits, len(low), len(high)) + low.tobytes() + high.tobytes()


class Rising:
    """Reads an Elias-Fano sequence at a place of a buffer."""

    def __init__(self, buffer, at: int):
        self.n, self.bits, n_low, n_high = _SEQUENCE.unpack_from(buffer, at)
        at += _SEQUENCE.size
        self.low = np.frombuffer(buffer, np.uint8, n_low, at)
        self.high = np.frombuffer(buffer, np.uint8, n_high, at + n_low)
        self.end = at + n_low + n_high
        # The select structure: ones before each byte at every SAMPLE-th one, made when first asked.
        self._samples = None

    def _low(self, i: int) -> int:
        bit, out = i * self.bits, 0
        first, last = bit >> 3, (bit + self.bits + 7) >> 3
        out = int.from_bytes(self.low[first:last].tobytes(), "little") >> (bit & 7)
        return out & ((1 << self.bits) - 1)

    def select(self, i: int) -> int:
        """Place of the i-th one of the high bits."""
        if self._samples is None:
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.high), dtype=np.int64)])
            first = np.searchsorted(before, np.arange(0, self.n, SAMPLE), "right") - 1
            self._samples = np.column_stack([first, before[first]])
        at, seen = self._samples[i // SAMPLE]
        step = 64
        while True:
            ones = np.cumsum(np.bitwise_count(self.high[at : at + step]), dtype=np.int64) + seen
            if ones[-1] > i:
                k = int(np.searchsorted(ones, i, "right"))
                before = int(ones[k - 1]) if k else int(seen)
                bits = np.flatnonzero(np.unpackbits(self.high[at + k : at + k + 1], bitorder="little"))
                return (int(at) + k) * 8 + int(bits[i - before])
            at, seen = at + step, ones[-1]

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        return ((self.select(i) - i) << self.bits) | self._low(i)

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        out = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.bits)
        if self.bits:
            planes = np.unpackbits(self.low, bitorder="little")[: self.n * self.bits].reshape(self.n, self.bits)
            for k in range(self.bits):
                out |= planes[:, k].astype(np.uint64) << np.uint64(k)
        return out


def encode_file(doc_ids: list[int | None], bounds: np.ndarray, ids: np.ndarray, width: int) -> bytes:
    """A file of documents in order; ``bounds`` has one number more than there are documents."""
    known = np.array([x for x in doc_ids if x is not None], np.int64)
    least = int(known[0]) if len(known) else 0
    header = _HEADER.pack(b"SWT1", width, len(ids), len(doc_ids), len(doc_ids) - len(known), least)
    from_least = known.astype(np.uint64) - np.uint64(least % (1 << 64))
    return header + encode_rising(bounds[1:]) + encode_rising(from_least) + ids.astype(f"<u{width}").tobytes()


class TokenFile:
    """Documents of one file, each found through the bounds alone."""

    def __init__(self, payload):
        mark, self.width, self.n_ids, self.n_docs, self.n_null, self.least = _HEADER.unpack_from(payload, 0)
        if mark != b"SWT1":
            raise ValueError("not a token file")
        self.ends = Rising(payload, _HEADER.size)
        self.names = Rising(payload, self.ends.end)
        self.ids = np.frombuffer(payload, f"<u{self.width}", self.n_ids, self.names.end)

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.ends[i - 1] if i else 0 : self.ends[i]]

    def doc_id(self, i: int) -> int | None:
        return None if i < self.n_null else self.names[i - self.n_null] + self.least

    def bounds(self) -> np.ndarray:
        return np.concatenate([[0], self.ends.all().astype(np.int64)])

    def doc_ids(self) -> pa.Array:
        known = (self.names.all() + np.uint64(self.least % (1 << 64))).astype(np.int64)
        values = np.concatenate([np.zeros(self.n_null, np.int64), known])
        return pa.array(values, mask=np.arange(self.n_docs) < self.n_null)


def write_token_files(spark: SparkSession, docs: DataFrame, path: str | None = None, folder: str | None = None, end_id: int = END_ID, file_ids: int = FILE_IDS) -> str:
    """Write all documents' ids in ascending doc_id order; returns the folder."""
    path, folder = path or vocabulary(), folder or shared_path(spark, "tokens")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker, number = TaskContext.get().partitionId(), 0
        width = 2 if encoder(path).tokenizer.get_vocab_size() <= 1 << 16 else 4
        names, sizes, ids, held = [], [], [], 0

        def file():
            nonlocal number, names, sizes, ids, held
            bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            payload = encode_file(names, bounds, np.concatenate(ids), width)
            row = [pa.array([worker], pa.int32()), pa.array([number], pa.int32()), pa.array([int(bounds[-1])], pa.int64()), pa.array([payload], pa.binary())]
            number, names, sizes, ids, held = number + 1, [], [], [], 0
            return pa.RecordBatch.from_arrays(row, ["worker", "shard", "n_ids", "payload"])

        for batch in batches:
            found, bounds = encode_documents(path, batch.column(0), end_id)
            doc_ids, at = batch.column(1).to_pylist(), 0
            while at < len(doc_ids):
                upto = max(at + 1, int(np.searchsorted(bounds, bounds[at] + file_ids - held, "right")) - 1)
                upto = min(upto, len(doc_ids))
                if held and bounds[upto] - bounds[at] + held > file_ids:
                    yield file()
                    continue
                names += doc_ids[at:upto]
                sizes += np.diff(bounds[at : upto + 1]).tolist()
                # A copy, so that the batch's ids need not stay in memory with it.
                ids.append(found[bounds[at] : bounds[upto]].astype(f"<u{width}"))
                held += int(bounds[upto] - bounds[at])
                at = upto
        if names:
            yield file()

    rows = docs.select(F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    save(ordered.mapInArrow(work, "worker int, shard int, n_ids long, payload binary"), folder)
    return folder


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files alone."""
    files = spark.read.schema("worker int, shard int, n_ids long, payload binary").parquet(folder)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for worker, shard, payload in zip(*(batch.column(i) for i in range(3)), strict=True):
                file = TokenFile(payload.as_buffer())
                bounds, raw = file.bounds(), memoryview(file.ids.astype("<u4").tobytes())
                at = (bounds * 4).tolist()
                crc = [zlib.crc32(raw[a:b]) for a, b in zip(at, at[1:], strict=False)]
                n = file.n_docs
                columns = [
                    pa.array([worker.as_py()] * n, pa.int32()), pa.array([shard.as_py()] * n, pa.int32()), file.doc_ids(),
                    pa.array(bounds[:-1]), pa.array(np.diff(bounds)), pa.array(crc, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["worker", "shard", "doc_id", "at", "n_tokens", "ids_crc32"])

    found = files.select("worker", "shard", "payload").mapInArrow(
        work, "worker int, shard int, doc_id long, at long, n_tokens long, ids_crc32 long"
    )
    # Ids before each file: sums over the files of a worker, and over workers; one row per file.
    workers = files.groupBy("worker").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    workers = workers.select("worker", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before_worker"))
    inside = Window.partitionBy("worker").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = files.select("worker", "shard", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("before_shard"))
    before = shards.join(workers, "worker")
    start = (F.col("before_worker") + F.col("before_shard") + F.col("at")).alias("start")
    return found.join(before, ["worker", "shard"]).select("doc_id", start, "n_tokens", "ids_crc32")


def op9_elias_fano_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_token_files(spark, write_token_files(spark, documents(spark, sf_dir)))


QUERIES = {"op9_elias_fano_tokens": (op9_elias_fano_tokens, None)}
