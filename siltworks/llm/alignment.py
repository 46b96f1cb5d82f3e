"""Alignment of two tokenizers over the same texts, as an Arrow pipeline merged by Spark.

Each text is encoded by A (byte-level BPE, from ``tokenizers``) and by B (merges, from ``sentencepiece``), and
both sides' tokens are laid over the bytes of a space and the text. Where tokens of both end at one byte, a
group ends; two tokens are linked where their bytes overlap.

* Ends. A block of texts gives two list columns of ids. Their elements are flattened with the indices of their
  parents, ids are replaced by byte lengths, and sums that start anew with each text give the
  end of every token, as the key (text, byte).
* Join. A full outer hash join of both sides on that key has one row for each byte at which any token ends.
  Each row is the end of one overlap, so it is one link; rows with both sides are the ends of groups.
* Counts. A block's links are grouped by pair of ids, and Spark adds up the blocks' counts. A block asks for
  the totals of its own pairs only, each once, so a pair that every text has travels once per
  block instead of once per link.

Blocks are written once, with links as positions in the block's list of pairs; the second pass reads numbers only.

Defined cases: a text that is null, empty, or that one side's tokens don't spell exactly (such as one with U+2581,
which B reads as a space) has no tokens: zeros and an empty digest. Strings of special tokens are plain text.
Several rows with one doc_id are documents of their own; a missing doc_id is carried along; an empty table gives
no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.llm.shared import documents, written
from siltworks.llm.tokens import _BYTE_CHARS, _BASE, _INVERSE, AT_ONCE, Encoder, gather, powers, vocabulary
from siltworks.llm.words import blocks

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
MARK = "▁"
#: Bytes of text and number of texts in a block; a longer text is a block of its own.
BLOCK, TEXTS = 1 << 20, 20_000
#: Pieces of text one side remembers before it starts anew.
REMEMBERED = 250_000
#: Bits of a key that count bytes; the others count the texts of a block.
BYTES = 40


class TokenBytes:
    """What each id stands for: its bytes, their number, and its decimal digits."""

    def __init__(self, pieces: list[bytes]):
        self.length = np.array([len(p) for p in pieces], np.int64)
        self.flat = np.frombuffer(b"".join(pieces), np.uint8)
        self.start = np.cumsum(self.length) - self.length
        self.digits = pa.array([str(i) for i in range(len(pieces))])

    def spell(self, ids: np.ndarray) -> np.ndarray:
        return gather(self.flat, self.start[ids], self.length[ids])


class ByteLevel(Encoder):
    """A: the byte-level encoder, which here reads special tokens as plain text."""

    def __init__(self, path: str):
        super().__init__(path)
        self.tokenizer.encode_special_tokens, self.special = True, []
        value = {c: bytes([b]) for b, c in enumerate(_BYTE_CHARS)}
        names = {i: t for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        added = self.tokenizer.get_added_tokens_decoder()
        plain = [b"" if i in added else b"".join(value[c] for c in names.get(i, "")) for i in range(max(names) + 1)]
        self.bytes = TokenBytes(plain)


class Merges(Encoder):
    """B: the library's merges, a piece of text at a time.

    No piece of the model goes on past a space or holds a newline, so ids of texts are those of their parts, cut
    where A's are. The model puts a space before what it is given.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.special = []
        self.powers, self.back = powers(_BASE, AT_ONCE + 1), powers(_INVERSE, AT_ONCE + 1)
        self.forget()
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any("\n" in x or MARK in x.lstrip(MARK) for x in names):
            raise ValueError("a piece goes on past a space or a line's end")
        is_byte = self.model.is_byte
        self.bytes = TokenBytes([bytes([int(x[3:5], 16)]) if is_byte(i) else x.replace(MARK, " ").encode() for i, x in enumerate(names)])
        self.lead = len(self.model.encode("\n"))  # ids of the space put before and of a newline

    def _library(self, pieces: list[str]) -> list[bytes]:
        return self.encode_pieces(pieces)

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        plain = [len(p) > 1 and p[0] == " " for p in pieces]
        found = self.model.encode([p[1:] if ok else "\n" + p for p, ok in zip(pieces, plain, strict=True)], num_threads=1)
        return [array("I", ids if ok else ids[self.lead :]).tobytes() for ids, ok in zip(found, plain, strict=True)]


@lru_cache(maxsize=1)
def encoders(a_path: str, b_path: str) -> tuple[ByteLevel, Merges]:
    """The worker's encoders: files are read once per Python process."""
    return ByteLevel(a_path), Merges(b_path)


def spelled(side: Encoder, ids: np.ndarray, n: np.ndarray, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whether each text's tokens spell it."""
    size = side.bytes.length[ids]
    ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(n)])]
    good = np.diff(ends) == np.diff(bounds)
    if good.all():
        wrong = np.flatnonzero(side.bytes.spell(ids) != data)
        good[np.searchsorted(bounds, wrong, "right") - 1] = False
        return good
    at = np.concatenate([[0], np.cumsum(n)])
    for i in np.flatnonzero(good).tolist():
        good[i] = np.array_equal(side.bytes.spell(ids[at[i] : at[i + 1]]), data[bounds[i] : bounds[i + 1]])
    return good


def token_lists(side: Encoder, texts: pa.Array) -> tuple[pa.ListArray, np.ndarray]:
    """Ids of each text, and whether they spell it."""
    all_ids, counts, good = [], [], []
    for low, high, data, bounds in blocks(texts, AT_ONCE, TEXTS):
        ids, n = side.encode(texts.slice(low, high - low))
        if len(side.hashes) > REMEMBERED:
            side.forget()
        all_ids.append(ids.astype(np.int32))
        counts.append(n)
        good.append(spelled(side, ids, n, data, bounds))
    at = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(np.concatenate(all_ids))), np.concatenate(good)


def ends(lists: pa.ListArray, length: np.ndarray) -> pa.Array:
    """Key (text, byte) of the end of each token of a list column."""
    parent = pc.list_parent_indices(lists).cast(pa.int64())
    running = pc.cumulative_sum(pa.array(length).take(pc.list_flatten(lists)))
    # A text's sums start anew: what was reached before its first token goes.
    first = np.concatenate([[0], running.to_numpy()])[lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()]
    within = pc.subtract(running, pa.array(first).take(parent))
    return pc.add(pc.shift_left(parent, BYTES), within)


def joined_by(strings: pa.Array, offsets: np.ndarray, mark: str) -> pa.Array:
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), strings), mark)


def align(a: pa.ListArray, b: pa.ListArray, a_side: TokenBytes, b_side: TokenBytes) -> dict[str, pa.Array]:
    """Per text: n_a, n_b, n_groups, n_links, groups; per link, text by text: its place among ``pairs``; pairs and times.

    A pair is the id of A in the upper 32 bits, and that of B.
    """
    a_ids, b_ids, n = pc.list_flatten(a), pc.list_flatten(b), len(a)
    left = pa.table({"end": ends(a, a_side.length), "a": pa.array(np.ones(len(a_ids), bool))})
    right = pa.table({"end": ends(b, b_side.length), "b": pa.array(np.ones(len(b_ids), bool))})
    rows = left.join(right, "end", join_type="full outer", use_threads=False)
    rows = rows.take(pc.sort_indices(rows["end"]))
    has_a, has_b = (rows[c].is_valid().combine_chunks().to_numpy(zero_copy_only=False) for c in ("a", "b"))
    text = pc.shift_right(rows["end"], BYTES).to_numpy()
    # All texts end on both sides, so counting ends over the block gives places in the flat ids.
    past_a, past_b = np.cumsum(has_a), np.cumsum(has_b)
    a_of, b_of = a_ids.to_numpy()[past_a - has_a], b_ids.to_numpy()[past_b - has_b]
    link = pa.array((a_of.astype(np.int64) << 32) | b_of).dictionary_encode()
    counts = pa.table({"at": link.indices}).group_by("at", use_threads=False).aggregate([("at", "count")]).sort_by("at")
    close = has_a & has_b
    groups = pc.binary_join_element_wise(
        joined_by(a_side.digits.take(a_ids), np.concatenate([[0], past_a[close]]), ","),
        joined_by(b_side.digits.take(b_ids), np.concatenate([[0], past_b[close]]), ","), "|",
    )
    n_groups = np.bincount(text[close], minlength=n)
    return {
        "n_a": a.value_lengths().cast(pa.int64()), "n_b": b.value_lengths().cast(pa.int64()), "n_groups": pa.array(n_groups),
        "n_links": pa.array(np.bincount(text, minlength=n)), "groups": joined_by(groups, np.concatenate([[0], np.cumsum(n_groups)]), ";"),
        "links": link.indices, "pairs": link.dictionary, "times": counts["at_count"].combine_chunks(),
    }


BLOCK_SCHEMA = (
    "block long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups_sha256 array<string>, links binary, pairs array<long>, times array<long>"
)


def aligned_blocks(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per block of texts: its documents' numbers, its links, and its pairs with their counts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        names = [c.split()[0] for c in BLOCK_SCHEMA.split(", ")]
        for batch in batches:
            for low, high, _, _ in blocks(batch.column(1), BLOCK, TEXTS):
                a_side, b_side = encoders(a_path, b_path)
                texts = batch.column(1).slice(low, high - low)
                (a, a_good), (b, b_good) = token_lists(a_side, texts), token_lists(b_side, texts)
                if not (good := a_good & b_good).all():  # the others have no tokens
                    bad = pa.array(~good)
                    a, b = (pc.if_else(bad, pa.scalar([], x.type), x) for x in (a, b))
                found = align(a, b, a_side.bytes, b_side.bytes)
                digest = [hashlib.sha256(g.as_buffer()).hexdigest() if g.as_buffer().size else "" for g in found.pop("groups")]
                columns = [batch.column(0).slice(low, high - low), *(found[c] for c in names[2:6]), pa.array(digest, pa.string())]
                links = pa.array([packed(found["links"].to_numpy(), len(found["pairs"]))], pa.binary())
                rows = [pa.array([block], pa.int64()), *map(one_row, columns), links, one_row(found["pairs"]), one_row(found["times"])]
                yield pa.RecordBatch.from_arrays(rows, names)
                block += 1
                del a, b, found, columns, rows, links
                pa.default_memory_pool().release_unused()

    text = F.col("text").cast("string")
    spaced = F.when(F.length(text) > 0, F.concat(F.lit(" "), text)).otherwise(F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), spaced.alias("text")).mapInArrow(work, BLOCK_SCHEMA)


def _width(n_pairs: int) -> type:
    return np.uint16 if n_pairs <= 1 << 16 else np.uint32


def packed(links: np.ndarray, n_pairs: int) -> bytes:
    """Places of links as bytes: Spark need not take each as a value."""
    return links.astype(_width(n_pairs)).tobytes()


def one_row(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, n (links of the whole corpus), best (its B id has no pair with more)."""
    each = aligned.select(F.inline(F.arrays_zip("pairs", "times"))).groupBy("pairs").agg(F.sum("times").alias("n"))
    each = written(each.select(F.col("pairs").alias("pair"), "n", F.col("pairs").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b")), "pair-counts")
    most = each.groupBy("b").agg(F.max("n").alias("most"))  # a B id has as many pairs as A has ids, at most
    return each.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def per_document(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """The contract's columns of every document."""
    wanted = aligned.select("block", F.posexplode("pairs").alias("at", "pair"))
    answers = wanted.join(counts, "pair").groupBy("block").agg(F.collect_list(F.struct("at", "n", "best")).alias("known"))
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in schema.split(", ")]
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(j)[i].values for j, name in enumerate(batch.schema.names) if name not in ("block", "links")}
                n_links, n_pairs = row["n_links"].to_numpy(), len(row["known"] or ())
                links = np.frombuffer(batch.column("links")[i].as_buffer(), _width(n_pairs))
                times, best = np.zeros(n_pairs, np.int64), np.zeros(n_pairs, np.int64)
                if n_pairs:
                    at = row["known"].field(0).to_numpy()
                    times[at] = row["known"].field(1).to_numpy()
                    best[at] = row["known"].field(2).to_numpy(zero_copy_only=False)
                upto = np.cumsum(n_links)
                sums = [np.concatenate([[0], np.cumsum(x[links])]) for x in (best, times)]
                n_best, count_sum = (pa.array(s[upto] - s[upto - n_links]) for s in sums)
                columns = [row["doc_ids"], *(row[c] for c in names[1:5]), n_best, count_sum, row["groups_sha256"]]
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = aligned.drop("pairs", "times").join(answers, "block", "left")
    return rows.mapInArrow(work, schema)


def aligned_documents(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    aligned = written(aligned_blocks(docs, a_path or vocabulary(A_FILE), b_path or vocabulary(B_FILE)), "aligned")
    return per_document(aligned, written(pair_counts(aligned), "pairs"))


def id_pairs(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """a, b, n, best: how often each pair of ids is linked; ``best`` pairs map B's ids to A's."""
    aligned = written(aligned_blocks(docs, a_path or vocabulary(A_FILE), b_path or vocabulary(B_FILE)), "aligned")
    found = pair_counts(aligned)
    return found.select(F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b"), "n", "best")


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned_documents(documents(spark, sf_dir))


QUERIES = {"op11_tokenizer_alignment": (op11_tokenizer_alignment, None)}
