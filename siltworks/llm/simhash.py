"""Near-duplicates by SimHash: an inverted index over the bytes of fingerprints, with count filtering.

A fingerprint has 64 bits, one for each bit position of its shingles' XXH64: set where over half of
them have it set, shingles counted as often as they occur. Documents link where at most four bits
differ.

* Index. A fingerprint is its eight bytes at their positions. Four differing bits spoil four bytes at
  most, so a link's sides share four positional bytes or more: that is the least tally a pair
  must reach. Lists of single bytes would hold a 256th of the corpus each, so the index keeps a list
  for each set of four positions and their bytes instead, 70 for a fingerprint: a pair
  reaches the tally exactly if it meets in one of them, and nothing is tallied for the others.
* Verification. The members of a list are compared by the bits that differ. Short lists are compared
  pair by pair; in a longer one each member reached takes along those not yet reached, and the
  links kept are the tree by which it reached them. So copies cost what they are, not their square.
* Crowded lists, beyond a fixed number of fingerprints, are not gathered. Their members write down
  all 2,081 values within two bits of theirs; two fingerprints link exactly if they share such a
  value, and at most 2,081 fingerprints can share one.

Equal fingerprints are one node from the start, and components of nodes give the classes.

Defined cases: a null text, and one without words, has the fingerprint zero and is linked like any other; several rows
with one doc_id are documents of their own; rows without doc_id are linked, but name no component (null if
nobody else is in it); an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.llm.components import components
from siltworks.llm.shared import documents, written
from siltworks.llm.words import Words, blocks

WORDS = 4
SEED = 42
DIFFER = 4
POSITIONS = 8
#: Fingerprints that one list may hold to be compared in memory; longer ones go by neighbouring values.
CROWDED = 8_192
#: Lists up to this length are compared pair by pair.
SHORT = 16
#: Shingles hashed at once.
HASHED = 1 << 17

_DELIMITER = np.isin(np.arange(256), [32, *range(9, 14)])
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float64)


def fingerprints_of(data: np.ndarray, bounds: np.ndarray, words: int = WORDS, seed: int = SEED) -> np.ndarray:
    """Fingerprint of each text of a block."""
    found = Words(data, bounds, _DELIMITER)
    raw, n = found.text.tobytes(), np.diff(found.of)
    count = np.maximum(n - words + 1, np.minimum(n, 1))
    doc = np.repeat(np.arange(len(n)), count)
    first = found.of[:-1][doc] + np.arange(len(doc)) - (np.cumsum(count) - count)[doc]
    last = np.minimum(first + words, found.of[1:][doc]) - 1
    start, end = found.start[first], found.end[last]
    ones, digest = np.zeros((len(n), 64)), xxhash.xxh64_digest
    for low in range(0, len(doc), HASHED):
        part = slice(low, low + HASHED)
        hashes = b"".join([digest(raw[a:b], seed) for a, b in zip(start[part].tolist(), end[part].tolist(), strict=True)])
        planes = np.frombuffer(hashes, np.uint8).reshape(-1, POSITIONS)  # the highest byte first
        base, upto = doc[low], doc[part][-1] + 1
        key = ((doc[part] - base)[:, None] * POSITIONS + np.arange(POSITIONS)) * 256 + planes
        tally = np.bincount(key.reshape(-1), minlength=(upto - base) * POSITIONS * 256)
        ones[base:upto] += (tally.reshape(-1, 256) @ _BITS).reshape(-1, 64)
    return np.packbits(2 * ones > count[:, None], axis=1).view(">u8").reshape(-1).astype(np.uint64)


def fingerprints(docs: DataFrame, words: int = WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed number) of every document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, bounds in blocks(batch.column(1)):
                prints = fingerprints_of(data, bounds, words, seed)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), pa.array(prints.view(np.int64))], ["doc_id", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(work, "doc_id long, fp long")


def lists(nodes: DataFrame, differ: int = DIFFER) -> DataFrame:
    """places, bytes, fp: the fingerprints under each set of positions that a link can share."""
    entries = []
    for number, places in enumerate(combinations(range(POSITIONS), POSITIONS - differ)):
        mask = sum(0xFF << (8 * p) for p in places)
        signed = mask - (1 << 64) if mask >> 63 else mask
        entries.append(F.struct(F.lit(number).alias("places"), F.col("fp").bitwiseAND(F.lit(signed)).alias("bytes")))
    return nodes.select("fp", F.inline(F.array(*entries))).select("places", "bytes", "fp")


def reached(prints: np.ndarray, differ: int) -> list[tuple[int, int]]:
    """Links among fingerprints that join what belongs together: a tree for each component."""
    out, left = [], np.arange(len(prints))
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            i = front.pop()
            near = np.bitwise_count(prints[left] ^ prints[i]) <= differ
            found, left = left[near], left[~near]
            out += [(i, j) for j in found.tolist()]
            front += found.tolist()
    return out


def compared(shared: DataFrame, differ: int) -> DataFrame:
    """a, b: links within the lists of ``shared`` (a column ``fps``)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            size = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            prints = column.flatten().to_numpy().view(np.uint64)
            start = np.cumsum(size) - size
            a, b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
            short = size <= SHORT
            rest = np.repeat(np.where(short, start + size, 0), size) - np.arange(len(prints))  # members from here on
            for step in range(1, SHORT):
                at = np.flatnonzero(rest > step)
                at = at[np.bitwise_count(prints[at] ^ prints[at + step]) <= differ]
                a.append(prints[at])
                b.append(prints[at + step])
            for i in np.flatnonzero(~short).tolist():
                own = prints[start[i] : start[i] + size[i]]
                links = np.array(reached(own, differ), np.int64).reshape(-1, 2)
                a.append(own[links[:, 0]])
                b.append(own[links[:, 1]])
            sides = [pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)]
            yield pa.RecordBatch.from_arrays(sides, ["a", "b"])

    return shared.select("fps").mapInArrow(work, "a long, b long")


def by_near_values(members: DataFrame, differ: int) -> DataFrame:
    """a, b: links among fingerprints (fp), by the values that both are within half the difference of."""
    flips = [0] + [sum(1 << p for p in places) for k in range(1, differ // 2 + 1) for places in combinations(range(64), k)]
    flipped = np.array(flips, np.uint64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy().view(np.uint64)
            for low in range(0, len(prints), 512):
                part = prints[low : low + 512]
                values = (part[:, None] ^ flipped).reshape(-1)
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(np.repeat(part, len(flipped)).view(np.int64))], ["value", "fp"])

    values = members.select("fp").mapInArrow(work, "value long, fp long")
    held = values.groupBy("value").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    return held.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b").distinct()


def links_of(nodes: DataFrame, differ: int = DIFFER, crowded: int = CROWDED) -> DataFrame:
    """a, b: links that join all fingerprints (fp, distinct) which belong together."""
    index = lists(nodes, differ)
    sizes = index.groupBy("places", "bytes").agg(F.count("*").alias("n")).where("n > 1")
    sizes = written(sizes, "simhash-lists")
    small = written(index.join(sizes.where(F.col("n") <= crowded).drop("n"), ["places", "bytes"]), "simhash-members")
    links = compared(small.groupBy("places", "bytes").agg(F.collect_list("fp").alias("fps")), differ)
    over = sizes.where(F.col("n") > crowded)
    if not over.isEmpty():
        members = written(index.join(over, ["places", "bytes"], "leftsemi").select("fp").distinct(), "simhash-crowded")
        links = links.unionByName(by_near_values(members, differ))
    return links


def near_duplicates(docs: DataFrame, differ: int = DIFFER, words: int = WORDS, seed: int = SEED, crowded: int = CROWDED) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id, kept of every document. ``differ`` is 2, 4 or 6."""
    if differ not in (2, 4, 6):
        raise ValueError("differ must be 2, 4 or 6")
    signed = written(fingerprints(docs, words, seed), "simhash")
    nodes = written(signed.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "simhash-nodes")
    found = components(links_of(nodes.select("fp"), differ, crowded))
    joined = nodes.join(found, nodes["fp"] == found["node"], "left")
    joined = joined.select("fp", "first_doc", F.coalesce("component", "fp").alias("component"))
    least = joined.groupBy("component").agg(F.min("first_doc").alias("component_id"))
    named = written(joined.join(least, "component").select("fp", "component_id"), "simhash-named")
    rows = signed.join(named, "fp")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.select("doc_id", digits.alias("fingerprint"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op13_simhash_byte_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


QUERIES = {"op13_simhash_byte_index": (op13_simhash_byte_index, None)}
