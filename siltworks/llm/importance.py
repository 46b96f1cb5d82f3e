"""Importance resampling toward a target distribution, over hashed runs of words.

A document's features are its runs of 1 to ``longest`` consecutive words, joined by single spaces and hashed by
CRC-32 into buckets. A bucket gains what its smoothed share in the target is larger than in the corpus
(logarithm, in thousandths, rounded down); a document weighs the mean gain of its features, gets Gumbel
noise from its id, and the highest scores are drawn, which samples without replacement in proportion to
the exponential of the weights.

* Dictionary. A worker keeps an Aho-Corasick automaton of distinct words with a delimiter on each side;
  each carries CRC and length as its payload. Scanning a block of texts emits the payloads of
  all words known, in order. Words met twice in a block are learned until the dictionary is full; the
  others are hashed directly, so its size changes the time only.
* Composition. The CRC of a run follows from those of its neighbours: the left one moved on by the right one's length
  (a linear map over the bits, by powers of two), and the two combined. No run is put together as a string.
* Counting and scoring. Buckets are written once per document. Spark counts them, and the gains (one number a
  bucket) go to the workers for the scores.
* Drawing. Counts of coarse scores say from where on documents can be drawn; those are sorted by ranges,
  numbered where they are, and the counts of the parts say where each part's numbers begin.

Defined cases: a null text, and one without words, has no features, weight 0, and is never drawn; several
rows with one doc_id are documents of their own with the same noise; a missing doc_id is hashed as the empty string and comes last
among equals; an empty corpus gives no rows, an empty target has count 0 in all buckets; further columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.llm.shared import documents, written
from siltworks.llm.words import Words, blocks

LONGEST = 1
BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = "2024"
#: Words of a worker's dictionary (about 1 kB each).
DICTIONARY = 20_000
#: Scores counted together when the cut is looked for.
COARSE = 64

_CODES = np.arange(256)
_DELIMITER = (_CODES <= 0x2F) | ((_CODES >= 0x3A) & (_CODES <= 0x60)) | ((_CODES >= 0x7B) & (_CODES <= 0x7F))
_SPACE = np.uint32(zlib.crc32(b" "))


def _tables(columns: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, given by what it makes of each bit, as a table for each byte."""
    out = np.zeros((4, 256), np.uint32)
    for byte in range(4):
        for bit in range(8):
            out[byte, (_CODES >> bit & 1) > 0] ^= columns[8 * byte + bit]
    return out


def _apply(tables: np.ndarray, x: np.ndarray) -> np.ndarray:
    out = tables[0][x & np.uint32(255)]
    for byte in range(1, 4):
        out = out ^ tables[byte][(x >> np.uint32(8 * byte)) & np.uint32(255)]
    return out


@lru_cache(maxsize=1)
def _shifts() -> list[np.ndarray]:
    """Maps that move a CRC on by 1, 2, 4, ... bytes."""
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    # crc(x + b"\\0") is linear in crc(x) but for a constant, which cancels between two of them.
    zero = zlib.crc32(b"\0", 0)
    one = np.array([zlib.crc32(b"\0", int(b)) ^ zero for b in bits], np.uint32)
    out = [_tables(one)]
    for _ in range(31):
        out.append(_tables(_apply(out[-1], _apply(out[-1], bits))))
    return out


def compose(left: np.ndarray, right: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of texts put together, from both parts' and the right one's length in bytes."""
    out = left.copy()
    for power, tables in enumerate(_shifts()[: int(length.max(initial=0)).bit_length()]):
        on = (length >> power & 1) > 0
        out[on] = _apply(tables, out[on])
    return out ^ right


class Dictionary:
    """Words with their payloads, as an automaton over delimited text."""

    def __init__(self, size: int = DICTIONARY):
        self.size, self.words = size, ahocorasick.Automaton()
        self.crc, self.length = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def learn(self, words: list[bytes]) -> None:
        base = len(self.crc)
        for i, word in enumerate(words):
            self.words.add_word(f" {word.decode('latin-1')} ", base + i)
        self.crc = np.concatenate([self.crc, np.array([zlib.crc32(w) for w in words], np.uint32)])
        self.length = np.concatenate([self.length, np.array([len(w) for w in words], np.int64)])
        self.words.make_automaton()

    def payloads(self, found: Words) -> tuple[np.ndarray, np.ndarray]:
        """CRC and length of all words of a block, in order."""
        n = len(found.start)
        crc, length, known = np.zeros(n, np.uint32), np.zeros(n, np.int64), np.zeros(n, bool)
        raw = found.text.tobytes()
        if len(self.crc):
            hits = [x for hit in self.words.iter(raw.decode("latin-1")) for x in hit]
            hits = np.array(hits, np.int64).reshape(-1, 2)
            word = np.searchsorted(found.end, hits[:, 0])  # a hit ends at the delimiter after its word
            crc[word], length[word], known[word] = self.crc[hits[:, 1]], self.length[hits[:, 1]], True
        rest = np.flatnonzero(~known)
        missed = [raw[a:b] for a, b in zip(found.start[rest].tolist(), found.end[rest].tolist(), strict=True)]
        crc[rest] = np.fromiter(map(zlib.crc32, missed), np.uint32, len(missed))
        length[rest] = found.end[rest] - found.start[rest]
        room = self.size - len(self.crc)
        if room > 0 and missed:
            often = [w for w, times in Counter(missed).most_common(room) if times > 1]
            if often and (len(often) * 4 >= len(self.crc) or len(often) == room):  # an automaton is made anew each time
                self.learn(often)
        return crc, length

    def buckets(self, data: np.ndarray, bounds: np.ndarray, longest: int, n_buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words and features of each text of a block, and the features' buckets, text by text."""
        found = Words(data, bounds, _DELIMITER)
        crc, length = self.payloads(found)
        n_words = np.diff(found.of)
        last = np.repeat(found.of[1:], n_words)  # where each word's text ends
        text = np.repeat(np.arange(len(n_words)), n_words)
        run, at = crc, np.arange(len(crc))
        all_runs, all_texts = [crc], [text]
        spaced = compose(np.full(len(crc), _SPACE, np.uint32), crc, length) if longest > 1 else crc
        for k in range(1, longest):
            keep = at + k < last[at]
            at = at[keep]
            run = compose(run[keep], spaced[at + k], length[at + k] + 1)
            all_runs.append(run)
            all_texts.append(text[at])
        owner = np.concatenate(all_texts)
        order = np.argsort(owner, kind="stable") if longest > 1 else slice(None)
        found_in = (np.concatenate(all_runs)[order] % np.uint32(n_buckets)).astype(np.int32)
        return n_words, np.bincount(owner, minlength=len(n_words)), found_in


@lru_cache(maxsize=2)
def dictionary(size: int) -> Dictionary:
    """The worker's dictionary: one per Python process."""
    return Dictionary(size)


def features(docs: DataFrame, longest: int = LONGEST, n_buckets: int = BUCKETS, size: int = DICTIONARY) -> DataFrame:
    """doc_id, n_words, buckets of every document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, bounds in blocks(batch.column(1)):
                n_words, n, found = dictionary(size).buckets(data, bounds, longest, n_buckets)
                at = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
                rows = [batch.column(0).slice(low, high - low), pa.array(n_words.astype(np.int64)), pa.ListArray.from_arrays(at, pa.array(found))]
                yield pa.RecordBatch.from_arrays(rows, ["doc_id", "n_words", "buckets"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(work, "doc_id long, n_words long, buckets array<int>")


def counted(featured: DataFrame) -> DataFrame:
    """bucket, n: how many features fall into it."""
    return featured.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, n_buckets: int = BUCKETS) -> np.ndarray:
    """Gain of each bucket, from ``counted`` features: as many rows as buckets reach the driver, at most."""
    s, t = ({r["bucket"]: r["n"] for r in counts.collect()} for counts in (corpus, target))
    all_s, all_t = sum(s.values()), sum(t.values())
    share = lambda b: (t.get(b, 0) + 1.0) * (all_s + n_buckets) / ((s.get(b, 0) + 1.0) * (all_t + n_buckets))
    return np.array([math.floor(1000 * math.log(share(b))) for b in range(n_buckets)], np.int64)


def noise(doc_id: int | None, seed: str = SEED) -> float:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(featured: DataFrame, gained: np.ndarray, seed: str = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of documents with their buckets."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            n = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            total = np.concatenate([[0], np.cumsum(gained[column.flatten().to_numpy()])])
            upto = np.cumsum(n)
            weight = np.where(n > 0, (total[upto] - total[upto - n]) // np.maximum(n, 1), 0)
            score = weight + np.array([noise(x, seed) for x in batch.column(0).to_pylist()], np.int64)
            columns = [batch.column(0), batch.column(1), pa.array(n), pa.array(weight), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight", "score"])

    return featured.select("doc_id", "n_words", "buckets").mapInArrow(work, "doc_id long, n_words long, n_features long, weight long, score long")


def drawn(rows: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``rows`` with their rank by score, smaller doc_id first; null where they are not drawn. Read several times."""
    spark, may = rows.sparkSession, F.col("n_words") >= min_words
    coarse = F.floor(F.col("score") / COARSE).cast("long").alias("coarse")
    # Gains and noise are logarithms: there are a few thousand coarse scores at most, however many documents.
    have = sorted(((r["coarse"], r["n"]) for r in rows.where(may).groupBy(coarse).agg(F.count("*").alias("n")).collect()), reverse=True)
    wanted, cut, above = sum(n for _, n in have) * percent // 100, None, 0
    for score, n in have:
        if above >= wanted:
            break
        cut, above = score, above + n
    never = F.lit(None).cast("long").alias("rank")
    if cut is None:
        return rows.select("*", never)
    first = may & (F.col("score") >= F.lit(cut * COARSE))
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features")]
    # The row number spreads rows that are alike over several parts.
    ranged = rows.where(first).withColumn("__spread", F.monotonically_increasing_id()).repartitionByRange(*order, F.asc("__spread"))
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = ranged.sortWithinPartitions(*order, "__spread").withColumns({"__part": F.spark_partition_id(), "__at": within})
    ranged = written(ranged.drop("__spread"), "ranked")
    base, before = 0, []
    for r in sorted(ranged.groupBy("__part").agg(F.count("*").alias("n")).collect()):
        before.append((r["__part"], base))
        base += r["n"]
    begins = spark.createDataFrame(before, "__part int, __before long")  # as many rows as parts
    rank = F.col("__before") + F.col("__at") + 1
    ranked = ranged.join(F.broadcast(begins), "__part").select(*rows.columns, F.when(rank <= wanted, rank).alias("rank"))
    return ranked.unionByName(rows.where(~first).select("*", never))


def resample(docs: DataFrame, target: DataFrame, *, longest: int = LONGEST, n_buckets: int = BUCKETS, percent: int = PERCENT,
             min_words: int = MIN_WORDS, seed: str = SEED, size: int = DICTIONARY) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document; ``target`` needs a text."""
    featured = written(features(docs, longest, n_buckets, size), "features")
    wanted = target.select(F.lit(None).cast("long").alias("doc_id"), "text")
    gained = gains(counted(featured), counted(features(wanted, longest, n_buckets, size)), n_buckets)
    rows = written(scored(featured, gained, seed), "scores")
    return drawn(rows, percent, min_words).select("doc_id", "n_features", "weight", "score", "rank")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


# CRC-32 by its table of 256 entries, worked out once for each distinct word.
SQL = rf"""
with recursive turns as (
  select i, cast(i as ubigint) as c, 0 as step from range(256) r(i)
  union all
  select i, case when c & 1 = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end, step + 1 from turns where step < 8
), crc_table as (select list(c order by i) as entries from turns where step = 8),
doc_words as (
  select row_number() over () as k, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents
), target_words as (
  select unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as word from benchmark
), used as (select k, word, count(*) as n from (select k, unnest(words) as word from doc_words) u group by k, word),
known as (select distinct word from (select word from used union all select word from target_words) w),
hashed as (
  select word, xor(list_reduce(list_prepend(4294967295::ubigint,
      list_transform(range(1, cast(length(hex(encode(word))) / 2 as bigint) + 1), lambda i: cast('0x' || substr(hex(encode(word)), cast(2 * i - 1 as integer), 2) as ubigint))),
      lambda c, b: xor(c >> 8, entries[cast((xor(c, b) & 255) as bigint) + 1])), 4294967295::ubigint) % {BUCKETS} as bucket
  from known, crc_table
), s as (select bucket, cast(sum(n) as bigint) as n from used join hashed using (word) group by bucket),
t as (select bucket, count(*) as n from target_words join hashed using (word) group by bucket),
totals as (select coalesce((select sum(n) from s), 0)::double as all_s, coalesce((select sum(n) from t), 0)::double as all_t),
gained as (
  select s.bucket, cast(floor(1000 * ln((coalesce(t.n, 0) + 1)::double * (all_s + {BUCKETS}) / ((s.n + 1)::double * (all_t + {BUCKETS})))) as bigint) as gain
  from s left join t using (bucket), totals
), weighed as (select k, sum(n * gain)::double / sum(n) as mean from used join hashed using (word) join gained using (bucket) group by k),
noisy as (
  select doc_id, len(words) as n_features, cast(coalesce(floor(mean), 0) as bigint) as weight,
    cast('0x' || substr(sha256('{SEED}:' || coalesce(cast(doc_id as varchar), '')), 1, 8) as bigint) as h
  from doc_words left join weighed using (k)
), scores as (select doc_id, n_features, weight, weight + cast(floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double))) as bigint) as score from noisy),
ordered as (
  select *, row_number() over (partition by n_features >= {MIN_WORDS} order by score desc, doc_id nulls last, n_features) as place,
    count(*) over (partition by n_features >= {MIN_WORDS}) as eligible
  from scores
)
select doc_id, n_features, weight, score, case when n_features >= {MIN_WORDS} and place <= {PERCENT} * eligible // 100 then place end as rank from ordered
"""

QUERIES = {"op12_importance_resampling": (op12_importance_resampling, SQL)}
