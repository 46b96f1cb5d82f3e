"""Removal of repeated byte strings by prefix-free parsing.

Every byte goes that a 200-byte string covers which also starts anywhere else. Prefix-free
parsing finds these strings without a row per byte of the corpus:

* Parse. A rolling hash of 8 bytes triggers where it is the least of its neighbourhood of 96.
  A phrase reaches from a trigger to the end of the next one, so triggers depend on nearby
  text alone and any 200-byte string holds two of them at least, the same ones wherever it stands.
* Dictionary. Phrases are counted over the corpus. A string that holds a phrase met once is
  met once itself; most text ends here.
* Parse and dictionary combined. What is left is cut into runs of neighbouring starts whose
  strings hold the same phrases. Suffixes are compared to a depth of 200 bytes, and equality is
  all that is asked, so ranks of the two suffix arrays become classes of equal content: a run
  whose whole surrounding text (its cover) occurs again is repeated as a whole; where one
  sequence of phrases has several covers, one copy of each is opened, and its 200-byte strings
  are classed one by one. This takes hash aggregation, which spreads evenly, where a global
  sort of suffixes would put all copies of a passage into one range.

Classes of phrases are a filter (a shared fingerprint costs time only); those of covers and strings
are decided by 64-bit fingerprints.

Whole copies are settled first by their text's hash; one of them stands for all in the parse.
Each step is a written table, so nothing is computed twice and a lost executor costs its tasks.

Defined cases: a null or empty text has no bytes; several rows with one doc_id, or wholly alike,
are documents of their own; a null doc_id is carried along; an empty table gives no rows; further
columns are not read. Texts are UTF-8 bytes, and what is left need not be valid UTF-8.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.llm.shared import documents, whole_row, written
from siltworks.llm.tokens import bytes_of, powers

LENGTH = 200
GRAM = 8
#: Bytes of text parsed at once; a longer document is parsed alone.
AT_ONCE = 1 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
_KEY = np.uint64(0xFFFFFFFF00000000)


def near(length: int) -> int:
    """Neighbourhood in which a trigger is the least: two of them fit into a string."""
    return (length - GRAM + 1) // 2


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours."""
    out, reach = values, 1
    while reach * 2 <= width:
        out = np.minimum(out[: len(out) - reach], out[reach:])
        reach *= 2
    return np.minimum(out[: len(out) - (width - reach)], out[width - reach :]) if reach < width else out


@lru_cache(maxsize=2)
def _powers(base: int, n: int) -> np.ndarray:
    return powers(np.uint64(base), n)


class Prints:
    """Fingerprints of any substrings of a buffer."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        size = max(AT_ONCE, n) + 1
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(data * _powers(int(_BASE), size)[:n], out=self.total[1:])
        self.back = _powers(int(_BACK), size)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = (self.total[end] - self.total[start]) * self.back[start]
        out ^= (end - start).astype(np.uint64) * _MIX
        out *= _MIX
        return (out ^ (out >> np.uint64(32))).view(np.int64)


class Parse:
    """Triggers of adjacent texts. A window is a start of ``near`` neighbouring grams of one text."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, length: int = LENGTH):
        self.length, self.near = length, near(length)
        n, begin, end = len(data), bounds[:-1], bounds[1:]
        eight = np.ndarray(n + 1, "<u8", np.concatenate([data, np.zeros(GRAM, np.uint8)]), strides=(1,))
        mixed = eight[:n] * _MIX
        mixed ^= mixed >> np.uint64(29)
        mixed *= _BASE
        # Hash above, place below: the least is the first place of the least hash.
        keyed = (mixed & _KEY) | np.arange(n, dtype=np.uint64)
        least = sliding_least(keyed, self.near) if n >= self.near else keyed[:0]
        self.ends = end
        self.n_windows = np.where(end - begin >= length, end - begin - (self.near + GRAM - 2), 0)
        inside = np.zeros(n + 1, np.int8)
        inside[begin[self.n_windows > 0]] = 1
        inside[(begin + self.n_windows)[self.n_windows > 0]] -= 1
        self.place = np.flatnonzero(np.cumsum(inside[:n], dtype=np.int8))
        chosen = (least[self.place] & ~_KEY).astype(np.int64)
        change = np.ones(len(chosen), bool)
        change[1:] = chosen[1:] != chosen[:-1]  # a trigger lies in one text, so texts differ too
        self.which = np.cumsum(change, dtype=np.int32) - np.int32(1)
        self.anchor = chosen[change]
        self.doc = np.searchsorted(bounds, self.anchor, "right") - 1

    def phrases(self) -> np.ndarray:
        """Anchors at which a phrase begins."""
        return np.flatnonzero(self.doc[1:] == self.doc[:-1])

    def runs(self, repeated: np.ndarray):
        """Runs of starts whose strings hold the same phrases, all of them repeated.

        ``repeated`` says for each anchor whether the phrase from there is. Gives, for each run,
        text, first start, number of starts, first and last trigger of its strings.
        """
        far = self.length - GRAM + 1 - self.near
        # The last window of a string is a window too, if the string ends in the text.
        ok = np.zeros(len(self.place), bool)
        last = np.cumsum(self.n_windows)[self.n_windows > 0]
        ok[:] = True
        tail = self.n_windows[self.n_windows > 0] - far  # starts of whole strings
        for k in range(far):
            ok[last[tail >= 0] - 1 - k] = False
        at = np.flatnonzero(ok)
        first, final = self.which[at], self.which[at + far]
        bad = np.concatenate([[0], np.cumsum(~repeated, dtype=np.int32)])
        may = bad[final] == bad[first]
        at, first, final = at[may], first[may], final[may]
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) != 1) | (first[1:] != first[:-1]) | (final[1:] != final[:-1])
        head = np.flatnonzero(new)
        n = np.diff(np.append(head, len(at)))
        return self.doc[first[head]], self.place[at[head]], n, self.anchor[first[head]], self.anchor[final[head]]


def _blocks(column) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows low to high of a string column with their bytes and bounds."""
    data, bounds = bytes_of(column)
    at = 0
    while at < len(bounds) - 1:
        upto = max(at + 1, int(np.searchsorted(bounds, bounds[at] + AT_ONCE, "right")) - 1)
        yield at, upto, data[bounds[at] : bounds[upto]], bounds[at : upto + 1] - bounds[at]
        at = upto


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of a list column and the bounds of its rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return column.flatten(), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def find_phrases(texts: DataFrame, length: int) -> DataFrame:
    """phrase, k, x: fingerprint, text, and number of the trigger in its text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for low, high, data, bounds in _blocks(batch.column(1)):
                parse = Parse(data, bounds, length)
                at = parse.phrases()
                phrase = Prints(data).of(parse.anchor[at], parse.anchor[at + 1] + GRAM)
                x = at - np.searchsorted(parse.doc, np.arange(high - low))[parse.doc[at]]
                out = [pa.array(phrase), pa.array(keys[low:high][parse.doc[at]]), pa.array(x.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(out, ["phrase", "k", "x"])

    return texts.select("k", "text").mapInArrow(work, "phrase long, k long, x int")


def find_runs(texts: DataFrame, repeated: DataFrame, length: int) -> DataFrame:
    """inner, cover, k, at, n, settled: a row per run of starts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, settled = batch.column(0).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False)
            numbers, of = _lists(batch.column(3))
            numbers = numbers.to_numpy()
            for low, high, data, bounds in _blocks(batch.column(1)):
                parse = Parse(data, bounds, length)
                first = np.searchsorted(parse.doc, np.arange(high - low))
                flag = np.zeros(len(parse.anchor), bool)
                flag[numbers[of[low] : of[high]] + np.repeat(first, np.diff(of[low : high + 1]))] = True
                doc, at, n, left, right = parse.runs(flag)
                prints = Prints(data)
                out = [
                    pa.array(prints.of(left, right + GRAM)), pa.array(prints.of(at, at + n - 1 + length)),
                    pa.array(keys[low:high][doc]), pa.array((at - bounds[doc]).astype(np.int32)),
                    pa.array(n.astype(np.int32)), pa.array(settled[low:high][doc]),
                ]
                yield pa.RecordBatch.from_arrays(out, ["inner", "cover", "k", "at", "n", "settled"])

    rows = texts.join(repeated, "k").select("k", "text", "settled", "xs")
    return rows.mapInArrow(work, "inner long, cover long, k long, at int, n int, settled boolean")


def open_covers(texts: DataFrame, covers: DataFrame, length: int) -> DataFrame:
    """string, k, at: the strings of the runs in ``covers``; no k where nothing is to be decided."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            runs, of = _lists(batch.column(2))
            at, n, open_ = (runs.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            for low, high, data, bounds in _blocks(batch.column(1)):
                mine = slice(of[low], of[high])
                doc = np.repeat(np.arange(high - low), np.diff(of[low : high + 1]))
                size = n[mine].astype(np.int64)
                start = np.repeat(at[mine] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                doc, undecided = np.repeat(doc, size), np.repeat(open_[mine].astype(bool), size)
                place = start + bounds[doc]
                out = [
                    pa.array(Prints(data).of(place, place + length)),
                    pa.array(keys[low:high][doc], mask=~undecided), pa.array(start.astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(out, ["string", "k", "at"])

    found = covers.groupBy("k").agg(F.collect_list(F.struct("at", "n", "open")).alias("runs"))
    rows = texts.join(found, "k").select("k", "text", "runs")
    return rows.mapInArrow(work, "string long, k long, at int")


def spans(starts: np.ndarray, counts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes that strings with these starts (``counts`` adjacent ones each) cover."""
    order = np.argsort(starts, kind="stable")
    low, high = starts[order], (starts + counts - 1 + length)[order]
    reach = np.maximum.accumulate(high)
    new = np.ones(len(low), bool)
    new[1:] = low[1:] > reach[:-1]
    head = np.flatnonzero(new)
    return list(zip(low[head].tolist(), reach[np.append(head[1:], len(low)) - 1].tolist(), strict=True))


def per_text(texts: DataFrame, starts: DataFrame, length: int, make: Callable, schema: str) -> DataFrame:
    """``make(bytes, spans)`` for each text that has starts; gives a tuple of values for the schema's columns after k."""
    names = ["k", *(c.split()[0] for c in schema.split(", "))]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, of = _lists(batch.column(2))
            at, n = (found.field(i).to_numpy() for i in range(2))
            rows = []
            for i, text in enumerate(batch.column(1)):
                mine = slice(of[i], of[i + 1])
                rows.append(make(text.as_buffer().to_pybytes(), spans(at[mine].astype(np.int64), n[mine].astype(np.int64), length)))
            columns = [pa.array(x) for x in zip(*rows, strict=True)]
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    found = starts.groupBy("k").agg(F.collect_list(F.struct("at", "n")).alias("starts"))
    return texts.join(found, "k").select("k", "text", "starts").mapInArrow(work, f"k long, {schema}")


def repeated_starts(docs: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Where repeated strings start: (documents, texts, starts).

    ``documents`` has a narrow row per row of ``docs``: doc_id, k (joins the others), n_bytes,
    sha256, copied (its text occurs again, long enough to go as a whole). ``texts`` has the other
    texts that can hold such a string (and one of each copied text, marked ``settled``);
    ``starts`` has k, at, n: strings start at ``at`` and the next n - 1 bytes.
    """
    content = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), content.alias("text"),
        F.octet_length(content).cast("long").alias("n_bytes"), F.sha2(content, 256).alias("sha256"),
    ).withColumn("k", F.xxhash64("doc_id", "sha256"))
    narrow = written(keyed.drop("text"), "texts-narrow")
    # Rows wholly alike share k; they are copies of each other.
    same = narrow.where(F.col("n_bytes") >= length).groupBy("sha256").agg(F.count("*").alias("n"), F.min("k").alias("first_k"))
    copied = written(same.where("n > 1").select("sha256", "first_k"), "copied")
    marked = narrow.join(copied, "sha256", "left").withColumn("copied", F.col("first_k").isNotNull())
    marked = written(marked.select("doc_id", "k", "n_bytes", "sha256", "copied", (F.col("k") == F.col("first_k")).alias("first")), "texts-marked")
    chosen = marked.where((F.col("n_bytes") >= length) & (~F.col("copied") | F.col("first")))
    chosen = chosen.groupBy("k").agg(F.max("copied").alias("settled"))
    texts = keyed.select("k", "text").join(chosen, "k").select("k", "text", "settled")
    texts = written(texts, "texts")

    phrases = written(find_phrases(texts, length), "phrases")
    # Counts are tables of their own: beside a plain shuffle of them, Spark can split a hot phrase.
    often = written(phrases.groupBy("phrase").agg(F.count("*").alias("n")).where("n > 1").select("phrase"), "often")
    repeated = phrases.join(often, "phrase", "leftsemi").groupBy("k").agg(F.collect_set("x").alias("xs"))
    runs = written(find_runs(texts, repeated, length), "runs")

    covers = runs.groupBy("inner", "cover").agg(F.count("*").alias("copies"), F.min_by(F.struct("k", "at", "n", "settled"), F.struct("k", "at")).alias("one"))
    covers = written(covers, "covers")
    decided = covers.where("copies > 1").select("cover", "inner")
    whole = runs.where(~F.col("settled")).join(decided, ["cover", "inner"], "leftsemi").select("k", "at", "n")
    several = written(covers.groupBy("inner").agg(F.count("*").alias("n")).where("n > 1").select("inner"), "several")
    opened = covers.join(several, "inner", "leftsemi").select(
        "one.k", "one.at", "one.n", ((F.col("copies") == 1) & ~F.col("one.settled")).alias("open")
    )
    strings = written(open_covers(texts, opened, length), "strings")
    twice = written(strings.groupBy("string").agg(F.count("*").alias("n")).where("n > 1").select("string"), "twice")
    single = strings.where(F.col("k").isNotNull()).join(twice, "string", "leftsemi")
    starts = written(whole.unionByName(single.select("k", "at", F.lit(1).alias("n"))), "starts")
    return marked, texts, starts


def kept_bytes(text: bytes, found: list[tuple[int, int]]) -> bytes:
    at, out = 0, []
    for low, high in found:
        out.append(text[at:low])
        at = high
    return b"".join([*out, text[at:]])


def dedup_digest(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    marked, texts, starts = repeated_starts(docs, length)

    def make(text, found):
        return sum(b - a for a, b in found), len(found), hashlib.sha256(kept_bytes(text, found)).hexdigest()

    cut = per_text(texts, starts, length, make, "cut long, spans long, kept string")
    empty = hashlib.sha256(b"").hexdigest()
    rows = marked.join(cut, "k", "left")
    return rows.select(
        "doc_id", "n_bytes",
        F.when(F.col("copied"), F.col("n_bytes")).otherwise(F.coalesce("cut", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("copied"), 1).otherwise(F.coalesce("spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(F.col("copied"), F.lit(empty)).otherwise(F.coalesce("kept", "sha256")).alias("kept_sha256"),
    )


def dedup_texts(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents with repeated strings cut out of ``text``; all other columns stay.

    Bytes of a character of which only a part was covered are dropped from its ends. A document
    of which nothing stays keeps its row, with an empty text.
    """
    marked, texts, starts = repeated_starts(docs, length)

    def make(text, found):
        return (kept_bytes(text, found).decode("utf-8", "ignore"),)

    cut = per_text(texts, starts, length, make, "cut_text string")
    gone = marked.where("copied").select("k", F.lit("").alias("cut_text")).distinct()
    content = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(F.xxhash64(F.col("doc_id").cast("long"), F.sha2(content, 256)).alias("k"), whole_row(docs).alias("row"))
    rows = keyed.join(cut.unionByName(gone), "k", "left")
    text = F.coalesce("cut_text", F.col("row.text")).alias("text")
    return rows.select(*[text if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


def op10_prefix_free_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_digest(documents(spark, sf_dir))


QUERIES = {"op10_prefix_free_dedup": (op10_prefix_free_dedup, None)}
