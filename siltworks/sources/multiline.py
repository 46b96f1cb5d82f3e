"""Delimited text with line breaks inside quotes, read in splits like any other text.

Whether a line begins inside a quoted field depends on all lines before it, so a reader that allows line breaks
in quotes takes each file whole. Here files are read in splits, twice. The first pass works out what each split does
to either state it can begin in, outside or inside a quoted field. These are composed along each file, which gives the
state every split begins in. The second pass then cuts each split into records; a record that goes on
past a split's end is put together from its pieces. Number and size of tasks follow the bytes, not the files.

Quotes count as the parser counts them: only at a field's start does one open a quoted field, ``\\"`` is part of it, and
a quote that is followed by neither a separator nor the line's end makes the field end at the next of these.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.sources.delimited import CORRUPT, SEPARATOR, _local_path

OUTSIDE, INSIDE = 0, 1
WHOLE, HEAD, TAIL, MIDDLE = 0, 1, 2, 3
FILE = "__file"

_QUOTED = re.compile(r'(?:[^"\\]|\\["\\]|\\(?!["\\]))*')
_BLANK = re.compile(r"[\x00-\x20]*")


def state_after(line: str, state: int, separator: str = SEPARATOR) -> int:
    """Whether a line that begins outside (at a field's start) or inside a quoted field ends inside one."""
    if '"' not in line:
        return state
    at, end = 0, len(line)
    while True:
        if state == OUTSIDE:
            if not line.startswith('"', at):
                at = line.find(separator, at)
                if at < 0:
                    return OUTSIDE
                at += len(separator)
                continue
            at += 1
        at = _QUOTED.match(line, at).end()
        if at >= end:
            return INSIDE
        state, after = OUTSIDE, _BLANK.match(line, at + 1).end()
        if after >= end:
            return OUTSIDE
        if not line.startswith(separator, after):
            after = line.find(separator, at)
            if after < 0:
                return OUTSIDE
        at = after + len(separator)


def _lines(spark: SparkSession, paths: list[str], pattern: str) -> DataFrame:
    """file, block, value: lines of splits. The rows of a split are adjacent and in order."""
    text = spark.read.option("lineSep", "\n").option("pathGlobFilter", pattern).text(paths)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.Array]]:
    """The adjacent lines of each split in a batch."""
    files, blocks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
    low = 0
    for i in range(1, batch.num_rows + 1):
        if i == batch.num_rows or (files[i], blocks[i]) != (files[low], blocks[low]):
            yield files[low], blocks[low], batch.column(2).slice(low, i - low)
            low = i


def split_states(lines: DataFrame, separator: str = SEPARATOR) -> DataFrame:
    """file, block, begins: the state each split begins in."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple[str, int] | None = None
        ends = [OUTSIDE, INSIDE]
        for batch in batches:
            for file, block, values in _runs(batch):
                if now is not None and now != (file, block):
                    yield row(now, ends)
                    ends = [OUTSIDE, INSIDE]
                now = (file, block)
                # Only lines with a quote change anything.
                for line in values.filter(pc.match_substring(values, '"')).to_pylist():
                    ends = [state_after(line, s, separator) for s in ends] if ends[0] != ends[1] else [state_after(line, ends[0], separator)] * 2
        if now is not None:
            yield row(now, ends)

    def row(split: tuple[str, int], ends: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"file": [split[0]], "block": pa.array([split[1]], pa.int64()), "outside": pa.array([ends[0]], pa.int32()), "inside": pa.array([ends[1]], pa.int32())})

    found = lines.mapInArrow(work, "file string, block long, outside int, inside int")
    # One entry per split of a file. The states are composed in file order.
    ordered = found.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("block", "outside", "inside"))).alias("splits"))

    def add(known, split):
        state = known["state"]
        entry = F.struct(split["block"].alias("block"), state.alias("begins"))
        return F.struct(F.when(state == INSIDE, split["inside"]).otherwise(split["outside"]).alias("state"), F.array_append(known["splits"], entry).alias("splits"))

    none = F.array().cast("array<struct<block: bigint, begins: int>>")
    states = F.aggregate("splits", F.struct(F.lit(OUTSIDE).alias("state"), none.alias("splits")), add)["splits"]
    return ordered.select("file", F.inline(states))


def cut_records(lines: DataFrame, inside: set[tuple[str, int]], separator: str = SEPARATOR) -> DataFrame:
    """file, block, kind, value: records, and the pieces of those that go on past a split's end. Headers are left out."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple[str, int] | None = None
        pieces: list[str] = []
        state, first, skip = OUTSIDE, WHOLE, False

        def rows(split, kinds, values):
            n = len(values)
            columns = [pa.array([split[0]] * n, pa.string()), pa.array([split[1]] * n, pa.int64()), pa.array(kinds, pa.int32()), pa.array(values, pa.string())]
            return pa.RecordBatch.from_arrays(columns, ["file", "block", "kind", "value"])

        def ended():
            """What the split that just ended leaves over."""
            if pieces:
                yield rows(now, [MIDDLE if first == TAIL else HEAD], ["\n".join(pieces)])

        for batch in batches:
            for file, block, values in _runs(batch):
                if now != (file, block):
                    yield from ended()
                    now, pieces, skip = (file, block), [], block == 0
                    state = INSIDE if now in inside else OUTSIDE
                    first = TAIL if state == INSIDE else WHOLE
                kinds, out = [], []
                quoted = pc.match_substring(values, '"').to_pylist()
                for line, marked in zip(values.to_pylist(), quoted, strict=True):
                    pieces.append(line)
                    if marked:
                        state = state_after(line, state, separator)
                    if state == INSIDE:
                        continue
                    if skip:  # a file's header
                        skip = False
                    else:
                        kinds.append(first)
                        out.append("\n".join(pieces).removesuffix("\r"))
                    pieces, first = [], WHOLE
                if out:
                    yield rows(now, kinds, out)
        yield from ended()

    return lines.mapInArrow(work, "file string, block long, kind int, value string")


def join_pieces(pieces: DataFrame) -> DataFrame:
    """file, value: records from their pieces. A file has two pieces for each of its splits, at most."""
    order = ["block", F.when(F.col("kind") == HEAD, 1).otherwise(0)]
    begun = Window.partitionBy("file").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = pieces.withColumn("record", F.count_if(F.col("kind") == HEAD).over(begun))
    parts = F.array_sort(F.collect_list(F.struct("block", order[1].alias("late"), "value")))
    whole = F.array_join(F.transform(parts, lambda p: p["value"]), "\n")
    return numbered.groupBy("file", "record").agg(whole.alias("value")).select("file", F.regexp_replace("value", r"\r$", "").alias("value"))


def scan_multiline(spark: SparkSession, path: str | list[str], schema: T.StructType, *, keep_corrupt: bool = False, pattern: str = "*.[tT][xX][tT]") -> DataFrame:
    """``scan_delimited(multi_line=True)`` with splits: the schema's columns, and ``__file``, the file's path.

    The splits that begin inside a quoted field are collected, a name and an offset each.
    """
    paths = [_local_path(p) for p in ([path] if isinstance(path, str) else path)]
    lines = _lines(spark, paths, pattern)
    inside = {(r["file"], r["block"]) for r in split_states(lines).where(F.col("begins") == INSIDE).collect()}
    cut = cut_records(lines, inside)
    records = cut.where(F.col("kind") == WHOLE).select("file", "value")
    if inside:
        records = records.unionByName(join_pieces(cut.where(F.col("kind") != WHOLE)))
    fields = [*schema.fields, T.StructField(CORRUPT, T.StringType())] if keep_corrupt else schema.fields
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    options = {"sep": SEPARATOR, "mode": "PERMISSIVE", "maxCharsPerColumn": "-1", "multiLine": "true", "columnNameOfCorruptRecord": CORRUPT}
    # With a line's end (U+FFFF for this parser, so that line breaks are text): it reads a quote that is the very last character twice.
    line = F.concat("value", F.lit("\uffff"))
    parsed = records.where("value <> ''").select(F.from_csv(line, columns, options).alias("r"), F.col("file").alias(FILE))
    return parsed.select(*[F.col(f"r.`{f.name}`") for f in fields], FILE)
