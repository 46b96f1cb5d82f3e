import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType
from tokenizers import Tokenizer

from siltworks.llm import elias_fano as ef
from siltworks.llm import harmonic_packing as hp
from siltworks.llm import length_histogram as lh
from siltworks.llm.tokens import Encoder, vocabulary

SMALL = "/root/testdata/sf0.001"
ODD = [
    "a  b", "a\n b", " x", "x ", "\n", "a \n  b", "<|endoftext|> hi", "a <|endoftext|> b", "a\0b c", "héé ça\tb c",
    "x　y z's don't", " ", "", None, "a᠎ b", "a  \n\nb", "\n\nx", "a\n", "\ta b\t", "q  r s", "a" * 3000 + " b",
    "é \n é", "日本 語", "same same same", "x\x1cy \x1c z",
]
SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("rank", LongType())])


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary())


def ids_of(library, text, end=True):
    return library.encode(text or "", add_special_tokens=False).ids + [0] * end


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_encoder_equals_the_library(library):
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choice(["a", " ", " ", "\n", "é", "1", "'s", "\t", "word", ".", "　"]) for _ in range(rng.randrange(40))) for _ in range(3000)]
    ids, n = Encoder(vocabulary()).encode(pa.array(texts))
    at = np.concatenate([[0], np.cumsum(n)])
    for k, text in enumerate(texts):
        assert ids[at[k] : at[k + 1]].tolist() == ids_of(library, text, end=False), repr(text)


def test_encoder_forgets_and_takes_long_texts(library, monkeypatch):
    monkeypatch.setattr("siltworks.llm.tokens.REMEMBERED", 3)
    monkeypatch.setattr("siltworks.llm.tokens.AT_ONCE", 64)
    texts = ["one two three four", "x y " * 100, "five six seven"] * 3
    ids, n = Encoder(vocabulary()).encode(pa.array(texts))
    assert ids.tolist() == [i for t in texts for i in ids_of(library, t, end=False)]
    assert n.sum() == len(ids)


def odd_documents(spark):
    rows = [(i if t is not None else None, t, -1) for i, t in enumerate(ODD)] + [(3, "a repeated id", 0), (3, "a repeated id", 0)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def sample(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.mark.parametrize("source", [odd_documents, sample])
def test_packing_against_its_contract(spark, library, source):
    docs = source(spark)
    rows = [r.asDict() for r in hp.pack_documents(spark, docs, keep_ids=True).collect()]
    want = {}
    for r in docs.select("doc_id", "text").collect():
        want.setdefault(r["doc_id"], []).append(ids_of(library, r["text"]))
    got = {}
    for r in rows:
        assert len(r["ids"]) == r["length"] and r["ids_crc32"] == crc(r["ids"])
        got.setdefault(r["doc_id"], []).append((r["start"], r["ids"], r["doc_tokens"]))
    assert got.keys() == want.keys()
    for key, texts in want.items():
        if len(texts) == 1:
            at = 0
            for start, ids, total in sorted(got[key]):
                assert start == at and ids == texts[0][at : at + len(ids)] and total == len(texts[0])
                at += len(ids)
            assert at == len(texts[0])
        else:
            assert sum(len(x[1]) for x in got[key]) == sum(map(len, texts))
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    n_ids = sum(r["length"] for r in rows)
    assert n_ids >= 0.97 * 1024 * (len(sequences) - 1)


def test_packed_sequences_hold_the_ids(spark, library):
    docs = sample(spark)
    out = hp.assemble(hp.pack_documents(spark, docs, keep_ids=True)).collect()
    assert all(len(r["ids"]) == 1024 for r in out)
    everything = sorted(i for r in out for i in r["ids"][: r["n_ids"]])
    assert everything == sorted(i for r in docs.collect() for i in ids_of(library, r["text"]))


def test_cutting_and_first_fit():
    lengths = set(hp.class_lengths(1024))
    assert len(lengths) == 63
    n = np.arange(1, 5000)
    doc, start, size = hp.cut(n, 1024)
    assert set(size.tolist()) <= lengths
    assert np.array_equal(np.bincount(doc, size), n)
    assert np.bincount(doc).max() <= 5 + 4
    last = hp.combine_last({600: 600, 500: 500, 400: 400, 24: 24}, 1024)
    assert len({x for x, _ in last.values()}) == 2


def test_packing_and_histogram_of_nothing(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert hp.pack_documents(spark, docs).count() == 0
    assert lh.suffix_sums(lh.length_histogram(docs)).count() == 0
    folder = ef.write_token_files(spark, docs)
    assert ef.read_token_files(spark, folder).count() == 0


def test_histogram_and_suffix_sums(spark, library):
    docs = odd_documents(spark).unionByName(sample(spark).select("doc_id", "text", F.lit(0).cast("long").alias("rank")))
    lengths = [len(ids_of(library, r["text"], end=False)) for r in docs.collect()]
    histogram = lh.length_histogram(docs).cache()
    rows = lh.suffix_sums(histogram, block=16).collect()
    assert {r["n_tokens"] for r in rows} == set(lengths)
    for r in rows:
        n = r["n_tokens"]
        assert r["n_docs"] == lengths.count(n)
        assert r["docs_from"] == sum(x >= n for x in lengths)
        assert r["tokens_from"] == sum(x for x in lengths if x >= n)
        assert r["truncated_tokens"] == sum(min(x, n) for x in lengths)
        assert r["quantile"] == sum(x <= n for x in lengths) / len(lengths)
    for r in lh.at_limits(histogram, [0, 7, 100, 10**6]).collect():
        assert r["docs_within"] == sum(x <= r["n_limit"] for x in lengths)
        assert r["truncated_tokens"] == sum(min(x, r["n_limit"]) for x in lengths)
    middle = lh.length_quantiles(lh.suffix_sums(histogram), [0.5]).first()["n_tokens"]
    assert middle == sorted(lengths)[(len(lengths) + 1) // 2 - 1]
    histogram.unpersist()


def test_histogram_by_group(spark, library):
    docs = sample(spark).withColumn("lang", F.when(F.col("doc_id") % 5 > 0, F.col("lang")))
    rows = lh.suffix_sums(lh.length_histogram(docs, by=["lang"]), by=["lang"]).collect()
    texts = docs.collect()
    for lang in {r["lang"] for r in texts}:
        lengths = [len(ids_of(library, r["text"], end=False)) for r in texts if r["lang"] == lang]
        mine = [r for r in rows if r["lang"] == lang]
        assert sum(r["n_docs"] for r in mine) == len(lengths) == mine[0]["total_docs"]
        assert all(r["truncated_tokens"] == sum(min(x, r["n_tokens"]) for x in lengths) for r in mine)


def test_rising_sequences():
    rng = np.random.default_rng(3)
    for n, top in ((0, 1), (1, 1), (1, 2**63), (5, 3), (1000, 10), (1000, 2**62), (3000, 5000), (2000, 2**40)):
        values = np.sort(rng.integers(0, top, n, dtype=np.uint64))
        raw = ef.encode_rising(values)
        read = ef.Rising(raw, 0)
        assert np.array_equal(read.all(), values) and read.end == len(raw)
        for i in rng.integers(0, n, min(n, 60)) if n else ():
            assert read[int(i)] == values[i]
        if n >= 1000:
            assert len(raw) * 8 <= n * (3 + np.log2(max(1, int(values[-1]) / n))) + 8 * ef._SEQUENCE.size + 16


def test_file_finds_single_documents():
    ids = np.arange(5000, dtype=np.uint32) % 700
    bounds = np.sort(np.random.default_rng(1).integers(0, 5000, 900))
    bounds = np.concatenate([[0], bounds, [5000]])
    names = [None, None, *(-(2**62) + 3 * i for i in range(899))]
    file = ef.TokenFile(ef.encode_file(names, bounds, ids, 2))
    assert file.doc_ids().to_pylist() == names and np.array_equal(file.bounds(), bounds)
    for i in (0, 1, 2, 450, 900):
        assert file.doc_id(i) == names[i]
        assert np.array_equal(file.document(i), ids[bounds[i] : bounds[i + 1]])


@pytest.mark.parametrize("file_ids", [50, 1 << 22])
@pytest.mark.parametrize("source", [odd_documents, sample])
def test_token_files_round_trip(spark, library, source, file_ids):
    docs = source(spark)
    folder = ef.write_token_files(spark, docs, file_ids=file_ids)
    rows = sorted(ef.read_token_files(spark, folder).collect(), key=lambda r: r["start"])
    at = 0
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
    keys = [r["doc_id"] for r in rows]
    assert keys == sorted(keys, key=lambda x: (x is not None, x))
    want = sorted((r["doc_id"] is not None, r["doc_id"], len(i := ids_of(library, r["text"])), crc(i)) for r in docs.collect())
    got = sorted((r["doc_id"] is not None, r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows)
    assert got == want


def test_histogram_by_columns_with_names_of_its_own(spark):
    rows = [(1, "one two three", "x", None, 5), (2, "one", "x", "b", 5), (3, None, "y", "b", 7), (4, "one two three", "x", None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, n_docs string, quantile int")
    by = ["n_tokens", "n_docs", "quantile"]
    found = lh.suffix_sums(lh.length_histogram(docs, by=by).cache(), by)
    assert found.columns[:5] == ["by_n_tokens", "by_n_docs", "by_quantile", "n_tokens", "n_docs"]
    got = {(r["by_n_tokens"], r["by_n_docs"], r["by_quantile"], r["n_tokens"]): (r["n_docs"], r["docs_from"], r["total_docs"]) for r in found.collect()}
    assert got == {("x", None, "5", 3): (2, 2, 2), ("x", "b", "5", 1): (1, 1, 1), ("y", "b", "7", 0): (1, 1, 1)}
