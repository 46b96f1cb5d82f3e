import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from siltworks.llm import prefix_free as pf

SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("k", StringType())])


def brute(texts, length):
    """Removed bytes, spans and what is kept, for each text."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, x in enumerate(gone) if x and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((len(b), sum(gone), spans, kept))
    return out


def corpus(seed, length):
    rng = random.Random(seed)
    words = ["the", "of", "Straße", "日本", "x", "lorem", "ipsum", "dolor", "amet", "elit", "\n", "0", "aaaa"]
    text = lambda n: " ".join(rng.choice(words) + str(rng.randrange(400)) for _ in range(n))
    base = text(200)
    raw = [text(rng.randrange(150)) for _ in range(25)]
    for n in (length - 1, length, length + 1, 2 * length, 3 * length + 7):
        at = rng.randrange(100)
        passage = base[at : at + n]
        raw += [text(5) + passage + text(6), passage + text(3), text(4) + passage, passage[1:] + "!"]
    raw += [base, base, base[:-1] + "?", "ab" * length, "z" * (3 * length), "z" * (length - 1), "y" * length, "y" * length]
    words_of = base.split(" ")
    for _ in range(12):  # near copies
        edited = list(words_of)
        for _ in range(6):
            edited[rng.randrange(len(edited))] = rng.choice(words)
        raw.append(" ".join(edited))
    long = text(3000)
    return [*raw, long, long[500:9000] + text(20), "", None, None, text(40) * 2]


def frame(spark, texts, parts=4):
    rows = [(i if i % 17 else None, t, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts), rows


@pytest.mark.parametrize(("seed", "length"), [(1, 200), (2, 200), (3, 64), (4, 33)])
def test_digest_equals_brute_force(spark, seed, length):
    docs, rows = frame(spark, corpus(seed, length))
    want = Counter((r[0], n, gone, spans, hashlib.sha256(kept).hexdigest()) for r, (n, gone, spans, kept) in zip(rows, brute([r[1] for r in rows], length), strict=True))
    got = Counter(tuple(r) for r in pf.dedup_digest(docs, length).collect())
    assert got == want


def test_rows_wholly_alike_are_copies(spark):
    text = corpus(5, 200)[30] * 3
    docs = spark.createDataFrame([(7, text, ""), (7, text, ""), (7, "short", ""), (7, "short", "")], SCHEMA)
    got = Counter((r["n_bytes"], r["n_removed"], r["n_spans"]) for r in pf.dedup_digest(docs).collect())
    n = len(text.encode())
    assert got == Counter({(n, n, 1): 2, (5, 0, 0): 2})


def test_texts_lose_what_the_digest_says(spark):
    texts = corpus(6, 200)
    docs, rows = frame(spark, texts)
    got = Counter((r["doc_id"], r["text"], r["k"]) for r in pf.dedup_texts(docs).collect())
    want = Counter((r[0], r[1] if r[1] is None else kept.decode("utf-8", "ignore"), "x") for r, (*_, kept) in zip(rows, brute(texts, 200), strict=True))
    assert got == want


def test_no_documents(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert pf.dedup_digest(empty).count() == 0
    assert pf.dedup_texts(empty).columns == ["doc_id", "text", "k"]


def test_triggers_leave_two_in_each_string():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 100, 5000, dtype=np.uint8)
    bounds = np.array([0, 100, 100, 2000, 2199, 5000])
    parse = pf.Parse(data, bounds)
    for low, high in zip(bounds, bounds[1:], strict=False):
        for i in range(low, high - 200 + 1):
            assert ((parse.anchor >= i) & (parse.anchor <= i + 200 - pf.GRAM)).sum() >= 2


def test_spans_join_and_part():
    assert pf.spans(np.array([10, 0, 4, 40]), np.array([1, 1, 2, 3]), 5) == [(0, 15), (40, 47)]
