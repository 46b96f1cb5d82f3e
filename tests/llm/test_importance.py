import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

import check_queries as cq
from siltworks.llm import importance as im

SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("rank", StringType()), StructField("bucket", StringType())])


def runs(text, longest):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return words, [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


def brute(rows, target, longest=1, n_buckets=10_000, percent=10, min_words=20):
    bucket = lambda f: zlib.crc32(f.encode()) % n_buckets
    s = Counter(bucket(f) for _, text, *_ in rows for f in runs(text, longest)[1])
    t = Counter(bucket(f) for text in target for f in runs(text, longest)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + n_buckets) / ((s[b] + 1) * (all_t + n_buckets)))) for b in s}
    out = []
    for doc_id, text, *_ in rows:
        words, found = runs(text, longest)
        weight = sum(gain[bucket(f)] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(found), weight, score, None, len(words)])
    may = [r for r in out if r[5] >= min_words]
    may.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for i, r in enumerate(may[: percent * len(may) // 100]):
        r[4] = i + 1
    return Counter(tuple(r[:5]) for r in out)


def corpus(n=400):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(300)] + ["Straße", "日本語", "it's", "A-B", "x_y", "\x7f", "\x00z", "É", "42", "y" * 200]
    texts = [None, "", " \n", "--", "one", "ONE", "a" * 4000]
    texts += ["".join(rng.choice(words) + rng.choice([" ", "  ", "\n", ", ", "/"]) for _ in range(rng.randrange(80))) for _ in range(n)]
    rows = [(i if i % 40 else None, t, "clash", "x") for i, t in enumerate(texts)]
    return [*rows, rows[-1], rows[-1], rows[20]], ["".join(rng.choice(words[:40]) + " " for _ in range(30)) for _ in range(20)] + [None]


def frames(spark, rows, target):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return docs, spark.createDataFrame([(t,) for t in target], "text string")


def found(df):
    return Counter(tuple(r) for r in df.collect())


def test_equals_the_definition(spark):
    rows, target = corpus()
    got = im.resample(*frames(spark, rows, target))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert found(got) == brute(rows, target)


@pytest.mark.parametrize("longest,n_buckets,percent,size", [(2, 500, 100, 50), (3, 97, 33, 1), (4, 10_000, 1, 20_000)])
def test_longer_runs_and_other_sizes(spark, longest, n_buckets, percent, size):
    rows, target = corpus(150)
    got = im.resample(*frames(spark, rows, target), longest=longest, n_buckets=n_buckets, percent=percent, size=size)
    assert found(got) == brute(rows, target, longest, n_buckets, percent)


def test_composition_of_crcs():
    rng = random.Random(1)
    texts = [(bytes(rng.randrange(256) for _ in range(rng.randrange(50))), bytes(rng.randrange(256) for _ in range(rng.choice([0, 1, 3, 64, 70_000])))) for _ in range(60)]
    crc = lambda xs: np.array([zlib.crc32(x) for x in xs], np.uint32)
    got = im.compose(crc([a for a, _ in texts]), crc([b for _, b in texts]), np.array([len(b) for _, b in texts]))
    assert got.tolist() == crc([a + b for a, b in texts]).tolist()


def test_dictionary_learns_and_agrees():
    from siltworks.llm.words import Words

    known = im.Dictionary(30)
    for seed in range(4):
        rng = random.Random(seed)
        text = " ".join(rng.choice(["ab", "abc", "b", "bc", "é", "a" * 90, f"r{rng.randrange(10**6)}"]) for _ in range(300)).encode()
        words = Words(np.frombuffer(text, np.uint8), np.array([0, 5, 5, len(text)]), im._DELIMITER)
        crc, length = known.payloads(words)
        raw = words.text.tobytes()
        want = [raw[a:b] for a, b in zip(words.start, words.end, strict=True)]
        assert crc.tolist() == [zlib.crc32(w) for w in want] and length.tolist() == [*map(len, want)]
    assert 0 < len(known.crc) <= 30


def test_many_alike(spark):
    """A third of all rows with one id and text: ranks go on without gaps."""
    rows = [(7, "word " * 30, "c", "x")] * 300 + [(i, f"word{i} " * 25, "c", "x") for i in range(600)]
    docs, target = frames(spark, rows, ["word"])
    got = im.resample(docs, target, percent=50)
    assert sorted(r["rank"] for r in got.where("rank is not null").collect()) == list(range(1, 451))
    assert found(got) == brute(rows, ["word"], percent=50)


def test_empty_tables(spark):
    rows, target = corpus(30)
    docs, wanted = frames(spark, rows, target)
    assert im.resample(docs.where("false"), wanted).count() == 0
    assert found(im.resample(docs, wanted.where("false"))) == brute(rows, [])


def test_query_equals_its_check(spark):
    small = "/root/testdata/sf0.001"
    assert cq.compare(spark, cq.connect(small), "op12_importance_resampling", small) is None
