import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql.types import LongType, StringType, StructField, StructType

from siltworks.llm import simhash as sh

SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("fp", StringType()), StructField("fps", StringType())])


def fingerprint(text, words=4, seed=42):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not found:
        return 0
    grams = [found[i : i + words] for i in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(" ".join(g).encode(), seed) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(rows, differ=4):
    """Component of each row by comparing all pairs."""
    prints = np.array([fingerprint(t) for _, t, *_ in rows], np.uint64)
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(prints[:i] ^ prints[i]) <= differ).tolist():
            label[find(i)] = find(j)
    least = {}
    for i, (doc_id, *_) in enumerate(rows):
        known = least.get(find(i))
        least[find(i)] = doc_id if known is None else known if doc_id is None else min(known, doc_id)
    return [(r[0], f"{int(p):016x}", least[find(i)]) for i, (r, p) in enumerate(zip(rows, prints, strict=True))]


def corpus(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Straße", "日本語", "ÀÉ", "\x85", "\xa0", "x" * 300]
    texts = [None, "", " \t\n\x0b\x0c\r", "one", "Two words", "a B c", "a b C d", "A b c d", "x" * 5000, "same same same same same same"]
    base = [[rng.choice(vocabulary) for _ in range(rng.randrange(1, 260))] for _ in range(60)]
    for words in base:
        for _ in range(rng.randrange(1, 6)):
            own = list(words)
            for _ in range(rng.randrange(3)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            texts.append("".join(w + rng.choice([" ", "  ", "\n", "\t"]) for w in own))
    texts += [" ".join(base[0])] * 40  # copies
    rows = [(i if i % 13 else None, t, "clash", "x") for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return [*rows, rows[0], rows[0]]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def found(df):
    return Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in df.collect())


def test_equals_all_pairs(spark):
    rows = corpus()
    got = sh.near_duplicates(frame(spark, rows))
    assert got.columns[:3] == ["doc_id", "fingerprint", "component_id"]
    want = Counter(classes(rows))
    assert found(got) == want
    assert len({c for _, _, c in want}) < len(want) - 20


@pytest.mark.parametrize("crowded", [1, 3])
def test_crowded_lists_by_near_values(spark, crowded):
    rows = corpus(9)
    assert found(sh.near_duplicates(frame(spark, rows), crowded=crowded)) == Counter(classes(rows))


@pytest.mark.parametrize("differ", [2, 6])
def test_other_differences(spark, differ):
    rows = corpus(5)
    assert found(sh.near_duplicates(frame(spark, rows), differ=differ)) == Counter(classes(rows, differ))
    with pytest.raises(ValueError):
        sh.near_duplicates(frame(spark, rows), differ=3)


def test_links_of_any_fingerprints(spark):
    """Fingerprints around a few centres, so that many pairs lie just within or just beyond four bits."""
    rng = np.random.default_rng(4)
    prints = set()
    for centre in rng.integers(0, 1 << 63, 5, dtype=np.uint64):
        for _ in range(120):
            x = int(centre)
            for b in rng.integers(0, 64, rng.integers(0, 7)):
                x ^= 1 << int(b)
            prints.add(x)
    prints = np.array(sorted(prints), np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints) <= 4

    def groups(links):
        label = {int(p): int(p) for p in prints.view(np.int64)}

        def find(x):
            while label[x] != x:
                x = label[x]
            return x

        for a, b in links:
            label[find(a)] = find(b)
        sets = {}
        for x in label:
            sets.setdefault(find(x), set()).add(x)
        return {frozenset(s) for s in sets.values()}

    signed = prints.view(np.int64).tolist()
    want = groups([(signed[i], signed[j]) for i, j in np.argwhere(near).tolist()])
    nodes = spark.createDataFrame([(x,) for x in signed], "fp long")
    for crowded in (10_000, 40, 1):
        links = [(r["a"], r["b"]) for r in sh.links_of(nodes, crowded=crowded).collect()]
        assert groups(links) == want
        assert all(bin((a ^ b) & (2**64 - 1)).count("1") <= 4 for a, b in links)


def test_a_long_list_of_near_copies_gives_a_tree():
    rng = np.random.default_rng(1)
    prints = np.unique(np.uint64(7) ^ (np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64)))
    links = sh.reached(prints, 4)
    assert len(links) == len(prints) - 1


def test_a_long_text_in_parts(spark, monkeypatch):
    monkeypatch.setattr(sh, "HASHED", 7)
    text = " ".join(f"word{i % 50}" for i in range(500))
    raw = np.frombuffer((text + "abc d").encode(), np.uint8)
    got = sh.fingerprints_of(raw, np.array([0, len(text), len(raw)]))
    assert got.tolist() == [fingerprint(text), fingerprint("abc d")]


def test_empty_table(spark):
    assert sh.near_duplicates(frame(spark, corpus()).where("false")).count() == 0
