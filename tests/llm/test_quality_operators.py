import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from siltworks.llm import empirical_bayes as eb
from siltworks.llm import weak_supervision as ws

SMALL = "/root/testdata/sf0.01"
SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("pattern", StringType()), StructField("n", IntegerType())])
SPACE = r"[\x20\x09-\x0D]"


def base_signals(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    n = Counter(windows)
    covered = {j for i, w in enumerate(windows) if n[w] > 1 for j in range(i, i + 8)}
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    seen, again = set(), 0
    for line in lines:
        again += line in seen
        seen.add(line)
    return len(words), sum(map(len, words)), symbols, again, len(covered)


def odd_texts():
    rng = random.Random(4)
    word = lambda: rng.choice(["the", "a", "Straße", "日本", "x", "#", "|", "\x85", "\xa0b", "\x1c"])
    out = [None, "", " \n\t\x0b", "one", "a b c d e f g h a b c d e f g h", "x " * 300, "l\nl\n l\nl\r\nl\n\n\n", "A" * 5000, "| " * 40]
    for _ in range(60):
        out.append("".join(word() + rng.choice([" ", " ", "\n", "\t", "\x0b\x0c"]) for _ in range(rng.randrange(120))))
    return out


def frame(spark, texts):
    rows = [(i if i % 7 else None, t, "clash", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[-1]], SCHEMA).repartition(3), [*rows, rows[-1]]


def test_signals_equal_their_definitions(spark):
    docs, rows = frame(spark, odd_texts())
    got = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in ws.judge(docs).collect())
    want = Counter()
    for doc_id, text, *_ in rows:
        s = base_signals(text)
        want[doc_id, *s, s[0] < 20 or 100 * s[4] > 30 * s[0]] += 1
    assert got == want


def test_repeated_words_of_any_numbers():
    rng = np.random.default_rng(2)
    for _ in range(300):
        words = rng.integers(0, rng.integers(1, 4), rng.integers(0, 60))
        text = " ".join(map(str, words))
        assert ws.repeated_words(words) == base_signals(text)[4]


PLANTED = [
    ([0.90, 0.85, 0.80, 0.95], [0.70, 0.80, 0.75, 0.90], 0.8),
    ([0.99, 0.98, 0.97, 0.99], [0.70, 0.50, 0.80, 0.60], 0.8),
    ([0.70, 0.75, 0.90, 0.80, 0.85, 0.95], [0.90, 0.70, 0.75, 0.80, 0.70, 0.85], 0.7),
    ([0.995, 0.999, 0.993, 0.998], [0.7, 0.5, 0.8, 0.6], 0.8),
]


def planted(on_good, on_bad, share, n, seed=6):
    rng = np.random.default_rng(seed)
    good, size = rng.random(n) < share, (n, len(on_good))
    says_good = np.where(good[:, None], rng.random(size) < on_good, rng.random(size) >= on_bad)
    return good, np.where(rng.random(size) < 0.1, 0, np.where(says_good, 1, -1))


def patterns_of(votes):
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    return patterns, counts.astype(float)


@pytest.mark.parametrize("on_good,on_bad,share", PLANTED)
def test_estimate_recovers_planted_accuracies(on_good, on_bad, share):
    good, votes = planted(on_good, on_bad, share, 60_000)
    patterns, counts = patterns_of(votes)
    model = ws.estimate(patterns, counts)
    assert abs(model.share - share) < 0.01
    assert np.abs(model.on_good - on_good).max() < 0.015 and np.abs(model.on_bad - on_bad).max() < 0.03
    judged = dict(zip(map(tuple, patterns), model.posterior(patterns) >= 0.5, strict=True))
    kept = np.array([judged[tuple(v)] for v in votes])
    odds = np.log(share / (1 - share)) + (votes > 0) @ np.log(np.array(on_good) / (1 - np.array(on_bad))) + (votes < 0) @ np.log((1 - np.array(on_good)) / on_bad)
    assert np.mean(kept == (odds >= 0)) > 0.99  # what the planted accuracies themselves would say
    assert np.mean(kept[good]) > 0.9


def plain_em(votes, share=0.8, rounds=400):
    """Two classes, a document at a time, each rule's votes as shares of good, none and bad; nothing shared with the library."""
    rows = [tuple(int(x) for x in v) for v in votes]
    good = [0.1 if -1 in row else 0.9 for row in rows]
    n_rules = len(rows[0])
    for _ in range(rounds):
        tables = []
        for held, prior in ((good, (9.0, 1.0, 1.0)), ([1 - g for g in good], (2.0, 1.0, 2.0))):
            table = [{v: p for v, p in zip((1, 0, -1), prior, strict=True)} for _ in range(n_rules)]
            for row, weight in zip(rows, held, strict=True):
                for r, v in enumerate(row):
                    table[r][v] += weight
            tables.append([{v: x / sum(t.values()) for v, x in t.items()} for t in table])
        share = (sum(good) + 1) / (len(rows) + 2)
        new = []
        for row in rows:
            p, q = share, 1 - share
            for r, v in enumerate(row):
                p, q = p * tables[0][r][v], q * tables[1][r][v]
            new.append(p / (p + q))
        done = max(abs(a - b) for a, b in zip(new, good, strict=True)) < 1e-7
        good = new
        if done:
            break
    right = lambda table, v: [t[v] / (t[1] + t[-1]) for t in table]
    return share, right(tables[0], 1), right(tables[1], -1), good


def test_estimate_equals_a_plain_version():
    _, votes = planted(*PLANTED[0], 1500)
    patterns, counts = patterns_of(votes)
    model = ws.estimate(patterns, counts)
    share, on_good, on_bad, posterior = plain_em(votes)
    assert len(model.shares) == 2
    assert abs(model.share - share) < 2e-3
    assert np.abs(model.on_good - on_good).max() < 2e-3 and np.abs(model.on_bad - on_bad).max() < 5e-3
    mine = dict(zip(map(tuple, patterns), model.posterior(patterns), strict=True))
    assert max(abs(mine[tuple(v)] - p) for v, p in zip(votes, posterior, strict=True)) < 0.01


def test_kinds_of_bad_documents_that_different_rules_notice():
    """Two kinds of bad documents: each passes half of the rules. A single bad class could not hold both."""
    rng = np.random.default_rng(3)
    kind = rng.choice(3, 40_000, p=[0.85, 0.1, 0.05])
    on = np.array([[0.97] * 6, [0.97, 0.97, 0.1, 0.4, 0.3, 0.97], [0.2, 0.3, 0.97, 0.97, 0.97, 0.1]])
    votes = np.where(rng.random((40_000, 6)) < on[kind], 1, -1)
    patterns, counts = patterns_of(votes)
    model = ws.estimate(patterns, counts)
    assert len(model.shares) == 3 and abs(model.share - 0.85) < 0.02
    assert np.abs(model.on_good - 0.97).max() < 0.02
    judged = dict(zip(map(tuple, patterns), model.posterior(patterns) >= 0.5, strict=True))
    kept = np.array([judged[tuple(v)] for v in votes])
    assert kept[kind == 0].mean() > 0.97 and kept[kind == 1].mean() < 0.2 and kept[kind == 2].mean() < 0.2


def test_estimate_of_few_or_uniform_votes():
    one = ws.estimate(np.ones((1, 8), int), np.array([5.0]))
    assert one.posterior(np.ones((1, 8), int))[0] > 0.5
    none = ws.estimate(np.zeros((0, 8), int), np.zeros(0))
    assert none.posterior(np.ones((1, 8), int))[0] > 0.5 > none.posterior(-np.ones((1, 8), int))[0]
    silent = ws.estimate(np.zeros((1, 8), int), np.array([9.0]))
    assert np.isfinite(silent.posterior(np.zeros((1, 8), int))).all()


def test_verdict_follows_from_all_patterns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = ws.judge(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["kept"] == (not r["base_failed"] and r["posterior"] >= 0.5)
    kept = ws.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {r["doc_id"] for r in rows if r["kept"]}
    good = docs.join(spark.read.parquet(f"{SMALL}/labels.parquet"), "doc_id").where("quality = 1")
    good = {r["doc_id"] for r in good.collect()}
    passed = [r for r in rows if r["doc_id"] in good and not r["base_failed"]]
    assert sum(r["kept"] for r in passed) >= 0.98 * len(passed)
    bad = {r["doc_id"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").where("quality = 0").collect()}
    assert sum(r["kept"] for r in rows if r["doc_id"] in bad) <= 0.2 * len(bad)
    # The verdicts again, from each document's own votes and the model's classes, one product at a time.
    value = {"+": 1, "0": 0, "-": -1}
    marked = docs.select("doc_id", ws.signals(F.col("text")).alias("s")).select("doc_id", ws.pattern("s").alias("p")).collect()
    votes = {r["doc_id"]: [value[c] for c in r["p"]] for r in marked}
    model = ws.estimate(*patterns_of(np.array(list(votes.values()))))
    for r in rows:
        odds = [share * np.prod([model.votes[1 - v, c, i] for i, v in enumerate(votes[r["doc_id"]])]) for c, share in enumerate(model.shares)]
        assert abs(sum(x for x, g in zip(odds, model.good, strict=True) if g) / sum(odds) - r["posterior"]) < 1e-6


@pytest.mark.parametrize("keep", [ws.keep_good, lambda d: eb.keep_good(d, d.sparkSession.createDataFrame([], "doc_id long, quality int, toxic int"), "pattern", "n")])
def test_filters_keep_columns_and_take_empty_tables(spark, keep):
    docs, rows = frame(spark, [*odd_texts(), " ".join(f"word{i} and" for i in range(60))])
    kept = keep(docs)
    assert kept.columns == docs.columns
    assert any(r["text"] and "word5 and" in r["text"] for r in kept.collect())
    assert keep(docs.where("false")).count() == 0


def site_documents(spark, n=1500):
    rng = random.Random(8)
    neutral = [f"{a}{b}" for a in ("lor", "ips", "dol", "ame") for b in range(300)]
    rows, labels = [], []
    for i in range(n):
        host = f"h{rng.randrange(6)}" if i % 50 else None
        path = rng.choice(["a", "b", None])
        toxic = rng.random() < (0.7 if host == "h0" and path == "a" else 0.08)
        low = rng.random() < 0.08
        words = rng.choices(neutral, k=80) + (["vilely", "scummy"] if toxic and rng.random() < 0.9 else [])
        words = [w + "***" for w in words] if low else words
        rng.shuffle(words)
        rows.append((i, " ".join(words), host, path, 1.0))
        labels.append((i, int(not low), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, s double").repartition(4)
    return docs, labels


def test_classifier_on_held_out_labels(spark):
    docs, labels = site_documents(spark)
    known = [(i, q if i % 11 else None, t) for i, q, t in labels if i % 2] + [(None, 0, 1), (10**9, 0, 1), (3, 1, 0)]
    judged = eb.classify(docs, spark.createDataFrame(known, "doc_id long, quality int, toxic int")).collect()
    assert len(judged) == len(labels)
    truth = {i: q == 1 and not t for i, q, t in labels if i % 2 == 0}
    mine = {r["doc_id"]: r["kept"] for r in judged if r["doc_id"] in truth}
    good = [mine[i] for i, x in truth.items() if x]
    bad = [mine[i] for i, x in truth.items() if not x]
    assert sum(good) > 0.97 * len(good) and sum(bad) < 0.2 * len(bad)
    site = {(r["host"], r["path"]) for r in judged}
    assert (None, None) in site and len(site) == 21


def test_sites_shrink_toward_the_levels_above(spark):
    rows = [("a", "x", 0.9)] * 300 + [("a", "y", 0.1)] * 300 + [("b", "x", 0.1)] * 400 + [("b", "z", 0.9)] * 1 + [(None, None, 0.2)] * 100
    sites = {(r["_host"], r["_path"]): r for r in eb.site_posteriors(spark.createDataFrame(rows, "_host string, _path string, p double")).collect()}
    assert len(sites) == 5
    mean = lambda r: (r["strength"] * r["prior"] + r["s"]) / (r["strength"] + r["n"])
    assert abs(mean(sites["a", "x"]) - 0.9) < 0.05 and abs(mean(sites["a", "y"]) - 0.1) < 0.05
    assert mean(sites["b", "z"]) < 0.5  # one document says little
    assert sites["a", "x"]["prior"] > sites["b", "x"]["prior"]


def test_classifier_on_the_labelled_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    train, held = labels.where("doc_id % 4 <> 0"), labels.where("doc_id % 4 = 0")
    judged = eb.classify(docs, train).join(held, "doc_id").groupBy((F.expr("quality = 1 and toxic = 0")).alias("clean")).agg(F.avg(F.col("kept").cast("int")).alias("kept"))
    kept = {r["clean"]: r["kept"] for r in judged.collect()}
    assert kept[True] > 0.95 and kept[False] < 0.6


def test_bound_on_labels(spark):
    docs, labels = site_documents(spark, 200)
    sample = eb.labelled(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), bound=25)
    assert sample.count() == 25
