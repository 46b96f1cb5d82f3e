import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from siltworks.llm import lsh_forest as lf
from siltworks.llm.components import components

SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("n", StringType())])


def shingle_set(text, words=4):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not found:
        return frozenset()
    return frozenset([tuple(found)]) if len(found) < words else frozenset(zip(*(found[k:] for k in range(words)), strict=False))


def brute(rows, percent=80, words=4):
    sets = [shingle_set(t, words) for _, t, *_ in rows]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    label[find(i)] = find(j)
    least = {}
    for i, (doc_id, *_) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    out = []
    for i, (doc_id, *_) in enumerate(rows):
        component = least.get(find(i)) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), component, doc_id == component))
    return out, len({find(i) for i in range(len(rows)) if sets[i]}) + sum(not s for s in sets)


def corpus(seed, families=6, copies=25):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("Ab", "cd", "É", "日", "x-", "Zz") for b in range(60)]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    raw = []
    for _ in range(families):
        base = text(rng.randrange(20, 160))
        for _ in range(copies):
            edited = list(base)
            for _ in range(rng.randrange(0, 2 + len(base) // 14)):
                at = rng.randrange(len(edited))
                edited[at : at + rng.randrange(2)] = text(rng.randrange(2))
            raw.append(rng.choice([" ", "  ", "\n", "\x0b"]).join(edited))
        raw += [" ".join(base).upper(), " ".join(base), " ".join(base)]
    chain = text(200)  # each a neighbour of the next, the ends far apart
    for k in range(0, 100, 8):
        raw.append(" ".join(chain[k : k + 100]))
    raw += [" ".join(text(rng.randrange(1, 60))) for _ in range(60)]
    raw += ["", None, " \n\t", "one", "ONE", "one two", "one two three", "one  two three", "one two three four", "a\x85b c d e", "a\x85b c d e"]
    rng.shuffle(raw)
    return raw


def frame(spark, seed, **kind):
    rows = [(i * 3 + 1 if i % 19 else None, t, "x") for i, t in enumerate(corpus(seed, **kind))]
    rows += [(4, rows[1][1], "x"), (4, rows[1][1], "y"), (4, "another text with the same id as before", "z")]
    return spark.createDataFrame(rows, SCHEMA).repartition(5), rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_equal_all_pairs(spark, seed):
    docs, rows = frame(spark, seed)
    got = Counter(tuple(r) for r in lf.near_duplicates(docs).collect())
    assert got == Counter(brute(rows)[0])


def test_other_shingles_and_threshold(spark):
    docs, rows = frame(spark, 4, families=3)
    got = Counter(tuple(r) for r in lf.near_duplicates(docs, percent=90, words=2).collect())
    assert got == Counter(brute(rows, 90, 2)[0])


def test_family_blocks(spark, monkeypatch):
    monkeypatch.setattr(lf, "OUTSIDE", 3)
    monkeypatch.setattr(lf, "ALL", 7)
    docs, rows = frame(spark, 5, families=2, copies=60)
    got = Counter(tuple(r) for r in lf.near_duplicates(docs).collect())
    assert got == Counter(brute(rows)[0])


def test_links_left_to_families_are_found(spark):
    rows = [(i, t) for i, t in enumerate(corpus(6, families=2)) if shingle_set(t)]
    texts = spark.createDataFrame([(i, t) for i, t in rows], "node long, text string")
    members = texts.select("node", F.col("node").alias("component"), F.lit(0).cast("long").alias("family"), (F.col("node") > 3).alias("outside"))
    found = {(r["a"], r["b"]) for r in lf.linked_in_families(members, texts, 80, 4).collect()}
    sets = dict((i, shingle_set(t)) for i, t in rows)
    want = set()
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a > 3 and a != b and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                want.add((a, b))
    assert found == want


def test_one_document_of_each_component_stays(spark):
    docs, rows = frame(spark, 7)
    kept = lf.keep_one(docs)
    assert kept.columns == docs.columns
    out = kept.collect()
    assert len(out) == brute(rows)[1]
    judged, _ = brute(rows)
    ids = {(d, t) for (d, t, _), (_, n, c, k) in zip(rows, judged, strict=True) if k or n == 0}
    assert all((r["doc_id"], r["text"]) in ids for r in out)


def test_no_documents(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert lf.near_duplicates(empty).count() == 0 and lf.keep_one(empty).count() == 0


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(9)
    links = [(i, i + 1) for i in range(0, 70)] + [(1000, i) for i in range(1001, 1300)] + [(5000, 5000)]
    links += [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(80)]
    rng.shuffle(links)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    label = {x: x for link in links for x in link}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    assert got == {x: c for x, c in label.items() if x != 5000}


def test_regions_of_sorted_trees():
    prints = np.arange(1, 2001, dtype=np.uint64)
    regions, deep = lf.signatures(prints, np.array([1000, 1000]))
    assert regions.shape == (2, lf.TREES) and deep.shape == (2, lf.FOREST * lf.DEEP // 2)
    again, _ = lf.signatures(prints[:1000], np.array([1000]))
    assert np.array_equal(again[0], regions[0])


def template_pages(n, seed=1, near=0.1):
    """Pages of one template with fields from small pools: alike, but hardly any two by four fifths. Some come with a near copy."""
    rng = random.Random(seed)
    fixed = [f"t{i}" for i in range(90)]
    pools = [[f"f{k}v{v}" for v in range(25)] for k in range(9)]
    out = []
    for i in range(n):
        page = list(fixed)
        for k, pool in enumerate(pools):
            page[10 * k + 4] = rng.choice(pool)
        out.append(" ".join(page))
        if rng.random() < near:
            page[85] = f"own{i}"
            out.append(" ".join(page))
    return out


def numbered_sets(spark, texts):
    signed = lf.numbered(lf.sign(spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "doc_id long, k long, text string")))
    classes = signed.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("regions").alias("regions"))
    return classes.select("node", "doc_id", "regions").checkpoint()


def test_classes_compared_with_each_are_bounded_for_a_template(spark):
    spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
    met = []
    for n in (1000, 4000):
        classes = numbered_sets(spark, template_pages(n))
        alive = classes.select("node", F.posexplode("regions").alias("tree", "region"))
        sizes = lf.adaptive(alive, classes).groupBy("region").agg(F.count("*").alias("n"))
        total = sizes.agg(F.sum(F.col("n") * (F.col("n") - 1))).first()[0]
        assert sizes.agg(F.max("n")).first()[0] <= lf.CROWDED
        met.append(total / classes.count())
    # Four times the pages: below the bound of 32 regions of 128, where it stays; all pairs would be 1,000 and 4,000 each.
    assert met[1] < 3 * met[0] < lf.TREES * lf.CROWDED / 2, met


def test_crowded_regions_lose_hardly_a_link(spark, monkeypatch):
    """All regions of a template go deeper; near copies are still found, and nothing is linked that should not be."""
    monkeypatch.setattr(lf.adaptive, "__defaults__", (16,))
    rows = list(enumerate(template_pages(260, 3, near=0.3)))
    got = {r["doc_id"]: r["component_id"] for r in lf.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {d: c for d, _, c, _ in brute(rows)[0]}
    together = {(a, b) for a in want for b in want if a < b and want[a] == want[b]}
    found = {(a, b) for a in got for b in got if a < b and got[a] == got[b]}
    assert found <= together and len(found) >= 0.95 * len(together) and len(together) > 50


def test_equal_numbers_of_different_sets_are_dealt_anew(spark, monkeypatch):
    """Two sets that share a class number: all are numbered again, with another salt."""
    signed = spark.createDataFrame([(1, 1, 5, 7, 9), (2, 2, 5, 7, 9), (3, 3, 5, 8, 9)], "doc_id long, k long, n long, f1 long, f2 long")
    real, calls = F.xxhash64, []

    def clashing(*columns):
        calls.append(len(columns))
        return F.lit(11).cast("long") if len(columns) == 3 else real(*columns)

    monkeypatch.setattr(lf.F, "xxhash64", clashing)
    rows = {r["doc_id"]: r["node"] for r in lf.numbered(signed).collect()}
    assert rows[1] == rows[2] != rows[3] and 4 in calls


def test_crowded_regions_lose_no_link(spark, monkeypatch):
    """Pages of one template with two words of their own: those with them in the same places are linked, by shingles that all pages have."""
    for step in (lf.adaptive, lf.undecided):
        monkeypatch.setattr(step, "__defaults__", (16,))
    rng, texts = random.Random(11), []
    for pair in range(120):
        places = rng.sample(range(4, 85), 2)
        for copy in range(2):
            page = [f"t{i}" for i in range(90)]
            for at in places:
                page[at] = f"own{pair}c{copy}a{at}"
            texts.append(" ".join(page))
    rows = list(enumerate(texts))
    want = {d: c for d, _, c, _ in brute(rows)[0]}
    got = {r["doc_id"]: r["component_id"] for r in lf.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(set(want.values())) > 20
    assert got == want


def test_only_sets_that_can_be_similar_share_a_rare_region(spark):
    """Of 90 words, two sets with 8 of their own are similar at 0.8; with 15 they are not, whatever they share beyond."""
    page = lambda name, own: " ".join([f"{name}{i}" for i in range(own)] + [f"all{i}" for i in range(90 - own)])
    for own, meet in ((8, True), (15, False)):
        rows = [(1, 90, page("a", own)), (2, 90, page("b", own))]
        regions = lf.by_rare_shingles(spark.createDataFrame(rows, "node long, n long, text string"), 80, 1).collect()
        assert {r["node"] for r in regions} == ({1, 2} if meet else set())


def test_regions_of_all_levels_are_counted_at_once(spark, monkeypatch):
    """The regions are those of splitting level by level, and crowded ones are looked for twice, however deep they go."""
    spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
    classes, real, labels = numbered_sets(spark, template_pages(150)), lf.written, []
    monkeypatch.setattr(lf, "written", lambda df, label: labels.append(label) or real(df, label))
    hashes = {r["node"]: r["regions"] for r in classes.collect()}
    parts = {}
    for node, regions in hashes.items():
        for tree, region in enumerate(regions):
            parts.setdefault((tree, region), []).append(node)
    want = Counter()
    for (tree, _), nodes in parts.items():
        level = [nodes]
        for trees in lf.DEEPER:
            want.update(frozenset(n) for n in level if len(n) <= 8)
            split = {}
            for at, members in enumerate(level):
                for node in members if len(members) > 8 else ():
                    split.setdefault((at, *[hashes[node][(tree + t) % lf.TREES] for t in trees]), []).append(node)
            level = list(split.values())
        want.update(map(frozenset, level))
    alive = classes.select("node", F.posexplode("regions").alias("tree", "region"))
    found = lf.adaptive(alive, classes, 8).groupBy("region").agg(F.collect_list("node").alias("nodes")).collect()
    assert Counter(frozenset(r["nodes"]) for r in found) == want
    assert labels.count("crowded-regions") == 2
