"""Near-duplicate components with an LSH forest.

A document's set is its distinct shingles of words. Documents with the same set are one class, so
copies cost one row each and nothing more. Each class has minimum hashes in 32 trees.

* Candidates. Classes that agree in the first four hashes of a tree share a region; all other
  pairs are left alone. A pair at the threshold of 0.8 shares none of 32 regions with a probability
  of (1 - 0.8 ** 4) ** 32 = 5e-8, and a closer pair with less.
* Neighbours. Four trees are sorted by eight hashes; each class goes with the first one of the
  deepest region in which it has company (so depth follows how crowded the region is), regions
  go with their predecessors, and every class with the most typical one of its regions. These
  pairs are few for a class, however large the group of copies is, and join nearly all that belongs together.
* Rest. A region that lies in one component needs no further look. In the others, classes outside the
  region's largest component are compared with the region, so that links between components are found. A
  region with more than 128 classes goes deeper first, in all 32 trees: it is split by the next hashes until
  its parts are small, or 32 hashes deep, and the parts are compared. That finds most links of a crowded region at little cost, not all.
* Crowded regions. The classes of those that still lie in several components are compared by rare shingles, which
  leaves nothing out: two sets that share four fifths have one in common among the least frequent fifth (and one) of each. All
  classes that hold such a shingle are a region again, and those in several components are compared whole, in blocks.

Which classes share a region at all is the one step that depends on chance (5e-8 for a pair at the threshold).

Equal sets share size and two 64-bit sums over their shingles' prints; a class number that two different ones
share is dealt anew. Links are confirmed on full sets, recomputed from the texts. Before that, a class is dropped if so
many of its shingles occur in no other candidate that no partner can reach the threshold.

Defined cases: a null text, and one without words, has an empty set, is linked with nothing and
is kept; several rows with one doc_id are documents of their own; a component of rows without doc_id has a
null component_id and is kept; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltworks.llm.components import components
from siltworks.llm.prefix_free import Prints, _blocks
from siltworks.llm.shared import documents, whole_row, written

WORDS = 4
PERCENT = 80
TREES = 32
DEPTH = 4
FOREST, DEEP = 4, 8
#: Classes compared at once: outside a region's largest component, and of the region.
OUTSIDE, ALL = 256, 512
#: Classes beyond which a region goes deeper, and up to which its pairs are looked at one by one.
CROWDED, FEW = 128, 8
#: At each level, the trees (counted on from a region's own) whose four hashes are added.
DEEPER = ((1,), (3,), (7,), (11, 13), (17, 19))

_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Odd factors: one hash function each, DEPTH for a tree and the deeper ones of the sorted trees after them.
_FACTORS = np.random.default_rng(20).integers(0, 1 << 63, TREES * DEPTH + FOREST * (DEEP - DEPTH), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def shingles(data: np.ndarray, bounds: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle prints of each text, one text after another, and how many each has."""
    data = _LOWER[data]
    word = ~_SPACE[data]
    edge = np.ones(len(data), bool)
    edge[1:] = ~word[:-1]
    edge[bounds[:-1][bounds[:-1] < len(data)]] = True
    start = np.flatnonzero(word & edge)
    edge = np.ones(len(data), bool)
    edge[:-1] = ~word[1:]
    edge[bounds[1:][bounds[1:] > 0] - 1] = True
    end = np.flatnonzero(word & edge) + 1
    prints = Prints(data).of(start, end).view(np.uint64)
    of = np.searchsorted(start, bounds)
    n = np.diff(of)
    joined = prints[: max(0, len(prints) - words + 1)]
    for k in range(1, words):
        joined = mix(joined) + prints[k : len(joined) + k]
    joined = mix(joined)
    out, counts = [np.zeros(0, np.uint64)], np.zeros(len(n), np.int64)
    for i in np.flatnonzero(n).tolist():
        a, b = of[i], of[i + 1]
        if b - a >= words:
            own = np.unique(joined[a : b - words + 1])
        else:
            short = prints[a : a + 1]
            for k in range(a + 1, b):
                short = mix(short) + prints[k]
            own = mix(short + np.uint64(b - a))
        out.append(own)
        counts[i] = len(own)
    return np.concatenate(out), counts


def signatures(prints: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Region of each tree, and the hashes of the sorted trees two to a number, of non-empty sets."""
    first = np.cumsum(n) - n
    least = np.empty((len(n), len(_FACTORS)), np.uint64)
    for j, factor in enumerate(_FACTORS):
        least[:, j] = np.minimum.reduceat(prints * factor, first)
    least >>= np.uint64(32)
    region = np.empty((len(n), TREES), np.uint64)
    for t in range(TREES):
        key = np.full(len(n), t, np.uint64)
        for j in range(DEPTH):
            key = mix(key + least[:, t * DEPTH + j])
        region[:, t] = key
    deep = np.empty((len(n), FOREST, DEEP), np.uint64)
    for t in range(FOREST):
        more = TREES * DEPTH + t * (DEEP - DEPTH)
        deep[:, t, :DEPTH] = least[:, t * DEPTH : (t + 1) * DEPTH]
        deep[:, t, DEPTH:] = least[:, more : more + DEEP - DEPTH]
    paired = (deep[:, :, ::2] << np.uint64(32)) | deep[:, :, 1::2]
    return region.view(np.int64), paired.reshape(len(n), FOREST * DEEP // 2).view(np.int64)


def _lists(values: np.ndarray, n_rows: int) -> pa.ListArray:
    """Equal shares of a flat array."""
    width = values.size // n_rows if n_rows else 0
    return pa.ListArray.from_arrays(pa.array(np.arange(n_rows + 1, dtype=np.int32) * width), pa.array(values.reshape(-1)))


def sign(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, k, n, node, regions, deep: size, class and signature of each document's set."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, bounds in _blocks(batch.column(2)):
                prints, n = shingles(data, bounds, words)
                has = np.flatnonzero(n)
                size, f1, f2 = n.copy(), np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
                rows = np.zeros((len(n), TREES), np.int64), np.zeros((len(n), FOREST * DEEP // 2), np.int64)
                if len(has):
                    first = (np.cumsum(n) - n)[has]
                    f1[has] = np.add.reduceat(mix(prints), first)
                    f2[has] = np.add.reduceat(mix(prints ^ _A), first)
                    rows[0][has], rows[1][has] = signatures(prints, n[has])
                out = [
                    *(batch.column(i).slice(low, high - low) for i in range(2)), pa.array(size),
                    pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)), _lists(rows[0], len(n)), _lists(rows[1], len(n)),
                ]
                yield pa.RecordBatch.from_arrays(out, ["doc_id", "k", "n", "f1", "f2", "regions", "deep"])

    signed = docs.mapInArrow(work, "doc_id long, k long, n long, f1 long, f2 long, regions array<long>, deep array<long>")
    return signed


def numbered(signed: DataFrame) -> DataFrame:
    """The signed sets with the number of their class: one for each size and pair of sums."""
    known, salt = [F.col(c) for c in ("n", "f1", "f2")], 0
    while True:
        rows = signed.withColumn("node", F.xxhash64(*known, F.lit(salt)) if salt else F.xxhash64(*known))
        sets = rows.groupBy("node").agg(F.min(F.struct(*known)).alias("low"), F.max(F.struct(*known)).alias("high"))
        # 64 bits: some hundred clashes among 10^11 sets. All sets are numbered anew then.
        if sets.where("low <> high").isEmpty():
            return rows.drop("f1", "f2")
        salt += 1


def possible(n_a, c_a, n_b, c_b, percent: int):
    """Whether sets of n shingles, c of which others have too, can be similar enough."""
    return F.least(c_a, c_b) * (100 + percent) >= (n_a + n_b) * percent


def neighbours(trees: DataFrame) -> DataFrame:
    """Pairs of classes next to each other in the sorted trees, at the depth where each has company.

    Rows have tree, node, n, c and the hashes; pairs a, b come with both sides' n and c.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tree, node = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            marks = np.column_stack([batch.column(4 + i).to_numpy().view(np.uint64) for i in range(DEEP // 2)])
            hashes = np.empty((len(node), DEEP), np.uint64)
            hashes[:, ::2], hashes[:, 1::2] = marks >> np.uint64(32), marks & np.uint64(0xFFFFFFFF)
            common = np.zeros(len(node) + 1, np.int64)  # with the row before; none at either end
            if len(node) > 1:
                same = (hashes[1:] == hashes[:-1]) & (tree[1:] == tree[:-1])[:, None]
                common[1:-1] = np.cumprod(same, axis=1).sum(axis=1)
            depth = np.maximum(common[:-1], common[1:])
            place, pivot = np.arange(len(node)), np.arange(len(node))
            for d in range(DEPTH, DEEP + 1):
                start = np.maximum.accumulate(np.where(common[:-1] < d, place, 0))
                pivot = np.where(depth == d, start, pivot)
            previous = np.where((pivot == place) & (common[:-1] >= DEPTH), place - 1, place)
            a, b = np.concatenate([pivot, previous]), np.concatenate([place, place])
            real = a != b
            sides = [pa.array(x) for i in (1, 2, 3) for x in (batch.column(i).to_numpy()[a[real]], batch.column(i).to_numpy()[b[real]])]
            yield pa.RecordBatch.from_arrays(sides, ["a", "b", "n_a", "n_b", "c_a", "c_b"])

    marks = [f"m{i}" for i in range(DEEP // 2)]
    ordered = trees.repartitionByRange("tree", *marks, "node").sortWithinPartitions("tree", *marks, "node")
    return ordered.select("tree", "node", "n", "c", *marks).mapInArrow(work, "a long, b long, n_a long, n_b long, c_a long, c_b long")


def linked(pairs: DataFrame, texts: DataFrame, percent: int, words: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = []
            for i in (2, 3):
                own = []
                for _, _, data, bounds in _blocks(batch.column(i)):
                    prints, n = shingles(data, bounds, words)
                    own += np.split(prints, np.cumsum(n)[:-1])
                sets.append(own)
            keep = []
            for x, y in zip(*sets, strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    other = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(other, "b").join(one, "a").select("a", "b", "text_a", "text_b")
    return rows.mapInArrow(work, "a long, b long")


def adaptive(alive: DataFrame, signatures: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """region, node: regions of live classes (tree, region, node), crowded ones split by further hashes.

    ``signatures`` has the regions of all trees of each class; further columns of ``alive`` come along. Each level's regions
    are parts of those above, so all levels are made and counted at once, and a class stays in the first that is not
    crowded. Pairs that a split parts are left to ``by_rare_shingles``.
    """

    def too_large(rows: DataFrame) -> DataFrame:
        sizes = rows.groupBy("region").agg(F.count("*").alias("here"))
        return written(sizes.where(F.col("here") > crowded).select("region"), "crowded-regions")

    rest = [c for c in alive.columns if c not in ("tree", "region")]
    big = too_large(alive)
    if big.isEmpty():
        return alive.select("region", *rest)
    split = alive.join(big, "region", "leftsemi").join(signatures.select("node", "regions"), "node")
    levels, region = [], F.col("region")
    for trees in DEEPER:
        region = F.xxhash64(region, *[F.col("regions")[(F.col("tree") + t) % TREES] for t in trees])
        levels.append(region)
    split = written(split.select(F.array(*levels).alias("levels"), *rest), "deeper")
    counted = split.select(F.explode(F.slice("levels", 1, len(DEEPER) - 1)).alias("region"))
    deeper, rows = too_large(counted), split
    for i in range(len(DEEPER) - 1):
        rows = rows.join(deeper.select(F.col("region").alias(f"big{i}")), F.col("levels")[i] == F.col(f"big{i}"), "left")
    marks = [F.when(F.col(f"big{i}").isNull(), F.col("levels")[i]) for i in range(len(DEEPER) - 1)]
    own = F.coalesce(*marks, F.col("levels")[len(DEEPER) - 1]).alias("region")
    return alive.join(big, "region", "left_anti").select("region", *rest).unionByName(rows.select(own, *rest))


def undecided(alive: DataFrame, found: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """node: classes of crowded regions that lie in more than one of the components found."""
    placed = alive.join(found, "node", "left").select("region", "node", F.coalesce("component", "node").alias("component"))
    seen = placed.groupBy("region").agg(F.count("*").alias("here"), F.min("component").alias("low"), F.max("component").alias("high"))
    apart = seen.where((F.col("here") > crowded) & (F.col("low") != F.col("high"))).select("region")
    return placed.join(apart, "region", "leftsemi").select("node").distinct()


def by_rare_shingles(texts: DataFrame, percent: int, words: int) -> DataFrame:
    """region, node: a region for each shingle, of the classes (node, n, text) that have it among their rarest.

    Sets of n shingles that are similar enough share ``percent`` of n at least. With the shingles in one order for all, the
    first of each set that are one more than it may lack have a member in common. Of two sets the one that is not larger shares
    2 * percent / (100 + percent) of its own, so its member is among fewer: larger sets, and regions, without such a one go.
    """
    prints = written(_prints_of(texts, words, sized=True), "prints")
    often = prints.groupBy("print").agg(F.count("*").alias("sets"))
    place = F.row_number().over(Window.partitionBy("node").orderBy("sets", "print"))
    lacking = F.floor(F.col("n") * (100 - percent) / 100)
    rare = prints.join(often, "print").withColumn("place", place).where(F.col("place") <= lacking + 1)
    first = F.col("place") * (100 + percent) <= F.col("n") * (100 - percent) + 100 + percent
    rare = written(rare.where("sets > 1").select(F.col("print").alias("region"), "node", "n", first.alias("first")), "rarest")
    least = rare.where("first").groupBy("region").agg(F.min("n").alias("least"))
    return rare.join(least, "region").where("n >= least").select("region", "node")


def between_components(regions: DataFrame, found: DataFrame, live: DataFrame, percent: int, words: int) -> DataFrame:
    """Links a, b between components that meet in a region (region, node, n, c); ``found`` has the components of nodes."""
    part = F.coalesce("component", "node").alias("component")
    placed = regions.join(found, "node", "left").select("region", "node", "n", "c", part)
    marks = [F.sum(F.xxhash64("node").bitwiseAND(F.lit((1 << 40) - 1))), F.bit_xor(F.xxhash64("node", F.lit(1))), F.count("*")]
    seen = placed.groupBy("region").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("here"), F.struct(*marks).alias("marks")
    )
    # Regions of several trees that hold the same classes are looked at once.
    mixed = seen.where("low <> high").groupBy("marks").agg(F.min("region").alias("region"), F.max("here").alias("here"))
    rest = written(placed.join(mixed.select("region", "here"), "region"), "mixed")
    few = rest.where(F.col("here") <= FEW)
    members = few.groupBy("region").agg(F.collect_list(F.struct("node", "component", "n", "c")).alias("all"))
    sides = members.select(F.col("all"), F.explode("all").alias("x")).select("x", F.explode("all").alias("y"))
    sides = sides.where("x.node < y.node and x.component <> y.component")
    sides = sides.where(possible(F.col("x.n"), F.col("x.c"), F.col("y.n"), F.col("y.c"), percent))
    pairs = sides.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    many = rest.where(F.col("here") > FEW).select("node", "component", F.col("region").alias("family"))
    largest = many.groupBy("family", "component").agg(F.count("*").alias("size"))
    largest = largest.groupBy("family").agg(F.max_by("component", F.struct("size", "component")).alias("main"))
    many = many.join(largest, "family").select("node", "component", "family", (F.col("component") != F.col("main")).alias("outside"))
    in_blocks = linked_in_families(written(many, "members"), live, percent, words)
    return linked(pairs, live, percent, words).unionByName(in_blocks)


def linked_in_families(members: DataFrame, texts: DataFrame, percent: int, words: int) -> DataFrame:
    """Links a, b between components of one region: one for each class outside and each component.

    ``members`` has node, component, family (the region), outside. Blocks of the classes outside meet blocks of the
    whole region; a task holds one block of each.
    """

    def work(table: pa.Table) -> pa.Table:
        rows = table.combine_chunks()
        sets = []
        for _, _, data, bounds in _blocks(rows.column("text")):
            prints, n = shingles(data, bounds, words)
            sets += np.split(prints, np.cumsum(n)[:-1])
        left = rows.column("left").to_numpy()
        node, component = rows.column("node").to_numpy(), rows.column("component").to_numpy()
        out: list[tuple[int, int]] = []
        right = np.flatnonzero(~left)
        if len(right):
            all_prints, sizes = np.concatenate([sets[i] for i in right]), np.array([len(sets[i]) for i in right])
            known, place = np.unique(all_prints, return_inverse=True)
            first = np.cumsum(sizes) - sizes
            for i in np.flatnonzero(left):
                at = np.minimum(np.searchsorted(known, sets[i]), len(known) - 1)
                mine = np.zeros(len(known), np.int64)
                mine[at[known[at] == sets[i]]] = 1
                both = np.add.reduceat(mine[place], first)
                near = right[100 * both >= percent * (sizes + len(sets[i]) - both)]
                near = near[component[near] != component[i]]
                _, one = np.unique(component[near], return_index=True)
                out += [(int(node[i]), int(node[j])) for j in near[one]]
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    size = members.groupBy("family").agg(
        F.ceil(F.count_if("outside") / OUTSIDE).alias("rows"), F.ceil(F.count("*") / ALL).alias("columns")
    )
    placed = members.join(size, "family")
    row = F.pmod(F.xxhash64("node"), F.col("rows"))
    column = F.pmod(F.xxhash64("node", F.lit(1)), F.col("columns"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = placed.where("outside").select("family", "node", "component", F.lit(True).alias("left"), row.alias("row"), every("columns").alias("column"))
    right = placed.select("family", "node", "component", F.lit(False).alias("left"), every("rows").alias("row"), column.alias("column"))
    blocks = left.unionByName(right).join(texts.select("node", "text"), "node")
    return blocks.groupBy("family", "row", "column").applyInArrow(work, "a long, b long")


def _key():
    """Rows with the same key are the same document, written several times."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def grouped(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """doc_id, k, n (size of the set), component (null without words), component_id of every document."""
    text = F.col("text").cast("string")
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), _key().alias("k"))
    signed = numbered(written(sign(keyed.select("doc_id", "k", "text"), words), "signed"))

    one = F.min_by(F.struct("n", "k", "regions", "deep"), "k").alias("one")
    classes = signed.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("first_doc"), one)
    classes = written(classes.select("node", "first_doc", "one.*"), "classes")

    regions = classes.select("node", F.posexplode("regions").alias("tree", "region"))
    crowded = written(regions.groupBy("region").agg(F.count("*").alias("here")).where("here > 1").select("region"), "crowded")
    shared = written(regions.join(crowded, "region", "leftsemi"), "regions")
    candidates = classes.join(shared.select("node").distinct(), "node", "leftsemi").select("node", "n", "k", "deep")
    texts = keyed.select("k", "text").join(candidates, "k").dropDuplicates(["node"]).select("node", "n", "text", "deep")
    texts = written(texts, "candidates")

    own = _prints_of(texts, words).groupBy("print").agg(F.count("*").alias("sets"), F.min("node").alias("node"))
    alone = own.where("sets = 1").groupBy("node").agg(F.count("*").alias("alone"))
    in_others = F.col("n") - F.coalesce("alone", F.lit(0))
    live = texts.join(alone, "node", "left").withColumn("c", in_others).where(f"c * 100 >= n * {percent}")
    live = written(live.select("node", "n", "c", "text", "deep"), "live")
    sizes = live.select("node", "n", "c")

    of_tree = [
        F.struct(F.lit(t).alias("tree"), *(F.col("deep")[t * DEEP // 2 + i].alias(f"m{i}") for i in range(DEEP // 2)))
        for t in range(FOREST)
    ]
    trees = live.select("node", "n", "c", F.inline(F.array(*of_tree)))
    alive = written(shared.join(sizes, "node").select("node", "n", "c", "tree", "region"), "live-regions")
    whole = F.struct(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("c").alias("c_a"))
    typical = written(alive.groupBy("region").agg(F.max_by(whole, F.struct(F.col("c") / F.col("n"), F.col("node"))).alias("t")), "typical")
    others = alive.join(typical.select("region", "t.*"), "region").where("a <> node")
    others = others.withColumnsRenamed({"node": "b", "n": "n_b", "c": "c_b"})
    pairs = neighbours(trees).unionByName(others.drop("region", "tree"))
    pairs = pairs.where(possible(F.col("n_a"), F.col("c_a"), F.col("n_b"), F.col("c_b"), percent))
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = written(linked(pairs, live, percent, words), "links")

    found = components(links)
    part = F.coalesce("component", "node").alias("component")
    more = between_components(adaptive(alive, classes), found, live, percent, words)
    found = joined_up(found, written(more, "more-links"))
    rest = written(live.join(undecided(alive, found), "node").select("node", "n", "text"), "undecided")
    if not rest.isEmpty():
        regions = written(by_rare_shingles(rest, percent, words).join(sizes, "node"), "rare")
        found = joined_up(found, written(between_components(regions, found, live, percent, words), "last-links"))

    joined = classes.select("node", "first_doc").join(found, "node", "left").select("node", "first_doc", part)
    least = joined.groupBy("component").agg(F.min("first_doc").alias("component_id"))
    named = written(joined.join(least, "component").select("node", "component", "component_id"), "named")
    rows = signed.select("doc_id", "k", "n", F.when(F.col("n") > 0, F.col("node")).alias("node")).join(named, "node", "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "k", "n", "component", own.alias("component_id"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document."""
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    return grouped(docs, percent, words).select("doc_id", F.col("n").alias("n_shingles"), "component_id", kept)


def joined_up(found: DataFrame, links: DataFrame) -> DataFrame:
    """node, component of the components found, once further links a, b have joined some of them."""
    if links.isEmpty():
        return found
    return components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links))


def _prints_of(texts: DataFrame, words: int, sized: bool = False) -> DataFrame:
    """print, node: the shingles of candidates; ``sized`` adds n, how many the node has."""
    names = ["print", "node", "n"] if sized else ["print", "node"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = batch.column(0).to_numpy()
            for low, high, data, bounds in _blocks(batch.column(1)):
                prints, n = shingles(data, bounds, words)
                out = [prints.view(np.int64), np.repeat(node[low:high], n), np.repeat(n, n)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in out[: len(names)]], names)

    return texts.select("node", "text").mapInArrow(work, ", ".join(f"{name} long" for name in names))


def keep_one(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """One document of each component, with all columns of ``docs``; documents without words all stay.

    A component keeps a row of its smallest doc_id (one without doc_id if there is no other).
    """
    found = written(grouped(docs, percent, words).where("n > 0"), "grouped")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k")).alias("first")
    chosen = found.groupBy("component").agg(first).select(F.col("first.k").alias("k"))
    has_word = F.coalesce(F.col("text").cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    single = docs.where(has_word).select(_key().alias("k"), whole_row(docs).alias("row"))
    single = single.join(chosen, "k").dropDuplicates(["k"]).select("row.*")
    return single.unionByName(docs.where(~has_word))


def op5_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


QUERIES = {"op5_lsh_forest": (op5_lsh_forest, None)}
