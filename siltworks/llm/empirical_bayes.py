"""Quality classification by hierarchical empirical Bayes.

A classifier judges a document by its text; its host and its path on the host say what to expect
before the text is read. Hosts are shrunk toward the corpus and paths toward their host, by how
much hosts and paths differ (estimated by moments), so a site with few documents says little. A
document's verdict adds both: the evidence of its text, as odds, and its path's odds, without
the document's own share in them.

The classifier is logistic regression over words, their beginnings and bands of a few measures, one for
low quality and one for toxicity, fitted on a bounded sample of labelled documents. Features are
chosen by grouped counts over the sample. Sites are sums over all documents.

Defined cases: documents without label are only judged; labels of unknown or null doc_id and null labels are
ignored, of several labels the worst counts; a null or empty text has no words; null hosts and
paths are a site of their own; without labels of both kinds a model is silent and nothing is rejected; an
empty table gives no rows; further columns are kept by ``keep_good``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.llm.shared import documents, whole_row, written

#: Labelled documents the classifier is fitted on, chosen by hash. The bound is the only limit on them.
MAX_LABELLED = 40_000
#: Features a model may have; the strongest are taken.
MAX_FEATURES = 1_500
#: Documents a feature must occur in, and standard errors by which its share must differ.
MIN_DOCUMENTS, MIN_Z = 5, 4.0
REJECT_FROM = 0.5

TARGETS = ("low", "toxic")
_WORD = re.compile(r"[^\W\d_]+")
_SYMBOLS = b"#*$%&|<>!?@^~=+{}[]\\/"


def bands(text: str) -> list[str]:
    """Measures of a text, each as a band of a rising scale."""
    raw = text.encode()
    n, words = max(1, len(raw)), text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    digits = len(raw) - len(raw.translate(None, b"0123456789"))
    capitals = sum(map(str.isupper, text)) if not raw.isascii() else len(raw) - len(raw.translate(None, bytes(range(65, 91))))
    measures = {
        "symbols": symbols / n, "digits": digits / n, "capitals": capitals / n,
        "same_words": 1 - len(set(words)) / max(1, len(words)), "same_lines": 1 - len(set(lines)) / max(1, len(lines)),
    }
    out = [f"={k}:{int(np.searchsorted(_SCALE, v))}" for k, v in measures.items()]
    return [*out, f"=words:{len(words).bit_length()}", f"=letters:{min(20, len(raw) // max(1, len(words)))}"]


_SCALE = np.array([0.001, 0.003, 0.01, 0.02, 0.04, 0.07, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])


def features(text: str | None) -> set[str]:
    """Words in lower case, their beginnings (marked by ^) and bands (marked by =)."""
    text = text or ""
    words = set(_WORD.findall(text.lower()))
    return {*words, *bands(text), *("^" + w[:4] for w in words if len(w) > 4), *("^" + w[:5] for w in words if len(w) > 5)}


def labelled(docs: DataFrame, labels: DataFrame, bound: int = MAX_LABELLED) -> DataFrame:
    """text and targets of at most ``bound`` labelled documents; the labels are small enough to be sent to all."""
    bad = {"low": F.col("quality") <= 0, "toxic": F.col("toxic") > 0}
    one = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("_labelled"))
    chosen = one.agg(*[F.max(c.cast("int")).alias(k) for k, c in bad.items()]).where(F.col("low").isNotNull() & F.col("toxic").isNotNull())
    chosen = chosen.orderBy(F.xxhash64("_labelled"), "_labelled").limit(bound)
    text = docs.select(F.col("doc_id").cast("long").alias("_labelled"), F.col("text").cast("string").alias("text"))
    return text.join(F.broadcast(chosen), "_labelled").select("text", *TARGETS)  # bound rows of 16 bytes


class Model:
    """Weights of features whose sum, with the bias, is log odds."""

    def __init__(self, weights: dict[str, float] | None = None, bias: float = -12.0):
        self.weights, self.bias = weights or {}, bias

    def odds(self, found: set[str]) -> float:
        return float(np.clip(self.bias + sum(map(self.weights.get, self.weights.keys() & found)), -12, 12))


def fit_logistic(row: np.ndarray, column: np.ndarray, bad: np.ndarray, width: int, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression on the features that are present (row and column numbers), with an L2 penalty.

    Accelerated gradient steps on columns of equal second moment, so that rare words move as fast as
    common bands; the penalty leaves weights of features seen a few times small.
    """
    n = len(bad)
    share = np.bincount(column, minlength=width) / n
    size = 1 / np.sqrt(np.maximum(share, 1 / n))
    value = size[column]
    times = lambda w: np.bincount(row, value * w[column], minlength=n)
    back = lambda r: np.bincount(column, value * r[row], minlength=width)
    probe = np.ones(width)
    for _ in range(15):  # the largest curvature
        probe = back(times(probe)) / n
        top = np.linalg.norm(probe)
        probe /= max(top, 1e-12)
    penalty = 2.0 / n
    step = 1 / (0.25 * (1.1 * top + 1) + penalty * (size**2).max())
    w, b = np.zeros(width), float(np.log((bad.sum() + 0.5) / (n - bad.sum() + 0.5)))
    w_ahead, b_ahead, t = w, b, 1.0
    for _ in range(rounds):
        r = 1 / (1 + np.exp(-np.clip(times(w_ahead) + b_ahead, -30, 30))) - bad
        w_next = w_ahead - step * (back(r) / n + penalty * size**2 * w_ahead)
        b_next = b_ahead - step * r.mean()
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        w_ahead, b_ahead = w_next + (t - 1) / t_next * (w_next - w), b_next + (t - 1) / t_next * (b_next - b)
        w, b, t = w_next, b_next, t_next
    return w * size, b


def fit(docs: DataFrame, labels: DataFrame, bound: int = MAX_LABELLED) -> dict[str, Model]:
    """A model per target. The driver gets the chosen features and, of each labelled document, which it has."""
    sample = written(labelled(docs, labels, bound), "labelled")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(features(t)) for t in batch.column(0).to_pylist()]
            row = np.repeat(np.arange(len(found)), [len(x) for x in found])
            table = pa.table([pa.array([w for x in found for w in x], pa.string()), *(batch.column(1 + i).take(pa.array(row)) for i in range(2))], ["feature", *TARGETS])
            added = table.group_by("feature").aggregate([("low", "sum"), ("toxic", "sum"), ([], "count_all")])
            yield from added.select(["feature", "low_sum", "toxic_sum", "count_all"]).rename_columns(["feature", *TARGETS, "n"]).to_batches()

    totals = sample.agg(F.count("*").alias("n"), *[F.sum(t).alias(t) for t in TARGETS]).first()
    counts = sample.mapInArrow(split, "feature string, low long, toxic long, n long").groupBy("feature")
    counts = written(counts.agg(*[F.sum(c).alias(c) for c in ("low", "toxic", "n")]).where(F.col("n") >= MIN_DOCUMENTS), "features")
    chosen: dict[str, list[str]] = {}
    for target in TARGETS:
        n, bad = totals["n"], totals[target] or 0
        if bad and bad < n:
            rate = bad / n
            z = F.abs(F.col(target) - F.col("n") * rate) / F.sqrt(F.col("n") * rate * (1 - rate))
            strong = counts.withColumn("z", z).where(F.col("z") >= MIN_Z).orderBy(F.desc("z"), "feature").limit(MAX_FEATURES)
            chosen[target] = [r["feature"] for r in strong.select("feature").collect()]
    number = {f: i for i, f in enumerate(sorted({f for found in chosen.values() for f in found}))}
    if not number:
        return {t: Model() for t in TARGETS}

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(number[f] for f in features(t) if f in number) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(found, pa.list_(pa.int32()))], [*TARGETS, "xs"])

    known = sample.select("text", *[F.col(t).cast("int") for t in TARGETS]).mapInArrow(index, "low int, toxic int, xs array<int>").toArrow()
    xs = known.column("xs").combine_chunks()
    column = xs.flatten().to_numpy().astype(np.int64)
    row = np.repeat(np.arange(known.num_rows), xs.value_lengths().to_numpy())
    models = {t: Model() for t in TARGETS}
    for target, names in chosen.items():
        mine = np.full(len(number), -1)
        mine[[number[f] for f in names]] = np.arange(len(names))
        has = mine[column] >= 0
        bad = known.column(target).to_numpy().astype(float)
        if names:
            w, b = fit_logistic(row[has], mine[column[has]], bad, len(names))
            models[target] = Model(dict(zip(names, w.tolist(), strict=True)), b)
    return models


def evidence(models: dict[str, Model], text: Column) -> Column:
    """Log odds that a document is low or toxic, by its text."""

    @F.pandas_udf("double")
    def odds(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            out = []
            for t in batch:
                found = features(t)
                good = np.prod([1 / (1 + np.exp(m.odds(found))) for m in models.values()])
                out.append(np.log((1 - good) / good) if good < 1 else -30.0)
            yield pd.Series(out, dtype="float64")

    # Called nondeterministic, so that filters on it don't run it a second time.
    return odds.asNondeterministic()(text.cast("string"))


def _sums(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), F.sum("p").alias("s"))


def _strength(groups: DataFrame, mean: str | float) -> float:
    """How many documents' worth the level above counts, by moments: large if its parts hardly differ."""
    m = F.col(mean) if isinstance(mean, str) else F.lit(mean)
    rate = F.col("s") / F.col("n")
    inside = m * (1 - m)
    row = groups.where("n >= 2").agg(
        F.sum(F.col("n") * (rate - m) * (rate - m)).alias("seen"), F.sum(inside).alias("chance"),
        F.sum(F.col("n") * inside).alias("room"), F.count("*").alias("groups"),
    ).first()
    if not row["groups"] or not row["room"]:
        return 100.0
    share = max(0.0, row["seen"] - row["chance"]) / row["room"]  # variance between, as a share of all
    return float(np.clip((1 - share) / share if share else 1e6, 5.0, 1e6))


def site_posteriors(judged: DataFrame) -> DataFrame:
    """_host, _path, n, s, prior, strength for each path, from rows of _host, _path, p (share of being bad).

    A document's own prior is (strength * prior + s - p) / (strength + n - 1).
    """
    paths = written(_sums(judged, "_host", "_path"), "paths")
    hosts = paths.groupBy("_host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    rate = (total["s"] + 0.5) / (total["n"] + 1) if total["n"] else 0.5
    k_host = _strength(hosts, rate)
    hosts = hosts.select(F.col("_host").alias("_h"), ((F.lit(k_host * rate) + F.col("s")) / (F.lit(k_host) + F.col("n"))).alias("prior"))
    paths = paths.join(hosts, F.col("_host").eqNullSafe(F.col("_h"))).drop("_h")
    return paths.withColumns({"strength": F.lit(_strength(paths, "prior")), "rate": F.lit(float(rate))})


def verdict() -> Column:
    """Log odds of a document: its text's, with its site's odds in place of the corpus's."""
    own = 1 / (1 + F.exp(-F.col("_odds")))
    prior = (F.col("strength") * F.col("prior") + F.col("s") - own) / (F.col("strength") + F.col("n") - 1)
    prior = F.least(F.greatest(prior, F.lit(1e-4)), F.lit(1 - 1e-4))
    logit = lambda x: F.log(x / (1 - x))
    return F.col("_odds") + logit(prior) - logit(F.col("rate"))


def _sited(models: dict[str, Model], host: str, path: str) -> list[Column]:
    odds = evidence(models, F.col("text")).alias("_odds")
    return [F.col(host).cast("string").alias("_host"), F.col(path).cast("string").alias("_path"), odds]


def _joined(rows: DataFrame, sites: DataFrame) -> DataFrame:
    other = sites.select(F.col("_host").alias("_h"), F.col("_path").alias("_p"), "n", "s", "prior", "strength", "rate")
    other = other.select("_h", "_p", F.struct("n", "s", "prior", "strength", "rate").alias("_site"))
    return rows.join(other, F.col("_host").eqNullSafe(F.col("_h")) & F.col("_path").eqNullSafe(F.col("_p")))


def _share(odds: Column) -> Column:
    return 1 / (1 + F.exp(-odds))


def classify(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", bound: int = MAX_LABELLED) -> DataFrame:
    """doc_id, host, path, text_odds, site_prior, p_bad and kept of every document."""
    models = fit(docs, labels, bound)
    rows = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_sited(models, host, path)), "evidence")
    sites = site_posteriors(rows.select("_host", "_path", _share(F.col("_odds")).alias("p")))
    judged = _joined(rows, sites).select("doc_id", "_host", "_path", "_odds", "_site.*")
    p_bad = _share(verdict())
    return judged.select(
        "doc_id", F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_odds").alias("text_odds"),
        F.col("prior").alias("host_prior"), p_bad.alias("p_bad"), (p_bad < REJECT_FROM).alias("kept"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", bound: int = MAX_LABELLED) -> DataFrame:
    """The documents that aren't rejected, with all their columns.

    Texts are judged twice, for the sites and for the verdicts, so they need not be written or shuffled.
    """
    models = fit(docs, labels, bound)
    rows = docs.select(whole_row(docs).alias("_row"), *_sited(models, host, path))
    sites = site_posteriors(rows.select("_host", "_path", _share(F.col("_odds")).alias("p")))
    judged = _joined(rows, written(sites, "sites")).select("_row", "_odds", "_site.*")
    return judged.where(_share(verdict()) < REJECT_FROM).select("_row.*")


def op4_empirical_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {"op4_empirical_bayes": (op4_empirical_bayes, None)}
