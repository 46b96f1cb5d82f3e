"""Quality rules as weak supervision: rules vote or abstain, and their accuracies are estimated.

Each rule looks at one signal of a whole text and votes good, bad, or not at all. Expectation
maximisation estimates, for each rule, how often it votes good on good documents and bad
on bad ones, and the share of good documents, with no labels. It needs the documents only
as counts of voting patterns: at most three to the power of the rules, whatever the corpus, added
up by the workers. The posterior of a pattern then holds for all its documents, and replaces the
demand that all rules pass.

Rules are taken to err independently within a class of documents, with a rate of their own for good, bad and no
vote. Bad documents come in kinds that different rules notice: a page of symbols passes every rule but one. With
a single class of bad documents such a rule could not be told from one that is often wrong, so models with one bad
class, two, and so on are fitted, begun from the rules that notice most documents others don't, as long as the Bayesian information criterion
improves. Where one bad class explains the votes, that is the model.

Which classes are bad follows from the votes as well: the one that holds documents without a bad vote is good, and
of several others those on which some rule votes bad more often than not are bad. Accuracies of bad
documents are over all their kinds. Beta priors of a few documents hold the estimates where votes are few.

Defined cases: a null or empty text has no words and all signals 0; rows are judged by
themselves, whatever their doc_id; an empty table gives no rows; further columns are not read by ``judge``
and are kept by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.llm.shared import documents, whole_row, written

MIN_WORDS = 20
WINDOW = 8
MAX_REPEATED_PERCENT = 30
SYMBOLS = b"#*$%&|<>"
KEEP_FROM = 0.5
#: Votes good, none and bad that each rule is believed to have cast before any is seen, on good and on bad documents.
PRIOR_GOOD, PRIOR_BAD = (9.0, 1.0, 1.0), (2.0, 1.0, 2.0)

SIGNALS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_letters long, n_capitals long"

#: Rules: signal as a ratio, votes good up to the first bound (from it on, if it is the larger one), bad beyond the second.
RULES = {
    "length": ("n_words", None, 50, 20),
    "long_words": ("word_chars", "n_words", 10, 14),
    "short_words": ("word_chars", "n_words", 3, 2),
    "symbols": ("n_symbols", "n_words", 0.05, 0.1),
    "repeated_lines": ("n_dup_lines", "n_lines", 0.1, 0.5),
    "repeated_words": ("n_repeat_words", "n_words", 0.1, 0.3),
    "capitals": ("n_capitals", "n_letters", 0.2, 0.4),
    "letters": ("n_letters", "word_chars", 0.7, 0.5),
}

_SPACES = bytes([32, *range(9, 14)])
_HASH = np.uint64(0x9E3779B97F4A7C15)


def repeated_words(words: np.ndarray, window: int = WINDOW) -> int:
    """Words (as numbers) in windows found at least twice, first ones included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    # Windows that differ in a hash differ; only texts with equal hashes are looked at exactly.
    mixed = (words.astype(np.uint64) + np.uint64(1)) * _HASH
    mixed ^= mixed >> np.uint64(29)
    rolled = np.zeros(n, np.uint64)
    for k in range(window):
        rolled = rolled * np.uint64(0x100000001B3) + mixed[k : n + k]
    if len(np.unique(rolled)) == n:
        return 0
    rank, width = words, 1
    while width < window:  # ranks of windows twice as long from pairs of ranks
        step = min(width, window - width)
        pairs = rank[: len(rank) - step].astype(np.int64) * (int(rank.max()) + 1) + rank[step:]
        rank, width = np.unique(pairs, return_inverse=True)[1], width + step
    twice = np.bincount(rank)[rank] > 1
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, np.flatnonzero(twice), 1)
    np.add.at(covered, np.flatnonzero(twice) + window, -1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def signals_of(text: str | None) -> tuple[int, ...]:
    """Signals of one whole text, in the order of SIGNALS."""
    if not text:
        return (0,) * 8
    raw = text.encode()
    words = raw.split()
    spaces = len(raw) - len(raw.translate(None, _SPACES))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    letters = sum(map(str.isalpha, text)) if not text.isascii() else len(raw) - len(raw.translate(None, _LETTERS))
    capitals = sum(map(str.isupper, text)) if not text.isascii() else len(raw) - len(raw.translate(None, _CAPITALS))
    return (
        len(words), len(text) - spaces, len(raw) - len(raw.translate(None, SYMBOLS)), len(lines) - len(set(lines)),
        repeated_words(ids) if len(number) < len(words) else 0, len(lines), letters, capitals,
    )


_CAPITALS = bytes(range(65, 91))
_LETTERS = _CAPITALS + bytes(range(97, 123))


def signals(text: Column) -> Column:
    """Struct of the signals. Called nondeterministic, so that filters on it don't run it a second time."""

    @F.pandas_udf(SIGNALS)
    def measured(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in SIGNALS.split(", ")]
        for batch in texts:
            yield pd.DataFrame([signals_of(t) for t in batch], columns=names, dtype="int64")

    return measured.asNondeterministic()(text.cast("string"))


def vote(rule: str, s: str) -> Column:
    """1 for good, -1 for bad, 0 for neither; ``s`` names the struct of signals."""
    top, below, good, bad = RULES[rule]
    value = F.try_divide(F.col(f"{s}.{top}").cast("double"), F.col(f"{s}.{below}") if below else F.lit(1))
    is_good, is_bad = (value <= good, value > bad) if good < bad else (value >= good, value < bad)
    return F.when(is_good, 1).when(is_bad, -1).otherwise(0)


def pattern(s: str) -> Column:
    """All votes as one string of +, - and 0."""
    return F.concat(*[F.element_at(F.array(F.lit("-"), F.lit("0"), F.lit("+")), vote(r, s) + 2) for r in RULES])


def base_failed(s: str) -> Column:
    words = F.col(f"{s}.n_words")
    return (words < MIN_WORDS) | (100 * F.col(f"{s}.n_repeat_words") > MAX_REPEATED_PERCENT * words)


class Accuracies:
    """Share of good documents; of each rule, the share of good votes on good and of bad votes on bad documents, where it votes.

    ``shares`` and ``votes`` (vote, class, rule) describe all classes, ``good`` says which are good.
    """

    def __init__(self, shares: np.ndarray, votes: np.ndarray):
        self.shares, self.votes = shares, votes
        self.good = (votes[2] < 0.5).all(axis=1)
        self.good[0] = True
        if len(shares) == 2:
            self.good[1] = False
        self.share = float(shares[self.good].sum())
        self.on_good, self.on_bad = self._right(0, self.good), self._right(2, ~self.good)

    def _right(self, vote: int, classes: np.ndarray) -> np.ndarray:
        cast = np.einsum("c,vcr->vr", self.shares[classes], self.votes[:, classes])
        return cast[vote] / (cast[0] + cast[2])

    def likelihoods(self, votes: np.ndarray) -> np.ndarray:
        """Logarithm of the probability of each class with each pattern."""
        return np.log(self.shares) + sum((votes == v) @ np.log(p).T for v, p in zip((1, 0, -1), self.votes, strict=True))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return _shares(self.likelihoods(votes))[0][:, self.good].sum(axis=1)


def _shares(likelihoods: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each class's share of its row, and the logarithm of the row's sum."""
    top = likelihoods.max(axis=1, keepdims=True)
    each = np.exp(likelihoods - top)
    total = each.sum(axis=1, keepdims=True)
    return each / total, (top + np.log(total))[:, 0]


def _fitted(votes: np.ndarray, counts: np.ndarray, held: np.ndarray, rounds: int) -> tuple[Accuracies, float]:
    """Expectation maximisation from ``held``, the classes' shares of each pattern; the model and its criterion."""
    is_vote = [(votes == v).astype(float) for v in (1, 0, -1)]
    n_classes = held.shape[1]
    prior = np.array([PRIOR_GOOD] + [PRIOR_BAD] * (n_classes - 1)).T[:, :, None]
    before = -np.inf
    for _ in range(rounds):
        weight = counts[:, None] * held
        seen = np.stack([weight.T @ x for x in is_vote]) + prior
        model = Accuracies((weight.sum(axis=0) + 1) / (counts.sum() + n_classes), seen / seen.sum(axis=0))
        held, each = _shares(model.likelihoods(votes))
        now = float(counts @ each)
        if now - before < 1e-9 * counts.sum():
            break
        before = now
    parameters = 2 * n_classes * votes.shape[1] + n_classes - 1
    return model, parameters * np.log(max(2.0, counts.sum())) - 2 * now


def _begun(bad: np.ndarray, rules: list[int]) -> np.ndarray:
    """Shares of a good class and of a bad one for each of ``rules``: documents with a bad vote begin as bad, of the kinds that these rules notice."""
    mine, any_bad = bad[:, rules], bad.any(axis=1)
    kinds = np.where(mine.any(axis=1)[:, None], mine / np.maximum(mine.sum(axis=1), 1)[:, None], 1 / len(rules))
    is_bad = np.where(any_bad, 0.9, 0.1)[:, None]
    return np.column_stack([1 - is_bad, is_bad * kinds])


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = 2000) -> Accuracies:
    """The model of voting patterns with the best criterion; classes are added while that improves."""
    n_rules = votes.shape[1]
    if not len(counts):
        beliefs = np.array([PRIOR_GOOD, PRIOR_BAD]).T[:, :, None] * np.ones(n_rules)
        return Accuracies(np.array([0.5, 0.5]), beliefs / beliefs.sum(axis=0))
    bad = votes < 0
    best, criterion = _fitted(votes, counts, _begun(bad, list(range(n_rules))) @ _merged(n_rules), rounds)
    rules, since = _noticing(bad, counts), 0
    for n_kinds in range(2, len(rules) + 1):
        model, found = _fitted(votes, counts, _begun(bad, rules[:n_kinds]), rounds)
        if found < criterion:
            best, criterion, since = model, found, 0
        elif (since := since + 1) == 2:
            break
    return best


def _noticing(bad: np.ndarray, counts: np.ndarray) -> list[int]:
    """Rules in the order of how many documents they alone, of those before them, vote bad on."""
    out, left = [], counts.copy()
    while len(out) < bad.shape[1] and (alone := left @ bad).max() > 0:
        out.append(int(alone.argmax()))
        left[bad[:, out[-1]]] = 0
    return out


def _merged(n_rules: int) -> np.ndarray:
    """Adds up the kinds of ``_begun`` to one bad class."""
    return np.vstack([[1, 0], np.tile([0, 1], (n_rules, 1))]).astype(float)


def pattern_posteriors(spark: SparkSession, patterns: DataFrame) -> DataFrame:
    """pattern, posterior from pattern, n: at most 3 ** rules rows, which come to the driver."""
    rows = [(r["pattern"], r["n"]) for r in patterns.collect()]
    votes = np.array([[{"+": 1, "-": -1, "0": 0}[c] for c in p] for p, _ in rows], np.int64).reshape(len(rows), len(RULES))
    posterior = estimate(votes, np.array([n for _, n in rows], float)).posterior(votes)
    return spark.createDataFrame([(p, float(x)) for (p, _), x in zip(rows, posterior, strict=True)], "pattern string, posterior double")


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, the signals, base_failed, posterior and kept of every document."""
    measured = docs.select(F.col("doc_id").cast("long").alias("doc_id"), signals(F.col("text")).alias("s"))
    measured = measured.select("doc_id", "s").withColumns({"pattern": pattern("s"), "base_failed": base_failed("s")})
    measured = written(measured, "signals")
    counts = measured.groupBy("pattern").agg(F.count("*").alias("n"))
    known = pattern_posteriors(docs.sparkSession, counts)
    rows = measured.join(F.broadcast(known), "pattern")  # at most 3 ** rules rows
    names = [c.split()[0] for c in SIGNALS.split(", ")]
    kept = (~F.col("base_failed") & (F.col("posterior") >= KEEP_FROM)).alias("kept")
    return rows.select("doc_id", *[F.col(f"s.{c}") for c in names], "base_failed", "posterior", kept)


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns.

    Signals are taken twice, for the counts and for the verdicts, so texts need not be written or joined.
    """
    measured = docs.select(whole_row(docs).alias("row"), signals(F.col("text")).alias("s"))
    counts = measured.select(pattern("s").alias("pattern")).groupBy("pattern").agg(F.count("*").alias("n"))
    known = pattern_posteriors(docs.sparkSession, counts).where(F.col("posterior") >= KEEP_FROM)
    passed = measured.where(~base_failed("s")).withColumn("pattern", pattern("s"))
    return passed.join(F.broadcast(known.select("pattern")), "pattern", "leftsemi").select("row.*")


def op3_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir))


QUERIES = {"op3_weak_supervision": (op3_weak_supervision, None)}
