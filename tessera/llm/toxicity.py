"""Toxicity by a classifier chain.

Categories are predicted in sequence, each by a linear model over hashed word features and the probabilities of
the categories before it. In training those earlier probabilities are out-of-fold predictions, so a later model
sees them as wrong as they will be on new texts. Word features are chosen by their evidence in the training part
of each fold. Fitted on a bounded sample of labelled rows (about ``PER_CLASS`` of either class, by a hash of the
id; of rows that share an id one), whose whole texts are turned into features on the executors; prediction reads
every whole text, without a shuffle.

``labels`` has one toxic label; ``CATEGORIES`` grades it: ``severe`` (toxic, with three distinct words of strong
evidence or more), ``explicit`` (toxic, with one). Which words are strong is learned from the other folds' rows,
so that no row's grade comes from its own label.

Defined cases: a null or empty text has no word features and gets the models' intercepts; rows without a label
aren't learned from; an id labelled both ways counts as toxic; if the labels hold one class only, its share is every
row's probability; repeated rows get a row each; an empty table gives an empty result; columns other than those
named are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .common import hash_below, small_batches, text_or_empty
from .linear import Sparse, fit_logistic, fit_platt, folds, logit, sigmoid
from .words import Bags

PER_CLASS = 2_500
FOLDS, STEPS = 5, 300
FEATURES = 2_000
#: A feature is used if it is in so many texts of a class at least, and its log odds have so many standard errors.
LEAST_TEXTS, LEAST_EVIDENCE = 4, 3.0
#: The decision threshold is the lowest at which this share of held-out decisions is right.
PRECISION = 0.99

#: Log odds from which a word's evidence is strong, and how many such words make a text severe.
STRONG, SEVERE_WORDS = 3.0, 3
CATEGORIES = ("severe", "explicit", "toxic")


def _evidence(bags: Bags, y: np.ndarray) -> dict[int, float]:
    """Feature -> log odds of its presence in positive texts, for the features with the most evidence."""
    if not bags.n or y.min() == y.max():
        return {}
    pos = np.bincount(bags.col, y[bags.row], minlength=1 << words.BITS)
    neg = np.bincount(bags.col, minlength=1 << words.BITS) - pos
    a, b, n, m = pos + 0.5, neg + 0.5, y.sum(), len(y) - y.sum()
    odds = np.log(a / (n - pos + 0.5)) - np.log(b / (m - neg + 0.5))
    z = np.abs(odds) / np.sqrt(1 / a + 1 / b)
    use = np.flatnonzero((np.maximum(pos, neg) >= LEAST_TEXTS) & (z >= LEAST_EVIDENCE))
    order = use[np.lexsort((use, -z[use]))][:FEATURES]
    return {int(f): float(odds[f]) for f in order}


class Link:
    """One model of the chain: weights of word features and of earlier categories' log odds, intercept, calibration."""

    def __init__(self, bags: Bags, earlier: np.ndarray, y: np.ndarray):
        self.chosen = np.array(sorted(_evidence(bags, y)), np.int64)
        self.slope, self.shift = 1.0, 0.0
        w, self.b = fit_logistic(self._rows(bags, earlier), y, l2=1.0, steps=STEPS)
        self.words = dict(zip(self.chosen.tolist(), w[: len(self.chosen)], strict=True))
        self.earlier = w[len(self.chosen) :]

    def _rows(self, bags: Bags, earlier: np.ndarray) -> Sparse:
        k, m = len(self.chosen), earlier.shape[1]
        at = np.full(1 << words.BITS, -1)
        at[self.chosen] = np.arange(k)
        col = at[bags.col]
        on = col >= 0
        row = np.concatenate([bags.row[on], np.repeat(np.arange(bags.n), m)])
        return Sparse(row, np.concatenate([col[on], np.tile(k + np.arange(m), bags.n)]), np.concatenate([bags.val[on], earlier.ravel() / 4]), bags.n, k + m)

    def raw(self, bags: Bags, earlier: np.ndarray) -> np.ndarray:
        return self._rows(bags, earlier).dot(np.append([self.words[f] for f in self.chosen.tolist()], self.earlier)) + self.b


class Chain:
    """Fitted links in order, ready to score texts."""

    def __init__(self, names: list[str], links: list[Link], threshold: float):
        self.names, self.threshold = names, threshold
        self.shift = np.array([x.b for x in links])
        self.platt = [(x.slope, x.shift) for x in links]
        self.earlier = [x.earlier for x in links]
        merged: dict[int, np.ndarray] = {}
        for k, x in enumerate(links):
            for f, w in x.words.items():
                merged.setdefault(f, np.zeros(len(links)))[k] = w
        self.weights = merged

    def scorer(self) -> Callable[[list[str]], np.ndarray]:
        tokens = words.TokenWeights(self.weights, len(self.names))

        def score(texts: list[str]) -> np.ndarray:
            raw = np.array([tokens.score(t) for t in texts]).reshape(len(texts), len(self.names)) + self.shift
            p = np.zeros_like(raw)
            for k, (slope, shift) in enumerate(self.platt):
                z = raw[:, k] + (logit(p[:, :k]) / 4) @ self.earlier[k]
                p[:, k] = sigmoid(slope * z + shift)
            return p

        return score


def train_chain(texts: list[str], targets: dict[str, np.ndarray]) -> Chain:
    """Fit the chain; ``targets`` gives the categories in order. The last one's decisions set the threshold."""
    return train_on(Bags.of(texts), targets)


def train_on(bags: Bags, targets: dict[str, np.ndarray]) -> Chain:
    n = bags.n
    fold = folds(n, FOLDS)
    earlier, links, names = np.zeros((n, 0)), [], list(targets)
    held = np.zeros(n)
    for name in names:
        y, raw = targets[name].astype(float), np.zeros(n)
        for k in range(FOLDS):
            out = np.flatnonzero(fold == k)
            fit = np.flatnonzero(fold != k)
            link = Link(bags.take(fit), earlier[fit], y[fit])
            raw[out] = link.raw(bags.take(out), earlier[out])
        link = Link(bags, earlier, y)
        link.slope, link.shift = fit_platt(raw, y)
        held = sigmoid(link.slope * raw + link.shift)
        earlier = np.column_stack([earlier, logit(held)])
        links.append(link)
    return Chain(names, links, _threshold(held, targets[names[-1]].astype(float)) if n else 0.5)


def _threshold(p: np.ndarray, y: np.ndarray) -> float:
    order = np.argsort(-p, kind="stable")
    right = np.cumsum(y[order]) / np.arange(1, len(p) + 1)
    good = np.flatnonzero(right >= PRECISION)
    if not len(good) or not y.any():
        return 0.5
    last = good[-1]
    below = p[order[last + 1]] if last + 1 < len(p) else 0.0
    return float(np.clip((p[order[last]] + below) / 2, 0.2, 0.8))


def categories(bags: Bags, toxic: np.ndarray) -> dict[str, np.ndarray]:
    """The chain's targets, from the one label: how many strong words a row has, by what the other folds' rows say."""
    on, strong, fold = toxic.astype(bool), np.zeros(bags.n, np.int64), folds(bags.n, FOLDS, seed=1)
    for k in range(FOLDS):
        rows, others = np.flatnonzero(fold == k), np.flatnonzero(fold != k)
        found = _evidence(bags.take(others), toxic[others].astype(float)) if len(others) else {}
        telling = np.zeros(1 << words.BITS, bool)
        telling[[f for f, odds in found.items() if odds > STRONG and f % 2 == 0]] = True
        part = bags.take(rows)
        strong[rows] = np.bincount(part.row[telling[part.col]], minlength=len(rows))
    return {"severe": on & (strong >= SEVERE_WORDS), "explicit": on & (strong >= 1), "toxic": on}


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str = "toxic", text_col: str = "text", id_col: str = "doc_id") -> tuple[Bags, np.ndarray]:
    """Features and labels of about PER_CLASS rows of either class, chosen by a hash of the id, in order of id."""
    marks = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).filter("y in (0, 1) and doc_id is not null")
    counts = {r["y"]: r["n"] for r in marks.groupBy("y").agg(F.count("*").alias("n")).collect()}
    pick = F.lit(False)
    for y, n in sorted(counts.items()):
        pick = pick | ((F.col("y") == y) & hash_below(F.col("doc_id"), PER_CLASS / n, "label sample"))
    chosen = marks.filter(pick).groupBy("doc_id").agg(F.max("y").alias("y"))  # about 2 * PER_CLASS rows: fit to broadcast
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).join(F.broadcast(chosen), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[int]] = {}
        for b in batches:
            found = [words.bag(t, known) for t in b.column(1).to_pylist()]
            cols, vals = ([x[k].astype(t).tobytes() for x in found] for k, t in ((0, "<i4"), (1, "<u2")))
            yield pa.RecordBatch.from_pydict({"doc_id": b.column(0), "y": b.column(2), "col": pa.array(cols, pa.binary()), "val": pa.array(vals, pa.binary())})

    found = rows.select("doc_id", "text", "y").mapInArrow(run, "doc_id long, y int, col binary, val binary")
    one = found.groupBy("doc_id").agg(F.min_by(F.struct("y", "col", "val"), F.xxhash64("col", "val")).alias("r"))
    got = sorted(one.select("doc_id", "r.y", "r.col", "r.val").collect(), key=lambda r: r["doc_id"])
    bags = [(np.frombuffer(r["col"], "<i4").astype(np.int32), np.frombuffer(r["val"], "<u2").astype(np.float32)) for r in got]
    return Bags.join(bags), np.array([r["y"] for r in got], dtype=int)


def fit(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> Chain:
    bags, y = labelled_sample(docs, labels, "toxic", text_col, id_col)
    return train_on(bags, categories(bags, y))


SCHEMA = "doc_id long, " + ", ".join(f"p_{c} double" for c in CATEGORIES) + ", toxic boolean"


def classify(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row: id, each category's probability, and the decision on the last."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, text_col, id_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = shared.value
        score = chain.scorer()
        for batch in batches:
            p = score(batch.column(1).to_pylist())
            columns = {"doc_id": batch.column(0)} | {f"p_{c}": pa.array(p[:, k], pa.float64()) for k, c in enumerate(chain.names)}
            yield pa.RecordBatch.from_pydict(columns | {"toxic": pa.array(p[:, -1] >= chain.threshold, pa.bool_())})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).mapInArrow(run, SCHEMA)
