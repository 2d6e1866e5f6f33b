"""Quality by co-training two views of a document.

The text view reads the text alone (character classes, word shapes, repetition); the metadata view reads the other
columns alone (source, language, stated length). Both are logistic models that start from the labelled rows. In
each of ``ROUNDS`` rounds both views score all unlabelled rows of the table, and each hands every row that it is sure
of, with its predicted label, to the other view, which learns from them beside the labelled ones. A view is sure
above the score from which on ``SURE`` of held-out labelled rows were right; a view without such a score hands over
nothing. After the rounds each view's log odds are calibrated on held-out labelled rows and a last logistic model
combines them; it scores every document.

Texts are read once, to a written table of features. A round is a few passes over that table, which give sums: for
the text view the gradient and curvature of its loss over the rows handed to it (a Newton step each pass), for the
metadata view how many rows of each label it was handed in each of its ``CELLS`` cells. Sums are of whole numbers, so
they don't depend on the order in which tasks end. Rows handed over weigh ``EACH`` of a labelled row, and all of one
label together ``ALL`` times the labelled rows of that label at most. The views that are held out for calibration go
through the same rounds in the same passes.

Only labelled rows are sampled: about ``PER_CLASS`` of either label, by a hash of the id, of rows that share an id
one. They reach the driver as features. Labelled rows beyond the sample count as unlabelled.

Defined cases: a null text counts as empty, null metadata is a value of its own; a null id has no label; without
labels every row scores 0.5 and is kept; with labels of one class only, all rows get about that class' share; an id
labelled both ways counts as good; repeated rows get a row each; an empty table gives an empty result; columns other
than those named are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_below, small_batches, text_or_empty, written
from .linear import Dense, Sparse, fit_logistic, fit_platt, folds, minimise, sigmoid

PER_CLASS = 2_000
#: Rounds, and Newton steps of the text view in each.
ROUNDS, STEPS = 4, 3
#: How often a view must be right where it is sure, and over how many held-out rows at least.
SURE, LEAST_SURE = 0.99, 3
EACH, ALL = 0.25, 1.0
L2 = 2.0
FOLDS = 3
KEEP_AT = 0.5
SOURCES, LANGUAGES, SIZES = 64, 16, 32
CELLS = SOURCES * LANGUAGES * SIZES
#: Sums are kept in this part of one.
UNIT = 4096

_KIND = np.zeros(256, np.int64)
_KIND[list(range(97, 123))] = 1  # lower-case
_KIND[list(range(65, 91))] = 2  # upper-case
_KIND[list(range(48, 58))] = 3  # digits
_KIND[[9, 10, 11, 12, 13, 32]] = 4  # white space
_KIND[[46, 44, 59, 58, 63, 39, 45]] = 5  # usual punctuation
_KIND[128:] = 1
N_TEXT = 16


def text_view(text: str) -> np.ndarray:
    """Features of the text alone."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    n = max(1, len(raw))
    kinds = np.bincount(_KIND, np.bincount(raw, minlength=256), minlength=6) / n
    tokens = text.split()
    distinct = set(tokens)
    m, d = max(1, len(tokens)), max(1, len(distinct))
    lines = text.split("\n")
    sizes = np.fromiter(map(len, distinct), np.int64, len(distinct)) if distinct else np.zeros(1)
    odd = sum(1 for t in distinct if not t.strip(".,;:?'()\"").isalnum()) / d
    upper = sum(1 for t in distinct if len(t) > 1 and t.isupper()) / d
    return np.array(
        [*kinds, d / m, np.log1p(m), len(set(lines)) / len(lines), sizes.mean(), sizes.std(), odd, upper,
         np.log1p(n / len(lines)), text.count(".") / m, len(text) / m / 10]
    )


def meta_view(source: str | None, lang: str | None, n_chars: int | None) -> int:
    """The metadata's cell: hashed source, hashed language, and size in half powers of two."""
    size = 0 if n_chars is None or n_chars < 0 else min(SIZES - 1, 1 + int(np.log2(n_chars + 1) * 2))
    at = lambda x, n: zlib.crc32(str(x).encode("utf-8", "surrogatepass")) % n
    return (at(f"source {source}", SOURCES) * LANGUAGES + at(f"lang {lang}", LANGUAGES)) * SIZES + size


def _of_cells(cells: np.ndarray) -> Sparse:
    """Features of cells: source, language, both, and size."""
    pair, size = cells // SIZES, cells % SIZES
    width = SOURCES + LANGUAGES + SOURCES * LANGUAGES
    col = np.column_stack([pair // LANGUAGES, SOURCES + pair % LANGUAGES, SOURCES + LANGUAGES + pair, width + size]).ravel()
    return Sparse(np.repeat(np.arange(len(cells)), 4), col, np.ones(len(col)), len(cells), width + SIZES)


def _fit_cells(cells: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Log odds of every cell, from weighted rows."""
    x, total = _of_cells(cells), max(1e-9, weight.sum())

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        z = x.dot(w[:-1]) + w[-1]
        e = weight * (sigmoid(z) - y)
        value = weight @ (np.logaddexp(0, z) - y * z) + L2 / 2 * (w[:-1] @ w[:-1])
        return value / total, np.append(x.back(e) + L2 * w[:-1], e.sum()) / total

    w = minimise(loss, np.zeros(x.width + 1), 200)
    return (_of_cells(np.arange(CELLS)).dot(w[:-1]) + w[-1]).astype(np.float32)


class Views:
    """Both views' models, fitted on some labelled rows and then by rounds."""

    def __init__(self, text: np.ndarray, cells: np.ndarray, y: np.ndarray, sure: bool = True):
        self.y, self.cells = y, cells
        self.mean, self.scale = text.mean(0), np.maximum(text.std(0), 1e-3)
        self.z = self._z(text)
        w, b = fit_logistic(Dense(self.z[:, :-1]), y, l2=L2)
        self.w = np.append(w, b)
        self.table = _fit_cells(cells, y, np.ones(len(y)))
        if sure:
            raw, fold = np.zeros((len(y), 2)), folds(len(y), max(2, min(FOLDS, len(y))))
            for k in range(fold.max() + 1):
                out, fit = np.flatnonzero(fold == k), np.flatnonzero(fold != k)
                if len(out) and len(fit):
                    raw[out] = Views(text[fit], cells[fit], y[fit], sure=False).raw(text[out], cells[out])
            self.sure = [(_sure_from(raw[:, v], y == 1), _sure_from(-raw[:, v], y == 0)) for v in (0, 1)]
        self.freeze()

    def _z(self, text: np.ndarray) -> np.ndarray:
        z = np.clip((text - self.mean) / self.scale, -8, 8)
        return np.column_stack([z, np.ones(len(z))])

    def raw(self, text: np.ndarray, cells: np.ndarray) -> np.ndarray:
        return np.column_stack([self._z(text) @ self.w, self.table[cells]])

    def freeze(self) -> None:
        """The models that hand over from now on are those of this moment."""
        self.frozen = self.w.copy(), self.table

    def for_tasks(self) -> tuple:
        return self.mean, self.scale, self.w, self.frozen, self.sure

    def step(self, n: np.ndarray, g: np.ndarray, h: np.ndarray) -> None:
        """A Newton step of the text view: labelled rows, and the sums over rows handed to it, by label."""
        p = sigmoid(self.z @ self.w)
        ridge = np.append(np.full(len(self.w) - 1, L2), 1e-3)
        grad = self.z.T @ (p - self.y) + ridge * self.w * (ridge == L2)
        curve = (self.z * (p * (1 - p))[:, None]).T @ self.z + np.diag(ridge)
        for label in (0, 1):
            s = self.worth(label, n[label])
            grad, curve = grad + s * g[label], curve + s * h[label]
        move = np.linalg.solve(curve, grad)
        self.w = self.w - move * min(1.0, 4 / max(1e-9, np.linalg.norm(move)))

    def worth(self, label: int, n: float) -> float:
        """What a row handed over with this label weighs, when ``n`` are."""
        return min(EACH, ALL * (self.y == label).sum() / n) if n else 0.0

    def refit(self, counts: np.ndarray) -> None:
        """The metadata view again, with rows handed to it: how many of each label are in each cell."""
        cells, y, weight = [self.cells], [self.y], [np.ones(len(self.y))]
        for label in (0, 1):
            at = np.flatnonzero(counts[label])
            cells.append(at)
            y.append(np.full(len(at), float(label)))
            weight.append(counts[label][at] * self.worth(label, counts[label].sum()))
        self.table = _fit_cells(*map(np.concatenate, (cells, y, weight)))


def _sure_from(score: np.ndarray, right: np.ndarray) -> float:
    """The least score, none below even odds, from which on SURE of the rows are right."""
    order = np.argsort(-score, kind="stable")
    share = np.cumsum(right[order]) / np.arange(1, len(score) + 1)
    good = np.flatnonzero(share >= SURE)
    return max(0.0, float(score[order[good[-1]]])) if len(good) and good[-1] + 1 >= LEAST_SURE else np.inf


def sums(views: list[tuple], text: np.ndarray, cells: np.ndarray, count_cells: bool) -> dict[int, int]:
    """Over some unlabelled rows: for each view and label the number, gradient and curvature of the rows that its
    metadata view hands to its text view, and by cell the number that go the other way. Numbers in UNITs, by place
    in one long row of numbers: ``unpack`` tells them apart."""
    out: dict[int, int] = {}
    for t, (mean, scale, w, (old_w, table), sure) in enumerate(views):
        z = np.clip((text - mean) / scale, -8, 8)
        z = np.column_stack([z, np.ones(len(z))])
        by_text, by_meta, d = z @ old_w, table[cells], len(w)
        upper = np.triu_indices(d)
        for label, sign in ((0, -1), (1, 1)):
            mine = z[sign * by_meta >= sure[1][1 - label]]
            if len(mine):
                p = sigmoid(mine @ w)
                found = np.concatenate([[len(mine)], mine.T @ (p - label), ((mine * (p * (1 - p))[:, None]).T @ mine)[upper]])
                at = _place(t, label, d)
                out.update(zip(range(at, at + len(found)), np.rint(found * UNIT).astype(np.int64).tolist(), strict=True))
            if count_cells:
                at, n = np.unique(cells[sign * by_text >= sure[0][1 - label]], return_counts=True)
                out.update(zip((-1 - (t * 2 + label) * CELLS - at).tolist(), (n * UNIT).tolist(), strict=True))
    return out


def _place(t: int, label: int, d: int) -> int:
    return (t * 2 + label) * (1 + d + d * (d + 1) // 2)


def unpack(found: dict[int, int], t: int, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A view's part of the sums: by label the number of rows, gradient, curvature, and counts by cell."""
    n, g, h, counts = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d)), np.zeros((2, CELLS))
    upper = np.triu_indices(d)
    for label in (0, 1):
        at = _place(t, label, d)
        row = np.array([found.get(k, 0) for k in range(at, at + 1 + d + len(upper[0]))]) / UNIT
        n[label], g[label], h[label][upper] = row[0], row[1 : d + 1], row[d + 1 :]
        h[label] = h[label] + np.triu(h[label], 1).T
        low, high = -1 - (t * 2 + label) * CELLS - (CELLS - 1), -1 - (t * 2 + label) * CELLS
        for k, v in found.items():
            if low <= k <= high:
                counts[label][high - k] = v / UNIT
    return n, g, h, counts


class Pool:
    """The written features of all rows; those without a label in the sample are the unlabelled ones."""

    def __init__(self, table: DataFrame):
        self.rows = table.filter("y is null").select("f_text", "cell")

    def sums(self, views: list[tuple], count_cells: bool) -> dict[int, int]:
        shared = self.rows.sparkSession.sparkContext.broadcast(views)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, int] = {}
            for b in batches:
                for k, v in sums(shared.value, _matrix(b.column(0)), b.column(1).to_numpy(), count_cells).items():
                    total[k] = total.get(k, 0) + v
            yield pa.RecordBatch.from_pydict({"k": pa.array(list(total), pa.int64()), "v": pa.array(list(total.values()), pa.int64())})

        # As many rows as there are sums: views by labels by cells at most.
        found = self.rows.mapInArrow(run, "k long, v long").groupBy("k").agg(F.sum("v").alias("v")).collect()
        shared.unpersist()
        return {r["k"]: r["v"] for r in found}


class LocalPool:
    """Unlabelled rows in memory."""

    def __init__(self, text: np.ndarray, cells: np.ndarray):
        self.text, self.cells = text, cells

    def sums(self, views: list[tuple], count_cells: bool) -> dict[int, int]:
        return sums(views, self.text, self.cells, count_cells)


def cotrain(tracks: list[Views], pool: Pool | LocalPool, rounds: int = ROUNDS) -> None:
    """All tracks' views, by rounds of exchange over the pool."""
    for _ in range(rounds):
        for t in tracks:
            t.freeze()
        for k in range(STEPS):
            found = pool.sums([t.for_tasks() for t in tracks], count_cells=k == 0)
            if not found:
                return
            for i, t in enumerate(tracks):
                n, g, h, counts = unpack(found, i, len(t.w))
                t.step(n, g, h)
                if k == 0:
                    t.refit(counts)


class Combined:
    """Both views, their calibration, and the model that combines their log odds."""

    def __init__(self, text: np.ndarray, cells: np.ndarray, y: np.ndarray, pool: Pool | LocalPool):
        self.empty = not len(y)
        if self.empty:
            return
        fold, held = folds(len(y), FOLDS), []
        for k in range(FOLDS):
            if (fold == k).any() and (fold != k).any():
                held.append((np.flatnonzero(fold == k), Views(text[fold != k], cells[fold != k], y[fold != k])))
        self.views = Views(text, cells, y)
        cotrain([self.views, *(v for _, v in held)], pool)
        raw = np.zeros((len(y), 2))
        for out, v in held:
            raw[out] = v.raw(text[out], cells[out])
        self.platt = [fit_platt(raw[:, v], y) for v in (0, 1)]
        self.w, self.b = fit_logistic(Dense(self._odds(raw) / 4), y, l2=0.05)

    def _odds(self, raw: np.ndarray) -> np.ndarray:
        return np.clip(np.column_stack([a * raw[:, v] + b for v, (a, b) in enumerate(self.platt)]), -12, 12)

    def score(self, text: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Columns: calibrated text view, calibrated metadata view, combined."""
        if self.empty or not len(text):
            return np.full((len(text), 3), 0.5)
        z = self._odds(self.views.raw(text, cells))
        return np.column_stack([sigmoid(z), sigmoid(z / 4 @ self.w + self.b)])


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f4").reshape(-1, N_TEXT).astype(np.float64)


def features(docs: DataFrame, chosen: DataFrame | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, sampled label, text view and cell; written, so that texts are read once."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"), F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"), F.col("n_chars").cast("long").alias("n_chars"),
    )
    rows = rows.withColumn("y", F.lit(None).cast("int")) if chosen is None else rows.join(F.broadcast(chosen), "doc_id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [text_view(t).astype("<f4").tobytes() for t in b.column(2).to_pylist()]
            cell = [meta_view(*r) for r in zip(*(b.column(k).to_pylist() for k in (3, 4, 5)), strict=True)]
            yield pa.RecordBatch.from_pydict({"doc_id": b.column(0), "y": b.column(1), "f_text": pa.array(text, pa.binary()), "cell": pa.array(cell, pa.int32())})

    rows = rows.select("doc_id", "y", "text", "source", "lang", "n_chars")
    return written(rows.mapInArrow(run, "doc_id long, y int, f_text binary, cell int"), "quality-features")


def label_sample(labels: DataFrame, label: str, id_col: str) -> DataFrame | None:
    """(doc_id, y) of about PER_CLASS rows of either label, by a hash of the id: fit to broadcast. None without any."""
    marks = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).filter("y in (0, 1) and doc_id is not null")
    counts = {r["y"]: r["n"] for r in marks.groupBy("y").agg(F.count("*").alias("n")).collect()}
    pick = F.lit(False)
    for y, n in sorted(counts.items()):
        pick = pick | ((F.col("y") == y) & hash_below(F.col("doc_id"), PER_CLASS / n, "label sample"))
    return marks.filter(pick).groupBy("doc_id").agg(F.max("y").alias("y")) if counts else None


def fit(table: DataFrame) -> Combined:
    """The model, from the written features of all rows."""
    one = table.filter("y is not null").groupBy("doc_id").agg(F.min_by(F.struct("y", "f_text", "cell"), F.xxhash64("f_text", "cell")).alias("r"))
    found = sorted(one.select("doc_id", "r.y", "r.f_text", "r.cell").collect(), key=lambda r: r["doc_id"])
    text = np.frombuffer(b"".join(r["f_text"] for r in found), "<f4").reshape(-1, N_TEXT).astype(np.float64)
    return Combined(text, np.array([r["cell"] for r in found], dtype=np.int64), np.array([r["y"] for r in found], dtype=np.float64), Pool(table))


SCHEMA = "doc_id long, p_text double, p_meta double, quality double, keep boolean"


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, both views' calibrated probabilities of good quality, the combined one, and whether to keep it."""
    small_batches(docs.sparkSession)
    table = features(docs, label_sample(labels, "quality", id_col), id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(fit(table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            p = model.score(_matrix(b.column(1)), b.column(2).to_numpy())
            yield pa.RecordBatch.from_pydict(
                {"doc_id": b.column(0), "p_text": pa.array(p[:, 0]), "p_meta": pa.array(p[:, 1]), "quality": pa.array(p[:, 2]), "keep": pa.array(p[:, 2] >= KEEP_AT)}
            )

    return table.select("doc_id", "f_text", "cell").mapInArrow(run, SCHEMA)
