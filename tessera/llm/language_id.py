"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text's vector is the mean embedding of its hashed 2-, 3- and 4-grams of lower-cased letters (a word's edge counts
as a character; grams don't cross words). Embeddings and softmax are trained by stochastic gradient descent in
numpy on a bounded sample: about ``PER_LANGUAGE`` labelled rows of each of the ``MOST_LANGUAGES`` most frequent
languages at most, of each a slice of at most ``SLICE`` characters; of rows that share an id one. A fifth of the
sample is kept out of training and sets the softmax' temperature and two thresholds:

- how usual a text's grams are: the mean, over its grams, of the log share that a gram has in the language that has
  it most. Kept-out texts and their beginnings show how low that falls in learned languages, and each language's
  texts, by the shares of the others alone, how high it rises in a language that wasn't learned. The threshold lies
  halfway between, where there is room; where there is none, learned languages' texts stay.
- how flat the softmax may be: no flatter than for kept-out texts joined from two languages or more, so that a text
  of several languages stays.

``REJECT_SHARE`` of kept-out rows may fall below either. A text below one of them is rejected.

At prediction embeddings times softmax weights is one small table (buckets x languages), which is broadcast, so a
whole text costs a table look-up a gram. Rows aren't shuffled.

Defined cases: a null text or one without letters is ``und`` with score 0, and rejected; without any labelled row
all are; repeated rows get a row each; a null id is never learned from and not held out; an empty table gives an
empty result; columns other than those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_below, small_batches, text_or_empty

BUCKET_BITS = 16
DIMENSIONS = 16
PER_LANGUAGE, MOST_LANGUAGES = 400, 1_000
SLICE = 3_000
EPOCHS = 4
RATE = 0.4
REJECT_SHARE = 0.001
#: Part of the texts in languages left out that the threshold should lie above; labels are wrong for some of the rest, and
#: some are of several languages.
LEFT_OUT_SHARE = 0.9
#: Grams that a text is taken to have beside its own, as usual as training's: one odd word is no other language.
BENEFIT = 40
#: Words of a beginning by which the thresholds are set, beside whole texts.
BEGINNING = 8
UNDETERMINED = "und"
#: Characters handled at once; bounds a worker's memory for long texts.
CHUNK = 1 << 18

_MIX = np.uint32(0x9E3779B1)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all grams of the texts, and where each text's begin (with the end appended)."""
    joined = "\n" + "\n".join(texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    c = np.where(letter, codes, np.uint32(32))
    edges = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    found, at = [], []
    for n in (2, 3, 4):
        m = len(c) - n + 1
        if m <= 0:
            continue
        h = np.full(m, n, np.uint32)
        for k in range(n):
            h = (h ^ c[k : k + m]) * _MIX
            h ^= h >> np.uint32(15)
        valid = letter[1 : 1 + m].copy()
        if n == 2:
            valid |= letter[:m]
        for k in range(2, n - 1):
            valid &= letter[k : k + m]
        where = np.flatnonzero(valid)
        found.append((h[where] * _MIX >> np.uint32(32 - BUCKET_BITS)).astype(np.int32))
        at.append(np.searchsorted(where, edges))
    parts = [f[a[i] : a[i + 1]] for i in range(len(texts)) for f, a in zip(found, at, strict=True)]
    sizes = np.array([len(p) for p in parts], dtype=np.int64).reshape(len(texts), -1).sum(1)
    return np.concatenate(parts) if parts else np.zeros(0, np.int32), np.concatenate([[0], np.cumsum(sizes)])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


class Model:
    """What prediction needs: languages, the gram table (its last column tells how usual a gram is), intercepts,
    temperature, how usual grams are on average, and thresholds."""

    def __init__(self, languages: list[str], grams_to_scores: np.ndarray, intercepts: np.ndarray, temperature: float = 1.0):
        self.languages, self.table, self.intercepts, self.temperature = languages, grams_to_scores, intercepts, temperature
        self.usual, self.least_usual, self.least_top = 0.0, -np.inf, 0.0

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log scores of each whole text, how many grams it has, and how usual these are together. Long texts
        are summed by chunks that end between words."""
        sums, n = np.zeros((len(texts), self.table.shape[1])), np.zeros(len(texts), np.int64)
        batch, owner, held = [], [], 0

        def add() -> None:
            buckets, begin = grams(batch)
            total = np.zeros((len(buckets) + 1, self.table.shape[1]))
            np.cumsum(self.table[buckets], axis=0, out=total[1:])
            np.add.at(sums, owner, total[begin[1:]] - total[begin[:-1]])
            np.add.at(n, owner, np.diff(begin))

        for i, text in enumerate(texts):
            for piece in _chunks(text.lower()):
                batch.append(piece)
                owner.append(i)
                held += len(piece)
                if held >= CHUNK:
                    add()
                    batch, owner, held = [], [], 0
        if batch:
            add()
        return sums[:, :-1] / np.maximum(n, 1)[:, None] + self.intercepts, n, sums[:, -1]

    def judge(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Softmax, number of grams, and how usual they are on average, of each text."""
        z, n, total = self.scores(texts)
        return _softmax(z / self.temperature), n, self.average(total, n)

    def average(self, total: np.ndarray, n: np.ndarray) -> np.ndarray:
        return (total + BENEFIT * self.usual) / (n + BENEFIT)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and whether it is accepted, of each text."""
        if not texts or not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        p, n, usual = self.judge(texts)
        best, top = p.argmax(1), p.max(1)
        names = [self.languages[i] if k else UNDETERMINED for i, k in zip(best, n, strict=True)]
        return names, np.where(n > 0, top, 0.0), (n > 0) & (usual >= self.least_usual) & (top >= self.least_top)


def _chunks(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > CHUNK:
        cut = text.rfind(" ", at, at + CHUNK)
        cut = at + CHUNK if cut <= at else cut
        yield text[at:cut]
        at = cut
    yield text[at:]


def train(rows: list[tuple[str, str]], seed: int = 7) -> Model:
    """Fit on (language, text) rows."""
    rows = sorted(set(rows))
    languages = sorted({lang for lang, _ in rows})
    if not languages:
        return Model([], np.zeros((1 << BUCKET_BITS, 1), np.float32), np.zeros(0))
    rng = np.random.default_rng(seed)
    rows = [rows[i] for i in rng.permutation(len(rows))]
    y = np.array([languages.index(lang) for lang, _ in rows])
    bags, sizes = [], []
    for _, text in rows:
        buckets, _ = grams([text.lower()])
        ids, n = np.unique(buckets, return_counts=True)
        bags.append((ids, n / max(1, n.sum())))
        sizes.append(n.sum())
    kept_out = np.arange(len(rows)) % 5 == 0 if len(rows) >= 20 else np.zeros(len(rows), bool)
    learn = np.flatnonzero(~kept_out)
    counts = np.bincount(y[learn], minlength=len(languages))
    weight = len(learn) / np.maximum(1, counts) / len(languages)
    emb = rng.normal(0, 0.1, (1 << BUCKET_BITS, DIMENSIONS))
    w, b = rng.normal(0, 0.1, (DIMENSIONS, len(languages))), np.zeros(len(languages))
    steps, step = EPOCHS * len(learn), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(learn):
            ids, part = bags[i]
            if not len(ids):
                continue
            rate = RATE * (1 - step / steps)
            step += 1
            x = part @ emb[ids]
            g = _softmax(x @ w + b)
            g[y[i]] -= 1
            g *= min(weight[y[i]], 10.0)
            back = w @ g
            w -= rate * np.outer(x, g)
            b -= rate * 0.1 * g
            # A mean's gradient is spread over its grams; scaling by their number keeps rare grams learning.
            emb[ids] -= rate * np.minimum(part * len(ids), 5.0)[:, None] * back
    share = np.full((len(languages), 1 << BUCKET_BITS), 0.5)
    for i in learn:
        share[y[i], bags[i][0]] += bags[i][1] * sizes[i]
    share = np.log(share / share.sum(1, keepdims=True))
    model = Model(languages, np.column_stack([emb @ w, share.max(0)]).astype(np.float32), b)
    known = [share.max(0)[bags[i][0]] @ bags[i][1] for i in learn if sizes[i]]
    model.usual = float(np.mean(known)) if known else 0.0
    held = np.flatnonzero(kept_out)
    if len(held):
        calibrate(model, [rows[i][1] for i in held], y[held], share, rng)
    return model


def calibrate(model: Model, texts: list[str], y: np.ndarray, share: np.ndarray, rng: np.random.Generator) -> None:
    """Sets temperature and thresholds by kept-out texts; ``share`` has each gram's log share in each language."""
    z, n, total = model.scores(texts)
    loss = lambda t: -np.log(np.maximum(_softmax(z / t)[np.arange(len(y)), y], 1e-12)).mean()
    model.temperature = float(min(np.geomspace(0.05, 20, 60), key=loss))
    begin = [" ".join(t.split()[:BEGINNING]) for t in texts]
    _, n_begin, total_begin = model.scores(begin)
    inside = np.concatenate([model.average(total, n)[n > 0], model.average(total_begin, n_begin)[n_begin > 0]])
    if not len(inside):
        return
    low, left_out = float(np.quantile(inside, REJECT_SHARE)), []
    for k in np.unique(y) if len(share) > 1 else ():
        others = np.delete(share, k, axis=0).max(0)
        for t in (t for t, v in zip(texts, y, strict=True) if v == k):
            buckets, _ = grams([t.lower()])
            if len(buckets):
                left_out.append(model.average(others[buckets].sum(), len(buckets)))
    high = float(np.quantile(left_out, LEFT_OUT_SHARE)) if left_out else -np.inf
    model.least_usual = low if not left_out or high >= low else (low + high) / 2
    mixed, by = [], [np.flatnonzero(y == k) for k in np.unique(y)]
    for _ in range(2 * len(texts) if len(by) > 1 else 0):
        some = rng.permutation(len(by))[: rng.integers(2, min(len(by), 4) + 1)]
        mixed.append(" ".join(texts[rng.choice(by[k])] for k in some))
    p, n, _ = model.judge([*texts, *mixed])
    if (n > 0).any():
        model.least_top = float(np.quantile(p.max(1)[n > 0], REJECT_SHARE))


def labelled_sample(docs: DataFrame, usable: Column, text_col: str, lang_col: str, id_col: str) -> list[tuple[str, str]]:
    """About PER_LANGUAGE labelled rows of each language, chosen by a hash of the id; one of those that share it."""
    known = docs.filter(usable & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    known = known.select(F.col(lang_col).cast("string").alias("lang"), F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    counts = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES).collect()
    if not counts:
        return []
    most = {}
    for r in counts:  # as many numbers as languages
        most.setdefault(min(1.0, PER_LANGUAGE / r["n"]), []).append(r["lang"])
    pick = F.lit(False)
    for fraction, languages in sorted(most.items()):
        pick = pick | (F.col("lang").isin(languages) & hash_below(F.col("id"), fraction, "language sample"))
    start = F.pmod(F.xxhash64("id"), F.greatest(F.lit(1), F.char_length("text") - SLICE + 1)) + 1
    rows = known.filter(pick).select("id", "lang", F.substr("text", start.cast("int"), F.lit(SLICE)).alias("text"))
    one = rows.groupBy("id").agg(F.min_by(F.struct("lang", "text"), F.xxhash64("lang", "text")).alias("r"))
    return [(r["lang"], r["text"]) for r in one.select("r.lang", "r.text").collect()]


SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, accepted boolean"


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> Model:
    return train(labelled_sample(docs, ~held_out(id_col) & F.col(id_col).isNotNull(), text_col, lang_col, id_col))


def identify(docs: DataFrame, model: Model | None = None, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> DataFrame:
    """Per row: id, whether it was kept from training, predicted language, score, and whether it is accepted."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs, text_col, lang_col, id_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            names, p, accepted = m.predict(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0),
                    "held_out": batch.column(1),
                    "lang_pred": pa.array(names, pa.string()),
                    "score": pa.array(p, pa.float64()),
                    "accepted": pa.array(accepted, pa.bool_()),
                }
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), text_or_empty(text_col).alias("text")).mapInArrow(run, SCHEMA)


def keep_accepted(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose language is accepted, with all their columns."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, text_col, lang_col, id_col))

    @F.pandas_udf("boolean")
    def accepted(texts):
        import pandas as pd

        return pd.Series(shared.value.predict(texts.tolist())[2])

    return docs.filter(accepted(text_or_empty(text_col)))
