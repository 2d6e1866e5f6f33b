"""Language ID, toxicity and quality: held-out accuracy on made-up text, and the defined cases."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import language_id, linear, quality, toxicity, words

from .conftest import ODD

SYLLABLES = {"aa": "ka to mi ra ne".split(), "bb": "sch ung ver ach ein".split(), "cc": "ção inho lha ões mente".split()}


def prose(rng, lang, n=60):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def speech():
    rng = random.Random(4)
    return [(i, prose(rng, lang), lang, f"s{i % 3}") for i, lang in enumerate(rng.choices(list(SYLLABLES), k=300))]


def test_language_of_held_out_rows(docs, speech):
    rows = [*speech, (1000, None, "aa", "s"), (1001, "12 34 !!", "aa", "s"), (1002, "", None, "s"), (None, "kato mira", "aa", "s")]
    got = {r.doc_id: r for r in language_id.identify(docs(rows, extra=("score", "lang_pred"))).collect()}
    assert len(got) == len(rows)
    for i, _, lang, _ in speech:
        r = got[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and r.lang_pred == lang and 0 <= r.score <= 1
    for i in (1000, 1001, 1002):
        assert (got[i].lang_pred, got[i].score, got[i].accepted) == ("und", 0.0, False)
    assert got[None].held_out is False and got[None].lang_pred == "aa"
    assert np.mean([got[i].accepted for i, *_ in speech]) > 0.98


def test_language_without_labels_and_rows(docs):
    df = docs([(1, "text here", None, "s"), (2, "more", None, "s")])
    assert {(r.lang_pred, r.score) for r in language_id.identify(df).collect()} == {("und", 0.0)}
    assert language_id.identify(df.limit(0)).count() == 0


def test_held_out_rows_teach_nothing(docs, speech):
    """Wrong labels on held-out rows change no prediction."""
    lie = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else lang, s) for i, t, lang, s in speech]
    a, b = ({r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(docs(x)).collect()} for x in (speech, lie))
    assert a == b


def test_long_texts_are_read_whole(monkeypatch, speech):
    model = language_id.train([(lang, t) for _, t, lang, _ in speech])
    long = " ".join(t for _, t, lang, _ in speech if lang == "bb")
    want = model.scores([long])[0]
    monkeypatch.setattr(language_id, "CHUNK", 500)
    got = model.scores([long])[0]
    assert np.allclose(got, want, atol=1e-6) and model.predict([long])[0] == ["bb"]


OTHER = "zu pli qua vex dor wy jem fro gul pax".split()


def test_rejection(docs, speech):
    """Texts of a language that wasn't learned go; those of two learned languages, and single words, stay."""
    rng = random.Random(11)
    foreign = [(2000 + k, " ".join("".join(rng.choice(OTHER) for _ in range(rng.randint(1, 4))) for _ in range(60)), None, "s") for k in range(40)]
    noise = [(3000 + k, " ".join("".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(7)) for _ in range(60)), None, "s") for k in range(40)]
    mixed = [(4000 + k, prose(rng, "aa", 30) + " " + prose(rng, "bb", 30), None, "s") for k in range(40)]
    short = [(5000 + k, prose(rng, "cc", 1), None, "s") for k in range(40)]
    got = {r.doc_id: r.accepted for r in language_id.identify(docs([*speech, *foreign, *noise, *mixed, *short])).collect()}
    assert not any(got[i] for i, *_ in foreign + noise)
    assert all(got[i] for i, *_ in mixed + short)


def test_left_out_languages(speech):
    """Trained without a language, its texts are rejected."""
    for out in SYLLABLES:
        model = language_id.train([(lang, t) for _, t, lang, _ in speech if lang != out])
        assert not model.predict([t for _, t, lang, _ in speech if lang == out])[2].any()
        assert model.predict([t for _, t, lang, _ in speech if lang != out])[2].mean() > 0.99


def test_repeated_ids_teach_once(docs, speech):
    rows = [(1, f"kato mira {k}", "aa", "s") for k in range(500)] + speech
    found = language_id.labelled_sample(docs(rows), F.lit(True), "text", "lang", "doc_id")
    assert sum(t.startswith("kato mira ") for _, t in found) <= 1 and len(found) <= len({i for i, *_ in rows})


def test_odd_rows_of_language_id(docs, speech):
    df = docs([*ODD, *speech], extra=("lang_pred", "accepted"))
    kept = language_id.keep_accepted(df)
    assert kept.columns == df.columns and kept.limit(0).count() == 0
    assert language_id.keep_accepted(df.limit(0)).count() == 0


def test_keep_accepted(docs, speech):
    rows = [*speech[:60], (1000, None, "aa", "s"), (1001, "12 34 !!", "aa", "s")]
    df = docs(rows)
    kept = language_id.keep_accepted(df)
    ids = {r.doc_id for r in kept.collect()}
    assert kept.columns == df.columns and not ids & {1000, 1001} and len(ids) >= 59


BAD = ["idiot", "moron", "trash", "vile", "scum"]


def talk(n, seed):
    """(id, text, toxic): every fifth text has bad words, some of them only with an ending."""
    rng, out = random.Random(seed), []
    for i in range(n):
        t, toxic = prose(rng, "aa", 80).split(), i % 5 == 0
        for _ in range(3 if toxic else 0):
            t.insert(rng.randrange(len(t)), rng.choice(BAD) + rng.choice(["", ",", "ic"]))
        out.append((i, " ".join(t), int(toxic)))
    return out


def test_toxicity_of_unlabelled_rows(spark, docs):
    rows = talk(600, 1)
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows if i < 400], "doc_id long, quality int, toxic int")
    df = docs([(i, t, "en", "s") for i, t, _ in rows], extra=("toxic", "p_toxic"))
    got = {r.doc_id: r for r in toxicity.classify(df, labels).collect()}
    held = [(got[i].toxic, bool(y)) for i, _, y in rows if i >= 400]
    assert sum(a and not b for a, b in held) == 0 and sum(a and b for a, b in held) >= 0.95 * sum(b for _, b in held)
    assert all(0 <= got[i][c] <= 1 for i in got for c in ("p_severe", "p_explicit", "p_toxic"))


def test_chain_feeds_earlier_categories():
    """The second category equals the first where words say nothing of it: only the chain can tell."""
    rng = np.random.default_rng(0)
    texts = [("bad " if k % 2 else "good ") + " ".join(f"w{rng.integers(50)}" for _ in range(10)) for k in range(200)]
    first = np.arange(200) % 2 == 1
    chain = toxicity.train_chain(texts, {"first": first, "second": first})
    assert len(chain.earlier[1]) == 1 and chain.earlier[1][0] > 0
    p = chain.scorer()(texts)
    assert ((p[:, 1] > 0.5) == first).all()


def test_grades_come_from_other_folds():
    """A word that only one toxic text has says nothing of that text; words of many do."""
    rows = talk(400, 9)
    texts, y = [t for _, t, _ in rows], np.array([y for *_, y in rows])
    texts[0] = prose(random.Random(1), "aa", 40) + " lonely solitary unique"
    got = toxicity.categories(words.Bags.of(texts), y)
    assert list(got) == list(toxicity.CATEGORIES) and (got["toxic"] == (y == 1)).all()
    assert not got["explicit"][0] and not (got["severe"] & ~got["explicit"]).any() and not (got["explicit"] & ~got["toxic"]).any()
    assert got["explicit"].sum() > 0.5 * y.sum()


def test_toxic_words_far_into_a_text(spark, docs):
    """Whole texts are learned from and scored, however long; an id's rows teach once."""
    rng = random.Random(21)
    rows = [(i, prose(rng, "aa", 4_000) + (" idiot moron trash vile scum" if i % 4 == 0 else "") + prose(rng, "aa", 50)) for i in range(120)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(80)], "doc_id long, quality int, toxic int")
    df = docs([(i, t, "en", "s") for i, t in rows] + [(3, "kato mira", "en", "s")] * 50)
    got = {r.doc_id: r.toxic for r in toxicity.classify(df, labels).collect()}
    assert all(got[i] == (i % 4 == 0) for i in range(80, 120))
    assert toxicity.labelled_sample(df, labels)[0].n == 80


def test_minimise_finds_the_least():
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(300, 5)), (rng.random(300) < 0.4).astype(float)
    w, b = linear.fit_logistic(linear.Dense(x), y, l2=1.0)
    p = linear.sigmoid(x @ w + b)
    assert np.abs(x.T @ (p - y) + w).max() < 1e-3 and abs((p - y).sum()) < 1e-3


def test_scorer_equals_training_rows():
    rows = talk(200, 3)
    texts, y = [t for _, t, _ in rows], np.array([y for *_, y in rows])
    chain = toxicity.train_chain(texts, {"toxic": y.astype(bool)})
    link = toxicity.Link(words.Bags.of(texts), np.zeros((200, 0)), y.astype(float))
    slope, shift = chain.platt[0]
    want = linear.sigmoid(slope * link.raw(words.Bags.of(texts), np.zeros((200, 0))) + shift)
    assert np.allclose(chain.scorer()(texts)[:, 0], want)


def test_toxicity_defined_cases(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.classify(docs(ODD), none).collect()
    assert len(got) == len(ODD) and not any(r.toxic for r in got if r.p_toxic < 0.5)
    one = spark.createDataFrame([(5, 1, 0), (7, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert not any(r.toxic for r in toxicity.classify(docs(ODD), one).collect())
    assert toxicity.classify(docs(ODD).limit(0), one).count() == 0


def pages(n, seed):
    """(id, text, source, quality): junk is loud and comes mostly from one source."""
    rng, out = random.Random(seed), []
    for i in range(n):
        junk = rng.random() < 0.25
        t = prose(rng, "aa")
        if junk:
            t = " ".join(w.upper() + "!!" for w in t.split()) if i % 2 else " ".join(w + "$$$" for w in t.split())
        out.append((i, t, "spam" if rng.random() < (0.9 if junk else 0.05) else "press", int(not junk)))
    return out


def test_quality_of_unlabelled_rows(spark, docs):
    rows = pages(500, 2)
    labels = spark.createDataFrame([(i, y, 0) for i, _, _, y in rows if i % 4 == 0], "doc_id long, quality int, toxic int")
    df = docs([(i, t, "en", s) for i, t, s, _ in rows], extra=("quality", "keep"))
    got = {r.doc_id: r for r in quality.classify(df, labels).collect()}
    right = [got[i].keep == bool(y) for i, _, _, y in rows if i % 4]
    assert np.mean(right) > 0.97
    assert all(got[i].keep for i, _, _, y in rows if y) or np.mean([got[i].keep for i, _, _, y in rows if y]) > 0.98


def two_views(n=600, seed=5):
    """A strong text view, and metadata that tell as much but of which a few labelled rows show little."""
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n).astype(float)
    text = np.column_stack([y * 4 + rng.normal(size=n), rng.normal(size=(n, 3))])
    source = np.where(rng.random(n) < 0.95, y, 1 - y).astype(int) * 20 + rng.integers(0, 20, n)
    cells = (source * quality.LANGUAGES + 3) * quality.SIZES + rng.integers(0, 8, n)
    few = np.concatenate([np.flatnonzero(y == 0)[:8], np.flatnonzero(y == 1)[:8]])
    return text, cells, y, few, np.setdiff1d(np.arange(n), few)


def test_cotraining_helps_the_weaker_view():
    """With a few labelled rows, a view learns from what the other is sure of."""
    text, cells, y, few, rest = two_views()
    hits = []
    for rounds in (0, 4):
        views = quality.Views(text[few], cells[few], y[few])
        quality.cotrain([views], quality.LocalPool(text[rest], cells[rest]), rounds)
        hits.append(((views.raw(text[rest], cells[rest])[:, 1] > 0) == (y[rest] > 0)).mean())
    assert hits[1] > hits[0] + 0.1


def test_rounds_against_all_rows_at_once():
    """One round's text view is what a fit of labelled and handed-over rows together gives."""
    text, cells, y, few, rest = two_views()
    views = quality.Views(text[few], cells[few], y[few])
    views.sure = [views.sure[0], (0.5, 0.5)]
    given = views.table[cells[rest]]
    on, off = rest[given >= 0.5], rest[given <= -0.5]
    quality.STEPS, steps = 30, quality.STEPS
    quality.cotrain([views], quality.LocalPool(text[rest], cells[rest]), 1)
    quality.STEPS = steps
    x = views._z(np.concatenate([text[few], text[on], text[off]]))
    t = np.concatenate([y[few], np.ones(len(on)), np.zeros(len(off))])
    u = np.concatenate([np.ones(len(few)), np.full(len(on), min(0.25, 8 / len(on))), np.full(len(off), min(0.25, 8 / len(off)))])
    grad = x.T @ (u * (linear.sigmoid(x @ views.w) - t)) + np.append(quality.L2 * views.w[:-1], 0)
    assert np.abs(grad).max() < 0.01


def test_passes_equal_memory(spark):
    """Sums over the written table are those over the rows in memory, however they are dealt."""
    rng = np.random.default_rng(3)
    text, cells, y = rng.normal(size=(300, quality.N_TEXT)).astype("<f4"), rng.integers(0, quality.CELLS, 300), rng.integers(0, 2, 300).astype(float)
    views = quality.Views(text[:40].astype(float), cells[:40], y[:40])
    views.sure = [(0.1, 0.1), (0.0, 0.0)]
    rows = [(k, int(y[k]) if k < 40 else None, text[k].tobytes(), int(cells[k])) for k in range(300)]
    want = quality.LocalPool(text[40:].astype(float), cells[40:]).sums([views.for_tasks()], True)
    for parts in (1, 5):
        df = spark.createDataFrame(rows, "doc_id long, y int, f_text binary, cell int").repartition(parts)
        got = quality.Pool(df).sums([views.for_tasks()], True)
        assert set(got) == set(want) and all(abs(got[k] - want[k]) <= parts for k in want)


def test_null_and_repeated_ids_of_labels(spark, docs):
    rows = pages(200, 3)
    df = docs([(i, t, "en", s) for i, t, s, _ in rows] + [(None, "no id", "en", "s")] * 30 + [(-1, "minus one", "en", "s")] + [(1, "x y z", "en", "s")] * 30)
    labels = spark.createDataFrame([(i, y, 0) for i, _, _, y in rows] + [(-1, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    table = quality.features(df, quality.label_sample(labels, "quality", "doc_id"))
    assert table.filter("doc_id is null and y is not null").count() == 0 and table.filter("doc_id = -1 and y = 0").count() == 1
    out = quality.classify(df, labels)
    assert out.count() == 261


def test_quality_defined_cases(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.classify(docs(ODD), none).collect()
    assert len(got) == len(ODD) and {(r.quality, r.keep) for r in got} == {(0.5, True)}
    one = spark.createDataFrame([(5, 1, 0), (7, 1, 0), (8, None, 0)], "doc_id long, quality int, toxic int")
    assert all(r.keep for r in quality.classify(docs(ODD), one).collect())
    assert quality.classify(docs(ODD).limit(0), one).count() == 0
