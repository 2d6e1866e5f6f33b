"""The n-gram join against all pairs."""

import random
import re
import tempfile
import time
from pathlib import Path

import numpy as np
import pytest

from tessera.llm import components, ngram_join
from tessera.llm.ngram_join import need, prefix_length, sketch, sketch_join, tree_join
from tessera.sources.scratch import _CLEANUP, written

from .conftest import ODD

components_decide = ngram_join.decide


def all_pairs(rows, n=4, share=85):
    """id -> (size, component), by comparing every two documents."""
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        grams = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
        sets.setdefault(i, []).append(grams)
    first = {i: i for i in sets}

    def find(x):
        while first[x] != x:
            x = first[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            for a in sets[i]:
                for b in sets[j]:
                    if a and b and 100 * len(a & b) >= share * len(a | b):
                        u, v = find(i), find(j)
                        first[max(u, v)] = min(u, v)
    return {(i, len(g)): find(i) for i in ids for g in sets[i]}


def corpus(seed, families=8, copies=8, words=60):
    """Families of near copies that also share a passage with others, and single texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    passage = [word() for _ in range(20)]
    rows, i = [], 0
    for _ in range(families):
        base = [word() for _ in range(rng.randint(10, words))]
        if rng.random() < 0.5:
            base[5:5] = passage
        for _ in range(copies):
            t = list(base)
            for _ in range(rng.randint(0, 3)):
                t[rng.randrange(len(t))] = word()
            rows.append((i, " ".join(t).title() if rng.random() < 0.3 else " ".join(t), "en", "s"))
            i += 1
    return rows


def test_tree_join_is_exact():
    rng = random.Random(3)
    for _ in range(150):
        bases = [rng.sample(range(200), rng.randint(1, 60)) for _ in range(5)]

        def near():
            s = set(rng.choice(bases))  # noqa: B023
            for _ in range(rng.randint(0, 6)):
                s ^= {rng.randrange(200)}
            return np.array(sorted(s or {1}), np.int64)

        a, b = [near() for _ in range(10)], [near() for _ in range(10)]
        na, nb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
        want = {(i, j) for i in range(10) for j in range(10) if len(np.intersect1d(a[i], b[j])) >= need(len(a[i]), len(b[j]))}
        assert {(i, int(j)) for i, ok, _ in tree_join(a, na, b, nb) for j in ok} == want
        cut = lambda s: [x[: prefix_length(len(x))] for x in s]
        assert want <= {(i, int(j)) for i, ok, _ in tree_join(cut(a), na, cut(b), nb) for j in ok}


def test_sketches_lose_no_link():
    """Of sets of all sizes, also where counts are full or sketches differ in length; unlike sets are told apart."""
    rng = np.random.default_rng(8)
    for size in (1, 7, 60, 127, 500, 1000):
        bases = [rng.integers(0, 1 << 58, size) for _ in range(4)] + [np.arange(size, dtype=np.int64) << 20]

        def near():
            s = bases[rng.integers(5)]  # noqa: B023
            s = s[rng.random(len(s)) > rng.choice([0, 0.05, 0.12])]
            return np.unique(np.append(s, rng.integers(0, 1 << 58, rng.integers(1, 2 + size // 8))))  # noqa: B023

        a, b = [near() for _ in range(20)], [near() for _ in range(20)]
        na, nb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
        want = {(i, j) for i in range(20) for j in range(20) if len(np.intersect1d(a[i], b[j])) >= need(len(a[i]), len(b[j]))}
        got = {(int(i), j) for j, found in sketch_join([sketch(x) for x in a], na, [sketch(x) for x in b], nb) for i in found}
        assert want <= got and (size < 500 or len(got) < 200)


def test_far_rows_do_not_multiply(docs, monkeypatch):
    """A class goes to Python once under each crowded n-gram, with a sketch that is much smaller than its prefix."""
    held, rng = [], random.Random(6)
    passage = [f"p{k}" for k in range(40)]
    rows = [(i, " ".join([*passage, *(f"w{rng.random()}" for _ in range(200))]), "en", "s") for i in range(40)]
    monkeypatch.setattr(ngram_join, "fit_order", lambda *a: ngram_join.Order(np.zeros(0, np.uint64), np.zeros(0), 1.0))
    monkeypatch.setattr(ngram_join, "discard", lambda *a: None)
    monkeypatch.setattr(ngram_join, "written", lambda df, name, real=ngram_join.written: held.append((name, out := real(df, name))) or out)
    assert ngram_join.components(docs(rows)).filter("component_id <> doc_id").count() == 0
    (crowds,) = (df for name, df in held if name == "n-gram-crowds")
    (classes,) = (df for name, df in held if name == "n-gram-classes")
    assert classes.filter("length(sketch) > 8 * size(prefix) / 4").count() == 0
    seen = []
    monkeypatch.setattr(type(crowds), "mapInArrow", lambda df, *a, real=type(crowds).mapInArrow: seen.append(df) or real(df, *a))
    ngram_join.far_pairs(crowds, classes.select("id", "sketch"))
    assert crowds.count() > 0 and seen[-1].count() == crowds.count()


@pytest.mark.parametrize("whole", [True, False])
def test_far_pairs_come_once(spark, whole):
    """However many crowded n-grams a pair shares; pairs well below the threshold don't come at all."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 58, 300)
    near = [np.append(base[5:], rng.integers(0, 1 << 58, 5)) for _ in range(6)]
    unlike = [np.append(base[35:], rng.integers(0, 1 << 58, 35)) for _ in range(6)]
    sets = dict(enumerate(near + unlike))
    sketches = spark.createDataFrame([(i, bytearray(sketch(s).tobytes())) for i, s in sets.items()], "id long, sketch binary")
    # Sets lack some n-grams, so first ones differ from pair to pair.
    rows = [(g, i, 300, g % 12 != i, i, whole) for g in range(20) for i in sets if (g + i) % 5]
    crowds = spark.createDataFrame(rows, "gram long, id long, n int, minor boolean, c long, whole boolean")
    got = [(r.a, r.b) for r in ngram_join.far_pairs(crowds, sketches).collect()]
    assert sorted(got) == [(a, b) for a in range(6) for b in range(a + 1, 6)]


def test_shuffle_files_go(spark):
    """A table that has been written leaves no shuffle files, and the session's settings as they were."""
    held = lambda: set(Path(tempfile.gettempdir()).glob("blockmgr-*/*/shuffle_*.data"))
    before, was, until = held(), spark.conf.get(_CLEANUP, None), time.monotonic() + 10
    out = written(spark.range(1000).selectExpr("id % 100 AS k").groupBy("k").count(), "few")
    while held() - before and time.monotonic() < until:  # Spark removes them beside the query
        time.sleep(0.1)
    assert not held() - before and spark.conf.get(_CLEANUP, None) == was and out.count() == 100


def test_need_is_the_share():
    for n in range(1, 60):
        for m in range(1, 60):
            k = need(n, m)
            linked = lambda c: 100 * c >= 85 * (n + m - c)  # noqa: B023, E731
            assert linked(k) and not linked(k - 1)


@pytest.mark.parametrize("near, block, group", [(32, 1024, 20_000), (1, 2, 20_000), (2, 3, 2)])
def test_components_equal_all_pairs(docs, monkeypatch, near, block, group):
    """Small limits drive the far pairs, blocks and salts that large groups need."""
    monkeypatch.setattr(ngram_join, "NEAR", near)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "GROUP", group)
    rows = corpus(near + block)
    got = {(r.doc_id, r.n_shingles): r.component_id for r in ngram_join.components(docs(rows)).collect()}
    assert got == all_pairs([(i, t) for i, t, *_ in rows])


@pytest.mark.parametrize("near", [1, 32])
def test_groups_of_near_copies(docs, monkeypatch, near):
    """Large groups of near copies, with and without the rounds that link most of them, beside a shared passage."""
    monkeypatch.setattr(ngram_join, "NEAR", near)
    monkeypatch.setattr(ngram_join, "PICK_SHARE", 0.25 if near == 32 else 9)
    rows = corpus(77, families=3, copies=70, words=80)
    got = {(r.doc_id, r.n_shingles): r.component_id for r in ngram_join.components(docs(rows)).collect()}
    assert got == all_pairs([(i, t) for i, t, *_ in rows])


def test_pairs_grow_with_the_group(docs, spark, monkeypatch):
    """A group of m near copies is linked by about m pairs, not m * m."""
    decided = []
    monkeypatch.setattr(ngram_join, "decide", lambda pairs, *a: decided.append(pairs.count()) or real(pairs, *a))
    real = components_decide
    rng = random.Random(4)
    base = [f"w{k}" for k in range(120)]
    for m in (60, 120):
        decided.clear()
        rows = []
        for i in range(m):  # some edited once, which are linked, and some so often that they aren't
            t = list(base)
            for k in range(1 if i % 2 else 6):
                t[rng.randrange(120)] = f"e{i}.{k}"
            rows.append((i, " ".join(t), "en", "s"))
        got = ngram_join.components(docs(rows)).collect()
        assert {r.component_id for r in got if r.doc_id % 2} == {1} and sum(decided) <= 3 * m


def test_ids_of_several_texts(docs):
    """An id's rows share a component, so they join those of their texts."""
    a, b, c = ("alpha beta gamma delta one", "other words stand here now", "third text of its own here")
    rows = [(3, a, "en", "s"), (4, a, "en", "s"), (4, b, "en", "s"), (9, b, "en", "s"), (12, c, "en", "s"), (12, c, "en", "s")]
    got = {(r.doc_id, r.component_id) for r in ngram_join.components(docs(rows)).collect()}
    assert got == {(3, 3), (4, 3), (9, 3), (12, 12)}
    kept = ngram_join.keep_one(docs([(1, a, "en", "s"), (1, b, "en", "s"), (1, b, "en", "s"), (1, " ", "en", "s"), (1, " ", "en", "s")], extra=("gone", "a", "id", "row")))
    assert sorted(r.text for r in kept.collect()) == sorted([a, b, " ", " "])


def test_odd_rows(docs):
    got = ngram_join.components(docs(ODD, extra=("n", "name", "component"))).collect()
    assert len(got) == len(ODD)
    want = all_pairs([(i, t) for i, t, *_ in ODD if i is not None])
    for r in got:
        assert r.component_id == (want[r.doc_id, r.n_shingles] if r.doc_id is not None else None)
    assert ngram_join.components(docs(ODD).limit(0)).count() == 0


def test_one_of_each_stays(docs):
    rows = corpus(5)
    want = {c for c in all_pairs([(i, t) for i, t, *_ in rows]).values()}
    df = docs(rows)
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == want
    again = ngram_join.keep_one(docs(ODD)).collect()
    assert sorted(r.doc_id for r in again if r.doc_id is not None) == [1, 2, 3, 4, 5, 7, 8, 9, 10]
    assert sum(r.doc_id is None for r in again) == 1


def test_connected(spark):
    rng = random.Random(2)
    links = [(k, k + 1) for k in range(40)] + [(100 + rng.randrange(30), 100 + rng.randrange(30)) for _ in range(25)] + [(7, 7)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.id: r.component for r in components.connected(df).collect()}
    first = {x: x for e in links for x in e}
    for _ in range(60):
        for a, b in links:
            first[a] = first[b] = min(first[a], first[b])
    assert got == {x: c for x, c in first.items() if any(x in e and e[0] != e[1] for e in links)}
    assert components.connected(df.limit(0)).count() == 0


def test_few_links_are_joined_at_once(spark, monkeypatch):
    """Without rounds, and as the stars do."""
    rng = random.Random(12)
    df = spark.createDataFrame([(rng.randrange(-90, 90), rng.randrange(-90, 90)) for _ in range(110)] + [(k, k + 1) for k in range(200, 240)], "a long, b long")
    monkeypatch.setattr(components, "FEW", 0)
    stars = sorted(map(tuple, components.connected(df).collect()))
    monkeypatch.undo()
    monkeypatch.setattr(components, "_large_star", None)
    assert sorted(map(tuple, components.connected(df).collect())) == stars
