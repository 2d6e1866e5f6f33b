"""Targets, exact quotas, shards, and texts of the mix."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import mixing

from .conftest import ODD


def size(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def shares(sizes, weights=(5, 2, 1), cap=3):
    """Targets by sharing the excess again until no source is above its cap. ``sizes`` in order of source."""
    w = {s: weights[k % 3] for k, s in enumerate(sizes)}
    target, free, left = {}, set(sizes), float(sum(sizes.values()))
    while free:
        total = sum(w[s] for s in free)
        over = [s for s in free if left * w[s] / total > cap * sizes[s]]
        if not over:
            target |= {s: left * w[s] / total for s in free}
            break
        for s in over:
            target[s] = float(cap * sizes[s])
            left -= target[s]
            free.discard(s)
    return target


def corpus(rng, n=300):
    return [(i, " ".join(["w"] * int(rng.integers(0, 700))), "en", f"s{int(rng.integers(0, 5)) ** 2 // 3}" if i % 11 else None) for i in range(n)]


@pytest.fixture(scope="module")
def mixed(docs):
    rows = corpus(np.random.default_rng(7))
    return rows, mixing.taken_per_document(*mixing.plan(docs(rows, extra=("size", "taken")))).collect()


def test_targets_and_sizes(mixed):
    rows, got = mixed
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += size(t)
    ordered = {s: sizes[s] for s in sorted((s for s in sizes if s is not None), key=lambda s: s.encode())} | {None: sizes[None]}
    want, source = shares(ordered), {i: s for i, _, _, s in rows}
    assert len(got) == len(rows)
    taken = Counter()
    for r in got:
        s = source[r.doc_id]
        assert r.size == size(rows[r.doc_id][1]) and r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= mixing.BLOCK_WORDS / 2 + 1


def test_reruns_agree(mixed, docs):
    rows, got = mixed
    again = mixing.taken_per_document(*mixing.plan(docs(rows[::-1]))).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_shards_split_the_quotas(docs, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_BLOCKS", 16)
    monkeypatch.setattr(mixing, "CELL_BLOCKS", 8)
    rows = corpus(np.random.default_rng(1), 120)
    sized, aims, drawn = mixing.plan(docs(rows))
    found = drawn.collect()
    per = Counter(r.shard for r in found)
    assert set(per) == set(range(len(per))) and len(per) & (len(per) - 1) == 0 and max(per.values()) - min(per.values()) <= len(per).bit_length()
    assert max(Counter((r.doc_id, r.tie, r.sid, r.block, r["pass"]) for r in found).values()) == 1  # blocks of a pass are drawn once
    target = {r.sid: r.target for r in aims.collect()}
    words = Counter()
    for r in found:
        words[r.sid] += r.words
    assert all(abs(words[s] - target[s]) <= mixing.BLOCK_WORDS / 2 + 1 for s in target)


def test_hypergeometric(spark):
    cases = [(400_000, 200_000, 200_000), (100, 30, 40), (20_000, 9_000, 7_000), (10, 10, 3), (10, 0, 3), (7, 3, 7), (1_000_000, 5, 500_000)]
    for n, k, m in cases:
        x = spark.range(2_000).select(mixing.hypergeometric(F.lit(n), F.lit(k), F.lit(m), F.col("id")).alias("x")).toPandas()["x"]
        p, sd = k / n, (m * (k / n) * (1 - k / n) * (n - m) / max(1, n - 1)) ** 0.5
        assert x.min() >= max(0, m - n + k) and x.max() <= min(k, m)
        assert abs(x.mean() - m * p) <= 5 * sd / 2_000**0.5 + 1e-9 and abs(x.std() - sd) <= 0.1 * sd + 1e-9


def test_hypergeometric_is_exact(spark):
    """Every term of a distribution whose deviation is large: shares of draws against exact probabilities."""
    from math import comb

    n, k, m, draws = 6_000, 3_000, 3_000, 40_000  # a deviation of 19
    x = spark.range(draws).select(mixing.hypergeometric(F.lit(n), F.lit(k), F.lit(m), F.col("id")).alias("x")).groupBy("x").count().collect()
    p = {r.x: comb(k, r.x) * comb(n - k, m - r.x) / comb(n, m) for r in x}
    chi = sum((r["count"] - draws * p[r.x]) ** 2 / (draws * p[r.x]) for r in x if draws * p[r.x] >= 8)
    bins = sum(draws * v >= 8 for v in p.values())
    assert abs(chi - bins) < 5 * (2 * bins) ** 0.5


def test_the_tree_decides(docs, monkeypatch):
    """With another split of the quotas the results are that split's."""
    rows = corpus(np.random.default_rng(5), 100)
    df = docs(rows)
    own = mixing.taken_per_document(*mixing.plan(df)).collect()
    given = {}

    def last_first(quotas, depth, seed):
        q = quotas.first().q
        given.update({2**depth - 1: q} | {leaf: [0] * len(q) for leaf in range(2**depth - 1)})
        return df.sparkSession.createDataFrame(sorted(given.items()), "leaf long, q array<long>")

    monkeypatch.setattr(mixing, "split_quotas", last_first)
    other = mixing.taken_per_document(*mixing.plan(df)).collect()
    place = lambda found: {(r.doc_id, x.shard) for r in found for x in r.by_shard}
    assert len({s for _, s in place(own)}) == mixing.LEAST_SHARDS and {s for _, s in place(other)} == {max(given)}


def test_repeated_rows_and_clashing_names(docs):
    rows = [(1, "a b c d", lang, "s") for lang in ("en", "de", "en")] + [(2, "e f g", "en", "t"), (None, None, None, None), (3, " ", "en", "t")]
    names = ("id", "_id", "tie", "size", "turn", "turns", "pieces", "shard", "slot", "row")
    df = docs(rows, extra=names)
    a, b = (sorted(map(str, mixing.mixed_documents(x).collect())) for x in (df, docs(rows[::-1], extra=names)))
    assert a == b and mixing.mixed_documents(df).columns == df.columns
    assert mixing.mixed_documents(df.limit(0)).count() == 0


def test_odd_rows(docs):
    got = mixing.taken_per_document(*mixing.plan(docs(ODD))).collect()
    assert len(got) == len(ODD)
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert [r.taken for r in by[1]] == [0] and [r.size for r in by[8]] == [20_000]
    assert len(by[4]) == 2 and all(r.taken <= 3 * r.size for r in got)
    assert mixing.taken_per_document(*mixing.plan(docs(ODD).limit(0))).count() == 0


def test_texts_of_the_mix(docs):
    rows = [(i, " ".join(f"d{i}w{k}" for k in range(n)), "en", s) for i, (n, s) in enumerate([(900, "a"), (700, "b"), (2000, "c"), (40, "c"), (0, "a")])]
    df = docs(rows, extra=("size", "block"))
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    seen = Counter()
    for r in out.collect():
        original = rows[r.doc_id][1].split()
        place = {w: k for k, w in enumerate(original)}
        at = [place[w] for w in r.text.split()]
        assert at == sorted(at) and len(set(at)) == len(at)  # in order, each word once a copy
        seen[r.doc_id] += len(at)
    want = {r.doc_id: r.taken for r in mixing.taken_per_document(*mixing.plan(df)).collect()}
    assert {i: n for i, n in want.items() if n} == dict(seen)


def test_blocks_join_to_the_text(spark):
    text = "  one two\tthree \n four five\x0bsix " + "x " * 1000
    blocks = spark.createDataFrame([(text,)], "t string").select(mixing.block_texts(F.col("t"), 4).alias("b")).first().b
    assert "".join(blocks) == text and all(size(b) <= 4 for b in blocks) and all(size(b) == 4 for b in blocks[:-1])


def test_results_follow_the_leaf_quotas(docs, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_BLOCKS", 16)
    monkeypatch.setattr(mixing, "CELL_BLOCKS", 8)
    rows = [(i, " ".join(f"d{i}w{k}" for k in range(size(t))), lang, s) for i, t, lang, s in corpus(np.random.default_rng(3), 120)]
    df = docs([*rows, rows[5]])
    parts = mixing.plan(df)
    want, first = Counter(), {}
    for r in sorted(parts[2].collect(), key=lambda r: r.slot):
        want[r.shard, r.doc_id] += r.words
        first.setdefault((r.shard, r.doc_id, r["pass"]), r.slot)
    taken = mixing.taken_per_document(*parts).collect()
    got = Counter()
    for r in taken:
        assert r.taken == sum(x.words for x in r.by_shard)
        for x in r.by_shard:
            got[x.shard, r.doc_id] += x.words
            assert x.slot == min(v for (s, i, _), v in first.items() if (s, i) == (x.shard, r.doc_id))
    assert got == want and len({s for s, _ in want}) > 2
    out = mixing.mixed_documents(df).select("doc_id", "text", F.spark_partition_id().alias("shard")).collect()
    told, order = Counter(), defaultdict(list)
    for r in out:
        told[r.shard, r.doc_id] += size(r.text)
        order[r.shard].append(r.doc_id)
    assert told == want
    for shard, ids in order.items():
        assert ids == [i for _, i in sorted((v, i) for (s, i, _), v in first.items() if s == shard)]
