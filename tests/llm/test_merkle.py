"""Fingerprints against a plain version of the same tree, and edits."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tessera.llm import merkle

from .conftest import ODD


def test_edited_texts(docs):
    rows = [r for r in ODD if r[0] is not None]
    got = {(r.doc_id, r.n_chars): r for r in merkle.compare_with_edits(docs(ODD, extra=("edited", "fingerprint"))).collect()}
    ids = sorted({i for i, *_ in rows})
    texts = {i: t or "" for i, t, *_ in rows}
    order = [*[(i, texts[i]) for i in ids], (None, "no id at all")]  # a null id comes last
    for k, (i, t) in enumerate(order):
        nxt = order[(k + 1) % len(order)][1]
        n = len(t) // 4
        edited = t[: len(t) - n] + nxt[:n]
        r = got[i, len(t)]
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.fingerprint == r.edited_fingerprint) == (t == edited)
    assert got[5, 33].fingerprint == got[6, 33].fingerprint and got[5, 33].near_next == 1.0
    assert got[8, 100_000].near_edited == pytest.approx(0.4)  # one repeated leaf of two and of three
    assert len(merkle.compare_with_edits(docs(ODD)).collect()) == len(ODD)


def test_one_document_and_none(docs):
    one = merkle.compare_with_edits(docs([(3, "abcdefgh", "en", "a")])).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()
    assert merkle.compare_with_edits(docs(ODD).limit(0)).count() == 0


def plain(text):
    """The fingerprint, by the docstring's rules."""
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()

    def cut(line):
        while line:
            n = next((k for k in range(27, min(64, len(line))) if line[k] in " \t.,;:!?/&=-"), None)
            n = min(64, len(line)) if n is None else n + 1
            yield line[:n]
            line = line[n:]

    sections, held = [], []
    lines = text.split("\n")
    for k, line in enumerate(lines):
        digests = [sha(x) for x in cut(line)]
        held.append((sha("".join(digests)), "".join(d[:10] for d in digests)))
        if held[-1][0][0] in "048c" or k == len(lines) - 1:
            sections.append((sha("".join(d for d, _ in held)), ",".join(x for _, x in held)))
            held = []
    return sha("".join(d for d, _ in sections)) + "/" + ";".join(f"{d[:16]}={x}" for d, x in sections)


def test_equals_the_plain_tree(docs):
    lines = [f"line {k}, with words: {k * 7919 % 1000} and some more of its own; " * (k % 4) for k in range(200)]
    rows = [*ODD, (20, "\n".join(lines), "en", "s"), (21, "a" * 63 + " b" * 40 + "\n\n" + "\u00e9" * 70, "en", "s")]
    texts = {i: t or "" for i, t, *_ in rows}
    for r in merkle.fingerprints(docs(rows)).collect():
        assert r.fingerprint == plain(texts[r.doc_id])


def test_short_hashes_dont_make_the_root(spark):
    """Two texts whose leaves have the same first 40 bits."""
    a, b = (f"{k:032d}" for k in (511756, 1889193))
    df = spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")
    x, y = sorted(r.fingerprint for r in merkle.fingerprints(df).collect())
    assert x[:64] != y[:64]


def compared(spark, a, b):
    df = spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")
    fp = {r.doc_id: r.fingerprint for r in merkle.fingerprints(df).collect()}
    pair = spark.createDataFrame([(fp[1], fp[2])], "a string, tree_a string")
    row = merkle.with_edits(pair, "a", "tree_a", "e").select("e", merkle.likeness(merkle.leaves(F.col("a")), merkle.leaves(F.col("tree_a"))).alias("near")).first()
    places = lambda fp, found: [sum(len(s.split(",")) for s in fp.split("/")[1].split(";")[: e.section]) + e.paragraph for e in found]
    return places(fp[1], row.e.gone), places(fp[2], row.e.come), row.near


def test_edits_are_located(spark):
    lines = [f"line number {k} with some words of its own" for k in range(40)]
    text = "\n".join(lines)
    assert compared(spark, text, text) == ([], [], 1.0)
    assert compared(spark, text, "\n".join([*lines[:20], "another line", *lines[21:]]))[:2] == ([20], [20])
    assert compared(spark, text, "\n".join([*lines[:20], "a line put in", *lines[20:]]))[:2] == ([], [20])
    assert compared(spark, text, "\n".join([*lines[:7], *lines[8:]]))[:2] == ([7], [])


def test_an_insertion_moves_few_leaves(spark):
    line = " ".join(f"word{k * 7919 % 997}" for k in range(300))
    *_, near = compared(spark, line, "x" + line)
    assert near > 0.9


def test_likeness_is_dice(spark):
    a, b = ["x", "y", "z"], ["y", "z", "w", "v"]
    row = spark.createDataFrame([(a, b, [])], "a array<string>, b array<string>, c array<string>").select(
        merkle.likeness(F.col("a"), F.col("b")).alias("ab"), merkle.likeness(F.col("c"), F.col("c")).alias("cc"), merkle.likeness(F.col("a"), F.col("c")).alias("ac")
    ).first()
    assert (row.ab, row.cc, row.ac) == (2 * 2 / 7, 1.0, 0.0)
