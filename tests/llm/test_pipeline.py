"""The pipeline's stages, one by one and together."""

from collections import defaultdict

import numpy as np
import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from tessera.llm import mixing, ngram_join, pii  # noqa: E402

from .test_classifiers import prose  # noqa: E402
from .test_ngram_join import all_pairs  # noqa: E402


@pytest.fixture(scope="module")
def rows():
    import random

    rng = random.Random(8)
    out = [(i, prose(rng, lang, 40), lang, f"s{i % 4}") for i, lang in enumerate(rng.choices(["aa", "bb", "cc"], k=160))]
    out += [(200 + k, out[k][1] + " and", out[k][2], "s9") for k in range(10)]  # near copies
    out += [(300, "kato mail a@b.org " + out[5][1], "aa", "s1"), (301, "1234 5678", "aa", "s1"), (302, None, None, None)]
    return out


def test_stages(spark, docs, rows):
    df = docs(rows)
    assert [k for k, _ in corpus_pipeline.STAGES] == ["language ID", "n-gram Jaccard join", "PII", "mixing sources to target weights", "packing"]
    language, near, private, mix, pack = (f for _, f in corpus_pipeline.STAGES)
    kept = language(spark, df, "")
    ids = {r.doc_id for r in kept.collect()}
    assert not ids & {301, 302} and len(ids) >= len(rows) - 4 and kept.columns == df.columns
    one = near(spark, kept, "")
    texts = {r.doc_id: r.text for r in one.collect()}
    want = set(all_pairs([(r.doc_id, r.text) for r in kept.collect()]).values())
    assert set(texts) == want and not set(texts) & set(range(200, 210)) and one.columns == df.columns
    clean = private(spark, one, "")
    field = pii.Field()
    for r in clean.collect():
        assert r.text == pii.blank(texts[r.doc_id], pii.find([texts[r.doc_id]], field)[0][1]) and r.n_chars == len(r.text)
    assert clean.columns == df.columns
    mixed = mix(spark, clean, "")
    taken = defaultdict(int)
    for r in mixed.collect():
        taken[r.doc_id] += len(r.text.split())
        assert r.n_chars == len(r.text)
    plan = mixing.taken_per_document(*mixing.plan(clean)).collect()
    assert {r.doc_id: r.taken for r in plan if r.taken} == dict(taken) and mixed.columns == df.columns
    packed = pack(spark, mixed, "").collect()
    assert sum(r.length for r in packed) == sum({(r.sequence_id, r.offset): r.length for r in packed}.values())


def test_run(spark, docs, rows, tmp_path):
    docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert out and {r.doc_id for r in out} <= {i for i, *_ in rows}
    by = defaultdict(list)
    for r in out:
        by[r.sequence_id].append((r.offset, r.length))
    for s in by.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at == 1024 or at & (at - 1) == 0
    assert np.all([r.doc_tokens > 0 for r in out]) and corpus_pipeline.ORACLE_SQL is None and ngram_join.SHARE == 85


def test_odd_and_empty_tables(spark, docs, tmp_path):
    from .conftest import ODD

    for k, df in enumerate((docs(ODD), docs(ODD).limit(0), docs([(1, None, None, None)]))):
        df.write.parquet(str(tmp_path / f"{k}" / "documents.parquet"))
        out = corpus_pipeline.run(spark, str(tmp_path / f"{k}")).collect()
        assert (len(out) > 0) == (k == 0)
