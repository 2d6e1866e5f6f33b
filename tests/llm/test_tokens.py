"""Token counts and packing against the library itself."""

import zlib
from collections import defaultdict

import numpy as np
import pytest

from tessera.llm import bpe, packing, token_counts

from .conftest import ODD


@pytest.fixture(scope="module")
def tokenizer(vocabulary):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary)


def test_pieces_equal_the_library(vocabulary, tokenizer):
    rng = np.random.default_rng(0)
    letters = list("abc  \n\t'sltrevmd0123.,!?éßñÀ²½    \u0085\x1c漢\U0001f600$%<|>")
    texts = ["".join(rng.choice(letters, int(rng.integers(0, 60)))) for _ in range(3000)] + [t for _, t, *_ in ODD if t]
    pieces = bpe.Pieces(vocabulary, bpe.pack_ids)
    for t in texts:
        assert bpe.id_bytes(pieces, t) == np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t


def test_cache_generations(vocabulary, tokenizer, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    pieces = bpe.Pieces(vocabulary, len)
    text = "a few words and a few more words than the cache can hold"
    for _ in range(3):
        assert sum(map(pieces.__getitem__, pieces.cut(text))) == len(tokenizer.encode(text).ids)
    assert len(pieces) <= 3


def test_counts(docs, vocabulary, tokenizer):
    df = docs(ODD, extra=("n_tokens", "piece"))
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(df, vocabulary).collect())
    want = []
    for i, t, *_ in ODD:
        n = len(tokenizer.encode(t or "", add_special_tokens=False).ids)
        want.append((i or 0, len((t or "").encode()), n, n > 512))
    assert got == sorted(want)
    assert token_counts.count_tokens(df.limit(0), vocabulary).count() == 0


def test_other_vocabularies(docs, vocabulary):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = {(r.doc_id, r.n_bytes): r.n_tokens for r in token_counts.count_tokens(docs(ODD[:7]), path).collect()}
    assert all(got[i, len((t or "").encode())] == len(model.encode(t or "")) for i, t, *_ in ODD[:7])


def test_plan_fills_sequences():
    rng = np.random.default_rng(1)
    for _ in range(50):
        lengths = [int(x) for x in rng.integers(1, 3000, int(rng.integers(1, 60)))]
        rows = packing.plan(lengths)
        whole, filled = defaultdict(list), defaultdict(list)
        for d, start, n, s, offset in rows:
            assert n > 0
            whole[d].append((start, n))
            filled[s].append((offset, n))
        for d, n in enumerate(lengths):  # each id once, without a gap
            at = 0
            for start, size in sorted(whole[d]):
                assert start == at
                at += size
            assert at == n
        for s in filled.values():
            at = 0
            for offset, size in sorted(s):
                assert offset == at
                at += size
            assert at == 1024 or at & (at - 1) == 0  # full, or a power of two: no padding


def placed(lengths, **more):
    """Document -> sequences of its pieces."""
    found = defaultdict(list)
    for d, _, _, s, _ in packing.plan(lengths, **more):
        found[d].append(s)
    return found


def test_documents_go_to_the_cheapest():
    """One document of 512 costs more than four of 130: a fifth joins the four, which have more ids but cost less.
    Neither the fuller nor the emptier sequence would be right for all of them, and without the quadratic part the
    fifth would join the 512."""
    lengths = [512] + [130] * 5 + [98] * 9 + [4]
    where = placed(lengths)
    assert {where[k][0] for k in range(1, 6)} == {1 - where[0][0]}
    linear = placed(lengths, quadratic_at=10**12)
    assert {linear[k][0] for k in range(1, 6)} == {0, 1}


def test_few_documents_are_cut():
    assert all(len(s) == 1 for s in placed([700, 600, 500, 424, 324, 548]).values())  # none where all find room
    rng = np.random.default_rng(4)
    lengths = [int(x) for x in rng.integers(20, 600, 400)]
    cut = sum(len(s) > 1 for s in placed(lengths).values())
    assert cut <= 60  # sequences without padding need some


def test_tails_go_over_to_the_next_block(docs, vocabulary):
    """Many blocks, one tail: all sequences of a task are full but a last few."""
    rng = np.random.default_rng(6)
    df = docs([(i, "word " * int(rng.integers(1, 400)), "en", "s") for i in range(200)]).coalesce(1)
    rows = packing.pack(df, vocabulary, block_tokens=3_000).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.sequence_id] += r.length
    short = sorted((s for s in sizes.values() if s < 1024), reverse=True)
    total = sum(sizes.values())
    assert short == [1 << b for b in range(9, -1, -1) if total % 1024 >> b & 1]
    seen = defaultdict(list)
    for r in rows:
        seen[r.doc_id].append((r.start, r.length, r.doc_tokens))
    for found in seen.values():
        at = 0
        for start, n, _ in sorted(found):
            assert start == at
            at += n
        assert at == found[0][2]


def test_packing(docs, vocabulary, tokenizer):
    df = docs(ODD, extra=("ids_crc32",))
    rows = packing.pack(df, vocabulary, with_ids=True).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        pieces[r.doc_id].append((r.start, bytes(r.ids), r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, t, *_ in ODD:
        if i == 4:
            continue  # twice: checked by the sum below
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        assert b"".join(b for _, b, _ in sorted(pieces[i])) == np.array(ids, "<u4").tobytes()
        assert {n for *_, n in pieces[i]} == {len(ids)}
    assert sum(len(b) for _, b, _ in pieces[4]) == 2 * 4 * (len(tokenizer.encode("one").ids) + 1)
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= 1024
    assert packing.pack(df.limit(0), vocabulary).count() == 0
