"""Byte-level BPE by pre-tokens: each distinct pre-token is encoded once per worker, then looked up.

A byte-level BPE never merges across pre-tokens, so a text's ids are its pre-tokens' ids in order. Texts made of
the characters in ``PLAIN`` are cut by a compiled expression over that alphabet; any other text is cut by the
library's own pre-tokenizer, and a text that contains one of the vocabulary's special strings is encoded whole by
the library, so results equal the library's for every text.
"""

from __future__ import annotations

import os
import re
import sys
from array import array

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_NUMBER = "0-9²³¹¼-¾"
#: Characters whose classes are the same in every Unicode version; others go through the library.
PLAIN = re.compile("[^\t\n\r -~¡-ɏ‐-‧]")
PIECES = re.compile(
    rf" ?[{_LETTER}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{_NUMBER}]+| ?[^\s{_LETTER}{_NUMBER}]+|\s+(?!\S)|\s+"
)

#: Pre-tokens in each of a worker's two cache generations, and characters of the longest that is kept.
CACHE_ENTRIES, LONGEST_KEPT = 150_000, 64


def _byte_characters() -> dict[int, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves, the
    others, in order, from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in plain)
    return {b: b for b in plain} | {b: 0x100 + k for k, b in enumerate(others)}


_BYTES = _byte_characters()


def load(path: str):
    """The tokenizer, its special strings, and whether texts may be cut at pre-tokens. Not kept: a worker that has
    gone on to other stages shouldn't hold it."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    pre = tok.pre_tokenizer
    special = [t.content for t in tok.get_added_tokens_decoder().values()]
    state = repr(pre)
    cuttable = tok.normalizer is None and "ByteLevel(" in state and "add_prefix_space=False" in state and "use_regex=True" in state
    return tok, special, cuttable


class Cutter:
    """Cuts texts into pre-tokens."""

    def __init__(self, path: str):
        self.tok, self.special, self.cuttable = load(path)

    def __call__(self, text: str) -> list[str] | None:
        """The text's pre-tokens; None where only the library may encode the text as a whole."""
        if not self.cuttable or any(s in text for s in self.special):
            return None
        if PLAIN.search(text) is None:
            return PIECES.findall(text)
        return [text[a:b] for _, (a, b) in self.tok.pre_tokenizer.pre_tokenize_str(text)]


class Pieces(dict):
    """Pre-token -> what ``make`` gives for its ids. Misses are encoded by the library's model and kept; when a
    generation is full it becomes the older one, from which what is still in use comes back."""

    def __init__(self, path: str, make):
        super().__init__()
        self.cut = Cutter(path)
        self.tok = self.cut.tok
        self.model, self.make, self.older = self.tok.model, make, {}

    def __missing__(self, piece: str):
        value = self.older.get(piece)
        if value is None:
            value = self.make([t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(_BYTES))])
        if len(piece) <= LONGEST_KEPT:
            if len(self) >= CACHE_ENTRIES:
                self.older = dict(self)
                self.clear()
            self[piece] = value
        return value

    def whole(self, text: str) -> list[int]:
        return self.tok.encode(text, add_special_tokens=False).ids


def pack_ids(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


def id_bytes(pieces: Pieces, text: str) -> bytes:
    """The text's ids, packed; ``pieces`` was made with ``pack_ids``."""
    cut = pieces.cut(text)
    if cut is None:
        return pack_ids(pieces.whole(text))
    return b"".join(map(pieces.__getitem__, cut))
