"""Cost-balanced packing of documents into training sequences.

A document of n ids costs ``n + n * n / quadratic_at``: linear work plus attention within the document. Of documents
longer than a sequence full pieces are cut first, which fill sequences of their own. What remains is placed whole, by
descending cost, in the sequence of lowest cost that has room for it. Documents that find no room whole wait, and are
cut last, into the room that is left.

Each task packs its own rows in blocks of about ``block_tokens`` ids, so no row is shuffled, memory is bounded by
a block and the longest document, and a lost task is redone alone. A block's sequences are as many as its ids fill;
the ids beyond a multiple of the capacity, its tail, go over to the next block, the smallest documents first. So all
sequences are full but those of a task's last tail, whose lengths are powers of two and need no padding. Sequence ids
are unique: the task's partition in the upper bits, a running number in the lower 40.

Defined cases: a null text counts as empty and is packed as the end id alone; repeated rows are packed each; an
empty table gives an empty result; columns other than the id and text are ignored, so their names can't clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Pieces, id_bytes, pack_ids
from .common import small_batches, text_or_empty

CAPACITY = 1024
BLOCK_TOKENS = 1 << 20
#: Length at which a document's quadratic cost equals its linear one.
QUADRATIC_AT = 4096

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_ARROW = pa.schema([(c.split()[0], pa.int64()) for c in SCHEMA.split(", ")])


def cost(n: np.ndarray | int, quadratic_at: int = QUADRATIC_AT):
    return n + n * n / quadratic_at


Piece = tuple[int, int, int]


def plan(lengths: list[int], capacity: int = CAPACITY, quadratic_at: int = QUADRATIC_AT) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of each piece, for documents of the given lengths."""
    rows, _ = plan_pieces([(d, 0, n) for d, n in enumerate(lengths)], True, capacity, quadratic_at)
    return rows


def plan_pieces(pieces: list[Piece], last: bool, capacity: int = CAPACITY, quadratic_at: int = QUADRATIC_AT) -> tuple[list[tuple[int, int, int, int, int]], list[Piece]]:
    """Places pieces (document, start, length): rows of document, start, length, sequence and offset, and the pieces
    that go over to the next block; ``last`` says that there is none."""
    rows, rest, sequence = [], [], 0
    for d, start, n in pieces:
        full = n // capacity
        rows += [(d, start + k * capacity, capacity, sequence + k, 0) for k in range(full)]
        sequence += full
        if n % capacity:
            rest.append((n % capacity, d, start + full * capacity))
    # By descending cost, which grows with the length.
    rest.sort(key=lambda x: (-x[0], x[1], x[2]))
    tail, over = sum(n for n, _, _ in rest) % capacity, []
    if not last:
        while tail:
            n, d, start = rest.pop()
            m = min(n, tail)
            over.append((d, start + n - m, m))
            tail -= m
            if n > m:
                rest.append((n - m, d, start))
        rest.sort(key=lambda x: (-x[0], x[1], x[2]))
    total = sum(n for n, _, _ in rest)
    sizes = [capacity] * (total // capacity) + [1 << b for b in range(tail.bit_length() - 1, -1, -1) if tail >> b & 1]
    room, load = np.array(sizes, dtype=np.int64), np.zeros(len(sizes))
    size, late = room.copy(), []

    def put(s: int, d: int, start: int, n: int) -> None:
        rows.append((d, start, n, sequence + s, int(size[s] - room[s])))
        room[s] -= n
        load[s] += cost(n, quadratic_at)

    for n, d, start in rest:
        fits = room >= n
        if fits.any():
            put(int(np.where(fits, load, np.inf).argmin()), d, start, n)
        else:
            late.append((n, d, start))
    for n, d, start in late:
        while n:
            s = int(room.argmax())
            m = min(n, int(room[s]))
            put(s, d, start, m)
            start, n = start + m, n - m
    return rows, over


def pack(
    docs: DataFrame, path: str, end_id: int = 0, capacity: int = CAPACITY, block_tokens: int = BLOCK_TOKENS,
    quadratic_at: int = QUADRATIC_AT, text_col: str = "text", id_col: str = "doc_id", with_ids: bool = False,
) -> DataFrame:
    """One row per piece; ``with_ids`` adds the piece's ids as little-endian 32-bit integers (``ids`` binary)."""
    small_batches(docs.sparkSession)
    schema = _ARROW.append(pa.field("ids", pa.binary())) if with_ids else _ARROW

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, end = Pieces(path, pack_ids), pack_ids([end_id])
        base, tokens = TaskContext.get().partitionId() << 40, 0
        held: list[tuple] = []  # documents of this block and of the last one's tail
        pieces: list[Piece] = []

        def flush(last: bool) -> pa.RecordBatch:
            nonlocal base, held, pieces, tokens
            rows, over = plan_pieces(pieces, last, capacity, quadratic_at)
            out = []
            for d, start, n, s, offset in rows:
                doc, ids = held[d]
                part = ids[4 * start : 4 * (start + n)]
                out.append((doc, start, n, zlib.crc32(part), len(ids) // 4, base + s, offset, part))
            base += max((r[3] for r in rows), default=-1) + 1
            kept = sorted({d for d, _, _ in over})
            held, at = [held[d] for d in kept], {d: k for k, d in enumerate(kept)}
            pieces, tokens = [(at[d], start, n) for d, start, n in over], 0
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * len(schema), schema, strict=False)], schema=schema)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = id_bytes(cache, text) + end
                pieces.append((len(held), 0, len(ids) // 4))
                held.append((doc, ids))
                tokens += len(ids) // 4
                if tokens >= block_tokens:
                    yield flush(False)
        if pieces:
            yield flush(True)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, SCHEMA + (", ids binary" if with_ids else ""))
