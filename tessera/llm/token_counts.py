"""Token counts by a map-side two-tier lookup.

Tier one is a compact hash table of frequent pre-tokens and their token counts (TABLE_ENTRIES at most, so under a
few MB), broadcast to every worker. Tier two is each worker's own cache, which encodes misses once. The corpus'
pre-tokens are never shuffled: counting is a single pass over the texts.

Which pre-tokens are frequent is counted over all whole texts, by task: a task keeps a table of at most
``TASK_ENTRIES`` counts, of which the least go when it is full, and gives its ``TASK_GIVES`` most frequent. Only
these are merged; the counts of tokens come from whole texts and don't depend on them.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); repeated rows each get their row; an empty table
gives an empty result; columns other than the id and text are ignored, so their names can't clash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import LONGEST_KEPT, Cutter, Pieces, load
from .common import small_batches, text_or_empty

TABLE_ENTRIES = 32_768
TASK_ENTRIES, TASK_GIVES = 131_072, 4_096

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def frequent_pieces(docs: DataFrame, path: str, text_col: str = "text") -> dict[str, int]:
    """The most frequent pre-tokens of all texts, with their token counts."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, found = Cutter(path), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found.update(cut(text) or ())
                if len(found) > TASK_ENTRIES:
                    found = Counter(dict(found.most_common(TASK_ENTRIES // 2)))
        top = [(p, n) for p, n in found.most_common(TASK_GIVES) if len(p) <= LONGEST_KEPT]
        yield pa.RecordBatch.from_pydict({"piece": [p for p, _ in top], "n": [n for _, n in top]}, schema=pa.schema([("piece", pa.string()), ("n", pa.int64())]))

    merged = docs.select(text_or_empty(text_col).alias("text")).mapInArrow(tally, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    rows = merged.orderBy(F.desc("n"), "piece").limit(TABLE_ENTRIES).collect()
    pieces = Pieces(path, len)
    return {r["piece"]: pieces[r["piece"]] for r in rows}


class TwoTier(Pieces):
    """The broadcast table, whose entries stay, and behind it the worker's cache."""

    def __init__(self, path: str, table: dict[str, int]):
        super().__init__(path, len)
        self.table = table

    def __missing__(self, piece: str) -> int:
        value = self.table.get(piece)
        return super().__missing__(piece) if value is None else self.setdefault(piece, value)

    def count(self, text: str) -> int:
        cut = self.cut(text)
        return len(self.whole(text)) if cut is None else sum(map(self.__getitem__, cut))


class WholeTexts:
    """Vocabularies that don't cut at pre-tokens: the library encodes each text."""

    def __init__(self, path: str):
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.count = lambda text: len(model.encode(text))
        else:
            tok = load(path)[0]
            self.count = lambda text: len(tok.encode(text, add_special_tokens=False).ids)


def count_tokens(docs: DataFrame, path: str, limit: int = 512, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row: id, UTF-8 bytes, tokens and whether tokens exceed ``limit``."""
    spark = docs.sparkSession
    small_batches(spark)
    two_tier = path.endswith(".json") and load(path)[2]
    table = spark.sparkContext.broadcast(frequent_pieces(docs, path, text_col) if two_tier else {})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TwoTier(path, table.value) if two_tier else WholeTexts(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            n = [counter.count(t) for t in texts]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0),
                    "n_bytes": pa.array([len(t.encode()) for t in texts], pa.int64()),
                    "n_tokens": pa.array(n, pa.int64()),
                    "over_limit": pa.array([x > limit for x in n], pa.bool_()),
                }
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).mapInArrow(count, SCHEMA)
