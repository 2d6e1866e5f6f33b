"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree. DataFrame functions only.

Documents are cut into blocks of ``BLOCK_WORDS`` words. A source's target is its share of all words by weight, at
most ``CAP`` times its own size; the excess is shared again among the others. A target is met by whole passes over
the source and a partial one, which draws blocks in a fixed random order until the target's words are reached, to
half a block. So each source has an exact quota of blocks.

The quotas are split among output shards of equal block counts by a binary tree: at each node the left half's
blocks are a multivariate-hypergeometric draw from the node's quotas, source by source. A source's drawn blocks, in
their random order, then go to the shards as its quotas in them say: shards get disjoint blocks, and each orders
its own by a hash. There are at least ``LEAST_SHARDS``, and more with more blocks, without a limit.

Draws invert the distribution term by term over eight standard deviations on either side of the mean; what lies
beyond has a probability under 1e-12. That takes 16 terms a standard deviation, which is at most a quarter of the
root of a node's blocks: a million terms for the root of a tree over 100 TB, and few for the many nodes below.

Random order means by hash. A source's blocks are dealt to cells of about ``CELL_BLOCKS`` by the hash, cells are
numbered by running sums over cells, and only within a cell are blocks sorted: no task orders a whole source. All
draws come from hashes of keys and ``seed``, so reruns agree and a lost task is redone alike.

Defined cases: a null or blank text has size 0 and is never taken; the null source is a source of its own, last in
order; a null id is an id of its own; repeated rows (same id, text and source) share their blocks' draws evenly, the
odd words going to the first; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, same_row, text_or_empty, written

WEIGHTS = (5, 2, 1)
CAP = 3
BLOCK_WORDS = 256
CELL_BLOCKS = 4_096
#: Blocks that a shard holds at least (about 100 MB of text), where that gives LEAST_SHARDS or more.
SHARD_BLOCKS, LEAST_SHARDS = 65_536, 16
#: Partitions of the mixed table at most; beyond, several shards follow one another in a partition.
MOST_PARTITIONS = 65_536
#: Sources, by number, that may be broadcast as a table of a few numbers each.
MOST_BROADCAST = 50_000

SPACE, WORD = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"{WORD}+")).cast("long")


def block_texts(text: Column, block_words: int = BLOCK_WORDS) -> Column:
    """The text cut into its blocks; joined again they give the text."""
    return F.regexp_extract_all(text, F.lit(f"{SPACE}*+(?:{WORD}++{SPACE}*+){{1,{block_words}}}+"), F.lit(0))


def sized(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """Per row, without its text: id, source, a hash of the text and the number of words."""
    text = text_or_empty(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.xxhash64(text).alias("tie"), words(text).alias("size"))


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, block_words: int = BLOCK_WORDS) -> DataFrame:
    """A row a source: its number in order, words, blocks and target words."""
    per = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.ceil(F.col("size") / block_words)).alias("blocks"))
    # One row a source from here: the windows below run over sources, not documents.
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    per = per.withColumn("sid", F.row_number().over(by_name) - 1)
    per = per.withColumn("weight", F.get(F.array(*map(F.lit, weights)), F.pmod("sid", F.lit(len(weights)))).cast("double"))
    per = per.withColumn("cap", (F.col("source_size") * cap).cast("double"))
    by_reach = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_reach.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    free = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    # With the sources before it at their caps, what a unit of weight gets; it is largest where caps cease to bind.
    per = per.withColumn("level", left / free)
    per = per.withColumn("target", F.least("cap", F.col("weight") * F.greatest(F.lit(0.0), F.max("level").over(every))))
    return per.select("source", "sid", "source_size", "blocks", "target")


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= MOST_BROADCAST else df


def _uniform(*keys: Column) -> Column:
    """A number in (0, 1) from a hash of the keys."""
    return (F.pmod(F.xxhash64(*keys), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)


def hypergeometric(total: Column, marked: Column, drawn: Column, *keys: Column) -> Column:
    """How many of ``drawn`` of ``total`` things are among the ``marked``: a draw fixed by the keys."""
    n, k, m = (x.cast("double") for x in (total, marked, drawn))
    low, high = F.greatest(F.lit(0.0), m - (n - k)), F.least(m, k)
    mean = m * k / F.greatest(n, F.lit(1.0))
    dev = F.sqrt(F.greatest(F.lit(0.0), mean * (1 - k / F.greatest(n, F.lit(1.0))) * (n - m) / F.greatest(n - 1, F.lit(1.0))))
    first = F.greatest(low, F.floor(mean - 8 * dev - 2).cast("double"))
    last = F.least(high, F.ceil(mean + 8 * dev + 2).cast("double"))
    steps = F.sequence(F.lit(0), (last - first).cast("int"))

    def start(goal: Column) -> Column:  # what doesn't change is carried along, since a step would work it out again
        return F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum"), F.lit(0).alias("below"), first.alias("first"), goal.alias("goal"))

    def step(acc: Column, i: Column) -> Column:
        x = acc["first"] + i
        # The probability of x over that of x - 1, if x isn't the first.
        term = F.when(i == 0, F.lit(1.0)).otherwise(acc["term"] * (k - x + 1) * (m - x + 1) / (x * (n - k - m + x)))
        total = acc["sum"] + term
        below = acc["below"] + F.when(total < acc["goal"], 1).otherwise(0)
        return F.struct(term.alias("term"), total.alias("sum"), below.alias("below"), acc["first"].alias("first"), acc["goal"].alias("goal"))

    u = _uniform(*keys)
    mass = F.aggregate(steps, start(F.lit(0.0)), step, lambda acc: acc["sum"])
    exact = first + F.aggregate(steps, start(u * mass), step, lambda acc: acc["below"])
    return F.when(low >= high, low).otherwise(exact).cast("long")


def _halved(nodes: DataFrame, *keys: Column) -> DataFrame:
    """Each node's two halves, source by source."""

    def draw(acc: Column, x: Column) -> Column:
        got = hypergeometric(acc["total"], x["q"], acc["left"], *keys, x["leaf"], x["i"])
        return F.struct((acc["total"] - x["q"]).alias("total"), (acc["left"] - got).alias("left"), F.concat(acc["out"], F.array(got)).alias("out"))

    total = F.aggregate("q", F.lit(0).cast("long"), lambda a, x: a + x)
    nodes = nodes.withColumn("total", total).withColumn("items", F.transform("q", lambda x, i: F.struct(x.alias("q"), i.alias("i"), F.col("leaf").alias("leaf"))))
    start = F.struct("total", F.expr("(total + 1) div 2").alias("left"), F.array().cast("array<long>").alias("out"))
    nodes = nodes.withColumn("l", F.aggregate("items", start, draw, lambda acc: acc["out"]))
    halves = F.array(
        F.struct((F.col("leaf") * 2).alias("leaf"), F.col("l").alias("q")),
        F.struct((F.col("leaf") * 2 + 1).alias("leaf"), F.zip_with("q", "l", lambda a, b: a - b).alias("q")),
    )
    return nodes.select(F.explode(halves).alias("h")).select("h.leaf", "h.q")


def split_quotas(quotas: DataFrame, depth: int, seed: int) -> DataFrame:
    """Leaf quotas of the splitting tree. ``quotas`` has one row: ``q``, an array with each source's blocks. Gives
    2 ** depth rows: leaf number and its quotas."""
    nodes = quotas.select(F.lit(0).cast("long").alias("leaf"), F.col("q").cast("array<long>").alias("q"))
    for level in range(depth):
        # Written level by level: filters inferred from nested explosions would double the plan with each.
        nodes = written(_halved(nodes, F.lit(seed), F.lit(level)), "mix-nodes")
    return nodes


def draw_blocks(rows: DataFrame, aims: DataFrame, seed: int = 0, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix: a row for each time a block is taken, with its output shard and its place there (``slot`` orders a
    shard's blocks). ``rows`` comes from ``sized``, ``aims`` from ``targets``; both are read several times and so
    should be written tables."""
    n_sources = aims.count()
    aims = _small(aims, n_sources)
    blocks = (
        rows.filter("size > 0")
        .join(aims.select("source", "sid", "blocks"), rows["source"].eqNullSafe(aims["source"]))
        .select("doc_id", "tie", "sid", "size", "blocks", F.explode(F.expr(f"sequence(0L, (size - 1) div {block_words})")).alias("block"))
        .withColumn("words", F.least(F.lit(block_words).cast("long"), F.col("size") - F.col("block") * block_words))
        .withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "tie", "block"))
        .withColumn("cell", F.pmod(F.xxhash64("h", F.lit("cell")), F.expr(f"blocks div {CELL_BLOCKS} + 1")))
    )
    cells = blocks.groupBy("sid", "cell").agg(F.count("*").alias("n"), F.sum("words").alias("w"))
    ahead = Window.partitionBy("sid").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        "sid", "cell", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("n_before"), F.coalesce(F.sum("w").over(ahead), F.lit(0)).alias("w_before")
    )
    inside = Window.partitionBy("sid", "cell").orderBy("h", "doc_id", "tie", "block")
    placed = (
        blocks.withColumn("rank", F.row_number().over(inside))
        .withColumn("w_inside", F.sum("words").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("words"))
        .join(cells, ["sid", "cell"])
        .join(aims.select("sid", "source_size", "target"), "sid")
        .withColumn("passes", F.floor(F.col("target") / F.col("source_size")))
        .withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
        .withColumn("extra", (F.col("w_before") + F.col("w_inside") + F.col("words") / 2 <= F.col("rest")).cast("long"))
        .select("doc_id", "tie", "sid", "size", "block", "words", "h", "blocks", (F.col("n_before") + F.col("rank") - 1).alias("place"), "passes", "extra")
    )
    placed = written(placed.filter("passes + extra > 0"), "mix-blocks")
    counts = placed.groupBy("sid").agg(F.sum(F.col("passes") + F.col("extra")).alias("quota"))
    whole = aims.select("sid").join(counts, "sid", "left").select("sid", F.coalesce("quota", F.lit(0)).alias("quota"))
    # One array with a number for each source: as many as the sources.
    quotas = whole.agg(F.transform(F.sort_array(F.collect_list(F.struct("sid", "quota"))), lambda x: x["quota"]).alias("q"))
    total = counts.agg(F.sum("quota")).first()[0] or 0
    depth = max(1, min(total, max(LEAST_SHARDS, total // SHARD_BLOCKS))).bit_length() - 1
    leaves = split_quotas(quotas, depth, seed).select("leaf", F.posexplode("q").alias("sid", "q"))
    parts, n_parts = shard_parts(leaves, 1 << depth)
    # Each draw looks its shard up among the few parts of its source that begin or end near it.
    widths = parts.select("sid", "width").distinct()
    taken = placed.join(_small(widths, n_sources), "sid").withColumn("pass", F.explode(F.expr("sequence(0L, passes + extra - 1)")))
    taken = taken.withColumn("at", F.col("pass") * F.col("blocks") + F.col("place")).withColumn("span", F.expr("at div width")).drop("width")
    parts = F.broadcast(parts) if n_parts <= MOST_BROADCAST * 10 else parts
    taken = taken.join(parts.select("sid", "span", "shard", "start", "end"), ["sid", "span"]).filter("start <= at and at < end")
    return taken.select(
        "doc_id", "tie", "sid", "size", "block", "words", "pass", "shard", F.xxhash64(F.lit(seed), "h", "pass", F.lit("slot")).alias("slot")
    )


def shard_parts(leaves: DataFrame, shards: int) -> tuple[DataFrame, int]:
    """Where each shard's part of a source begins and ends among the source's draws, and how many rows that takes: a
    row for each span of ``width`` draws that the part touches, an average part's length."""
    ahead = Window.partitionBy("sid").orderBy("leaf")
    sums = leaves.groupBy("sid").agg(F.greatest(F.lit(1).cast("long"), F.ceil(F.sum("q") / shards)).alias("width"))
    parts = leaves.filter("q > 0").withColumn("end", F.sum("q").over(ahead)).withColumn("start", F.col("end") - F.col("q")).join(sums, "sid")
    spans = F.explode(F.expr("sequence(start div width, (end - 1) div width)"))
    parts = written(parts.select("sid", F.col("leaf").alias("shard"), "start", "end", "width", spans.alias("span")), "mix-shards")
    return parts, parts.count()


def plan(docs: DataFrame, seed: int = 0, text_col: str = "text", id_col: str = "doc_id", source_col: str = "source") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sized rows, targets by source, blocks drawn)."""
    rows = written(sized(docs, text_col, id_col, source_col), "mix-rows")
    aims = written(targets(rows), "mix-targets")
    return rows, aims, draw_blocks(rows, aims, seed)


def taken_per_document(rows: DataFrame, aims: DataFrame, drawn: DataFrame) -> DataFrame:
    """A row a document: its size, its source's size and target, how many of its words the mix takes, and where they
    went: an entry a shard, with the words there and the least slot of their blocks."""
    n_sources = aims.count()
    aims = _small(aims, n_sources)
    named = rows.join(aims, rows["source"].eqNullSafe(aims["source"])).select("doc_id", "tie", "sid", "size", "source_size", "target")
    keys = ["doc_id", "tie", "sid", "size"]
    parts = drawn.groupBy(*keys, "shard").agg(F.sum("words").alias("words"), F.min("slot").alias("slot"))
    part = F.struct(F.col("shard").cast("int").alias("shard"), "slot", "words")
    both = named.select(*keys, F.lit(1).alias("copy"), F.lit(None).cast("struct<shard:int,slot:bigint,words:bigint>").alias("part")).unionByName(
        parts.select(*keys, F.lit(0).alias("copy"), part.alias("part"))
    )
    sums = both.groupBy(*keys).agg(F.sum("copy").alias("copies"), F.sort_array(F.collect_list("part")).alias("parts"))
    each = sums.withColumn("copy", F.explode(F.expr("sequence(0L, copies - 1)")))

    def share(n: Column) -> Column:  # of the first n words, those of this copy: every copies-th one
        return F.floor(n / F.col("copies")).cast("long") + (F.col("copy") < n % F.col("copies")).cast("long")

    def add(acc: Column, x: Column) -> Column:
        upto = acc["upto"] + x["words"]
        entry = F.struct(x["shard"].alias("shard"), x["slot"].alias("slot"), (share(upto) - share(acc["upto"])).alias("words"))
        return F.struct(upto.alias("upto"), F.concat(acc["out"], F.array(entry)).alias("out"))

    start = F.struct(F.lit(0).cast("long").alias("upto"), F.array().cast("array<struct<shard:int,slot:bigint,words:bigint>>").alias("out"))
    each = each.withColumn("parts", F.aggregate("parts", start, add, lambda acc: F.filter(acc["out"], lambda x: x["words"] > 0)))
    taken = F.aggregate("parts", F.lit(0).cast("long"), lambda acc, x: acc + x["words"])
    return each.join(aims.select("sid", "source_size", "target"), "sid").select(
        "doc_id", "size", "source_size", "target", taken.alias("taken"), F.col("parts").alias("by_shard")
    )


def mixed_documents(docs: DataFrame, seed: int = 0, text_col: str = "text", id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """``docs`` as the mix takes them, with all their columns: a document comes once for each shard and pass that take
    any of its blocks, with the text of those blocks. Each shard is a partition, in order of the least slots (beyond
    MOST_PARTITIONS, several shards are). Repeated rows (same id, text and source) were counted together: one of
    them carries all their draws, the one whose columns' hash is least."""
    _, aims, drawn = plan(docs, seed, text_col, id_col, source_col)
    drawn = written(drawn, "mix-drawn")
    # Shards are numbered from 0 and each holds blocks.
    shards = (drawn.agg(F.max("shard")).first()[0] or 0) + 1
    own_id, tie, source, size, turns, turn, pieces, shard, slot = fresh(docs, "id", "tie", "source", "size", "turns", "turn", "pieces", "shard", "slot")
    keys = [own_id, tie, source]
    sources = _small(aims.select("sid", F.col("source").alias(source)), aims.count())
    per = drawn.groupBy("doc_id", "tie", "sid", "size", "shard", "pass").agg(F.sort_array(F.collect_list("block")).alias("blocks"), F.min("slot").alias("slot"))
    per = per.groupBy("doc_id", "tie", "sid", "size").agg(F.collect_list(F.struct("shard", "slot", "blocks")).alias(turns))
    per = per.join(sources, "sid").select(F.col("doc_id").alias(own_id), F.col("tie").alias(tie), source, F.col("size").alias(size), turns)
    rows = docs.withColumns(dict(zip(keys, [F.col(id_col).cast("long"), F.xxhash64(text_or_empty(text_col)), F.col(source_col).cast("string")], strict=True)))
    if rows.groupBy(*keys).count().filter("count > 1").head(1):
        rows = rows.groupBy(*keys).agg(F.min_by(F.struct(*(F.col(f"`{c}`") for c in docs.columns)), same_row(docs)).alias("row")).select(*keys, "row.*")
    same = rows[own_id].eqNullSafe(per[own_id]) & (rows[tie] == per[tie]) & rows[source].eqNullSafe(per[source])
    out = rows.join(per, same).select(*(rows[f"`{c}`"] for c in docs.columns), size, F.explode(turns).alias(turn))
    blocks = F.col(turn)["blocks"]
    partial = F.array_join(F.transform(blocks, lambda b: F.get(F.col(pieces), b.cast("int"))), "")
    whole = F.size(blocks) * BLOCK_WORDS >= F.col(size)
    out = out.withColumn(pieces, F.when(~whole, block_texts(F.col(text_col))))
    out = out.withColumn(text_col, F.when(whole, F.col(text_col)).otherwise(partial))
    out = out.withColumns({shard: F.col(turn)["shard"], slot: F.col(turn)["slot"]})
    partitions = min(shards, MOST_PARTITIONS)
    place = F.col(shard) if partitions == shards else F.expr(f"{shard} * {partitions}L div {shards}")
    out = out.repartitionById(partitions, place.cast("int")).sortWithinPartitions(shard, slot)
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))
