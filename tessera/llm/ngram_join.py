"""N-gram Jaccard join by prefix trees, down to connected components.

A document's set is its distinct word n-grams, as 63-bit keys whose numeric order is the global one: first by how
many documents of a bounded sample hold the n-gram (in powers of two), then by a 58-bit hash. Rare ones come first,
so passages that many documents share come last. Two sets of n and m n-grams are linked when ``100 * common >=
SHARE * union``, which is ``common >= need(n, m)``; linked sets share one of the first ``n - ceil(SHARE * n / 100) +
1`` of either (prefix).

1. Equal sets are one class, named by its least document id; only classes go on.
2. Classes meet under each n-gram of their prefixes. First links are looked for in two rounds. Under every n-gram a
   class sees one other: first the n-gram's hub, in whose order it comes soonest (near copies have n-grams of their
   own ahead of what they share, the more the more they differ, so a hub is next to the copies' origin); then the
   class before it by size. Of all it has seen it picks the one it met most often. So a round decides one pair a
   class at most, and a group of m near copies costs m pairs.
3. What the rounds have left: pairs in different components. Under an n-gram of up to ``NEAR + 1`` classes they are
   listed; their meetings, and what either set has left behind the end of the prefix that ends first, bound their
   common n-grams from above. Under a larger one the classes outside the n-gram's largest component are compared, by
   sketches, with the classes whose sizes allow a link. A sketch tells for each value of the last bits of a hash
   whether an even or odd number of the set's n-grams have it; two sets differ in at least as many n-grams as their
   sketches in bits. A class' row has its sketch, a byte for two to four n-grams, and its first crowded n-grams, and is
   there once for each of its n-grams with up to BLOCK classes. A pair comes from the first of the crowded n-grams that
   both have, not from each. No link between components is lost, and no pair within a component is looked at.
4. Pairs are decided exactly: a tree of the candidates' whole sets is traversed by the other set, sharing overlaps of
   common beginnings and leaving subtrees that the remaining lengths rule out. Links give components.

Under a very common n-gram classes are first dealt to ``salts`` groups by hash, so no task orders them all; pairs
across groups are met in step 3.

Defined cases: a text without words, or null, has an empty set, links with nothing and is its own component; a
text of fewer words than n has one n-gram, all its words; rows of one id are one document (they share a
component) and each keeps a row with its own set's size; a null id has no name: its row's component is null and it
links with nothing; an empty table gives an empty result; columns other than the id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, fresh, hash_below, same_row, small_batches, text_or_empty, written
from .components import connected

WORDS, SHARE = 4, 85
NEAR, BLOCK = 8, 2048
#: Partners of one set that a task decides.
PARTNERS = 512
#: Bits of a sketch at least and at most, as powers of two.
SKETCH_BITS = 7, 15
#: Crowded n-grams that a class' row names, so that a pair isn't given again by a later one.
NAMED = 32
#: The part of the lesser prefix in which a pair must have met to be picked.
PICK_SHARE = 0.25
#: Documents in the sample that sets the order, and in how many of them an n-gram must be to count as common.
SAMPLE_ROWS, COMMON = 16_384, 3
#: Entries of the order's table of common n-grams at most (13 bytes each); the rarest beyond are left out.
MOST_COMMON = 200_000
#: Classes that one task should order under one n-gram.
GROUP = 20_000
UNSALTED = -1
#: The step of n-grams whose classes are one block.
WHOLE = -9
#: Ids of documents that may be broadcast to the scan (8 bytes each).
MOST_BROADCAST = 2_000_000

#: Words whose hashes a worker holds.
CACHE_ENTRIES = 150_000

_MIX = np.uint64(0x9E3779B97F4A7C15)


def need(n: int, m: int, share: int = SHARE) -> int:
    """Common n-grams at which sets of n and m are linked."""
    return -(-share * (n + m) // (100 + share))


def prefix_length(n: int, share: int = SHARE) -> int:
    return n - -(-share * n // 100) + 1 if n else 0


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE_ENTRIES:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


class Shingler:
    """Sets of n-grams of texts: lower-cased A-Z, words between ASCII white space."""

    def __init__(self, n: int = WORDS):
        self.n, self.hashes = n, _Hashes()

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split()
        if len(words) < self.n:
            return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=1)] if words else [], np.uint64)
        a = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))
        size = len(a) - self.n + 1
        h = a[:size].copy()
        for k in range(1, self.n):
            h ^= h >> np.uint64(29)
            h *= _MIX
            h += a[k : k + size]
        h ^= h >> np.uint64(32)
        h *= _MIX
        h ^= h >> np.uint64(29)
        return np.unique(h)


class Order:
    """The global order: common n-grams with their tier and number of salts."""

    def __init__(self, grams: np.ndarray, seen: np.ndarray, documents_per_row: float):
        at = np.argsort(grams)
        self.grams, seen = grams[at], seen[at]
        self.tiers = (1 + np.floor(np.log2(np.maximum(seen, 1)))).astype(np.int8)
        self.salts = np.maximum(1, seen * documents_per_row / GROUP).astype(np.int32)

    def keys(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The keys of a set (given in order of hash) in the global order, and each one's number of salts."""
        keys = (grams >> np.uint64(6)).view(np.int64)
        if not len(self.grams) or not len(grams):
            return keys, np.ones(len(grams), np.int32)
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        common = np.flatnonzero(self.grams[at] == grams)
        if not len(common):
            return keys, np.ones(len(grams), np.int32)
        at, salts = at[common], np.ones(len(grams), np.int32)
        keys = keys.copy()
        keys[common] |= self.tiers[at].astype(np.int64) << 58
        salts[common] = self.salts[at]
        order = np.argsort(keys, kind="stable")
        return keys[order], salts[order]


def sketch(keys: np.ndarray) -> np.ndarray:
    """Whether an odd number of a set's keys have the same last bits, as bits; a power of two of places that grows with the set."""
    least, most = SKETCH_BITS
    places = 1 << min(max(least, len(keys).bit_length() + 1), most)
    return np.packbits(np.bincount(keys & (places - 1), minlength=places) & 1, bitorder="little")


def folded(sketches: np.ndarray, words: int) -> np.ndarray:
    """Sketches (a row each, in words of 64 bits) as they are with fewer places."""
    return np.bitwise_xor.reduce(sketches.reshape(len(sketches), -1, words), 1)


def sketch_join(sketches: list[np.ndarray], sizes: np.ndarray, probes: list[np.ndarray], probe_sizes: np.ndarray, share: int = SHARE) -> Iterator[tuple[int, np.ndarray]]:
    """For each probe, its number and the sets whose sizes and sketches allow a link with it."""
    by = np.argsort(sizes, kind="stable")
    n = sizes[by].astype(np.int64)
    words = np.array([len(sketches[k]) // 8 for k in by], np.int64)
    # Places grow with sizes, so sets of as many places stand together.
    begins = {int(p): int(b) for p, b in zip(*np.unique(words, return_index=True), strict=True)}
    rows = {p: np.array([sketches[k] for k in by[b : b + np.count_nonzero(words == p)]]).view(np.uint64) for p, b in begins.items()}
    tables: dict[tuple[int, int], np.ndarray] = {}
    for q, (probe, m) in enumerate(zip(probes, probe_sizes.astype(np.int64).tolist(), strict=True)):
        low, high = np.searchsorted(n, -(-share * m // 100), "left"), np.searchsorted(n, 100 * m // share, "right")
        probe = probe.view(np.uint64)[None]
        for p, b in begins.items():
            x, y = max(low, b), min(high, b + len(rows[p]))
            if x >= y:
                continue
            least = min(p, probe.shape[1])
            if (p, least) not in tables:
                tables[p, least] = folded(rows[p], least)
            apart = np.bitwise_count(tables[p, least][x - b : y - b] ^ folded(probe, least)).sum(1, dtype=np.int64)
            both = n[x:y] + m
            ok = np.flatnonzero((100 + share) * (both - apart) >= 2 * share * both)
            if len(ok):
                yield q, by[x + ok]


def fit_order(docs: DataFrame, n: int = WORDS, text_col: str = "text", id_col: str = "doc_id") -> Order:
    """Counts common n-grams over a bounded sample of distinct texts. It only steers the order: any is right."""
    total = docs.count()
    none = Order(np.zeros(0, np.uint64), np.zeros(0), 1.0)
    if not total:
        return none
    fraction = min(1.0, SAMPLE_ROWS / total)
    chosen = hash_below(F.col(id_col), fraction, "n-gram order", otherwise=F.col(text_col))
    rows = docs.filter(chosen).select(text_or_empty(text_col).alias("text")).distinct()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(n)
        for b in batches:
            for text in b.column(0).to_pylist():
                yield pa.RecordBatch.from_pydict({"gram": pa.array(shingle(text).view(np.int64))})

    seen = rows.mapInArrow(split, "gram long").groupBy("gram").agg(F.count("*").alias("n")).filter(F.col("n") >= COMMON)
    found = seen.orderBy(F.desc("n"), "gram").limit(MOST_COMMON).collect()
    if not found:
        return none
    return Order(np.array([r["gram"] for r in found], np.int64).view(np.uint64), np.array([r["n"] for r in found]), 1 / fraction)


def features(docs: DataFrame, order, n: int = WORDS, share: int = SHARE, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row: id, size of its set, the set's 128-bit name, its prefix, under each of these its salt, and its sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, ranks = Shingler(n), order.value
        for b in batches:
            size, names, prefix, salt, sketches = [], [], [], [], []
            for text in b.column(1).to_pylist():
                s = shingle(text)
                name = xxhash.xxh3_128(s.tobytes())
                s, salts = ranks.keys(s)
                p = prefix_length(len(s), share)
                size.append(len(s))
                names.append(name.digest())
                prefix.append(s[:p])
                sketches.append(sketch(s).tobytes())
                salt.append(np.where(salts[:p] > 1, (name.intdigest() & 0x7FFFFFFF) % salts[:p], UNSALTED))
            yield pa.RecordBatch.from_pydict(
                {"doc_id": b.column(0), "n": pa.array(size, pa.int32()), "name": pa.array(names, pa.binary()),
                 "prefix": pa.array(prefix, pa.list_(pa.int64())), "salt": pa.array(salt, pa.list_(pa.int32())), "sketch": pa.array(sketches, pa.binary())}
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n int, name binary, prefix array<long>, salt array<int>, sketch binary")


# ---- the prefix tree ------------------------------------------------------------------------------------------


def tree_join(sets: list[np.ndarray], sizes: np.ndarray, probes: list[np.ndarray], probe_sizes: np.ndarray, share: int = SHARE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Traverses a tree of ``sets`` (each in the global order) by all ``probes`` at once.

    A node carries each probe's overlap with the path to it, shared by all sets below. A subtree is left when, for
    every probe, overlap plus what can still come can't reach the need of any set below. Sets and probes may be
    whole or prefixes of sets of the given sizes. Gives, for each set that is reached, its number, the probes that
    are still possible and their overlaps; for whole sets these are the links."""
    where: dict[int, np.ndarray] = {}
    if probes:
        every = np.concatenate(probes)
        owner = np.repeat(np.arange(len(probes)), [len(p) for p in probes])
        by = np.argsort(every, kind="stable")
        values, begin = np.unique(every[by], return_index=True)
        where = dict(zip(values.tolist(), np.split(owner[by], begin[1:]), strict=True))
    whole, part = 100 + share, share * probe_sizes.astype(np.int64)
    ends = np.array([len(s) for s in sets], np.int64)
    probe_ends = np.array([len(p) for p in probes], np.int64)
    probe_last = np.array([p[-1] if len(p) else -1 for p in probes], np.int64)
    behind, probe_behind = sizes - ends, probe_sizes - probe_ends

    def possible(overlap: np.ndarray, below: list[int], depth: int) -> np.ndarray:
        # Common n-grams are at most the overlap, the rest of the path, and what lies behind the end of the prefix
        # that ends first, so behind the larger of both.
        most = overlap + ends[below].max() - depth + np.maximum(behind[below].max(), probe_behind)
        return whole * most >= share * sizes[below].min() + part

    def reached(i: int, overlap: np.ndarray) -> np.ndarray:
        """The probes that may be linked with set i, whose path has been walked to its end."""
        ok = np.flatnonzero(possible(overlap, [i], ends[i]))
        if not len(ok) or not behind[i] and not probe_behind[ok].any():
            return ok
        # Behind the end of the one that ends first both must still have what is common.
        last = sets[i][-1] if ends[i] else -1
        rest = sizes[i] - np.searchsorted(sets[i], np.minimum(last, probe_last[ok]), "right")
        rest = np.where(probe_last[ok] <= last, np.minimum(rest, probe_behind[ok]), rest)
        lower = lambda k, r: whole * (overlap[ok[k]] + r) >= share * sizes[i] + part[ok[k]]
        kept = np.flatnonzero(lower(np.arange(len(ok)), rest))
        longer = [min(rest[k], probe_sizes[ok[k]] - int(np.searchsorted(probes[ok[k]], last, "right"))) for k in kept]
        return ok[kept[lower(kept, np.array(longer, np.int64))]] if len(kept) else ok[:0]

    paths = [s.tolist() for s in sets]
    stack = [(sorted(range(len(sets)), key=paths.__getitem__), 0, np.zeros(len(probes), np.int64))]
    while stack:
        below, depth, overlap = stack.pop()
        if len(below) == 1:
            hits = [where[g] for g in paths[below[0]][depth:] if g in where]
            if hits:
                overlap = overlap + np.bincount(np.concatenate(hits), minlength=len(overlap))
            ok = reached(below[0], overlap)
            if len(ok):
                yield below[0], ok, overlap[ok]
            continue
        at = 0
        while at < len(below):
            i = below[at]
            if len(paths[i]) == depth:
                ok = reached(i, overlap)
                if len(ok):
                    yield i, ok, overlap[ok]
                at += 1
                continue
            gram, end = paths[i][depth], at + 1
            while end < len(below) and paths[below[end]][depth] == gram:
                end += 1
            child = overlap
            if gram in where:
                child = overlap.copy()
                child[where[gram]] += 1
            if possible(child, below[at:end], depth + 1).any():
                stack.append((below[at:end], depth + 1, child))
            at = end


# ---- candidates -----------------------------------------------------------------------------------------------


def _fits(a: str, b: str, share: int) -> str:
    return f"100 * least({a}, {b}) >= {share} * greatest({a}, {b})"


def _prefix(n: str, share: int) -> str:
    return f"({n} - ceil({share}L * {n} / 100.0) + 1)"


def meetings(classes: DataFrame) -> DataFrame:
    """Classes under the n-grams of their prefixes that another class has too, in order of size: each with the
    n-gram's hub, and whether the n-gram is crowded (more than NEAR + 1 classes, or several groups)."""
    zipped = F.posexplode(F.arrays_zip("prefix", "salt")).alias("pos", "e")
    entries = classes.select("id", "n", F.element_at("prefix", -1).alias("last"), zipped).select("id", "n", "last", "pos", F.col("e.prefix").alias("gram"), F.col("e.salt").alias("salt"))
    group = Window.partitionBy("gram", "salt")
    by = group.orderBy("n", "id")
    placed = entries.withColumn("hub", F.min(F.struct("pos", "id", "n")).over(group)).withColumn("at", F.row_number().over(by)).withColumn("size", F.count("*").over(group))
    # A class alone in its group may still have others in the n-gram's other groups.
    placed = placed.filter(f"size > 1 or salt <> {UNSALTED}")
    return placed.withColumn("crowded", (F.col("size") > NEAR + 1) | (F.col("salt") != UNSALTED)).drop("size")


def with_components(met: DataFrame, component: DataFrame | None) -> DataFrame:
    """Adds ``c``, the component: a class without links is one of its own."""
    if component is None:
        return met.withColumn("c", F.col("id"))
    few = component.count() <= MOST_BROADCAST
    return met.join(F.broadcast(component) if few else component, "id", "left").withColumn("c", F.coalesce("component", "id")).drop("component")


def picks(met: DataFrame, share: int = SHARE) -> DataFrame:
    """Pairs (a, b): for each class b the one that it has seen (``other``) under the most n-grams, in another
    component. One that it met in too small a part of their prefixes isn't worth the look: step 3 comes to all."""
    seen = met.filter("other is not null and other.c <> c").filter(_fits("n", "other.n", share)).groupBy("id", F.col("other.id").alias("o"))
    seen = seen.agg(F.count("*").alias("k"), F.max("n").alias("n"), F.max("other.n").alias("m"))
    seen = seen.filter(f"k >= {PICK_SHARE} * least({_prefix('n', share)}, {_prefix('m', share)})")
    best = seen.groupBy("id").agg(F.max(F.struct("k", (-F.col("o")).alias("o"))).alias("best"))
    return best.select((-F.col("best.o")).alias("a"), F.col("id").alias("b"))


def listed_pairs(met: DataFrame, share: int = SHARE) -> DataFrame:
    """Pairs in different components that meet under n-grams that aren't crowded: how often, and their last places.
    ``met`` has components."""
    by = Window.partitionBy("gram").orderBy("at").rowsBetween(-NEAR, -1)
    before = F.collect_list(F.struct("id", "n", "pos", "last", "c")).over(by)
    met = met.filter("not crowded").withColumn("before", before)
    met = met.withColumn("before", F.expr(f"filter(before, o -> o.c <> c and {_fits('n', 'o.n', share)})")).filter("size(before) > 0")
    pairs = met.withColumn("o", F.explode("before"))
    a, b = F.struct("id", "n", "pos", "last"), F.col("o")
    swap = F.col("id") < F.col("o.id")
    pairs = pairs.select(F.when(swap, a).otherwise(F.struct("o.id", "o.n", "o.pos", "o.last")).alias("x"), F.when(swap, F.struct("o.id", "o.n", "o.pos", "o.last")).otherwise(a).alias("y"))
    of = {f"{f}{s}": F.max(f"{v}.{c}").alias(f"{f}{s}") for s, v in (("a", "x"), ("b", "y")) for f, c in (("n", "n"), ("p", "pos"), ("l", "last"))}
    return pairs.groupBy(F.col("x.id").alias("a"), F.col("y.id").alias("b")).agg(F.count("*").alias("met"), *of.values())


def crowds_of(met: DataFrame) -> DataFrame:
    """The meetings under crowded n-grams that hold several components: with whether the class is outside the largest
    of them (``minor``), and whether all of the n-gram's classes are few enough for one block (``whole``)."""
    met = met.filter("crowded").select("gram", "id", "n", "c")
    # A row a component and n-gram: the largest of an n-gram is found among these.
    parts = met.groupBy("gram", "c").agg(F.count("*").alias("k"))
    largest = parts.groupBy("gram").agg(F.max(F.struct("k", "c")).alias("best"), F.count("*").alias("several"), F.sum("k").alias("held")).filter("several > 1")
    largest = largest.select("gram", F.col("best.c").alias("most"), (F.col("held") <= BLOCK).alias("whole"))
    return met.join(largest, "gram").select("gram", "id", "n", (F.col("c") != F.col("most")).alias("minor"), "c", "whole")


def bounded(pairs: DataFrame, crowds: DataFrame, share: int = SHARE) -> DataFrame:
    """The pairs that can still be linked. Meetings under crowded n-grams weren't counted, so as many as both classes
    have there are allowed for."""
    unseen = crowds.groupBy("id").agg(F.count("*").alias("k"))
    p = pairs.join(unseen.withColumnsRenamed({"id": "a", "k": "ka"}), "a", "left").join(unseen.withColumnsRenamed({"id": "b", "k": "kb"}), "b", "left")
    p = p.withColumn("unseen", F.least(F.coalesce("ka", F.lit(0)), F.coalesce("kb", F.lit(0))))
    first, exact = F.col("la") <= F.col("lb"), F.col("unseen") == 0
    # Behind the prefix that ends first; and in the other set behind the last meeting, if all meetings are known.
    rest_a, rest_b = F.expr(f"na - {_prefix('na', share)}"), F.expr(f"nb - {_prefix('nb', share)}")
    rest_a = F.when(exact, F.least(rest_a, F.expr("nb - pb - 1"))).otherwise(rest_a)
    rest_b = F.when(exact, F.least(rest_b, F.expr("na - pa - 1"))).otherwise(rest_b)
    most = F.col("met") + F.col("unseen") + F.when(first, rest_a).otherwise(rest_b)
    return p.filter(most * (100 + share) >= F.expr(f"{share}L * (na + nb)")).select("a", "b")


def far_pairs(crowds: DataFrame, sketches: DataFrame, share: int = SHARE) -> DataFrame:
    """Pairs of classes in different components that crowded n-grams hold and the sketches leave. Sizes and sketches are the
    same under each n-gram that a pair shares, so it is given by the first; of a class the first NAMED are known, so
    a pair whose first one lies behind these may come again.

    An n-gram's classes are one block. Where they are more than BLOCK, they are kept by size, in steps of SHARE; those
    outside the n-gram's largest component go as probes to their own step and the ones beside it. Within a step, blocks
    of BLOCK classes meet blocks of BLOCK probes."""
    step = F.floor(F.log("n") / (1.001 * F.log(F.lit(100 / share)))).cast("int")
    key = ["gram", "step"]
    columns = [*key, "i", "j", "probe", "minor", "id", "n", "c"]
    named = crowds.groupBy("id").agg(F.slice(F.sort_array(F.collect_set("gram")), 1, NAMED).alias("named"))
    whole = crowds.filter("whole").select("gram", *(F.lit(v).alias(k) for k, v in (("step", WHOLE), ("i", 0), ("j", 0), ("probe", False))), "minor", "id", "n", "c")
    sets = crowds.filter("not whole").withColumn("step", step)
    probes = sets.filter("minor").withColumn("step", F.explode(F.expr("sequence(step - 1, step + 1)")))
    blocks = lambda df, name: df.groupBy(*key).agg(F.ceil(F.count("*") / BLOCK).alias(name))
    counts = blocks(sets, "sb").join(blocks(probes, "pb"), key)
    dealt = lambda of: F.pmod(F.xxhash64("id"), F.col(of)).cast("int")
    every = lambda of: F.explode(F.expr(f"sequence(0, cast({of} as int) - 1)"))
    left = sets.join(counts, key).withColumn("i", dealt("sb")).withColumn("j", every("pb")).withColumn("probe", F.lit(False))
    right = probes.join(counts, key).withColumn("j", dealt("pb")).withColumn("i", every("sb")).withColumn("probe", F.lit(True))
    rows = whole.select(columns).unionByName(left.select(columns)).unionByName(right.select(columns)).join(sketches, "id").join(named, "id")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, group in _groups(batches, 4):
            probe, minor, ids, sizes, c, held, named = group
            left, right = np.flatnonzero(~probe), np.flatnonzero(minor if key[1] == WHOLE else probe)
            out = []
            if len(left) and len(right):
                held = [np.frombuffer(h, np.uint8) for h in held]
                before = [frozenset(g[g < key[0]].tolist()) for g in named]
                for q, found in sketch_join([held[x] for x in left], sizes[left], [held[x] for x in right], sizes[right], share):
                    q, s = right[q], left[found]
                    # Two probes meet twice, as set and as probe.
                    s = s[(c[s] != c[q]) & (~minor[s] | (ids[s] < ids[q]))]
                    if before[q]:
                        s = s[[before[q].isdisjoint(before[x]) for x in s.tolist()]]
                    if len(s):
                        out.append(pa.RecordBatch.from_pydict({"a": pa.array(np.minimum(ids[s], ids[q])), "b": pa.array(np.maximum(ids[s], ids[q]))}))
            if out:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([o.column(k) for o in out]) for k in range(2)], ["a", "b"])

    keys = [*key, "i", "j"]
    rows = rows.select(*keys, "probe", "minor", "id", "n", "c", "sketch", "named")
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(join, "a long, b long")


def _groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, list]]:
    """Rows that come sorted by their first ``n_keys`` columns, group by group, whatever batches a group spans: the
    keys, and the other columns as arrays."""

    held, now = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        keys = np.column_stack([c.astype(np.int64) for c in columns[:n_keys]])
        starts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
        for x, y in zip(starts, starts[1:], strict=False):
            key = tuple(keys[x].tolist())
            if key != now:
                if held:
                    yield now, [np.concatenate(parts) for parts in zip(*held, strict=True)]
                held, now = [], key
            held.append([c[x:y] for c in columns[n_keys:]])
    if held:
        yield now, [np.concatenate(parts) for parts in zip(*held, strict=True)]


def whole_sets(ids: DataFrame, docs: DataFrame, order, n: int = WORDS, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The whole sets of documents, by id, as bytes; of each row of a repeated id."""
    ids = F.broadcast(ids) if ids.count() <= MOST_BROADCAST else ids
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text")).join(ids, "id", "left_semi")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, ranks = Shingler(n), order.value
        for b in batches:
            sets = [ranks.keys(shingle(t))[0].tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"id": b.column(0), "grams": pa.array(sets, pa.binary())})

    return rows.mapInArrow(whole, "id long, grams binary")


def decide(pairs: DataFrame, sets: DataFrame, share: int = SHARE) -> DataFrame:
    """Of the pairs (a, b), those that are linked, by their whole sets. A set ``a`` comes once for up to PARTNERS of its
    partners, ahead of them; one such group and a batch is all a task holds."""
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / min(BLOCK, PARTNERS)).alias("blocks"))
    left = many.select("a", F.explode(F.expr("sequence(0, cast(blocks as int) - 1)")).alias("block"), F.lit(None).cast("long").alias("b")).join(sets.withColumnRenamed("id", "a"), "a")
    dealt = pairs.join(many, "a").select("a", F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int").alias("block"), "b")
    right = dealt.join(sets.withColumnRenamed("id", "b"), "b").select("a", "block", "b", "grams")
    rows = left.select("a", "block", "b", "grams").unionByName(right)
    rows = rows.repartition("a", "block").sortWithinPartitions("a", "block", F.col("b").asc_nulls_first())

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, probes, cands, names = None, [], [], []

        def links() -> pa.RecordBatch:
            out = set()
            if probes and cands:
                for s, _, _ in tree_join(cands, np.array([len(c) for c in cands]), probes, np.array([len(p) for p in probes]), share):
                    out.add((group[0], names[s]))
            out = sorted(out)
            return pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

        for batch in batches:
            for a, block, b, grams in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if (a, block) != group:
                    yield links()
                    group, probes, cands, names = (a, block), [], [], []
                one = np.frombuffer(grams, np.int64)
                if b is None:
                    probes.append(one)
                else:
                    cands.append(one)
                    names.append(b)
                    if len(cands) >= 64:
                        yield links()
                        cands, names = [], []
        yield links()

    return rows.mapInArrow(check, "a long, b long")


def components(docs: DataFrame, n: int = WORDS, share: int = SHARE, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row: id, size of its set, and the least id that links lead to."""
    spark = docs.sparkSession
    small_batches(spark)
    order = spark.sparkContext.broadcast(fit_order(docs, n, text_col, id_col))
    whole = written(features(docs, order, n, share, text_col, id_col), "n-gram-features")
    classes = whole.filter("n > 0 and doc_id is not null").groupBy("name").agg(F.min_by(F.struct("doc_id", "n", "prefix", "salt", "sketch"), "doc_id").alias("r")).select("name", F.col("r.doc_id").alias("id"), "r.n", "r.prefix", "r.salt", "r.sketch")
    classes = written(classes, "n-gram-classes")
    # Prefixes and sketches are wanted once a class from here on.
    rows = written(whole.select("doc_id", "n", "name"), "n-gram-rows")
    discard(whole)
    usable = rows.filter("n > 0 and doc_id is not null")
    met = written(meetings(classes), "n-gram-meetings")
    component, sets, old = None, None, []
    # An id whose rows hold different sets joins their classes.
    several = usable.groupBy("doc_id").agg(F.min("name").alias("a"), F.max("name").alias("b")).filter("a < b").select("doc_id")
    several = written(several, "n-gram-repeated")
    if several.head(1):
        held = usable.join(several, "doc_id").select("doc_id", "name").distinct().join(classes.select("name", "id"), "name")
        component = written(connected(held.select(F.col("doc_id").alias("a"), F.col("id").alias("b"))), "n-gram-components")

    def linked(pairs: DataFrame) -> bool:
        """Decides pairs and joins what is linked to the components; the sets of earlier pairs are still there."""
        nonlocal component, sets
        pairs = written(pairs, "n-gram-pairs")
        ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
        if sets is not None:
            ids = ids.join(sets.select("id"), "id", "left_anti")
        more = written(whole_sets(ids, docs, order, n, text_col, id_col), "n-gram-sets")
        old.append(more)
        sets = more if sets is None else sets.unionByName(more)
        found = written(decide(pairs, sets, share), "n-gram-links")
        discard(pairs)
        if not found.head(1):
            return False
        links = found if component is None else found.unionByName(component.select(F.col("component").alias("a"), F.col("id").alias("b")))
        component = written(connected(links), "n-gram-components")
        discard(found)
        return True

    linked(picks(with_components(met, None).withColumn("other", F.struct("hub.id", "hub.n", F.col("hub.id").alias("c"))), share))
    by = Window.partitionBy("gram", "salt").orderBy("at")
    linked(picks(with_components(met, component).withColumn("other", F.lag(F.struct("id", "n", "c")).over(by)), share))
    placed = with_components(met, component)
    crowds = written(crowds_of(placed), "n-gram-crowds")
    near = bounded(listed_pairs(placed, share), crowds, share)
    far = far_pairs(crowds, classes.select("id", "sketch"), share)
    linked(near.unionByName(far).distinct())
    discard(met, crowds, *old)
    if component is None:
        component = spark.createDataFrame([], "id long, component long")
    # Classes of one document without links need no entry: their row names itself.
    several = usable.groupBy("name").agg(F.min("doc_id").alias("id"), F.max("doc_id").alias("last"))
    names = several.join(component, "id", "left").filter("component is not null or id < last").select("name", F.coalesce("component", "id").alias("component"))
    out = rows.select("doc_id", "n", "name").join(names, "name", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), own.alias("component_id"))


def keep_one(docs: DataFrame, n: int = WORDS, share: int = SHARE, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with one document of each component, its least id. Rows without an id or words all stay; of rows that
    repeat an id and its text one stays, and an id's different texts all do."""
    found = written(components(docs, n, share, text_col, id_col), "n-gram-components")
    (gone_id,) = fresh(docs, "gone")
    matched = lambda ids: F.broadcast(ids) if ids.count() <= MOST_BROADCAST else ids
    me = docs[id_col].cast("long")
    gone = matched(found.filter("component_id < doc_id").select(F.col("doc_id").alias(gone_id)).distinct())
    kept = docs.join(gone, me == gone[gone_id], "left_anti")
    again = written(found.filter("doc_id is not null and n_shingles > 0").groupBy(F.col("doc_id").alias(gone_id)).count().filter("count > 1").select(gone_id), "n-gram-repeated")
    if not again.head(1):
        return kept
    again = matched(again)
    once, several = kept.join(again, me == again[gone_id], "left_anti"), kept.join(again, me == again[gone_id], "left_semi")
    wordless = F.trim(F.translate(text_or_empty(text_col), "\t\n\x0b\x0c\r", "     ")) == ""
    row = F.min_by(F.struct(*(F.col(f"`{c}`") for c in docs.columns)), same_row(docs)).alias("row")
    one = several.filter(~wordless).groupBy(F.col(id_col).cast("long"), F.xxhash64(text_col)).agg(row).select("row.*")
    return once.unionByName(several.filter(wordless)).unionByName(one)
