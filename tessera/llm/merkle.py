"""Document fingerprints: a Merkle tree over a text's sections and paragraphs. DataFrame functions only.

A paragraph is a line. Its leaves are cut by content: a leaf ends after the first delimiter from ``LEAF_LEAST``
characters on, or at ``LEAF_MOST``, so that an insertion moves the cuts of the next leaves only. A section is a run of
paragraphs: it ends after a paragraph whose hash is 0 modulo ``SECTION_PARAGRAPHS``, so an edit moves no later
section's bounds. A paragraph's hash covers its leaves' hashes, a section's its paragraphs', and the root all
sections', all by whole SHA-256 digests. Equal roots mean equal texts; where roots differ, only sections that the
other text lacks need be looked into, and of these only paragraphs that its differing sections lack.

A fingerprint is one string: ``root/section=paragraph,paragraph;section=...``. The root is shown whole, a section by
the first 16 hex digits of its hash, a paragraph as its leaves, by ten each: short forms to compare branches by, not
what the hashes above are made of. The likeness of two fingerprints is Dice's coefficient of their distinct leaves,
1 at equal roots.

Defined cases: a null text counts as empty, and two empty texts have likeness 1; the next document follows in
ascending id (then by a hash of the text; null ids come last), after the last comes the first; repeated rows of
one id and text count as one document and get the same values each; an empty table gives an empty result; columns
other than the id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, text_or_empty, written

LEAF_LEAST, LEAF_MOST = 28, 64
#: A line's end, or a leaf: to the first delimiter after LEAF_LEAST - 1 characters, else up to LEAF_MOST.
LEAVES = rf"\n|[^\n]{{{LEAF_LEAST - 1},{LEAF_MOST - 1}}}?[ \t.,;:!?/&=-]|[^\n]{{1,{LEAF_MOST}}}"
SECTION_PARAGRAPHS = 4
DIGEST, LEAF_DIGITS, SECTION_DIGITS = 64, 10, 16
#: Range partitions into which ids are dealt to find each one's successor: each holds this many ids at most.
IDS_PER_PARTITION = 2_000_000


def _hash(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _paragraph(digests: Column) -> Column:
    """A paragraph's digest and its leaves, from its leaves' digests."""
    leaves = F.regexp_replace(digests, f"([0-9a-f]{{{LEAF_DIGITS}}})[0-9a-f]{{{DIGEST - LEAF_DIGITS}}}", "$1")
    return F.concat(_hash(digests), F.lit(":"), leaves)


def _ended(paragraph: Column) -> Column:
    ends = F.substring(paragraph, 1, 1).isin(*(f"{d:x}" for d in range(0, 16, SECTION_PARAGRAPHS)))
    return F.concat(paragraph, F.when(ends, ";").otherwise(","))


def _section(s: Column) -> Column:
    """A section's digest and its paragraphs' leaves, from digests and leaves of its paragraphs."""
    digests = F.transform(F.split(s, ","), lambda p: F.substring(p, 1, DIGEST))
    leaves = F.transform(F.split(s, ","), lambda p: F.substring(p, DIGEST + 2, 1 << 30))
    return F.concat(_hash(F.array_join(digests, "")), F.lit("="), F.array_join(leaves, ","))


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds the fingerprint of a non-null text column. Each step is a column, so that it is evaluated once."""
    (t,) = fresh(df, "tree")
    df = df.withColumn(t, F.regexp_extract_all(F.col(text), F.lit(LEAVES), F.lit(0)))
    df = df.withColumn(t, F.array_join(F.transform(t, lambda x: F.when(x == "\n", ",").otherwise(_hash(x))), ""))
    df = df.withColumn(t, F.transform(F.split(t, ","), _paragraph))
    df = df.withColumn(t, F.array_join(F.transform(t, _ended), ""))
    # The last paragraph ends the last section.
    df = df.withColumn(t, F.transform(F.split(F.expr(f"substring({t}, 1, length({t}) - 1)"), ";"), _section))
    tops = F.array_join(F.transform(t, lambda s: F.substring(s, 1, DIGEST)), "")
    shown = F.transform(t, lambda s: F.concat(F.substring(s, 1, SECTION_DIGITS), F.substring(s, DIGEST + 1, 1 << 30)))
    return df.withColumn(name, F.concat(_hash(tops), F.lit("/"), F.array_join(shown, ";"))).drop(t)


def leaves(fp: Column) -> Column:
    """The distinct leaf hashes of a fingerprint."""
    sections = F.split(F.substring(fp, DIGEST + 2, 1 << 30), ";")
    paragraphs = F.array_join(F.transform(sections, lambda s: F.substring(s, SECTION_DIGITS + 2, 1 << 30)), ",")
    return F.array_distinct(F.regexp_extract_all(paragraphs, F.lit(f"[0-9a-f]{{{LEAF_DIGITS}}}"), F.lit(0)))


def root(fp: Column) -> Column:
    return F.substring(fp, 1, DIGEST)


def likeness(a: Column, b: Column) -> Column:
    """Dice's coefficient of two arrays of distinct leaves."""
    both = F.size(a) + F.size(b)
    return F.when(both == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(a, b)) / both)


def with_edits(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """Adds where the trees of two fingerprints differ: ``gone``, the paragraphs of ``a`` that ``b`` lacks, and ``come``,
    those of ``b`` that ``a`` lacks, by section and place in it, from 0. Branches are matched by hash: sections that
    the other has aren't entered, and a shifted paragraph is no edit. Each step is a column, evaluated once."""
    x, y, open_x, open_y, parts_x, parts_y = fresh(df, "sections_a", "sections_b", "open_a", "open_b", "paragraphs_a", "paragraphs_b")
    df = df.withColumns({t: F.split(F.substring(F.col(fp), DIGEST + 2, 1 << 30), ";") for fp, t in ((a, x), (b, y))})

    def differing(mine: str, other: str) -> Column:
        numbered = F.transform(mine, lambda s, i: F.struct(s.alias("s"), i.alias("section")))
        return F.filter(numbered, lambda s: ~F.array_contains(F.col(other), s["s"]))

    def paragraphs(t: str) -> Column:
        inside = lambda s: F.split(F.substring(s["s"], SECTION_DIGITS + 2, 1 << 30), ",")
        return F.flatten(F.transform(t, lambda s: F.transform(inside(s), lambda p, j: F.struct(s["section"].alias("section"), j.alias("paragraph"), p.alias("p")))))

    def lacking(mine: str, other: str) -> Column:
        found = F.filter(mine, lambda p: ~F.array_contains(F.col(other)["p"], p["p"]))
        return F.transform(found, lambda p: F.struct(p["section"].alias("section"), p["paragraph"].alias("paragraph")))

    df = df.withColumns({open_x: differing(x, y), open_y: differing(y, x)}).drop(x, y)
    df = df.withColumns({parts_x: paragraphs(open_x), parts_y: paragraphs(open_y)}).drop(open_x, open_y)
    return df.withColumn(name, F.struct(lacking(parts_x, parts_y).alias("gone"), lacking(parts_y, parts_x).alias("come"))).drop(parts_x, parts_y)


def _shown(edits: Column) -> Column:
    """Edits as text: ``-section.paragraph,... +section.paragraph,...``."""
    listed = lambda c: F.array_join(F.transform(edits[c], lambda e: F.concat(e["section"].cast("string"), F.lit("."), e["paragraph"].cast("string"))), ",")
    return F.concat(F.lit("-"), listed("gone"), F.lit(" +"), listed("come"))


def fingerprints(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return with_fingerprint(rows, "text", "fingerprint").drop("text")


def _neighbours(keys: DataFrame) -> DataFrame:
    """For each key (none, id, tie): the key before it and that one's length ``n``, in a circle.

    Keys are dealt by range and each range is walked on its own; what crosses two ranges is settled on one row a
    range. The dealt keys are written, since where ranges end is decided by sampling."""
    order = ["none", "id", "tie"]
    least = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = keys.repartitionByRange(max(least, keys.count() // IDS_PER_PARTITION), *order)
    dealt = written(dealt.withColumn("part", F.spark_partition_id()), "keys")
    me = F.struct(*order, "n")
    ends = dealt.groupBy("part").agg(F.max(me).alias("end"))  # a row a range
    across = Window.orderBy("part")
    whole = across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("part", F.coalesce(F.lag("end").over(across), F.last("end").over(whole)).alias("before"))
    inside = Window.partitionBy("part").orderBy(*order)
    found = dealt.withColumn("prev", F.lag(me).over(inside)).join(F.broadcast(ends), "part")
    return found.select(*order, F.coalesce("prev", "before").alias("prev")).select(
        *order, F.col("prev.none").alias("p_none"), F.col("prev.id").alias("p_id"), F.col("prev.tie").alias("p_tie"), F.col("prev.n").alias("p_n")
    )


def compare_with_edits(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Each text's fingerprint, that of its edited text (the last quarter replaced by as much of the next
    document's beginning), the likeness of its fingerprint to the edited text's and the next document's, and where
    the edited text's tree differs."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    key = [F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text").alias("tie")]
    order = ["none", "id", "tie"]
    keys = rows.select(*key, F.char_length("text").alias("n")).groupBy(*order).agg(F.max("n").alias("n"))
    links = written(_neighbours(keys), "neighbours")
    # Both uses of this join read the same columns, so that texts are shuffled once; the id follows from its key.
    mine = rows.select(*key, "text").join(links, order)
    mine = with_fingerprint(mine, "text", "fingerprint")
    # What each document gives to the one before it; that one's own columns stay where the join has put them.
    given = mine.select(
        F.col("p_none").alias("none"), F.col("p_id").alias("id"), F.col("p_tie").alias("tie"),
        F.struct(F.expr("substring(text, 1, cast(p_n div 4 as int))").alias("head"), F.col("fingerprint").alias("next")).alias("given"),
    ).groupBy(*order).agg(F.first("given").alias("given"))
    both = mine.select(*order, "text", "fingerprint").join(given, order).withColumn("doc_id", F.when(~F.col("none"), F.col("id")))
    n = F.char_length("text")
    edited = F.concat(F.expr("substring(text, 1, char_length(text) - cast(char_length(text) div 4 as int))"), F.col("given.head"))
    both = both.select("doc_id", n.cast("long").alias("n_chars"), "fingerprint", F.col("given.next").alias("next"), edited.alias("edited"))
    both = with_fingerprint(both, "edited", "edited_fingerprint").withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    for name, fp in (("l_mine", "fingerprint"), ("l_edited", "edited_fingerprint"), ("l_next", "next")):
        both = both.withColumn(name, leaves(F.col(fp)))
    same = {"edited": "edited_fingerprint", "next": "next"}
    near = {f"near_{x}": F.when(root(F.col("fingerprint")) == root(F.col(fp)), 1.0).otherwise(likeness(F.col("l_mine"), F.col(f"l_{x}"))) for x, fp in same.items()}
    both = both.withColumns(near).select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", *near)
    return with_edits(both, "fingerprint", "edited_fingerprint", "edits").withColumn("edits", _shown(F.col("edits")))
