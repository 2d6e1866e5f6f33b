"""What the tags of a feature say, as folds over the ordered array ``tags`` of (k, v)."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schema as S
from ..dims import GENERIC, Classes


def class_code(classes: Classes, key: Column, value: Column) -> Column:
    """The class of one tag; 0 if none. A look-up by key, then among that key's values."""
    by_key: dict[str, dict[str, int]] = defaultdict(dict)
    for name, code in classes.codes.items():
        k, _, v = name.partition(":")
        by_key[k][v] = code
    maps = F.create_map(*(x for k, vs in by_key.items() for x in (F.lit(k), F.create_map(*(F.lit(y) for v, c in vs.items() for y in (v, c))))))
    return F.coalesce(F.try_element_at(F.try_element_at(maps, key), value), F.lit(0))


def fold_class(classes: Classes, tags: Column) -> Column:
    """The class of a feature: parks win, winter sports win over the rest, and generic classes give way."""
    parks = [classes["boundary:national_park"], classes["boundary:protected_area"]]
    winter = classes["landuse:winter_sports"]
    yields = sorted({classes[n] for n in GENERIC} | {c for c in classes.names if classes.is_building(c)})

    def step(cur: Column, tag: Column) -> Column:
        c = class_code(classes, tag["k"], tag["v"])
        return (
            F.when(c == 0, cur).when(c.isin(parks), c).when(cur.isin(parks), cur).when(c == winter, c).when(cur.isin(yields), c).otherwise(cur)
        )

    return F.aggregate(F.coalesce(tags, F.array().cast(f"array<{S.TAG}>")), F.lit(0), step)


def unclassed(classes: Classes, tags: Column) -> Column:
    """The tags that name no class; only these are read for anything but the building flag."""
    return F.filter(F.coalesce(tags, F.array().cast(f"array<{S.TAG}>")), lambda t: class_code(classes, t["k"], t["v"]) == 0)


def last(tags: Column, *keys: str) -> Column:
    """The value of the last tag with one of the keys; null without one."""
    return F.try_element_at(F.filter(tags, lambda t: t["k"].isin(*keys)), F.lit(-1))["v"]


def has(tags: Column, key: str, *values: str) -> Column:
    return F.exists(tags, lambda t: (t["k"] == key) & t["v"].isin(*values))


def has_other(tags: Column, key: str, value: str) -> Column:
    return F.exists(tags, lambda t: (t["k"] == key) & (t["v"] != value))


def _bits(*pairs: tuple[Column, int]) -> Column:
    out = F.lit(0)
    for on, bit in pairs:
        out = out.bitwiseOR(F.when(on, bit).otherwise(0))
    return out


def building(tags: Column) -> Column:
    """Any building tag counts, "no" included, and whether or not it names a class."""
    return F.exists(F.coalesce(tags, F.array().cast(f"array<{S.TAG}>")), lambda t: t["k"] == "building")


def node_flags(tags: Column, rest: Column) -> Column:
    return _bits(
        (building(tags), S.BUILDING), (has(rest, "capital", "yes"), S.COUNTRY_CAPITAL),
        (has(rest, "capital", "4") | has(rest, "state_capital", "yes"), S.STATE_CAPITAL),
    )


def way_flags(tags: Column, rest: Column) -> Column:
    return _bits(
        (building(tags), S.BUILDING), (has(rest, "oneway", "yes"), S.FORWARD), (has(rest, "oneway", "-1"), S.REVERSE),
        *((has_other(rest, key, "no"), bit) for key, bit in (("bridge", S.BRIDGE), ("tunnel", S.TUNNEL), ("cutting", S.CUTTING))),
    )


def relation_flags(tags: Column) -> Column:
    return _bits((building(tags), S.BUILDING))


def whole(text: Column) -> Column:
    """The whole number that a text begins with; 0 if it doesn't."""
    digits = F.regexp_extract(F.coalesce(text, F.lit("")), r"^\s*([+-]?\d{1,9})", 1)
    return F.coalesce(digits.try_cast("int"), F.lit(0))


def first_part(text: Column) -> Column:
    """A text up to its first semicolon."""
    return F.substring_index(text, ";", 1)


def reference(rest: Column) -> Column:
    """The last "ref"; before any, a "junction:ref" fills in."""
    start = F.lit("")
    fold = F.aggregate(
        F.filter(rest, lambda t: t["k"].isin("ref", "junction:ref")), start,
        lambda acc, t: F.when((t["k"] == "ref") | (acc == ""), first_part(t["v"])).otherwise(acc),
    )
    return F.substring(fold, 1, 255)


def protection(rest: Column) -> tuple[Column, Column]:
    """Protection class, and whether ownership is national (as it is unless a tag says otherwise)."""
    return whole(last(rest, "protect_class", "protect_id")), ~has_other(rest, "ownership", "national")


def pistes(tags: Column) -> tuple[Column, Column, Column]:
    """Downhill, nordic, and the difficulty from 0 on; -1 without one."""
    grades = ("novice", "easy", "intermediate", "advanced", "expert")
    known = F.filter(tags, lambda t: (t["k"] == "piste:difficulty") & t["v"].isin(*grades))
    grade = F.array_position(F.array(*map(F.lit, grades)), F.try_element_at(known, F.lit(-1))["v"]) - 1
    return has(tags, "piste:type", "downhill"), has(tags, "piste:type", "nordic"), F.coalesce(grade, F.lit(-1)).cast("int")


def override_class(classes: Classes, code: Column, protect: Column, national: Column, piste: tuple[Column, Column, Column] | None = None) -> Column:
    """Parks by their protection class, and for ways pistes by difficulty."""
    park = national & code.isin(classes["boundary:national_park"], classes["boundary:protected_area"])
    out = F.when(park, F.when(protect == 2, classes["boundary:national_park2"]).when(protect == 3, classes["boundary:national_monument3"]).otherwise(code))
    if piste is not None:
        downhill, nordic, grade = piste
        runs = F.array(*(F.lit(classes[f"piste:downhill{k}"]) for k in range(5)))
        out = out.when(downhill & grade.between(0, 4), F.get(runs, grade)).when(nordic & (code == 0), classes["piste:nordic"])
    return out.otherwise(code)
