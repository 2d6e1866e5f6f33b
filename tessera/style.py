"""Style sheets: which classes are drawn, how, and from which zoom on."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schema import LINE_MODES

#: The zoom of a class that is never drawn.
NEVER = 999


class StyleError(ValueError):
    pass


def line_mode(text: str | None) -> int:
    """The bits of a comma-separated list of line modes."""
    mode = 0
    for name in (text or "solid").split(","):
        if name not in LINE_MODES:
            raise StyleError(f"unknown line mode {name!r}")
        mode |= LINE_MODES[name]
    return mode


def color(text: str) -> tuple[float, float, float, float]:
    """RRGGBBAA as four parts of one."""
    if len(text) != 8:
        raise StyleError(f"not a color: {text!r}")
    try:
        return tuple(int(text[k : k + 2], 16) / 255 for k in (0, 2, 4, 6))
    except ValueError:
        raise StyleError(f"not a color: {text!r}") from None


@dataclass
class Style:
    layers: dict[str, int] = field(default_factory=dict)
    colors: dict[str, tuple[float, float, float, float]] = field(default_factory=dict)
    lines: dict[str, dict] = field(default_factory=dict)
    polys: dict[str, dict] = field(default_factory=dict)
    points: dict[str, dict] = field(default_factory=dict)
    classes: dict[str, dict] = field(default_factory=dict)

    @staticmethod
    def parse(text: str) -> Style:
        """From XML. What an element refers to must be declared before it."""
        style = Style()
        try:
            root = ET.fromstring(text)
        except ET.ParseError as e:
            raise StyleError(f"not well-formed: {e}") from None
        for e in root:
            add = getattr(style, f"_add_{e.tag}", None)
            if add is None:
                raise StyleError(f"unknown element {e.tag!r}")
            add(dict(e.attrib))
        return style

    @staticmethod
    def read(spark: SparkSession, path: str) -> Style:
        """From a file, which may lie wherever Spark can read."""
        row = spark.read.text(path, wholetext=True).first()
        if row is None:
            raise StyleError(f"no style in {path}")
        return Style.parse(row[0])

    def _new(self, table: str, a: dict) -> str:
        name = a.get("name")
        if not name:
            raise StyleError(f"an element of {table} has no name")
        if name in getattr(self, table):
            raise StyleError(f"{name!r} is declared twice in {table}")
        return name

    def _known(self, table: str, name: str | None) -> str | None:
        if name is not None and name not in getattr(self, table):
            raise StyleError(f"{name!r} isn't declared in {table}")
        return name

    def _add_layer(self, a: dict) -> None:
        self.layers[self._new("layers", a)] = len(self.layers)

    def _add_color(self, a: dict) -> None:
        self.colors[self._new("colors", a)] = color(a.get("val", ""))

    def _common(self, a: dict, colors: tuple[str, ...]) -> dict:
        layer = self._known("layers", a.get("layer"))
        return {"min_zoom": int(a.get("min_zoom", 0)), "layer": self.layers[layer] if layer else 0} | {
            c: self._known("colors", a.get(c)) for c in colors
        }

    def _add_line(self, a: dict) -> None:
        extra = {"mode": line_mode(a.get("mode")), "width": float(a.get("width", 1))}
        self.lines[self._new("lines", a)] = self._common(a, ("color1", "color2")) | extra

    def _add_poly(self, a: dict) -> None:
        self.polys[self._new("polys", a)] = self._common(a, ("color",))

    def _add_point(self, a: dict) -> None:
        flags = {"".join(f.split()) for f in a.get("flags", "").split(",")} - {""}
        unknown = flags - {"ele:show", "marker:show", "label:center"}
        if unknown:
            raise StyleError(f"unknown point flags {sorted(unknown)}")
        extra = {f"{f.replace(':', '_')}": f in flags for f in ("ele:show", "marker:show", "label:center")}
        shown = self._common(a, ("text_color1", "text_color2", "marker_color1", "marker_color2"))
        self.points[self._new("points", a)] = shown | {"text_scale": float(a.get("text_scale", 1))} | extra

    def _add_class(self, a: dict) -> None:
        parts = {k: self._known(f"{k}s", a.get(k)) for k in ("line", "poly", "point")}
        self.classes[self._new("classes", a)] = {"abrev": int(a.get("abrev", 0))} | parts

    def min_zoom(self, name: str) -> int:
        """The least zoom at which any part of a class is drawn."""
        c = self.classes.get(name, {})
        zooms = [getattr(self, f"{k}s")[c[k]]["min_zoom"] for k in ("line", "poly", "point") if c.get(k)]
        return min(zooms, default=NEVER)

    def frame(self, spark: SparkSession) -> DataFrame:
        """A row a class; columns of a missing part are null."""
        rows = []
        for name, c in self.classes.items():
            line, poly, point = (getattr(self, f"{k}s").get(c[k], {}) for k in ("line", "poly", "point"))
            rows.append(
                (name, c["abrev"], line.get("min_zoom"), line.get("mode"), line.get("layer"), poly.get("min_zoom"), poly.get("layer"),
                 point.get("min_zoom"), point.get("layer"), *(int(point[f]) if point else None for f in ("ele_show", "marker_show", "label_center")))
            )
        return spark.createDataFrame(rows, STYLE_DIM)


STYLE_DIM = (
    "class_name string, abrev int, line_min_zoom int, line_mode int, line_layer int, poly_min_zoom int, poly_layer int, "
    "point_min_zoom int, point_layer int, show_ele int, show_marker int, label_center int"
)


def min_zoom(*parts: Column) -> Column:
    """The least zoom of a class' parts; parts it doesn't have are null."""
    return F.coalesce(F.least(*parts), F.lit(NEVER))


def color_parts(text: Column) -> Column:
    """Column form of ``color``."""
    value = F.conv(text, 16, 10).cast("long")
    part = lambda shift: (F.shiftright(value, shift).bitwiseAND(255) / F.lit(255.0)).cast("float")
    return F.struct(part(24).alias("r"), part(16).alias("g"), part(8).alias("b"), part(0).alias("a"))


def line_mode_bits(text: Column) -> Column:
    """Column form of ``line_mode``; null where a name is unknown."""
    names = F.split(text, ",")
    bit = F.lit(None).cast("int")
    return F.aggregate(names, F.lit(0), lambda acc, n: acc.bitwiseOR(_mode_bit(n, bit)))


def _mode_bit(name: Column, unknown: Column) -> Column:
    out = unknown
    for k, v in LINE_MODES.items():
        out = F.when(name == k, F.lit(v)).otherwise(out)
    return out
