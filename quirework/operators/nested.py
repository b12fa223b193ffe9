"""Problem 7: deeply nested page records as related flat tables.

Producers write a page in many shapes. A bottom-up tree automaton reads each JSON value once: leaves get a state by
their type, arrays the state of the set of their members' states, objects the state that the states of their fields
give. An object's variant is its state with the fields and states it was made of. The states choose the reader of a
polygon and the page inside a wrapper, and the variant routes an object to its typed subtype table.

Supertype tables hold what all variants of a kind share, with common keys that keep the parent: pages (page_id),
regions (+ region_pos), lines (+ line_pos) and points (+ point_pos). ``PageTables.subtype`` is the table of one
variant: the same keys and a column for each of its fields, of the type its state gives. Fields that no supertype
knows are kept: typed in the subtypes, and as text in ``extra``.

Only the latest intact body of each page counts: bodies that do not parse, or whose value is no object, are left out
before the choice. Bodies received at the same time are told apart by their text (the greatest). Bare NaN and
infinities are intact and become null. Missing or null regions, lines and polygons give no rows below them; a single
region or line in place of an array is an array of one; null entries of arrays have no row, but keep their position,
and points that cannot be read are points with null coordinates. Null page ids are left out, null bodies are not
intact. An empty table gives empty tables. Whole bodies are read, of any depth and length; one body is one task's work.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from typing import Any, NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirework.runtime import save

# Names of the same field in records of different producers, in the order of their precedence.
POLYGON = ("polygon", "coords", "region_coords")
NAME = ("name", "region_name")
CONF = ("conf", "region_conf")
# The fields that the supertypes know, by kind.
KNOWN = {
    "page": ("image_path", "width", "height", "language", "stats", "regions", "page"),
    "region": (*POLYGON, *NAME, *CONF, "lines"),
    "line": (*POLYGON, *CONF, "text", "script", "line_conf", "script_conf"),
}
#: The four values of ``stats`` that are numbers, and the one that is a count.
STATS = ("PC", "PC25", "PC50", "PC75", "N_LONG_ROWTEXT")

NUMBER = r"-?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"
_PAIR = re.compile(rf"({NUMBER})\s*,\s*({NUMBER})")
_POINTS = re.compile(rf"\s*{NUMBER}\s*,\s*{NUMBER}(?:[\s;]+{NUMBER}\s*,\s*{NUMBER})*\s*")
KEYS = ("page_id", "region_pos", "line_pos")
NODE = "page_id long, kind string, region_pos int, line_pos int, variant string, fields map<string,string>, points array<struct<x:double,y:double>>"
_COLUMNS = [c.strip().split(" ")[0] for c in re.sub(r"<.*?>+", "", NODE).split(",")]


# The automaton


class Tree(NamedTuple):
    """A value with its state, and the trees of an object's fields or an array's members that the state came from."""

    value: Any
    state: str
    parts: dict[str, Tree] | list[Tree] | None = None


POLYGONS = ("points_text", "flat_points", "pair", "pairs", "points", "mixed_points")
# Transitions of arrays: the states of their members, nulls aside, to the state of the array.
ARRAYS = {
    frozenset(): "none",
    frozenset({"pair"}): "pairs",
    frozenset({"point"}): "points",
    frozenset({"pair", "point"}): "mixed_points",
    **{frozenset(x): "lines" for x in ({"line"}, {"line", "shape"})},
    **{frozenset(x): "regions" for x in ({"region"}, {"region", "shape"})},
    frozenset({"shape"}): "shapes",
}
# Transitions of objects, the first that holds: fields that must be there, with the states they may have (none: any).
OBJECTS: tuple[tuple[str, dict[str, frozenset[str]]], ...] = (
    ("point", {"x": frozenset({"num", "null", "text"}), "y": frozenset({"num", "null", "text"})}),
    ("wrapped_page", {"page": frozenset({"page", "region", "line", "shape", "object", "point", "wrapped_page"})}),
    *(("page", {f: frozenset()}) for f in ("regions", "image_path")),
    *(("region", {f: frozenset()}) for f in ("lines", "name", "region_name", "region_conf", "region_coords")),
    *(("line", {f: frozenset()}) for f in ("text", "line_conf", "script")),
    *(("shape", {f: frozenset(POLYGONS)}) for f in POLYGON),
)


def tree(v: Any) -> Tree:
    """The value read bottom-up."""
    if v is None or (type(v) is float and not math.isfinite(v)):
        return Tree(None, "null")
    if isinstance(v, bool):
        return Tree(v, "bool")
    if isinstance(v, (int, float)):
        return Tree(v, "num")
    if isinstance(v, str):
        return Tree(v, "points_text" if _POINTS.fullmatch(v) else "text")
    if isinstance(v, list):
        if v and all(type(x) is list and len(x) == 2 and _numbers(x) for x in v):
            return Tree(v, "pairs")  # most values are points: their members are not kept
        if v and _numbers(v):
            return Tree(v, "pair" if len(v) == 2 else "flat_points")
        parts = [tree(x) for x in v]
        return Tree(v, ARRAYS.get(frozenset(p.state for p in parts if p.state != "null"), "mixed"), parts)
    fields = {k: tree(x) for k, x in v.items()}
    return Tree(v, _object(fields), fields)


def _numbers(v: list) -> bool:
    return all(type(x) is int or type(x) is float for x in v)


def _object(fields: dict[str, Tree]) -> str:
    for state, need in OBJECTS:
        if all(f in fields and (not among or fields[f].state in among) for f, among in need.items()):
            return state
    return "object"


def variant(t: Tree) -> str:
    """State of an object with the states of its fields: ``line {"text": "text", ...}``."""
    return f"{t.state} {json.dumps({k: p.state for k, p in sorted(t.parts.items())}, ensure_ascii=False)}"


# Readers


def first_of(fields: dict[str, Tree], names: tuple[str, ...]) -> Tree | None:
    """The first field of these names that holds a value."""
    return next((fields[n] for n in names if n in fields and fields[n].value is not None), None)


def _number(v: Any) -> float | None:
    if isinstance(v, bool) or not isinstance(v, (int, float, str)):
        return None
    try:
        x = float(v)
    except (ValueError, OverflowError):
        return None
    return x if math.isfinite(x) else None


def points_of(polygon: Tree | None) -> list[tuple[float | None, float | None]]:
    """Points of a polygon by the reader of its state."""
    if polygon is None:
        return []
    v, state = polygon.value, polygon.state
    if state == "points_text":
        return [(_number(a), _number(b)) for a, b in _PAIR.findall(v)]
    if state in ("flat_points", "pair"):
        return [(_number(a), _number(b)) for a, b in zip(v[::2], v[1::2], strict=False)]
    if not isinstance(v, list):
        return []
    if state == "points":
        return [(_number(p.get("x")), _number(p.get("y"))) if p else (None, None) for p in v]
    return [_point(p) for p in v]


def _point(p: Any) -> tuple[float | None, float | None]:
    if isinstance(p, dict):
        return _number(p.get("x")), _number(p.get("y"))
    return (_number(p[0]), _number(p[1])) if isinstance(p, list) and len(p) >= 2 else (None, None)


def _members(t: Tree | None) -> list[tuple[int, Tree]]:
    """The objects of an array with their positions; a single object as an array of one; of anything else none."""
    if t is None:
        return []
    parts = t.parts if isinstance(t.value, list) else [t] if isinstance(t.value, dict) else []
    return [(i, p) for i, p in enumerate(parts or []) if isinstance(p.value, dict)]


def _fields(t: Tree, below: tuple[str, ...]) -> dict[str, str]:
    """Values of an object as text, but for those that have rows of their own."""
    out = {}
    for k, p in t.parts.items():
        if p.value is not None and not (k in below and (p.state in POLYGONS or isinstance(p.value, (list, dict)))):
            out[k] = p.value if isinstance(p.value, str) else json.dumps(p.value, ensure_ascii=False)
    return out


def flatten(page_id: int, body: str) -> Iterator[tuple]:
    """Rows of ``NODE`` for one intact body: the page, its regions, their lines."""
    root = tree(json.loads(body))
    page = root.parts["page"] if root.state == "wrapped_page" else root
    whole = _fields(root, ("page", "regions")) | _fields(page, ("regions",)) if page is not root else _fields(root, ("regions",))
    yield page_id, "page", None, None, variant(page) if page is root else f"{root.state}/{variant(page)}", whole, None
    for i, r in _members(page.parts.get("regions")):
        yield page_id, "region", i, None, variant(r), _fields(r, (*POLYGON, "lines")), points_of(first_of(r.parts, POLYGON))
        for j, x in _members(r.parts.get("lines")):
            yield page_id, "line", i, j, variant(x), _fields(x, POLYGON), points_of(first_of(x.parts, POLYGON))


def _intact(body: str | None) -> bool:
    try:
        return body is not None and isinstance(json.loads(body), dict)
    except (ValueError, RecursionError):
        return False


@F.pandas_udf(T.BooleanType())
def intact(body: pd.Series) -> pd.Series:
    """Whether a body parses to an object."""
    return body.map(_intact).astype(bool)


def _flat(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        rows = [r for p, b in zip(f["page_id"], f["body"], strict=True) for r in flatten(p, b)]
        out = pd.DataFrame(rows, columns=_COLUMNS)
        for c in ("region_pos", "line_pos"):
            out[c] = out[c].astype("Int64")
        yield out


def latest(records: DataFrame, page_id: str, received_at: str, body: str) -> DataFrame:
    """The latest intact body of each page: ``page_id, body``. Chosen by rows without bodies, so these move once at most."""
    r = records.select(F.col(page_id).cast("long").alias("page_id"), F.col(received_at).alias("_at"), F.col(body).alias("body"))
    good = r.where("page_id is not null and body is not null").where(intact("body"))
    mark = F.struct(F.col("_at"), F.sha2("body", 256).alias("_h"))
    best = good.select("page_id", mark.alias("_m")).groupBy("page_id").agg(F.max("_m").alias("_m"))
    best = best.select("page_id", F.col("_m._at").alias("_at"), F.col("_m._h").alias("_h"))
    keyed = r.where("page_id is not null and body is not null").withColumn("_h", F.sha2("body", 256)).alias("a")
    same = (F.col("a.page_id") == F.col("b.page_id")) & (F.col("a._h") == F.col("b._h")) & F.col("a._at").eqNullSafe(F.col("b._at"))
    return keyed.join(best.alias("b"), same, "left_semi").select("page_id", "body").dropDuplicates(["page_id"])


# Tables


def _text(*names: str) -> Column:
    return F.coalesce(*(F.col("fields")[n] for n in names))


def _real(*names: str) -> Column:
    v = _text(*names).try_cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v)


def _whole(name: str) -> Column:
    v = _real(name)
    return F.when(F.abs(v) < 2.0**62, v.cast("long"))


def states_of(variant: str) -> dict[str, str]:
    """Fields of a variant and their states."""
    return json.loads(variant.split("/")[-1].split(" ", 1)[1])


class PageTables:
    """Flat tables of page records; each keeps the keys of its parents."""

    def __init__(self, nodes: DataFrame):
        self.nodes = nodes

    def _of(self, kind: str) -> DataFrame:
        return self.nodes.where(F.col("kind") == kind)

    @property
    def pages(self) -> DataFrame:
        stats = F.from_json(_text("stats"), ", ".join(f"{s} {'long' if s.startswith('N_') else 'double'}" for s in STATS), {"allowNonNumericNumbers": "true"})
        return self._of("page").select("page_id", "variant", _text("image_path").alias("image_path"), _whole("width").alias("width"), _whole("height").alias("height"), _text("language").alias("language"), stats.alias("stats"))

    @property
    def regions(self) -> DataFrame:
        return self._of("region").select("page_id", "region_pos", "variant", _text(*NAME).alias("name"), _real(*CONF).alias("conf"), F.size("points").alias("n_points"))

    @property
    def lines(self) -> DataFrame:
        reals = [_real(c).alias(c) for c in ("line_conf", "script_conf")]
        return self._of("line").select(*KEYS, "variant", _text("text").alias("text"), _real(*CONF).alias("conf"), _text("script").alias("script"), *reals, F.size("points").alias("n_points"))

    @property
    def points(self) -> DataFrame:
        p = self.nodes.where("kind <> 'page'").select("page_id", "region_pos", F.coalesce("line_pos", F.lit(-1)).alias("line_pos"), F.posexplode("points").alias("point_pos", "_p"))
        return p.select(*KEYS, "point_pos", "_p.x", "_p.y")

    @property
    def extra(self) -> DataFrame:
        """Fields that no supertype knows, as text: ``KEYS, kind, field, value``."""
        known = F.create_map(*(F.lit(x) for k, names in KNOWN.items() for x in (k, list(names))))
        e = self.nodes.select(*KEYS, "kind", F.explode("fields").alias("field", "value"))
        return e.where(~F.array_contains(known[F.col("kind")], F.col("field")))

    def variants(self) -> DataFrame:
        """The structural variants and their numbers of rows: ``kind, variant, n``."""
        return self.nodes.groupBy("kind", "variant").agg(F.count(F.lit(1)).alias("n"))

    def subtype(self, kind: str, variant: str) -> DataFrame:
        """The typed table of one variant: ``KEYS`` of its kind and a column for each of its fields, in order of their names.

        Numbers, truth values and texts have their type, the polygon that counts is an array of points, other objects and
        arrays are JSON text; children with tables of their own are left out. A field named as a key gets ``_field`` appended.
        """
        keys = KEYS[: {"page": 1, "region": 2, "line": 3}[kind]]
        states = states_of(variant)
        polygon = next((n for n in POLYGON if states.get(n, "null") != "null"), None)
        below = {"page": ("regions",), "region": ("lines",), "line": ()}[kind]
        cols = []
        for name, state in states.items():
            if name in below and state not in ("text", "num", "bool", "null"):
                continue
            v = F.col("fields")[name]
            typed = {"num": _real(name), "bool": v.try_cast("boolean")}.get(state, v)
            cols.append((F.col("points") if kind != "page" and name == polygon and state in POLYGONS else typed).alias(f"{name}_field" if name in keys else name))
        return self._of(kind).where(F.col("variant") == variant).select(*keys, *cols)

    def subtypes(self, kind: str) -> dict[str, DataFrame]:
        """All typed tables of a kind by variant. The list of variants, a schema of the data, is read by the driver."""
        return {r["variant"]: self.subtype(kind, r["variant"]) for r in self.variants().where(F.col("kind") == kind).orderBy("variant").toLocalIterator()}


def page_tables(records: DataFrame, page_id: str = "page_id", received_at: str = "received_at", body: str = "body") -> PageTables:
    """Flat tables of the latest intact body of each page; parsed once and kept as one written table."""
    nodes = latest(records, page_id, received_at, body).mapInPandas(_flat, NODE)
    return PageTables(save(nodes).df)
