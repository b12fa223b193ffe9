"""Column expressions for boxes, polygons, confidences and identifiers; all planned by Catalyst.

A polygon is ARRAY<STRUCT<x, y>>. Null polygons give null; polygons of under three points have area 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LONG_ROW = 100


def _xs(polygon: Column) -> Column:
    return F.transform(polygon, lambda p: p["x"])


def _ys(polygon: Column) -> Column:
    return F.transform(polygon, lambda p: p["y"])


def box_of(polygon: Column) -> Column:
    """Struct ``x0, y0, x1, y1``: the least and greatest coordinates."""
    xs, ys = _xs(polygon), _ys(polygon)
    box = F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))
    return F.when(F.size(polygon) > 0, box)


def box_polygon(box: Column) -> Column:
    """The four corners of a box, clockwise from its top left."""
    at = lambda x, y: F.struct(box[x].alias("x"), box[y].alias("y"))
    return F.when(box.isNotNull(), F.array(at("x0", "y0"), at("x1", "y0"), at("x1", "y1"), at("x0", "y1")))


def whole_box(polygon: Column) -> Column:
    """``box_of`` with every vertex truncated towards zero first."""
    return box_of(F.transform(polygon, lambda p: F.struct(p["x"].cast("int").alias("x"), p["y"].cast("int").alias("y"))))


def placement(box: Column) -> Column:
    """Struct ``hpos, vpos, width, height``; sizes are at least 0."""
    zero = F.lit(0)
    return F.struct(
        box["x0"].alias("hpos"), box["y0"].alias("vpos"), F.greatest(box["x1"] - box["x0"], zero).alias("width"), F.greatest(box["y1"] - box["y0"], zero).alias("height")
    )


def polygon_area(polygon: Column) -> Column:
    """Half the absolute cross sum around the ring."""
    n = F.size(polygon)
    steps = F.sequence(F.lit(0), n - 1)
    cross = F.transform(
        steps,
        lambda i: F.get(polygon, i)["x"].cast("double") * F.get(polygon, (i + 1) % n)["y"] - F.get(polygon, (i + 1) % n)["x"].cast("double") * F.get(polygon, i)["y"],
    )
    return F.when(polygon.isNull(), None).when(n < 3, F.lit(0.0)).otherwise(F.abs(F.aggregate(cross, F.lit(0.0), lambda a, c: a + c)) / 2)


def area_fraction(polygon: Column, height: Column, width: Column) -> Column:
    return F.try_divide(polygon_area(polygon), height.cast("double") * width)


def interval_iou(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Overlap of two intervals over their hull; 0 where the hull is empty."""
    inside = F.greatest(F.least(a1, b1) - F.greatest(a0, b0), F.lit(0)).cast("double")
    hull = (F.greatest(a1, b1) - F.least(a0, b0)).cast("double")
    return F.when(hull <= 0, F.lit(0.0)).otherwise(inside / hull)


def axis_iou(a: Column, b: Column, axis: str = "y") -> Column:
    """``interval_iou`` of two boxes along an axis; 0.5 if a box is missing."""
    lo, hi = f"{axis}0", f"{axis}1"
    return F.when(a.isNull() | b.isNull(), F.lit(0.5)).otherwise(interval_iou(a[lo], a[hi], b[lo], b[hi]))


def box_area(b: Column) -> Column:
    return (b["x1"] - b["x0"]).cast("double") * (b["y1"] - b["y0"])


def box_intersection(a: Column, b: Column) -> Column:
    w = F.greatest(F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"]), F.lit(0)).cast("double")
    return w * F.greatest(F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"]), F.lit(0))


def box_iou(a: Column, b: Column) -> Column:
    i = box_intersection(a, b)
    return F.coalesce(F.try_divide(i, box_area(a) + box_area(b) - i), F.lit(0.0))


def box_distance(a: Column, b: Column) -> Column:
    """Distance of two boxes; 0 if they touch."""
    dx = F.greatest(a["x0"] - b["x1"], b["x0"] - a["x1"], F.lit(0)).cast("double")
    dy = F.greatest(a["y0"] - b["y1"], b["y0"] - a["y1"], F.lit(0)).cast("double")
    return F.sqrt(dx * dx + dy * dy)


def thickness(box: Column) -> Column:
    return F.least(box["x1"] - box["x0"], box["y1"] - box["y0"])


def box_features(box: Column) -> Column:
    """Struct of centre, anchor (top left), width and height."""
    return F.struct(
        ((box["x0"] + box["x1"]) / 2).alias("center_x"), ((box["y0"] + box["y1"]) / 2).alias("center_y"), box["x0"].alias("anchor_x"), box["y0"].alias("anchor_y"),
        (box["x1"] - box["x0"]).alias("width"), (box["y1"] - box["y0"]).alias("height"),
    )


def scale_polygon(polygon: Column, fx: Column, fy: Column) -> Column:
    """Each vertex scaled and rounded half to even."""
    return F.transform(polygon, lambda p: F.struct(F.rint(p["x"] * fx).cast("int").alias("x"), F.rint(p["y"] * fy).cast("int").alias("y")))


def clamp_box(box: Column, width: Column, height: Column, fx: Column | None = None, fy: Column | None = None) -> Column:
    """The box scaled, its corners sorted, clamped to the page; null if a side is under one pixel."""
    fx, fy = F.lit(1.0) if fx is None else fx, F.lit(1.0) if fy is None else fy
    inside = lambda v, most: F.least(F.greatest(v, F.lit(0.0)), most.cast("double"))
    xs = [inside(box[c] * fx, width) for c in ("x0", "x1")]
    ys = [inside(box[c] * fy, height) for c in ("y0", "y1")]
    b = F.struct(F.least(*xs).alias("x0"), F.least(*ys).alias("y0"), F.greatest(*xs).alias("x1"), F.greatest(*ys).alias("y1"))
    return F.when((b["x1"] - b["x0"] >= 1) & (b["y1"] - b["y0"] >= 1), b)


def is_finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def has_letters(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def language_code(language: Column) -> Column:
    """The code if it has a language tag's form and is not 'unknown', else null."""
    ok = language.rlike(r"^[a-zA-Z]{1,8}(-[a-zA-Z0-9]{1,8})*$") & (F.lower(language) != "unknown")
    return F.when(ok, language)


def xml_id(*parts: Column) -> Column:
    """The parts joined by '_', other characters than letters, digits and _ . - replaced; never begins with those."""
    clean = F.regexp_replace(F.concat_ws("_", *parts), r"[^A-Za-z0-9_.\-]", "_")
    return F.when(clean.rlike(r"^[A-Za-z_]"), clean).otherwise(F.concat(F.lit("id_"), clean))


def points_text(polygon: Column, least: int | None = None) -> Column:
    """'x,y x,y' of truncated coordinates, raised to ``least`` if given."""

    def num(c: Column) -> Column:
        v = c.cast("int")
        return (v if least is None else F.greatest(v, F.lit(least))).cast("string")

    return F.array_join(F.transform(polygon, lambda p: F.concat(num(p["x"]), F.lit(","), num(p["y"]))), " ")


def decimal_text(value: Column) -> Column:
    """Four decimals, rounded by the exact binary value and halves to even; null if not finite.

    Ten thousand times the value is the exact sum of two doubles: the products of its upper and lower bits. Their signs
    tell on which side of a half the value lies.
    """
    v = F.when(is_finite(value), value.cast("double"))
    x = F.abs(v)
    cut = x * F.lit(134217729.0)
    upper = cut - (cut - x)
    high, low = upper * 10000.0, (x - upper) * 10000.0
    down = F.floor(high)
    side = (high - down - 0.5) + low
    n = down + F.when(side > 0, F.lit(1)).when(side < 0, F.lit(0)).otherwise(down % 2)
    n = n.cast("long")
    sign = F.when(v < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, F.floor(n / 10000).cast("string"), F.lit("."), F.lpad((n % 10000).cast("string"), 4, "0"))


def confidence_text(conf: Column) -> Column:
    """Confidence clamped to [0, 1] with four decimals; null if not finite."""
    return F.when(is_finite(conf), decimal_text(F.least(F.greatest(conf.cast("double"), F.lit(0.0)), F.lit(1.0))))


def stats_settings(stats: Column, names: tuple[str, ...] = ("PC25", "PC50", "PC75", "N_LONG_ROWTEXT")) -> Column:
    """'name=value;...' of the statistics that have a value; null if none has."""
    part = lambda n: stats[n].cast("string") if n.startswith("N_") else decimal_text(stats[n])
    return F.nullif(F.concat_ws(";", *(F.concat(F.lit(f"{n}="), part(n)) for n in names)), F.lit(""))


def script_tag(script: Column) -> Column:
    return xml_id(F.lit("SCRIPT"), F.upper(script))


def trimmed(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^\s+|\s+$", "")


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def folder_of(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def now_text() -> Column:
    """Now, to the second, with the zone's offset."""
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssxxx")


def multiple_of_32(side: Column) -> Column:
    """Nearest multiple of 32, halves to even, 32 at least."""
    return F.greatest(F.rint(side / F.lit(32.0)).cast("int") * 32, F.lit(32))


def detector_bounds(limit: Column, kind: Column, cap: Column) -> Column:
    """Struct ``least, most`` of the side a detector works with: kind 'max' bounds the longer side, 'min' the shorter."""
    return F.when(kind == "max", F.struct(F.lit(None).cast("int").alias("least"), F.least(limit, cap).alias("most"))).otherwise(
        F.struct(limit.alias("least"), cap.alias("most"))
    )


def default_shape(longest: Column) -> Column:
    """Struct ``height, width`` of a portrait page of three to four whose sides are multiples of 32."""
    return F.struct(multiple_of_32(longest).alias("height"), multiple_of_32(longest * 3 / 4).alias("width"))


def tiled_side(tile_size: Column, across: Column, overlap: Column) -> Column:
    """Shorter side of an image before tiling: what the tiles cover, or 768 without tiling."""
    return F.when(tile_size > 0, tile_size * across - overlap).otherwise(F.lit(768))


def resize_shape(height: Column, width: Column, most: Column, by: str = "longer") -> Column:
    """Struct ``height, width`` after shrinking so that the longer (or shorter) side is at most ``most``; never enlarges."""
    side = F.greatest(height, width) if by == "longer" else F.least(height, width)
    f = F.least(F.lit(1.0), most / side)
    return F.struct(F.rint(height * f).cast("int").alias("height"), F.rint(width * f).cast("int").alias("width"))
