"""Raw detections to lines and regions: routing, filters, merging of overlapping polygons, sinks for later steps.

Tables have ``page_id``, an index within the page (``det_idx``), ``polygon`` and ``conf``. Null polygons are never
merged and pass no area filter. Filters are placed where they can reach the scan; merging is the only barrier.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirework.functions import polygons as G
from quirework.functions import scalars as S
from quirework.operators.components import components

POLYGON = T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))
#: Height in pixels of the strips in which overlapping boxes are sought.
STRIP = 256


def route(df: DataFrame, class_id: str = "class_id") -> DataFrame:
    """Adds ``kind``: classes from 2 up are lines, class 1 regions; others are dropped."""
    kind = F.when(F.col(class_id) >= 2, "line").when(F.col(class_id) == 1, "region")
    return df.withColumn("kind", kind).where("kind is not null")


def confident(df: DataFrame, threshold: float = 0.15, conf: str = "conf") -> DataFrame:
    return df.where(F.col(conf) >= threshold)


def large_enough(df: DataFrame, fraction: Column, threshold: float = 7e-05) -> DataFrame:
    """Keeps rows whose area fraction is above the threshold; equal ones are dropped."""
    return df.where(fraction > threshold)


def sliver_limit(height: Column, width: Column, threshold: float = 0.01) -> Column:
    return F.least(height, width) * F.lit(max(threshold, 0.0))


def not_slivers(df: DataFrame, box: Column, height: Column, width: Column, threshold: float = 0.01) -> DataFrame:
    """Drops boxes no thicker than the threshold's share of the page's shorter side. Belongs after merging."""
    return df.where(S.thickness(box) > sliver_limit(height, width, threshold))


@F.pandas_udf(T.DoubleType())
def slow_thickness(polygon: pd.Series) -> pd.Series:
    """Mean chord length of a polygon of any form, along the thinner direction."""
    rings = [G.as_ring(p) for p in polygon]
    return pd.Series([None if r is None else G.mean_thickness(r) for r in rings], dtype=float)


def layout_boxes(df: DataFrame, score: str = "score", class_id: str = "class_id", threshold: float = 0.3, first: int | None = None, idx: str = "det_idx") -> DataFrame:
    """Detections of a known class whose score reaches the threshold, among the first ``first`` rows if given."""
    d = df.where((F.col(class_id) >= 0) & (F.col(score) >= threshold))
    return d if first is None else d.where(F.col(idx) < first)


def overlap_pairs(df: DataFrame, page: str, idx: str, box: str, strip: int = STRIP, extra: tuple[str, ...] = ()) -> DataFrame:
    """Pairs of boxes of one page that meet: ``page, a, b`` (a < b), ``box_a, box_b`` and ``<extra>_a/_b``.

    Boxes go to all horizontal strips they touch and are joined by (page, strip); a pair is reported by the strip in
    which its common part begins, so once. A page with very many boxes is spread over its strips.
    """
    b = F.col(box)
    rows = df.where(b.isNotNull()).select(F.col(page).alias("_p"), F.col(idx).alias("_i"), b.alias("_box"), *extra)
    strips = F.sequence(F.floor(F.col("_box.y0") / strip).cast("long"), F.floor(F.col("_box.y1") / strip).cast("long"))
    placed = rows.withColumn("_s", F.explode(strips))
    l, r = placed.alias("l"), placed.alias("r")
    at = lambda side, c: F.col(f"{side}._box.{c}")
    meet = (at("l", "x0") <= at("r", "x1")) & (at("r", "x0") <= at("l", "x1")) & (at("l", "y0") <= at("r", "y1")) & (at("r", "y0") <= at("l", "y1"))
    once = F.floor(F.greatest(at("l", "y0"), at("r", "y0")) / strip) == F.col("l._s")
    j = l.join(r, (F.col("l._p") == F.col("r._p")) & (F.col("l._s") == F.col("r._s")) & (F.col("l._i") < F.col("r._i")) & meet & once)
    more = [F.col(f"{s}.{c}").alias(f"{c}_{t}") for c in extra for s, t in (("l", "a"), ("r", "b"))]
    return j.select(F.col("l._p").alias(page), F.col("l._i").alias("a"), F.col("r._i").alias("b"), F.col("l._box").alias("box_a"), F.col("r._box").alias("box_b"), *more)


@F.pandas_udf(T.StructType([T.StructField(c, T.DoubleType()) for c in ("a", "b", "common")]))
def polygon_areas(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """Areas of two polygons and of their common part."""
    out = []
    for p, q in zip(a, b, strict=True):
        rp, rq = G.as_ring(p), G.as_ring(q)
        out.append((0.0, 0.0, 0.0) if rp is None or rq is None else G.areas(rp, rq))
    return pd.DataFrame(out, columns=["a", "b", "common"])


def merge_edges(pairs: DataFrame, page: str, iou: float = 0.3, overlap: float = 0.5, vertical: bool = True, polygons: tuple[str, str] | None = None) -> DataFrame:
    """Pairs to merge: ``page, a, b``. IoU times v above ``iou``, or the part of the smaller one times v above ``overlap``.

    v is the IoU of the vertical extents for lines and 1 for regions; an overlap limit of 0 switches its test off. Boxes
    are compared in SQL; ``polygons`` names two polygon columns for areas of any form.
    """
    a, b = F.col("box_a"), F.col("box_b")
    if polygons:
        got = pairs.withColumn("_g", polygon_areas(*map(F.col, polygons)))
        common, area_a, area_b = F.col("_g.common"), F.col("_g.a"), F.col("_g.b")
    else:
        got, common, area_a, area_b = pairs, S.box_intersection(a, b), S.box_area(a), S.box_area(b)
    v = S.interval_iou(a["y0"], a["y1"], b["y0"], b["y1"]) if vertical else F.lit(1.0)
    test = F.coalesce(F.try_divide(common, area_a + area_b - common), F.lit(0.0)) * v > iou
    if overlap:
        test = test | (F.coalesce(F.try_divide(common, F.least(area_a, area_b)), F.lit(0.0)) * v > overlap)
    return got.where(test).select(page, "a", "b")


def merge_components(edges: DataFrame, page: str) -> DataFrame:
    """Members of merged groups: ``page, node, root`` (the least index)."""
    return components(edges, keys=[page])


def _union(page: str, idx: str):
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        rings = G.union_rings(list(frame["polygon"]))
        conf = float(frame["conf"].mean())
        closed = [np.trunc(np.concatenate([r, r[:1]])) for r in rings]
        out = [(key[0], int(key[1]), part, [{"x": float(x), "y": float(y)} for x, y in r], conf) for part, r in enumerate(closed)]
        return pd.DataFrame(out, columns=[page, idx, "part", "polygon", "conf"])

    return run


def merge(df: DataFrame, page: str, idx: str, members: DataFrame) -> DataFrame:
    """Merged polygons: ``page, idx, part, polygon, conf``. Groups become their union's outer rings (truncated, closed)
    with the mean confidence of their members; all others keep polygon and confidence."""
    d = df.select(page, idx, F.col("polygon").cast(POLYGON).alias("polygon"), F.col("conf").cast("double").alias("conf"))
    m = members.withColumnRenamed("node", idx)
    alone = d.join(m, [page, idx], "left_anti").select(page, F.col(idx).cast("long").alias(idx), F.lit(0).alias("part"), "polygon", "conf")
    grouped = d.join(m, [page, idx]).select(page, F.col("root").cast("long").alias("root"), "polygon", "conf")
    kind = d.schema[page].dataType.simpleString()
    schema = f"{page} {kind}, {idx} long, part int, polygon array<struct<x:double,y:double>>, conf double"
    return alone.unionByName(grouped.groupBy(page, "root").applyInPandas(_union(page, idx), schema))


@dataclass(frozen=True)
class Rules:
    """How detections of one kind are cleaned; the vertical extent counts, and slivers are dropped, for lines only."""

    size_fraction: float = 7e-05
    iou: float = 0.3
    overlap: float = 0.5
    sliver: float | None = 0.01

    @property
    def vertical(self) -> bool:
        return self.sliver is not None


def _shaped(df: DataFrame, rules: Rules) -> DataFrame:
    d = df.where(F.col("polygon").isNotNull() & (F.size("polygon") >= 3))
    return large_enough(d, S.area_fraction(F.col("polygon"), F.col("height"), F.col("width")), rules.size_fraction).withColumn("box", S.box_of(F.col("polygon")))


def _polygon_edges(d: DataFrame, rules: Rules) -> DataFrame:
    pairs = overlap_pairs(d, "page_id", "det_idx", "box")  # polygons are fetched for the pairs whose boxes meet
    for side in ("a", "b"):
        pairs = pairs.join(d.select("page_id", F.col("det_idx").alias(side), F.col("polygon").alias(f"polygon_{side}")), ["page_id", side])
    return merge_edges(pairs, "page_id", rules.iou, rules.overlap, rules.vertical, ("polygon_a", "polygon_b"))


def postprocess_kinds(df: DataFrame, rules: dict[str, Rules]) -> dict[str, DataFrame]:
    """Clean detections of each kind: small ones dropped, overlapping ones of the kind merged, slivers of lines dropped.

    df: ``page_id, det_idx, kind, polygon, conf, height, width``. Gives ``page_id, det_idx, part, polygon, conf, box`` by kind.
    The groups of all kinds are labelled together, by one row of rounds.
    """
    shaped = {k: _shaped(df.where(F.col("kind") == k), r) for k, r in rules.items()}
    edges = None
    for k, r in rules.items():
        e = _polygon_edges(shaped[k], r).withColumn("kind", F.lit(k))
        edges = e if edges is None else edges.unionByName(e)
    members = components(edges, keys=["page_id", "kind"])
    out = {}
    for k, r in rules.items():
        d = shaped[k]
        merged = merge(d, "page_id", "det_idx", members.where(F.col("kind") == k).drop("kind")).withColumn("box", S.box_of(F.col("polygon")))
        if r.sliver is not None:
            pages = d.select("page_id", "height", "width").distinct()
            merged = not_slivers(merged.join(pages, "page_id"), F.col("box"), F.col("height"), F.col("width"), r.sliver).drop("height", "width")
        out[k] = merged
    return out


def postprocess(df: DataFrame, kind: str, size_fraction: float = 7e-05, iou: float = 0.3, overlap: float = 0.5, sliver: float = 0.01) -> DataFrame:
    """``postprocess_kinds`` of one kind; df needs no ``kind``."""
    rules = Rules(size_fraction, iou, overlap, sliver if kind == "line" else None)
    return postprocess_kinds(df.withColumn("kind", F.lit(kind)), {kind: rules})[kind]


def outside_ignored(lines: DataFrame, regions: DataFrame, page: str, ignored: Column) -> DataFrame:
    """Lines but those whose box centre is inside some ignored region and inside no kept one (edges count as inside).

    lines: ``page, box``; regions: ``page, box`` and what ``ignored`` reads. Centres meet regions by page and horizontal
    strip, so a page of many lines and regions is spread over its strips. The joins are shuffled whatever the size of the
    regions seems to be: Catalyst's estimate does not count the rows that strips (or regions made of rows) add.
    """
    cx, cy = (F.col("box.x0") + F.col("box.x1")) / 2, (F.col("box.y0") + F.col("box.y1")) / 2
    l = lines.withColumns({"_cx": cx, "_cy": cy, "_s": F.floor(cy / STRIP).cast("long")})
    strips = F.sequence(F.floor(F.col("box.y0") / STRIP).cast("long"), F.floor(F.col("box.y1") / STRIP).cast("long"))
    r = regions.select(F.col(page).alias("_p"), F.col("box").alias("_b"), ignored.alias("_ignored"), F.explode(strips).alias("_rs"))
    inside = (F.col(page) == F.col("_p")) & (F.col("_s") == F.col("_rs")) & F.col("_cx").between(F.col("_b.x0"), F.col("_b.x1")) & F.col("_cy").between(F.col("_b.y0"), F.col("_b.y1"))
    kept = l.join(r.where(~F.col("_ignored")).hint("merge"), inside, "left_semi")
    free = l.join(r.hint("merge"), inside, "left_anti")
    return kept.unionByName(free).drop("_cx", "_cy", "_s")


def tile_grid(df: DataFrame, page: str, size: int, overlap: int = 128) -> DataFrame:
    """Overlapping tiles of each page: ``page, tile, x0, y0, x1, y1``; the last tile of a row or column ends at the edge."""
    step = max(size - overlap, 1)

    def starts(side: str) -> Column:
        return F.when(F.col(side) <= size, F.array(F.lit(0))).otherwise(
            F.array_distinct(F.transform(F.sequence(F.lit(0), F.ceil((F.col(side) - size) / step).cast("int")), lambda i: F.least(i * step, F.col(side) - size)))
        )

    t = df.select(page, "height", "width", F.explode(starts("height")).alias("y0")).select(page, "height", "width", "y0", F.explode(starts("width")).alias("x0"))
    t = t.select(page, "x0", "y0", F.least(F.col("x0") + size, "width").alias("x1"), F.least(F.col("y0") + size, "height").alias("y1"))
    return t.withColumn("tile", F.concat_ws(":", "y0", "x0"))


def suppress(df: DataFrame, page: str, idx: str, threshold: float = 0.85) -> DataFrame:
    """Of detections from overlapping tiles, those not overlapped above ``threshold`` (IoU) by a better one that stays.

    Only pairs above the threshold move: a greedy choice by confidence (ties: lower index) within their components.
    df: ``page, idx, box, conf``.
    """
    pairs = overlap_pairs(df, page, idx, "box", extra=("conf",))
    hot = pairs.where(S.box_iou(F.col("box_a"), F.col("box_b")) > threshold).select(page, "a", "b", "conf_a", "conf_b")
    member = components(hot, keys=[page]).select(F.col(page).alias("_p"), F.col("node").alias("_n"), "root")
    linked = hot.join(member, (F.col(page) == F.col("_p")) & (F.col("a") == F.col("_n"))).drop("_p", "_n")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        conf = dict(zip(frame["a"], frame["conf_a"], strict=True)) | dict(zip(frame["b"], frame["conf_b"], strict=True))
        near: dict = {}
        for a, b in zip(frame["a"], frame["b"], strict=True):
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
        gone: set = set()
        for n in sorted(conf, key=lambda i: (-conf[i], i)):
            if n not in gone:
                gone |= near[n]
        return pd.DataFrame({page: [frame[page].iloc[0]] * len(gone), idx: sorted(gone)})

    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    lost = linked.groupBy(page, "root").applyInPandas(run, f"{page} {kinds[page]}, {idx} {kinds[idx]}")
    return df.join(lost, [page, idx], "left_anti")


def masks_to_polygons(df: DataFrame, page: str, idx: str) -> DataFrame:
    """Outer outlines of masks scaled to the image: ``page, idx, part, polygon, conf, area_frac`` (one row per part).

    df: ``page, idx, mask`` (one byte a pixel), ``mask_h, mask_w, height, width, conf``.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for r in f.itertuples(index=False):
                if r.mask is None:
                    continue
                m = np.frombuffer(r.mask, dtype=np.uint8).reshape(int(r.mask_h), int(r.mask_w)) > 0
                for part, p in enumerate(G.mask_outlines(m)):
                    x, y = p[:, 0], p[:, 1]
                    frac = abs(float((x * np.roll(y, -1) - np.roll(x, -1) * y).sum())) / 2 / m.size
                    at = np.rint(p * [r.width / r.mask_w, r.height / r.mask_h])
                    rows.append((getattr(r, page), getattr(r, idx), part, [{"x": float(u), "y": float(v)} for u, v in at], r.conf, frac))
            yield pd.DataFrame(rows, columns=[page, idx, "part", "polygon", "conf", "area_frac"])

    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    return df.select(page, idx, "mask", "mask_h", "mask_w", "height", "width", "conf").mapInPandas(
        run, f"{page} {kinds[page]}, {idx} {kinds[idx]}, part int, polygon array<struct<x:double,y:double>>, conf double, area_frac double"
    )


def detect(images: DataFrame, model, schema: str, **options) -> DataFrame:
    """Runs a detector over images. ``model(**options)`` is called once per Python worker and task and returns a function
    from a frame of images to a frame of detections of ``schema``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        infer = model(**options)
        for f in frames:
            yield infer(f)

    return images.mapInPandas(run, schema)

