"""Lines to regions, and reading order."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirework.functions import polygons as G
from quirework.functions import scalars as S
from quirework.operators.components import spread_rank
from quirework.operators.detections import STRIP, overlap_pairs
from quirework.runtime import save

#: Boxes of a page that one task sorts; pages with more are ranked over several tasks, with the same result.
LARGE_PAGE = 500_000
#: Regions of a page with which each of its boxes is compared.
FEW_REGIONS = 64
#: A line farther than this from every region has none.
FAR = 1_000_000.0


@F.pandas_udf(T.StructType([T.StructField("iou", T.DoubleType()), T.StructField("dist", T.DoubleType())]))
def _near(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    out = []
    for p, q in zip(a, b, strict=True):
        i = G.iou(p, q)
        out.append((i, 0.0 if i > 0 else min(G.distance(p, q), 1e300)))
    return pd.DataFrame(out, columns=["iou", "dist"])


def assign_regions(lines: DataFrame, regions: DataFrame, page: str, line: str, region: str, polygons: bool = False) -> DataFrame:
    """``page, line, region, iou``: the region of greatest IoU; without any overlap the nearest one closer than ``FAR``.

    Equal ones go to the region of the lower index. Lines of pages without regions, and lines too far away, have no
    row. Both tables have ``box`` (or ``box`` and ``polygon``, for polygons of any form).

    Boxes of pages of at most ``FEW_REGIONS`` regions are compared with all of them. Else lines meet the regions whose
    boxes touch theirs, by page and strip; only lines that overlap none of these are compared with all regions of their
    page. Polygons are not carried through the joins: those of the pairs whose boxes touch are fetched afterwards, and of
    the others those whose box is no farther than some polygon can be. Both ways give the same.
    """
    if not polygons and not regions.groupBy(page).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > FEW_REGIONS).limit(1).count():
        return _assigned_at_once(lines, regions, page, line, region)
    l = lines.select(page, line, F.col("box").alias("_l"))
    r = regions.select(page, region, F.col("box").alias("_r"))
    touching = _touching(l, r, page, line, region)
    near = touching.select(page, line, region, *([] if polygons else [S.box_iou(F.col("_l"), F.col("_r")).alias("iou")]))
    if polygons:
        near = _measured(near, lines, regions, page, line, region).select(page, line, region, "iou")
    best = F.min_by(F.struct(F.col(region).alias("r"), "iou"), F.struct(-F.col("iou"), F.col(region)))
    over = save(near.where("iou > 0").groupBy(page, line).agg(best.alias("_b")).select(page, line, F.col("_b.r").alias(region), F.col("_b.iou").alias("iou"))).df

    rest = l.join(over.select(page, line), [page, line], "left_anti").join(r, page)
    rest = rest.withColumn("_d", S.box_distance(F.col("_l"), F.col("_r")))
    if polygons:
        # a polygon's distance lies between that of the boxes and that of their farthest corners
        far = F.hypot(*(F.greatest(F.col(f"_l.{c}1"), F.col(f"_r.{c}1")) - F.least(F.col(f"_l.{c}0"), F.col(f"_r.{c}0")) for c in "xy"))
        bound = rest.groupBy(page, line).agg(F.min(far).alias("_most"))
        close = rest.join(bound, [page, line]).where(F.col("_d") <= F.col("_most")).select(page, line, region)
        rest = _measured(close, lines, regions, page, line, region).withColumn("_d", F.col("dist"))
    least = F.min_by(F.struct(F.col(region).alias("r"), F.col("_d").alias("d")), F.struct("_d", F.col(region)))
    alone = rest.groupBy(page, line).agg(least.alias("_b")).where(F.col("_b.d") < FAR)
    return over.unionByName(alone.select(page, line, F.col("_b.r").alias(region), F.lit(0.0).alias("iou")))


def _assigned_at_once(lines: DataFrame, regions: DataFrame, page: str, line: str, region: str) -> DataFrame:
    """``assign_regions`` for boxes, an aggregate by line within the shuffle by page."""
    j = lines.select(page, line, F.col("box").alias("_l")).join(regions.select(page, region, F.col("box").alias("_r")), page)
    j = j.withColumns({"iou": S.box_iou(F.col("_l"), F.col("_r")), "_d": S.box_distance(F.col("_l"), F.col("_r"))})
    near = F.when(F.col("iou") > 0, F.lit(0.0)).otherwise(F.col("_d"))
    best = F.min_by(F.struct(F.col(region).alias("r"), "iou", near.alias("d")), F.struct(-F.col("iou"), near, F.col(region)))
    got = j.groupBy(page, line).agg(best.alias("_b"))
    return got.where((F.col("_b.iou") > 0) | (F.col("_b.d") < FAR)).select(page, line, F.col("_b.r").alias(region), F.col("_b.iou").alias("iou"))


def _touching(l: DataFrame, r: DataFrame, page: str, line: str, region: str) -> DataFrame:
    """Pairs of lines and regions of a page whose boxes meet, each once: joined by page and horizontal strip."""
    strips = lambda c: F.explode(F.sequence(F.floor(F.col(f"{c}.y0") / STRIP).cast("long"), F.floor(F.col(f"{c}.y1") / STRIP).cast("long"))).alias("_s")
    j = l.where("_l is not null").select(page, line, "_l", strips("_l")).join(r.where("_r is not null").select(page, region, "_r", strips("_r")), [page, "_s"])
    meet = (F.col("_l.x0") <= F.col("_r.x1")) & (F.col("_r.x0") <= F.col("_l.x1")) & (F.col("_l.y0") <= F.col("_r.y1")) & (F.col("_r.y0") <= F.col("_l.y1"))
    return j.where(meet & (F.floor(F.greatest("_l.y0", "_r.y0") / STRIP) == F.col("_s")))


def _measured(pairs: DataFrame, lines: DataFrame, regions: DataFrame, page: str, line: str, region: str) -> DataFrame:
    """``pairs`` with the ``iou`` and ``dist`` of their polygons."""
    j = pairs.join(lines.select(page, line, F.col("polygon").alias("_lp")), [page, line]).join(regions.select(page, region, F.col("polygon").alias("_rp")), [page, region])
    return j.withColumn("_n", _near("_lp", "_rp")).select(page, line, region, "_n.iou", "_n.dist")


def regions_without_lines(regions: DataFrame, assigned: DataFrame, page: str, region: str) -> DataFrame:
    """Regions that no line was assigned to; ordering leaves them out."""
    return regions.join(assigned, [page, region], "left_anti")


def default_regions(pages: DataFrame, regions: DataFrame, page: str) -> DataFrame:
    """For pages without region one that covers the page: ``page, id, name, conf, box``. pages: ``page, height, width``."""
    zero = F.lit(0.0)
    box = F.struct(zero.alias("x0"), zero.alias("y0"), F.col("width").cast("double").alias("x1"), F.col("height").cast("double").alias("y1"))
    bare = pages.join(regions.select(page), page, "left_anti")
    return bare.select(page, F.lit("0").alias("id"), F.lit("paragraph").alias("name"), F.lit(0.0).alias("conf"), box.alias("box"))


def region_rows(regions: DataFrame, idx: str) -> DataFrame:
    """Detections as region records: ``id`` is the index as text, the name always ``paragraph``."""
    return regions.withColumns({"id": F.col(idx).cast("string"), "name": F.lit("paragraph")})


def predecessors(df: DataFrame, page: str, idx: str, rtl: bool = False) -> DataFrame:
    """``df`` (with ``box``) and ``indegree``: how many boxes of its page come before each.

    Of two boxes that share more than half the lower one's height the left one (or right one) is first, else the upper
    one; equal anchors put the later index first. Counting by y is a rank; only the pairs in which x decides
    otherwise correct it, so not all pairs of a page are formed.
    """
    base = save(df.withColumns({"_y": F.col("box.y0"), "_i": F.col(idx)})).df
    order = [F.col("_y").asc(), F.col("_i").desc()]
    if base.groupBy(page).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > LARGE_PAGE).limit(1).count():
        ranked = spread_rank(base, [page], order, "_byy")
    else:
        ranked = base.withColumn("_byy", (F.row_number().over(Window.partitionBy(page).orderBy(*order)) - 1).cast("long"))
    a, b = F.col("box_a"), F.col("box_b")
    shared = F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"])
    same_row = shared > 0.5 * F.least(a["y1"] - a["y0"], b["y1"] - b["y0"])
    wide = F.struct(F.lit(0).alias("x0"), F.col("box.y0").alias("y0"), F.lit(0).alias("x1"), F.col("box.y1").alias("y1"))
    rows = base.withColumn("_wide", wide).withColumn("_x", F.col("box.x0"))
    pairs = overlap_pairs(rows, page, idx, "_wide", extra=("_x",)).where(same_row)
    by_y = a["y0"] < b["y0"]
    by_x = F.col("_x_a") > F.col("_x_b") if rtl else F.col("_x_a") < F.col("_x_b")
    turned = pairs.where(by_x != by_y).withColumn("_by_x", by_x)
    step = F.when(F.col("_by_x"), 1).otherwise(-1)  # x puts a first: a loses a predecessor, b gains one
    fixes = turned.select(page, F.explode(F.array(F.struct(F.col("a").alias(idx), (-step).alias("_d")), F.struct(F.col("b").alias(idx), step.alias("_d")))).alias("_f"))
    fix = fixes.select(page, f"_f.{idx}", "_f._d").groupBy(page, idx).agg(F.sum("_d").alias("_d"))
    out = ranked.join(fix, [page, idx], "left")
    return out.withColumn("indegree", F.col("_byy") + F.coalesce("_d", F.lit(0))).drop("_d", "_byy", "_y", "_i")


def cyclic_pages(counted: DataFrame, page: str) -> DataFrame:
    """Pages whose predecessor counts are no permutation: their precedence has a cycle."""
    g = counted.groupBy(page, "indegree").agg(F.count(F.lit(1)).alias("_c")).groupBy(page).agg(F.max("_c").alias("_c"))
    return g.where("_c > 1").select(page)


def _break_cycles(page: str, idx: str, rtl: bool):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        f = frame.sort_values(idx).reset_index(drop=True)
        x0, y0, y1 = ([b[c] for b in f["box"]] for c in ("x0", "y0", "y1"))
        n = len(f)

        def first(i: int, j: int) -> bool:
            if min(y1[i], y1[j]) - max(y0[i], y0[j]) > 0.5 * min(y1[i] - y0[i], y1[j] - y0[j]):
                return x0[i] > x0[j] if rtl else x0[i] < x0[j]
            return y0[i] < y0[j]

        left, open_ = dict(zip(range(n), f["indegree"] - f["_before"], strict=True)), set(range(n))
        order = []
        while open_:
            k = min(open_, key=lambda i: (left[i], y0[i], -x0[i] if rtl else x0[i], i))
            order.append(k)
            open_.remove(k)
            for j in open_:
                if first(min(k, j), max(k, j)) == (k < j):
                    left[j] -= 1
        pos = [0] * n
        for p, k in enumerate(order, int(f["_before"].iloc[0])):
            pos[k] = p
        return pd.DataFrame({page: f[page], idx: f[idx], "pos": pos})

    return run


def _knots(counted: DataFrame, page: str, idx: str) -> DataFrame:
    """``counted`` with ``_before`` and ``_size``: how many boxes come before the box's knot, and how many it has.

    One of every two boxes precedes the other, so the boxes fall into knots one after another, in which each can be reached
    from each: the k boxes of fewest predecessors end a knot where they have k * (k - 1) / 2 predecessors in all, those
    among themselves. All boxes of a knot are taken before any of the next, so cycles are broken knot by knot.
    """
    by = Window.partitionBy(page).orderBy("indegree", idx).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    k = counted.withColumns({"_k": F.count(F.lit(1)).over(by), "_sum": F.sum("indegree").over(by)})
    k = k.withColumn("_end", (F.col("_sum") * 2 == F.col("_k") * (F.col("_k") - 1)).cast("int"))
    before = Window.partitionBy(page).orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    k = k.withColumn("_knot", F.coalesce(F.sum("_end").over(before), F.lit(0)))
    size = k.groupBy(page, "_knot").agg((F.min("_k") - 1).alias("_before"), F.count(F.lit(1)).alias("_size"))
    return k.join(size, [page, "_knot"]).select(page, idx, "box", "indegree", "_before", "_size")


def reading_order(df: DataFrame, page: str, idx: str, rtl: bool = False) -> DataFrame:
    """``df`` with ``pos``: where precedence has no cycle it is the number of predecessors; else boxes are taken one by
    one, always that with the fewest open predecessors (then upper, then left, then lower index), knot by knot."""
    counted = save(predecessors(df, page, idx, rtl)).df
    cyclic = save(cyclic_pages(counted, page)).df
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    knots = save(_knots(counted.join(cyclic, page, "left_semi").select(page, idx, "box", "indegree"), page, idx)).df
    alone = knots.where("_size = 1").select(page, idx, F.col("_before").alias("pos"))
    tied = knots.where("_size > 1").groupBy(page, "_before").applyInPandas(_break_cycles(page, idx, rtl), f"{page} {kinds[page]}, {idx} {kinds[idx]}, pos long")
    solved = alone.unionByName(tied)
    easy = counted.join(cyclic, page, "left_anti").withColumn("pos", F.col("indegree"))
    broken = counted.join(solved, [page, idx])
    return easy.select(*df.columns, "pos").unionByName(broken.select(*df.columns, "pos"))


def order_page(lines: DataFrame, regions: DataFrame, assigned: DataFrame, page: str, line: str, region: str, rtl: bool = False) -> DataFrame:
    """``page, region, region_pos, line, line_pos``: lines in the order of their region, regions with lines by their box."""
    linked = lines.join(assigned.select(page, line, region), [page, line])
    with_key = linked.withColumn("_g", F.struct(page, region)).drop(page, region)
    inner = reading_order(with_key, "_g", line, rtl).select(F.col(f"_g.{page}").alias(page), F.col(f"_g.{region}").alias(region), line, F.col("pos").alias("line_pos"))
    used = regions.join(assigned.select(page, region).distinct(), [page, region], "left_semi").select(page, region, "box")
    outer = reading_order(used, page, region, rtl).select(page, region, F.col("pos").alias("region_pos"))
    return inner.join(outer, [page, region])


def batches(df: DataFrame, page: str, ratio: Column, idx: str, size: int) -> DataFrame:
    """``df`` with ``batch``: rows of a page by aspect ratio (then index) in runs of ``size``."""
    n = F.row_number().over(Window.partitionBy(page).orderBy(ratio, F.col(idx))) - 1
    return df.withColumn("batch", F.floor(n / size).cast("int"))
