"""Merging, assignment and reading order against direct loops."""

import itertools

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quirework.functions import polygons as G
from quirework.functions import scalars as S
from quirework.operators import components, detections, layout

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"


def boxes(spark, pages):
    rows = [(p, i, tuple(map(float, b)), 0.1 * (i + 1)) for p, bs in pages.items() for i, b in enumerate(bs)]
    return spark.createDataFrame(rows, f"p int, k int, box {BOX}, conf double")


def precedes(a, b):
    if min(a[3], b[3]) - max(a[1], b[1]) > 0.5 * min(a[3] - a[1], b[3] - b[1]):
        return a[0] < b[0]
    return a[1] < b[1]


def kahn(bs):
    """Direct topological order with the documented break of cycles."""
    n = len(bs)
    after = {i: [] for i in range(n)}
    left = [0] * n
    for i, j in itertools.combinations(range(n), 2):
        a, b = (i, j) if precedes(bs[i], bs[j]) else (j, i)
        after[a].append(b)
        left[b] += 1
    done = []
    while len(done) < n:
        k = min((i for i in range(n) if i not in done), key=lambda i: (left[i], bs[i][1], bs[i][0], i))
        done.append(k)
        for j in after[k]:
            left[j] -= 1
    return done


CASES = {
    1: [(50, 100, 250, 130), (300, 100, 500, 130), (50, 180, 250, 210), (300, 180, 500, 210)],
    2: [(0, 0, 10, 10), (0, 0, 10, 10)],
    3: [(0, 0, 10, 10)],
    4: [(0, 0, 10, 10), (20, 5, 30, 15)],  # shares exactly half: another row
    5: [(20, 0, 30, 20), (10, 8, 15, 30), (0, 18, 5, 40)],  # a chain of rows
    6: [(40, 0, 50, 30), (20, 14, 30, 60), (0, 20, 10, 100), (60, 28, 70, 50)],
}


def test_reading_order(spark):
    got = {}
    for r in layout.reading_order(boxes(spark, CASES), "p", "k").collect():
        got.setdefault(r.p, {})[r.pos] = r.k
    for p, bs in CASES.items():
        assert [got[p][i] for i in range(len(bs))] == kahn(bs), p
    assert [got[2][i] for i in (0, 1)] == [1, 0]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.data())
def test_reading_order_of_any_boxes(spark, data):
    side = st.integers(0, 60)
    pages = {}
    for p in range(25):
        bs = data.draw(st.lists(st.tuples(side, side, st.integers(1, 40), st.integers(1, 40)), min_size=1, max_size=7))
        pages[p] = [(x, y, x + w, y + h) for x, y, w, h in bs]
    got = {}
    for r in layout.reading_order(boxes(spark, pages), "p", "k").collect():
        got.setdefault(r.p, {})[r.pos] = r.k
    for p, bs in pages.items():
        assert sorted(got[p]) == list(range(len(bs)))
        assert [got[p][i] for i in range(len(bs))] == kahn(bs)


def test_right_to_left(spark):
    got = {r.k: r.pos for r in layout.reading_order(boxes(spark, {1: CASES[1]}), "p", "k", rtl=True).collect()}
    assert got == {1: 0, 0: 1, 3: 2, 2: 3}


def test_large_pages_rank_the_same(spark, monkeypatch):
    d = boxes(spark, CASES)
    plain = {(r.p, r.k): r.indegree for r in layout.predecessors(d, "p", "k").collect()}
    monkeypatch.setattr(layout, "LARGE_PAGE", 1)
    assert plain == {(r.p, r.k): r.indegree for r in layout.predecessors(d, "p", "k").collect()}


def test_spread_rank(spark):
    d = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    got = components.spread_rank(d, ["g"], [F.desc("v")], "r", 7).collect()
    for g in range(3):
        rows = sorted((r for r in got if r.g == g), key=lambda r: r.r)
        assert [r.r for r in rows] == list(range(len(rows))) and [r.v for r in rows] == sorted((r.v for r in rows), reverse=True)


def test_components(spark):
    edges = [(1, i, i + 1) for i in range(40)] + [(1, 60, 50), (1, 50, 60), (2, 5, 5), (2, None, 3)]
    got = {(r.p, r.node): r.root for r in components.components(spark.createDataFrame(edges, "p int, a int, b int"), keys=["p"]).collect()}
    assert got == {(1, i): 0 for i in range(41)} | {(1, 50): 50, (1, 60): 50, (2, 5): 5}
    assert components.components(spark.createDataFrame([], "p int, a int, b int"), keys=["p"]).count() == 0


def test_overlap_pairs_are_reported_once(spark):
    bs = [(0, 0, 10, 900), (5, 100, 20, 800), (20, 800, 30, 810), (100, 0, 110, 10), (-5, -700, 3, 5)]
    got = sorted((r.a, r.b) for r in detections.overlap_pairs(boxes(spark, {1: bs, 2: bs[:1]}), "p", "k", "box").collect())
    want = [(i, j) for i, j in itertools.combinations(range(5), 2) if bs[i][0] <= bs[j][2] and bs[j][0] <= bs[i][2] and bs[i][1] <= bs[j][3] and bs[j][1] <= bs[i][3]]
    assert got == want


def test_merge_limits_are_strict(spark):
    d = boxes(spark, {1: [(0, 0, 10, 10), (0, 0, 10, 10)], 2: [(0, 0, 10, 10), (5, 0, 15, 10)], 3: [(0, 0, 10, 10), (20, 0, 30, 10)]})
    pairs = detections.overlap_pairs(d, "p", "k", "box")
    assert {r.p for r in detections.merge_edges(pairs, "p", 1 / 3, 0.5).collect()} == {1}  # equal to both limits: not merged
    assert {r.p for r in detections.merge_edges(pairs, "p", 0.33, 0).collect()} == {1, 2}
    assert {r.p for r in detections.merge_edges(pairs, "p", 1.0, 0.49).collect()} == {1, 2}


def test_merge(spark):
    d = boxes(spark, {1: [(0, 0, 10, 10), (5, 0, 15, 10), (50, 50, 60, 60)]}).withColumn("polygon", S.box_polygon(F.col("box")))
    edges = spark.createDataFrame([(1, 0, 1)], "p int, a int, b int")
    got = {r.k: r for r in detections.merge(d, "p", "k", detections.merge_components(edges, "p")).collect()}
    assert set(got) == {0, 2} and abs(got[0].conf - 0.15) < 1e-9
    p = [(q.x, q.y) for q in got[0].polygon]
    assert p[0] == p[-1] and set(p) >= {(0, 0), (15, 0), (15, 10), (0, 10)}
    assert len(got[2].polygon) == 4


def test_filters(spark):
    d = spark.createDataFrame([(0, 0.9), (1, 0.15), (2, 0.1), (7, 0.5), (None, 0.5)], "class_id int, conf double")
    assert sorted((r.class_id, r.kind) for r in detections.confident(detections.route(d)).collect()) == [(1, "region"), (7, "line")]
    b = boxes(spark, {1: [(0, 0, 100, 16), (0, 0, 100, 17)]})
    assert [r.k for r in detections.not_slivers(b, F.col("box"), F.lit(1600), F.lit(2000)).collect()] == [1]
    f = spark.createDataFrame([(7e-05,), (7.1e-05,)], "f double")
    assert detections.large_enough(f, F.col("f")).count() == 1
    s = spark.createDataFrame([(0, 1, 0.3), (1, 1, 0.29), (2, -1, 0.9), (3, 2, 0.9)], "det_idx int, class_id int, score double")
    assert [r.det_idx for r in detections.layout_boxes(s).collect()] == [0, 3] and [r.det_idx for r in detections.layout_boxes(s, first=2).collect()] == [0]


def test_assignment(spark):
    lines = boxes(spark, {1: [(0, 0, 10, 10), (0, 200, 10, 210), (5, 0, 15, 10)], 2: [(0, 0, 10, 10)], 3: [(0, 0, 1, 1)]})
    regions = boxes(spark, {1: [(0, 0, 100, 100), (0, 0, 12, 12), (0, 150, 10, 190)], 3: [(2e6, 0, 2e6 + 1, 1)]}).withColumnRenamed("k", "rid").drop("conf")
    got = {(r.p, r.k): r.rid for r in layout.assign_regions(lines, regions, "p", "k", "rid").collect()}
    assert got == {(1, 0): 1, (1, 1): 2, (1, 2): 1}
    tie = boxes(spark, {1: [(0, 0, 10, 10), (0, 0, 10, 10)]}).withColumnRenamed("k", "rid").drop("conf")
    assert {r.rid for r in layout.assign_regions(lines.where("p = 1 and k = 0"), tie, "p", "k", "rid").collect()} == {0}
    poly = lambda d: d.withColumn("polygon", S.box_polygon(F.col("box")))
    same = {(r.p, r.k): r.rid for r in layout.assign_regions(poly(lines), poly(regions), "p", "k", "rid", polygons=True).collect()}
    assert same == got
    left = layout.regions_without_lines(regions, layout.assign_regions(lines, regions, "p", "k", "rid"), "p", "rid")
    assert {(r.p, r.rid) for r in left.collect()} == {(1, 0), (3, 0)}


def test_assignment_of_both_ways(spark, monkeypatch):
    """Random boxes and triangles: by strips and by all pairs, boxes and polygons, against brute force."""
    rng = np.random.default_rng(7)

    def some(n, size):
        at = rng.integers(0, 1500, (n, 2))
        return [(float(x), float(y), float(x + w), float(y + h)) for (x, y), (w, h) in zip(at, rng.integers(5, size, (n, 2)), strict=True)]

    tri = lambda b: [{"x": b[0], "y": b[1]}, {"x": b[2], "y": b[1]}, {"x": b[0], "y": b[3]}]
    schema = f"p int, k int, box {BOX}, polygon array<struct<x:double,y:double>>"
    lines, regions = some(60, 120), some(25, 500)
    l = spark.createDataFrame([(1, i, b, tri(b)) for i, b in enumerate(lines)] + [(2, 0, lines[0], tri(lines[0]))], schema)
    r = spark.createDataFrame([(1, i, b, tri(b)) for i, b in enumerate(regions)], schema).withColumnRenamed("k", "rid")
    best = {}
    for i, b in enumerate(lines):
        options = []
        for j, c in enumerate(regions):
            v = G.iou(tri(b), tri(c))
            options.append((-v, 0.0 if v > 0 else G.distance(tri(b), tri(c)), j))
        best[i] = min(options)[2]
    got = {x.k: x.rid for x in layout.assign_regions(l, r, "p", "k", "rid", polygons=True).collect()}
    assert got == best
    plain = sorted(map(tuple, layout.assign_regions(l, r, "p", "k", "rid").collect()))
    monkeypatch.setattr(layout, "FEW_REGIONS", 3)
    assert sorted(map(tuple, layout.assign_regions(l, r, "p", "k", "rid").collect())) == plain and len(plain) == 60


def test_ignored(spark):
    lines = boxes(spark, {1: [(0, 0, 10, 10), (40, 40, 50, 50), (90, 90, 110, 110), (300, 300, 310, 310)]})
    regions = spark.createDataFrame([(1, (0.0, 0.0, 100.0, 100.0), True), (1, (40.0, 40.0, 60.0, 60.0), False)], f"p int, box {BOX}, skip boolean")
    assert sorted(r.k for r in detections.outside_ignored(lines, regions, "p", F.col("skip")).collect()) == [1, 3]


def test_ignored_regions_are_not_broadcast(spark):
    """Catalyst takes few rows that regions and their strips are made of for a small table, however many they become."""
    box = lambda x0, y0, x1, y1: F.struct(*(F.lit(float(v)).alias(c) for c, v in zip(("x0", "y0", "x1", "y1"), (x0, y0, x1, y1), strict=True)))
    rid = F.explode(F.sequence(F.lit(0), F.lit(1)))
    regions = spark.range(3).select(F.col("id").alias("p"), rid.alias("rid")).withColumn("box", F.when(F.col("rid") == 1, box(0, 0, 100, 9000)).otherwise(box(40, 40, 60, 60)))
    lines = spark.range(3).select(F.col("id").alias("p"), F.posexplode(F.array(box(0, 0, 10, 10), box(40, 40, 50, 50), box(90, 9000, 110, 9900), box(0, 8000, 9, 8009))).alias("k", "box"))
    got = detections.outside_ignored(lines, regions, "p", F.col("rid") == 1)
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.p, r.k) for r in got.collect()) == [(p, k) for p in range(3) for k in (1, 2)]


def test_tiles_and_suppression(spark):
    d = spark.createDataFrame([(1, 1000, 500), (2, 300, 300)], "p int, height int, width int")
    t = [(r.p, r.x0, r.y0, r.x1, r.y1) for r in detections.tile_grid(d, "p", 640, 128).collect()]
    assert sorted(t) == [(1, 0, 0, 500, 640), (1, 0, 360, 500, 1000), (2, 0, 0, 300, 300)]
    b = boxes(spark, {1: [(0, 0, 100, 100), (0, 0, 100, 99), (0, 0, 100, 98), (500, 0, 600, 10)], 2: [(0, 0, 9, 9)]})
    assert sorted((r.p, r.k) for r in detections.suppress(b, "p", "k").collect()) == [(1, 2), (1, 3), (2, 0)]


def test_masks(spark):
    m = bytearray(8 * 10)
    for y in range(1, 4):
        for x in range(1, 5):
            m[y * 10 + x] = 1
    d = spark.createDataFrame([(1, 0, bytes(m), 8, 10, 80, 100, 0.7), (1, 1, None, 8, 10, 80, 100, 0.7)], "p int, k int, mask binary, mask_h int, mask_w int, height int, width int, conf double")
    (r,) = detections.masks_to_polygons(d, "p", "k").collect()
    assert sorted((q.x, q.y) for q in r.polygon) == [(10, 10), (10, 30), (40, 10), (40, 30)]
    assert r.area_frac == pytest.approx(6 / 80)


def test_default_region(spark):
    d = spark.createDataFrame([(1, 20, 10), (2, 20, 10)], "p int, height int, width int")
    (r,) = layout.default_regions(d, spark.createDataFrame([(2,)], "p int"), "p").collect()
    assert (r.p, r.id, r.name, r.conf, tuple(r.box)) == (1, "0", "paragraph", 0.0, (0, 0, 10, 20))


def test_batches(spark):
    d = spark.createDataFrame([(1, i, float(10 - i)) for i in range(5)], "p int, k int, ratio double")
    assert {r.k: r.batch for r in layout.batches(d, "p", F.col("ratio"), "k", 2).collect()} == {4: 0, 3: 0, 2: 1, 1: 1, 0: 2}
