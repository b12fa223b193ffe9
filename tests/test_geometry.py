"""Boxes, polygons and outlines against brute force and known figures."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quirework.functions import pixels
from quirework.functions import polygons as G
from quirework.functions import scalars as S

BOX = [(0, 0), (4, 0), (4, 3), (0, 3)]


def test_areas_of_boxes():
    b = [(2, 1), (6, 1), (6, 5), (2, 5)]
    assert G.areas(G.as_ring(BOX), G.as_ring(b)) == (12, 16, 4)
    assert G.iou(BOX, b) == 4 / 24
    assert G.iou(BOX, [(9, 9), (10, 9), (10, 10)]) == 0 and G.iou(BOX, None) == 0 and G.iou(BOX, [(0, 0), (1, 1)]) == 0
    assert G.distance(BOX, [(7, 3), (8, 3), (8, 4)]) == 3 and G.distance(BOX, b) == 0 and G.distance(BOX, None) == float("inf")


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), min_size=3, max_size=7), st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), min_size=3, max_size=7))
def test_areas_against_points(p, q):
    a, b = G.as_ring(p), G.as_ring(q)
    pts = np.random.default_rng(0).random((20000, 2)) * 30
    ina, inb = G.contains(a, pts), G.contains(b, pts)
    x, y, c = G.areas(a, b)
    for got, inside in ((x, ina), (y, inb), (c, ina & inb)):
        assert abs(got - inside.mean() * 900) < 25


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 10**6))
def test_union_covers_its_parts(seed):
    rng = np.random.default_rng(seed)
    parts = []
    for _ in range(3):
        a = np.sort(rng.random(6) * 2 * np.pi)
        parts.append(np.round(rng.random(2) * 30 + 8 * np.stack([np.cos(a), np.sin(a)], axis=1)))
    parts = [p for p in parts if G.area(p) > 1]
    pts = rng.random((4000, 2)) * 60 - 12
    inside = np.any([G.contains(p, pts) for p in parts], axis=0) if parts else np.zeros(len(pts), bool)
    rings = G.union_rings(parts)
    covered = np.any([G.contains(r, pts) for r in rings], axis=0) if rings else np.zeros(len(pts), bool)
    assert (inside & ~covered).mean() < 0.002


def test_union_of_equal_and_touching():
    assert len(G.union_rings([BOX, BOX])) == 1
    assert len(G.union_rings([BOX, [(4, 0), (8, 0), (8, 3), (4, 3)]])) == 1
    assert len(G.union_rings([BOX, [(9, 9), (10, 9), (10, 10)]])) == 2
    assert G.union_rings([None, [(0, 0)]]) == []


def test_outlines():
    m = np.zeros((8, 10), bool)
    m[1:4, 1:5] = True
    m[6, 8] = True
    (o,) = G.mask_outlines(m)
    assert sorted(map(tuple, o.tolist())) == [(1, 1), (1, 3), (4, 1), (4, 3)]
    assert G.mask_outlines(np.zeros((3, 3), bool)) == []


def test_thickness():
    assert G.mean_thickness(G.as_ring(BOX)) == 3


@pytest.fixture(scope="module")
def rows(spark):
    p = lambda *v: [{"x": float(x), "y": float(y)} for x, y in v]
    return spark.createDataFrame(
        [(1, p(*BOX)), (2, p((-1.7, 2.5), (3.2, 2.5), (3.2, 9.9))), (3, p((1, 1), (2, 2))), (4, None), (5, [])], "id int, polygon array<struct<x:double,y:double>>"
    )


def test_expressions(rows):
    poly = F.col("polygon")
    got = {
        r.id: r
        for r in rows.select(
            "id", S.polygon_area(poly).alias("area"), S.box_of(poly).alias("box"), S.points_text(poly).alias("alto"), S.points_text(poly, 0).alias("page"), S.whole_box(poly).alias("whole"),
            S.placement(S.whole_box(poly)).alias("at"), S.scale_polygon(poly, F.lit(0.5), F.lit(0.5)).alias("half"), S.box_features(S.box_of(poly)).alias("f"),
        ).collect()
    }
    assert got[1].area == 12 and got[3].area == 0 and got[4].area is None and got[5].area == 0
    assert tuple(got[1].box) == (0, 0, 4, 3) and got[4].box is None and got[5].box is None
    assert got[2].alto == "-1,2 3,2 3,9" and got[2].page == "0,2 3,2 3,9"
    assert tuple(got[2].whole) == (-1, 2, 3, 9) and got[2]["at"].width == 4
    assert [tuple(p) for p in got[1].half] == [(0, 0), (2, 0), (2, 2), (0, 2)]  # 1.5 is rounded to even
    assert got[1].f.center_x == 2 and got[1].f.width == 4


def test_scalars(spark):
    one = spark.range(1)

    def value(c):
        return one.select(c.alias("c")).first().c

    assert value(S.interval_iou(F.lit(0), F.lit(10), F.lit(5), F.lit(15))) == 5 / 15
    assert value(S.interval_iou(F.lit(1), F.lit(1), F.lit(1), F.lit(1))) == 0
    assert value(S.axis_iou(F.lit(None).cast("struct<y0:int,y1:int>"), F.lit(None).cast("struct<y0:int,y1:int>"))) == 0.5
    assert value(S.xml_id(F.lit("9 a"), F.lit(0))) == "id_9_a_0"
    assert value(S.script_tag(F.lit("latin"))) == "SCRIPT_LATIN"
    assert value(S.trimmed(F.lit("  a\t "))) == "a"
    assert value(S.stem(F.lit("/x/a.b.jpg"))) == "a.b" and value(S.folder_of(F.lit("/x/y/a.jpg"))) == "/x/y" and value(S.file_name(F.lit("/x/a.jpg"))) == "a.jpg"
    assert [value(S.multiple_of_32(F.lit(v))) for v in (1, 47, 48, 80, 112)] == [32, 32, 64, 64, 128]
    assert tuple(value(S.detector_bounds(F.lit(1536), F.lit("max"), F.lit(1000)))) == (None, 1000)
    assert value(S.tiled_side(F.lit(0), F.lit(2), F.lit(128))) == 768 and value(S.tiled_side(F.lit(640), F.lit(2), F.lit(128))) == 1152
    assert tuple(value(S.resize_shape(F.lit(100), F.lit(200), F.lit(50)))) == (25, 50) and tuple(value(S.resize_shape(F.lit(100), F.lit(200), F.lit(500)))) == (100, 200)
    assert value(S.language_code(F.lit("unknown"))) is None and value(S.language_code(F.lit("fi-FI"))) == "fi-FI" and value(S.language_code(F.lit("f i"))) is None
    assert value(S.has_letters(F.lit("12 !"))) is False and value(S.has_letters(F.lit("12 ä"))) is True and value(S.has_letters(F.lit(None).cast("string"))) is False
    assert tuple(value(S.clamp_box(F.struct(F.lit(-5.0).alias("x0"), F.lit(9.0).alias("y0"), F.lit(50.0).alias("x1"), F.lit(2.0).alias("y1")), F.lit(20), F.lit(30)))) == (0, 2, 20, 9)
    assert value(S.clamp_box(F.struct(F.lit(3.0).alias("x0"), F.lit(1.0).alias("y0"), F.lit(3.5).alias("x1"), F.lit(9.0).alias("y1")), F.lit(20), F.lit(30))) is None
    assert value(S.now_text())[-6] in "+-"
    assert tuple(value(S.default_shape(F.lit(1024)))) == (1024, 768)


def test_confidence_text(spark):
    d = spark.createDataFrame([(-0.1,), (1.2,), (float("nan"),), (None,), (0.00015,), (float("inf"),)], "c double")
    assert [r.t for r in d.select(S.confidence_text(F.col("c")).alias("t")).collect()] == ["0.0000", "1.0000", None, None, "0.0001", None]


def test_decimals_are_those_of_the_binary_value(spark):
    rng = np.random.default_rng(5)
    ties = [k / 1e4 + 5e-5 for k in range(0, 10000, 7)]
    values = [*ties, *np.nextafter(ties, 9).tolist(), *np.nextafter(ties, -9).tolist(), *(k / 65536 for k in range(0, 65536, 91)), *rng.random(2000).tolist(), 0.0, -0.25, -1e-9, 12345.67895, 0.03125, 0.09375]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", S.decimal_text(F.col("v")).alias("t")).collect()
    assert [r.t for r in got] == [f"{r.v:.4f}" for r in got]


def test_pixels():
    im = np.arange(4 * 6 * 3, dtype=np.uint8).reshape(4, 6, 3)
    assert pixels.resize(im, 4, 6).tolist() == im.tolist()
    assert pixels.shrink(im, 3).shape == (2, 3, 3) and pixels.shrink(im, 9) is im and pixels.shrink(im, 2, "shorter").shape == (2, 3, 3)
    assert pixels.classifier_input(im[:, :, 0]).shape == (3, 96, 768)
    assert pixels.line_input(im).shape == (3, 96, 320) and pixels.line_input(im, buckets=[400, 800]).shape == (3, 96, 400)
    assert pixels.enlarge_mask(np.eye(2, dtype=bool), 4, 4).sum() == 8
    assert pixels.enlarge_box((1, 2, 30, 4.9), 2, 1, 40, 50) == (2, 2, 40, 4)
    assert pixels.width_bucket(5, [3, 8]) == 8 and pixels.width_bucket(9, [3, 8]) == 8


def test_lines_through_vertices_cross_an_even_number_of_edges():
    """The middle of a slab between neighbouring floats is a vertex; a column of the grid may be one, too."""
    near = np.nextafter(1.0, 2.0)
    ring = np.array([(0.0, 0.0), (1.0, -1.0), (2.0, 0.0), (near, 1.0)])
    square = np.array([(0.0, 0.0), (2.0, 0.0), (2.0, 1.0), (0.0, 1.0)])
    assert abs(G.area(ring) - 2) < 1e-9
    assert np.allclose(G.areas(square, ring), (2, 2, 1))
    assert abs(G.mean_thickness(np.array([(0.0, 0.0), (32.0, 0.0), (16.5, 10.0)])) - 5) < 0.05


def test_upright_boxes_without_slabs():
    """Boxes from any corner, both ways round, empty ones and no boxes: the areas are those of the slabs."""
    rng = np.random.default_rng(3)
    for _ in range(300):
        x, y = np.sort(rng.integers(0, 6, (2, 2)).astype(float)), np.sort(rng.integers(0, 6, (2, 2)).astype(float))
        a, b = (np.roll(np.array([(u[0], v[0]), (u[1], v[0]), (u[1], v[1]), (u[0], v[1])])[:: rng.choice([1, -1])], rng.integers(4), axis=0) for u, v in zip(x, y, strict=True))
        assert G._as_box(a) and G._as_box(b) and G.areas(a, b) == G._slab_areas(a, b)
    bow = np.array([(0.0, 0.0), (4.0, 4.0), (4.0, 0.0), (0.0, 4.0)])
    assert G._as_box(bow) is None and G._as_box(bow[:3]) is None and G.area(bow) == 8
