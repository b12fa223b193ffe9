"""Recognition, page records, documents, nested records, sources, sinks, streams, options."""

import json
import struct
import xml.etree.ElementTree as ET
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quirework.functions import langid
from quirework.operators import nested, pages, recognize, xml
from quirework.plans import options, session
from quirework.sources import images, sinks
from quirework.streaming import ingest

# Recognition


def test_argmax_and_score(spark):
    d = spark.createDataFrame([([2.0, 1.0],), ([1.0, 1.0],), ([-5.0, 3.0],)], "l array<double>").select(recognize.argmax_label(F.col("l")).alias("r"))
    assert [r.r.label for r in d.collect()] == ["cyrillic", "cyrillic", "latin"]
    assert d.collect()[1].r.confidence == pytest.approx(0.5)
    inf = float("-inf")
    s = spark.createDataFrame([([-1.0, -3.0, inf], [5, 2, 0]), ([-1.0, -3.0], [5, 6]), ([], []), ([-2.0, inf], [2, 2])], "p array<double>, t array<int>")
    got = [r.s for r in s.select(recognize.sequence_score(F.col("p"), F.col("t"), F.lit(2)).alias("s")).collect()]
    assert got == pytest.approx([2.718281828**-2, 2.718281828**-2, 1.0, 2.718281828**-2])


def test_fallback(spark):
    rows = [(1, 0, None, None), (1, 1, "latin", 0.9), (1, 2, "cyrillic", 0.8), (1, 3, "cyrillic", 0.7), (1, 4, "latin", 0.6), (2, 0, None, None)]
    d = spark.createDataFrame(rows, "g int, i int, label string, confidence double")
    got = {(r.g, r.i): r for r in recognize.fallback_labels(d, "g", "i", "label", "confidence").collect()}
    assert got[1, 0].predicted_label == "latin" and got[1, 0].fallback and got[1, 0].confidence is None  # a tie: seen first
    assert got[2, 0].predicted_label == "latin" and not got[1, 2].fallback
    assert recognize.fallback_labels(d, "g", "i", "label", "confidence", None).where("g = 2").first().predicted_label is None


def by_value(kind):
    """Factories of stand-in models; nested, so that they travel to the workers by value."""

    def broken():
        def run(items):
            if any(x == "bad" for x in items):
                raise ValueError("bad line")
            return [(x.upper(), 0.5) for x in items]

        return run

    def reader():
        return lambda items: [(f"{int(p[0]['x'])}", 0.5) for p in items]

    return {"broken": broken, "reader": reader}[kind]


def test_recognize_isolates_failures(spark):
    rows = [(i, w, "latin") for i, w in enumerate(["a", "bad", "b", None, "c"])] + [(9, "x", "greek")]
    d = spark.createDataFrame(rows, "i int, crop string, predicted_label string")
    got = {r.i: r for r in recognize.recognize(d, "crop", {"latin": by_value("broken")}, 2).collect()}
    assert len(got) == 6
    assert [got[i].text for i in range(5)] == ["A", "", "B", "", "C"] and got[1].text_conf == 0 and "bad line" in got[1].error and got[2].error is None
    assert got[9].error == "no recognizer for greek"
    assert recognize.unmatched(d.select("i"), recognize.recognize(d, "crop", {"latin": by_value("broken")}).select("i"), ["i"]).count() == 0


def test_attempts():
    calls = []

    def flaky(items):
        calls.append(len(items))
        if len(calls) < 3:
            raise RuntimeError
        return items

    assert recognize.guarded(flaky, [1, 2], 2, attempts=5) == [(1, None), (2, None)] and calls == [2, 2, 2]
    assert recognize.guarded(lambda x: x[:1], [1, 2], 2) == [(1, None), (2, None)]  # too few results: line by line


def test_types(spark):
    rows = [(None, None), ("TROCR", None), (None, "TROCR"), ("TROCR", "TROCR"), ("PPOCRV6_MEDIUM_REC", "TROCR")]
    d = spark.createDataFrame(rows, "l string, c string").select(recognize.recognition_type(F.col("l"), F.col("c")).alias("t"))
    assert [r.t for r in d.collect()] == ["NONE", "TROCR", "TROCR", "LATIN_TROCR_AND_CYRILLIC_TROCR", "LATIN_PPOCRV6_AND_CYRILLIC_TROCR"]
    with pytest.raises(Exception, match="cyrillic"):
        spark.createDataFrame([("TROCR", "PPOCRV6_MEDIUM_REC")], "l string, c string").select(recognize.recognition_type(F.col("l"), F.col("c"))).collect()


# Pages

POINT = "array<struct<x:double,y:double>>"


def ring(x0, y0, x1, y1):
    return [{"x": float(x), "y": float(y)} for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1))]


@pytest.fixture(scope="module")
def docs(spark):
    lines = spark.createDataFrame(
        [
            (1, 0, 1, ring(10, 50, 90, 70), "b & c", 1.2, "latin", 0.9, 0.8), (1, 0, 0, ring(10, 20, 90, 40), " a ", float("nan"), None, 0.9, None),
            (1, 2, 0, ring(-5, 80, 30, 90), None, 0.5, "latin", None, None), (2, 0, 0, ring(0, 0, 9, 9), "x" * 101, None, None, None, None),
        ],
        f"page_id int, region_pos int, line_pos int, polygon {POINT}, text string, conf double, script string, line_conf double, script_conf double",
    )
    regions = spark.createDataFrame([(1, 0, "9 a", None, 0.5), (1, 1, "empty", None, None), (1, 2, "paragraph", ring(-9, 70, 40, 95), 0.7), (2, 0, None, None, None)], f"page_id int, region_pos int, name string, polygon {POINT}, conf double")
    sizes = spark.createDataFrame([(1, "/x/a b.jpg", 100, 120), (2, "/y/a b.jpg", None, None), (3, "/z/c.png", 5, 5)], "page_id int, image_path string, width int, height int")
    language = spark.createDataFrame([(1, "fi"), (2, "unknown")], "page_id int, language string")
    return pages.page_documents(sizes, regions, lines, pages.page_stats(lines, "page_id"), language).cache()


def test_records(docs):
    got = {r.page_id: r for r in docs.collect()}
    assert [l.text for l in got[1].regions[0].lines] == [" a ", "b & c"] and got[1].regions[1].lines == [] and got[1].regions[2].lines[0].text == ""
    assert got[3].regions == [] and got[3].stats is None
    assert got[1].stats.PC == pytest.approx(0.85) and got[1].stats.PC50 == pytest.approx(0.85) and got[1].stats.N_LONG_ROWTEXT == 0
    assert got[2].stats.PC is None and got[2].stats.N_LONG_ROWTEXT == 1
    assert [r.n for r in docs.orderBy("page_id").select(pages.line_count(F.col("regions")).alias("n")).collect()] == [3, 1, 0]
    assert pages.flatten_lines(docs).count() == 4
    j = json.loads(docs.where("page_id = 2").select(pages.page_json(docs).alias("j")).first().j)
    assert j["width"] is None and j["stats"]["PC"] is None and j["regions"][0]["lines"][0]["script"] is None


def test_alto(docs):
    steps = xml.processing_steps("RFDETR", "NONE", "TROCR", {"region": "r1", "text": "t1"}, "s1")
    out = {r.page_id: r.x for r in docs.select("page_id", xml.alto_column(steps, True, "me").alias("x")).collect()}
    ns = {"a": xml.ALTO}
    root = ET.fromstring(out[1].encode())
    page = root.find(".//a:Page", ns)
    assert page.get("LANG") == "fi" and page.get("PC") == "0.8500" and page.get("ID") == "page_a_b.jpg" and page.get("WIDTH") == "100"
    assert [t.get("ID") for t in root.iterfind(".//a:OtherTag", ns)] == ["SCRIPT_LATIN"]
    assert [b.get("ID") for b in root.iterfind(".//a:TextBlock", ns)] == ["id_9_a_0", "paragraph_0"]
    assert [b.get("ID") for b in root.iterfind(".//a:ComposedBlock", ns)] == ["block_1_1", "block_1_2"]
    first = root.find(".//a:TextBlock", ns)
    assert (first.get("HPOS"), first.get("VPOS"), first.get("WIDTH"), first.get("HEIGHT")) == ("10", "20", "80", "50")
    strings = [(s.get("CONTENT"), s.get("WC")) for s in root.iterfind(".//a:String", ns)]
    assert strings == [(" a ", None), ("b & c", "1.0000"), ("", "0.5000")]
    assert [l.get("TAGREFS") for l in root.iterfind(".//a:TextLine", ns)] == [None, "SCRIPT_LATIN", "SCRIPT_LATIN"]
    assert root.find(".//a:TopMargin", ns).get("HEIGHT") == "20" and root.find(".//a:LeftMargin", ns).get("WIDTH") == "0"
    (figures,) = [e.text for e in root.iterfind(".//a:processingStepSettings", ns)]
    assert figures == "PC25=0.6750;PC50=0.8500;PC75=1.0250;N_LONG_ROWTEXT=0"
    assert [p.get("ID") for p in root.iterfind(".//a:Processing", ns)] == ["TEXT_REGION_SEGMENTATION", "TEXT_LINE_SEGMENTATION", "SCRIPT_CLASSIFICATION", "TEXT_RECOGNITION"]
    second = ET.fromstring(out[2].encode())
    assert second.find(".//a:Page", ns).get("LANG") is None and second.find(".//a:TopMargin", ns) is None and second.find(".//a:PrintSpace", ns) is not None
    assert ET.fromstring(out[3].encode()).find(".//a:PrintSpace", ns) is None


SMALL_ALTO = """<?xml version='1.0' encoding='utf-8'?>
<alto xmlns="http://www.loc.gov/standards/alto/ns-v4#" xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance" xsi:schemaLocation="http://www.loc.gov/standards/alto/ns-v4# http://www.loc.gov/standards/alto/v4/alto-4-4.xsd">
  <Description>
    <MeasurementUnit>pixel</MeasurementUnit>
    <sourceImageInformation>
      <fileName>/p/1.png</fileName>
    </sourceImageInformation>
    <Processing ID="TEXT_RECOGNITION">
      <processingStepDescription>read</processingStepDescription>
    </Processing>
  </Description>
  <Styles />
  <Layout>
    <Page ID="page_1.png" PHYSICAL_IMG_NR="0" WIDTH="20" HEIGHT="10">
      <TopMargin ID="TM_00001" HPOS="0" VPOS="0" WIDTH="20" HEIGHT="1" />
      <LeftMargin ID="LM_00001" HPOS="0" VPOS="1" WIDTH="1" HEIGHT="2" />
      <RightMargin ID="RM_00001" HPOS="4" VPOS="1" WIDTH="16" HEIGHT="2" />
      <BottomMargin ID="BM_00001" HPOS="0" VPOS="3" WIDTH="20" HEIGHT="7" />
      <PrintSpace ID="PS_00001" HPOS="1" VPOS="1" WIDTH="3" HEIGHT="2">
        <ComposedBlock ID="block_1_1" HPOS="1" VPOS="1" WIDTH="3" HEIGHT="2">
          <TextBlock ID="p_0" HPOS="1" VPOS="1" WIDTH="3" HEIGHT="2">
            <Shape>
              <Polygon POINTS="1,1 4,1 4,3 1,3" />
            </Shape>
            <TextLine ID="p_0_line_0" HPOS="1" VPOS="1" WIDTH="3" HEIGHT="2">
              <Shape>
                <Polygon POINTS="1,1 4,1 4,3 1,3" />
              </Shape>
              <String ID="p_0_line_0_s0" CONTENT="&quot;a&quot; &lt; b" WC="0.2500" HPOS="1" VPOS="1" WIDTH="3" HEIGHT="2" />
            </TextLine>
          </TextBlock>
        </ComposedBlock>
      </PrintSpace>
    </Page>
  </Layout>
</alto>
"""
SMALL_PAGE = """<?xml version='1.0' encoding='utf-8'?>
<PcGts xmlns="http://schema.primaresearch.org/PAGE/gts/pagecontent/2013-07-15" xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance" xsi:schemaLocation="http://schema.primaresearch.org/PAGE/gts/pagecontent/2013-07-15 http://schema.primaresearch.org/PAGE/gts/pagecontent/2013-07-15/pagecontent.xsd">
  <Metadata>
    <Creator>me</Creator>
    <Created>now</Created>
    <LastChange>now</LastChange>
  </Metadata>
  <Page imageFilename="/p/1.png" imageWidth="20" imageHeight="10">
    <TextRegion id="r0" custom="readingOrder {index:0;}">
      <Coords points="1,1 4,1 4,3 1,3" />
      <TextLine id="r0l0" custom="readingOrder {index:0;}">
        <Coords points="1,1 4,1 4,3 1,3" />
        <TextEquiv>
          <Unicode>"a" &lt; b</Unicode>
        </TextEquiv>
      </TextLine>
    </TextRegion>
  </Page>
</PcGts>
"""


def test_whole_documents(spark):
    line = f"struct<polygon:{POINT},text:string,conf:double,script:string,line_conf:double,script_conf:double>"
    schema = f"image_path string, width int, height int, language string, stats struct<PC:double,PC25:double,PC50:double,PC75:double,N_LONG_ROWTEXT:long>, regions array<struct<name:string,polygon:{POINT},conf:double,lines:array<{line}>>>"
    at = [{"x": float(x), "y": float(y)} for x, y in ((1, 1), (4, 1), (4, 3), (1, 3))]
    text = {"polygon": at, "text": ' "a" < b', "conf": 0.25}
    rows = [("/p/1.png", 20, 10, "unknown", None, [{"name": "p", "lines": [dict(text, text=text["text"].strip())]}]), ("/p/2.png", None, None, None, None, None), ("/p/3.png", 1, 1, "sv", None, [{"name": "p", "lines": None}])]
    d = spark.createDataFrame([dict(zip(("image_path", "width", "height", "language", "stats", "regions"), r, strict=True)) for r in rows], schema)
    out = {r.image_path: r for r in d.select("image_path", xml.alto_column([xml.Step("TEXT_RECOGNITION", "read", stats=True)], True).alias("a"), xml.page_column(None, "me", "now").alias("p")).collect()}
    assert out["/p/1.png"].a == SMALL_ALTO and out["/p/1.png"].p == SMALL_PAGE
    odd = dict(text, polygon=[*at, {"x": float("nan"), "y": 1.0}, {"x": float("inf"), "y": 1.0}, {"x": None, "y": 2.0}], text='"a" < b')
    d2 = spark.createDataFrame([{"image_path": "/p/1.png", "width": 20, "height": 10, "language": None, "stats": None, "regions": [{"name": "p", "lines": [odd]}]}], schema)
    assert d2.select(xml.page_column(None, "me", "now").alias("p")).first().p == SMALL_PAGE  # vertices without a place are left out
    for path in ("/p/2.png", "/p/3.png"):
        assert "TextBlock" not in out[path].a and "TextRegion" not in out[path].p
        assert ET.fromstring(out[path].a.encode()) is not None and ET.fromstring(out[path].p.encode()) is not None
    plan = d.select(xml.alto_column([], True))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_page_xml(docs):
    out = {r.page_id: r.x for r in docs.select("page_id", xml.page_column("done", "me", "2020-01-01T00:00:00+00:00").alias("x")).collect()}
    ns = {"p": xml.PAGE}
    root = ET.fromstring(out[1].encode())
    assert [e.tag.split("}")[1] for e in root.find("p:Metadata", ns)] == ["Creator", "Created", "LastChange", "Comments"]
    assert [r.get("id") for r in root.iterfind(".//p:TextRegion", ns)] == ["r0", "r1"]
    assert [l.get("id") for l in root.iterfind(".//p:TextLine", ns)] == ["r0l0", "r0l1", "r1l0"]
    assert [u.text or "" for u in root.iterfind(".//p:Unicode", ns)] == ["a", "b & c", ""]
    assert root.find(".//p:TextRegion[@id='r1']/p:Coords", ns).get("points").startswith("0,70 40,70")
    assert "imageWidth" not in ET.fromstring(out[2].encode()).find("p:Page", ns).attrib


def test_step_of_other_kind():
    with pytest.raises(ValueError):
        xml.processing_steps("TROCR", "NONE", "TROCR", {})


def test_language_scorer(spark):
    rows = [(1, 0, 0, "den gamla mannen gick över bron"), (2, 0, 0, "vanha mies meni yli sillan"), (3, 0, 0, "12 34"), (4, 0, 0, None), (5, 0, 1, "mannen gick"), (5, 0, 0, "hej hej gamla")]
    lines = spark.createDataFrame(rows, "page_id int, region_pos int, line_pos int, text string")
    train = spark.createDataFrame([("den gamla mannen gick över bron och hej", "sv"), ("vanha mies meni yli sillan ja", "fi"), (None, "sv")], "t string, l string")
    counts = langid.trigram_counts(train, "t", "l")
    got = {r.page_id: r.language for r in pages.page_language(lines, "page_id", langid.scorer(counts)).collect()}
    assert got == {1: "sv", 2: "fi", 3: None, 5: "sv"}

    def failing():
        def run(texts):
            raise ValueError

        return run

    assert {r.language for r in pages.page_language(lines, "page_id", failing).collect()} == {None}


# Nested records (p7)


def reference(body):
    """Rows of an intact body by plain recursion."""
    v = json.loads(body)
    page = v["page"] if isinstance(v.get("page"), dict) else v
    listed = lambda x: x if isinstance(x, list) else [x] if isinstance(x, dict) else []

    def points(r):
        p = next((r[k] for k in ("polygon", "coords", "region_coords") if r.get(k) is not None), [])
        if isinstance(p, str):
            return len(p.split())
        return len(p) // 2 if p and not isinstance(p[0], (list, dict)) else len(p)

    out = []
    for i, r in enumerate(listed(page.get("regions"))):
        out.append((i, -1, points(r)))
        out += [(i, j, points(l)) for j, l in enumerate(listed(r.get("lines")))]
    return out


BODIES = [
    '{"image_path": "a", "regions": [{"name": "p", "polygon": [[1,2],[3,4],[5,6]], "lines": [{"text": "x", "polygon": [{"x":1,"y":2},{"x":3,"y":4}], "conf": NaN}, {"text": "y", "coords": "1,2 3,4 5,6"}]}]}',
    '{"page": {"image_path": "b", "width": 10, "regions": {"region_name": "q", "region_coords": [1.0,2.0,3.0,4.0], "lines": {"text": "z", "polygon": null, "line_conf": 0.5}}}, "xml_input": {}}',
    '{"image_path": "c", "regions": null, "stats": {"PC": 0.5}}',
    '{"image_path": "d", "regions": [{"conf": 0.1, "lines": null}, {"lines": []}, {"polygon": []}]}',
    '{"image_path": "e"}',
]


@pytest.mark.parametrize("body", BODIES)
def test_flatten(body):
    got = [(r[2], -1 if r[3] is None else r[3], len(r[-1])) for r in nested.flatten(1, body) if r[1] != "page"]
    assert got == reference(body)


def test_tables(spark):
    t = lambda s: __import__("datetime").datetime(2020, 1, 1, 0, 0, s)
    rows = [(1, t(1), BODIES[3]), (1, t(2), BODIES[0]), (1, t(3), BODIES[0][:-9]), (2, t(1), BODIES[1]), (2, t(1), BODIES[1]), (3, t(1), "[]"), (3, t(0), None), (None, t(1), BODIES[0]), (4, None, BODIES[2]), (5, t(1), "")]
    d = spark.createDataFrame(rows, "page_id long, received_at timestamp, body string").withColumn("kind", F.lit("clash"))
    tables = nested.page_tables(d)
    assert sorted(r.page_id for r in tables.pages.collect()) == [1, 2, 4]
    assert sorted((r.page_id, r.region_pos, r.n_points) for r in tables.regions.collect()) == [(1, 0, 3), (2, 0, 2)]
    assert sorted((r.page_id, r.line_pos, r.n_points, r.conf) for r in tables.lines.collect()) == [(1, 0, 2, None), (1, 1, 3, None), (2, 0, 0, None)]
    assert tables.points.count() == 3 + 2 + 2 + 3
    assert {r.variant for r in tables.regions.collect()} == {'region {"lines": "lines", "name": "text", "polygon": "pairs"}', 'region {"lines": "line", "region_coords": "flat_points", "region_name": "text"}'}
    sub = tables.subtypes("region")['region {"lines": "line", "region_coords": "flat_points", "region_name": "text"}']
    assert sub.columns == ["page_id", "region_pos", "region_coords", "region_name"] and [len(r.region_coords) for r in sub.collect()] == [2]
    assert sum(t.count() for t in tables.subtypes("line").values()) == tables.lines.count() == 3
    assert [(r.kind, r.field, r.value) for r in tables.extra.collect()] == [("page", "xml_input", "{}")]
    assert [r.stats.PC for r in tables.pages.where("page_id = 4").collect()] == [0.5]
    parents = tables.lines.join(tables.regions, ["page_id", "region_pos"], "left_anti")
    assert parents.count() == 0
    assert nested.page_tables(d.limit(0)).regions.count() == 0


def test_states_come_from_below():
    line = {"text": "x", "polygon": [[1, 2], [3, 4]]}
    state = lambda v: nested.tree(v).state
    assert state(line) == "line" and state({"polygon": [[1, 2]]}) == "shape" and state({"polygon": [["a"]]}) == "object"
    assert state([line, None, {"coords": "1,2 3e1,4"}]) == "lines" and state([{"lines": []}, {"polygon": [[1, 2]]}]) == "regions"
    assert state({"page": {"regions": []}}) == "wrapped_page" and state({"page": 3}) == "object" and state({"page": [1]}) == "object"
    assert state([{"x": 1, "y": 2}, [3, 4]]) == "mixed_points" and state([1, 2]) == "pair" and state([1, 2, 3, 4]) == "flat_points"
    assert state({"x": [1], "y": 2}) == "object" and state([True, 1]) == "mixed"
    assert nested.variant(nested.tree(line)) == 'line {"polygon": "pairs", "text": "text"}'
    assert nested.points_of(nested.tree([[1, 2], None, [5], {"x": 7, "y": "8"}, [9, 1]])) == [(1, 2), (None, None), (None, None), (7, 8), (9, 1)]
    assert nested.points_of(nested.tree("1e1,2 -3.5,.5")) == [(10, 2), (-3.5, 0.5)]


@settings(max_examples=60, deadline=None)
@given(st.recursive(st.none() | st.booleans() | st.floats(allow_nan=False) | st.text(max_size=5), lambda c: st.lists(c, max_size=4) | st.dictionaries(st.sampled_from(["x", "y", "page", "regions", "lines", "text", "polygon", "name"]), c, max_size=4), max_leaves=20))
def test_any_record_is_read(value):
    body = json.dumps(value if isinstance(value, dict) else {"regions": value})
    assert next(iter(nested.flatten(1, body)))[1] == "page"
    list(nested.flatten(1, body))


# Sources and sinks


def png(width, height):
    raw = b"".join(b"\0" + bytes([40, 80, 120]) * width for _ in range(height))
    chunk = lambda k, v: struct.pack(">I", len(v)) + k + v + struct.pack(">I", zlib.crc32(k + v))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("images")
    for name in ("b.png", "a.PNG", "c.Png", "d.txt"):
        (d / name).write_bytes(png(6, 4))
    (d / "e.jpg").write_bytes(b"no image")
    (d / "sub").mkdir()
    (d / "sub" / "f.png").write_bytes(png(2, 2))
    return str(d)


def test_image_folder(spark, folder):
    names = [r.path.rsplit("/", 1)[1] for r in images.list_images(spark, folder).collect()]
    assert names == ["a.PNG", "b.png", "e.jpg"]
    assert images.read_images(spark, folder).where("length > 0").count() == 3
    sizes = {r.path.rsplit("/", 1)[1]: (r.height, r.width) for r in images.decode_images(spark, folder).collect()}
    assert sizes["b.png"] == (4, 6) and sizes["e.jpg"] == (-1, -1)


def test_crops(spark, folder):
    im = images.decode_images(spark, folder).where("path like '%b.png'").withColumn("page_id", F.lit(1))
    lines = spark.createDataFrame([(1, ring(1, 1, 4, 3)), (1, ring(-3, -3, 2, 2)), (1, ring(50, 50, 60, 60)), (1, None)], f"page_id int, polygon {POINT}")
    got = session.crop_polygons(lines, im).collect()
    assert sorted((r.crop_h, r.crop_w) for r in got) == [(0, 0), (0, 0), (3, 3), (3, 4)]
    assert next(r for r in got if r.crop_w == 4).crop[:3] == bytes([40, 80, 120])


def test_labels(spark, tmp_path):
    (tmp_path / "l.txt").write_text("paragraph\n\n  title \nfigure\n")
    got = {r.label: r.id for r in images.read_labels(spark, str(tmp_path / "l.txt")).collect()}
    assert got == {"paragraph": 0, "title": 1, "figure": 2}
    assert images.label_ids(["2", "title"], got) == [2, 1]
    with pytest.raises(ValueError):
        images.label_ids(["table"], got)


def test_caller_lines(spark):
    d = spark.createDataFrame([(1, 0, ring(0, 0, 1, 1)), (1, 1, ring(0, 0, 1, 1)[:2]), (None, 2, ring(0, 0, 1, 1))], f"page_id int, line_idx int, polygon {POINT}")
    assert images.caller_lines(d).count() == 1
    with pytest.raises(ValueError):
        images.caller_lines(d.drop("polygon"))


def test_files(docs, tmp_path):
    status = sinks.write_json(docs, str(tmp_path / "json"))
    assert sinks.totals(status) == (3, 0)
    names = sorted(p.name for p in (tmp_path / "json").iterdir())
    assert len(names) == 3 and "c.json" in names  # two images of one stem keep both files
    assert json.loads((tmp_path / "json" / "c.json").read_text())["width"] == 5
    steps = xml.processing_steps("NONE", "NONE", "TROCR", {})
    for s in sinks.write_xml(docs, str(tmp_path / "xml"), steps, page=True):
        assert sinks.totals(s) == (3, 0)
    assert len(list((tmp_path / "xml" / "alto").iterdir())) == len(list((tmp_path / "xml" / "page").iterdir())) == 3
    assert sinks.write_xml(docs, None, steps) == []
    sinks.write_table(docs, str(tmp_path / "t"))


# Streams


def test_streams(spark, folder, tmp_path):
    seen = []
    q = ingest.run_batches(ingest.image_stream(spark, folder, 1), lambda df, i: seen.append(df.count()), str(tmp_path / "c1"))
    q.awaitTermination(60)
    assert sum(seen) == 3 and max(seen) == 1
    lines = spark.sql("SELECT * FROM VALUES (1L, 's', 'a', 0.5D, timestamp'2020-01-01 10:00:00'), (1L, 's', 'a', 0.5D, timestamp'2020-01-03 10:00:00'), (2L, 's', 'b', 0.7D, timestamp'2020-01-01 12:00:00') AS t(line_id, source, text, conf, written_at)")
    lines.write.parquet(str(tmp_path / "lines"))
    stream = ingest.table_stream(spark, str(tmp_path / "lines"), "line_id long, source string, text string, conf double, written_at timestamp")
    once = ingest.latest_lines(stream).writeStream.format("memory").queryName("once").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c3")).start()
    once.awaitTermination(60)
    assert sorted(r.line_id for r in spark.table("once").collect()) == [1, 2]
    out = ingest.daily_stats(stream, "30 days").writeStream.format("memory").queryName("daily").outputMode("update").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c2")).start()
    out.awaitTermination(60)
    assert sorted((str(r.day)[:10], r.n) for r in spark.table("daily").collect()) == [("2020-01-01", 2), ("2020-01-03", 1)]


# Options and session


def test_options():
    o = options.make(recognition_model_path="m", processor_path="p", device="cuda", line_iou=0.4)
    assert o.line_iou == 0.4 and o.ignored == ("device",) and len(options.check(o)) == 1
    with pytest.raises(TypeError):
        options.make(nonsense=1)
    for bad in ({}, {"recognition_model_path": "m"}, {"recognition_model_path": "m", "processor_path": "p", "detector": "paddle"}, {"recognition_model_path": "m", "processor_path": "p", "cyrillic_recognition_model_path": "c", "cyrillic_processor_path": "q"}, {"detector": "x"}):
        with pytest.raises(ValueError):
            options.check(options.make(**bad))
    full = options.make(recognition_model_path="m", processor_path="p", cyrillic_recognition_model_path="c", cyrillic_processor_path="q", script_classification_model_path="s")
    assert options.check(full) == []


def test_session(spark):
    raw = spark.createDataFrame(
        [(1, 0, 2, ring(10, 10, 90, 20), 0.9), (1, 1, 2, ring(12, 12, 92, 21), 0.7), (1, 2, 2, ring(10, 50, 90, 60), 0.9), (1, 3, 1, ring(0, 0, 95, 70), 0.8), (1, 4, 0, ring(0, 0, 9, 9), 0.9), (1, 5, 2, ring(0, 0, 90, 20), 0.1), (2, 0, 2, ring(5, 5, 60, 20), 0.9), (3, 0, 1, ring(5, 5, 60, 20), 0.9)],
        f"page_id int, det_idx int, class_id int, polygon {POINT}, conf double",
    )
    sizes = spark.createDataFrame([(i, f"/x/{i}.jpg", 100, 100) for i in (1, 2, 3)], "page_id int, image_path string, height int, width int")
    with pytest.raises(ValueError):
        session.Session.of({"latin": by_value("reader"), "cyrillic": by_value("reader")})
    got = {r.page_id: r for r in session.Session.of({"latin": by_value("reader")}).process(raw, sizes).collect()}
    assert set(got) == {1, 2}
    (region,) = got[1].regions
    assert [l.text for l in region.lines] == ["10", "10"] and region.lines[0].line_conf == pytest.approx(0.8) and region.lines[0].script is None
    assert [(p.x, p.y) for p in got[2].regions[0].polygon] == [(0, 0), (100, 0), (100, 100), (0, 100)] and got[2].regions[0].conf == 0
