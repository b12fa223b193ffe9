"""Whole runs over folders of images, detectors on stand-in sessions, the command line."""

import json
import struct
import sys
import xml.etree.ElementTree as ET
import zlib

import numpy as np
import pytest
from pyspark import cloudpickle

from quirework.operators import detectors, models, xml
from quirework.plans import options, run

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers do not know the folder of tests


def png(pixels):
    h, w = pixels.shape[:2]
    chunk = lambda k, v: struct.pack(">I", len(v)) + k + v + struct.pack(">I", zlib.crc32(k + v))
    raw = b"".join(b"\0" + row.tobytes() for row in pixels)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def page(height, width, bars):
    im = np.full((height, width, 3), 255, dtype=np.uint8)
    for y in bars:
        im[y : y + 8, 10 : width - 10] = 0
    return im


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("pages")
    (d / "a.png").write_bytes(png(page(100, 80, [10, 40])))
    (d / "b.png").write_bytes(png(page(60, 80, [])))
    (d / "c.jpg").write_bytes(b"broken")
    (d / "d.png").write_bytes(png(page(90, 80, [20])))
    (d / "e.png").write_bytes(png(page(30, 31, [])))
    return d


def bars():
    """A stand-in detector: dark rows are lines; images 31 pixels wide fail."""

    def one(im):
        if im.shape[1] == 31:
            raise ValueError("too narrow")
        dark = np.flatnonzero(im.mean(axis=(1, 2)) < 128)
        runs = np.split(dark, np.flatnonzero(np.diff(dark) > 1) + 1) if len(dark) else []
        w = im.shape[1]
        return [(2, 0.9, np.array([(0, r[0]), (w, r[0]), (w, r[-1] + 1), (0, r[-1] + 1)])) for r in runs]

    return lambda images: [one(i) for i in images]


def shades():
    return lambda crops: [(f"{c['crop_w']}x{c['crop_h']}", 0.5) for c in crops]


def test_a_folder(spark, folder, tmp_path):
    said = []
    got = run.run(str(folder), spark, said.append, detector=bars, recognizers={"latin": shades}, xml_folder=str(tmp_path / "x"), json_folder=str(tmp_path / "j"), page_xml=1)
    assert got == (2, 2)
    assert sorted(p.name for p in (tmp_path / "j").iterdir()) == ["a.json", "d.json"]
    for kind, space in (("alto", xml.ALTO), ("page", xml.PAGE)):
        assert sorted(p.name for p in (tmp_path / "x" / kind).iterdir()) == ["a.xml", "d.xml"]
        assert ET.parse(tmp_path / "x" / kind / "a.xml").getroot().tag.startswith("{" + space)
    lines = json.loads((tmp_path / "j" / "a.json").read_text())["regions"][0]["lines"]
    assert [l["polygon"][0]["y"] for l in lines] == [10, 40] and all(l["text"] == "80x9" for l in lines)
    notes = sorted(s[: s.index("]") + 1] + s.rsplit("/", 1)[1] for s in said if s[0] == "[")
    assert notes == ["[error]c.jpg: the image cannot be decoded", "[error]e.png: ValueError: too narrow", "[info]b.png: nothing detected or read"]


def test_tiles_give_what_the_whole_gives(spark, tmp_path):
    (tmp_path / "t.png").write_bytes(png(page(150, 100, [20, 70, 120])))
    with run.Recognition(spark, bars, {"latin": shades}, tile_size=100, tile_overlap=40, tile_batch_size=3) as r:
        images = r.images(str(tmp_path))
        raw = r._raw(images).where("error is null").collect()
        assert sorted((x.polygon[0].y, x.polygon[2].y) for x in raw) == [(20, 28), (70, 78), (120, 128)]
        lines, _ = r.detect(images)
        assert lines.count() == 3
    assert detectors.tile_starts(250, 100, 20) == [0, 80, 150] and detectors.tile_starts(100, 100, 20) == [0] and detectors.tile_starts(101, 100, 20) == [0, 1]


def test_single_images_keep_their_order(spark, folder):
    with run.Recognition(spark, bars, {"latin": shades}) as r:
        got = r.process_many([str(folder / n) for n in ("d.png", "b.png", "a.png")])
        assert [g and len(g.regions[0].lines) for g in got] == [1, None, 2]
        with pytest.raises(RuntimeError, match="decoded"):
            r.submit(str(folder / "c.jpg")).result()
        lines = spark.createDataFrame([(got[0].page_id, 0, 0, [{"x": 0.0, "y": 0.0}, {"x": 9.0, "y": 0.0}, {"x": 9.0, "y": 4.0}], 0.7, None, None, "mine")], "page_id string, region_pos int, line_pos int, polygon array<struct<x:double,y:double>>, det_conf double, region_polygon array<struct<x:double,y:double>>, region_conf double, region_name string")
        own = r.recognize(r.images(str(folder)), lines).first()
        assert own.regions[0].name == "mine" and own.regions[0].lines[0].text == "10x5"
    with pytest.raises(RuntimeError, match="closed"):
        r.submit("x")
    with pytest.raises(ValueError, match="no detector"), run.Recognition(spark, None, {"latin": shades}) as bare:
        bare.process(bare.images(str(folder)))


def test_command_line():
    got = run.arguments(["--input_folder", "f", "--recognizer", "latin=json:loads", "--line_iou", "0.4", "--use_ppocr", "--paddle_layout_mean", "1", "2", "3", "--detector", "paddle", "--device", "cpu"])
    assert got["line_iou"] == 0.4 and got["use_ppocr"] and got["paddle_layout_mean"] == (1.0, 2.0, 3.0) and got["detector_kind"] == "paddle" and callable(got["recognizers"]["latin"])
    assert options.make(**{k: v for k, v in got.items() if k not in ("recognizers", "detector_kind")}).ignored == ("device",)
    with pytest.raises(SystemExit):
        run.arguments([])


class Fake:
    """A session that answers with what a function makes of its inputs."""

    def __init__(self, inputs, answer):
        self.inputs, self.answer = inputs, answer

    def get_inputs(self):
        return [type("I", (), {"name": n, "shape": s}) for n, s in self.inputs]

    def get_outputs(self):
        return [type("O", (), {"name": "o", "shape": [1, None, 4]})]

    def run(self, _, feed):
        return self.answer(feed)


def test_detectors_on_stand_in_sessions(monkeypatch):
    heat = np.zeros((1, 1, 64, 96), dtype=np.float32)
    heat[0, 0, 20:30, 10:80] = 0.9
    heat[0, 0, 50:60, 10:80] = 0.5  # bright enough to be seen, too faint to be kept
    layout = np.array([[0, 0.9, 0, 0, 96, 64], [1, 0.8, 0, 15, 96, 40], [2, 0.1, 0, 0, 9, 9]], dtype=np.float32)
    masks = np.zeros((1, 3, 16, 24), dtype=np.float32) - 1
    masks[0, 0, 2:6, 2:20] = masks[0, 1, 8:12, 2:20] = 1
    fakes = {
        "d.onnx": Fake([("x", [1, 3, None, None])], lambda f: [heat]),
        "l.onnx": Fake([("image", [1, 3, 64, 96])], lambda f: [layout, np.array([3])]),
        "m.onnx": Fake([("x", [1, 3, 16, 24])], lambda f: [np.zeros((1, 3, 4)), np.array([[[-9, -9, 3.0], [-9, 2.0, -9], [-9, -9, -9]]]), masks]),
    }
    monkeypatch.setattr(models, "session", lambda path, threads=1: fakes[path])
    image = np.zeros((64, 96, 3), dtype=np.uint8)
    ((quad, score),) = models.line_detector("d.onnx")()([image])[0]
    assert score > 0.85 and quad.min(axis=0)[1] < 20 and quad.max(axis=0)[1] > 29
    find = lambda ignored: models.page_detector(models.line_detector("d.onnx"), models.layout_detector("l.onnx"), 0.3, ignored)()([image])[0]
    assert [(c, len(p)) for c, _, p in find(set())] == [(1, 4), (1, 4), (2, 4)]
    assert [c for c, _, _ in find({1})] == [1, 2] and [c for c, _, _ in find({0, 1})] == []
    assert [(c, round(s, 2)) for c, s, _ in models.mask_detector("m.onnx")()([image])[0]] == [(2, 0.95), (1, 0.88)]
    with pytest.raises(ValueError, match="onnx"):
        models.mask_detector("weights.pth")()
    o = options.make(detector="paddle", paddle_det_model_path="d.onnx", paddle_layout_model_path="l.onnx", paddle_layout_ignore_classes=("seal",))
    assert [c for c, _, _ in models.detector_of(o, {"seal": 1})()([image])[0]] == [1, 2]
    assert models.detector_of(options.make(detector="none")) is None
    for bad in (options.make(), options.make(detector="paddle")):
        with pytest.raises(ValueError):
            models.detector_of(bad)


def test_rectangles_and_shapes():
    turned = np.array([(0, 0), (4, 4), (2, 6), (-2, 2), (1, 3)])
    assert {tuple(np.round(p, 6)) for p in models.least_rectangle(turned)} == {(0, 0), (4, 4), (2, 6), (-2, 2)}
    assert models.working_shape(2000, 1000, 1536, "max", 4000) == (1536, 768) and models.working_shape(100, 50, 64, "min", 4000) == (128, 64)


def test_generation():
    path = {1: [0, 0, 3.0, 0], 2: [0, 0, 0, 3.0], 3: [5.0, 0, 0, 0]}
    ids, score = models.generated(lambda ids: np.array(path[int(ids[0, -1])]), 1, {0})
    p, q = np.exp(3) / (np.exp(3) + 3), np.exp(5) / (np.exp(5) + 3)
    assert ids == [2, 3, 0] and score == pytest.approx((p * p * q) ** (1 / 3))
    assert models.generated(lambda ids: np.array([0.0, 1.0]), 1, {0}, most=4)[0] == [1] * 4


def test_ignored_boxes():
    found = detectors.with_ignored([(5, 0.5, (0, 0, 10, 10)), (6, 0.6, (8, 8, 20, 20))], [(np.array([(1, 1), (3, 3)]), 0.9), (np.array([(8, 8), (10, 10)]), 0.8), (np.array([(50, 50), (60, 60)]), 0.7)], {5})
    assert [(c, s) for c, s, _ in found] == [(1, 0.6), (2, 0.8), (2, 0.7)]


def test_a_batch_is_filled_and_failures_stay_alone():
    sizes = []

    def model(images):
        sizes.append(len(images))
        if any(i.sum() == 0 for i in images):
            raise ValueError("black")
        return [[(2, 0.5, i[:1])] for i in images]

    got = detectors._guarded(model, [np.ones((2, 2)), np.ones((2, 2)), np.zeros((2, 2))], 2)
    assert sizes == [2, 2, 1] and [e for _, e in got] == [None, None, "ValueError: black"]


def test_labels_need_their_recognizer(spark):
    from quirework.operators import recognize
    from quirework.plans.session import Session

    d = spark.createDataFrame([(1, "a", "greek")], "line int, crop string, predicted_label string")
    with pytest.raises(Exception, match="no recognizer for 'greek'"):
        recognize.recognize(d, "crop", {"latin": lambda: lambda x: [(v, 1.0) for v in x]}, strict=True).collect()
    with pytest.raises(ValueError, match="default label"):
        Session.of({"cyrillic": shades, "greek": shades}, shades)
