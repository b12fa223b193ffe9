"""A recognition run: images of a folder to page records, files and a status for each image.

``Recognition`` holds options and models and works on tables of images; ``run`` does a whole folder, and the module is
the command line. Models are factories (see ``detectors`` and ``recognize``); where none is passed, the paths among the
options are loaded as ONNX files.
"""

from __future__ import annotations

import argparse
import importlib
import sys
import time
from collections.abc import Callable, Iterable
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.operators import detections, detectors, models, pages, recognize
from quirework.plans.options import PLACEMENT, Options, check, make
from quirework.plans.session import Session, crop_polygons
from quirework.runtime import Saved, save, scope
from quirework.sources import images as sources
from quirework.sources import sinks

# The types of the models that run, by detector.
REGION_TYPE = {"rfdetr": "RFDETR", "paddle": "PPLAYOUT_L_V1", "none": "CALLER_SUPPLIED_LINES"}
LINE_TYPE = {"rfdetr": "RFDETR", "paddle": "PPOCRV6_MEDIUM_DET", "none": "CALLER_SUPPLIED_LINES"}


class Recognition:
    """Options and models for any number of images; a context manager.

    ``process`` gives the records of a table of images, ``detect`` their lines and regions, ``recognize`` reads lines that
    the caller supplies. ``submit`` queues one image file, ``process_many`` several and keeps their order: Spark runs the
    queued images as jobs side by side.
    """

    def __init__(
        self,
        spark: SparkSession | None = None,
        detector: detectors.Detector | None = None,
        recognizers: dict[str, recognize.Model] | None = None,
        classifier: recognize.Model | None = None,
        language: Callable | None = None,
        jobs: int = 4,
        **options,
    ):
        self.spark = spark or SparkSession.builder.getOrCreate()
        kind = options.pop("detector_kind", None)
        self.options = make(**options, **({"detector": kind} if kind else {}))
        self.notes = check(self.options, given=recognizers is not None)
        if detector is None and (recognizers is None or self.options.detection_model_path or self.options.paddle_det_model_path):
            labels = self.options.paddle_layout_labels_path
            ids = {r["label"]: r["id"] for r in sources.read_labels(self.spark, labels).collect()} if labels else None  # a small file
            detector = models.detector_of(self.options, ids)
        if recognizers is None:
            recognizers, classifier = models.recognizers_of(self.options), models.classifier_of(self.options)
        self.detector, self.language = detector, language
        self.session = Session(self.options, recognizers, classifier)
        self._pool: ThreadPoolExecutor | None = ThreadPoolExecutor(jobs)
        self._saved: list[Saved] = []

    # Tables

    def images(self, folder: str) -> DataFrame:
        """``page_id, image_path, height, width, data`` of the images of a folder; undecodable ones have height -1."""
        return self._images(sources.list_images(self.spark, folder).select("path"), sources.decode_images(self.spark, folder))

    def _images(self, listed: DataFrame, decoded: DataFrame) -> DataFrame:
        same = lambda d: d.withColumn("_at", F.regexp_replace("path", "^file:/+", "file:/"))  # noqa: E731  both forms occur
        j = same(listed).join(same(decoded).drop("path"), "_at", "left")
        return j.select(F.col("path").alias("page_id"), F.col("path").alias("image_path"), F.coalesce("height", F.lit(-1)).alias("height"), F.coalesce("width", F.lit(-1)).alias("width"), "data")

    def _raw(self, images: DataFrame) -> DataFrame:
        if self.detector is None:
            raise ValueError("there is no detector; lines must be supplied by the caller")
        o = self.options
        batch = o.tile_batch_size if o.tile_size else 1
        raw = self._save(detectors.detect_images(images, self.detector, batch, o.tile_size, o.tile_overlap, o.tiles_across, o.tile_iou_threshold))
        return self._save(detectors.best_of_tiles(raw, o.tile_iou_threshold)) if o.tile_size else raw

    def _save(self, df: DataFrame) -> DataFrame:
        self._saved.append(save(df))
        return self._saved[-1].df

    def detect(self, images: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Lines and regions after all filters and merging."""
        good = self._raw(images).where("error is null").drop("error")
        return self.session.detect(good, images.where("height > 0").select("page_id", "height", "width"))

    def process(self, images: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Page records of the images on which lines were found, and a status row for every image."""
        sizes = images.select("page_id", "image_path", "height", "width")
        raw = self._raw(images)
        shape = sizes.where("height > 0").select("page_id", "height", "width")
        lines, regions = (self._save(t) for t in self.session.detect(raw.where("error is null").drop("error"), shape))
        found = shape.join(lines.select("page_id").distinct(), "page_id", "left_semi")
        docs = self._read(images, self.session.arrange(lines, regions, found))
        return docs, self.session.status(sizes, docs, raw.where("error is not null").select("page_id", "error"))

    def recognize(self, images: DataFrame, lines: DataFrame) -> DataFrame:
        """Page records of ordered lines that the caller supplies: ``page_id, region_pos, line_pos, polygon, det_conf`` and
        ``region_polygon, region_conf, region_name``."""
        return self._read(images, sources.caller_lines(lines, line="line_pos"))

    def _read(self, images: DataFrame, ordered: DataFrame) -> DataFrame:
        point = detections.POLYGON
        ordered = ordered.withColumns({c: F.col(c).cast(point) for c in ("polygon", "region_polygon")})
        crops = crop_polygons(ordered, images).withColumn("crop", F.when(F.col("crop").isNotNull(), F.struct("crop", "crop_h", "crop_w"))).drop("crop_h", "crop_w")
        read = self._save(self.session.read(crops, "crop").drop("crop"))
        language = None
        if self.language is not None:
            language = pages.page_language(read, "page_id", self.language)
        return self._save(self.session.assemble(read, images.select("page_id", "image_path", "height", "width"), language))

    # Single images

    def submit(self, path: str) -> Future:
        """Queues one image file; the result is its record as a row, None if nothing was found. Errors are raised by it."""
        if self._pool is None:
            raise RuntimeError("this session is closed")
        return self._pool.submit(self._one, path)

    def _one(self, path: str):
        listed = self.spark.read.format("binaryFile").load(path).select("path")
        docs, status = self.process(self._images(listed, sources.decode_images(self.spark, path)))
        row = docs.first()
        if row is None:
            state = status.first()
            if state is None or state["status"] == "error":
                raise RuntimeError(f"{path}: {state['message'] if state else 'no such image'}")
        return row

    def process_many(self, paths: Iterable[str]) -> list:
        """Records of image files in the order of ``paths``, None where nothing was found."""
        return [f.result() for f in [self.submit(p) for p in paths]]

    def close(self) -> None:
        """Ends the queue and deletes what this session has written to the shared folder."""
        if self._pool is not None:
            self._pool.shutdown()
            self._pool = None
        for s in self._saved:
            s.drop()
        self._saved.clear()

    def __enter__(self) -> Recognition:
        return self

    def __exit__(self, *error) -> None:
        self.close()

    # Files

    def write(self, docs: DataFrame, folder: str) -> DataFrame:
        """The files that the options ask for, beside the images unless folders are named; a status row for each file."""
        o = self.options
        out = sinks.write_xml(docs, o.xml_folder or folder, self.steps(), bool(o.page_xml), bool(o.alto_xml), self.session.classifier is not None)
        if o.output_json:
            out.append(sinks.write_json(docs, o.json_folder or folder))
        status = self.spark.createDataFrame([], "name string, status string, message string")
        for s in out:
            status = status.unionByName(s)
        return status

    def steps(self) -> list:
        o = self.options
        labels = set(self.session.recognizers)
        latin = "PPOCRV6_MEDIUM_REC" if o.use_ppocr else "TROCR"
        both = "LATIN_PPOCRV6_AND_CYRILLIC_TROCR" if o.use_ppocr else "LATIN_TROCR_AND_CYRILLIC_TROCR"
        text = both if {"latin", "cyrillic"} <= labels else "TROCR" if labels == {"cyrillic"} else latin
        regions = "NONE" if o.detector == "paddle" and not o.paddle_layout_model_path else REGION_TYPE[o.detector]
        return self.session.steps(regions, LINE_TYPE[o.detector], text)


def run(input_folder: str, spark: SparkSession | None = None, report: Callable[[str], None] = print, **options) -> tuple[int, int]:
    """Reads all images of a folder and writes their files; (images read, images failed). Images without lines are neither.

    ``options``: those of ``Recognition``, models among them. An image also fails if a file of it cannot be written.
    """
    began = time.time()
    with scope(), Recognition(spark, **options) as r:
        for note in r.notes:
            report(note)
        images = r._save(r.images(input_folder))
        docs, status = r.process(images)
        failed = r.write(docs, input_folder).where("status = 'error'").groupBy("name").agg(F.min("message").alias("_m"))
        named = sinks.unique_names(docs).select("page_id", "name").join(failed, "name").select("page_id", "_m")
        status = status.join(named, "page_id", "left")
        state = F.when(F.col("_m").isNotNull(), "error").otherwise(F.col("status"))
        status = r._save(status.select("page_id", "image_path", state.alias("status"), F.coalesce("_m", "message").alias("message"), "n_lines"))
        for s in status.where("status <> 'ok'").orderBy("image_path").toLocalIterator():
            report(f"[{s['status']}] {s['image_path']}: {s['message']}")
        n_ok, n_err = sinks.totals(status)
        speed = pages.throughput(status, time.time() - began, status.agg(F.sum("n_lines")).first()[0] or 0)
        report(f"{n_ok} read, {n_err} failed; images a second: {speed['images_per_s']}, ms a line: {speed['ms_per_line']}")
        return n_ok, n_err


def _named(spec: str):
    """``module:name`` as a factory."""
    module, _, name = spec.partition(":")
    return getattr(importlib.import_module(module), name)


def arguments(argv: list[str] | None = None) -> dict:
    """The command line as keywords of ``run``: all options, and models as ``module:factory``."""
    p = argparse.ArgumentParser("quirework", description="Reads the images of a folder into page records and layout XML.")
    p.add_argument("--detector_factory", help="module:factory of a detector")
    p.add_argument("--recognizer", action="append", default=[], metavar="LABEL=module:factory")
    p.add_argument("--classifier_factory", help="module:factory of a script classifier")
    for f in fields(Options):
        if f.name == "ignored":
            continue
        kind = {"bool": None, "int": int, "float": float}.get(f.type.split(" ")[0], str)
        if f.type.startswith("tuple"):
            p.add_argument(f"--{f.name}", nargs="*", type={"i": int, "f": float}.get(f.type[6], str), default=argparse.SUPPRESS)
        elif kind is None:
            p.add_argument(f"--{f.name}", action="store_true", default=argparse.SUPPRESS)
        else:
            p.add_argument(f"--{f.name}", type=kind, default=argparse.SUPPRESS, required=f.name == "input_folder")
    for name in PLACEMENT:
        p.add_argument(f"--{name}", nargs="*", default=argparse.SUPPRESS, help="left to Spark's configuration")
    got = {k: tuple(v) if isinstance(v, list) and k != "recognizer" else v for k, v in vars(p.parse_args(argv)).items()}
    if "detector" in got:
        got["detector_kind"] = got.pop("detector")
    detector, named, classifier = got.pop("detector_factory"), got.pop("recognizer"), got.pop("classifier_factory")
    if detector:
        got["detector"] = _named(detector)
    if named:
        got["recognizers"] = {label: _named(spec) for label, spec in (x.split("=", 1) for x in named)}
    if classifier:
        got["classifier"] = _named(classifier)
    return got


def main(argv: list[str] | None = None) -> int:
    """0 if no image failed."""
    return 1 if run(**arguments(argv))[1] else 0


if __name__ == "__main__":
    sys.exit(main())
