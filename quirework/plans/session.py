"""A recognition session: detections to ordered lines to pages, with pluggable models."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.functions import scalars as S
from quirework.operators import detections, layout, pages, recognize, xml
from quirework.plans.options import Options, check, make
from quirework.runtime import save


@dataclass
class Session:
    """``detect`` cleans detections, ``arrange`` attaches and orders lines, ``read`` recognizes them, ``assemble`` makes
    the page records; ``process`` does all. Every step is a table, so a caller may put own steps between them."""

    options: Options
    recognizers: dict[str, recognize.Model]
    classifier: recognize.Model | None = None

    def __post_init__(self):
        check(self.options, given=True)
        if self.classifier is None and len(self.recognizers) != 1:
            raise ValueError("without classifier there must be one recognizer")
        if self.classifier is not None and self.options.classifier_default_label not in self.recognizers:
            raise ValueError(f"no recognizer for the default label {self.options.classifier_default_label!r}")

    @classmethod
    def of(cls, recognizers: dict[str, recognize.Model], classifier: recognize.Model | None = None, **options) -> Session:
        return cls(make(**options), recognizers, classifier)

    def detect(self, raw: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
        """raw: ``page_id, det_idx, class_id, polygon, conf``; sizes: ``page_id, height, width``. Lines and regions."""
        o = self.options
        d = detections.confident(detections.route(raw), o.confidence_threshold).join(sizes, "page_id")
        clean = detections.postprocess_kinds(
            d,
            {
                "line": detections.Rules(o.line_percentage_threshold, o.line_iou, o.line_overlap_threshold, o.sliver_threshold),
                "region": detections.Rules(o.region_percentage_threshold, o.region_iou, o.region_overlap_threshold, None),
            },
        )
        return clean["line"], clean["region"]

    def arrange(self, lines: DataFrame, regions: DataFrame, sizes: DataFrame) -> DataFrame:
        """Ordered lines: ``page_id, region_pos, line_pos, polygon, det_conf`` and their region's columns ``region_*``."""
        key = lambda d: d.withColumn("_k", F.struct(F.col("det_idx").cast("long").alias("det_idx"), F.col("part")))
        l, r = key(lines), key(regions).select("page_id", "_k", "polygon", "conf", "box", F.lit("paragraph").alias("name"))
        whole = layout.default_regions(sizes, regions, "page_id")
        whole = whole.select("page_id", F.struct(F.lit(0).cast("long").alias("det_idx"), F.lit(0).alias("part")).alias("_k"), S.box_polygon(F.col("box")).alias("polygon"), "conf", "box", "name")
        r = save(r.unionByName(whole).withColumnRenamed("_k", "region_key")).df
        l = save(l.withColumnRenamed("_k", "line_key")).df
        to = save(layout.assign_regions(l, r, "page_id", "line_key", "region_key", polygons=True)).df
        order = layout.order_page(l, r, to, "page_id", "line_key", "region_key", self.options.reading_direction == "rl")
        reg = r.select("page_id", "region_key", F.col("polygon").alias("region_polygon"), F.col("conf").alias("region_conf"), F.col("name").alias("region_name"))
        out = order.join(l.select("page_id", "line_key", "polygon", F.col("conf").alias("det_conf")), ["page_id", "line_key"]).join(reg, ["page_id", "region_key"])
        return out.drop("line_key", "region_key")

    def read(self, lines: DataFrame, column: str) -> DataFrame:
        """Adds script and text to lines; ``column`` is what the models read (a crop, or any stand-in)."""
        o = self.options
        size = o.ppocr_batch_size if o.use_ppocr else o.trocr_batch_size
        if self.classifier is None:
            d = recognize.skip_classification(lines, next(iter(self.recognizers)))
        else:
            c = recognize.classify(lines, column, self.classifier, o.classifier_batch_size).withColumn("_at", F.struct("region_pos", "line_pos"))
            d = _fallback(save(c).df, o.classifier_default_label).withColumn("classified", F.lit(True))
        return recognize.attach_script(recognize.recognize(d, column, self.recognizers, size, 10 if o.use_ppocr else 1, strict=True))

    def assemble(self, read: DataFrame, sizes: DataFrame, language: DataFrame | None = None) -> DataFrame:
        """Nested page records with statistics. sizes: ``page_id, image_path, height, width``."""
        lines = save(read.select("page_id", "region_pos", "line_pos", "polygon", "text", F.col("text_conf").alias("conf"), "script", F.col("det_conf").alias("line_conf"), "script_conf", "region_polygon", "region_conf", "region_name")).df
        regions = lines.groupBy("page_id", "region_pos").agg(F.first("region_name").alias("name"), F.first("region_polygon").alias("polygon"), F.first("region_conf").alias("conf"))
        found = sizes.join(lines.select("page_id").distinct(), "page_id", "left_semi")
        return pages.page_documents(found, regions, lines, pages.page_stats(lines, "page_id"), language)

    def process(self, raw: DataFrame, sizes: DataFrame, column: str = "polygon") -> DataFrame:
        """Page records of raw detections; pages on which nothing was found are missing (``status`` tells them)."""
        shape = sizes.select("page_id", "height", "width")
        lines, regions = self.detect(raw, shape)
        with_lines = shape.join(lines.select("page_id").distinct(), "page_id", "left_semi")
        ordered = self.arrange(lines, regions, with_lines)
        return self.assemble(self.read(ordered, column), sizes)

    @staticmethod
    def status(sizes: DataFrame, docs: DataFrame, errors: DataFrame | None = None) -> DataFrame:
        """A row for each page of ``sizes``: ``page_id, image_path, status, message, n_lines``.

        'ok' with a record, 'error' if the image has no size or ``errors`` (``page_id, error``) has it, else 'info'.
        """
        lines = docs.select("page_id", pages.line_count(F.col("regions")).alias("n_lines"))
        s = sizes.select("page_id", "image_path", "height").join(lines, "page_id", "left")
        bad = F.lit(None).cast("string")
        if errors is not None:
            s = s.join(errors.groupBy("page_id").agg(F.min("error").alias("_error")), "page_id", "left")
            bad = F.col("_error")
        lost = F.when(F.coalesce("height", F.lit(-1)) < 0, F.lit("the image cannot be decoded")).otherwise(bad)
        state = F.when(F.col("n_lines").isNotNull(), "ok").when(lost.isNotNull(), "error").otherwise("info")
        note = F.when(state == "error", lost).when(state == "info", F.lit("nothing detected or read"))
        return s.select("page_id", "image_path", state.alias("status"), note.alias("message"), "n_lines")

    def steps(self, region_type: str, line_type: str, text_type: str) -> list[xml.Step]:
        o = self.options
        names = {"region": o.region_model_name, "line": o.line_model_name, "text": o.text_rec_model_name}
        return xml.processing_steps(region_type, line_type, text_type, names, o.script_classification_model_name if self.classifier else None)


def _fallback(classified: DataFrame, default: str | None) -> DataFrame:
    return recognize.fallback_labels(classified, "page_id", "_at", "label", "confidence", default).drop("_at", "error")


def crop_polygons(lines: DataFrame, images: DataFrame, page: str = "page_id") -> DataFrame:
    """``lines`` with ``crop`` (RGB bytes), ``crop_h, crop_w``: the polygon's bounding rectangle, white outside it.

    images: ``page, data, height, width`` (BGR as decoded). Corners outside the image are clamped; an empty crop is null.
    """
    import numpy as np
    import pandas as pd

    from quirework.functions import polygons as G

    def cut(data: bytes, h: int, w: int, polygon) -> tuple[bytes | None, int, int]:
        ring = G.as_ring(polygon)
        if ring is None:
            return None, 0, 0
        p = np.trunc(ring)
        x0, y0 = np.maximum(p.min(axis=0), 0).astype(int)
        x1, y1 = np.minimum(p.max(axis=0) + 1, [w, h]).astype(int)
        if x1 <= x0 or y1 <= y0:
            return None, 0, 0
        part = np.frombuffer(data, dtype=np.uint8).reshape(h, w, 3)[y0:y1, x0:x1, ::-1].copy()
        gx, gy = np.meshgrid(np.arange(x0, x1), np.arange(y0, y1))
        inside = G.contains(p, np.stack([gx.ravel() + 0.5, gy.ravel() + 0.5], axis=1)).reshape(gx.shape)
        part[~inside] = 255
        return part.tobytes(), int(y1 - y0), int(x1 - x0)

    def run(frames):
        for f in frames:
            got = [cut(d, int(h), int(w), p) for d, h, w, p in zip(f["data"], f["height"], f["width"], f["polygon"], strict=True)]
            out = f.drop(columns=["data", "height", "width"])
            yield out.assign(crop=[g[0] for g in got], crop_h=pd.Series([g[1] for g in got], index=f.index), crop_w=pd.Series([g[2] for g in got], index=f.index))

    j = lines.join(images.select(page, "data", "height", "width"), page)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in lines.schema) + ", crop binary, crop_h int, crop_w int"
    cols = [page, *[c for c in lines.columns if c != page], "data", "height", "width"]
    return j.select(*cols).mapInPandas(run, schema)
