"""Detectors over images, whole or in tiles, as tables of raw detections.

A detector is a factory, called once per Python worker and task, of a function from RGB images to a list for each of
(class, score, polygon) in the pixels of that image: class 1 for regions, 2 and above for lines. An image that fails
is tried alone and then gives one row with its error, so no job fails for one image.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.functions import pixels
from quirework.functions import polygons as G
from quirework.functions import scalars as S
from quirework.operators.detections import suppress

Found = list[tuple[int, float, np.ndarray]]
Detector = Callable[[], Callable[[list[np.ndarray]], list[Found]]]
#: Longest side of an image that is not tiled.
WHOLE_SIDE = 768


def tile_starts(length: int, size: int, overlap: int) -> list[int]:
    """Where tiles of a side begin; the last one ends at the edge."""
    if length <= size:
        return [0]
    step = max(size - overlap, 1)
    return sorted({*range(0, length - size, step), length - size})


def from_masks(masks: Iterable[tuple[int, float, np.ndarray]], height: int, width: int) -> Found:
    """Outer outlines of masks, scaled to an image; each part has the score of its mask."""
    out = []
    for label, score, mask in masks:
        scale = np.array([width / mask.shape[1], height / mask.shape[0]])
        out += [(label, score, np.rint(p * scale)) for p in G.mask_outlines(np.asarray(mask) > 0)]
    return out


def with_ignored(regions: list[tuple[int, float, tuple[float, float, float, float]]], lines: list[tuple[np.ndarray, float]], ignored: set[int]) -> Found:
    """Boxes of kept classes as regions, and the lines but those centred in an ignored box and in no kept one."""
    kept = [(s, tuple(np.rint(b))) for c, s, b in regions if c not in ignored]
    out: Found = [(1, s, np.array([(b[0], b[1]), (b[2], b[1]), (b[2], b[3]), (b[0], b[3])], dtype=float)) for s, b in kept]
    shut, open_ = [b for c, _, b in regions if c in ignored], [b for c, _, b in regions if c not in ignored]
    for polygon, score in lines:
        x, y = (polygon.min(axis=0) + polygon.max(axis=0)) / 2
        holds = lambda b: b[0] <= x <= b[2] and b[1] <= y <= b[3]  # noqa: B023, E731
        if open_ and any(map(holds, open_)) or not any(map(holds, shut)):
            out.append((2, score, polygon))
    return out


def _guarded(model: Callable, images: list[np.ndarray], size: int) -> list[tuple[Found, str | None]]:
    """Batches of ``size``, the last one filled up with its first image; a failing batch is tried image by image."""
    out: list[tuple[Found, str | None]] = []
    for i in range(0, len(images), size):
        part = images[i : i + size]
        try:
            got = list(model(part + [part[0]] * (size - len(part))))[: len(part)]
            if len(got) != len(part):
                raise ValueError(f"{len(got)} results for {len(part)} images")
            out += [(g, None) for g in got]
        except Exception:
            for image in part:
                try:
                    out.append((list(model([image]))[0], None))
                except Exception as e:
                    out.append(([], f"{type(e).__name__}: {e}"))
    return out


def detect_images(
    images: DataFrame, detector: Detector, batch: int = 1, tile_size: int = 0, overlap: int = 128, across: int = 2, tile_iou: float = 0.85, page: str = "page_id"
) -> DataFrame:
    """Raw detections in the pixels of the image: ``page, det_idx, class_id, polygon, conf, error``.

    images: ``page, data, height, width`` (BGR as decoded). Images are shrunk first: their longer side to ``WHOLE_SIDE``,
    or with tiles their shorter side to what ``across`` tiles cover. Of detections of one class from overlapping tiles
    those under a better one (IoU above ``tile_iou``) are dropped.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = detector()
        for f in frames:
            rows = []
            for p, data, h, w in zip(f[page], f["data"], f["height"], f["width"], strict=True):
                rgb = np.frombuffer(data, dtype=np.uint8).reshape(int(h), int(w), 3)[:, :, ::-1]
                small = pixels.shrink(rgb, tile_size * across - overlap, "shorter") if tile_size else pixels.shrink(rgb, WHOLE_SIDE)
                scale = np.array([w / small.shape[1], h / small.shape[0]])
                at = [(0, 0)] if not tile_size else [(x, y) for y in tile_starts(small.shape[0], tile_size, overlap) for x in tile_starts(small.shape[1], tile_size, overlap)]
                parts = [small] if not tile_size else [small[y : y + tile_size, x : x + tile_size] for x, y in at]
                k = 0
                for (x, y), (found, error) in zip(at, _guarded(model, parts, batch), strict=True):
                    if error is not None:
                        rows.append((p, None, None, None, None, error))
                    for label, score, polygon in found:
                        points = np.rint((np.asarray(polygon, dtype=float) + [x, y]) * scale)
                        rows.append((p, k, int(label), [{"x": float(a), "y": float(b)} for a, b in points], float(score), None))
                        k += 1
            out = pd.DataFrame(rows, columns=[page, "det_idx", "class_id", "polygon", "conf", "error"])
            yield out.astype({"det_idx": "Int64", "class_id": "Int64"})

    kind = images.schema[page].dataType.simpleString()
    d = images.where("height > 0").select(page, "data", "height", "width")
    raw = d.mapInPandas(run, f"{page} {kind}, det_idx long, class_id int, polygon array<struct<x:double,y:double>>, conf double, error string")
    return raw


def best_of_tiles(raw: DataFrame, tile_iou: float = 0.85, page: str = "page_id") -> DataFrame:
    """Of raw detections (written, not computed twice) from overlapping tiles, those under no better one of their class."""
    keyed = raw.withColumns({"_pc": F.struct(page, "class_id"), "box": S.box_of(F.col("polygon"))})
    good = suppress(keyed.where("error is null"), "_pc", "det_idx", tile_iou).select(*raw.columns)
    return good.unionByName(raw.where("error is not null"))
