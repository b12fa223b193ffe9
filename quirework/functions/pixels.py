"""Pixel kernels for Arrow functions: scaling, model input, masks. Images are uint8 [height, width, 3]."""

from __future__ import annotations

import numpy as np

# Size and colour statistics that script classifiers of this kind are trained with.
CLASSIFIER_SHAPE = (96, 768)
MEAN = (0.485, 0.456, 0.406)
STD = (0.229, 0.224, 0.225)


def resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear, pixel centres aligned."""
    h, w = image.shape[:2]
    y = np.clip((np.arange(height) + 0.5) * h / height - 0.5, 0, h - 1)
    x = np.clip((np.arange(width) + 0.5) * w / width - 0.5, 0, w - 1)
    y0, x0 = y.astype(int), x.astype(int)
    y1, x1 = np.minimum(y0 + 1, h - 1), np.minimum(x0 + 1, w - 1)
    fy, fx = (y - y0)[:, None, None], (x - x0)[None, :, None]
    v = image.reshape(h, w, -1).astype(float)
    top = v[y0][:, x0] * (1 - fx) + v[y0][:, x1] * fx
    low = v[y1][:, x0] * (1 - fx) + v[y1][:, x1] * fx
    out = top * (1 - fy) + low * fy
    out = np.rint(out).astype(image.dtype) if image.dtype == np.uint8 else out
    return out.reshape(height, width, *image.shape[2:])


def shrink(image: np.ndarray, most: int, by: str = "longer") -> np.ndarray:
    """Scaled down so that its longer (or shorter) side is at most ``most``; never enlarged."""
    h, w = image.shape[:2]
    side = max(h, w) if by == "longer" else min(h, w)
    if side <= most:
        return image
    return resize(image, max(int(np.rint(h * most / side)), 1), max(int(np.rint(w * most / side)), 1))


def classifier_input(image: np.ndarray) -> np.ndarray:
    """float32 [3, 96, 768], normalized; grey images get three channels."""
    if image.ndim == 2:
        image = np.repeat(image[:, :, None], 3, axis=2)
    v = resize(image[:, :, :3], *CLASSIFIER_SHAPE).astype(np.float32) / 255
    return ((v - np.float32(MEAN)) / np.float32(STD)).transpose(2, 0, 1)


def width_bucket(width: int, buckets: list[int]) -> int:
    """The least bucket that holds the width, else the greatest."""
    return next((b for b in sorted(set(buckets)) if b >= width), max(buckets))


def line_input(image: np.ndarray, height: int = 96, least: int = 320, most: int = 3200, buckets: list[int] | None = None) -> np.ndarray:
    """float32 [3, height, width] in [-1, 1]: scaled to the height, its width clamped and padded to the bucket."""
    h, w = image.shape[:2]
    width = int(np.clip(np.ceil(w * height / max(h, 1)), 1, most))
    room = width_bucket(max(width, least), buckets) if buckets else max(width, least)
    out = np.zeros((3, height, room), dtype=np.float32)
    part = resize(image, height, min(width, room)).astype(np.float32) / 127.5 - 1
    out[:, :, : part.shape[1]] = part.transpose(2, 0, 1)
    return out


def enlarge_mask(mask: np.ndarray, height: int, width: int) -> np.ndarray:
    """Nearest neighbour."""
    h, w = mask.shape
    return mask[(np.arange(height) * h // height)[:, None], (np.arange(width) * w // width)[None, :]]


def enlarge_box(box: tuple[float, float, float, float], fx: float, fy: float, width: int, height: int) -> tuple[int, int, int, int]:
    """Scaled, clamped to the image, truncated."""
    x0, y0, x1, y1 = box
    return tuple(int(min(max(v * f, 0), m)) for v, f, m in ((x0, fx, width), (y0, fy, height), (x1, fx, width), (y1, fy, height)))
