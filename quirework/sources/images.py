"""Image folders, label lists and model files as sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Extensions of images; written in small or in capital letters, not mixed.
EXTENSIONS = ("jpg", "jpeg", "png", "gif", "bmp", "tiff", "tif", "webp")


def _glob(extensions: tuple[str, ...]) -> str:
    return "*.{" + ",".join(e for x in extensions for e in (x.lower(), x.upper())) + "}"


def list_images(spark: SparkSession, folder: str, extensions: tuple[str, ...] = EXTENSIONS) -> DataFrame:
    """``path, modificationTime, length`` of the images in a folder, not below it, by path. File contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", _glob(extensions)).load(folder).drop("content").orderBy("path")


def read_images(spark: SparkSession, folder: str, extensions: tuple[str, ...] = EXTENSIONS) -> DataFrame:
    """As ``list_images``, with ``content``, in no order."""
    return spark.read.format("binaryFile").option("pathGlobFilter", _glob(extensions)).load(folder)


def decode_images(spark: SparkSession, folder: str) -> DataFrame:
    """``path, height, width, n_channels, mode, data`` (BGR); an image that cannot be decoded has height -1."""
    d = spark.read.format("image").load(folder)
    return d.select(F.col("image.origin").alias("path"), "image.height", "image.width", F.col("image.nChannels").alias("n_channels"), "image.mode", "image.data")


def inventory(listed: DataFrame, extensions: tuple[str, ...] = EXTENSIONS, path: str = "path") -> DataFrame:
    """Rows of an image table whose extension is known, all small or all capital, without repeated paths.

    For inventories that are tables already; the same test as the folder scan, in SQL.
    """
    return listed.where(extension_known(F.col(path), extensions)).dropDuplicates([path])


def extension_known(path: Column, extensions: tuple[str, ...] = EXTENSIONS) -> Column:
    ext = F.regexp_extract(path, r"\.([^./]+)$", 1)
    return ext.isin([e for x in extensions for e in (x.lower(), x.upper())])


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """``id, label`` of a label list: one per line that is not blank, trimmed; ids count those lines from 0.

    A label list is a small file, read as one value so that its order is kept.
    """
    text = spark.read.text(path, wholetext=True)
    lines = F.filter(F.transform(F.split("value", r"\r?\n"), lambda x: F.trim(x)), lambda x: x != "")
    return text.select(F.posexplode(lines).alias("id", "label"))


def label_ids(names: list[str], labels: dict[str, int]) -> list[int]:
    """Ids of classes given by number or by name; an unknown name is an error."""
    out = []
    for n in names:
        if n.lstrip("-").isdigit():
            out.append(int(n))
        elif n in labels:
            out.append(labels[n])
        else:
            raise ValueError(f"unknown class {n!r}")
    return out


def model_inputs(path: str) -> list[tuple[str, list[int | None]]]:
    """Inputs of an ONNX model, symbolic dimensions as None; needs onnxruntime."""
    import onnxruntime as ort

    session = ort.InferenceSession(path, providers=["CPUExecutionProvider"])
    return [(i.name, [d if isinstance(d, int) else None for d in i.shape]) for i in session.get_inputs()]


def caller_lines(df: DataFrame, page: str = "page_id", line: str = "line_idx") -> DataFrame:
    """Lines that a caller supplies: checked to hold a page, an index and polygons of three or more points."""
    missing = {page, line, "polygon"} - set(df.columns)
    if missing:
        raise ValueError(f"missing columns: {sorted(missing)}")
    return df.where(F.col(page).isNotNull() & F.col(line).isNotNull() & (F.size("polygon") >= 3))
