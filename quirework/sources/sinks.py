"""Page records and documents to files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from quirework.functions import scalars as S
from quirework.operators import pages, xml
from quirework.runtime import save


def write_table(docs: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Nested page records as Parquet."""
    docs.write.mode(mode).parquet(path)


def _write_files(rows: DataFrame, folder: str, suffix: str) -> DataFrame:
    """Files ``<folder>/<name><suffix>``, written once by the tasks now, with a status row each: ``name, status, message``.

    ``folder`` is a path or an address that Arrow's file systems know, and all executors must share it. A file is written
    under another name first and then renamed, so a task that is run again leaves whole files.
    """

    def run(frames):
        import pandas as pd
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
        files.create_dir(root, recursive=True)
        for f in frames:
            out = []
            for name, text in zip(f["name"], f["text"], strict=True):
                try:
                    part = f"{root}/.{name}{suffix}.{uuid.uuid4().hex}"
                    with files.open_output_stream(part) as h:
                        h.write(text.encode())
                    files.move(part, f"{root}/{name}{suffix}")
                    out.append((name, "ok", None))
                except Exception as e:
                    out.append((name, "error", f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["name", "status", "message"])

    return save(rows.mapInPandas(run, "name string, status string, message string")).df


def unique_names(docs: DataFrame) -> DataFrame:
    """``docs`` with ``name``: the image's stem; images of one stem get a hash of their path appended, so none is lost."""
    d = docs.withColumn("_stem", S.stem(F.col("image_path")))
    twice = d.groupBy("_stem").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_stem", F.lit(True).alias("_twice"))
    j = d.join(twice, "_stem", "left")
    tail = F.concat(F.lit("_"), F.substring(F.sha2(F.col("image_path"), 256), 1, 8))
    return j.withColumn("name", F.when(F.col("_twice"), F.concat("_stem", tail)).otherwise(F.col("_stem"))).drop("_stem", "_twice")


def write_json(docs: DataFrame, folder: str) -> DataFrame:
    """One JSON file per page in a folder that all executors share; null fields are kept."""
    return _write_files(unique_names(docs).select("name", pages.page_json(docs).alias("text")), folder, ".json")


def write_xml(docs: DataFrame, folder: str | None, steps: list[xml.Step], page: bool = False, alto: bool = True, scripts: bool = False) -> list[DataFrame]:
    """``<folder>/page/*.xml`` and ``<folder>/alto/*.xml``; nothing without a folder. Returns the status tables of what is written."""
    out = []
    if not folder:
        return out
    d = unique_names(docs)
    if page:
        out.append(_write_files(d.select("name", xml.page_column(xml.summary(steps)).alias("text")), f"{folder}/page", ".xml"))
    if alto:
        out.append(_write_files(d.select("name", xml.alto_column(steps, scripts).alias("text")), f"{folder}/alto", ".xml"))
    return out


def totals(status: DataFrame) -> tuple[int, int]:
    """(ok, errors) of a status table."""
    r: Row = pages.run_totals(status).first()
    return r["n_ok"], r["n_err"]
