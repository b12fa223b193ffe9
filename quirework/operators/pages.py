"""Pages from recognized lines: statistics, language, the nested page record, run totals."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.functions import scalars as S

LINE_FIELDS = ("polygon", "text", "conf", "script", "line_conf", "script_conf")
#: The languages that a page's language is chosen from.
LANGUAGES = ("sv", "fi", "en", "de", "ru", "lv", "lt", "la", "et", "fr", "da", "no", "is", "se")


def page_stats(lines: DataFrame, page: str, conf: str = "conf", text: str = "text") -> DataFrame:
    """``page, PC, PC25, PC50, PC75, N_LONG_ROWTEXT``: mean and exact percentiles of finite confidences, long lines.

    Null where a page has no finite confidence; the count is 0 then, not null.
    """
    c = F.when(S.is_finite(F.col(conf)), F.col(conf))
    long_row = F.coalesce(F.length(text), F.lit(0)) > S.LONG_ROW
    pct = lambda q: F.percentile(c, F.lit(q))
    return lines.groupBy(page).agg(
        F.avg(c).alias("PC"), pct(0.25).alias("PC25"), pct(0.5).alias("PC50"), pct(0.75).alias("PC75"), F.count_if(long_row).alias("N_LONG_ROWTEXT")
    )


def stats_struct() -> Column:
    return F.struct("PC", "PC25", "PC50", "PC75", "N_LONG_ROWTEXT")


def page_language(lines: DataFrame, page: str, scorer: Callable[[], Callable[[list[str]], list[str | None]]], text: str = "text", order: tuple[str, ...] = ("region_pos", "line_pos")) -> DataFrame:
    """``page, language``: the scorer's answer for the texts of a page in order, null without letters or if it fails.

    ``scorer`` is a factory of a function from texts to codes, called once per worker and task.
    """
    has = lines.where(F.coalesce(F.col(text), F.lit("")) != "")
    joined = has.groupBy(page).agg(F.sort_array(F.collect_list(F.struct(*order, text))).alias("_l"))
    texts = joined.select(page, F.array_join(F.transform("_l", lambda x: x[text]), " ").alias("_t"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = scorer()
        for f in frames:
            out: list[str | None] = []
            for t in f["_t"]:
                try:
                    out.append(score([t])[0] if any(map(str.isalpha, t)) else None)
                except Exception:
                    out.append(None)
            yield pd.DataFrame({page: f[page], "language": out})

    kind = lines.schema[page].dataType.simpleString()
    return texts.mapInPandas(run, f"{page} {kind}, language string")


def page_documents(pages: DataFrame, regions: DataFrame, lines: DataFrame, stats: DataFrame | None = None, language: DataFrame | None = None, page: str = "page_id") -> DataFrame:
    """One nested record per page of ``pages``: regions in order, lines in order, regions without lines kept.

    pages: ``page, image_path, width, height``. regions: ``page, region_pos, name, polygon, conf``. lines: ``page,
    region_pos, line_pos`` and ``LINE_FIELDS``; a missing text is ''. All aggregates are by page or within it.
    """
    fields = [F.coalesce("text", F.lit("")).alias("text") if c == "text" else F.col(c) for c in LINE_FIELDS]
    per_region = lines.groupBy(page, "region_pos").agg(F.sort_array(F.collect_list(F.struct("line_pos", F.struct(*fields).alias("v")))).alias("_l"))
    joined = regions.join(per_region, [page, "region_pos"], "left")
    empty = F.array().cast(per_region.schema["_l"].dataType)
    region = F.struct("name", "polygon", "conf", F.transform(F.coalesce("_l", empty), lambda x: x["v"]).alias("lines"))
    nested = joined.groupBy(page).agg(F.sort_array(F.collect_list(F.struct("region_pos", region.alias("v")))).alias("_r"))
    out = pages.join(nested, page, "left")
    out = out.join(stats.select(page, stats_struct().alias("stats")), page, "left") if stats is not None else out.withColumn("stats", F.lit(None))
    out = out.join(language, page, "left") if language is not None else out.withColumn("language", F.lit(None).cast("string"))
    none = F.array().cast(nested.schema["_r"].dataType)
    return out.select(page, "image_path", "width", "height", "language", "stats", F.transform(F.coalesce("_r", none), lambda x: x["v"]).alias("regions"))


def line_count(regions: Column) -> Column:
    return F.aggregate(regions, F.lit(0), lambda a, r: a + F.size(r["lines"]))


def fallback_polygon(region: Column) -> Column:
    """The region's polygon, else the box of its lines, else null."""
    box = S.whole_box(F.flatten(F.transform(region["lines"], lambda l: l["polygon"])))
    return F.when(F.size(region["polygon"]) > 0, region["polygon"]).otherwise(F.when(box.isNotNull(), S.box_polygon(box).cast(_polygon_type(region))))


def _polygon_type(region: Column) -> str:
    return "array<struct<x:double,y:double>>"


def flatten_lines(docs: DataFrame, page: str = "page_id") -> DataFrame:
    """Nested records back to rows: ``page, region_pos, line_pos`` and the fields of each line."""
    r = docs.select(page, F.posexplode("regions").alias("region_pos", "_r"))
    return r.select(page, "region_pos", F.posexplode("_r.lines").alias("line_pos", "_l")).select(page, "region_pos", "line_pos", "_l.*")


def page_json(docs: DataFrame) -> Column:
    """The page record as JSON text, null fields kept."""
    cols = ["image_path", "width", "height", "language", "stats", "regions"]
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false", "pretty": "true"})


def run_totals(status: DataFrame) -> DataFrame:
    """``n_ok, n_err``; pages of status 'info' (nothing detected) count in neither."""
    return status.agg(F.count_if(F.col("status") == "ok").alias("n_ok"), F.count_if(F.col("status") == "error").alias("n_err"))


def throughput(pages: DataFrame, seconds: float, n_lines: int) -> dict[str, float | None]:
    """Images a second without the first, and milliseconds a line."""
    n = pages.count()
    return {"images_per_s": (n - 1) / seconds if seconds > 0 and n > 1 else None, "ms_per_line": 1000 * seconds / n_lines if n_lines else None}
