"""Queries of the core operators and the SQL that states their results for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirework.functions import langid
from quirework.functions import scalars as S
from quirework.operators import detections, layout, nested, pages, recognize, xml
from quirework.plans import fixtures as X
from quirework.plans.session import Session
from quirework.runtime import table
from quirework.sources import images

BOX = ("x0", "y0", "x1", "y1")


# Pages and lines


def distinct_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines without later deliveries of the same line, which differ in written_at only."""
    t = table(spark, d, "line_text")
    return t.groupBy("line_id").agg(*(F.first(c).alias(c) for c in t.columns if c not in ("line_id", "written_at")))


def page_stats(spark: SparkSession, d: str) -> DataFrame:
    p = pages.page_stats(distinct_lines(spark, d), "page_id")  # means at 12 decimals: at fewer, some lie between two roundings
    return p.select("page_id", F.round("PC", 12).alias("PC"), *(F.round(c, 8).alias(c) for c in ("PC25", "PC50", "PC75")), "N_LONG_ROWTEXT")


def doc_stats(spark: SparkSession, d: str) -> DataFrame:
    p = pages.page_stats(X.doc_lines(spark, d), "doc_id", text="t")
    return p.select("doc_id", F.round("PC", 12).alias("PC"), *(F.round(c, 8).alias(c) for c in ("PC25", "PC50", "PC75")), "N_LONG_ROWTEXT")


def long_rows(spark: SparkSession, d: str) -> DataFrame:
    return X.doc_lines(spark, d).where(F.length("t") > S.LONG_ROW).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_long"))


def has_letters(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", S.has_letters(F.col("text")).alias("letters"))


def page_languages_stored(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "page_info").select("page_id", S.language_code(F.col("language")).alias("lang")).distinct()


def stats_text(spark: SparkSession, d: str) -> DataFrame:
    p = pages.page_stats(X.doc_lines(spark, d), "doc_id", text="t")
    return p.select("doc_id", S.stats_settings(pages.stats_struct()).alias("settings"))


def run_status(spark: SparkSession, d: str) -> DataFrame:
    """A status for each page of the inventory, by whether it has a record, an image that can be decoded, or neither."""
    t = table(spark, d, "page_images").groupBy("page_id").agg(F.max("height").alias("height"), F.max("width").alias("width"), F.min("path").alias("image_path"))
    return Session.status(t, _records(spark, d)).select("page_id", "status", F.coalesce("n_lines", F.lit(0)).alias("n_lines"))


def run_summary(spark: SparkSession, d: str) -> DataFrame:
    return pages.run_totals(run_status(spark, d))


def image_inventory(spark: SparkSession, d: str) -> DataFrame:
    return images.inventory(table(spark, d, "page_images")).select("path", S.stem(F.col("path")).alias("stem"), S.folder_of(F.col("path")).alias("folder"), "height", "width")


def pages_never_read(spark: SparkSession, d: str) -> DataFrame:
    i = images.inventory(table(spark, d, "page_images")).select("page_id").distinct()
    return i.join(table(spark, d, "line_text").select("page_id"), "page_id", "left_anti")


def page_language(spark: SparkSession, d: str) -> DataFrame:
    """Languages of pages by a trigram scorer trained on the pages' stored labels."""
    lines = distinct_lines(spark, d)
    labels = table(spark, d, "page_info").where(F.col("language").isin(list(pages.LANGUAGES))).select("page_id", "language").distinct()
    train = langid.trigram_counts(lines.join(labels, "page_id"), "text", "language")
    return pages.page_language(lines, "page_id", langid.scorer(train))


# Boxes


def small_polygon_filter(spark: SparkSession, d: str) -> DataFrame:
    b = X.boxes(spark, d)
    frac = S.area_fraction(S.box_polygon(F.col("box")), F.lit(X.SIDE), F.lit(X.SIDE))
    return detections.large_enough(b, frac).select("p", "k")


def _large(spark: SparkSession, d: str) -> DataFrame:
    return detections.large_enough(X.boxes(spark, d), S.box_area(F.col("box")) / F.lit(float(X.SIDE * X.SIDE)))


def sliver_filter(spark: SparkSession, d: str) -> DataFrame:
    return detections.not_slivers(X.boxes(spark, d), F.col("box"), F.lit(X.SIDE), F.lit(X.SIDE)).select("p", "k")


def interval_iou_pairs(spark: SparkSession, d: str) -> DataFrame:
    j = detections.overlap_pairs(X.boxes(spark, d), "p", "k", "box")
    return j.select("p", "a", "b", F.round(S.axis_iou(F.col("box_a"), F.col("box_b")), 6).alias("v"), F.round(S.box_iou(F.col("box_a"), F.col("box_b")), 6).alias("iou"))


def _edges(spark: SparkSession, d: str) -> DataFrame:
    return detections.merge_edges(detections.overlap_pairs(_large(spark, d), "p", "k", "box"), "p")


def merge_edges(spark: SparkSession, d: str) -> DataFrame:
    return _edges(spark, d)


def merge_components(spark: SparkSession, d: str) -> DataFrame:
    return detections.merge_components(_edges(spark, d), "p")


def _merged(spark: SparkSession, d: str) -> DataFrame:
    """Boxes after merging, through the operator: ``p, k`` (the group's least index)``, part, polygon, conf``."""
    b = _large(spark, d).withColumn("polygon", S.box_polygon(F.col("box")))
    return detections.merge(b, "p", "k", detections.merge_components(_edges(spark, d), "p"))


def merged_confidence(spark: SparkSession, d: str) -> DataFrame:
    m = _merged(spark, d).withColumn("_box", S.box_of(F.col("polygon")))
    return m.select("p", "k", F.round("conf", 6).alias("conf"), *(F.col(f"_box.{c}").alias(c) for c in BOX))


def merged_polygons(spark: SparkSession, d: str) -> DataFrame:
    """Area and circumference of every merged polygon."""
    m = _merged(spark, d).where("part = 0")
    n = F.size("polygon")
    at = lambda i, c: F.get("polygon", i % n)[c]
    side = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.hypot(at(i, "x") - at(i + 1, "x"), at(i, "y") - at(i + 1, "y")))
    return m.select("p", "k", F.round(F.aggregate(side, F.lit(0.0), lambda x, y: x + y), 3).alias("circumference"), F.round(S.polygon_area(F.col("polygon")), 3).alias("area"))


def line_region(spark: SparkSession, d: str) -> DataFrame:
    a = layout.assign_regions(X.boxes(spark, d), X.regions(spark, d), "p", "k", "rid")
    return a.select("p", "k", "rid", F.round("iou", 6).alias("iou"))


def regions_without_lines(spark: SparkSession, d: str) -> DataFrame:
    r = X.regions(spark, d)
    return layout.regions_without_lines(r, layout.assign_regions(X.boxes(spark, d), r, "p", "k", "rid"), "p", "rid").select("p", "rid")


def default_region(spark: SparkSession, d: str) -> DataFrame:
    all_pages = table(spark, d, "orders").select(F.col("o_orderkey").alias("p"), F.lit(X.SIDE).alias("height"), F.lit(X.SIDE).alias("width"))
    got = layout.default_regions(all_pages, X.regions(spark, d).where("o_orderstatus <> 'F'"), "p")
    return got.select("p", "id", "name", "conf", *(F.col(f"box.{c}").alias(c) for c in BOX))


def ignored_region_lines(spark: SparkSession, d: str) -> DataFrame:
    return detections.outside_ignored(X.boxes(spark, d), X.regions(spark, d), "p", F.col("rid") == 1).select("p", "k")


def reading_rank(spark: SparkSession, d: str) -> DataFrame:
    return layout.predecessors(X.boxes(spark, d), "p", "k").select("p", "k", "indegree")


def cyclic_pages(spark: SparkSession, d: str) -> DataFrame:
    return layout.cyclic_pages(layout.predecessors(X.boxes(spark, d), "p", "k"), "p")


def reading_order(spark: SparkSession, d: str) -> DataFrame:
    return layout.reading_order(X.boxes(spark, d), "p", "k").select("p", "k", "pos")


def width_batches(spark: SparkSession, d: str) -> DataFrame:
    b = X.boxes(spark, d)
    return layout.batches(b, "p", (F.col("x1") - F.col("x0")) / (F.col("y1") - F.col("y0")), "k", 2).select("p", "k", "batch")


def region_ids(spark: SparkSession, d: str) -> DataFrame:
    """Identifiers of regions as the documents number them, from nested records."""
    r = X.regions(spark, d).withColumns({"name": F.when(F.col("rid") == 2, "9 a").otherwise("paragraph"), "polygon": S.box_polygon(F.col("box"))})
    one = F.struct("rid", F.struct("name", "polygon", F.array().cast(f"array<struct<text:string,conf:double,script:string,polygon:{detections.POLYGON.simpleString()}>>").alias("lines")).alias("v"))
    docs = r.groupBy("p").agg(F.transform(F.sort_array(F.collect_list(one)), lambda x: x["v"]).alias("regions"))  # three a page
    ids = F.transform(xml.prepared(F.col("regions")), lambda x: S.xml_id(x["name"], x["nth"].cast("string")))
    return docs.select("p", F.posexplode(ids).alias("rid", "id"))


def points_text(spark: SparkSession, d: str) -> DataFrame:
    b = X.boxes(spark, d)
    moved = F.struct((F.col("x0") - 500.7).alias("x0"), F.col("y0"), F.col("x1"), F.col("y1"))
    p = S.box_polygon(moved)
    return b.select("p", "k", S.points_text(p).alias("alto"), S.points_text(p, 0).alias("page"))


def text_extent(spark: SparkSession, d: str) -> DataFrame:
    b = X.boxes(spark, d).groupBy("p").agg(xml.hull(F.collect_list("box")).alias("_h")).select("p", "_h.*")  # the boxes of one page
    side = F.lit(float(X.SIDE))
    return b.select("p", *BOX, F.greatest(side - F.col("x1"), F.lit(0.0)).alias("right_width"), F.greatest(side - F.col("y1"), F.lit(0.0)).alias("bottom_height"))


# Detections as delivered


def detections_routed(spark: SparkSession, d: str) -> DataFrame:
    r = detections.confident(detections.route(table(spark, d, "detections").withColumnRenamed("kind", "given")))
    return r.select("page_id", "det_idx", "class_id", "kind", "conf", S.polygon_area(F.col("polygon")).alias("area"))


def _sizes(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "page_images").where("height > 0")
    return t.groupBy("page_id").agg(F.min("path").alias("image_path"), F.max("height").alias("height"), F.max("width").alias("width"))


def detections_clean(spark: SparkSession, d: str) -> DataFrame:
    """Lines of the raw detections after all filters and merging."""
    raw = table(spark, d, "detections").withColumn("polygon", F.col("polygon").cast(detections.POLYGON))
    s = Session.of({"latin": _echo})
    lines, _ = s.detect(raw, _sizes(spark, d).select("page_id", "height", "width"))
    return lines.select("page_id", "det_idx", "part", F.round("conf", 6).alias("conf"), *(F.col(f"box.{c}").alias(c) for c in BOX))


def _echo() -> Callable[[list], list]:
    """A stand-in recognizer: the text is the number of points, the score grows with it."""
    return lambda items: [(f"{len(p)} points", 1 - 1 / (1 + len(p))) for p in items]


def _by_width() -> Callable[[list], list]:
    """A stand-in classifier: wide lines are latin, others cyrillic; polygons of more than six points fail."""

    def label(p) -> tuple[str, float]:
        if len(p) > 6:
            raise ValueError("too many points")
        xs = [q["x"] for q in p]
        return ("latin", 0.9) if max(xs) - min(xs) > 1000 else ("cyrillic", 0.8)

    return lambda items: [label(p) for p in items]


def page_documents(spark: SparkSession, d: str) -> DataFrame:
    """Raw detections to nested page records with both layout documents, by stand-in models."""
    raw = table(spark, d, "detections").withColumn("polygon", F.col("polygon").cast(detections.POLYGON))
    s = Session.of({"latin": _echo, "cyrillic": _echo}, _by_width)
    docs = s.process(raw, _sizes(spark, d))
    out = xml.add_documents(docs, s.steps("RFDETR", "RFDETR", "LATIN_TROCR_AND_CYRILLIC_TROCR"), scripts=True)
    return out.select("page_id", pages.line_count(F.col("regions")).alias("n_lines"), pages.page_json(docs).alias("json"), F.length("alto").alias("alto_length"), F.length("page_xml").alias("page_length"))


def _records(spark: SparkSession, d: str) -> DataFrame:
    """Nested records of the recognized lines of line_text."""
    lines = distinct_lines(spark, d).where("region_pos is not null and line_pos is not null")
    regions = lines.select("page_id", "region_pos").distinct().select("page_id", "region_pos", F.lit("paragraph").alias("name"), F.lit(None).cast(lines.schema["polygon"].dataType).alias("polygon"), F.lit(None).cast("double").alias("conf"))
    return pages.page_documents(_sizes(spark, d), regions, lines, pages.page_stats(lines, "page_id")).where(F.size("regions") > 0)


def page_records(spark: SparkSession, d: str) -> DataFrame:
    """Nested records, flattened again: all fields of all lines in their order."""
    return pages.flatten_lines(_records(spark, d)).select("page_id", "region_pos", "line_pos", "text", "conf", "script", "line_conf", "script_conf", F.size("polygon").alias("n_points"))


def document_contents(spark: SparkSession, d: str) -> DataFrame:
    """What ALTO and PAGE documents say of the records of line_text, read back from their text."""
    docs = _records(spark, d)
    out = xml.add_documents(docs, [xml.Step("TEXT_RECOGNITION", "read", stats=True)], scripts=True)
    found = lambda c, pattern: F.array_join(F.regexp_extract_all(c, F.lit(pattern), F.lit(1)), "\n")
    return out.select(
        "page_id",
        found("alto", 'CONTENT="([^"]*)"').alias("contents"),
        found("alto", 'WC="([^"]*)"').alias("confidences"),
        found("alto", 'TAGREFS="([^"]*)"').alias("scripts"),
        found("alto", 'POINTS="([^"]*)"').alias("outlines"),
        found("page_xml", "<Unicode>([^<]*)</Unicode>").alias("texts"),
    )


# Recognition


def script_argmax(spark: SparkSession, d: str) -> DataFrame:
    e = X.logits(spark, d).withColumn("r", recognize.argmax_label(F.col("logits")))
    return e.select("vec_id", F.col("r.label").alias("script"), F.round("r.confidence", 6).alias("confidence"))


def _failures(spark: SparkSession, d: str) -> DataFrame:
    e = X.logits(spark, d).withColumn("r", recognize.argmax_label(F.col("logits")))
    ok = F.col("vec_id") % 17 != 0
    return e.select(F.col("label").alias("grp"), "vec_id", F.when(ok, F.col("r.label")).alias("script"), F.when(ok, F.col("r.confidence")).alias("confidence"))


def script_fallback(spark: SparkSession, d: str) -> DataFrame:
    f = recognize.fallback_labels(_failures(spark, d), "grp", "vec_id", "script", "confidence")
    return f.select("grp", "vec_id", "predicted_label", F.round("confidence", 6).alias("confidence"), "fallback")


def route_by_label(spark: SparkSession, d: str) -> DataFrame:
    f = recognize.fallback_labels(_failures(spark, d), "grp", "vec_id", "script", "confidence")
    return recognize.group_by_label(f, "grp", "vec_id", "predicted_label").select("grp", "predicted_label", "n", "first", "label_pos")


def model_names(spark: SparkSession, d: str) -> DataFrame:
    f = recognize.fallback_labels(_failures(spark, d), "grp", "vec_id", "script", "confidence")
    kinds = f.groupBy("grp").agg(F.max(F.when(F.col("predicted_label") == "latin", F.lit("PPOCRV6_MEDIUM_REC"))).alias("l"), F.max(F.when(F.col("predicted_label") == "cyrillic", F.lit("TROCR"))).alias("c"))
    kinds = kinds.select("grp", recognize.recognition_type(F.col("l"), F.col("c")).alias("model_type"))
    return recognize.used_models(f, "grp", "vec_id", "predicted_label", {"latin": "L", "cyrillic": "C"}).join(kinds, "grp")


def sequence_score(spark: SparkSession, d: str) -> DataFrame:
    e = X.logits(spark, d)
    logp = F.transform("embedding", lambda x: -F.abs(x.cast("double")))
    tokens = F.transform(F.sequence(F.lit(0), F.size("embedding") - 1), lambda i: F.when(i == F.col("vec_id") % 64, 1).otherwise(0))
    return e.select("vec_id", F.round(recognize.sequence_score(logp, tokens, F.lit(1)), 6).alias("score"))


# Nested records


def p7_tables(spark: SparkSession, d: str) -> nested.PageTables:
    return nested.page_tables(table(spark, d, "page_json"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    t = p7_tables(spark, d)
    regions = t.regions.select("page_id", "region_pos", F.lit(-1).alias("line_pos"), "n_points")
    return regions.unionByName(t.lines.select("page_id", "region_pos", "line_pos", "n_points"))


def p7_points(spark: SparkSession, d: str) -> DataFrame:
    return p7_tables(spark, d).points


def p7_variants(spark: SparkSession, d: str) -> DataFrame:
    return p7_tables(spark, d).variants()


def p7_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages with their figures; whole numbers that are missing as -1."""
    p = p7_tables(spark, d).pages.select("page_id", "image_path", "width", "height", "language", *(F.col(f"stats.{c}").alias(c) for c in nested.STATS))
    return p.withColumns({c: F.coalesce(c, F.lit(-1).cast("long")) for c in ("width", "height", "N_LONG_ROWTEXT")})


def p7_lines(spark: SparkSession, d: str) -> DataFrame:
    return p7_tables(spark, d).lines.drop("variant")


def p7_extra(spark: SparkSession, d: str) -> DataFrame:
    """Fields that no supertype knows; positions that a kind has not as -1."""
    return p7_tables(spark, d).extra.select("page_id", *(F.coalesce(c, F.lit(-1)).alias(c) for c in ("region_pos", "line_pos")), "kind", "field")


_QUERIES: tuple[Callable[[SparkSession, str], DataFrame], ...] = (
    page_stats, doc_stats, long_rows, has_letters, page_languages_stored, stats_text, run_status, run_summary, image_inventory, pages_never_read, page_language,
    small_polygon_filter, sliver_filter, interval_iou_pairs, merge_edges, merge_components, merged_confidence, merged_polygons,
    line_region, regions_without_lines, default_region, ignored_region_lines, reading_rank, cyclic_pages, reading_order, width_batches,
    region_ids, points_text, text_extent, detections_routed, detections_clean, page_documents, page_records, document_contents,
    script_argmax, script_fallback, route_by_label, model_names, sequence_score, p7_found, p7_points, p7_variants, p7_pages, p7_lines, p7_extra,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in _QUERIES}


_LINES = "(SELECT line_id, any_value(page_id) page_id, any_value(text) AS text, any_value(conf) conf, any_value(region_pos) region_pos, any_value(line_pos) line_pos FROM line_text GROUP BY line_id)"
_STATS = """round(avg(c), 12) "PC", round(quantile_cont(c, 0.25), 8) "PC25", round(median(c), 8) "PC50", round(quantile_cont(c, 0.75), 8) "PC75",
  count(*) FILTER (length(coalesce(t, '')) > 100) "N_LONG_ROWTEXT" """
_B = f"WITH b AS ({X.BOXES})"
_BIG = f"{_B}, g AS (SELECT * FROM b WHERE (x1 - x0) * (y1 - y0) / {float(X.SIDE**2)} > 7e-05)"
_PAIR = """s AS (SELECT a.p, a.k a, b.k b, greatest(least(a.x1, b.x1) - greatest(a.x0, b.x0), 0) * greatest(least(a.y1, b.y1) - greatest(a.y0, b.y0), 0) i,
  (a.x1 - a.x0) * (a.y1 - a.y0) aa, (b.x1 - b.x0) * (b.y1 - b.y0) ab,
  greatest(least(a.y1, b.y1) - greatest(a.y0, b.y0), 0) / (greatest(a.y1, b.y1) - least(a.y0, b.y0)) v
  FROM {t} a JOIN {t} b ON a.p = b.p AND a.k < b.k AND a.x0 <= b.x1 AND b.x0 <= a.x1 AND a.y0 <= b.y1 AND b.y0 <= a.y1)"""
_EDGE = f"{_BIG}, {_PAIR.format(t='g')}, e AS (SELECT p, a, b FROM s WHERE i / (aa + ab - i) * v > 0.3 OR i / least(aa, ab) * v > 0.5)"
_COMP = f"""{_EDGE.replace('WITH b AS', 'WITH RECURSIVE b AS')}, u AS (SELECT p, a x, b y FROM e UNION SELECT p, b, a FROM e),
  w AS (SELECT DISTINCT p, x node, x other FROM u UNION SELECT w.p, w.node, u.y FROM w JOIN u ON u.p = w.p AND u.x = w.other),
  m AS (SELECT p, node, min(other) root FROM w GROUP BY p, node)"""
_R = f"{_B}, r AS ({X.REGIONS})"
_BEST = f"""{_R}, j AS (SELECT b.p, b.k, r.rid,
    greatest(least(b.x1, r.x1) - greatest(b.x0, r.x0), 0) * greatest(least(b.y1, r.y1) - greatest(b.y0, r.y0), 0) i,
    (b.x1 - b.x0) * (b.y1 - b.y0) + (r.x1 - r.x0) * (r.y1 - r.y0) s,
    greatest(b.x0 - r.x1, r.x0 - b.x1, 0) dx, greatest(b.y0 - r.y1, r.y0 - b.y1, 0) dy FROM b JOIN r ON b.p = r.p),
  q AS (SELECT *, row_number() OVER (PARTITION BY p, k ORDER BY i / (s - i) DESC, CASE WHEN i > 0 THEN 0 ELSE sqrt(dx * dx + dy * dy) END, rid) n FROM j)"""
_RANK = f"""{_B}, f AS (SELECT u.p, u.k, count(v.k) FILTER (CASE WHEN least(u.y1, v.y1) - greatest(u.y0, v.y0) > 0.5 * least(u.y1 - u.y0, v.y1 - v.y0)
    THEN (CASE WHEN v.k < u.k THEN v.x0 < u.x0 ELSE NOT u.x0 < v.x0 END) ELSE (CASE WHEN v.k < u.k THEN v.y0 < u.y0 ELSE NOT u.y0 < v.y0 END) END) indegree
  FROM b u LEFT JOIN b v ON u.p = v.p AND u.k <> v.k GROUP BY u.p, u.k)"""
_BEFORE = """CASE WHEN least(u.y1, v.y1) - greatest(u.y0, v.y0) > 0.5 * least(u.y1 - u.y0, v.y1 - v.y0)
    THEN (CASE WHEN v.k < u.k THEN v.x0 < u.x0 ELSE NOT u.x0 < v.x0 END) ELSE (CASE WHEN v.k < u.k THEN v.y0 < u.y0 ELSE NOT u.y0 < v.y0 END) END"""
_MERGED = f"{_COMP}, q AS (SELECT g.p, coalesce(m.root, g.k) k, x0, y0, x1, y1, conf FROM g LEFT JOIN m ON g.p = m.p AND g.k = m.node)"
_RECORDS = """WITH i AS (SELECT page_id, max(height) height FROM page_images GROUP BY page_id),
  n AS (SELECT line_id, any_value(page_id) page_id, any_value(region_pos) region_pos, any_value(line_pos) line_pos, any_value(text) AS text, any_value(conf) conf, any_value(script) script, any_value(line_conf) line_conf, any_value(script_conf) script_conf, any_value(polygon) polygon FROM line_text GROUP BY line_id),
  k AS (SELECT * FROM n WHERE region_pos IS NOT NULL AND line_pos IS NOT NULL AND page_id IN (SELECT page_id FROM i WHERE height > 0))"""
_STATUS = f"""{_RECORDS}, c AS (SELECT page_id, CAST(count(*) AS INTEGER) n_lines FROM k GROUP BY page_id),
  s AS (SELECT page_id, CASE WHEN n_lines IS NOT NULL THEN 'ok' WHEN coalesce(height, -1) < 0 THEN 'error' ELSE 'info' END status, n_lines FROM i LEFT JOIN c USING (page_id))"""
_ARG = """z AS (SELECT vec_id, label grp, CAST(embedding[1] AS DOUBLE) l0, CAST(embedding[2] AS DOUBLE) l1 FROM embeddings),
  y AS (SELECT *, CASE WHEN l0 >= l1 THEN 'cyrillic' ELSE 'latin' END script, 1 / (exp(l0 - greatest(l0, l1)) + exp(l1 - greatest(l0, l1))) c FROM z)"""
_FALL = f"""WITH {_ARG}, g AS (SELECT grp, script, count(*) n, min(vec_id) f FROM y WHERE vec_id % 17 <> 0 GROUP BY ALL),
  h AS (SELECT grp, arg_max(script, n * 1000000000 - f) best FROM g GROUP BY grp),
  o AS (SELECT y.grp, vec_id, CASE WHEN vec_id % 17 <> 0 THEN script ELSE coalesce(best, 'latin') END predicted_label,
    CASE WHEN vec_id % 17 <> 0 THEN round(c, 6) END confidence, vec_id % 17 = 0 AS fallback FROM y LEFT JOIN h USING (grp))"""
_COUNT = """CASE json_type({0}) WHEN 'VARCHAR' THEN len(regexp_extract_all({0} ->> '$', '-?[\\d.]+\\s*,\\s*-?[\\d.]+'))
  WHEN 'ARRAY' THEN CASE WHEN json_type({0}, '$[0]') IN ('ARRAY', 'OBJECT') THEN json_array_length({0}) ELSE json_array_length({0}) // 2 END ELSE 0 END"""


def _polygon(x: str, names: tuple[str, ...]) -> str:
    return "CASE " + " ".join(f"WHEN coalesce(json_type({x}, '$.{n}'), 'NULL') <> 'NULL' THEN {x} -> '$.{n}'" for n in names) + " END"


def _members(x: str) -> str:
    """An array's members, a single object as one, else none, as a list of JSON."""
    return f"CASE json_type({x}) WHEN 'ARRAY' THEN CAST({x} AS JSON[]) WHEN 'OBJECT' THEN [{x}] ELSE [] END"


_P7 = f"""WITH b AS (SELECT page_id, received_at, body, regexp_replace(body, '([:,\\[]\\s*)-?(NaN|Infinity)\\b', '\\1null', 'g') j FROM page_json WHERE body IS NOT NULL AND page_id IS NOT NULL),
  v AS (SELECT page_id, CAST(j AS JSON) j, row_number() OVER (PARTITION BY page_id ORDER BY received_at DESC NULLS LAST, sha256(body) DESC) n FROM b WHERE json_valid(j) AND json_type(j) = 'OBJECT'),
  t AS (SELECT page_id, json_type(j, '$.page') = 'OBJECT' w, j, CASE WHEN json_type(j, '$.page') = 'OBJECT' THEN j -> '$.page' ELSE j END x FROM v WHERE n = 1),
  g AS (SELECT page_id, x -> '$.regions' r FROM t),
  r AS (SELECT page_id, CAST(unnest(range(len(m))) AS INTEGER) region_pos, unnest(m) x FROM (SELECT page_id, {_members('r')} m FROM g)),
  l AS (SELECT page_id, region_pos, CAST(unnest(range(len(m))) AS INTEGER) line_pos, unnest(m) x FROM (SELECT page_id, region_pos, {_members("(x -> '$.lines')")} m FROM r)),
  c AS (SELECT page_id, region_pos, -1 line_pos, {_polygon('x', nested.POLYGON)} p FROM r UNION ALL SELECT page_id, region_pos, line_pos, {_polygon('x', nested.POLYGON)} FROM l),
  o AS (SELECT page_id, NULL::INTEGER region_pos, NULL::INTEGER line_pos, 'page' kind, x, coalesce(w, false) w FROM t
    UNION ALL SELECT page_id, region_pos, NULL, 'region', x, false FROM r UNION ALL SELECT page_id, region_pos, line_pos, 'line', x, false FROM l)"""
_XY = """CASE json_type(p) WHEN 'VARCHAR' THEN list_transform(regexp_extract_all(p ->> '$', '([^\\s,;]+)\\s*,\\s*([^\\s,;]+)', {g}), lambda e: TRY_CAST(e AS DOUBLE))
  WHEN 'ARRAY' THEN CASE json_type(p, '$[0]') WHEN 'ARRAY' THEN list_transform(CAST(p AS JSON[]), lambda e: TRY_CAST(e ->> '$[{i}]' AS DOUBLE))
    WHEN 'OBJECT' THEN list_transform(CAST(p AS JSON[]), lambda e: TRY_CAST(e ->> '$.{f}' AS DOUBLE))
    ELSE list_transform(range(CAST(json_array_length(p) // 2 AS BIGINT)), lambda i: TRY_CAST(CAST(p AS JSON[])[2 * i + {g}] ->> '$' AS DOUBLE)) END END"""
_NUM = "('UBIGINT', 'BIGINT', 'DOUBLE', 'HUGEINT')"
_KINDS = (("point", ("x",)), ("wrapped_page", ("page",)), ("page", ("regions", "image_path")), ("region", ("lines", "name", "region_name", "region_conf", "region_coords")), ("line", ("text", "line_conf", "script")), ("shape", nested.POLYGON))
# class of an object by its keys, and state of a value; the data have no key of these names with a value of another kind
_CLASS = "CASE " + " ".join(f"WHEN {' OR '.join(f'json_exists({{0}}, {chr(39)}$.{f}{chr(39)})' for f in names)} THEN '{c}'" for c, names in _KINDS) + " ELSE 'object' END"
_STATE = f"""CASE coalesce(json_type(e), 'NULL') WHEN 'NULL' THEN 'null' WHEN 'BOOLEAN' THEN 'bool'
  WHEN 'VARCHAR' THEN CASE WHEN regexp_full_match(e ->> '$', '\\s*-?[\\d.]+\\s*,\\s*-?[\\d.]+([\\s;]+-?[\\d.]+\\s*,\\s*-?[\\d.]+)*\\s*') THEN 'points_text' ELSE 'text' END
  WHEN 'OBJECT' THEN {_CLASS.format('e')}
  WHEN 'ARRAY' THEN CASE WHEN json_array_length(e) = 0 THEN 'none' WHEN json_type(e, '$[0]') IN {_NUM} THEN CASE WHEN json_array_length(e) = 2 THEN 'pair' ELSE 'flat_points' END
    WHEN json_type(e, '$[0]') = 'ARRAY' THEN 'pairs' WHEN json_type(e, '$[0]') = 'OBJECT' THEN CASE {_CLASS.format("(e -> '$[0]')")} WHEN 'point' THEN 'points' ELSE (CASE k WHEN 'regions' THEN 'regions' ELSE 'lines' END) END ELSE 'mixed' END
  ELSE 'num' END"""


def _first(x: str, names: tuple[str, ...]) -> str:
    return "coalesce(" + ", ".join(f"{x} ->> '$.{n}'" for n in names) + ")"


_EXT = "('" + "', '".join(e for x in images.EXTENSIONS for e in (x, x.upper())) + "')"


def _escape(x: str) -> str:
    return f"replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^[\\s\\pZ]+|[\\s\\pZ]+$', '', 'g')"


def oracle_sql() -> dict[str, str]:
    p = "x0, y0, x1, y1"
    corner = "concat_ws(' ', {0} || ',' || {1}, {2} || ',' || {1}, {2} || ',' || {3}, {0} || ',' || {3})"
    cast = [f"CAST(trunc({c}) AS INT)" for c in ("x0 - 500.7", "y0", "x1", "y1")]
    return {
        "page_stats": f"SELECT page_id, {_STATS} FROM (SELECT page_id, text t, CASE WHEN isfinite(conf) THEN conf END c FROM {_LINES}) GROUP BY page_id",
        "doc_stats": f"SELECT doc_id, {_STATS} FROM (SELECT *, conf c FROM ({X.DOC_LINES})) GROUP BY doc_id",
        "long_rows": f"SELECT doc_id, count(*) n_long FROM ({X.DOC_LINES}) WHERE length(t) > 100 GROUP BY doc_id",
        "has_letters": "SELECT doc_id, coalesce(regexp_matches(text, '\\p{L}'), false) letters FROM documents",
        "page_languages_stored": "SELECT DISTINCT page_id, CASE WHEN regexp_full_match(language, '[a-zA-Z]{1,8}(-[a-zA-Z0-9]{1,8})*') AND lower(language) <> 'unknown' THEN language END lang FROM page_info",
        "stats_text": f"SELECT doc_id, 'PC25=' || printf('%.4f', quantile_cont(conf, 0.25)) || ';PC50=' || printf('%.4f', median(conf)) || ';PC75=' || printf('%.4f', quantile_cont(conf, 0.75)) || ';N_LONG_ROWTEXT=' || count(*) FILTER (length(t) > 100) settings FROM ({X.DOC_LINES}) GROUP BY doc_id",
        "run_status": f"{_STATUS} SELECT page_id, status, coalesce(n_lines, 0) n_lines FROM s",
        "run_summary": f"{_STATUS} SELECT count(*) FILTER (status = 'ok') n_ok, count(*) FILTER (status = 'error') n_err FROM s",
        "image_inventory": f"SELECT DISTINCT ON (path) path, regexp_replace(regexp_extract(path, '[^/]*$'), '(.)\\.[^.]*$', '\\1') stem, regexp_replace(path, '/?[^/]*$', '') folder, height, width FROM page_images WHERE regexp_extract(path, '\\.([^./]+)$', 1) IN {_EXT}",
        "pages_never_read": f"SELECT DISTINCT page_id FROM page_images WHERE regexp_extract(path, '\\.([^./]+)$', 1) IN {_EXT} AND page_id NOT IN (SELECT page_id FROM line_text WHERE page_id IS NOT NULL)",
        "small_polygon_filter": f"{_BIG} SELECT p, k FROM g",
        "sliver_filter": f"{_B} SELECT p, k FROM b WHERE least(x1 - x0, y1 - y0) > {X.SIDE * 0.01}",
        "interval_iou_pairs": f"{_B}, {_PAIR.format(t='b')} SELECT p, a, b, round(v, 6) v, round(i / (aa + ab - i), 6) iou FROM s",
        "merge_edges": f"{_EDGE} SELECT * FROM e",
        "merge_components": f"{_COMP} SELECT * FROM m",
        "merged_confidence": f"{_MERGED} SELECT p, k, round(avg(conf), 6) conf, min(x0) x0, min(y0) y0, max(x1) x1, max(y1) y1 FROM q GROUP BY p, k",
        # area and circumference of a union of boxes by the cells that their sides cut out
        "merged_polygons": f"""{_MERGED}, xs AS (SELECT p, k, x, lead(x) OVER (PARTITION BY p, k ORDER BY x) x2 FROM (SELECT p, k, x0 x FROM q UNION SELECT p, k, x1 FROM q)),
          ys AS (SELECT p, k, y, lead(y) OVER (PARTITION BY p, k ORDER BY y) y2 FROM (SELECT p, k, y0 y FROM q UNION SELECT p, k, y1 FROM q)),
          cell AS (SELECT DISTINCT p, k, x, x2, y, y2 FROM xs JOIN ys USING (p, k) JOIN q USING (p, k) WHERE q.x0 <= x AND x2 <= q.x1 AND q.y0 <= y AND y2 <= q.y1),
          edge AS (SELECT p, k, e.l, count(*) n FROM (SELECT p, k, unnest([{{'v': true, 'a': x, 'b': y, 'l': y2 - y}}, {{'v': true, 'a': x2, 'b': y, 'l': y2 - y}}, {{'v': false, 'a': y, 'b': x, 'l': x2 - x}}, {{'v': false, 'a': y2, 'b': x, 'l': x2 - x}}]) e FROM cell) GROUP BY p, k, e)
          SELECT p, k, circumference, area FROM (SELECT p, k, round(sum(l), 3) circumference FROM edge WHERE n = 1 GROUP BY p, k) JOIN (SELECT p, k, round(sum((x2 - x) * (y2 - y)), 3) area FROM cell GROUP BY p, k) USING (p, k)""",
        "line_region": f"{_BEST} SELECT p, k, rid, round(i / (s - i), 6) iou FROM q WHERE n = 1",
        "regions_without_lines": f"{_BEST} SELECT p, rid FROM r WHERE (p, rid) NOT IN (SELECT (p, rid) FROM q WHERE n = 1)",
        "default_region": f"SELECT o_orderkey p, '0' id, 'paragraph' AS name, 0.0::DOUBLE conf, 0.0::DOUBLE x0, 0.0::DOUBLE y0, {X.SIDE}.0::DOUBLE x1, {X.SIDE}.0::DOUBLE y1 FROM orders WHERE o_orderstatus = 'F'",
        "ignored_region_lines": f"{_R}, c AS (SELECT b.p, b.k, coalesce(bool_or(rid = 1), false) ign, coalesce(bool_or(rid <> 1), false) kept FROM b LEFT JOIN r ON b.p = r.p AND (b.x0 + b.x1) / 2 BETWEEN r.x0 AND r.x1 AND (b.y0 + b.y1) / 2 BETWEEN r.y0 AND r.y1 GROUP BY b.p, b.k) SELECT p, k FROM c WHERE kept OR NOT ign",
        "reading_rank": f"{_RANK} SELECT * FROM f",
        "cyclic_pages": f"{_RANK} SELECT p FROM f GROUP BY p HAVING count(DISTINCT indegree) < count(*)",
        "reading_order": f"""{_RANK.replace('WITH b AS', 'WITH RECURSIVE b AS', 1)}, cyc AS (SELECT p FROM f GROUP BY p HAVING count(DISTINCT indegree) < count(*)), h AS (SELECT b.* FROM b JOIN cyc USING (p)),
          r AS (SELECT u.p, u.k u, v.k v FROM h u JOIN h v ON u.p = v.p AND u.k <> v.k WHERE {_BEFORE}),
          s AS (SELECT p, []::BIGINT[] taken FROM cyc UNION ALL SELECT p, list_append(taken, arg_min(k, {{'a': l, 'b': y0, 'c': x0, 'd': k}})) FROM
            (SELECT s.p, s.taken, h.k, h.y0, h.x0, count(r.v) l FROM s JOIN h ON h.p = s.p AND NOT list_contains(s.taken, h.k) LEFT JOIN r ON r.p = h.p AND r.u = h.k AND NOT list_contains(s.taken, r.v) GROUP BY ALL) GROUP BY p, taken),
          t AS (SELECT p, taken FROM s JOIN (SELECT p, count(*) n FROM h GROUP BY p) USING (p) WHERE len(taken) = n)
          SELECT p, k, indegree pos FROM f WHERE p NOT IN (SELECT p FROM cyc) UNION ALL SELECT p, unnest(taken) k, unnest(range(len(taken))) pos FROM t""",
        "width_batches": f"{_B} SELECT p, k, CAST((row_number() OVER (PARTITION BY p ORDER BY (x1 - x0) / (y1 - y0), k) - 1) // 2 AS INTEGER) batch FROM b",
        "region_ids": f"{_R} SELECT p, rid, CASE rid WHEN 2 THEN 'id_9_a_0' ELSE 'paragraph_' || rid END id FROM r",
        "points_text": f"{_B} SELECT p, k, {corner.format(*cast)} alto, {corner.format(*(f'greatest({c}, 0)' for c in cast))} page FROM b",
        "text_extent": f"{_B}, t AS (SELECT p, min(x0) x0, min(y0) y0, max(x1) x1, max(y1) y1 FROM b GROUP BY p) SELECT p, {p}, greatest({X.SIDE} - x1, 0) right_width, greatest({X.SIDE} - y1, 0) bottom_height FROM t",
        "detections_routed": """SELECT page_id, det_idx, class_id, CASE WHEN class_id >= 2 THEN 'line' ELSE 'region' END kind, conf, CASE WHEN len(polygon) < 3 THEN 0.0 ELSE abs(list_sum(list_transform(range(1, len(polygon) + 1), lambda i:
          polygon[i].x::DOUBLE * polygon[i % len(polygon) + 1].y - polygon[i % len(polygon) + 1].x::DOUBLE * polygon[i].y))) / 2 END area FROM detections WHERE class_id >= 1 AND conf >= 0.15""",
        "document_contents": f"""{_RECORDS}, e AS (SELECT *, {_escape("coalesce(text, '')")} v, len(polygon) > 0 w FROM k),
          q AS (SELECT *, CASE WHEN w THEN array_to_string(list_transform(polygon, lambda p: CAST(trunc(p.x) AS INTEGER) || ',' || CAST(trunc(p.y) AS INTEGER)), ' ') END pts, list_aggregate(list_transform(polygon, lambda p: p.x), 'min') x0, list_aggregate(list_transform(polygon, lambda p: p.y), 'min') y0,
            list_aggregate(list_transform(polygon, lambda p: p.x), 'max') x1, list_aggregate(list_transform(polygon, lambda p: p.y), 'max') y1 FROM e),
          o AS (SELECT page_id, region_pos, string_agg(replace(v, '"', '&quot;'), chr(10) ORDER BY line_pos) FILTER (w) contents, string_agg(printf('%.4f', least(greatest(conf, 0), 1)), chr(10) ORDER BY line_pos) FILTER (w AND isfinite(conf)) confidences,
            string_agg('SCRIPT_' || upper(script), chr(10) ORDER BY line_pos) FILTER (w AND script <> '') scripts, min(x0) || ',' || min(y0) || ' ' || max(x1) || ',' || min(y0) || ' ' || max(x1) || ',' || max(y1) || ' ' || min(x0) || ',' || max(y1) || chr(10) || string_agg(pts, chr(10) ORDER BY line_pos) outlines,
            string_agg({_strip("v")}, chr(10) ORDER BY line_pos) FILTER ({_strip("v")} <> '' OR true) texts FROM q GROUP BY ALL HAVING bool_or(w))
          SELECT page_id, {", ".join(f"coalesce(string_agg({c}, chr(10) ORDER BY region_pos), '') {c}" for c in ("contents", "confidences", "scripts", "outlines", "texts"))} FROM o GROUP BY page_id""",
        "page_records": f"{_RECORDS} SELECT page_id, CAST(dense_rank() OVER (PARTITION BY page_id ORDER BY region_pos) - 1 AS INTEGER) region_pos, CAST(row_number() OVER (PARTITION BY page_id, region_pos ORDER BY line_pos) - 1 AS INTEGER) line_pos, coalesce(text, '') \"text\", conf, script, line_conf, script_conf, CAST(len(polygon) AS INTEGER) n_points FROM k",
        "p7_found": f"{_P7} SELECT page_id, CAST(region_pos AS INTEGER) region_pos, CAST(line_pos AS INTEGER) line_pos, CAST(coalesce({_COUNT.format('p')}, 0) AS INTEGER) n_points FROM c",
        "p7_points": f"{_P7}, q AS (SELECT page_id, region_pos, line_pos, {_XY.format(g=1, i=0, f='x')} xs, {_XY.format(g=2, i=1, f='y')} ys FROM c) SELECT page_id, region_pos, line_pos, CAST(unnest(range(len(xs))) AS INTEGER) point_pos, unnest(xs) x, unnest(ys) y FROM q",
        "p7_variants": f"""{_P7}, f AS (SELECT *, row_number() OVER () id FROM o), h AS (SELECT *, unnest(json_keys(x)) k FROM f), e AS (SELECT *, x -> ('$."' || k || '"') e FROM h),
          z AS (SELECT id, string_agg('"' || k || '": "' || {_STATE} || '"', ', ' ORDER BY k) s FROM e GROUP BY id)
          SELECT kind, (CASE WHEN w THEN 'wrapped_page/' ELSE '' END) || {_CLASS.format('x')} || ' {{' || coalesce(s, '') || '}}' AS variant, count(*) n FROM f LEFT JOIN z USING (id) GROUP BY ALL""",
        "p7_pages": f"""{_P7} SELECT page_id, x ->> '$.image_path' image_path, coalesce(CAST(TRY_CAST(x ->> '$.width' AS DOUBLE) AS BIGINT), -1) width, coalesce(CAST(TRY_CAST(x ->> '$.height' AS DOUBLE) AS BIGINT), -1) height, x ->> '$.language' "language",
          {", ".join(f"TRY_CAST(x ->> '$.stats.{c}' AS DOUBLE) {chr(34)}{c}{chr(34)}" for c in nested.STATS[:4])}, coalesce(TRY_CAST(x ->> '$.stats.N_LONG_ROWTEXT' AS BIGINT), -1) "N_LONG_ROWTEXT" FROM t""",
        "p7_lines": f"""{_P7} SELECT page_id, region_pos, line_pos, x ->> '$.text' "text", TRY_CAST({_first('x', nested.CONF)} AS DOUBLE) conf, x ->> '$.script' script, TRY_CAST(x ->> '$.line_conf' AS DOUBLE) line_conf, TRY_CAST(x ->> '$.script_conf' AS DOUBLE) script_conf,
          CAST(coalesce({_COUNT.format('p')}, 0) AS INTEGER) n_points FROM (SELECT *, {_polygon('x', nested.POLYGON)} p FROM l)""",
        "p7_extra": f"""{_P7}, u AS (SELECT page_id, region_pos, line_pos, kind, x FROM o UNION ALL SELECT page_id, NULL, NULL, 'page', j FROM t WHERE w),
          k AS (SELECT page_id, region_pos, line_pos, kind, x, unnest(json_keys(x)) field FROM u)
          SELECT page_id, coalesce(region_pos, -1) region_pos, coalesce(line_pos, -1) line_pos, kind, field FROM k WHERE coalesce(json_type(x, '$."' || field || '"'), 'NULL') <> 'NULL' AND NOT list_contains(CASE kind {" ".join(f"WHEN '{k}' THEN {list(v)}" for k, v in nested.KNOWN.items())} END, field)""",
        "script_argmax": f"WITH {_ARG} SELECT vec_id, script, round(c, 6) confidence FROM y",
        "script_fallback": f"{_FALL} SELECT * FROM o",
        "route_by_label": f"{_FALL}, k AS (SELECT grp, predicted_label, count(*) n, min(vec_id) AS first FROM o GROUP BY ALL) SELECT *, CAST(row_number() OVER (PARTITION BY grp ORDER BY first) - 1 AS INTEGER) label_pos FROM k",
        "model_names": f"{_FALL}, k AS (SELECT grp, predicted_label l, min(vec_id) f FROM o GROUP BY ALL) SELECT grp, string_agg(CASE l WHEN 'latin' THEN 'L' ELSE 'C' END, ' and ' ORDER BY f) model_name, CASE WHEN count(*) = 2 THEN 'LATIN_PPOCRV6_AND_CYRILLIC_TROCR' WHEN min(l) = 'latin' THEN 'PPOCRV6_MEDIUM_REC' ELSE 'TROCR' END model_type FROM k GROUP BY grp",
        "sequence_score": "SELECT vec_id, round(exp(-list_sum(list_transform(embedding[1:vec_id % 64 + 1], lambda x: abs(CAST(x AS DOUBLE)))) / (vec_id % 64 + 1)), 6) score FROM embeddings",
    }
