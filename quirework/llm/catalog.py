"""Queries of the training-data operators and, where SQL can state the result, their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirework.llm import cutoff, language, lookalike, mixing, packing, quality, radix, repetition, scan, textkind
from quirework.runtime import save, table

P1_KEYS = ["language", "script", "run_day"]
P1_PERCENTS = {"p10": 0.10, "p25": 0.25, "p50": 0.50, "p75": 0.75, "p90": 0.90}


def distinct_lines(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    """Lines without their later copies, which differ in written_at only."""
    t = table(spark, d, "line_text")
    return t.groupBy("line_id").agg(*(F.first(c).alias(c) for c in cols))


def distinct_pages(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    t = table(spark, d, "page_info")
    return t.groupBy("page_id").agg(*(F.first(c).alias(c) for c in cols))


def p1_values(spark: SparkSession, d: str) -> DataFrame:
    """conf of distinct lines with language and day of their page and their script; no key null."""
    lines = table(spark, d, "line_text").where(F.col("script").isNotNull() & radix.finite(F.col("conf")))
    lines = lines.groupBy("line_id").agg(F.first("page_id").alias("page_id"), F.first("script").alias("script"), F.first("conf").alias("conf"))
    pages = distinct_pages(spark, d, "language", "run_at").where("language is not null and run_at is not null")
    pages = pages.select("page_id", "language", F.date_format("run_at", "yyyy-MM-dd").alias("run_day"))
    return lines.join(pages, "page_id").select(*P1_KEYS, "conf")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    p = radix.radix_percentiles(p1_values(spark, d), P1_KEYS, "conf", {"p10": 0.10, "p50": 0.50})
    return p.where((F.col("n") >= 30) & ((F.col("p50") < 0.60) | (F.col("p10") < 0.25))).select(*P1_KEYS)


def p1_percentiles(spark: SparkSession, d: str) -> DataFrame:
    p = radix.radix_percentiles(p1_values(spark, d), P1_KEYS, "conf", P1_PERCENTS)
    return p.select(*P1_KEYS, "n", *(F.round(c, 8).alias(c) for c in P1_PERCENTS))


def p1_merged_days(spark: SparkSession, d: str) -> DataFrame:
    """Daily histograms of 26 leading bits merged over days: enclosing bounds per language and script."""
    daily = radix.radix_histogram(p1_values(spark, d), P1_KEYS, "conf", 26)
    merged = radix.merge_histograms(daily, ["language", "script"])
    b = radix.histogram_percentiles(merged, ["language", "script"], P1_PERCENTS, 26)
    return b.select("language", "script", "n", *(F.round(f"{c}_{side}", 9).alias(f"{c}_{side}") for c in P1_PERCENTS for side in ("low", "high")))


def p2_repetition(spark: SparkSession, d: str) -> DataFrame:
    """Share of repeated words of each document and page, judged by the learned list."""
    docs = table(spark, d, "documents").select(F.lit("document").alias("record_kind"), F.col("doc_id").alias("record_id"), "text")
    pages, huge = repetition.page_texts(table(spark, d, "line_text").select("page_id", "region_pos", "line_pos", "line_id", "text"))
    pages = pages.select(F.lit("page").alias("record_kind"), F.col("page_id").alias("record_id"), "text")
    return repetition.repeated(docs.unionByName(pages), repetition.huge_statistics(huge))


def p2_shares(spark: SparkSession, d: str) -> DataFrame:
    """Words of each document and page, and the share of them in runs that came before."""
    return p2_repetition(spark, d).select("record_kind", "record_id", "n_words", F.round("repeated_share", 9).alias("repeated_share"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    r = p2_repetition(spark, d)
    return r.where(F.col("is_repeated") & ~F.col("junk")).select("record_kind", "record_id")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return scan.find_noise(docs, "doc_id", "text", scan.fit(docs, "text", table(spark, d, "lexicon")))


def p3_repaired(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return scan.repaired(docs, "doc_id", "text", scan.fit(docs, "text", table(spark, d, "lexicon")))


def p4_records(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(F.lit("document").alias("record_kind"), F.col("doc_id").alias("id"), "text")
    lines = table(spark, d, "line_text").select(F.lit("line").alias("record_kind"), F.col("line_id").alias("id"), "text")
    return docs.unionByName(lines)


def p4_classes(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.classes(p4_records(spark, d)).select("record_kind", "id", "class_id", "form")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    c = lookalike.classes(p4_records(spark, d))
    return lookalike.pairs(c.where(~_junk("text")))


@F.pandas_udf(T.BooleanType())
def _junk(text: pd.Series) -> pd.Series:
    return text.map(textkind.is_junk)


def p10_statistics(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    stats = save(quality.statistics(docs, "doc_id", "text", "lang", table(spark, d, "lexicon"))).df
    return quality.scored(stats)


def p10_shares(spark: SparkSession, d: str) -> DataFrame:
    """The statistics themselves, before any score."""
    docs = table(spark, d, "documents")
    stats = quality.statistics(docs, "doc_id", "text", "lang", table(spark, d, "lexicon"))
    return stats.select("doc_id", *(F.round(c, 9).alias(c) if not c.startswith("n_") else F.col(c) for c in quality.STATS))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return p10_statistics(spark, d).where("kind is not null").select("doc_id", F.col("kind").alias("text_kind"))


def _language_model(spark: SparkSession, d: str) -> language.Model:
    return language.train(table(spark, d, "documents"), "doc_id", "text", "lang")


def _languages(spark: SparkSession, d: str) -> DataFrame:
    """Languages of documents and pages in one form; pages carry the normalized label of their page_info row."""
    model = _language_model(spark, d)
    docs = language.document_languages(table(spark, d, "documents"), "doc_id", "text", "lang", model)
    docs = docs.withColumn("record_kind", F.lit("document"))
    info = distinct_pages(spark, d, "language").select(F.col("page_id").alias("_p"), language.label_language(F.col("language")).alias("label"))
    pages = language.page_languages(table(spark, d, "line_text"), model).join(info, F.col("page_id") == F.col("_p"))
    pages = pages.select(F.lit("page").alias("record_kind"), F.col("page_id").alias("record_id"), "label", "lang", "confidence", "n_words", "ambiguous", "is_main", "n_langs", F.lit(False).alias("junk"))
    cols = pages.columns
    return docs.select(*(F.col(c).cast("int").alias(c) if c == "n_langs" else F.col(c) for c in cols)).unionByName(pages)


def p5_languages(spark: SparkSession, d: str) -> DataFrame:
    return _languages(spark, d).drop("junk")


def p5_passages(spark: SparkSession, d: str) -> DataFrame:
    """Language and confidence of each passage: of documents by number and first word, of pages by line."""
    model = _language_model(spark, d)
    docs = language.document_passages(table(spark, d, "documents"), "doc_id", "text", model)
    info = table(spark, d, "page_info").select(F.col("page_id").alias("_p")).distinct()
    lines = language.page_passages(table(spark, d, "line_text"), model).join(info, F.col("page_id") == F.col("_p"), "left_semi")
    none, rest = F.lit(None).cast("long"), ["lang", "confidence", "n_words", "ambiguous"]
    docs = docs.select(F.lit("document").alias("record_kind"), "record_id", "passage", "first_word", none.alias("line_id"), *rest)
    pages = lines.select(F.lit("page").alias("record_kind"), F.col("page_id").alias("record_id"), none.alias("passage"), none.alias("first_word"), "line_id", *rest)
    return docs.unionByName(pages)


def p5_segments(spark: SparkSession, d: str) -> DataFrame:
    """Segments of documents: runs of passages of one language, with their first and last word."""
    return language.document_segments(table(spark, d, "documents"), "doc_id", "text", _language_model(spark, d))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Records whose label is missing or names another language than the main one, or that have several languages."""
    every = save(_languages(spark, d)).df
    main = every.where("is_main and not junk")
    case = main.where(F.col("label").isNull() | (F.col("label") != F.col("lang")) | (F.col("n_langs") > 1)).select("record_kind", "record_id")
    return every.join(case, ["record_kind", "record_id"]).select("record_kind", "record_id", "lang")


def p6_cutoffs(spark: SparkSession, d: str, finish: int = 4096) -> DataFrame:
    lines = distinct_lines(spark, d, "source", "script", "conf")
    targets = table(spark, d, "source_targets")
    return cutoff.keep_cutoffs(lines, ["source", "script"], "conf", targets, ["source"], "keep_pct", finish)


def p6_rounds(spark: SparkSession, d: str) -> DataFrame:
    """As ``p6_cutoffs``, by pivots alone: no window of more than eight records is sorted."""
    return p6_cutoffs(spark, d, 8)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    c = p6_cutoffs(spark, d)
    return c.where((F.col("kept") - F.col("wanted")) * 50 > F.col("n")).select("source", "script")


def p8_pieces(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return packing.pack(docs, "doc_id", packing.byte_tokens(F.col("text")), table(spark, d, "pack_sizes"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents in several containers, counted from the packing itself."""
    per = p8_pieces(spark, d).groupBy("profile", "doc_id").agg((F.max("piece") + 1).alias("n_pieces"))
    return per.where("n_pieces > 1")


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill(p8_pieces(spark, d), table(spark, d, "pack_sizes"))


def p8_placements(spark: SparkSession, d: str) -> DataFrame:
    """How many pieces dominance has fixed, and what best fit has placed."""
    return packing.placements(p8_pieces(spark, d))


def p8_whole(spark: SparkSession, d: str) -> DataFrame:
    """That no token is lost, no container too full and no document cut without need."""
    return packing.wholeness(p8_pieces(spark, d), table(spark, d, "pack_sizes"))


def _p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "source_targets"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    m = _p9_mix(spark, d)
    return m.select("source", "tokens", F.round("goal", 3).alias("goal"), F.round("rate", 6).alias("rate"), F.round("used", 3).alias("used"), "goal_permille", F.round("share_permille", 6).alias("share_permille"), "short")


def p9_soft_tokens(spark: SparkSession, d: str) -> DataFrame:
    """Expected tokens that documents without a target source would add to each, by the classifier's posteriors."""
    return _p9_mix(spark, d).select("source", "tokens", F.round("soft_tokens", 3).alias("soft_tokens"))


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    """The mixture itself: how many times each document that is used is used."""
    return mixing.mixture(table(spark, d, "documents"), _p9_mix(spark, d))


def p9_drawn(spark: SparkSession, d: str) -> DataFrame:
    """Tokens and shares of p9_mixture beside the goals."""
    m = mixing.drawn(table(spark, d, "documents"), _p9_mix(spark, d))
    return m.withColumns({c: F.round(c, 6) for c in ("expected_permille", "share_permille")})


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Sources that the solved rates leave short: all repeats are used and the goal is not met."""
    return _p9_mix(spark, d).where("short").select("source")


_LINES = "(SELECT line_id, any_value(page_id) page_id, any_value(source) source, any_value(script) script, any_value(conf) conf FROM line_text GROUP BY line_id)"
_P1 = f"""v AS (SELECT i.language, l.script, strftime(i.run_at, '%Y-%m-%d') run_day, l.conf
FROM {_LINES} l JOIN (SELECT page_id, any_value(language) AS language, any_value(run_at) run_at FROM page_info GROUP BY page_id) i USING (page_id)
WHERE l.script IS NOT NULL AND l.conf IS NOT NULL AND isfinite(l.conf) AND i.language IS NOT NULL AND i.run_at IS NOT NULL)"""
_P6 = f"""v AS (SELECT source, script, conf, keep_pct FROM {_LINES} l JOIN source_targets USING (source)
WHERE script IS NOT NULL AND conf IS NOT NULL AND isfinite(conf) AND keep_pct IS NOT NULL),
w AS (SELECT *, count(*) OVER (PARTITION BY source, script) n, row_number() OVER (PARTITION BY source, script ORDER BY conf DESC) r FROM v),
c AS (SELECT source, script, n, (keep_pct * n + 99) // 100 wanted, conf AS cutoff FROM w WHERE r = greatest((keep_pct * n + 99) // 100, 1)),
k AS (SELECT c.source, c.script, c.n, c.wanted, c.cutoff, count(*) kept FROM c JOIN v ON v.source = c.source AND v.script = c.script AND v.conf >= c.cutoff GROUP BY ALL)"""
_P9 = """t AS (SELECT source, coalesce(sum(strlen(text)), 0) tokens FROM documents WHERE source IN (SELECT source FROM source_targets) GROUP BY source)"""

_P9R = f"""{_P9}, g AS (SELECT s.source, coalesce(tokens, 0)::BIGINT tokens, mix_permille / 1000.0 * (SELECT sum(tokens) FROM t) goal, max_repeats cap, mix_permille FROM source_targets s LEFT JOIN t USING (source)),
          r AS (SELECT *, CASE WHEN tokens = 0 THEN least(1.0, cap) ELSE least(goal / tokens, cap) END rate FROM g)"""
_P9U = """u AS (SELECT doc_id, source, coalesce(strlen(text), 0) t, CAST(floor(rate) AS INTEGER) + CASE WHEN ('0x' || md5(CAST(doc_id AS VARCHAR))[1:7])::BIGINT / 268435456.0 < rate - floor(rate) THEN 1 ELSE 0 END times FROM documents JOIN r USING (source))"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_found": p1_found,
        "p1_percentiles": p1_percentiles,
        "p1_merged_days": p1_merged_days,
        "p2_found": p2_found,
        "p2_shares": p2_shares,
        "p2_repetition": p2_repetition,
        "p3_found": p3_found,
        "p3_repaired": p3_repaired,
        "p4_found": p4_found,
        "p4_classes": p4_classes,
        "p5_found": p5_found,
        "p5_languages": p5_languages,
        "p5_passages": p5_passages,
        "p5_segments": p5_segments,
        "p6_found": p6_found,
        "p6_cutoffs": p6_cutoffs,
        "p6_rounds": p6_rounds,
        "p8_found": p8_found,
        "p8_pieces": p8_pieces,
        "p8_fill": p8_fill,
        "p8_placements": p8_placements,
        "p8_whole": p8_whole,
        "p9_found": p9_found,
        "p9_shares": p9_shares,
        "p9_soft_tokens": p9_soft_tokens,
        "p9_mixture": p9_mixture,
        "p9_drawn": p9_drawn,
        "p10_found": p10_found,
        "p10_shares": p10_shares,
        "p10_statistics": p10_statistics,
    }


_STRIP = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"
_LIKE = f"""CASE WHEN regexp_full_match(w, '\\p{{Nd}}+') THEN length(w) WHEN length(w) >= 2 AND regexp_full_match(w, '\\pL+')
  AND 6 * length(regexp_replace(lower(w), '[^{"".join(sorted(textkind.VOWELS))}]', '', 'g')) >= length(w) THEN length(w) ELSE 0 END"""
_CELLS = f"""1 + greatest(length(x) - length(replace(x, chr(9), '')), length(trim(x, '|')) - length(replace(trim(x, '|'), '|', '')),
  len(regexp_extract_all(x, '\\s{{3,}}')), len(regexp_extract_all(x, '\\.{{3,}}')), length(x) - length(replace(x, ';', '')) - len(regexp_extract_all(x || ' ', ';\\s')))"""
_MARKED = """regexp_matches(x, '(?i)^(?:[•\\-*–—·◦▪‣]|\\(?\\d{1,3}[.)]|\\(?\\pL[.)]|\\(?[ivxlc]+[.)])\\s+\\S')"""
_ENTRY = f"""({_MARKED} OR (length(x) - length(replace(x, ' ', '')) <= 5 AND len(regexp_extract_all(x, '[\\pL\\pN]+')) <= 4 AND NOT regexp_matches(x, '[.!?;:]|[-¬=⸗\u00ad‐–—]$')))"""


def _kinds(texts: str) -> str:
    """CTEs that end in ``kinds`` (id columns of ``texts``, statistics of p10, kind by limits in the wide gaps of the statistics)."""
    forms = lookalike.sql_look("text", {a: b for a, b in lookalike.LOOKS.items() if a in textkind._FORMS}, False)
    count = lambda test: f"len(list_filter(ls, lambda x: {test}))"
    return f"""pl AS (SELECT *, {forms} p FROM {texts}),
      pw AS (SELECT *, regexp_extract_all(p, '[\\pL\\pN]+') ws, length(regexp_replace(p, '\\s', '', 'g')) vis, list_filter(list_transform(string_split(p, chr(10)), lambda x: {_STRIP.format('x')}), lambda x: x <> '') ls, (SELECT list(word) FROM lexicon WHERE is_common) lx FROM pl),
      ps AS (SELECT * EXCLUDE (ws, ls, lx), len(ws) n_words, list_sum(list_transform(ws, lambda w: length(w))) letters, coalesce(list_sum(list_transform(ws, lambda w: {_LIKE})), 0) / greatest(vis, 1) word_like_share,
        len(list_filter(regexp_extract_all(lower(p), '[\\pL\\pN]+'), lambda w: list_contains(lx, w))) common,
        len(ls) n_lines, {count(_ENTRY)} entries, {count(f'{_CELLS} >= 3')} cells, {count("regexp_matches(x, '[.!?;:,…]$')")} ended, {count(_MARKED)} marked FROM pw),
      kinds AS (SELECT * EXCLUDE (p, vis), CASE WHEN n_lines = 0 THEN NULL WHEN word_like_share < 0.3 THEN 'junk' WHEN cells > 0.6 * n_lines THEN 'table' WHEN entries > 0.75 * n_lines AND n_lines > 1 THEN 'list' END kind, vis FROM ps)"""


def _repeated(texts: str) -> str:
    """CTEs that end in ``shares`` (kind, id, share of words in runs met before) of ``texts`` (kind, id, text), and their ``kinds``."""
    return f"""{_kinds(texts)}, rw AS (SELECT record_kind, record_id, regexp_extract_all(lower({lookalike.sql_look('lower(text)')}), '[\\pL\\pN]+') ws FROM {texts}),
      ru AS (SELECT record_kind, record_id, len(ws) n, unnest(range(1, len(ws) + 1)) i, ws FROM rw),
      rh AS (SELECT record_kind, record_id, n, i, CASE WHEN i + 4 <= n THEN hash(ws[i:i + 4]) END h FROM ru),
      ra AS (SELECT *, CASE WHEN h IS NOT NULL AND min(i) OVER (PARTITION BY record_kind, record_id, h) < i THEN 1 ELSE 0 END a FROM rh),
      rc AS (SELECT *, max(a) OVER (PARTITION BY record_kind, record_id ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) c FROM ra),
      shares AS (SELECT record_kind, record_id, any_value(n) n, sum(c) / any_value(n) share FROM rc GROUP BY ALL)"""


_RECORDS = """t AS (SELECT 'document' record_kind, doc_id record_id, text FROM documents WHERE text IS NOT NULL UNION ALL
  SELECT 'page', page_id, string_agg(text, chr(10) ORDER BY region_pos NULLS FIRST, line_pos NULLS FIRST, line_id) FROM (SELECT DISTINCT page_id, region_pos, line_pos, line_id, text FROM line_text WHERE page_id IS NOT NULL) GROUP BY page_id),
  tt AS (SELECT * FROM t WHERE text IS NOT NULL)"""
_LOOKS = f"""t AS (SELECT 'document' record_kind, doc_id id, text FROM documents UNION SELECT 'line', line_id, text FROM line_text),
          m AS (SELECT record_kind, id, text, {lookalike.sql_look('text')} look FROM t WHERE text IS NOT NULL AND id IS NOT NULL)"""


def _edge(c: str, upper: bool) -> str:
    """Lower or upper edge of the bucket of 26 leading bits (12 of sign and exponent, 14 of the mantissa) around a positive value."""
    e = f"floor(log2({c}))"
    low = f"(1 + floor(({c} / pow(2, {e}) - 1) * 16384) / 16384) * pow(2, {e})"
    return f"CASE WHEN {c} = 0 THEN {'pow(2, -1022) / 16384' if upper else '0'} WHEN {c} < 0 THEN NULL ELSE {low} + {f'(pow(2, {e} - 14) - pow(2, {e} - 52))' if upper else '0'} END"


def oracle_sql() -> dict[str, str]:
    qs = ", ".join(f"round(quantile_cont(conf, {q}), 8) {c}" for c, q in P1_PERCENTS.items())
    return {
        "p1_found": f"WITH {_P1} SELECT language, script, run_day FROM v GROUP BY ALL HAVING count(*) >= 30 AND (quantile_cont(conf, 0.5) < 0.6 OR quantile_cont(conf, 0.1) < 0.25)",
        "p1_percentiles": f"WITH {_P1} SELECT language, script, run_day, count(*) n, {qs} FROM v GROUP BY language, script, run_day",
        "p1_merged_days": f"""WITH {_P1}, r AS (SELECT language, script, conf, count(*) OVER w n, row_number() OVER (PARTITION BY language, script ORDER BY conf) r FROM v WINDOW w AS (PARTITION BY language, script)),
          q AS (SELECT language, script, any_value(n) n, {", ".join(f"max(CASE WHEN r = greatest(ceil({q} * n), 1) THEN conf END) {c}" for c, q in P1_PERCENTS.items())} FROM r GROUP BY language, script)
          SELECT language, script, n, {", ".join(f"round({_edge(c, False)}, 9) {c}_low, round({_edge(c, True)}, 9) {c}_high" for c in P1_PERCENTS)} FROM q""",
        "p2_found": f"WITH {_RECORDS}, {_repeated('tt')} SELECT record_kind, record_id FROM shares JOIN kinds USING (record_kind, record_id) WHERE share >= 0.3 AND kind IS DISTINCT FROM 'junk'",
        "p2_shares": f"""WITH {_RECORDS}, {_repeated('tt')}, every AS (SELECT 'document' record_kind, doc_id record_id FROM documents UNION ALL SELECT DISTINCT 'page', page_id FROM line_text WHERE page_id IS NOT NULL)
          SELECT record_kind, record_id, coalesce(n, 0) n_words, round(coalesce(share, 0), 9) repeated_share FROM every LEFT JOIN shares USING (record_kind, record_id)""",
        "p4_found": f"""WITH {_LOOKS}, {_kinds('m')}, k AS (SELECT record_kind, look, id, text FROM kinds WHERE kind IS DISTINCT FROM 'junk' AND regexp_matches(look, '[\\pL\\pN]'))
          SELECT a.record_kind, a.id id_a, b.id id_b FROM k a JOIN k b ON a.record_kind = b.record_kind AND a.look = b.look AND a.id < b.id AND a.text <> b.text""",
        "p10_shares": f"""WITH d AS (SELECT doc_id, text FROM documents), {_kinds('d')}, z AS (SELECT *, n_lines = 0 blank FROM kinds)
          SELECT doc_id, coalesce(n_words, 0) n_words, round(CASE WHEN n_words > 0 THEN letters / n_words ELSE 0 END, 9) mean_word_length, round(CASE WHEN n_words > 0 THEN word_like_share ELSE 0 END, 9) word_like_share,
            round(CASE WHEN vis > 0 THEN 1 - coalesce(letters, 0) / vis ELSE 0 END, 9) symbol_share, round(CASE WHEN n_words > 0 THEN common / n_words ELSE 0 END, 9) common_share, coalesce(n_lines, 0) n_lines,
            {", ".join(f"round(CASE WHEN n_lines > 0 THEN {c} / n_lines ELSE 0 END, 9) {name}" for c, name in (("entries", "entry_share"), ("cells", "row_share"), ("ended", "ended_share"), ("marked", "marked_share")))} FROM z""",
        "p10_found": f"WITH d AS (SELECT doc_id, text FROM documents WHERE text IS NOT NULL), {_kinds('d')} SELECT doc_id, kind text_kind FROM kinds WHERE kind IS NOT NULL",
        "p4_classes": f"""WITH {_LOOKS},
          c AS (SELECT record_kind, look, arg_min({{'f': text, 'i': id}}, {{'f': text, 'i': id}}) c FROM m WHERE regexp_matches(look, '[\\pL\\pN]') GROUP BY ALL HAVING min(text) <> max(text))
          SELECT record_kind, id, c.i class_id, c.f form FROM m JOIN c USING (record_kind, look)""",
        "p6_found": f"WITH {_P6} SELECT source, script FROM k WHERE (kept - wanted) * 50 > n",
        "p6_cutoffs": f"WITH {_P6} SELECT * FROM k",
        "p6_rounds": f"WITH {_P6} SELECT * FROM k",
        "p8_found": "SELECT profile, doc_id, CAST(ceil(strlen(text) / capacity) AS INTEGER) n_pieces FROM documents, pack_sizes WHERE strlen(text) > capacity",
        "p8_whole": "SELECT profile, CAST(sum(strlen(coalesce(text, ''))) AS BIGINT) tokens, count(*) n_docs, count(*) FILTER (strlen(text) > capacity) n_cut, CAST(0 AS BIGINT) n_over, CAST(0 AS BIGINT) n_loose FROM documents, pack_sizes GROUP BY profile",
        "p9_shares": f"""WITH {_P9R}
          SELECT source, tokens, round(goal, 3) goal, round(rate, 6) rate, round(rate * tokens, 3) used, CAST(mix_permille AS DOUBLE) goal_permille, round(1000 * rate * tokens / (SELECT sum(rate * tokens) FROM r), 6) share_permille, goal - rate * tokens > 1e-9 * goal short FROM r""",
        "p9_mixture": f"WITH {_P9R}, {_P9U} SELECT doc_id, source, times FROM u WHERE times > 0",
        "p9_drawn": f"""WITH {_P9R}, {_P9U}, p AS (SELECT source, count(*) n_docs, CAST(sum(times) AS BIGINT) times, CAST(sum(times * t) AS BIGINT) tokens FROM u WHERE times > 0 GROUP BY source)
          SELECT source, CAST(mix_permille AS DOUBLE) goal_permille, round(1000 * rate * r.tokens / (SELECT sum(rate * tokens) FROM r), 6) expected_permille, coalesce(n_docs, 0) n_docs, coalesce(times, 0) times, coalesce(p.tokens, 0) tokens,
            round(1000 * coalesce(p.tokens, 0) / (SELECT sum(tokens) FROM p), 6) share_permille FROM r LEFT JOIN p USING (source)""",
        "p9_found": f"WITH {_P9} SELECT source FROM source_targets LEFT JOIN t USING (source) WHERE coalesce(tokens, 0) * max_repeats * 1000 < mix_permille * (SELECT sum(tokens) FROM t)",
    }
