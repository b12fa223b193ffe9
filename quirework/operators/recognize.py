"""Script classification and text recognition as pluggable functions, with routing, fallback and failure isolation.

A recognizer or classifier is a factory: called once per Python worker and task, it returns a function from a list of
inputs to a list of results. A failing batch is tried line by line; a failing line gets a placeholder, so no line is
ever lost and no job fails for one image.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Model = Callable[[], Callable[[list], list]]
LABELS = ("cyrillic", "latin")


def argmax_label(logits: Column, labels: tuple[str, ...] = LABELS) -> Column:
    """Struct ``label, confidence``: the class of the greatest logit (the first of equal ones) and its soft-max share."""
    most = F.array_max(logits)
    total = F.aggregate(logits, F.lit(0.0), lambda a, x: a + F.exp(x - most))
    at = F.array_position(logits, most).cast("int")
    return F.struct(F.element_at(F.array(*map(F.lit, labels)), at).alias("label"), (F.lit(1.0) / total).alias("confidence"))


def sequence_score(log_probs: Column, tokens: Column, eos: Column) -> Column:
    """Geometric mean of token probabilities up to and with the first end token; the tokens after it do not count."""
    stop = F.array_position(tokens, eos)
    used = F.when(stop > 0, F.slice(log_probs, F.lit(1), stop.cast("int"))).otherwise(log_probs)
    return F.exp(F.aggregate(used, F.lit(0.0), lambda a, x: a + x) / F.greatest(F.size(used), F.lit(1)))


def fallback_labels(df: DataFrame, group: str, idx: str, label: str, confidence: str, default: str | None = "latin") -> DataFrame:
    """Failed lines (null label) get their group's most frequent label, of equal ones the one seen first, else ``default``.

    Columns become ``predicted_label, confidence`` (null where failed), ``fallback``. Counts are pre-aggregated by
    label; the result is one row per group, joined back. Without ``default`` a group of failures keeps null labels.
    """
    n = df.where(F.col(label).isNotNull()).groupBy(group, label).agg(F.count(F.lit(1)).alias("_n"), F.min(idx).alias("_first"))
    best = n.groupBy(group).agg(F.min_by(label, F.struct(-F.col("_n"), F.col("_first"))).alias("_best"))
    j = df.join(best, group, "left")
    failed = F.col(label).isNull()
    return j.select(
        *[c for c in df.columns if c not in (label, confidence)],
        F.coalesce(label, "_best", F.lit(default)).alias("predicted_label"),
        F.when(failed, None).otherwise(F.col(confidence)).alias("confidence"),
        failed.alias("fallback"),
    )


def group_by_label(df: DataFrame, group: str, idx: str, label: str) -> DataFrame:
    """``group, label, n, first``: the lines of each label, with the rank of its first appearance as ``label_pos``."""
    g = df.groupBy(group, label).agg(F.count(F.lit(1)).alias("n"), F.min(idx).alias("first"))
    return g.withColumn("label_pos", F.row_number().over(Window.partitionBy(group).orderBy("first")) - 1)


def skip_classification(df: DataFrame, label: str) -> DataFrame:
    """With one recognizer no classifier runs: its label for every line, ``classified`` false."""
    return df.withColumns({"predicted_label": F.lit(label), "confidence": F.lit(None).cast("double"), "fallback": F.lit(False), "classified": F.lit(False)})


def attach_script(df: DataFrame) -> DataFrame:
    """``script, script_conf`` from the prediction where classification really ran."""
    ran = F.col("classified")
    return df.withColumns({"script": F.when(ran, F.col("predicted_label")), "script_conf": F.when(ran, F.col("confidence"))})


def used_models(df: DataFrame, group: str, idx: str, label: str, names: dict[str, str]) -> DataFrame:
    """``group, model_name``: names of the models used, in the order in which their labels first appear."""
    first = df.groupBy(group, label).agg(F.min(idx).alias("_first"))
    name = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))[F.col(label)]
    # one entry per label, so the list is as short as ``names``
    listed = first.groupBy(group).agg(F.sort_array(F.collect_list(F.struct("_first", name.alias("n")))).alias("_l"))
    return listed.select(group, F.array_join(F.transform("_l", lambda x: x["n"]), " and ").alias("model_name"))


def recognition_type(latin: Column, cyrillic: Column) -> Column:
    """Type of the recognizers used on a page, from each script's type (null: no line of it).

    Fixed values: NONE; a single type as it is; the combined types of latin TrOCR or PP-OCR with cyrillic TrOCR. A
    cyrillic recognizer other than TrOCR raises an error.
    """
    both = F.when(latin == "TROCR", "LATIN_TROCR_AND_CYRILLIC_TROCR").when(latin == "PPOCRV6_MEDIUM_REC", "LATIN_PPOCRV6_AND_CYRILLIC_TROCR")
    return (
        F.when(latin.isNull() & cyrillic.isNull(), F.lit("NONE"))
        .when(cyrillic.isNotNull() & (cyrillic != "TROCR"), F.raise_error(F.lit("a cyrillic recognizer must be TROCR")))
        .when(latin.isNull(), cyrillic)
        .when(cyrillic.isNull(), latin)
        .otherwise(F.coalesce(both, F.raise_error(F.lit("unknown latin recognizer"))))
    )


def guarded(model: Callable[[list], list], inputs: list, size: int, attempts: int = 1) -> list[tuple]:
    """(result, error) per input: batches of ``size``, up to ``attempts`` tries each, then one by one."""
    out: list[tuple] = []
    for i in range(0, len(inputs), size):
        part = inputs[i : i + size]
        for _ in range(max(attempts, 1)):
            try:
                got = list(model(part))
                if len(got) != len(part):
                    raise ValueError(f"{len(got)} results for {len(part)} lines")
                out += [(g, None) for g in got]
                break
            except Exception:  # noqa: S112
                continue
        else:
            for x in part:
                try:
                    out.append((list(model([x]))[0], None))
                except Exception as e:
                    out.append((None, f"{type(e).__name__}: {e}"))
    return out


def classify(lines: DataFrame, column: str, model: Model, batch: int = 32) -> DataFrame:
    """Adds ``label, confidence, error``; a failed line has null label and confidence. Results are (label, confidence)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        infer = model()
        for f in frames:
            got = guarded(infer, list(f[column]), batch)
            yield f.assign(label=[g[0] if g else None for g, _ in got], confidence=[g[1] if g else None for g, _ in got], error=[e for _, e in got])

    return lines.mapInPandas(run, _with(lines, "label string, confidence double, error string"))


def recognize(lines: DataFrame, column: str, models: dict[str, Model], batch: int = 8, attempts: int = 1, strict: bool = False) -> DataFrame:
    """Adds ``text, text_conf, error`` by the recognizer of each line's ``predicted_label``; results are (text, score).

    Lines stay in their partition; each Arrow batch is split by label. A label without recognizer is an error of its
    lines, or with ``strict`` of the whole run. A line that cannot be read has text '' and score 0; null inputs are such lines.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ready: dict[str, Callable] = {}
        for f in frames:
            text, conf, error = [""] * len(f), [0.0] * len(f), [None] * len(f)
            for label, at in f.reset_index(drop=True).groupby("predicted_label", dropna=False, sort=False).indices.items():
                if label not in models:
                    if strict:
                        raise ValueError(f"no recognizer for {label!r}, only for {sorted(models)}")
                    for i in at:
                        error[i] = f"no recognizer for {label}"
                    continue
                if label not in ready:
                    ready[label] = models[label]()
                whole = [int(i) for i in at if f[column].iloc[i] is not None]
                for i, (g, e) in zip(whole, guarded(ready[label], [f[column].iloc[i] for i in whole], batch, attempts), strict=True):
                    error[i] = e
                    if g is not None:
                        text[i], conf[i] = g
            yield f.assign(text=text, text_conf=conf, error=error)

    return lines.mapInPandas(run, _with(lines, "text string, text_conf double, error string"))


def _with(df: DataFrame, more: str) -> str:
    names = {c.strip().split(" ")[0] for c in more.split(",")}
    return ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name not in names] + [more])


def unmatched(lines: DataFrame, predictions: DataFrame, keys: list[str]) -> DataFrame:
    """Lines without prediction and predictions without line, with ``side``; empty if results are complete."""
    a = lines.select(*keys).exceptAll(predictions.select(*keys)).withColumn("side", F.lit("no result"))
    return a.unionByName(predictions.select(*keys).exceptAll(lines.select(*keys)).withColumn("side", F.lit("no line")))
