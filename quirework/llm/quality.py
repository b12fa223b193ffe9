"""Problem 10: statistics of words, characters and lines per document, and the tails of their distributions.

Each document is read once, as a whole. Every statistic has a mergeable quantile sketch (KLL) per language label;
merging them gives the sketch of all documents. A value becomes a robust z-score, its distance from the median in
units of the interquartile range.

Kinds are told by the sketches. For each share that makes a kind, documents in its tail (robust z-score of ``tail`` or
more within their language or among all, as measured from documents of which the share holds no majority) get a sketch
of their own. Its emptiest stretch on the side of the majority parts the documents that are of the kind from those
that merely lie far out, and the middle of that stretch is the limit. Junk is told first, then tables among the rest,
then lists. No limit is given beforehand but the majority, by which the kinds are defined.

Null and blank texts have statistics of 0 and no kind. Labels are taken as stored; null labels form a group. Ties
share a score. Repeated rows are documents of their own. An empty table gives no rows, and without a tail there is
no kind. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.llm import textkind as K
from quirework.runtime import save, small

STATS = ["n_words", "mean_word_length", "word_like_share", "symbol_share", "common_share", "n_lines", "entry_share", "row_share", "ended_share", "marked_share"]
#: The shares that make a kind, with the side of the majority, in the order in which they are judged.
KINDS = {"junk": ("word_like_share", -1), "table": ("row_share", 1), "list": ("entry_share", 1)}
HALF = 0.5
#: Smallest unit of a z-score of a share, where most values are equal.
LEAST_SCALE = 0.03
#: Steps of a share at which a sketch is asked, the width of the stretch that must be empty, and how far from the
#: emptiest one a stretch may be (the error of the sketch in rank).
STEPS, STRETCH, RANK_ERROR = 100, 15, 0.002
LEXICON_LIMIT = 1_000_000


def measure(text: str | None, common: frozenset[str]) -> tuple:
    """The values of ``STATS`` for one text."""
    if text is None or not text or text.isspace():
        return (0, 0.0, 0.0, 0.0, 0.0, 0, 0.0, 0.0, 0.0, 0.0)
    t = K.plain(text)
    words = K.WORD.findall(t)
    visible = K.visible_chars(t)
    n, letters = len(words), sum(map(len, words))
    known = sum(map(common.__contains__, K.WORD.findall(t.lower()))) if n else 0
    lines, entries, rows, ended, marked = K.line_shares(t)
    return (n, letters / n if n else 0.0, K.word_like_share(words, visible), 1 - letters / visible, known / n if n else 0.0, lines, entries, rows, ended, marked)


def statistics(docs: DataFrame, doc_id: str, text: str, lang: str, lexicon: DataFrame) -> DataFrame:
    """``doc_id, lang`` and the columns of ``STATS``."""
    words = lexicon.where("is_common and word is not null").select("word").distinct().limit(LEXICON_LIMIT + 1).collect()
    if len(words) > LEXICON_LIMIT:
        raise ValueError(f"at most {LEXICON_LIMIT} common words")
    common = frozenset(r[0] for r in words)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = pd.DataFrame([measure(t, common) for t in f["text"]], columns=STATS)
            out.insert(0, "doc_id", f["doc_id"].to_numpy())
            out.insert(1, "lang", f["lang"].to_numpy())
            yield out

    kinds = ", ".join(f"{s} {'long' if s.startswith('n_') else 'double'}" for s in STATS)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    # nulls would turn long ids into doubles in pandas
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("string"))
    return rows.mapInPandas(run, f"doc_id string, lang string, {kinds}").withColumn("doc_id", F.col("doc_id").cast("long"))


def sketches(stats: DataFrame, names: list[str] = STATS, size: int = 400) -> DataFrame:
    """Mergeable sketches per language: ``lang, n``, and one binary column per statistic, null without values."""
    return stats.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), *(F.when(F.count(s) > 0, F.kll_sketch_agg_double(F.col(s).cast("double"), F.lit(size))).alias(s) for s in names))


def merge(parts: DataFrame, keys: list[str], names: list[str] = STATS) -> DataFrame:
    """Sketches of several languages, days or parts as one per ``keys``; without keys all as one, no row of no parts."""
    whole = F.lit(0).alias("_whole")
    m = parts.groupBy(*(keys or [whole])).agg(F.sum("n").alias("n"), *(F.when(F.count(s) > 0, F.kll_merge_agg_double(s)).alias(s) for s in names))
    return m.drop("_whole")


def limits(sk: DataFrame, prefix: str, stats: list[str]) -> list[Column]:
    """Median and robust scale of each statistic as columns ``<prefix><stat>_mid`` and ``_scale``."""
    out = []
    for s in stats:
        q = [F.kll_sketch_get_quantile_double(F.col(s), F.lit(p)) for p in (0.25, 0.5, 0.75)]
        least = F.lit(1.0 if s.startswith("n_") or s == "mean_word_length" else LEAST_SCALE)
        out += [q[1].alias(f"{prefix}{s}_mid"), F.greatest((q[2] - q[0]) / 1.349, least).alias(f"{prefix}{s}_scale")]
    return out


def _joined(stats: DataFrame, parts: DataFrame, names: list[str]) -> DataFrame:
    """``stats`` with the limits of their language (``_o_``) and the pooled ones (``_a_``)."""
    own = parts.select(F.col("lang").alias("_lang"), *limits(parts, "_o_", names))
    # one row: the pooled limits become literals
    every = merge(parts, [], names).select(*limits(parts, "_a_", names)).first()
    pooled = every.asDict() if every else {}
    j = stats.join(small(own), F.col("lang").eqNullSafe(F.col("_lang")), "left").drop("_lang")
    return j.withColumns({c: F.lit(pooled.get(c)).cast("double") for c in (f"_a_{s}_{k}" for s in names for k in ("mid", "scale"))})


def emptiest(ranks: list[float], side: int) -> float:
    """Middle of the emptiest stretch of a share, on the side of ``HALF`` where the majority is.

    ranks: the part of the values at or below 0, 1/``STEPS``, ... 1. Of several stretches as empty as the sketch can
    tell, the longest run of them counts.
    """
    first, last = (STEPS // 2, STEPS - STRETCH) if side > 0 else (0, STEPS // 2 - STRETCH)
    mass = [ranks[i + STRETCH] - ranks[i] for i in range(first, last + 1)]
    best, run = (0, 0, 0), 0
    for i, m in enumerate([*mass, float("inf")]):
        if m <= min(mass) + RANK_ERROR:
            run += 1
        else:
            best, run = max(best, (run, i - run, i - 1), key=lambda b: b[0]), 0
    return (2 * first + best[1] + best[2] + STRETCH) / 2 / STEPS


def _ref(share: str) -> str:
    return f"{share}_ref"


def tail_limit(joined: DataFrame, share: str, side: int, tail: float) -> float | None:
    """The limit of a share by the sketch of the documents in its tail; None without a tail.

    joined: documents with the limits of ``_ref(share)``, the documents without a majority. The unit of the tail is small
    enough for every majority to lie in it, however far the others spread.
    """

    def of(p: str) -> Column:
        mid = F.col(f"{p}{_ref(share)}_mid")
        unit = F.least(F.col(f"{p}{_ref(share)}_scale"), F.abs(F.lit(HALF) - mid) / tail)
        return F.coalesce((F.col(share) - mid) * side >= unit * tail, F.lit(False))

    alone = F.coalesce(f"_o_{_ref(share)}_mid", f"_a_{_ref(share)}_mid").isNull()  # there are majorities only
    far = joined.where(of("_o_") | of("_a_") | alone).agg(F.kll_sketch_agg_double(F.col(share), F.lit(2000)).alias("s"), F.count(F.lit(1)).alias("n"))
    grid = F.array(*(F.lit(i / STEPS) for i in range(STEPS + 1)))
    r = far.where("n > 0").select(F.kll_sketch_get_rank_double("s", grid).alias("r")).first()
    return emptiest(r["r"], side) if r else None


def scored(stats: DataFrame, tail: float = 3.0) -> DataFrame:
    """``stats`` with ``<stat>_z`` (within the language), and ``kind``."""
    some = F.col("n_lines") > 0
    refs = {_ref(share): F.when(some & (F.col(share) * side <= HALF * side), F.col(share)) for share, side in KINDS.values()}
    seen = stats.withColumns({s: F.when(some, F.col(s)) for s in STATS} | refs)
    names = [*STATS, *refs]
    j = _joined(stats, save(sketches(seen, names)).df, names)
    kind, left = F.lit(None).cast("string"), j.where(some)
    for name, (share, side) in KINDS.items():
        limit = tail_limit(left, share, side, tail)
        is_kind = F.lit(False) if limit is None else (F.col(share) * side > limit * side) & (F.col("n_lines") > (1 if name == "list" else 0))
        kind, left = F.coalesce(kind, F.when(is_kind, name)), left.where(~is_kind)
    z = [((F.col(s) - F.col(f"_o_{s}_mid")) / F.col(f"_o_{s}_scale")).alias(f"{s}_z") for s in STATS]
    return j.select("doc_id", "lang", *STATS, *z, kind.alias("kind"))
