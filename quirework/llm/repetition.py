"""Problem 2: repetition inside one document.

For every text the share of words in runs of five or more that occurred before in it is measured, with some more
statistics of repetition. Letter case, punctuation and line breaks do not count, and look-alike letters are one.

Texts are judged by a learned decision list alone. Sequential covering grows a conjunction of thresholds on the
statistics from two thirds of the labelled rows (by information gain), prunes it on the other third, keeps it if it
is precise enough, removes what it covers and goes on; the rules come out as one ordered CASE expression that Spark
evaluates. The list never sees the share that labels its rows, only the ``FEATURES`` beside it, and no test of that
share follows it. Labelled are at most about ``train_rows`` records in which some run comes again, drawn by a hash of
their ids.

Null and blank texts have no words and a share of 0. Texts of under five words have a share of 0. Lines of a page
that come again count once. An empty table gives no rows. Whole texts are read, however long. Pages of more than
``MAX_PAGE_LINES`` lines are measured by shuffled word runs instead of in one task, with the same values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.llm import textkind as K
from quirework.operators.components import spread_rank
from quirework.runtime import save, small

RUN = 5
LIMIT = 0.30
MAX_PAGE_LINES = 50_000
#: Words of a huge page that are looked at together.
CHUNK = 10_000
#: Runs shorter and longer than ``RUN`` whose shares the list may use.
SHORT, LONG = 3, 8
STATS = ["repeated_share", "short_share", "long_share", "new_word_share", "top_run_share", "same_line_share", "new_run_share"]
FEATURES = STATS[1:]
NOTHING = (0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 1.0)


def _ids(text: str) -> np.ndarray:
    return np.fromiter(map(hash, K.WORD.findall(K.readable(text).lower())), dtype=np.int64)


def _runs(ids: np.ndarray, length: int = RUN) -> np.ndarray:
    """One number for each run of ``length`` words."""
    h = np.zeros(len(ids) - length + 1, dtype=np.uint64)
    u = ids.astype(np.uint64)
    for k in range(length):
        h = h * np.uint64(0x9E3779B97F4A7C15) + (u[k : k + len(h)] ^ (u[k : k + len(h)] >> np.uint64(29)))
    return h


def _covered(ids: np.ndarray, length: int) -> tuple[float, float, float]:
    """Of runs of ``length`` words: the share of words in runs met before, of different runs, of the most frequent run."""
    n = len(ids)
    if n < length:
        return 0.0, 1.0, 0.0
    runs = _runs(ids, length)
    _, first, back, count = np.unique(runs, return_index=True, return_inverse=True, return_counts=True)
    if len(first) == len(runs):
        return 0.0, 1.0, 1 / len(runs)
    again = np.flatnonzero(first[back] < np.arange(len(runs)))
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + length, -1)
    return float(np.count_nonzero(np.cumsum(edge[:n]))) / n, len(first) / len(runs), float(count.max()) / len(runs)


def measure(text: str | None) -> tuple:
    """Words, and the values of ``STATS``."""
    if not text or text.isspace():
        return (0, *NOTHING)
    ids = _ids(text)
    n = len(ids)
    if n < RUN:
        return (n, *NOTHING)
    new_words = len(set(ids.tolist())) / n
    short, _, _ = _covered(ids, SHORT)
    repeated, new, top = _covered(ids, RUN) if short else (0.0, 1.0, 1 / (n - RUN + 1))
    if repeated == 0.0:
        return n, 0.0, short, 0.0, new_words, top, 0.0, 1.0
    lines = [x for x in (x.strip().lower() for x in text.split("\n")) if x]
    return n, repeated, short, _covered(ids, LONG)[0], new_words, top, 1 - len(set(lines)) / max(len(lines), 1), new


def label(text: str | None) -> bool:
    """By the definition, without hashing: extend every earlier occurrence of a run and mark its words."""
    words = K.WORD.findall(K.readable(text or "").lower())
    n, seen, marked = len(words), {}, 0
    end = 0
    for i in range(n - RUN + 1):
        run = tuple(words[i : i + RUN])
        if run in seen:
            marked += i + RUN - max(end, i)
            end = i + RUN
        else:
            seen[run] = i
    return n > 0 and marked / n >= LIMIT


def _measured(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        out = pd.DataFrame([measure(t) for t in f["text"]], columns=["n_words", *STATS])
        out.insert(0, "record_kind", f["record_kind"].to_numpy())
        out.insert(1, "record_id", f["record_id"].to_numpy())
        # only texts near a repeated share need to be told from junk
        out["junk"] = [s >= 0.1 and K.is_junk(t) for s, t in zip(out["repeated_share"], f["text"], strict=True)]
        yield out


_SCHEMA = "record_kind string, record_id long, n_words long, " + ", ".join(f"{s} double" for s in STATS) + ", junk boolean"


def statistics(records: DataFrame) -> DataFrame:
    """records: ``record_kind, record_id, text``. Adds ``n_words``, ``STATS`` and ``junk``, without the text."""
    return records.select("record_kind", F.col("record_id").cast("long").alias("record_id"), "text").where("record_id is not null").mapInPandas(_measured, _SCHEMA)


def page_texts(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Texts of pages from their distinct lines in order, and the lines of pages too large for one task.

    lines: ``page_id, region_pos, line_pos, line_id, text``.
    """
    size = lines.where("page_id is not null").groupBy("page_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > MAX_PAGE_LINES)
    huge = save(size.select("page_id")).df  # a page of so many lines is rare, so this table is tiny or empty
    ordinary = lines.where("page_id is not null").join(small(huge), "page_id", "left_anti")
    line = F.struct("region_pos", "line_pos", "line_id", "text")
    pages = ordinary.groupBy("page_id").agg(F.sort_array(F.collect_set(line)).alias("_l"))
    text = F.concat_ws("\n", F.transform("_l", lambda x: x["text"]))
    return pages.select("page_id", text.alias("text")), lines.join(small(huge), "page_id", "left_semi")


def _line_scripts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        out = pd.DataFrame([K.script_counts(t) for t in f["text"]], columns=["_surely", "_chars", "_alike", "_latin"])
        out.insert(0, "page_id", f["page_id"].to_numpy())
        yield out


def _line_words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each line its words, its lines with content (as ``measure`` compares them), and what ``is_junk`` adds up."""
    for f in frames:
        rows = []
        for p, at, t, *of in zip(f["page_id"], f["_rank"], f["text"], f["_alike"], f["_cyrillic"], f["_latin"], strict=True):
            words = K.WORD.findall(K.readable(t, K.Scripts(*map(bool, of))).lower())
            plain = K.plain(t)
            like, visible = K.word_like_share(K.WORD.findall(plain), 1), K.visible_chars(plain)
            rows.append((p, at, words, [x for x in (x.strip().lower() for x in t.split("\n")) if x], int(like), visible))
        yield pd.DataFrame(rows, columns=["page_id", "_rank", "_w", "_lines", "_like", "_visible"])


def _with_neighbours(df: DataFrame, side: int, length: int) -> DataFrame:
    """``df`` in chunks ``_chunk`` of ``CHUNK`` words, each with the ``length`` words that follow it (``side`` 1) or precede it (-1).

    Rows of a chunk of their own have ``_own`` equal to ``_chunk``; the others are there to be looked at.
    """
    own = F.floor(F.col("_pos") / CHUNK)
    at = F.col("_pos") % CHUNK
    edge = at < length if side > 0 else at >= CHUNK - length
    both = F.when(edge, F.array(own, own - side)).otherwise(F.array(own))
    return df.withColumn("_own", own).withColumn("_chunk", F.explode(both))


def huge_statistics(lines: DataFrame) -> DataFrame:
    """What ``statistics`` gives for pages, by shuffles alone, whatever their size: ``record_kind, record_id, n_words, STATS, junk``.

    Lines are ranked by ranges and read one by one, with the scripts of their whole page; words get a position from the
    words before their line, counted by blocks of lines; runs are made in chunks of words that see the next chunk's
    first ones, and are compared by page and hash. No task holds a page.
    """
    order = ["region_pos", "line_pos", "line_id", "text"]
    distinct = lines.select("page_id", *order).distinct()
    one = save(spread_rank(distinct, ["page_id"], [F.col(c) for c in order], "_rank")).df
    full = one.where("text is not null")
    counts = full.select("page_id", "text").mapInPandas(_line_scripts, "page_id long, _surely long, _chars long, _alike boolean, _latin boolean")
    cyrillic = F.sum("_surely") * 5 > F.sum("_chars") + F.count(F.lit(1)) - 1  # with the line feeds between the lines
    scripts = counts.groupBy("page_id").agg(F.max("_alike").alias("_alike"), cyrillic.alias("_cyrillic"), F.max("_latin").alias("_latin"))
    read = full.select("page_id", "_rank", "text").join(small(save(scripts).df), "page_id")
    words = save(read.mapInPandas(_line_words, "page_id long, _rank long, _w array<string>, _lines array<string>, _like long, _visible long")).df

    sized = words.select("page_id", "_rank", "_w", F.floor(F.col("_rank") / CHUNK).alias("_block"))
    blocks = sized.groupBy("page_id", "_block").agg(F.sum(F.size("_w")).alias("_k"))  # a row for each so many lines
    blocks = blocks.withColumn("_before", F.sum("_k").over(Window.partitionBy("page_id").orderBy("_block")) - F.col("_k")).drop("_k")
    inside = F.sum(F.size("_w")).over(Window.partitionBy("page_id", "_block").orderBy("_rank")) - F.size("_w")
    w = sized.withColumn("_in", inside).join(blocks, ["page_id", "_block"])
    w = w.select("page_id", (F.col("_before") + F.col("_in")).alias("_at"), F.posexplode("_w").alias("_p", "_word"))
    w = w.select("page_id", (F.col("_at") + F.col("_p")).alias("_pos"), F.xxhash64("_word").alias("_h"))
    by_pos = Window.partitionBy("page_id", "_chunk").orderBy("_pos")

    def run_of(length: int) -> Column:
        return F.when(F.lead("_h", length - 1).over(by_pos).isNotNull(), F.xxhash64(*(F.lead("_h", k).over(by_pos) for k in range(length))))

    ahead = _with_neighbours(w, 1, LONG - 1).withColumns({f"_run{k}": run_of(k) for k in (SHORT, RUN, LONG)})
    runs = save(ahead.where("_chunk = _own").drop("_chunk", "_own")).df

    def hits(length: int) -> DataFrame:
        """Per page its words and those in runs met before."""
        run = f"_run{length}"
        mine = runs.select("page_id", "_pos", run)
        first = mine.where(F.col(run).isNotNull()).groupBy("page_id", run).agg(F.min("_pos").alias("_first"))
        again = mine.join(first, ["page_id", run], "left").withColumn("_again", F.coalesce((F.col("_first") < F.col("_pos")).cast("int"), F.lit(0)))
        near = _with_neighbours(again.select("page_id", "_pos", "_again"), -1, length - 1)
        hit = near.withColumn("_hit", F.max("_again").over(by_pos.rowsBetween(-(length - 1), 0))).where("_chunk = _own")
        return hit.groupBy("page_id").agg(F.count(F.lit(1)).alias(f"_n{length}"), F.sum("_hit").alias(f"_hits{length}"))

    kinds = runs.groupBy("page_id", "_h").agg(F.lit(1)).groupBy("page_id").agg(F.count(F.lit(1)).alias("_words"))
    per_run = runs.where(F.col(f"_run{RUN}").isNotNull()).groupBy("page_id", f"_run{RUN}").agg(F.count(F.lit(1)).alias("_k"))
    per_run = per_run.groupBy("page_id").agg(F.sum("_k").alias("_runs"), F.max("_k").alias("_top"), F.count(F.lit(1)).alias("_new_runs"))
    per_line = words.select("page_id", F.explode("_lines").alias("_line")).groupBy("page_id", "_line").agg(F.count(F.lit(1)).alias("_k"))
    per_line = per_line.groupBy("page_id").agg(F.sum("_k").alias("_lines"), F.count(F.lit(1)).alias("_new_lines"))
    chars = words.groupBy("page_id").agg(F.sum("_like").alias("_like"), F.sum("_visible").alias("_visible"))
    per = one.select("page_id").distinct()
    for part in (*map(hits, (SHORT, RUN, LONG)), kinds, per_run, per_line, chars):  # one row per page
        per = per.join(part, "page_id", "left")

    n = F.coalesce(f"_n{RUN}", F.lit(0))
    some = n >= RUN
    share_of = lambda k: F.when(some, F.col(f"_hits{k}") / F.col(f"_n{k}")).otherwise(0.0)
    share = share_of(RUN)
    junk = F.when(F.col("_visible") > 0, F.col("_like") / F.col("_visible")).otherwise(0.0) < K.JUNK_BELOW
    return per.select(
        F.lit("page").alias("record_kind"), F.col("page_id").cast("long").alias("record_id"), n.cast("long").alias("n_words"), share.alias("repeated_share"),
        share_of(SHORT).alias("short_share"), share_of(LONG).alias("long_share"),
        F.when(some, F.col("_words") / F.col(f"_n{RUN}")).otherwise(1.0).alias("new_word_share"), F.when(some, F.col("_top") / F.col("_runs")).otherwise(0.0).alias("top_run_share"),
        F.when(share > 0, 1 - F.col("_new_lines") / F.col("_lines")).otherwise(0.0).alias("same_line_share"),
        F.when(some, F.col("_new_runs") / F.col("_runs")).otherwise(1.0).alias("new_run_share"), ((share >= 0.1) & junk).alias("junk"),
    )


# The decision list

Rule = list[tuple[str, str, float]]


def _holds(x: np.ndarray, names: list[str], rule: Rule) -> np.ndarray:
    ok = np.ones(len(x), dtype=bool)
    for name, op, limit in rule:
        c = x[:, names.index(name)]
        ok &= (c >= limit) if op == ">=" else (c <= limit)
    return ok


def _grow(x: np.ndarray, y: np.ndarray, names: list[str], depth: int) -> Rule:
    rule: Rule = []
    inside = np.ones(len(x), dtype=bool)
    while len(rule) < depth and y[inside].any() and not y[inside].all():
        p, n = int(y[inside].sum()), int(inside.sum())
        best = (1e-9, None)
        for j, name in enumerate(names):
            c, t = x[inside, j], y[inside]
            order = np.argsort(c, kind="stable")
            c, t = c[order], t[order].astype(np.int64)
            cut = np.flatnonzero(c[1:] > c[:-1]) + 1
            if not len(cut):
                continue
            below = np.cumsum(t)[cut - 1]
            for op, pos, tot in (("<=", below, cut), (">=", p - below, n - cut)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(pos > 0, pos * (np.log2(pos / tot) - np.log2(p / n)), -1.0)
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (float(gain[k]), (name, op, float((c[cut[k] - 1] + c[cut[k]]) / 2)))
        if best[1] is None:
            break
        rule.append(best[1])
        inside = _holds(x, names, rule)
    return rule


def learn(x: np.ndarray, y: np.ndarray, names: list[str], depth: int = 3, most: int = 8, precise: float = 0.9, seed: int = 0) -> list[Rule]:
    """Ordered rules for the positive class by sequential covering with reduced-error pruning."""
    fold = np.random.default_rng(seed).random(len(x)) < 2 / 3
    rules: list[Rule] = []
    left = np.ones(len(x), dtype=bool)
    while len(rules) < most and (left & y).any():
        rule = _grow(x[left & fold], y[left & fold], names, depth) if (left & fold & y).any() else []
        if not rule:
            break
        held = left & ~fold

        def worth(r: Rule, held: np.ndarray = held) -> float:
            ok = _holds(x[held], names, r)
            return (float(y[held][ok].sum()) - float((~y[held][ok]).sum())) / max(int(ok.sum()), 1)

        while len(rule) > 1 and held.any() and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        covered = left & _holds(x, names, rule)
        if not covered.any() or y[covered].mean() < precise:
            break
        rules.append(rule)
        left &= ~covered
    return rules


def as_case(rules: list[Rule]) -> Column:
    """The list as one ordered CASE expression: true by the first rule that holds, else false."""
    out = None
    for rule in rules:
        test = F.lit(True)
        for name, op, limit in rule:
            test = test & ((F.col(name) >= limit) if op == ">=" else (F.col(name) <= limit))
        out = F.when(test, F.lit(True)) if out is None else out.when(test, F.lit(True))
    return F.lit(False) if out is None else out.otherwise(F.lit(False))


def fit(sample: pd.DataFrame) -> list[Rule]:
    """Rules over ``FEATURES`` from rows of statistics labelled by their share; a rule of always or never without both labels."""
    y = sample["repeated_share"].to_numpy(dtype=float) >= LIMIT
    if not y.any() or y.all():
        return [[(FEATURES[0], ">=", 0.0 if len(y) and y.all() else 2.0), ("new_run_share", "<=", 1 - 1e-12)]]
    x = sample[FEATURES].to_numpy(dtype=float)
    return learn(x, y, FEATURES) or [_grow(x, y, FEATURES, 3)]  # few rows: one rule from all of them, not pruned


def judged(stats: DataFrame, train_rows: int = 3000) -> DataFrame:
    """``stats`` with ``is_repeated`` by a list learned from a sample of them: rows of no junk in which some run comes again."""
    kept = save(stats).df
    pool = kept.where("new_run_share < 1 and not junk")
    share = min(1.0, train_rows / max(pool.count(), 1))
    sample = pool.where(F.pmod(F.xxhash64("record_kind", "record_id"), F.lit(1_000_000)) < int(share * 1_000_000) + 1)
    return kept.withColumn("is_repeated", as_case(fit(sample.select(*STATS).orderBy(*STATS).toPandas())))


def repeated(records: DataFrame, more: DataFrame | None = None, train_rows: int = 3000) -> DataFrame:
    """Statistics of all records with ``is_repeated`` by the learned list. ``more``: statistics measured elsewhere."""
    stats = statistics(records)
    return judged(stats if more is None else stats.unionByName(more), train_rows)
