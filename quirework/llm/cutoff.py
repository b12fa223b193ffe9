"""Problem 6: a score cutoff per group that keeps a target fraction, by distributed quickselect.

Each round every partition gives its median of the values still in play per group, the weighted median of these
medians becomes the group's pivot, and counts above and at it discard one side: the group's window of values shrinks.
A group leaves when its pivot is the cutoff, or once at most ``finish`` records are in its window, whose exact order
isolates the rank. Only medians and counts are shuffled, a row per group and task; the values are written once without
a shuffle, and again when the windows hold less than two thirds of what was written. The counts give the number kept.

Null, NaN and infinite scores are no records here; rows with a null group key or a source without target give none.
Ties at the cutoff are all kept (score >= cutoff). A target of 0 percent keeps the best score and its ties.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirework.llm.radix import finite
from quirework.runtime import save, small


def quickselect(values: DataFrame, keys: Sequence[str], ranks: DataFrame, finish: int = 4096) -> DataFrame:
    """The value at a rank from the top per group, and how many records have it or more: ``keys, _v, kept``.

    values: ``keys, _v``. ranks: ``keys, _rank`` (from 1, at most the group's records). Keys must not be null. ``finish``
    bounds the records of a group that are sorted in one task.
    """
    keys = list(keys)
    # a window is open at both ends; _base counts the records above it
    start = ranks.select(*keys, F.col("_rank").cast("long").alias("_rank"), *(F.lit(None).cast("double").alias(c) for c in ("_lo", "_hi")), F.lit(0).cast("long").alias("_base"))
    state, live, written, size = save(start), values, None, 0
    done: DataFrame | None = None
    while True:
        inside = (F.col("_lo").isNull() | (F.col("_v") > F.col("_lo"))) & (F.col("_hi").isNull() | (F.col("_v") < F.col("_hi")))
        play = live.join(small(state.df), keys).where(inside)
        medians = play.groupBy(*keys, F.spark_partition_id().alias("_part")).agg(F.percentile_approx("_v", 0.5, 100).alias("_med"), F.count(F.lit(1)).alias("_w"))
        pivots = save(medians.groupBy(*keys).agg(F.expr("percentile(_med, 0.5D, _w)").alias("_pivot"), F.sum("_w").alias("_m")))
        n = pivots.df.agg(F.sum("_m"), F.count_if(F.col("_m") > finish), F.count_if(F.col("_m") <= finish)).first()
        found = []
        if n[2]:
            ready = play.join(small(pivots.df.where(F.col("_m") <= finish).select(*keys)), keys)
            w = Window.partitionBy(*keys).orderBy(F.desc("_v"))
            order = ready.withColumns({"_row": F.row_number().over(w), "_upto": F.count(F.lit(1)).over(w)})  # ties share _upto
            found.append(order.where(F.col("_row") == F.col("_rank") - F.col("_base")).select(*keys, "_v", (F.col("_base") + F.col("_upto")).alias("kept")))
        split = None
        if n[1]:
            rest = play.join(small(pivots.df.where(F.col("_m") > finish).select(*keys, "_pivot")), keys)
            split = save(
                rest.groupBy(*keys, "_rank", "_lo", "_hi", "_base", "_pivot").agg(
                    F.count_if(F.col("_v") > F.col("_pivot")).alias("_above"), F.count_if(F.col("_v") >= F.col("_pivot")).alias("_upto")
                )
            )
            need = F.col("_rank") - F.col("_base")
            up, down = need <= F.col("_above"), need > F.col("_upto")
            found.append(split.df.where(~up & ~down).select(*keys, F.col("_pivot").alias("_v"), (F.col("_base") + F.col("_upto")).alias("kept")))
        for f in found:
            got = save(f).df
            done = got if done is None else done.unionByName(got)
        if split is None:
            state.drop()
            pivots.drop()
            break
        lo, hi = F.when(up, F.col("_pivot")).otherwise(F.col("_lo")), F.when(down, F.col("_pivot")).otherwise(F.col("_hi"))
        nxt = save(split.df.where(up | down).select(*keys, "_rank", lo.alias("_lo"), hi.alias("_hi"), (F.col("_base") + F.when(down, F.col("_upto")).otherwise(0)).alias("_base")))
        if size and 3 * n[0] < 2 * size:
            less = save(play.join(small(nxt.df.select(*keys)), keys, "left_semi").select(*keys, "_v"))
            if written is not None:
                written.drop()
            live, written = less.df, less
        if not size or 3 * n[0] < 2 * size:
            size = n[0]
        for t in (state, pivots, split):
            t.drop()
        state = nxt
    if written is not None:
        written.drop()
    return values.select(*keys, "_v", F.lit(0).cast("long").alias("kept")).limit(0) if done is None else done


def keep_cutoffs(df: DataFrame, keys: Sequence[str], score: str, targets: DataFrame, target_keys: Sequence[str], pct: str, finish: int = 4096) -> DataFrame:
    """Cutoffs per ``keys``: ``keys, n, wanted, cutoff, kept``.

    ``targets`` has ``target_keys`` (some of ``keys``) and the whole percentage ``pct`` to keep; wanted is
    ceil(pct * n / 100). The cutoff is the greatest score that keeps at least ``wanted`` records.
    """
    keys = list(keys)
    have = F.lit(True)
    for k in keys:
        have = have & F.col(k).isNotNull()
    values = save(df.select(*keys, F.col(score).cast("double").alias("_v")).where(finite(F.col("_v")) & have))
    n = values.df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    goal = targets.select(*target_keys, F.col(pct).cast("long").alias("_pct")).where(F.col("_pct").isNotNull())
    ranks = save(
        n.join(goal, list(target_keys)).select(
            *keys, "n", F.expr("least((_pct * n + 99) div 100, n)").alias("wanted"), F.expr("least(greatest((_pct * n + 99) div 100, 1), n)").alias("_rank")
        )
    ).df
    cut = quickselect(values.df, keys, ranks.select(*keys, "_rank"), finish).withColumnRenamed("_v", "cutoff")
    values.drop()
    return ranks.join(cut, keys).select(*keys, "n", "wanted", "cutoff", "kept")
