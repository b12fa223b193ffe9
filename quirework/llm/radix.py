"""Problem 1: percentiles of very large numeric columns by radix selection.

Doubles become order-preserving 64-bit integers; histograms of successive bit digits are counted per group and
only the digit that holds a target rank is followed. The keys are written once, without a shuffle; every digit is
counted in the tasks that read them, so a shuffle carries counters only, at most 2**16 for a group and prefix in play
and task, and a group that holds a third of all rows costs its reducer no more.

Histograms of the leading bits are mergeable: add the counts of any parts, days or partitions. Percentiles read
from one are bounded by the edges of the bucket that holds the rank: relative error at most 2**(12 - bits).

Nulls, NaN and infinities are no values and are left out. Groups without values give no row. Null group keys form
a group of their own. Ties are counted once each. Clashing column names: only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.runtime import save, small

DIGIT_BITS = 16
_MANTISSA = 1 << 52


def finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def order_key(c: Column) -> Column:
    """Signed 64-bit integer with the order of the finite double ``c``: its IEEE bits, negated below zero. -0 equals 0."""
    a = F.abs(c)
    guess = F.floor(F.log2(F.greatest(a, F.lit(2.0**-1022))))  # log2 may be off by one near powers of two
    low = F.when(F.pow(F.lit(2.0), guess) > a, guess - 1).otherwise(guess)
    e = F.least(F.when(F.pow(F.lit(2.0), low + 1) <= a, low + 1).otherwise(low), F.lit(1023))
    # twice a half power keeps 2**1023 in range
    normal = (e + 1023) * F.lit(_MANTISSA) + ((a / F.pow(F.lit(2.0), e) - 1) * F.lit(float(_MANTISSA))).cast("long")
    subnormal = (a * F.lit(2.0**537) * F.lit(2.0**537)).cast("long")
    key = F.when(a < F.lit(2.0**-1022), subnormal).otherwise(normal)
    return F.when(c < 0, -key).otherwise(key).cast("long")


def key_value(k: Column) -> Column:
    """The double whose ``order_key`` is ``k``."""
    a = F.abs(k)
    e, m = F.shiftright(a, 52), a.bitwiseAND(F.lit(_MANTISSA - 1))
    normal = (1 + m / F.lit(float(_MANTISSA))) * F.pow(F.lit(2.0), (e - 1023).cast("double"))
    subnormal = m * F.lit(2.0**-537) * F.lit(2.0**-537)
    v = F.when(e == 0, subnormal).otherwise(normal)
    return F.when(k < 0, -v).otherwise(v)


def _same(cols: Sequence[str]) -> Column:
    """Equality, null to null, of columns of the sides aliased ``a`` and ``b``."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    return cond


def radix_select(counts: DataFrame, keys: Sequence[str], targets: DataFrame) -> DataFrame:
    """The values at given ranks.

    counts: ``keys``, ``_k`` (order key), ``_n`` (how often; keys may come again). targets: ``keys``, ``_rank`` (from 0).
    Returns ``keys, _rank, _value``.
    """
    keys = list(keys)
    state = targets.select(*keys, "_rank").distinct().withColumns({"_p": F.lit(0).cast("long"), "_off": F.col("_rank")})
    for shift in range(64 - DIGIT_BITS, -1, -DIGIT_BITS):
        # the prefix is the key without its lower digits; the first step has no prefix yet
        up = shift + DIGIT_BITS
        prefix = F.lit(0).cast("long") if up >= 64 else F.shiftright("_k", up)
        rows = counts.withColumn("_p", prefix)
        if up < 64:
            live = state.select(*keys, "_p").distinct()
            rows = rows.alias("a").join(small(live).alias("b"), _same([*keys, "_p"]), "left_semi")
        hist = rows.groupBy(*keys, "_p", F.shiftright("_k", shift).alias("_d")).agg(F.sum("_n").alias("_n"))
        before = F.sum("_n").over(Window.partitionBy(*keys, "_p").orderBy("_d").rowsBetween(Window.unboundedPreceding, -1))
        hist = hist.withColumn("_before", F.coalesce(before, F.lit(0)))
        off, least = F.col("a._off"), F.col("b._before")
        hit = state.alias("a").join(hist.alias("b"), _same([*keys, "_p"]) & (off >= least) & (off < least + F.col("b._n")))
        # the state is read twice by the next step: written, it is not computed twice
        state = save(hit.select(*(F.col(f"a.{c}") for c in keys), "a._rank", F.col("b._d").alias("_p"), (off - least).alias("_off"))).df
    return state.select(*keys, "_rank", key_value(F.col("_p")).alias("_value"))


def radix_percentiles(df: DataFrame, keys: Sequence[str], value: str, percents: dict[str, float]) -> DataFrame:
    """Exact percentiles (linear interpolation) per group: ``keys``, ``n`` and a column for each name in ``percents``."""
    keys = list(keys)
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).where(finite(F.col("_v")))
    counts = save(rows.select(*keys, order_key(F.col("_v")).alias("_k"))).df.withColumn("_n", F.lit(1).cast("long"))
    n = counts.groupBy(*keys).agg(F.sum("_n").alias("n"))
    pos = {name: F.lit(q) * (F.col("n") - 1) for name, q in percents.items()}
    ranks = F.array_distinct(F.array(*(f(p).cast("long") for p in pos.values() for f in (F.floor, F.ceil))))
    targets = n.select(*keys, F.explode(ranks).alias("_rank"))
    got = (
        radix_select(counts, keys, targets)
        .groupBy(*keys)
        .agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_value"))).alias("_at"))
    )
    out = n.alias("a").join(got.alias("b"), _same(keys)).select(*(F.col(f"a.{c}") for c in keys), "n", "_at")

    def between(p: Column) -> Column:
        lo, hi = F.element_at("_at", F.floor(p).cast("long")), F.element_at("_at", F.ceil(p).cast("long"))
        return lo + (hi - lo) * (p - F.floor(p))

    return out.select(*keys, "n", *(between(p).alias(name) for name, p in pos.items()))


def radix_histogram(df: DataFrame, keys: Sequence[str], value: str, bits: int = 24) -> DataFrame:
    """Mergeable summary: ``keys``, ``bucket`` (the leading ``bits`` of the order key), ``n``."""
    if not 13 <= bits <= 64:
        raise ValueError("bits must be between 13 and 64")
    return (
        df.select(*keys, F.col(value).cast("double").alias("_v"))
        .where(finite(F.col("_v")))
        .groupBy(*keys, F.shiftright(order_key(F.col("_v")), 64 - bits).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def merge_histograms(hist: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add histograms of equal ``bits`` over parts or days (union them first); ``keys`` may be coarser than before."""
    return hist.groupBy(*keys, "bucket").agg(F.sum("n").alias("n"))


def histogram_percentiles(hist: DataFrame, keys: Sequence[str], percents: dict[str, float], bits: int = 24) -> DataFrame:
    """``keys, n`` and, for each percentile (rank ceil(q n), 1 at least), ``<name>_low`` and ``<name>_high`` that enclose it."""
    w = Window.partitionBy(*keys).orderBy("bucket")
    c = hist.withColumns({"_upto": F.sum("n").over(w), "_all": F.sum("n").over(Window.partitionBy(*keys))})
    width = 1 << (64 - bits)
    # for negative keys the bucket's lower edge is the larger magnitude: both edges go through key_value
    low, high = key_value(F.col("bucket") * F.lit(width)), key_value(F.col("bucket") * F.lit(width) + F.lit(width - 1))
    aggs = [F.max("_all").alias("n")]
    for name, q in percents.items():
        hit = F.col("_upto") >= F.greatest(F.ceil(F.lit(q) * F.col("_all")), F.lit(1))
        aggs += [F.min(F.when(hit, low)).alias(f"{name}_low"), F.min(F.when(hit, high)).alias(f"{name}_high")]
    return c.groupBy(*keys).agg(*aggs)
