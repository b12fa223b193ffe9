"""p1 percentiles and p6 cutoffs against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quirework.llm import cutoff, radix

NAN, INF = float("nan"), float("inf")


def test_order_key_is_the_bit_pattern(spark):
    rng = np.random.default_rng(1)
    v = [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, -1.7976931348623157e308]
    v += [float(x) for e in range(-1074, 1024, 7) for x in (2.0**e, np.nextafter(2.0**e, 0), np.nextafter(2.0**e, 1e308))]
    v += list(rng.normal(size=200) * 10.0 ** rng.integers(-300, 300, 200))
    rows = spark.createDataFrame([(float(x),) for x in v], "x double").select("x", radix.order_key(F.col("x")).alias("k")).withColumn("y", radix.key_value(F.col("k"))).collect()
    for r in rows:
        bits = int(np.float64(abs(r.x)).view(np.int64))
        assert r.k == (-bits if r.x < 0 else bits)
        assert r.y == r.x


@pytest.fixture(scope="module")
def scores(spark):
    rng = np.random.default_rng(5)
    rows = [("a", float(x)) for x in rng.normal(size=900)] + [("b", round(float(x), 1)) for x in rng.random(300)] + [(None, 0.5)] * 3 + [("one", 7.0)]
    rows += [("a", None), ("a", NAN), ("a", INF), ("b", -INF), ("none", None)]
    return spark.createDataFrame(rows, "g string, v double").withColumn("n", F.lit("clash"))


def finite(rows, g):
    return sorted(r.v for r in rows if r.g == g and r.v is not None and math.isfinite(r.v))


def test_percentiles_equal_numpy(scores):
    rows = scores.collect()
    got = {r.g: r for r in radix.radix_percentiles(scores.drop("n"), ["g"], "v", {"p10": 0.1, "p50": 0.5, "p99": 0.99}).collect()}
    assert set(got) == {"a", "b", None, "one"}
    for g, r in got.items():
        v = finite(rows, g)
        assert r.n == len(v)
        assert np.allclose([r.p10, r.p50, r.p99], np.percentile(v, [10, 50, 99]), rtol=1e-12)


def test_histograms_merge_and_bound_the_error(scores):
    parts = scores.withColumn("part", (F.rand(3) * 3).cast("int"))
    hist = [radix.radix_histogram(parts.where(F.col("part") == i), ["g"], "v", 26) for i in range(3)]
    merged = radix.merge_histograms(hist[0].unionByName(hist[1]).unionByName(hist[2]), ["g"])
    rows = scores.collect()
    for r in radix.histogram_percentiles(merged, ["g"], {"p50": 0.5}, 26).collect():
        v = finite(rows, r.g)
        exact = v[max(math.ceil(0.5 * len(v)), 1) - 1]
        assert min(r.p50_low, r.p50_high) <= exact <= max(r.p50_low, r.p50_high)
        assert abs(r.p50_high - r.p50_low) <= 2.0 ** (12 - 26) * max(abs(exact), 1e-300) * 1.01


def test_percentiles_of_no_rows(spark):
    e = spark.createDataFrame([], "g string, v double")
    assert radix.radix_percentiles(e, ["g"], "v", {"p50": 0.5}).collect() == []


@pytest.mark.parametrize("finish", [1, 16, 4096])
def test_cutoffs_equal_sorting(spark, finish):
    rng = np.random.default_rng(8)
    rows = [("s1", "x", round(float(v), 2)) for v in rng.random(700)] + [("s2", "x", 0.5)] * 40 + [("s2", "y", float(v)) for v in rng.random(90)]
    rows += [("s3", "x", 0.1), ("s3", None, 0.2), (None, "x", 0.3), ("s1", "x", None), ("s1", "x", NAN), ("s1", "x", INF), ("s9", "x", 0.4)]
    d = spark.createDataFrame(rows, "source string, script string, conf double").withColumn("n", F.lit(1))
    t = spark.createDataFrame([("s1", 33), ("s2", 50), ("s3", 0), ("s4", 10), ("s5", None)], "source string, pct int")
    got = {(r.source, r.script): r for r in cutoff.keep_cutoffs(d, ["source", "script"], "conf", t, ["source"], "pct", finish).collect()}
    assert set(got) == {("s1", "x"), ("s2", "x"), ("s2", "y"), ("s3", "x")}
    pct = {"s1": 33, "s2": 50, "s3": 0}
    for (s, sc), r in got.items():
        v = sorted((x for a, b, x in rows if a == s and b == sc and x is not None and math.isfinite(x)), reverse=True)
        wanted = -(-pct[s] * len(v) // 100)
        assert (r.n, r.wanted) == (len(v), wanted)
        assert r.cutoff == v[max(wanted, 1) - 1]
        assert r.kept == sum(x >= r.cutoff for x in v)


def test_cutoffs_of_no_rows(spark):
    d = spark.createDataFrame([], "source string, script string, conf double")
    t = spark.createDataFrame([("s1", 33)], "source string, pct int")
    assert cutoff.keep_cutoffs(d, ["source", "script"], "conf", t, ["source"], "pct").collect() == []
