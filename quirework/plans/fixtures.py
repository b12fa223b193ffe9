"""Page-like inputs derived from the star-schema tables, the same in Spark and in DuckDB.

Pages are orders, boxes their rows; documents split at line feeds give lines; embeddings give logits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.runtime import table

SIDE = 1600

BOXES = """SELECT l_orderkey p, row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_shipdate) - 1 k,
  CAST((l_partkey * 37) % 1000 AS DOUBLE) x0, CAST((l_suppkey * 53) % 1400 AS DOUBLE) y0,
  CAST((l_partkey * 37) % 1000 + CAST(l_quantity AS INT) * 10 AS DOUBLE) x1,
  CAST((l_suppkey * 53) % 1400 + 8 + (l_partkey % 5) * 8 AS DOUBLE) y1, l_discount * 10 conf FROM lineitem"""
REGIONS = """SELECT o_orderkey p, rid, CAST((o_custkey * 31 * (rid + 1)) % 500 AS DOUBLE) x0, CAST(rid * 480 AS DOUBLE) y0,
  CAST((o_custkey * 31 * (rid + 1)) % 500 + 700 AS DOUBLE) x1, CAST(rid * 480 + 400 + (o_custkey % 3) * 40 AS DOUBLE) y1, o_orderstatus
  FROM orders CROSS JOIN (VALUES (0), (1), (2)) t(rid)"""
DOC_LINES = """SELECT doc_id, i, t, ((doc_id * 7919 + i * 104729) % 10007) / 10006.0 AS conf
  FROM (SELECT doc_id, unnest(range(len(a))) AS i, unnest(a) AS t FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents WHERE text IS NOT NULL))"""


def _box() -> Column:
    return F.struct("x0", "y0", "x1", "y1")


def boxes(spark: SparkSession, d: str) -> DataFrame:
    sql = BOXES.replace("FROM lineitem", "FROM {lineitem}")
    return spark.sql(sql, lineitem=table(spark, d, "lineitem")).withColumn("box", _box())


def regions(spark: SparkSession, d: str) -> DataFrame:
    """As ``REGIONS``, the three bands by an explode instead of a join."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("p"), "o_custkey", "o_orderstatus", F.explode(F.array(*map(F.lit, range(3)))).alias("rid"))
    x0, y0, top = (F.col("o_custkey") * 31 * (F.col("rid") + 1)) % 500, F.col("rid") * 480, F.col("o_custkey") % 3
    cols = {"x0": x0, "y0": y0, "x1": x0 + 700, "y1": y0 + 400 + top * 40}
    return o.withColumns({k: v.cast("double") for k, v in cols.items()}).drop("o_custkey").withColumn("box", _box())


def doc_lines(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents").where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "t"))
    return t.withColumn("conf", ((F.col("doc_id") * 7919 + F.col("i") * 104729) % 10007) / F.lit(10006.0))


def logits(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    return e.select("vec_id", "label", "embedding", F.transform(F.slice("embedding", 1, 2), lambda x: x.cast("double")).alias("logits"))
