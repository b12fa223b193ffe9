"""Connected components and ranks that no single task has to hold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.runtime import save


def components(edges: DataFrame, a: str = "a", b: str = "b", keys: Sequence[str] = ()) -> DataFrame:
    """Members of the components of an edge table: ``keys, node, root`` with the least node as root.

    Min-label rounds: every node hands the least label it knows to its neighbours and to its old root, until no label
    changes. Each round is a shuffle on (keys, node) and is written, so neither a component nor a key need fit a task.
    Edges with a null end are left out; self-loops and repeated edges are harmless. Nodes without edges do not occur.
    """
    keys = list(keys)
    e = edges.select(*keys, F.col(a).alias("_a"), F.col(b).alias("_b")).where("_a is not null and _b is not null")
    links = save(e.unionByName(e.select(*keys, F.col("_b").alias("_a"), F.col("_a").alias("_b"))).distinct())
    known = save(links.df.groupBy(*keys, F.col("_a").alias("node")).agg(F.least(F.min("_b"), F.first("_a")).alias("root")).withColumn("_old", F.lit(None).cast(edges.schema[a].dataType)))
    while True:
        s = known.df.drop("_old")
        near = links.df.join(s.select(*keys, F.col("node").alias("_a"), "root"), [*keys, "_a"]).select(*keys, F.col("_b").alias("node"), "root")
        # a node also gets the label of its root: paths halve each round
        jump = s.select(*keys, "node", F.col("root").alias("_r")).join(s.select(*keys, F.col("node").alias("_r"), "root"), [*keys, "_r"]).select(*keys, "node", "root")
        own = s.withColumn("_old", F.col("root"))
        none = F.lit(None).cast(edges.schema[a].dataType).alias("_old")
        every = own.unionByName(near.select(*keys, "node", "root", none)).unionByName(jump.select(*keys, "node", "root", none))
        new = save(every.groupBy(*keys, "node").agg(F.min("root").alias("root"), F.max("_old").alias("_old")))  # one write a round
        known.drop()
        known = new
        if not new.df.where("root < _old").limit(1).count():
            links.drop()
            return new.df.select(*keys, "node", "root")


def spread_rank(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str, parts: int | None = None) -> DataFrame:
    """``df`` with the row's rank (from 0) within ``keys`` by ``order``, without one task per key.

    Rows are range-partitioned by keys and order; a key spread over several partitions gets its offsets from their
    counts. Ties must be broken by ``order`` itself.
    """
    keys = list(keys)
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(n, *keys, *order).withColumn("_part", F.spark_partition_id())
    saved = save(placed).df  # the partition ids must not change between the two readings
    counts = saved.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_part")) - F.col("_n")
    offsets = counts.withColumn("_before", before).drop("_n")
    local = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order)) - 1
    return saved.withColumn("_local", local).join(offsets, [*keys, "_part"]).withColumn(name, (F.col("_local") + F.col("_before")).cast("long")).drop("_local", "_before", "_part")
