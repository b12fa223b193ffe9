"""Page streams: a folder of images or of page records as an unbounded table. A page is the unit of work.

Watermarked day statistics over late lines are an extension on top of Structured Streaming.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quirework.functions import scalars as S
from quirework.sources.images import EXTENSIONS, _glob


def image_stream(spark: SparkSession, folder: str, per_trigger: int = 16) -> DataFrame:
    """New images of a folder; ``per_trigger`` bounds the pages in flight."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    return spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", _glob(EXTENSIONS)).option("maxFilesPerTrigger", per_trigger).load(folder)


def table_stream(spark: SparkSession, folder: str, schema: str, per_trigger: int = 16) -> DataFrame:
    """New Parquet files of a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(folder)


def latest_lines(lines: DataFrame, late: str = "30 days") -> DataFrame:
    """Lines without repeated deliveries: a line_id counts once within ``late`` of its first delivery."""
    return lines.withWatermark("written_at", late).dropDuplicatesWithinWatermark(["line_id"])


def daily_stats(lines: DataFrame, late: str = "30 days", by: tuple[str, ...] = ("source",)) -> DataFrame:
    """``day, by..., n, n_long, mean_conf`` by day of delivery, closed once ``late`` has passed.

    For deliveries that come again, write ``latest_lines`` to a table first and stream from that: each query keeps one
    state and may run in any output mode.
    """
    c = F.when(S.is_finite(F.col("conf")), F.col("conf"))
    w = F.window("written_at", "1 day")
    g = lines.withWatermark("written_at", late).groupBy(w.alias("_w"), *by)
    return g.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.length("text") > S.LONG_ROW).alias("n_long"), F.avg(c).alias("mean_conf")).select(F.col("_w.start").alias("day"), *by, "n", "n_long", "mean_conf")


def run_batches(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Runs a batch pipeline over every micro-batch, from where the last run ended."""
    w = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()
