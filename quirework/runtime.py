"""Session helpers: table loading, lineage cuts in the shared folder, size-checked broadcasts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only if Catalyst's own size estimate of it is below this.
BROADCAST_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, or the context's checkpoint folder.

    Only a local master may do without: a folder of our own is made then, removed at exit. On a cluster an unset folder
    is an error, as a machine's own one would be written by some executors and read by others.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        own = tempfile.mkdtemp(prefix="quirework-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        sc.setCheckpointDir(own)
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def _drop(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session has ended before us; the cluster clears its checkpoint folder
        pass


#: Tables written by the scopes that are open, innermost last.
_SCOPES: list[list[Saved]] = []


class Saved:
    """A written table together with the handle that deletes it again."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.df = spark.read.parquet(path)
        atexit.register(self.drop)
        for scope in _SCOPES[-1:]:
            scope.append(self)

    def drop(self) -> None:
        _drop(self.spark, self.path)
        atexit.unregister(self.drop)


@contextmanager
def scope() -> Iterator[None]:
    """Deletes at its end every table that operators have written within it, so that a long session does not fill the folder.

    Results are lazy and read those tables: consume or write them before the scope ends.
    """
    _SCOPES.append([])
    try:
        yield
    finally:
        for s in _SCOPES.pop():
            s.drop()


def save(df: DataFrame) -> Saved:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quirework-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return Saved(spark, path)


def cut(df: DataFrame) -> DataFrame:
    """``save`` for callers that need no early deletion."""
    return save(df).df


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimized plan."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its estimated size is within ``limit``, else unchanged (a shuffle join then)."""
    return F.broadcast(df) if estimated_bytes(df) <= limit else df
