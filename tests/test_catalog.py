"""Every core query on the smallest data, against DuckDB where SQL states the result."""

import math
import os

import pytest

import __spark_entry__ as entry
from quirework.plans import catalog


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    return tuple(map(norm, v)) if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def duck(data):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(data):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{data}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, data, duck, name):
    df = catalog.queries()[name](spark, data)
    rows = df.collect()
    assert rows or name == "cyclic_pages"  # the smallest data have no cycle
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        return
    r = duck.execute(sql)
    cols = [c[0] for c in r.description]
    assert sorted(cols) == sorted(df.columns)
    got = sorted(repr([norm(x[c]) for c in cols]) for x in rows)
    assert got == sorted(repr([norm(v) for v in x]) for x in r.fetchall())


def test_entry(spark, data):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalog.queries()) <= set(entry.queries())


def test_core_stands_alone():
    """Nothing outside the training-data subpackage imports it, but for the driver's entry."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sub = "l" + "lm"
    for folder, _, files in os.walk(os.path.join(root, "quirework")):
        if os.sep + sub in folder:
            continue
        for f in files:
            if f.endswith(".py"):
                assert f"quirework.{sub}" not in open(os.path.join(folder, f), encoding="utf-8").read(), f


def test_plans(spark, data):
    """What the plans must keep: pruned columns, no cross join, no nested loops over whole tables."""
    for name in ("page_stats", "merge_edges", "line_region", "sliver_filter"):
        plan = catalog.queries()[name](spark, data)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan
        assert "BroadcastNestedLoopJoin" not in plan, name
    plan = catalog.queries()["long_rows"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_a_cluster_needs_a_shared_folder():
    """Only a local master may write to a folder of its own."""
    from quirework import runtime

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, name, default=None):
            return self.value if name == "spark.checkpoint.dir" else default

    session = lambda value: type("S", (), {"sparkContext": Context(), "conf": Conf(value)})
    with pytest.raises(RuntimeError):
        runtime.shared_dir(session(None))
    assert runtime.shared_dir(session("hdfs://x/shared/")) == "hdfs://x/shared"


def test_a_scope_leaves_nothing_behind(spark):
    from quirework import runtime

    with runtime.scope():
        t = runtime.save(spark.range(3))
        assert t.df.count() == 3
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(t.path)
    assert not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
