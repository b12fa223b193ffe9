"""Every query on the smallest data and on empty tables; SQL results where SQL can state them."""

import math

import pytest

from quirework.llm import catalog

SMALL = ["p1_found", "p1_merged_days", "p1_percentiles", "p10_found", "p10_shares", "p2_found", "p2_shares", "p4_classes", "p4_found", "p6_cutoffs", "p6_found", "p6_rounds", "p8_found", "p8_whole", "p9_drawn", "p9_found", "p9_mixture", "p9_shares"]


def plain(rows, cols):
    def norm(v):
        return ("nan" if math.isnan(v) else round(v, 8)) if isinstance(v, float) else v

    return sorted(repr([norm(r[c]) for c in cols]) for r in rows)


@pytest.mark.parametrize("name", SMALL)
def test_sql(spark, data, name):
    duckdb = pytest.importorskip("duckdb")
    df = catalog.queries()[name](spark, data)
    con = duckdb.connect()
    for t in ("documents", "line_text", "page_info", "source_targets", "pack_sizes", "lexicon"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    r = con.execute(catalog.oracle_sql()[name])
    cols = [c[0] for c in r.description]
    assert sorted(cols) == sorted(df.columns)
    assert plain([x.asDict() for x in df.collect()], cols) == plain([dict(zip(cols, x, strict=True)) for x in r.fetchall()], cols)


COLUMNS = {
    "p1_found": ["language", "script", "run_day"], "p2_found": ["record_kind", "record_id"], "p3_found": ["doc_id", "line_no", "noise_kind"],
    "p4_found": ["record_kind", "id_a", "id_b"], "p5_found": ["record_kind", "record_id", "lang"], "p6_found": ["source", "script"],
    "p8_found": ["profile", "doc_id", "n_pieces"], "p9_found": ["source"], "p10_found": ["doc_id", "text_kind"],
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_empty_tables(spark, empty, name):
    df = catalog.queries()[name](spark, empty)
    assert df.columns == COLUMNS[name]
    assert df.count() == 0


@pytest.mark.parametrize("name", ["p2_found", "p3_found", "p4_found", "p5_found", "p10_found"])
def test_small_data(spark, data, name):
    df = catalog.queries()[name](spark, data)
    assert df.columns == COLUMNS[name]
    assert df.count() > 0
