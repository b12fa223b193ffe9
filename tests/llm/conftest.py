import pytest

TABLES = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long, script string, conf double, run_at timestamp, loaded_at timestamp",
    "line_text": "line_id long, page_id long, source string, region_pos int, line_pos int, polygon array<struct<x:int,y:int>>, text string, conf double, script string, line_conf double, script_conf double, written_at timestamp",
    "page_info": "page_id long, image_path string, width int, height int, language string, stats struct<PC:double,PC25:double,PC50:double,PC75:double,N_LONG_ROWTEXT:long>, run_at timestamp, written_at timestamp",
    "lexicon": "word string, is_common boolean",
    "source_targets": "source string, keep_pct int, mix_permille int, max_repeats int",
    "pack_sizes": "profile string, capacity int",
    "page_json": "page_id long, received_at timestamp, body string",
}


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    """A data folder whose tables have no rows."""
    d = tmp_path_factory.mktemp("empty")
    for name, schema in TABLES.items():
        spark.createDataFrame([], schema).write.parquet(f"{d}/{name}.parquet")
    return str(d)
