import math

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
CHECKED = ["clean_report_by_source", "chunk_rows", "continuation_convs", "equal_quota_cap", "assemble_multi_turn", "blend_rows", "pack_blocks", "grounding_verdicts", "dpo_checks", "whatif_expand"]


def plain(df):
    value = lambda v: None if v is None or (isinstance(v, float) and math.isnan(v)) else round(float(v), 6) if isinstance(v, float) else str(v)
    return sorted((tuple(value(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    got, sql = entry.queries()[name](spark, sf).toPandas(), con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(sql.columns) and plain(got) == plain(sql) and len(got)


def test_entry_and_names(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
