import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", ["p1_found", "p5_columns", "prospect_rollup", "policy_prefix_unique", "ledger_merge", "parse_cells_pages", "layout_choice", "crm_match"])
def test_against_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.split('.')[0]} as select * from read_parquet('{SF}/{f}')")
    got, want = entry.queries()[name](spark, SF).toPandas(), con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    text = lambda d: sorted(tuple("" if v is None or v != v else (f"{v:.6g}" if isinstance(v, float) else str(v)) for v in r) for r in d[cols].itertuples(index=False, name=None))
    assert text(got) == text(want)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_flagship(spark):
    assert entry.entry(spark).count() > 0
