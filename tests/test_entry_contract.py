"""The driver contract of __spark_entry__.py."""

import __spark_entry__ as entry
from tools.check_oracles import digest, frame_rows


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["country", "co2", "methane", "nitrous"]


def test_every_oracle_has_a_query():
    qs, os_ = entry.queries(), entry.oracle_sql()
    assert set(os_) <= set(qs)
    assert len(qs) >= 100


def test_some_queries_match_oracle(spark):
    import duckdb
    from airshed.sources.driver import TABLES
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    for key in ["stage_emissions", "sum_by_country", "explode_dash_years", "upsert_changed_only", "dedupe_keep_first", "row_hash"]:
        got = entry.queries()[key](spark, sf).toPandas()
        want = con.execute(entry.oracle_sql()[key]).df()
        assert sorted(got.columns) == sorted(want.columns), key
        assert digest(frame_rows(got)[1]) == digest(frame_rows(want)[1]), key
