import duckdb

import __spark_entry__ as E


def test_entry_flagship(spark):
    df = E.entry(spark)
    assert df.count() == 15
    assert df.columns[0] == "vin"


def test_every_query_has_an_oracle():
    assert set(E._QUERIES) == set(E._ORACLE)
    assert set(E.oracle_sql()) <= set(E.queries())


def test_queries_match_oracle_at_small_scale(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{sf_dir}/events.parquet')")
    for name in ["silver_clean", "vin_last_state", "fastest_per_hour", "pattern_violations",
                 "silver_stats", "bronze_partition_counts"]:
        got = E.queries()[name](spark, sf_dir)
        cur = con.execute(E.oracle_sql()[name])
        want = cur.fetchall()
        cols = [d[0] for d in cur.description]
        assert sorted(got.columns) == sorted(cols), name
        order = [cols.index(c) for c in got.columns]
        rows = [tuple(r) for r in got.collect()]
        assert sorted(map(repr, rows)) == sorted(repr(tuple(w[i] for i in order)) for w in want), name
