"""Queries against their SQL, on a table of a thousand lines of orders with different keys."""

import duckdb
import pytest

import __spark_entry__

TABLES = ("nation", "customer", "supplier", "part", "orders", "lineitem")
NAMES = ["summary", "report_columns", "report_series", "merge_chunks", "positional_pairs", "orphans", "quality_trim", "demultiplex", "workflow_report", "alignment_log", "histogram_roundtrip", "json_roundtrip", "rejected", "pair_merge", "stream_summary"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    con = duckdb.connect()
    for t in TABLES:
        keys = "DISTINCT ON (l_orderkey, l_linenumber, l_partkey, l_suppkey)" if t == "lineitem" else ""
        rows = f"SELECT {keys} * FROM '/root/testdata/sf0.001/{t}.parquet'" + (" ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 1000" if t == "lineitem" else "")
        con.execute(f"COPY ({rows}) TO '{folder}/{t}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return str(folder), con


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, tables, name):
    folder, con = tables
    got = __spark_entry__.queries()[name](spark, folder)
    columns = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(f'{chr(34)}{c}{chr(34)}' for c in columns)} FROM ({__spark_entry__.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(repr, want))
