"""The queries of this subpackage that SQL can express, against DuckDB on sf0.001 and sf0.01."""

import duckdb
import pytest

import __spark_entry__ as E
from strata.llm.oracles import oracle_sql
from strata.llm.queries import queries
from tools.compare import TABLES, digest


def test_all_queries_are_registered():
    registered = set(E.queries())
    assert {"pipeline", *queries()} <= registered
    assert sorted(int(q[2:].split("_")[0]) for q in queries()) == list(range(1, 14))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, name, sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/{sf}/{t}.parquet')")
    found = queries()[name](spark, f"/root/testdata/{sf}")
    wanted = con.execute(oracle_sql()[name])
    columns = [d[0] for d in wanted.description]
    assert sorted(found.columns) == sorted(columns)
    assert digest(found.columns, [tuple(r) for r in found.collect()]) == digest(columns, wanted.fetchall())
