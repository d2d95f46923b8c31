"""The queries with SQL against DuckDB on the smallest tables."""

import duckdb
import pytest

from ticklake.llm.queries import REGISTRY
from ticklake.llm.sql import SQL
from ticklake.sources.tables import table_path

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{table_path(SF, t)}'")
    want = con.sql(SQL[name])
    got = REGISTRY[name](spark, SF)
    cols = sorted(want.columns)
    assert cols == sorted(got.columns)
    rows = lambda names, data: sorted(str([r[names.index(c)] for c in cols]) for r in data)
    assert rows(got.columns, map(tuple, got.collect())) == rows(want.columns, want.fetchall())
