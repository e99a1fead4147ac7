"""Queries of the sources and sinks against their SQL on the smallest tables."""

import duckdb
import pytest

from ledgerloom.queries import sources
from ledgerloom.queries.common import shipped

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "inventor", "citation", "loc"]


@pytest.mark.parametrize("name", sorted(sources.QUERIES))
def test_source_query_equals_its_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = shipped(sources.QUERIES)[name](spark, sf)
    columns = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(chr(34) + c + chr(34) for c in columns)} FROM ({sources.SQL[name]})").fetchall()
    text = lambda rows: sorted([tuple(str(v) for v in r) for r in rows])
    assert text(tuple(r) for r in df.select(*(f"`{c}`" for c in columns)).collect()) == text(want)
