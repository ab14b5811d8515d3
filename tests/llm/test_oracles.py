"""Queries against their SQL, on whole test tables, and the registry itself."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from orderloom.llm.queries import ORACLES, QUERIES


def test_every_operator_has_one_query():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees(spark, sf_dir, name):
    db = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    ours, theirs = QUERIES[name](spark, sf_dir).toPandas(), db.sql(ORACLES[name]).df()
    key = ours.columns[0]
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    a, b = (x[columns].sort_values(key, ignore_index=True).astype(object).where(lambda v: v.notna(), None) for x in (ours, theirs))
    pd.testing.assert_frame_equal(a, b, check_dtype=False, rtol=1e-9)
