"""Every query with SQL gives DuckDB's rows on the smallest tables."""

from functools import cache
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd
import pytest

from tracksieve.plans import flow_queries
from tracksieve.plans.catalogue import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
flow_queries.flow = cache(flow_queries.flow)  # one run of the flow for all queries on it


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        c.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return c


def rows(df):
    shown = lambda v: "null" if pd.isna(v) else f"{float(v):.5f}" if isinstance(v, (float, int, np.integer, np.floating)) and not isinstance(v, bool) else str(v)
    return sorted(tuple(shown(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_as_sql(spark, con, name):
    assert rows(QUERIES[name](spark, SF).toPandas()) == rows(con.execute(ORACLE_SQL[name]).df())
