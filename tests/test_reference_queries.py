"""Every registered reference query against its SQL in DuckDB, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from taxarium.plans.everything import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(df: pd.DataFrame) -> list:
    plain = lambda x: None if pd.isna(x) else (x.item() if hasattr(x, "item") else x)
    cells = lambda x: float(x) if isinstance(x, int) and not isinstance(x, bool) else x
    return sorted(repr(tuple(cells(plain(x)) for x in r)) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name in SQL:
        want = duck.sql(SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
    else:
        assert len(got)
