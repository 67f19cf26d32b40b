import duckdb
import pytest

import __spark_entry__
from docketry.plans.catalogue import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    return tuple(map(plain, v)) if isinstance(v, list | tuple) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    assert name in ORACLE_SQL
    cur = duck.execute(ORACLE_SQL[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in cur.fetchall()), key=repr)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_chunked_total_of_users_without_errors(spark, tmp_path):
    con = duckdb.connect()
    rows = "(1, 7, 'view', 50.0), (2, 7, 'error', 30.0), (3, 8, 'error', 31.0), (12, 8, 'error', 99.0), (4, 8, 'view', 1.0)"
    con.execute(f"COPY (SELECT event_id::BIGINT AS event_id, user_id::BIGINT AS user_id, event_type, value::DOUBLE AS value FROM (VALUES {rows}) t(event_id, user_id, event_type, value)) TO '{tmp_path}/events.parquet'")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    got = {tuple(r) for r in QUERIES["chunked_total"](spark, str(tmp_path)).select("user_id", "total", "errors").collect()}
    assert got == set(con.execute(ORACLE_SQL["chunked_total"]).fetchall()) == {(7, 2, None), (8, None, "3;12")}
