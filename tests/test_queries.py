"""Every query with SQL gives the rows of its SQL on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from auralith.plans.extended import QUERIES, SQL

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in "orders lineitem events documents embeddings pages labels conversations customer supplier benchmark".split():
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def rows(df: pd.DataFrame) -> list:
    plain = lambda v: "" if pd.isna(v) else repr(float(v)) if not isinstance(v, str | bool) else repr(v)
    return sorted(tuple(plain(v) for v in r) for r in df[sorted(df.columns)].astype(object).values.tolist())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, duck, name):
    assert rows(QUERIES[name](spark, DATA).toPandas()) == rows(duck.sql(SQL[name]).df())


def test_components_of_whole_table(spark, duck):
    """The recursive SQL would not end on all rows, so union and find over them."""
    pairs = duck.sql("SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem").fetchall()
    root: dict = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for clip, speaker in pairs:
        a, b = sorted((find((0, clip)), find((1, speaker))))
        root[b] = a
    want = {c: find((0, c))[1] for c, _ in pairs}
    got = {r["clip"]: r["root"] for r in QUERIES["G1_components_suppliers"](spark, DATA).collect()}
    assert got == want and len(got) == duck.sql("SELECT count(DISTINCT l_orderkey) FROM lineitem").fetchall()[0][0]
    assert {r["clip"] for r in QUERIES["G1_splits_suppliers"](spark, DATA).collect()} == set(want)


def test_splits_of_suppliers_contract_a_small_graph(spark, duck, monkeypatch):
    from auralith.operators import graph

    edges, whole = [], graph.connected
    monkeypatch.setattr(graph, "connected", lambda e: edges.append(e.count()) or whole(e))
    QUERIES["G1_splits_suppliers"](spark, DATA)
    assert len(edges) == 1 and edges[0] < duck.sql("SELECT count(DISTINCT l_orderkey) FROM lineitem").fetchall()[0][0] / 10
