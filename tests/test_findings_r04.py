"""What the fourth round's findings asked for."""

from __future__ import annotations

import re
from datetime import datetime

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Row

from tradewind.operators import behaviour, recommend
from tradewind.plans import registry
from tradewind.plans import silver as silver_plans
from tradewind.plans.sample import Sample

N_ORDERS = 60


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A small set of tables: lines without product or order, repeated orders and lines that differ, null keys."""
    root, day = str(tmp_path_factory.mktemp("tables")), lambda i: datetime(1996, 1 + i % 12, 1 + i % 28)
    orders = [(i, i % 13 if i % 11 else None, "OFP"[i % 3], 1000.0 * i, day(i), ["1-URGENT", "5-LOW"][i % 2]) for i in range(N_ORDERS)]
    orders += [(i, 5 + i % 3, "F", 7.0, day(i + 3), "2-HIGH") for i in range(0, N_ORDERS, 7)] + [(None, 1, "O", 1.0, day(1), "5-LOW")]
    lines = [
        (o, (o * 7 + n) % 23, 1, n, 1.0 + (o + n) % 9, 90.0 + o * n, 0.01 * (n % 5), 0.0, "N", "O", day(o))
        for o in range(N_ORDERS + 5) for n in range(1, 2 + o % 6)]
    lines += [(*x[:1], (x[1] + 2) % 23, *x[2:4], x[4] + o % 2, *x[5:]) for o, x in enumerate(lines[::4])]
    lines += [(None, 3, 1, 1, 2.0, 9.0, 0.0, 0.0, "N", "O", day(2)), (8, None, 1, 9, 2.0, 9.0, 0.0, 0.0, "N", "O", day(2))]
    frames = {
        "region": ([(0, "ASIA"), (1, "EUROPE")], "r_regionkey int, r_name string"),
        "nation": ([(i, f"NATION {i}", i % 2) for i in range(4)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(i, f"Customer#{i}", i % 4, 1.0, "FURNITURE") for i in range(12)],
                     "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "part": ([(i, f"part {i}", "Brand#1", ["LARGE", "SMALL"][i % 2], i, 10.0 + i) for i in range(20)],
                 "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "orders": (orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": (lines, """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double,
                     l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"""),
        "events": ([(i, datetime(1997, 1, 1 + i % 20, i % 24), i % 13, ["view", "click", "signup"][i % 3], 1.0, f'{{"k": {i % 20}}}') for i in range(80)],
                   "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"),
    }
    for name, (rows, schema) in frames.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    return root


@pytest.fixture
def no_broadcast(spark):
    """Every lookup shuffles, as with large tables."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def _plain(v):
    return {k: _plain(x) for k, x in v.asDict().items()} if isinstance(v, Row) else [_plain(x) for x in v] if isinstance(v, list) else v


def _sorted(df):
    return sorted((repr(_plain(r)) for r in df.select(*sorted(df.columns)).collect()))


def _shuffles(df) -> list[str]:
    """The first keys of the shuffles of the plan as it ran, without those that only read another's files."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    found = (re.search(r" Exchange hashpartitioning\(([a-z_]+)#", x) for x in plan.splitlines() if "ReusedExchange" not in x)
    return [x[1] for x in found if x]


def test_documents_deal_items_and_orders_once(spark, tables, no_broadcast):
    lazy = Sample(spark, tables)
    want = behaviour.order_documents(lazy.orders, lazy.lines)
    found = registry.queries()["order_documents"](spark, tables)
    assert found.columns == want.columns and _sorted(found) == _sorted(want) and found.count() > 40
    assert _shuffles(found).count("order_id") == 2


def test_lake_deals_each_fact_once_and_holds_the_same_rows(spark, tables, no_broadcast, tmp_path, monkeypatch):
    written, write = {}, silver_plans.write_bucketed

    def noted(table, path, *args):
        written[path.rsplit("/", 1)[1]] = table
        return write(table, path, *args)

    monkeypatch.setattr(silver_plans, "write_bucketed", noted)
    lazy = Sample(spark, tables).silver
    lake = silver_plans.write_silver(spark, lazy, str(tmp_path / "lake"))
    for name in silver_plans.TABLES:
        month = {"order_month"} if name == "lines" else set()
        want, found = getattr(lazy, name), getattr(lake, name)
        assert set(found.columns) - month == set(want.columns) and _sorted(found.drop(*month)) == _sorted(want) and want.count() > 10
    assert _shuffles(written["lines"]).count("order_id") == 2
    assert _shuffles(written["orders"]).count("order_id") == 1       # the lines lie in buckets already


def test_block_products_are_single_and_their_best_exact(monkeypatch):
    """Some scores lie within single precision's error of each other; ties go to the smaller id."""
    rng = np.random.default_rng(4)
    n, k, rank = 4096, 10, 32
    users, items = (1 + rng.random((512, rank))).astype(np.float32), rng.random((n, rank)).astype(np.float32)
    items[::200] = (1 + rng.random(rank)).astype(np.float32)       # 21 alike, some of them a little better
    items[::400, 0] += np.float32(2.0**-21)
    alike = np.repeat(items[:8], n // 8, axis=0)                    # whole rows of near ties
    alike[:, 0] += (rng.integers(0, 4, n) * 2.0**-21).astype(np.float32)
    norm = lambda x: np.sqrt((x.astype(float) ** 2).sum(1))
    seen, products = np.arange(512, dtype=np.int32), []

    class Noted(np.ndarray):
        def __array_ufunc__(self, ufunc, method, *inputs, **kw):
            plain = [np.asarray(x) if isinstance(x, Noted) else x for x in inputs]
            if ufunc is np.matmul:
                products.append(np.result_type(*plain))
            return getattr(ufunc, method)(*plain, **kw)

    def best(items, kths):
        row = {
            "ub": 0, "uids": np.arange(512, dtype=np.int32).tobytes(), "users": users.tobytes(), "norms": norm(users).tobytes(),
            "kths": kths.astype(np.float32).tobytes(), "seen_rows": seen.tobytes(), "seen_places": (seen * 8).tobytes(),
            "block": 0, "iids": np.arange(n, dtype=np.int32).tobytes(), "items": items.tobytes(),
            "places": np.arange(n, dtype=np.int32).tobytes(), "largest": float(norm(items).max())}
        got = {}
        for batch in recommend._block_top(k, n)([pa.RecordBatch.from_pylist([row])]):
            for r in sorted(batch.to_pylist(), key=lambda r: (r["uid"], -r["score"], r["iid"])):
                got.setdefault(r["uid"], []).append(r["iid"])
        return got

    def want(items, kths):
        scores = (users.astype(float) @ items.astype(float).T).astype(np.float32)
        scores[seen, seen * 8] = -np.inf
        found = {u: [i for i in np.lexsort((np.arange(n), -scores[u]))[:k].tolist() if scores[u, i] >= kths[u]] for u in range(512)}
        return {u: x for u, x in found.items() if x}

    none = np.full(512, -np.inf)
    fifth = np.sort((users.astype(float) @ items.astype(float).T).astype(np.float32), axis=1)[:, -5]
    fifth[::3] = 1e9                                                # nothing is good enough
    plain = np.frombuffer
    monkeypatch.setattr(np, "frombuffer", lambda *a: plain(*a).view(Noted))
    assert best(items, none) == want(items, none)
    monkeypatch.undo()
    assert products == [np.float32]
    assert best(items, fifth) == want(items, fifth)
    assert best(alike, none) == want(alike, none)
