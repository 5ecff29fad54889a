"""Cleaning rules on hand-made rows with nulls, blanks, duplicates and mixed case."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tradewind.operators import clean, silver
from tradewind.sources import readers, schemas, sinks
from tradewind.sources.readers import Bronze


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_blank_to_null_and_canonical(spark):
    df = spark.createDataFrame([("a", "  upi "), ("b", "CREDIT card"), ("c", "gift voucher"), ("d", None)], "k string, v string")
    out = df.withColumn("v", clean.canonical("v", ["UPI", "Credit Card"]))
    assert {r.k: r.v for r in out.collect()} == {"a": "UPI", "b": "Credit Card", "c": "Gift Voucher", "d": None}
    vocabulary = spark.createDataFrame([("UPI",), ("Credit Card",)], "v string")
    joined = clean.canonicalise(df, "v", vocabulary)
    assert rows(joined.fillna("-"), "k", "v") == rows(out.fillna("-"), "k", "v")
    blank = clean.blank_to_null(spark.createDataFrame([(" ",), ("x",), (None,)], "v string"), ["v"])
    assert [r.v for r in blank.collect()] == [None, "x", None]


def test_dedupe_is_deterministic_and_keeps_smallest(spark):
    data = [(1, "b", 2), (1, "a", 9), (2, None, 1), (2, "z", 0), (3, "q", 5)]
    want = [(1, "a", 9), (2, None, 1), (3, "q", 5)]
    for parts in (1, 4, 7):
        df = spark.createDataFrame(data, "k int, s string, n int").repartition(parts)
        assert sorted(map(tuple, clean.dedupe(df, ["k"]).collect())) == want


def test_dedupe_limits_rows_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = clean.dedupe(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


def test_unused_lookups_are_dropped_from_the_plan(spark):
    from tradewind.operators import sales
    from tradewind.plans.silver import Silver

    s = Silver(_bronze(spark))
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" not in plan(sales.sales_monthly(s.orders))
    assert "LeftOuter" in plan(sales.sales_by_state(s.orders))


def _bronze(spark):
    ts = dt.datetime(2025, 1, 2, 3, 4, 5)
    customers = spark.createDataFrame([
        ("C1", "Asha", "Rao", None, "F", 30, " mumbai ", "MH", "West", 1, None, "Direct"),
        ("C1", "Asha", "Rao", None, "F", 30, " mumbai ", "MH", "West", 1, None, "Direct"),
        ("C2", "Ben", "Lee", None, "M", 40, "  ", "DL", "North", 1, None, "Email")], schemas.CUSTOMERS)
    products = spark.createDataFrame([
        ("P1", "Pen", "Office", "Pens", "X", Decimal("10.00"), Decimal("4.00"), None),
        ("P2", "Bad", "Office", "Pens", "X", Decimal("0.00"), Decimal("4.00"), None)], schemas.PRODUCTS)
    orders = spark.createDataFrame([
        ("O1", "C1", ts, " delivered", "upi", "Desktop", " ", Decimal("5.00")),
        ("O1", "C1", ts, " delivered", "upi", "Desktop", " ", Decimal("5.00")),
        ("O2", "C2", ts, "Cancelled", "EMI", "Desktop", "SAVE", Decimal("0.00")),
        ("O3", "C2", None, "Shipped", "EMI", "Desktop", None, Decimal("0.00")),
        ("O4", "C2", ts, "Shipped", "EMI", "Desktop", None, Decimal("0.00"))], schemas.ORDERS)
    items = spark.createDataFrame([
        ("O1", 1, "P1", 3, Decimal("10.00"), Decimal("9.99"), Decimal("0.0010"), 5),
        ("O1", 1, "P1", 3, Decimal("10.00"), Decimal("9.99"), Decimal("0.0010"), 5),
        ("O1", 2, "P1", 0, Decimal("10.00"), Decimal("9.99"), Decimal("0.0010"), None),
        ("O2", 1, "P1", 1, Decimal("10.00"), Decimal("10.00"), Decimal("0.0000"), None),
        ("O2", 2, "P2", 1, Decimal("10.00"), Decimal("10.00"), Decimal("0.0000"), None)], schemas.ORDER_ITEMS)
    events = spark.createDataFrame([
        ("E1", "S1", "C1", ts, "PRODUCT_VIEW", "P1", "Desktop", "Email", None),
        ("E1", "S1", "C1", ts, "PRODUCT_VIEW", "P1", "Desktop", "Email", None),
        ("E2", "S1", "C1", ts + dt.timedelta(minutes=2), "product_view", " ", "Desktop", "Email", None),
        ("E3", "S1", "C1", ts + dt.timedelta(minutes=4), "purchase", "P1", "Desktop", "Email", "O1"),
        ("E4", "S2", "C2", ts, "error", None, "Mobile App", "Direct", None)], schemas.EVENTS)
    return Bronze(customers, products, orders, items, events)


def test_silver_of_hand_made_rows(spark):
    from tradewind.plans.silver import Silver

    s = Silver(_bronze(spark))
    assert rows(s.customers, "customer_id", "city", "full_name") == [("C1", "Mumbai", "Asha Rao"), ("C2", "Unknown", "Ben Lee")]
    orders = {r.order_id: r for r in s.orders.collect()}
    assert set(orders) == {"O1", "O2"}                       # O3 has no time, O4 no valid line
    assert orders["O1"].net_amount == Decimal("29.97") and orders["O1"].profit == Decimal("17.97")
    assert orders["O1"].status == "Delivered" and orders["O1"].is_revenue and not orders["O1"].coupon_used
    assert not orders["O2"].is_revenue and orders["O2"].items_count == 1
    (session,) = s.sessions.collect()
    assert (session.events, session.product_views, session.has_purchase, session.duration_sec) == (2, 1, 1, 240)


def test_dq_report_identities(spark):
    got = {(r.table_name, r.metric): r.value for r in clean.dq_report(_bronze(spark)).collect()}
    assert got["customers", "raw"] == 3 and got["customers", "duplicates_removed"] == 1
    assert got["customers", "missing_city_filled"] == 1
    assert got["products", "invalid_removed"] == 1
    assert got["orders", "clean"] == 3 and got["orders", "payment_values_standardised"] == 2
    assert got["order_items", "clean"] == 3 and got["order_items", "invalid_quantity_removed"] == 1
    assert got["events", "event_type_case_fixed"] == 2 and got["events", "duplicates_removed"] == 1
    assert got["events", "raw"] == got["events", "clean"] + got["events", "duplicates_removed"] + got["events", "invalid_removed"]


@pytest.mark.parametrize("gap", [60, 1800, 86400])
def test_sessions_match_a_plain_python_split(spark, gap):
    import random

    rng = random.Random(gap)
    base = dt.datetime(2025, 1, 1)
    events, t = [], {c: base for c in ("hot", "b", "c")}
    for i in range(600):
        c = "hot" if rng.random() < 0.6 else rng.choice("bc")
        t[c] += dt.timedelta(seconds=rng.choice([1, gap // 3, gap - 1, gap, gap + 1, 2 * gap]))
        events.append((f"E{i:04}", c, t[c], "product_view", "P1", "Desktop", "Email"))
    df = spark.createDataFrame(
        events, "event_id string, customer_id string, event_time timestamp, event_type string, product_id string, "
                "device string, traffic_source string").repartition(5)
    want = {}
    for c in t:
        times = sorted(e[2] for e in events if e[1] == c)
        sizes = [1]
        for a, b in zip(times, times[1:]):
            if (b - a).total_seconds() >= gap:
                sizes.append(0)
            sizes[-1] += 1
        want[c] = sizes
    got = {}
    for r in silver.sessionise(df, gap).orderBy("customer_id", "start_time").collect():
        got.setdefault(r.customer_id, []).append(r.events)
    assert got == want


def test_malformed_csv_rows_are_quarantined(spark, tmp_path):
    (tmp_path / "o.csv").write_text(
        "order_id,line_no,product_id,quantity,list_price,unit_price,discount_pct,rating\n"
        "O1,1,P1,2,10.00,9.00,0.1,5\nO2,x,P1,2,10.00,9.00,0.1,5\n")
    df = readers.read_csv(spark, str(tmp_path / "o.csv"), schemas.ORDER_ITEMS, keep_corrupt=True)
    good, bad = readers.quarantine(df)
    assert [r.order_id for r in good.collect()] == ["O1"]
    assert bad.collect()[0][0].startswith("O2,x")


def test_export_normalise_nested_values(spark):
    df = spark.sql("""select date'2025-01-02' d, timestamp'2025-01-02 03:04:05' t, cast(1.5 as decimal(5,2)) x,
        double('NaN') n, double('Infinity') i, array(3.0D, double('NaN')) arr,
        named_struct('k', array(date'2024-05-01')) nested, cast(null as struct<a:date>) none""")
    r = sinks.export_normalise(df).collect()[0]
    assert r.d == "2025-01-02" and isinstance(r.t, dt.datetime) and r.x == 1.5
    assert r.n is None and r.i is None and r.arr == [3.0, None]
    assert r.nested.k == ["2024-05-01"] and r.none is None


def test_upsert_and_replace(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, s string, n int")
    updates = spark.createDataFrame([(2, None, 20, "x"), (3, "c", 30, "y")], "k int, s string, n int, e string")
    assert sorted(map(tuple, sinks.merge_upsert(target, updates, "k").collect())) == [
        (1, "a", 1, None), (2, "b", 20, "x"), (3, "c", 30, "y")]
    assert sinks.merge_upsert(target, updates, "k", insert=False).count() == 2
    replaced = sinks.replace_documents(target, updates.drop("e"), "k")
    assert sorted(map(tuple, replaced.collect())) == [(1, "a", 1), (2, None, 20), (3, "c", 30)]


def test_document_batches_reach_the_sink(spark, tmp_path):
    folder = str(tmp_path)

    def send(batch):
        import uuid
        with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
            f.write(str(len(batch)))

    sinks.foreach_document_batch(spark.range(25).repartition(2), send, "id", batch=10)
    sizes = [int(p.read_text()) for p in tmp_path.iterdir()]
    assert sum(sizes) == 25 and max(sizes) <= 10


def test_rare_duplicates_leave_the_same_survivors(spark):
    rng = random.Random(3)
    rows = [(k, rng.choice(["a", "b", None]), rng.choice([1, 2, None])) for k in [*range(60), *[rng.randrange(60) for _ in range(25)], *[7] * 40, None, None]]
    df = spark.createDataFrame(rows, "k int, v string, w int")
    key = lambda d: sorted(map(str, d.collect()))
    assert key(clean.dedupe_rare(df, ["k"])) == key(clean.dedupe(df, ["k"]))
    assert key(clean.dedupe_rare(df, ["k", "v"])) == key(clean.dedupe(df, ["k", "v"]))
    assert key(clean.dedupe_rare(df, ["k", "v", "w"])) == key(clean.dedupe(df, ["k", "v", "w"]))


def test_fact_rows_are_not_sorted_for_duplicates(spark):
    """Only repeated rows, those behind the semi join, reach the sorting aggregate."""
    df = spark.range(1000).selectExpr("id as k", "cast(id as string) as v").repartition(4)
    lines = clean.dedupe_rare(df, ["k"])._jdf.queryExecution().executedPlan().toString().splitlines()
    sorts = [i for i, line in enumerate(lines) if "SortAggregate" in line or " Sort " in line]
    semi = next(i for i, line in enumerate(lines) if "LeftSemi" in line)
    anti = next(i for i, line in enumerate(lines) if "LeftAnti" in line)
    assert sorts and all(anti < i < semi for i in sorts)


def _plain_sessions(rows, gap):
    """rows: (customer, seconds, event_id); sorted list of (customer, start, events, id)."""
    out, by = [], {}
    for c, t, e in rows:
        if c is None:
            out.append((None, t, 1, f"event-{e}"))
        else:
            by.setdefault(c, []).append(t)
    for c, times in by.items():
        no, last = 0, None
        for t in sorted(times):
            if last is None or t - last >= gap:
                no += 1
                out.append([c, t, 0, f"{c}-{no}"])
            out[-1][2] += 1
            last = t
    return sorted(map(tuple, out), key=str)


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_sessions_of_a_hot_customer_cross_ranges(spark, partitions):
    rng = random.Random(partitions)
    gap = 600
    hot = sorted(rng.sample(range(0, 900_000), 700))
    rows = [("hot", t) for t in hot] + [(f"c{rng.randrange(40)}", rng.randrange(20_000)) for _ in range(500)]
    rows += [(None, rng.randrange(5_000)) for _ in range(30)] + [("later", 10), ("later", 10 + gap), ("later", 9 + gap)]
    rows = [(c, t, i) for i, (c, t) in enumerate(rows)]
    df = spark.createDataFrame(rows, "customer_id string, t long, event_id int").selectExpr(
        "customer_id", "timestamp_seconds(t) as event_time", "event_id", "'product_view' as event_type", "'d' as device", "'s' as traffic_source")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = silver.sessionise(df, gap).selectExpr("customer_id", "unix_seconds(start_time) as t", "events", "session_id").collect()
        slots = df.filter("customer_id is not null").groupBy("customer_id", "event_time").agg(F.min("event_time").alias("start_time"))
        spread = silver.sorted_ranges(slots).filter("customer_id = 'hot'").select("_part").distinct().count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(map(tuple, found), key=str) == _plain_sessions(rows, gap)
    assert spread >= min(partitions, 4) // 2 + 1 if partitions > 1 else spread == 1


def test_upsert_rewrites_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = [(i, f"2024-0{1 + i % 5}", i * 1.0, "x") for i in range(100)] + [(500, None, 1.0, "n")]
    spark.createDataFrame(rows, "id int, month string, v double, note string").repartition("month").write.partitionBy("month").parquet(path)
    names = lambda: {str(f.relative_to(path)) for f in (tmp_path / "table").rglob("*.parquet")}
    before = names()
    updates = spark.createDataFrame(
        [(3, None, 30.0), (8, "2024-01", None), (900, "2024-07", 9.0), (901, "2024-02", 9.5), (901, "2024-02", 8.5), (500, None, 5.0)],
        "id int, month string, v double")
    sinks.upsert_partitions(spark, path, updates, "id", "month")
    after = names()
    assert {f for f in before if "2024-01" in f or "2024-03" in f or "2024-05" in f} == {f for f in after if "2024-01" in f or "2024-03" in f or "2024-05" in f}
    changed = {f.split("/")[0] for f in before ^ after}
    assert changed == {"month=2024-04", "month=2024-02", "month=2024-07", "month=__HIVE_DEFAULT_PARTITION__"}
    got = {r.id: (r.month, r.v, r.note) for r in spark.read.parquet(path).collect()}
    want = {i: (m, v, n) for i, m, v, n in rows} | {3: ("2024-04", 30.0, "x"), 900: ("2024-07", 9.0, None), 901: ("2024-02", 9.5, None), 500: (None, 5.0, "n")}
    assert got == want
    sinks.upsert_partitions(spark, path, updates.limit(0), "id", "month")
    sinks.upsert_partitions(spark, path, spark.createDataFrame([(7, "z"), (7777, "z")], "id int, note string"), "id", "month", insert=False)
    assert names() - after and spark.read.parquet(path).filter("note = 'z'").count() == 1 and spark.read.parquet(path).count() == len(want)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lake_prunes_periods_and_joins_without_shuffle(spark, tmp_path):
    from tradewind.plans.sample import Sample
    from tradewind.plans.silver import Lake, write_silver

    root = str(tmp_path / "lake")
    sample = Sample(spark, "/root/testdata/sf0.001")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    write_silver(spark, sample.silver, root)
    lake = Lake(spark, root)                                 # as another session would read it
    assert lake.orders.count() == sample.orders.count() and lake.lines.count() == sample.lines.count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lake.lines.select("order_id", "revenue").join(lake.orders.select("order_id", "net_amount"), "order_id")
        assert "Exchange" not in _plan(joined)
        per_order = lake.lines.groupBy("order_id").agg(F.sum("revenue"))
        assert "Exchange" not in _plan(per_order)
        staged = Sample(spark, "/root/testdata/sf0.001", staged=True)
        both = staged.lines.select("order_id", "revenue").join(staged.orders.select("order_id", "net_amount"), "order_id")
        assert "Exchange" not in _plan(both) and both.count() == joined.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    days = [F.lit(d).cast("date") for d in ("1996-03-05", "1996-04-02")]
    part = lake.period("orders", *days)
    plan = _plan(part)
    assert "PartitionFilters: [isnotnull(order_month" in plan and "order_month" in plan.split("PartitionFilters")[1]
    files = {f.split("order_month=")[1][:7] for f in part.inputFiles()}
    assert {r.order_month for r in part.select("order_month").distinct().collect()} <= {"1996-03", "1996-04"}
    assert part.count() == sample.orders.filter(F.col("order_date").between(*days)).count() > 0 and files
