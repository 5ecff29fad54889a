"""Streamed sessions equal batch sessions once the watermark has passed them."""

from __future__ import annotations

import datetime as dt
import json
import random

from tradewind.operators import silver
from tradewind.operators.clean import clean_events
from tradewind.sources import readers, schemas
from tradewind.streaming import sessions


def test_stream_equals_batch(spark, tmp_path):
    base = dt.datetime(2025, 1, 1)
    rows = []
    for i in range(60):
        t = base + dt.timedelta(minutes=7 * i + (50 if i > 30 else 0))
        rows.append({"event_id": f"E{i}", "session_id": "x", "customer_id": f"C{i % 3}", "event_time": str(t),
                     "event_type": " Product_View" if i % 2 else "add_to_cart", "product_id": "P1",
                     "device": "Desktop", "traffic_source": "Email", "order_id": None})
    closing = dict(rows[-1], event_id="Z", customer_id="Z", event_time="2025-03-01 00:00:00", event_type="purchase")
    folder = tmp_path / "events"
    folder.mkdir()
    for n, part in enumerate((rows[:30] + rows[:2], rows[30:], [closing], [dict(closing, event_id="Z2")])):
        (folder / f"{n}.jsonl").write_text("\n".join(json.dumps(r) for r in part))
    stream = sessions.stream_sessions(
        sessions.clean_stream(sessions.read_event_stream(spark, str(folder), files_per_batch=1)), "30 minutes")
    query = stream.writeStream.outputMode("append").format("memory").queryName("finished").option(
        "checkpointLocation", str(tmp_path / "state")).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    cols = ["customer_id", "start_time", "end_time", "events", "product_views", "has_cart", "duration_sec", "is_bounce"]
    got = sorted(map(tuple, spark.table("finished").select(*cols).collect()))
    batch = silver.sessionise(clean_events(readers.read_json_lines(spark, str(folder), schemas.EVENTS)), 1800)
    want = sorted(map(tuple, batch.filter("customer_id <> 'Z'").select(*cols).collect()))
    assert got == want and len(want) > 3


def test_identified_sessions_equal_batch_with_late_events(spark, tmp_path):
    rng = random.Random(11)
    base = dt.datetime(2025, 1, 1)
    rows = []
    for i in range(240):
        customer = rng.choice(["A", "B", "C", None])
        t = base + dt.timedelta(minutes=rng.randrange(0, 4 * 24 * 60))
        rows.append({"event_id": f"E{i:04}", "session_id": "x", "customer_id": customer, "event_time": str(t),
                     "event_type": rng.choice(["product_view", "add_to_cart", "checkout", "purchase"]), "product_id": "P1",
                     "device": rng.choice(["Desktop", "Mobile App"]), "traffic_source": rng.choice(["Email", "Direct"]), "order_id": None})
    rows.sort(key=lambda r: r["event_time"])
    parts = [rows[i : i + 40] for i in range(0, 240, 40)]
    for a, b in zip(parts, parts[1:]):                        # late events: some come with the next files
        for _ in range(4):
            b.append(a.pop(rng.randrange(20, len(a))))
    closing = [dict(rows[-1], event_id=f"Z{n}", customer_id="Z", event_time=f"2025-0{n + 3}-01 00:00:00") for n in range(3)]
    folder = tmp_path / "events"
    folder.mkdir()
    for n, part in enumerate([*parts, *([c] for c in closing)]):
        (folder / f"{n:02}.jsonl").write_text("\n".join(json.dumps(r) for r in part))
    events = sessions.clean_stream(sessions.read_event_stream(spark, str(folder), files_per_batch=1), "2 days")
    query = sessions.stream_identified_sessions(events, 1800).writeStream.outputMode("append").format("memory").queryName(
        "identified").option("checkpointLocation", str(tmp_path / "state")).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    cols = ["session_id", "customer_id", "start_time", "end_time", "events", "product_views", "has_view", "has_cart", "has_checkout",
            "has_purchase", "device", "traffic_source", "duration_sec", "is_bounce", "session_date"]
    got = sorted(map(tuple, spark.table("identified").filter("customer_id is null or customer_id <> 'Z'").select(*cols).collect()), key=str)
    batch = silver.sessionise(clean_events(readers.read_json_lines(spark, str(folder), schemas.EVENTS)), 1800)
    want = sorted(map(tuple, batch.filter("customer_id is null or customer_id <> 'Z'").select(*cols).collect()), key=str)
    assert len(want) > 100 and got == want
