"""The session rollup as a stream: new event files in, finished sessions out.

Same result as the batch `sessionise` for events that arrive within the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from tradewind.functions.exprs import flag
from tradewind.operators.clean import valid_events
from tradewind.sources import schemas


def read_event_stream(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """Event logs (JSON lines) picked up as files arrive."""
    return (
        spark.readStream.schema(schemas.EVENTS).option("timestampFormat", schemas.TIMESTAMP_FORMAT)
        .option("maxFilesPerTrigger", files_per_batch).json(path))


def clean_stream(events: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Normalised event types, duplicates dropped inside the watermark, invalid events removed."""
    tidy = events.withColumn("event_type", F.lower(F.trim("event_type"))).withWatermark("event_time", lateness)
    return valid_events(tidy.dropDuplicatesWithinWatermark(["event_id"]))


def stream_sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Sessions per customer, emitted once the watermark has passed their end (append mode)."""
    kind = F.col("event_type")
    rolled = events.groupBy("customer_id", F.session_window("event_time", gap)).agg(
        F.min("event_time").alias("start_time"), F.max("event_time").alias("end_time"),
        F.count("*").alias("events"), F.sum(flag(kind == "product_view")).alias("product_views"),
        F.max(flag(kind == "add_to_cart")).alias("has_cart"),
        F.max(flag(kind == "checkout")).alias("has_checkout"),
        F.max(flag(kind == "purchase")).alias("has_purchase"))
    return rolled.drop("session_window").withColumns({
        "duration_sec": F.unix_timestamp("end_time") - F.unix_timestamp("start_time"),
        "has_view": flag(F.col("product_views") > 0), "is_bounce": flag(F.col("events") == 1),
        "session_date": F.to_date("start_time")})


STATE = "closed bigint, sessions string"
SESSIONS = (
    "session_id string, customer_id {kind}, start_time timestamp, end_time timestamp, events bigint, product_views bigint,"
    " has_cart int, has_checkout int, has_purchase int, device string, traffic_source string")


def stream_identified_sessions(events: DataFrame, gap_seconds: int = 1800) -> DataFrame:
    """Finished sessions with what the batch operator gives them: the customer's session number, and device and source of the first event.

    `events` has a watermark (`clean_stream`).  A customer's state is the number of closed sessions and the open ones as
    summaries: an event joins those it is nearer to than the gap, late events too, and may merge two.  When the watermark has
    passed a session's end by the gap, nothing can join it any more; it gets the next number and is emitted, so numbers follow time
    as in the batch.  State is as large as the sessions within the watermark's lateness, whatever a customer's history.
    """
    kind = dict(events.dtypes)["customer_id"]
    schema = SESSIONS.format(kind=kind)
    gap = gap_seconds * 1_000_000

    def close(key, batches, state):
        import json

        import numpy as np
        import pandas as pd

        closed, stored = state.get if state.exists else (0, "[]")
        # start, end, events, views, cart, checkout, purchase, [event id, device, source] of the first event, in microseconds
        open_ = [tuple(x) for x in json.loads(stored)]
        for pdf in batches:
            times = pdf["event_time"].to_numpy().astype("datetime64[us]").astype(np.int64)
            kinds = pdf["event_type"].to_numpy()
            for t, what, *first in zip(times.tolist(), kinds, pdf["event_id"], pdf["device"], pdf["traffic_source"]):
                first = [None if x is None or x != x else x.item() if hasattr(x, "item") else x for x in first]
                open_.append((t, t, 1, int(what == "product_view"), *(int(what == k) for k in ("add_to_cart", "checkout", "purchase")), first))
        open_.sort(key=lambda x: (x[0], str(x[7][0])))
        merged = []
        for x in open_:
            if merged and x[0] - merged[-1][1] < gap:
                a = merged[-1]
                first = min((a[0], a[7]), (x[0], x[7]), key=lambda f: (f[0], f[1][0]))[1]
                merged[-1] = (a[0], max(a[1], x[1]), a[2] + x[2], a[3] + x[3], *(max(p, q) for p, q in zip(a[4:7], x[4:7])), first)
            else:
                merged.append(x)
        mark = state.getCurrentWatermarkMs() * 1000
        done = [x for x in merged if x[1] + gap <= mark]
        left = merged[len(done):]
        rows = [(f"{key[0]}-{closed + i}", key[0], x[0], x[1], *x[2:7], x[7][1], x[7][2]) for i, x in enumerate(done, 1)]
        if left:
            state.update((closed + len(done), json.dumps(left)))
            state.setTimeoutTimestamp(max(left[0][1] + gap, mark + 1000) // 1000 + 1)
        else:
            # the count stays, or numbers would start again
            state.update((closed + len(done), "[]"))
        names = [c.strip().split(" ")[0] for c in schema.split(",")]
        out = pd.DataFrame(rows, columns=names)
        for c in ("start_time", "end_time"):
            out[c] = pd.to_datetime(out[c].astype("int64"), unit="us")
        yield out

    columns = ["customer_id", "event_id", "event_time", "event_type", "device", "traffic_source"]
    known = events.filter(F.col("customer_id").isNotNull()).select(*columns).groupBy("customer_id").applyInPandasWithState(
        close, schema, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    is_kind = lambda k: flag(F.col("event_type") == k)
    alone = events.filter(F.col("customer_id").isNull()).select(
        F.concat_ws("-", F.lit("event"), F.col("event_id").cast("string")).alias("session_id"), "customer_id",
        F.col("event_time").alias("start_time"), F.col("event_time").alias("end_time"), F.lit(1).cast("bigint").alias("events"),
        is_kind("product_view").cast("bigint").alias("product_views"), is_kind("add_to_cart").alias("has_cart"),
        is_kind("checkout").alias("has_checkout"), is_kind("purchase").alias("has_purchase"), "device", "traffic_source")
    return known.union(alone).withColumns({
        "duration_sec": F.unix_timestamp("end_time") - F.unix_timestamp("start_time"),
        "has_view": flag(F.col("product_views") > 0), "is_bounce": flag(F.col("events") == 1),
        "session_date": F.to_date("start_time")})
