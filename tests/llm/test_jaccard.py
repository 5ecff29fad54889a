"""Small blocks and candidate texts of the Jaccard join."""

from __future__ import annotations

import types

import numpy as np
from pyspark.sql import functions as F

from tradewind.llm import jaccard_join as jj


def block(seed, n):
    """Rows as `across` gives them: second, size, component, node, bitmap, leading shingles, home; by size."""
    rng = np.random.default_rng(seed)
    pool, rows = rng.integers(0, 2**64, 700, dtype=np.uint64), []
    base = pool[:600]
    for k in range(n):
        size = int(rng.choice([20, 60, 130, 600]))
        h = np.unique(np.concatenate((base[: size - 2], rng.choice(pool[600:], int(rng.integers(0, 4))))))
        bits = jj.folded(jj.bitmap(h), jj.SMALL)
        leading = np.sort(h.view(np.int64)[: size // 10 + 1])[: jj.LEADING]
        rows.append((bool(rng.integers(2)), len(h), int(rng.integers(4)), k, bits.tobytes(), leading.tobytes(), bool(rng.integers(4))))
    return sorted(rows, key=lambda r: (r[1], r[3]))


def test_small_blocks_keep_every_pair_that_the_bounds_allow():
    total = 0
    for seed in range(30):
        rows = block(seed, 12)
        for tile in ((2**62, 0, 0, 0), (-(2**61), 0, 0, 1)):
            expected = []
            for a, x in enumerate(rows):
                for y in rows[a + 1 :]:
                    if y[1] > x[1] * 100 // 90 or not y[6] or y[2] == x[2] or (tile[2] != tile[3] and x[0] == y[0]):
                        continue
                    mine, theirs = np.frombuffer(x[4], np.uint64), np.frombuffer(y[4], np.uint64)
                    apart = int(np.bitwise_count(mine ^ jj.folded(theirs, len(mine))).sum())
                    first = {k for k in np.frombuffer(x[5], np.int64).tolist() if k < tile[0]}
                    if (x[1] + y[1] - apart) // 2 >= jj.least_overlap(x[1], y[1], 90, 100) and not first & set(np.frombuffer(y[5], np.int64).tolist()):
                        expected.append((x[3], y[3]))
            found = list(zip(*jj._close_few(tile, rows, 90, 100)))
            assert found == expected
            total += len(expected)
    assert total


def test_texts_of_candidates_are_dealt_once(spark):
    """Texts meet their owners by row name; dropping repeated rows needs no second shuffle of them."""
    docs = spark.createDataFrame([("1:a", b"x y z"), ("1:a", b"x y z"), ("2:b", b"u v w"), ("3:c", None)], "row string, text binary")
    owners = spark.createDataFrame([(11, "1:a"), (12, "2:b")], "node bigint, row string").repartition(2)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = jj._Search._texts(types.SimpleNamespace(spark=spark), docs, owners)
        assert sorted(r.node for r in found.select("node", F.length("packed").alias("n")).collect()) == [11, 12]
        assert "hashpartitioning(node" not in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
