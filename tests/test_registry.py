"""The registry contract, a sample of oracle comparisons, and invariance to the shuffle width."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

SMALL = "/root/testdata/sf0.001"
CHECKED = [
    "dq_report", "silver_orders", "sessions", "kpis", "sales_monthly", "campaign_uplift", "product_stats",
    "cohort_retention", "funnel_by_dimension", "holdout_split", "roc_curve", "daily_series_filled",
]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_returns_months(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[0] == "month"


@pytest.mark.parametrize("key", CHECKED)
def test_against_oracle(spark, key):
    assert compare(entry.queries()[key](spark, SMALL), connect(SMALL), entry.oracle_sql()[key]) == []


@pytest.mark.parametrize("partitions", [1, 4, 64])
def test_results_do_not_depend_on_partitions(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        con = connect(SMALL)
        for key in ("sales_monthly", "customer_profiles", "rfm_scores"):
            assert compare(entry.queries()[key](spark, SMALL), con, entry.oracle_sql()[key]) == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_totals_agree_across_grains(spark):
    q = entry.queries()
    total = lambda key, c="revenue": round(sum(r[c] or 0 for r in q[key](spark, SMALL).collect()), 2)
    assert total("sales_daily") == total("sales_monthly") == total("kpis")
    assert total("sales_by_category") == total("sales_daily_category") == total("sales_by_subcategory")


def test_concurrent_versions_are_all_kept(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.ml.feature import VectorAssembler

    from tradewind.sources.model_store import ModelStore

    root = str(tmp_path / "models")
    stores = [ModelStore(spark, root) for _ in range(2)]
    model = VectorAssembler(inputCols=["a"], outputCol="f")

    def write(i):
        return [stores[i].publish("m", "t", "alg", {"score": 10 * i + j, "gone": None}, {"i": i, "j": j}, model if j == 0 else None) for j in range(8)]

    with ThreadPoolExecutor(2) as pool:
        made = [v for part in pool.map(write, range(2)) for v in part]
    assert stores[0].versions("m") == sorted(made) and len(set(made)) == 16
    assert stores[1].pointer("m") == max(made)
    assert sorted(r.metrics["score"] for r in stores[0].records().collect()) == sorted(10.0 * i + j for i in range(2) for j in range(8))
    newest = stores[0].records(latest=True).collect()
    assert [r.version for r in newest] == [max(made)] and set(newest[0].params) == {"i", "j"}
    assert stores[0].load("m", VectorAssembler.load, min(made)).getOutputCol() == "f"
    stores[0].publish("other", "t", "alg", {"x": 1.0}, is_best=True)
    assert {(r.model, r.metric) for r in stores[1].metrics().collect()} == {("m", "score"), ("other", "x")}
    assert ModelStore(spark, str(tmp_path / "none")).records().count() == 0
    import os
    assert os.listdir(f"{root}/_staging") == [] or all(f.startswith(".") for f in os.listdir(f"{root}/_staging"))


def test_nothing_written_is_left_behind(tmp_path):
    """A whole application with staged silver, a written round trip and a stored model."""
    import subprocess
    import sys
    from pathlib import Path

    program = f"""
import sys
sys.path.insert(0, {str(Path(__file__).resolve().parent.parent)!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {str(tmp_path / "shared")!r})
         .config("spark.sql.shuffle.partitions", "2").config("spark.sql.warehouse.dir", {str(tmp_path / "warehouse")!r}).getOrCreate())
import __spark_entry__ as entry
for key in ("io_csv_roundtrip", "smearing"):
    entry.queries()[key](spark, {SMALL!r}).count()
spark.stop()
"""
    subprocess.run([sys.executable, "-c", program], check=True, cwd=tmp_path, timeout=300)
    left = [p for p in (tmp_path / "shared").iterdir() if any(f.is_file() for f in p.rglob("*")) and "-" in p.name and not _is_checkpoint(p)]
    assert left == []


def _is_checkpoint(path) -> bool:
    """Spark's own checkpoint folder of an application, named by a plain UUID."""
    import uuid

    try:
        return str(uuid.UUID(path.name)) == path.name
    except ValueError:
        return False
