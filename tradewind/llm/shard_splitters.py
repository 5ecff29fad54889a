"""Sharding by sampled splitters, with DataFrame functions only.

Records are ordered by (hash of the text, hash of the id).  A size-weighted sample of these keys gives the splitters of
many ranges, each of about `range_rows` records; a range that turns out overfull gets splitters of its own
from a denser sample of it.  The ranges' exact sizes are summed, each range then ranks its own records, and
a record's exact place in the order of all bytes decides its shard: law `bytes`, shard sizes near equal.
Records of one text are neighbours in that order and stay in one shard (that of their middle) while their
group is at most `whole_share` of a shard; larger groups are cut.  No range, and so no task, holds a hot text
whole: its ids are split as well.

Size: UTF-8 bytes of the text (null: none) plus 1.  Slots number each shard's records from 0 without gaps.
Repeated rows are interchangeable.  An empty table gives an empty result.  Sampling
only balances the ranges: the result does not depend on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewind.llm.common import staged

SHARDS = 8
RANGE_ROWS = 4_000
MAX_RANGES = 16_384  # bound of the splitters that every task gets; beyond it ranges hold more rows each
SAMPLES_PER_RANGE = 24
WHOLE_SHARE = 0.005


def keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32 and the order key (h, d) of every record, without its text."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(
        F.col(doc_id).alias("doc_id"), (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"), F.xxhash64(body).alias("h"), F.xxhash64(F.col(doc_id)).alias("d"))


def _sample(rows: DataFrame, per_byte: float, seed: int, every: int) -> list[tuple[int, int]]:
    """Quantiles of the keys of a sample: a record is drawn with probability size x `per_byte`, by a hash of its key.
    Only every `every`-th key of the sorted sample is kept; their number is bounded by that of the ranges."""
    uniform = F.pmod(F.xxhash64("h", "d", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    keys = F.sort_array(F.collect_set(F.struct("h", "d")))
    drawn = rows.where(uniform < F.col("size") * F.lit(per_byte)).agg(keys.alias("k")).select(
        F.filter("k", lambda k, i: i % every == every - 1).alias("k"))
    return [(k.h, k.d) for k in drawn.first().k]


def _range_of(splitters: list[tuple[int, int]]) -> Column:
    """Number of splitters at or below a record's key, by binary search in a literal array."""
    if not splitters:
        return F.lit(0)
    h = F.expr("array(" + ",".join(f"{k}L" for k, _ in splitters) + ")")
    d = F.expr("array(" + ",".join(f"{k}L" for _, k in splitters) + ")")
    size = len(splitters)
    steps = F.array(*[F.lit(1 << b) for b in range(size.bit_length(), -1, -1)])

    def reached(at: Column) -> Column:
        own = F.try_element_at(h, at)
        return (own < F.col("h")) | ((own == F.col("h")) & (F.try_element_at(d, at) <= F.col("d")))

    return F.aggregate(steps, F.lit(0), lambda at, step: F.when((at + step <= size) & reached(at + step), at + step).otherwise(at))


def shard(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text",
          range_rows: int = RANGE_ROWS, whole_share: float = WHOLE_SHARE) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every record."""
    rows = staged(keyed(docs, doc_id, text), "shard-keys")  # texts are read once; all else runs on narrow rows
    count, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    if not count:
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("bigint").alias("slot"))
    ranges = max(1, min(MAX_RANGES // 2, -(-count // range_rows)))
    target = total / ranges

    # first splitters, then more of them inside overfull ranges
    first = _sample(rows, SAMPLES_PER_RANGE / target, 1, SAMPLES_PER_RANGE)
    sized = rows.withColumn("r", _range_of(first)).groupBy("r").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    overfull = [r.r for r in sized.where(((F.col("bytes") > 2 * target) | (F.col("n") > 2 * count / ranges)) & (F.col("n") > 1)).collect()]
    splitters = set(first)
    if overfull:
        inside = rows.where(_range_of(first).isin(overfull))
        splitters |= set(_sample(inside, 4 * SAMPLES_PER_RANGE / target, 2, 2 * SAMPLES_PER_RANGE))
    # a row per range, so the running sums over ranges below are bounded
    placed = rows.withColumn("r", _range_of(sorted(splitters)))
    order = [F.col("h"), F.col("d"), F.col("doc_id").asc_nulls_first()]
    ends = placed.groupBy("r").agg(F.sum("size").alias("bytes"))
    earlier = Window.orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ends.select("r", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_before"))
    within = Window.partitionBy("r").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ranked = staged(placed.join(F.broadcast(offsets), "r").withColumn(
        "before", F.col("bytes_before") + F.sum("size").over(within) - F.col("size")).drop("bytes_before"), "shard-order")
    # records of one text go by the middle of their group, unless it is large
    groups = ranked.groupBy("h").agg(
        F.min("before").alias("group_start"), F.sum("size").alias("group_bytes"), F.count("*").alias("copies"))
    whole = F.col("group_bytes") <= whole_share * total / shards
    # at most shards / whole_share texts are larger; their records are dealt out, as they need no partner
    large = groups.where(~whole).select("h", F.lit(True).alias("large"))
    together = groups.where((F.col("copies") > 1) & whole).drop("copies").withColumn("deal", F.lit(0).cast("bigint"))
    dealt = ranked.join(F.broadcast(large), "h", "left").withColumn(
        "deal", F.when(F.col("large"), 1 + F.pmod("d", F.lit(1 << 20))).otherwise(0)).drop("large")
    middle = F.coalesce(F.col("group_start") + F.col("group_bytes") / 2, F.col("before") + F.col("size") / 2)
    sharded = dealt.join(together, ["h", "deal"], "left").withColumn(
        "shard", F.least(F.lit(shards - 1), F.floor(middle * shards / total)).cast("int")).drop("group_start", "group_bytes")
    # slots: records are numbered within (shard, range); the ranges' first slots are bounded running sums
    parts = sharded.groupBy("shard", "r").agg(F.count("*").alias("n"))
    run = Window.partitionBy("shard").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("shard", "r", F.coalesce(F.sum("n").over(run), F.lit(0)).alias("base"))
    place = Window.partitionBy("r", "shard").orderBy(*order)
    return sharded.join(F.broadcast(bases), ["shard", "r"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("base") + F.row_number().over(place) - 1).alias("slot"))
