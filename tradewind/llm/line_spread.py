"""Removal of lines that spread over many sites, with DataFrame functions only.

One HyperLogLog sketch of the sites per line hash is built map-side and merged by the aggregation.  Lines
whose estimate is clear of the threshold are decided by it; for lines near it the distinct sites are
counted exactly.  A boilerplate line stays where it occurs first (smallest document id, then smallest
position) and goes from everywhere else.

Lines are what `\\n` separates; those without a word `[^\\x20\\x09-\\x0D]+` are never boilerplate.  Null sites
count as one site, null texts have no lines and stay null, a text that loses all lines becomes empty.
Repeated rows (same id and text) are treated alike.
Sketch width and band: at `LG_K` the estimate's standard error is about 1 %, the band is five of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import fresh

MIN_SITES = 8
LG_K = 13
NEAR = 0.05


def lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", site: str = "source") -> DataFrame:
    """doc_id, text_hash, site, pos and line hash h of every line with a word."""
    body = F.col(text).cast("string")
    cut = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(site)).alias("site"),  # sketches skip empty strings
        F.xxhash64(body).alias("text_hash"), F.posexplode(F.split(body, "\n", -1)).alias("pos", "line"))
    return cut.where(F.col("line").rlike(r"[^\x20\x09-\x0D]")).select(
        "doc_id", "text_hash", "site", "pos", F.xxhash64("line").alias("h"))


def boilerplate(rows: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K, near: float = NEAR) -> DataFrame:
    """h and first place of the lines that occur on at least `min_sites` sites."""
    spread = rows.groupBy("h").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", lg_k)).alias("sites"),
        F.min(F.struct("doc_id", "pos", "text_hash")).alias("first"))
    high = spread.where(F.col("sites") >= min_sites * (1 - near))
    clear = high.where(F.col("sites") > min_sites * (1 + near)).select("h", "first")
    close = high.where(F.col("sites") <= min_sites * (1 + near)).select("h", "first")
    exact = (
        rows.select("h", "site").join(close.select("h"), "h", "left_semi").distinct()
        .groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= min_sites).select("h"))
    return clear.unionByName(close.join(exact, "h", "left_semi"))


def drop_spread_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", site: str = "source",
    min_sites: int = MIN_SITES, counts: tuple[str, str] | None = None,
) -> DataFrame:
    """`docs` without the repeats of boilerplate lines.  `counts` names columns for the number of lines before,
    and of lines removed."""
    rows = lines(docs, doc_id, text, site)
    known = boilerplate(rows, min_sites)
    place = F.struct("doc_id", "pos", "text_hash")
    gone = (
        rows.drop("site").join(known, "h").where(~place.eqNullSafe(F.col("first")))
        .groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("gone")))
    id_, hash_, gone_ = fresh(docs, "_line_doc"), fresh(docs, "_line_text"), fresh(docs, "_line_gone")
    gone = gone.select(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_), F.col("gone").alias(gone_))
    body = F.col(text).cast("string")
    joined = docs.join(gone, F.col(doc_id).eqNullSafe(F.col(id_)) & (F.xxhash64(body) == F.col(hash_)), "left")
    cut = F.split(body, "\n", -1)
    kept = F.array_join(F.filter(cut, lambda line, i: ~F.array_contains(F.col(gone_), i)), "\n")
    new = F.when(F.col(gone_).isNull(), body).otherwise(kept)
    if counts:
        n_lines: Column = F.coalesce(F.size(cut), F.lit(0)) if text else F.lit(0)
        joined = joined.withColumn(counts[0], F.when(body.isNull(), 0).otherwise(n_lines).cast("bigint")).withColumn(
            counts[1], F.when(F.col(gone_).isNull(), 0).otherwise(F.size(gone_)).cast("bigint"))
    return joined.withColumn(text, new).drop(id_, hash_, gone_)
