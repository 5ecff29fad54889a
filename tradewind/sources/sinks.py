"""Writers: Parquet lake, nested documents, CSV export, keyed upsert, export normalisation."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.sources.schemas import TIMESTAMP_FORMAT
from tradewind.sources.scratch import remove_path, scratch_path

DOCUMENT_BATCH = 2000


def write_lake(df: DataFrame, path: str, partition_by: str | None = None, compression: str | None = None) -> None:
    """Overwrites a Parquet table.

    With a partition column the rows are first clustered on it, so that each
    partition gets few large files; AQE splits a hot partition value over tasks.
    """
    if partition_by:
        (df.hint("rebalance", partition_by).write.mode("overwrite").partitionBy(partition_by).parquet(path, compression=compression))
    else:
        df.write.mode("overwrite").parquet(path, compression=compression)


def write_bucketed(
    df: DataFrame, path: str, partition_by: str | None, bucket_by: str, buckets: int, compression: str | None = None,
) -> DataFrame:
    """Writes a Parquet table in folders per partition value, if there is one to name, each in `buckets` files by the hash of a key, and reads it back.

    Filters on the partition column read only its folders; joins and groupings on the key need no shuffle between tables with the
    same number of buckets.  A bucket's task holds rows of one hash range only, so there is one file per folder and bucket."""
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, bucket_by).write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    ((writer.partitionBy(partition_by) if partition_by else writer)
     .bucketBy(buckets, bucket_by).sortBy(bucket_by).option("path", path).saveAsTable(name))
    return spark.table(name)


def read_bucketed(spark: SparkSession, path: str, partition_by: str, bucket_by: str, buckets: int) -> DataFrame:
    """The same table in a session that didn't write it."""
    name = f"bucketed_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{c}` {t}" for c, t in spark.read.parquet(path).dtypes)
    spark.sql(f"""CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (`{partition_by}`)
        CLUSTERED BY (`{bucket_by}`) SORTED BY (`{bucket_by}`) INTO {buckets} BUCKETS LOCATION '{path}'""")
    spark.catalog.recoverPartitions(name)
    return spark.table(name)


def _export(dtype: T.DataType, c: Column) -> Column:
    if isinstance(dtype, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(dtype, T.DecimalType):
        return c.cast("double")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        bad = F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
        return F.when(~bad, c.cast("double"))
    if isinstance(dtype, VectorUDT):
        return _export(T.ArrayType(T.DoubleType()), vector_to_array(c))
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: _export(dtype.elementType, x))
    if isinstance(dtype, T.MapType):
        return F.transform_values(
            F.transform_keys(c, lambda k, v: _export(dtype.keyType, k)),
            lambda k, v: _export(dtype.valueType, v))
    if isinstance(dtype, T.StructType):
        inner = F.struct(*[_export(f.dataType, c.getField(f.name)).alias(f.name) for f in dtype.fields])
        return F.when(c.isNotNull(), inner)
    return c


def export_normalise(df: DataFrame) -> DataFrame:
    """Document-safe values: dates as ISO text, decimals as doubles, NaN/Inf as null,
    vectors as arrays; applied inside arrays, maps and structs.  Timestamps stay."""
    return df.select(*[_export(f.dataType, F.col(f"`{f.name}`")).alias(f.name) for f in df.schema.fields])


def to_documents(df: DataFrame, id_col: str | None = None) -> DataFrame:
    """Normalised rows with the key repeated as `_id`, ready for a document store."""
    out = export_normalise(df)
    return out.select(F.col(id_col).alias("_id"), "*") if id_col else out


def write_documents(df: DataFrame, path: str, id_col: str | None = None, drop_first: bool = True, compression: str | None = None) -> None:
    """Nested documents as JSON lines, one file per task."""
    to_documents(df, id_col).write.mode("overwrite" if drop_first else "append").json(path, compression=compression)


def foreach_document_batch(
    df: DataFrame, send: Callable[[list[Row]], None], id_col: str | None = None, batch: int = DOCUMENT_BATCH,
) -> None:
    """Hands every partition's documents to a custom sink in batches; runs on the executors."""

    def push(rows: Iterator[Row]) -> None:
        pending = []
        for row in rows:
            pending.append(row)
            if len(pending) == batch:
                send(pending)
                pending = []
        if pending:
            send(pending)

    to_documents(df, id_col).foreachPartition(push)


def merge_upsert(target: DataFrame, updates: DataFrame, key: str, insert: bool = True, order: str | None = None) -> DataFrame:
    """Sets the updates' non-null fields on matching rows; unmatched updates are inserted
    (`insert=True`, full outer join) or ignored (`insert=False`, left join).  Of several updates to a
    key the one with the greatest `order` counts; without it, the one whose JSON form is greatest."""
    fresh = [c for c in updates.columns if c != key]
    fields = F.struct(*[F.col(c) for c in fresh])
    renamed = updates.groupBy(key).agg(F.max_by(fields, F.col(order) if order else F.to_json(fields)).alias("_new")).select(
        key, *[F.col(f"_new.{c}").alias(f"_new_{c}") for c in fresh])
    joined = target.join(renamed, key, "full" if insert else "left")
    out = [
        F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in fresh else F.col(c) for c in target.columns
    ]
    out += [F.col(f"_new_{c}").alias(c) for c in fresh if c not in target.columns]
    return joined.select(*out)


def upsert_partitions(spark: SparkSession, path: str, updates: DataFrame, key: str, partition_by: str, insert: bool = True) -> None:
    """Merges updates into a Parquet table that is partitioned by a column, rewriting only the partitions that hold updated keys.

    An updated row stays in its partition; a new one goes to the partition that its update names (its column
    may be missing if `insert` is false).  The keys of the table, not its rows, are read to find the partitions;
    their merged rows are written aside first, so a failed merge leaves the table as it was."""
    table = spark.read.parquet(path)
    known = table.join(updates.select(key).distinct(), key, "left_semi").select(key, partition_by)
    touched = known.select(partition_by)
    if insert:
        fresh = updates.join(known.select(key), key, "left_anti")
        touched = touched.unionByName(fresh.select(F.col(partition_by).cast(dict(table.dtypes)[partition_by]).alias(partition_by)))
    values = [r[0] for r in touched.distinct().collect()]        # names of partitions, never rows
    if not values:
        return
    named = [v for v in values if v is not None]
    inside = F.col(partition_by).isin(named) if named else F.lit(False)
    if len(named) < len(values):
        inside = inside | F.col(partition_by).isNull()
    part = table.filter(inside)
    changes = updates.drop(partition_by) if partition_by in updates.columns else updates
    merged = merge_upsert(part, changes, key, insert=False)
    if insert:
        missing = [c for c in merged.columns if c not in fresh.columns]
        one = merge_upsert(fresh.select(key, partition_by).limit(0), fresh, key).select(*fresh.columns)
        merged = merged.unionByName(one.withColumns({c: F.lit(None).cast(dict(merged.dtypes)[c]) for c in missing}))
    aside = scratch_path(spark, "upsert")
    merged.write.parquet(aside)
    try:
        (spark.read.parquet(aside).repartition(partition_by).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path))
    finally:
        remove_path(spark, aside)


def replace_documents(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Replaces whole rows by key and inserts new ones (both frames share the columns)."""
    kept = target.join(updates.select(key), key, "left_anti")
    return kept.unionByName(updates, allowMissingColumns=True)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; spaces inside values are kept."""
    (df.write.mode("overwrite").option("header", True).option("timestampFormat", TIMESTAMP_FORMAT)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
