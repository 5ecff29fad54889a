"""What the text operators share: shipping this package to executors, row functions over Arrow, hashing."""

from __future__ import annotations

import ctypes
import gc
import os
import sys
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

PACKAGE = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


BATCH_KEY, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once per application, so that their Python workers can import it, and
    lowers the session's bound of Arrow batches to BATCH_BYTES: a worker holds a few of them at a time."""
    bound = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(BATCH_KEY))
    if bound <= 0 or bound > BATCH_BYTES:
        spark.conf.set(BATCH_KEY, str(BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    target = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{PACKAGE.name}.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(PACKAGE.rglob("*.py")):
            z.write(p, p.relative_to(PACKAGE.parent))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


_kept: dict[str, Callable[[], None]] = {}


def keep_for(owner: str, forget: Callable[[], None]) -> None:
    """Says in a worker that `owner` now remembers things; what other operators left behind in it goes.  A worker is
    reused by one stage after another, and would else hold the memory of all of them."""
    others = [k for k in _kept if k != owner]
    for k in others:
        _kept.pop(k)()
    _kept[owner] = forget
    if others:
        gc.collect()
        release()


def release() -> None:
    """Gives memory that this process no longer uses back to the system."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def released(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """`work` over a task's batches, with `release` at its end: a worker waits for later tasks, and would hold
    this one's buffers meanwhile, beside those of the workers that are busy."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            release()

    return run


def row_function(
    spark: SparkSession, make: Callable[[], Callable], returns: str, rows: int | None = 1024,
) -> Callable[..., Column]:
    """A column function over Arrow batches.

    `make()` runs once per task on the executor and gives a function of one list per argument that
    returns a list of values.  Only the arguments travel to Python; every other column stays in the
    JVM.  At most `rows` rows of a batch (None: all) are Python values at a time.  It counts as nondeterministic, which keeps the optimizer from evaluating it twice.
    """
    ship(spark)
    kind = to_arrow_type(F.udf(lambda: None, returns).returnType)

    @released
    def run(batches: Iterator) -> Iterator[pa.Array]:
        work = make()
        for batch in batches:
            columns = batch if isinstance(batch, tuple) else (batch,)
            size = len(columns[0])
            step = rows or max(size, 1)
            done = [pa.array(work(*(c.slice(i, step).to_pylist() for c in columns)), kind) for i in range(0, size, step)]
            yield pa.concat_arrays(done) if done else pa.array([], kind)

    def one(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return run(batches)

    def several(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        return run(batches)

    one.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    several.__annotations__ = {"batches": Iterator[tuple[pa.Array, ...]], "return": Iterator[pa.Array]}
    single = F.arrow_udf(one, returns).asNondeterministic()
    many = F.arrow_udf(several, returns).asNondeterministic()
    return lambda *columns: single(*columns) if len(columns) == 1 else many(*columns)


def utf8(column: Column) -> Column:
    """The text's UTF-8 bytes; null stays null."""
    return column.cast("string").cast("binary")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that `df` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def crc_part(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo `parts`."""
    return F.crc32(key.cast("string").cast("binary")) % parts


_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


def mix64(x: np.ndarray) -> np.ndarray:
    """Scatters 64-bit values (the finaliser of a well-known public-domain hash)."""
    shift = np.uint64(33)
    x = x ^ (x >> shift)
    x = x * _MIX[0]
    x = x ^ (x >> shift)
    x = x * _MIX[1]
    return x ^ (x >> shift)


CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes `df` once as Parquet in the shared folder and reads it back: later stages and lost executors
    start from the files.  They are deleted by `discard`, or when the application ends.  The shuffle files of the write
    go with its end, as nothing reads them again."""
    from tradewind.sources.scratch import scratch_path

    spark = df.sparkSession
    path = scratch_path(spark, name)
    delete_at_end(spark, path)
    before = spark.conf.get(CLEANUP_KEY, None)
    spark.conf.set(CLEANUP_KEY, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP_KEY, before) if before is not None else spark.conf.unset(CLEANUP_KEY)
    made = spark.read.schema(df.schema).parquet(path)
    made.staged_at = path
    return made


def discard(*frames: DataFrame) -> None:
    """Deletes staged tables that nothing reads any more."""
    for df in frames:
        target = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.staged_at)
        target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


def delete_at_end(spark: SparkSession, path: str) -> None:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(conf)
    fs.mkdirs(target.getParent())
    fs.deleteOnExit(target)


HOT_KEYS = 1_000


def join_unique(rows: DataFrame, table: DataFrame, key: str, weight: str, how: str = "inner") -> DataFrame:
    """Joins `rows` with a table of unique keys (inner or left).  `weight` is the number of rows of a key, given in the
    table: keys with more than a thousandth of all rows, so fewer than HOT_KEYS, are broadcast and never shuffled together."""
    total = table.agg(F.sum(weight).alias("n"))
    is_hot = F.col(weight) * HOT_KEYS > total.scalar()
    hot = table.where(is_hot)
    return rows.join(F.broadcast(hot), key).unionByName(
        rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(table.where(~is_hot), key, how))


FILTER_BITS = 1 << 25  # 4 MB


def maybe_in(rows: DataFrame, column: str, values: DataFrame, among: bool = True) -> DataFrame:
    """`rows` whose value of a column may be among `values` (one column), or those whose value is surely not: a bitmap of fixed size passes over the rows, so that a join
    after it shuffles few of the others.  Its share grows with the values; the join drops what comes through by chance."""
    spark = rows.sparkSession
    slot = F.pmod(F.xxhash64(values.columns[0]), F.lit(FILTER_BITS))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (slot % 64).cast("int"))
    words = values.select(F.shiftright(slot, 6).alias("w"), bit.alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    table = np.zeros(FILTER_BITS // 64, np.int64)
    table[words.column("w").to_numpy()] = words.column("b").to_numpy()
    shared = spark.sparkContext.broadcast(table.view(np.uint64))

    def pick(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = shared.value
        for slots in batches:
            at = slots.to_numpy(zero_copy_only=False)
            yield pa.array((table[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool))

    pick.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    chosen = F.arrow_udf(pick, "boolean")
    met = chosen(F.pmod(F.xxhash64(column), F.lit(FILTER_BITS)))
    return rows.where(met if among else ~met)
