"""Token ids as binary files: frequency-ranked, byte-aligned, with control bytes apart from the data.

Texts are tokenised once; their ids are staged, and what follows reads those.  The frequency of every id over
the whole corpus ranks the ids, so frequent ones have small numbers.  A rank
takes one to four bytes; one control byte holds the lengths of four ranks (two bits each).  Control bytes and
data bytes are separate streams, which lets numpy decode both by table lookup without a loop over ids.

File (all integers little-endian), one per range of doc_id:
  magic `TWID0001`, then blocks until the end:
  u32 documents, u64 ids, u64 control bytes, u64 data bytes,
  i64 doc_id per document, u8 per document (1: doc_id is null), u32 ids per document,
  control bytes, data bytes
`ranks.bin` beside them: u32 id of every rank.

Files are written under another name and moved into place when complete, so a task that runs twice leaves
one whole file with the same content.  Documents are in ascending doc_id order over the files (null first;
equal ones by the first HEAD characters of their texts, then by their ids' bytes).  Null texts count as empty; every document ends with `end_id`, so none has no ids.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import byte_bpe
from tradewind.llm.common import row_function, ship, staged

MAGIC = b"TWID0001"
BLOCK_IDS = 1 << 20
HEAD = 64  # characters of a text that order documents of the same doc_id, ahead of its ids
_HEAD = struct.Struct("<IQQQ")
MANIFEST = "part int, path string, n_docs bigint, n_ids bigint"

# lengths of the four ranks of each control byte
_LENGTHS = np.array([[(c >> (2 * k) & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)
_SUMS = _LENGTHS.sum(1).astype(np.int64)


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit ranks."""
    ranks = ranks.astype("<u4", copy=False)
    code = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    padded = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    padded[: len(ranks)] = code
    four = padded.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) <= code[:, None]]
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n].astype(np.int64)
    start = np.cumsum(lengths) - lengths
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    out = raw[start].astype(np.uint32)
    for k in range(1, 4):
        more = np.flatnonzero(lengths > k)
        out[more] |= raw[start[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path else pafs.FileSystem.from_uri("file://" + path.removeprefix("file:"))


def _read(path: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """doc_ids, null marks, ids per document and ranks, block by block."""
    fs, own = _store(path)
    with fs.open_input_stream(own) as f:
        if f.read(len(MAGIC)) != MAGIC:
            raise ValueError(f"{path} isn't a token file")
        while head := f.read(_HEAD.size):
            docs, ids, controls, data = _HEAD.unpack(head)
            doc_ids = np.frombuffer(f.read(8 * docs), "<i8")
            null = np.frombuffer(f.read(docs), np.uint8)
            sizes = np.frombuffer(f.read(4 * docs), "<u4")
            yield doc_ids, null, sizes, unpack(f.read(controls), f.read(data), ids)


def _write_block(f, doc_ids: list, parts: list[np.ndarray], rank_of_id: np.ndarray) -> None:
    ranks = rank_of_id[np.concatenate(parts)]
    control, data = pack(ranks)
    f.write(_HEAD.pack(len(parts), len(ranks), len(control), len(data)))
    f.write(np.array([d or 0 for d in doc_ids], "<i8").tobytes())
    f.write(np.array([d is None for d in doc_ids], np.uint8).tobytes())
    f.write(np.array([len(p) for p in parts], "<u4").tobytes())
    f.write(control)
    f.write(data)


def _coded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, head (the text's first HEAD characters) and compressed ids of every row; each text is tokenised here, once."""
    def make():
        own = byte_bpe.words(path)
        kind, press = _packed_as(own.size), zstandard.ZstdCompressor(level=1).compress
        return lambda texts: [
            press(np.frombuffer(ids, "<u4").astype(kind).tobytes()) for ids in own.ids_of_texts([t or "" for t in texts])]

    packed = row_function(docs.sparkSession, make, "binary")(F.col("text"))
    return docs.select("doc_id", F.substring("text", 1, HEAD).alias("head"), packed.alias("packed"))


def _packed_as(size: int) -> str:
    """The integers that ids of a vocabulary of this size are kept as between tokenising and writing."""
    return "<u2" if size <= 1 << 16 else "<u4"


def _id_counts(coded: DataFrame, size: int, end_id: int) -> np.ndarray:
    """How often the corpus has each id; as many numbers as the vocabulary has entries."""
    def count(batches):
        total, unpress = np.zeros(size, np.int64), zstandard.ZstdDecompressor().decompress
        for batch in batches:
            column = batch.column(0)
            total += np.bincount(np.frombuffer(b"".join(map(unpress, column.to_pylist())), _packed_as(size)), minlength=size)
            total[end_id] += len(column)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["id", "n"])

    found = coded.select("packed").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(size, np.int64)
    counts[found.column("id").to_numpy()] = found.column("n").to_numpy()
    return counts


def write_tokens(
    docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text", path: str | None = None, end_id: int = 0,
) -> DataFrame:
    """Writes the files and returns their manifest, in order: part, path, n_docs, n_ids, and `start`, the number of ids
    in the files before.  One row per file."""
    spark = docs.sparkSession
    ship(spark)
    path = path or byte_bpe.default_path()
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    size = byte_bpe.words(path).size
    coded = staged(_coded(rows, path), "coded-texts")
    counts = _id_counts(coded, size, end_id)
    id_of_rank = np.argsort(-counts, kind="stable").astype("<u4")
    rank_of_id = np.empty(len(id_of_rank), np.uint32)
    rank_of_id[id_of_rank] = np.arange(len(id_of_rank), dtype=np.uint32)
    fs, own = _store(folder)
    fs.create_dir(own, recursive=True)
    with fs.open_output_stream(f"{own}/ranks.bin") as f:
        f.write(id_of_rank.tobytes())
    shared = spark.sparkContext.broadcast(rank_of_id)

    def write(batches):
        rank, kind, unpress = shared.value, _packed_as(size), zstandard.ZstdDecompressor().decompress
        part = TaskContext.get().partitionId()
        fs, own = _store(folder)
        name, draft = f"{own}/tokens-{part:06d}.bin", f"{own}/_draft-{part:06d}-{uuid.uuid4().hex}"
        docs = ids = 0
        with fs.open_output_stream(draft) as f:
            f.write(MAGIC)

            doc_ids, parts, held = [], [], 0
            for batch in batches:
                for d, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    own_ids = np.append(np.frombuffer(unpress(packed), kind).astype("<u4"), np.uint32(end_id))
                    doc_ids.append(d)
                    parts.append(own_ids)
                    held += len(own_ids)
                    docs, ids = docs + 1, ids + len(own_ids)
                    if held >= BLOCK_IDS:
                        _write_block(f, doc_ids, parts, rank)
                        doc_ids, parts, held = [], [], 0
            if parts:
                _write_block(f, doc_ids, parts, rank)
        if not docs:
            fs.delete_file(draft)
            return
        fs.move(draft, name)
        target = folder.rstrip("/") + "/" + os.path.basename(name)
        yield pa.RecordBatch.from_pylist(
            [{"part": part, "path": target, "n_docs": docs, "n_ids": ids}],
            pa.schema([("part", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    order = [F.col(c).asc_nulls_first() for c in ("doc_id", "head", "packed")]
    ordered = coded.repartitionByRange(*order[:2]).sortWithinPartitions(*order).select("doc_id", "packed")
    manifest, start, out = ordered.mapInArrow(write, MANIFEST).collect(), 0, []  # a row per file
    for r in sorted(manifest, key=lambda r: r.part):
        out.append((r.part, r.path, r.n_docs, r.n_ids, start))
        start += r.n_ids
    return spark.createDataFrame(out, MANIFEST + ", start bigint")


def read_tokens(spark: SparkSession, manifest: DataFrame, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (of the ids as little-endian 32-bit integers) and on wish ids of every
    document, from the files."""
    ship(spark)
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids

    def read(batches):
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                fs, own = _store(os.path.dirname(path))
                with fs.open_input_stream(f"{own}/ranks.bin") as f:
                    id_of_rank = np.frombuffer(f.read(), "<u4")
                for doc_ids, null, sizes, ranks in _read(path):
                    ids = id_of_rank[ranks]
                    ends = np.cumsum(sizes.astype(np.int64))
                    first = ends - sizes
                    raw = memoryview(ids.tobytes())
                    columns = [
                        pa.array(doc_ids, pa.int64(), mask=null.astype(bool)), pa.array(first + start, pa.int64()),
                        pa.array(sizes.astype(np.int64)),
                        pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(first.tolist(), ends.tolist())], pa.int64())]
                    if with_ids:
                        columns.append(pa.ListArray.from_arrays(np.append(first, ends[-1:]).astype(np.int32), ids.astype(np.int32)))
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])
                    start += int(ends[-1])

    count = max(1, manifest.count())
    return manifest.select("path", "start").repartition(count).mapInArrow(read, schema)
