"""Benchmark decontamination with suffix arrays over the training text.

Each Arrow batch of documents is one shard.  Its words become ids of the benchmark's vocabulary (0: a word
that no item has); runs of known words that are too short for any window are left out, which loses no
match, and the shard's suffix array is built over the rest by prefix doubling.  Every suffix of every item
is then searched in all of it at once: an interval of the array per item suffix is narrowed word by word by
binary search until no suffix of the shard goes on the same way, which gives the longest verbatim match and
its places.  A match as long as the item's window is a hit.

Words: A-Z lower-cased, `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`.  A window is `window` consecutive item words; an
item of fewer words, but not none, is one window.  Null and empty texts have no words and no hits; items
without words or without an id are in nothing; repeated item rows count once; several texts under one
item id count as that item.  Repeated documents give repeated results.

The benchmark is the stated query set: it is cut by item into blocks of at most `block_bytes` of text, one
block is searched at a time, and only that block is sent to the executors.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import fresh, row_function, utf8

WINDOW = 13
BLOCK_BYTES = 32 << 20
HITS = "struct<n_words:bigint,spans:array<struct<start:bigint,end:bigint,item_id:string,longest:bigint>>>"

# Lower-cases A-Z and turns every byte that separates words into a space.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


class Benchmark:
    """Items as word ids: all item suffixes, with the window length each must reach."""

    def __init__(self, items: list[tuple[str, bytes]], window: int) -> None:
        self.vocabulary: dict[bytes, int] = {}
        ids, owner, need, left = [], [], [], []
        self.names: list[str] = []
        number: dict[str, int] = {}
        for name, text in sorted(set(items)):
            words = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            if not words:
                continue
            size = min(window, len(words))
            k = number.setdefault(name, len(self.names))
            if k == len(self.names):
                self.names.append(name)
            ids += words
            owner += [k] * len(words)
            need += [size] * len(words)
            left += range(len(words), 0, -1)
        self.ids = np.array(ids, np.int64)
        self.owner = np.array(owner, np.int64)
        self.need = np.array(need, np.int64)
        self.left = np.array(left, np.int64)
        self.shortest = int(self.need.min()) if ids else 0

    def matches(self, shard: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start in the shard, hit length, item, longest match) of every hit; shard: ids, 0 where words are unknown."""
        none = (np.empty(0, np.int64),) * 4
        if not len(self.ids) or not len(shard):
            return none
        # runs of known words that can hold a window, each followed by a separator
        edge = np.flatnonzero(np.diff(np.concatenate(([0], shard != 0, [0])).astype(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        long = ends - starts >= self.shortest
        starts, ends = starts[long], ends[long]
        if not len(starts):
            return none
        sizes = ends - starts + 1
        offset = np.cumsum(sizes) - sizes
        place = np.repeat(starts - offset, sizes) + np.arange(sizes.sum())
        text = np.append(shard, 0)[place]
        text[offset + sizes - 1] = 0
        order = suffix_array(text)
        padded = np.append(text, np.zeros(1, np.int64))

        todo = np.arange(len(self.ids))
        todo = todo[self.left >= self.need]
        low, high = np.zeros(len(todo), np.int64), np.full(len(todo), len(order), np.int64)
        at_need_low, at_need_high = np.zeros(len(self.ids), np.int64), np.zeros(len(self.ids), np.int64)
        longest = np.zeros(len(self.ids), np.int64)
        depth = 0
        while len(todo):
            wanted = self.ids[todo + depth]
            key = padded[np.minimum(order + depth, len(text))]
            low, high = _bound(key, wanted, low, high, False), _bound(key, wanted, low, high, True)
            alive = low < high
            todo, low, high = todo[alive], low[alive], high[alive]
            depth += 1
            longest[todo] = depth
            full = self.need[todo] == depth
            at_need_low[todo[full]], at_need_high[todo[full]] = low[full], high[full]
            more = self.left[todo] > depth
            todo, low, high = todo[more], low[more], high[more]
        hit = np.flatnonzero(at_need_high > at_need_low)
        many = at_need_high[hit] - at_need_low[hit]
        which = np.repeat(hit, many)
        inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        found = order[np.repeat(at_need_low[hit], many) + inside]
        return place[found], self.need[which], self.owner[which], longest[which]


def _bound(key: np.ndarray, wanted: np.ndarray, low: np.ndarray, high: np.ndarray, right: bool) -> np.ndarray:
    """Binary search of every `wanted` within its own interval of `key` at once."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) >> 1
        value = key[np.minimum(middle, len(key) - 1)]
        up = open_ & ((value <= wanted) if right else (value < wanted))
        low = np.where(up, middle + 1, low)
        high = np.where(open_ & ~up, middle, high)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Positions of the non-separator suffixes in order; a suffix ends at its separator (0)."""
    order = np.argsort(text, kind="stable")
    ordered = text[order]
    rank = np.empty(len(text), np.int64)
    rank[order] = np.cumsum(np.concatenate(([0], ordered[1:] != ordered[:-1])))
    open_run = text != 0
    width = 1
    while True:
        later = np.zeros(len(text), np.int64)
        later[:-width] = rank[width:] + 1
        later[~open_run] = 0
        order = np.lexsort((later, rank))
        a, b = rank[order], later[order]
        new = np.empty(len(text), np.int64)
        new[order] = np.cumsum(np.concatenate(([0], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
        settled = new.max() == rank.max()
        rank = new
        # a suffix whose first `width` words reach its separator is told apart by what follows no more
        reach = np.zeros(len(text), bool)
        reach[:-width] = open_run[width:]
        open_run &= reach
        width *= 2
        if settled or width >= len(text) or not open_run.any():
            break
    return order[text[order] != 0]


def _make_search(bench):
    def make():
        index = bench.value
        get = index.vocabulary.get

        def work(texts):
            sizes, parts = [], []
            for t in texts:
                words = words_of(t)
                sizes.append(len(words))
                parts.append(np.fromiter(map(get, words, repeat(0)), np.int64, len(words)))
                parts.append(np.zeros(1, np.int64))
            shard = np.concatenate(parts) if parts else np.empty(0, np.int64)
            first = np.cumsum([0] + [s + 1 for s in sizes])
            start, length, item, longest = index.matches(shard)
            spans: list[list] = [[] for _ in sizes]
            order = np.lexsort((start, item))
            start, length, item, longest = start[order], length[order], item[order], longest[order]
            doc = np.searchsorted(first, start, side="right") - 1
            last = None
            for d, s, n, i, m in zip(doc.tolist(), start.tolist(), length.tolist(), item.tolist(), longest.tolist()):
                s -= int(first[d])
                if last is not None and last[0] == (d, i) and s <= last[1]["end"]:
                    last[1]["end"] = max(last[1]["end"], s + n)
                    last[1]["longest"] = max(last[1]["longest"], m)
                    continue
                span = {"start": s, "end": s + n, "item_id": index.names[i], "longest": m}
                spans[d].append(span)
                last = ((d, i), span)
            return [{"n_words": n, "spans": s} for n, s in zip(sizes, spans)]

        return work

    return make


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_bytes: int):
    items = benchmark.select(F.col(item_id).cast("string").alias("i"), utf8(F.col(text)).alias("t")).where("i is not null and t is not null")
    total = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    count = max(1, -(-total // block_bytes))
    for k in range(count):
        rows = items.where(F.pmod(F.xxhash64("i"), F.lit(count)) == k) if count > 1 else items
        yield [(r.i, bytes(r.t)) for r in rows.toLocalIterator()]


def matches(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_bytes: int = BLOCK_BYTES, into: str = "matches",
) -> DataFrame:
    """`docs` with `into`: n_words, n_hit, spans (merged hits per item, in words, with the longest verbatim
    match that begins in them) and items (ids of the items that occur, sorted)."""
    spark = docs.sparkSession
    names, out = [], docs
    for k, items in enumerate(_blocks(benchmark, item_id, item_text, block_bytes)):
        bench = spark.sparkContext.broadcast(Benchmark(items, window))
        names.append(fresh(out, f"_block{k}"))
        out = out.withColumn(names[-1], row_function(spark, _make_search(bench), HITS, rows=None)(utf8(F.col(text))))
    spans = F.array_sort(F.concat(*[F.col(n)["spans"] for n in names]))
    zero = F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(0).cast("bigint").alias("n"))
    union = F.aggregate(
        spans, zero,
        lambda a, s: F.struct(
            F.greatest(a["end"], s["end"]).alias("end"),
            (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["end"], s["start"]))).alias("n")),
        lambda a: a["n"])
    found = F.struct(
        F.col(names[0])["n_words"].alias("n_words"), union.alias("n_hit"), spans.alias("spans"),
        F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["item_id"]))).alias("items"))
    return out.withColumn(into, found).drop(*[n for n in names if n != into])


def contaminated(found: Column, share: int = 20) -> Column:
    """At least one word in `share` is hit."""
    return (found["n_hit"] > 0) & (share * found["n_hit"] >= found["n_words"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that aren't contaminated, with their own columns."""
    name = fresh(docs, "_matches")
    return matches(docs, benchmark, into=name, **options).where(~contaminated(F.col(name))).drop(name)
