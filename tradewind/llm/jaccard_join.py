"""Exact Jaccard join of documents on word n-grams.

Texts become sets of hashed shingles; equal sets are one node from the start.  A tile is the set of nodes of one
size band that share a prefix shingle: with the shingles of every text in one order, two sets of Jaccard similarity >= t have
a common one among the first n - ceil(t n) + 1, so no link is missed.  The order is by hash, but the shingles that
are most frequent over the corpus come last, which keeps common passages out of the prefixes.

Only sets whose sizes are within t of each other can link, so a node is in the tiles of its own band and the next.  Each node carries a bitmap of
parities of its hashed shingles, as wide as the set is large; every differing bit needs a shingle that only
one side has, so bit counts bound the overlap from above.  Pairs that pass are decided exactly by
intersecting the sorted shingle arrays.

The result is components, so pairs are never listed within a component.  Three rounds pair each node with
one hub per tile (a pair only if both are still in different components), verify, and merge.  What is left,
tiles that still hold several components, is compared in blocks of at most BLOCK x BLOCK nodes, only across
components; pairs that pass the bitmap bound are verified and merged.

Shingles and sets are identified by 64-bit hashes.  Null, empty and blank texts have no shingles and link with
nothing; a text of fewer words than `words` has one shingle.  Null ids never become a component's name, unless all
of its ids are null.
"""

from __future__ import annotations

import math
import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import discard, fresh, mix64, released, row_function, ship, staged, utf8

HOT = 100_000  # shingles moved to the end of the order; any number gives the same links
HOT_LOCAL = 8  # occurrences in one task from which a shingle is counted for that
SKETCH_SLOTS = 1 << 22  # one byte each
HELD = 500_000  # such shingles a task holds before it hands their counts on
BLOCK = 4_096
FEW = 32  # nodes up to which a block is compared pair by pair
HUB_GROUP = 512
FILTER_BITS = 1 << 25  # bound of the filter that finds the texts of candidates: 4 MB
SETS = "struct<n:bigint,node:bigint,bitmap:binary,small:binary,leading:binary,prefix:array<bigint>>"
TILE = ["key", "band"]
SMALL = 8  # 64-bit words of the bitmap that goes into blocks; what it lets through meets the whole one
LEADING = 8  # least prefix shingles that go into blocks; any number gives the same links

_FOLD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))


def shingles(text: bytes | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams; bytes.lower and bytes.split are the ASCII rules wanted."""
    found = text.lower().split() if text else []
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    size = min(words, len(h))
    total = np.full(len(h) - size + 1, size, np.uint64)
    for i in range(size):
        total = mix64(total + h[i : len(h) - size + 1 + i] * _FOLD[0] + np.uint64(i))
    total.sort()
    return total[np.concatenate(([True], total[1:] != total[:-1]))]


def bitmap(hashes: np.ndarray) -> np.ndarray:
    """Parity bits of the hashes, in 64-bit words; twice as wide whenever the set doubles."""
    width = 64
    while width < len(hashes) and width < 1 << 13:
        width *= 2
    odd = np.bincount((hashes & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """The bitmap at a smaller width: halves fold onto each other."""
    while len(bits) > words:
        half = len(bits) // 2
        bits = bits[:half] ^ bits[half:]
    return bits


def least_overlap(a: int | np.ndarray, b: int | np.ndarray, num: int, den: int):
    """Smallest intersection with which sizes a and b reach num / den."""
    return -(-num * (a + b) // (num + den))


def _prefix(hashes: np.ndarray, hot: np.ndarray, num: int, den: int) -> np.ndarray:
    size = len(hashes) + (num * len(hashes)) // -den + 1  # n - ceil(t n) + 1
    if len(hot):
        at = np.minimum(np.searchsorted(hot, hashes), len(hot) - 1)
        is_hot = hot[at] == hashes
        if is_hot.any():
            hashes = np.concatenate((hashes[~is_hot], hashes[is_hot]))
    return hashes[:size]


def _make_sets(words: int, num: int, den: int, hot):
    def make():
        known = hot.value

        def one(text):
            h = shingles(text, words)
            if not len(h):
                return {"n": 0, "node": None, "bitmap": None, "small": None, "leading": None, "prefix": []}
            node = int(mix64(np.array([(h * _FOLD[1]).sum() ^ np.bitwise_xor.reduce(mix64(h))], np.uint64)).view(np.int64)[0])
            bits, prefix = bitmap(h), _prefix(h, known, num, den).view(np.int64)
            return {"n": len(h), "node": node, "bitmap": bits.tobytes(), "small": folded(bits, SMALL).tobytes(),
                    "leading": np.sort(prefix)[:LEADING].tobytes(), "prefix": prefix}

        return lambda texts: [one(t) for t in texts]

    return make


def _hot_shingles(docs: DataFrame, words: int, num: int, den: int) -> np.ndarray:
    """The most frequent prefix shingles, at most HOT of them.  They only set the order."""

    def frequent(batches):
        def counted(parts):
            values, n = np.unique(np.concatenate(parts), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n.astype(np.int64))], ["shingle", "n"])

        # how often each slot was met, as far as HOT_LOCAL: memory of fixed size, shared slots only change the order
        met = np.zeros(SKETCH_SLOTS, np.uint8)
        parts, held = [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = _prefix(shingles(text, words), np.empty(0, np.uint64), num, den)
                slot = (found & np.uint64(SKETCH_SLOTS - 1)).astype(np.int64)
                met[slot] = np.minimum(met[slot] + 1, HOT_LOCAL)
                often = found[met[slot] >= HOT_LOCAL]
                if len(often):
                    parts.append(often)
                    held += len(often)
            if held > HELD:
                yield counted(parts)
                parts, held = [], 0
        if parts:
            yield counted(parts)

    totals = docs.select("text").mapInArrow(released(frequent), "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n"))
    rows = staged(totals.withColumn("level", F.floor(F.log2("n") * 4).cast("int")), "frequent-shingles")
    room, least = HOT, 0
    for r in rows.groupBy("level").count().orderBy(F.desc("level")).collect():  # at most 256 levels
        if r["count"] > room:
            least = r.level + 1
            break
        room -= r["count"]
    found = rows.where(F.col("level") >= least).select("shingle").toArrow().column(0).to_numpy()
    return np.sort(found.astype(np.int64).view(np.uint64))


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of every node of `edges` (u, v); comp is its component's smallest node.  Alternates the large-star
    and small-star steps, both as aggregations and joins, until the edges stay the same."""
    def step(e: DataFrame, large: bool) -> DataFrame:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        if not large:
            both = both.where("v < u")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        met = both.join(least, "u")
        out = met.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")) if large else (
            met.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))))
        return out.where("u != v").distinct()

    mark = lambda e: tuple(e.agg(F.count("*"), F.coalesce(F.sum(F.hash("u", "v").cast("bigint")), F.lit(0))).first())
    edges = staged(edges.where("u != v").select("u", "v").distinct(), "edges")
    before = mark(edges)
    while before[0]:
        next_edges = staged(step(step(edges, True), False), "edges")
        discard(edges)
        edges = next_edges
        now = mark(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp"))


def _close_few(tile: tuple, rows: list[tuple], num: int, den: int) -> tuple[list[int], list[int]]:
    """What `across` finds in a small block, without arrays."""
    out_u, out_v = [], []
    bits = [int.from_bytes(r[4], "little") for r in rows]
    for x, (second, n, comp, node, own, least, _) in enumerate(rows):
        width, most = 8 * len(own), n * den // num
        smaller = None
        for y in range(x + 1, len(rows)):
            other = rows[y]
            if other[1] > most:
                break  # rows are sorted by size
            if not other[6] or other[2] == comp or (tile[2] != tile[3] and other[0] == second):
                continue
            theirs, wide = bits[y], 8 * len(other[4])
            while wide > width:
                wide //= 2
                theirs = theirs >> wide ^ theirs & (1 << wide) - 1
            if (n + other[1] - (bits[x] ^ theirs).bit_count()) // 2 < least_overlap(n, other[1], num, den):
                continue
            if smaller is None:
                smaller = {k for k in np.frombuffer(least, np.int64).tolist() if k < tile[0]}
            if smaller.isdisjoint(np.frombuffer(other[5], np.int64).tolist()):
                out_u.append(node)
                out_v.append(other[3])
    return out_u, out_v


class _Search:
    """The candidates of one corpus."""

    def __init__(self, docs: DataFrame, sets: DataFrame, words: int, num: int, den: int) -> None:
        self.spark, self.words, self.num, self.den = docs.sparkSession, words, num, den
        self.nodes = sets.where("n > 0").select("node", "n", "bitmap", "small", "leading")
        keys = sets.where("n > 0").select("node", "n", F.explode("prefix").alias("key"))
        shared = keys.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("key")
        # only shingles of two nodes or more go on, and of those only bands of two nodes or more
        met = staged(keys.join(shared, "key").distinct(), "shared")
        banded = met.withColumn("own", self._band(F.col("n"))).select(
            "key", F.explode(F.array("own", F.col("own") + 1)).alias("band"), "node", "n", "own").withColumn(
            "home", F.col("own") == F.col("band")).drop("own")
        tiles = banded.groupBy("key", "band").agg(
            F.min("node").alias("lo"), F.max("node").alias("hi"), F.max("home").alias("any")).where("lo < hi and any")
        self.members = staged(banded.join(tiles.select(*TILE), TILE), "tiles")
        discard(met)
        needed = self.members.select("node").distinct()
        owners = sets.groupBy("node").agg(F.min("row").alias("row")).join(needed, "node", "left_semi")
        self.texts = staged(self._texts(docs, owners), "candidate-texts")
        self.bitmaps = staged(
            self.nodes.join(needed, "node", "left_semi").groupBy("node").agg(
                *(F.first(c).alias(c) for c in ("n", "bitmap", "small", "leading"))),
            "bitmaps")

    def _band(self, n: Column) -> Column:
        """Size band.  Bands are a little wider than the sizes that can link, so those lie in one or in two neighbours;
        a node is at home in its own and visits the next, and the larger node of a pair is at home where they meet."""
        return F.floor(F.log(n) / math.log(1.01 * self.den / self.num)).cast("int")

    def _sized(self, a: str, b: str) -> Column:
        return F.lit(self.den) * F.least(a, b) >= F.lit(self.num) * F.greatest(a, b)

    def _texts(self, docs: DataFrame, owners: DataFrame) -> DataFrame:
        """(node, packed text) of the candidates.  A filter of fixed size passes over the corpus once; what it lets
        through by chance is dropped by the join."""
        word = F.shiftright(F.pmod("slot", F.lit(FILTER_BITS)), 6)
        bits = (
            owners.select(F.xxhash64("row").alias("slot")).select(word.alias("w"), F.expr("shiftleft(1L, cast(pmod(slot, 64) as int))").alias("b"))
            .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow())
        table = np.zeros(FILTER_BITS // 64, np.int64)
        table[bits.column("w").to_numpy()] = bits.column("b").to_numpy()
        shared = self.spark.sparkContext.broadcast(table)

        def pick(batches):
            table = shared.value.view(np.uint64)
            for batch in batches:
                slot = np.mod(batch.column("slot").to_numpy(), FILTER_BITS)
                hit = np.flatnonzero(table[slot >> 6] >> (slot & 63).astype(np.uint64) & np.uint64(1))
                if len(hit):
                    part = batch.take(pa.array(hit))
                    packed = [zlib.compress(t, 1) for t in part.column("text").to_pylist()]
                    yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(packed, pa.binary())], ["row", "packed"])

        rows = docs.where("text is not null").select("row", F.xxhash64("row").alias("slot"), "text")
        return rows.mapInArrow(released(pick), "row string, packed binary").join(owners, "row").dropDuplicates(
            ["row", "node"]).select("node", "packed")  # a node has one row name, and rows are dealt by it already

    def hubs(self, comps: DataFrame | None, turn: int) -> DataFrame:
        """Pairs (u: hub, v) of one hub per tile and its nodes of other components."""
        members = self._labelled(comps)
        rank = F.hash("node", F.lit(turn))
        hub = members.groupBy(*TILE).agg(
            F.min(F.struct(rank.alias("r"), "node", "comp", "n")).alias("hub"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
        hub = hub.select(*TILE, F.col("hub.node").alias("u"), F.col("hub.comp").alias("hub_comp"), F.col("hub.n").alias("hub_n"))
        return members.join(hub, TILE).where(F.col("comp") != F.col("hub_comp")).where(self._sized("n", "hub_n")).select("u", F.col("node").alias("v")).distinct()

    def _labelled(self, comps: DataFrame | None) -> DataFrame:
        if comps is None:
            return self.members.withColumn("comp", F.col("node"))
        return self.members.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))

    def bounded(self, pairs: DataFrame) -> DataFrame:
        """Pairs that sizes and bitmaps allow."""
        left = self.bitmaps.select(F.col("node").alias("u"), F.col("n").alias("nu"), F.col("bitmap").alias("bu"))
        right = self.bitmaps.select(F.col("node").alias("v"), F.col("n").alias("nv"), F.col("bitmap").alias("bv"))
        num, den = self.num, self.den
        sized = pairs.join(left, "u").join(right, "v").where(self._sized("nu", "nv"))

        def make():
            def one(a, b, x, y):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                words = min(len(x), len(y))
                apart = int(np.bitwise_count(folded(x, words) ^ folded(y, words)).sum())
                return (a + b - apart) // 2 >= least_overlap(a, b, num, den)

            return lambda *columns: [one(*row) for row in zip(*columns)]

        possible = row_function(self.spark, make, "boolean")
        return sized.withColumn("possible", possible(F.col("nu"), F.col("nv"), F.col("bu"), F.col("bv"))).where("possible").select("u", "v")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose sorted shingle arrays intersect in enough.  A hub's text goes once to each group of at most
        about HUB_GROUP partners, partners of a frequent hub are dealt out to several groups."""
        pairs = staged(self.bounded(pairs), "pairs")
        self.spent = pairs
        many = pairs.groupBy("u").agg(F.count("*").alias("many"))
        dealt = pairs.join(many, "u").select(
            "u", "v", F.pmod(F.xxhash64("v"), F.ceil(F.col("many") / HUB_GROUP)).cast("int").alias("part"))
        partner = dealt.join(self.texts.withColumnRenamed("node", "v"), "v").select("u", "part", "v", "packed")
        hub = dealt.select("u", "part").distinct().join(self.texts.withColumnRenamed("node", "u"), "u").select(
            "u", "part", F.lit(None).cast("bigint").alias("v"), "packed")
        rows = partner.union(hub).repartition("u", "part").sortWithinPartitions("u", "part", F.col("v").asc_nulls_first())
        words, num, den = self.words, self.num, self.den

        def check(batches):
            own, hashes = None, None
            for batch in batches:
                linked_u, linked_v = [], []
                for u, part, v, packed in zip(*(c.to_pylist() for c in batch.columns)):
                    found = shingles(zlib.decompress(packed), words)
                    if v is None:
                        own, hashes = (u, part), found
                        continue
                    assert own == (u, part)
                    at = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
                    common = int((hashes[at] == found).sum())
                    if den * common >= num * (len(hashes) + len(found) - common):
                        linked_u.append(u)
                        linked_v.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(linked_u, pa.int64()), pa.array(linked_v, pa.int64())], ["u", "v"])

        return rows.mapInArrow(released(check), "u bigint, v bigint")

    def across(self, comps: DataFrame | None) -> DataFrame:
        """All pairs of nodes of one tile but different components that sizes and bitmaps allow.

        Two near copies meet in most of their tiles.  A tile leaves a pair out if both sets have a smaller shingle among
        their LEADING ones: that shingle's tile holds both too, and the smallest such tile gives the pair."""
        members = self._labelled(comps)
        mixed = members.groupBy(*TILE).agg(
            F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("many"), F.max("home").alias("any")).where("lo < hi and any")
        rows = members.join(mixed.select(*TILE, "many"), TILE).join(self.bitmaps.select("node", F.col("small").alias("bitmap"), "leading"), "node")
        blocks = F.ceil(F.col("many") / BLOCK).cast("int")
        own = F.pmod(F.xxhash64("node"), blocks).cast("int")
        # every block meets every block of its tile: row (lower block, higher block)
        dealt = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
            *TILE, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
            (F.col("own") > F.col("other")).alias("second"), "n", "node", "comp", "bitmap", "leading", "home")
        dealt = dealt.repartition(*TILE, "i", "j").sortWithinPartitions(*TILE, "i", "j", "n", "node")
        num, den = self.num, self.den

        def compare(batches):
            def close(tile, rows):
                if len({r[2] for r in rows}) < 2:
                    return [], []
                if len(rows) <= FEW:
                    return _close_few(tile, rows, num, den)
                second = np.array([r[0] for r in rows])
                n = np.array([r[1] for r in rows])
                comp = np.array([r[2] for r in rows])
                node = [r[3] for r in rows]
                maps = [np.frombuffer(r[4], np.uint64) for r in rows]
                leading = np.full((len(rows), LEADING), np.iinfo(np.int64).max)
                for k, r in enumerate(rows):
                    own = np.frombuffer(r[5], np.int64)
                    leading[k, : len(own)] = own
                home = np.array([r[6] for r in rows])
                by_width: dict[int, np.ndarray] = {}
                out_u, out_v = [], []
                for x in range(len(rows) - 1):
                    # partners are at least as large; rows are sorted by size
                    end = int(np.searchsorted(n, n[x] * den // num, side="right"))
                    y = np.arange(x + 1, end)
                    y = y[home[y] & (comp[y] != comp[x])]
                    if tile[2] != tile[3]:
                        y = y[second[y] != second[x]]
                    if not len(y):
                        continue
                    width = len(maps[x])
                    if width not in by_width:
                        by_width[width] = np.array([folded(m, width) if len(m) >= width else np.zeros(width, np.uint64) for m in maps])
                    apart = np.bitwise_count(by_width[width][y] ^ by_width[width][x]).sum(1).astype(np.int64)
                    y = y[(n[x] + n[y] - apart) // 2 >= least_overlap(n[x], n[y], num, den)]
                    smaller = leading[x][leading[x] < tile[0]]
                    if len(y) and len(smaller):
                        y = y[~np.isin(leading[y], smaller).any(1)]
                    out_u += [node[x]] * len(y)
                    out_v += [node[k] for k in y]
                return out_u, out_v

            tile, held = None, []
            for batch in batches:
                found_u, found_v = [], []
                for key, band, i, j, second, n, node, comp, bits, least, home in zip(*(c.to_pylist() for c in batch.columns)):
                    if (key, band, i, j) != tile:
                        if held:
                            u, v = close(tile, held)
                            found_u += u
                            found_v += v
                        tile, held = (key, band, i, j), []
                    held.append((second, n, comp, node, bits, least, home))
                yield pa.RecordBatch.from_arrays([pa.array(found_u, pa.int64()), pa.array(found_v, pa.int64())], ["u", "v"])
            if held:
                u, v = close(tile, held)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

        found = dealt.mapInArrow(released(compare), "u bigint, v bigint")
        return found.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()

    def labels(self) -> DataFrame:
        """(node, comp) of the nodes that link with another."""
        edges, comps = [], None
        for turn in range(4):
            pairs = self.hubs(comps, turn) if turn < 3 else self.across(comps)
            edges.append(staged(self.verified(pairs), "links"))
            discard(self.spent)
            comps = components(reduce(DataFrame.union, edges))
        discard(self.members, self.texts, self.bitmaps, *edges)
        return comps


def jaccard_components(
    docs: DataFrame, words: int = 5, num: int = 80, den: int = 100, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """doc_id, n_shingles, component_id of every row, and the 64-bit `node` of its shingle set (null without words).

    Rows link when den * intersection >= num * union; component_id is the smallest doc_id of the rows that links
    reach, itself included."""
    own = _labelled_rows(docs, words, num, den, doc_id, text)
    least = own.where("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("least"))
    return own.join(least, "comp", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce(F.col("least"), F.col("doc_id")).alias("component_id"), "node")


def _row_name(doc_id: str, text: str) -> Column:
    """Tells rows apart well enough to find a text again: rows alike in it are alike in id and text."""
    return F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.hex(F.xxhash64(F.col(text).cast("string"))))


def _labelled_rows(docs: DataFrame, words: int, num: int, den: int, doc_id: str, text: str) -> DataFrame:
    """doc_id, row, n, node and comp of every row; rows without words have no node and no comp."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(doc_id).alias("doc_id"), _row_name(doc_id, text).alias("row"), utf8(F.col(text)).alias("text"))
    hot = spark.sparkContext.broadcast(_hot_shingles(rows, words, num, den))
    made = rows.withColumn("s", row_function(spark, _make_sets(words, num, den, hot), SETS)(F.col("text")))
    sets = staged(made.select("doc_id", "row", "s.*"), "sets")
    labels = _Search(rows, sets, words, num, den).labels()
    return sets.select("doc_id", "row", "n", "node").join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def drop_near_copies(
    docs: DataFrame, words: int = 5, num: int = 80, den: int = 100, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """`docs` with one row of each component, the one with the smallest id (null ids last); rows without words all stay.
    Where an id has several texts, each is a row of its own component.  Of rows that repeat an id and a text one stays:
    the one that sorts first as JSON."""
    found = staged(
        _labelled_rows(docs, words, num, den, doc_id, text).where("comp is not null").groupBy("comp", "doc_id", "node", "row").agg(
            F.count("*").alias("many")), "components")
    first = found.groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "node", "row")).getField("row").alias("first"))
    marked = found.join(first, "comp").select("row", "many", (F.col("row") == F.col("first")).alias("stays"))
    id_ = fresh(docs, "_copy_row")
    repeated = marked.where("stays and many > 1").select(F.col("row").alias(id_))
    named = docs.withColumn(id_, _row_name(doc_id, text))
    out = named.join(marked.where("not stays or many > 1").select(F.col("row").alias(id_)), id_, "left_anti").drop(id_)
    if repeated.isEmpty():
        return out
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = named.join(repeated, id_, "left_semi").groupBy(id_).agg(F.min_by(row, F.to_json(row)).alias("row"))
    return out.unionByName(one.select("row.*"))
