"""Near-duplicate detection by b-bit MinHash.

A document's set of word shingles is hashed K times; of each minimum all bits go into band keys (BANDS bands of ROWS minima)
and the low BITS into a packed signature.  Documents with a common band key are candidates.  The share of equal
low bits, less the 2^-BITS that agree by chance, estimates the similarity; candidates whose estimate is more than
MARGIN standard errors below the threshold are dropped.  The others are confirmed on the full sets: first by the parity
bits of all shingles, of which every differing one needs a shingle that one side lacks, then by intersecting the sets.

Chance of losing a link, per pair at similarity exactly 0.85: no common band (1 - 0.85^5)^32 = 7e-9, estimate too low
(5.5 standard errors of 256 minima) about 2e-8; both fall fast above it.  `bands_for` gives the number of bands for other
thresholds; below 0.75 the K minima don't suffice for MISSED.

Equal sets are one node from the start (128-bit hash of the set).  A bucket, the nodes with one band key, is never paired
with itself as a whole: rounds pair each node with one node only, the first in a random order of those that lead one of its buckets,
if both are still in different components, and merge what is confirmed.  Buckets that still hold several components are compared in blocks of BLOCK nodes by bit counts, only across
components: the nodes of a bucket's largest component once, against the others.  A pair comes out of the first band that it shares.  Of a
node's partners only the likeliest are confirmed in a round, one in the first and MORE times as many in each later one; rounds
end when no node has another partner outside its component, so none is left out.  Keys that a large share of the rows has (buckets, hubs, copies of one text) are joined by broadcast.

Null, empty and blank texts have no shingles and link with nothing; a text of fewer words than `words` has one shingle.
Repeated rows are one node.  Rows with a null id join components and get their names; a null never becomes a name unless all ids
of a component are null.
"""

from __future__ import annotations

import math
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import discard, join_unique, maybe_in, mix64, released, row_function, ship, staged, utf8
from tradewind.llm.jaccard_join import components, folded, least_overlap, shingles

K = 256  # minima
BITS = 4  # low bits kept of each
ROWS = 5  # minima in a band
MISSED = 1e-8  # chance that a pair at the threshold shares no band
MARGIN = 5.5
CHUNK = 256  # shingles hashed at a time, so that intermediate results stay in a core's cache
BLOCK = 2_048
GROUP = 256  # partners of a hub that are confirmed in one group
ROUNDS = 3
MORE = 8  # times the partners of a node that a later round confirms
PARITY_BITS = 1 << 16  # at most, for one node
SKETCH = "struct<n:bigint,node:binary,bands:array<bigint>,signature:binary,parity:binary,packed:binary>"
LINK = "u binary, v binary"
PARTNER = LINK + ", score double"


@lru_cache(maxsize=1)
def _factors() -> np.ndarray:
    """Odd multipliers, one for each of the K hash functions."""
    return mix64(np.arange(1, K + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def bands_for(num: int, den: int) -> int:
    """Bands with which a pair at the threshold is missed with a chance of MISSED at most, as far as K minima allow."""
    return min(K // ROWS, math.ceil(math.log(MISSED) / math.log1p(-((num / den) ** ROWS))))


def minima(hashes: np.ndarray) -> np.ndarray:
    """The K minima of a set's hashes."""
    factors = _factors()[:, None]
    best = np.full(K, np.iinfo(np.uint64).max)
    for i in range(0, len(hashes), CHUNK):
        np.minimum(best, (factors * hashes[i : i + CHUNK]).min(1), out=best)
    return best


def packed(least: np.ndarray) -> bytes:
    """The low bits of every minimum, one plane of K bits for each of the BITS.  Products mix upwards, so the lowest bits of
    the upper half are taken."""
    low = least >> np.uint64(32)
    planes = (low[None, :] >> np.arange(BITS, dtype=np.uint64)[:, None]) & np.uint64(1)
    return np.packbits(planes.astype(np.uint8), axis=1, bitorder="little").tobytes()


def planes(signatures: list[bytes]) -> np.ndarray:
    """(BITS, signatures, 64-bit words)."""
    return np.frombuffer(b"".join(signatures), np.uint64).reshape(len(signatures), BITS, K // 64).transpose(1, 0, 2)


def equal_minima(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many of the K minima agree in their low bits, along the second axis."""
    apart = x[0] ^ y[0]
    for p in range(1, BITS):
        apart = apart | (x[p] ^ y[p])
    return K - np.bitwise_count(apart).sum(-1, dtype=np.int64)


def similarity(equal: np.ndarray | int) -> np.ndarray | float:
    """Estimated Jaccard similarity: the share of agreeing minima less the collisions of their low bits."""
    chance = 2.0**-BITS
    return (equal / K - chance) / (1 - chance)


def least_equal(num: int, den: int) -> int:
    """Agreeing minima below which a pair is dropped: MARGIN standard errors under what the threshold is expected to give."""
    chance = 2.0**-BITS
    share = chance + (1 - chance) * num / den
    return math.floor(K * (share - MARGIN * math.sqrt(share * (1 - share) / K)))


def parity(hashes: np.ndarray) -> np.ndarray:
    """Parities of how many hashes fall on each bit, in 64-bit words; at least twice as many bits as hashes, as far as PARITY_BITS go."""
    width = 64
    while width < 2 * len(hashes) and width < PARITY_BITS:
        width *= 2
    odd = np.bincount((hashes & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def overlap_bound(n_x, n_y, x: np.ndarray, y: np.ndarray):
    """The most shingles that sets of these sizes with these parities (of one width) can share."""
    return (n_x + n_y - np.bitwise_count(x ^ y).sum(-1, dtype=np.int64)) // 2


def sketches(docs: DataFrame, words: int = 5, bands: int | None = None) -> DataFrame:
    """`docs`, whose column text is binary, with n, node, bands, signature, parity and the packed text; node is null without words."""
    bands = bands or K // ROWS

    def make():
        def one(text):
            found = shingles(text, words)
            if not len(found):
                return {"n": 0, "node": None, "bands": [], "signature": None, "parity": None, "packed": None}
            least = minima(found)
            rows = least[: bands * ROWS].reshape(bands, ROWS)
            keys = np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)  # a band's number is part of its keys
            for r in range(ROWS):
                keys = mix64(keys + rows[:, r] + np.uint64(r))
            return {"n": len(found), "node": xxhash.xxh3_128_digest(found.tobytes()), "bands": keys.view(np.int64),
                    "signature": packed(least), "parity": parity(found).tobytes(), "packed": zlib.compress(text, 1)}

        return lambda texts: [one(t) for t in texts]

    made = docs.withColumn("sketch", row_function(docs.sparkSession, make, SKETCH, 64)(F.col("text")))
    return made.drop("text").select("*", "sketch.*").drop("sketch")


def _halves(keys):
    return [np.array(k, np.int64).astype(np.uint32).tobytes() for k in keys]


class _Candidates:
    """Buckets, signatures and texts of one corpus' nodes."""

    def __init__(self, sets: DataFrame, num: int, den: int, words: int) -> None:
        self.spark, self.num, self.den, self.words = sets.sparkSession, num, den, words
        rows = sets.where("node is not null")
        # of equal sets the first row's bands count; only rows of nodes that may repeat are shuffled for that
        repeated = staged(rows.groupBy("node").agg(F.min("row").alias("first"), F.count("*").alias("copies")).where("copies > 1"), "repeated")
        banded = rows.select("row", "node", "n", "bands")
        later = join_unique(maybe_in(rows.select("row", "node"), "node", repeated.select("node")), repeated, "node", "copies").where("row != first")
        later = staged(later.select("row"), "later-copies")
        may, not_ = maybe_in(banded, "row", later), maybe_in(banded, "row", later, among=False)
        own = not_.union(may.join(later, "row", "left_anti"))
        bucketed = staged(own.select("row", "node", "n", F.explode("bands").alias("key")), "bands")
        buckets = staged(bucketed.groupBy("key").agg(
            F.min("row").alias("lo"), F.max("row").alias("hi"), F.count("*").alias("many")).where("lo < hi").select("key", "many"), "shared-bands")
        self.members = staged(join_unique(maybe_in(bucketed, "key", buckets.select("key")), buckets, "key", "many"), "buckets")
        needed = staged(self.members.select("row").distinct(), "candidates")
        # the low halves of band keys tell which bands two nodes share
        brief = row_function(self.spark, lambda: _halves, "binary")(F.col("bands"))
        self.texts = staged(
            maybe_in(rows, "row", needed).join(needed, "row", "left_semi").select(
                "node", "n", "signature", "parity", brief.alias("brief"), "packed"), "candidate-texts")
        discard(bucketed, buckets, needed)

    def _labelled(self, comps: DataFrame | None) -> DataFrame:
        if comps is None:
            return self.members.withColumn("comp", F.col("node"))
        return self.members.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))

    def _sized(self, a: str, b: str) -> Column:
        return F.lit(self.den) * F.least(a, b) >= F.lit(self.num) * F.greatest(a, b)

    def hubs(self, comps: DataFrame | None, turn: int) -> DataFrame:
        """(u: hub, v): of every bucket one node and those of other components."""
        members = self._labelled(comps)
        rank = F.hash("node", F.lit(turn))
        hub = members.groupBy("key").agg(
            F.min(F.struct(rank.alias("rank"), "node", "comp", "n")).alias("hub"), F.min("comp").alias("lo"), F.max("comp").alias("hi"),
            F.count("*").alias("many")).where("lo < hi")
        hub = hub.select("key", F.col("hub.node").alias("u"), F.col("hub.comp").alias("hub_comp"), F.col("hub.n").alias("hub_n"), "many")
        met = join_unique(members.drop("many"), hub, "key", "many").where(F.col("comp") != F.col("hub_comp")).where(self._sized("n", "hub_n"))
        first = F.min(F.struct(F.hash("u", F.lit(turn)).alias("rank"), "u"))
        return met.groupBy(F.col("node").alias("v")).agg(first.alias("first")).select("first.u", "v")

    def across(self, comps: DataFrame | None, most: int, waiting: DataFrame | None) -> DataFrame:
        """(u, v, rank): pairs of nodes of one bucket but different components that their signatures allow, by rank among u's.
        A node has no more than `most` + 1 of a block; a rank above `most` says that it has others.  `waiting` (node, tried), from
        the second time on, has the nodes whose pairs are wanted and the partners they were compared with."""
        members = self._labelled(comps)
        if waiting is not None:
            members = members.join(members.join(waiting.select("node"), "node", "left_semi").select("key").distinct(), "key", "left_semi")
        per_comp = members.groupBy("key", "comp").agg(F.count("*").alias("n_comp"))
        mixed = per_comp.groupBy("key").agg(
            F.count("*").alias("comps"), F.max(F.struct("n_comp", "comp")).alias("main"), F.sum("n_comp").alias("all")).where("comps > 1").select(
            "key", "all", F.col("main.comp").alias("main"), F.ceil(F.col("main.n_comp") / BLOCK).cast("int").alias("main_blocks"),
            F.ceil((F.col("all") - F.col("main.n_comp")) / BLOCK).cast("int").alias("other_blocks"))
        rows = join_unique(members.drop("many"), mixed, "key", "all").withColumn("is_main", F.col("comp") == F.col("main"))
        columns = ["n", "node", "comp"]
        dealt = lambda blocks: F.pmod(F.xxhash64("node"), F.col(blocks)).cast("int")
        upto = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
        # kind 0: every block of the largest component's nodes meets every block of the others; kind 1: those meet each other
        kind = lambda k: F.lit(k).alias("kind")
        main = rows.where("is_main").select(
            "key", kind(0), dealt("main_blocks").alias("i"), upto("other_blocks").alias("j"), F.lit(True).alias("second"), *columns)
        against = rows.where("not is_main").select(
            "key", kind(0), upto("main_blocks").alias("i"), dealt("other_blocks").alias("j"), F.lit(False).alias("second"), *columns)
        own = rows.where("not is_main").withColumn("own", dealt("other_blocks")).withColumn("other", upto("other_blocks")).select(
            "key", kind(1), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).alias("second"),
            *columns)
        group = ["key", "kind", "i", "j"]
        own_tried = F.col("tried") if waiting is not None else F.array().cast("array<binary>")
        pieces = main.union(against).union(own).join(self.texts.select("node", "signature", "parity", "brief"), "node")
        if waiting is not None:
            pieces = pieces.join(waiting, "node", "left")
        pieces = pieces.select(*group, "second", *columns, "signature", "parity", "brief", own_tried.alias("tried"))
        pieces = pieces.repartition(*group).sortWithinPartitions(*group, "n", "node")
        num, den, least = self.num, self.den, least_equal(self.num, self.den)

        def close(block, rows):
            number = {c: i for i, c in enumerate({r[3] for r in rows})}
            if len(number) < 2:
                return [], [], []
            second = np.array([r[0] for r in rows])
            n = np.array([r[1] for r in rows])
            node = [r[2] for r in rows]
            comp = np.array([number[r[3]] for r in rows])
            bits = planes([r[4] for r in rows])
            brief = np.array([np.frombuffer(r[6], np.uint32) for r in rows])
            # this bucket's band: the one whose key's low half is the block's
            here = np.uint32(block[0] & 0xFFFFFFFF)
            bands = np.flatnonzero((brief == here).all(0))
            earlier = brief[:, : bands[0] if len(bands) else 0]
            at_width: dict[int, np.ndarray] = {}
            out_u, out_v, out_score = [], [], []
            for x in range(len(rows) - 1):
                if rows[x][7] is None:
                    continue
                end = int(np.searchsorted(n, n[x] * den // num, side="right"))  # rows are sorted by size
                y = np.arange(x + 1, end)
                y = y[comp[y] != comp[x]]
                if block[1] == 0 or block[2] != block[3]:
                    y = y[second[y] != second[x]]
                if len(y):
                    y = y[equal_minima(bits[:, y], bits[:, x : x + 1]) >= least]
                if len(y) and earlier.shape[1]:
                    y = y[~(earlier[y] == earlier[x]).any(1)]
                if len(y):
                    words = len(rows[x][5]) // 8
                    if words not in at_width:  # larger sets have no fewer bits
                        at_width[words] = np.array([
                            folded(np.frombuffer(r[5], np.uint64), words) if len(r[5]) >= 8 * words else np.zeros(words, np.uint64) for r in rows])
                    own = at_width[words]
                    score = overlap_bound(n[x], n[y], own[x], own[y]) / least_overlap(n[x], n[y], num, den)
                    y, score = y[score >= 1], score[score >= 1]
                    if rows[x][7]:
                        tried = set(rows[x][7])
                        new = np.array([node[k] not in tried for k in y], bool)
                        y, score = y[new], score[new]
                    best = np.argsort(-score, kind="stable")[: most + 1]
                    out_u += [node[x]] * len(best)
                    out_v += [node[k] for k in y[best]]
                    out_score += score[best].tolist()
            return out_u, out_v, out_score

        def found_in(parts):
            u, v, score = ([x for part in parts for x in part[c]] for c in range(3))
            return pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(v, pa.binary()), pa.array(score, pa.float64())], ["u", "v", "score"])

        def compare(batches):
            block, held = None, []
            for batch in batches:
                parts = []
                for key, kind, i, j, *rest in zip(*(c.to_pylist() for c in batch.columns)):
                    if (key, kind, i, j) != block:
                        if held:
                            parts.append(close(block, held))
                        block, held = (key, kind, i, j), []
                    held.append(rest)
                yield found_in(parts)
            if held:
                yield found_in([close(block, held)])

        found = pieces.mapInArrow(released(compare), PARTNER).groupBy("u", "v").agg(F.max("score").alias("score"))
        return found.select("u", "v", F.row_number().over(Window.partitionBy("u").orderBy(F.desc("score"), "v")).alias("rank"))

    def estimated(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose signatures allow the threshold, with the part of the hub that a pair is dealt to."""
        side = lambda u: self.texts.select(*[F.col(c).alias(f"{u}_{c}" if c != "node" else u) for c in ("node", "n", "signature", "parity")])
        hubs = pairs.groupBy("u").agg(F.count("*").alias("many")).join(side("u"), "u")
        num, den, least = self.num, self.den, least_equal(self.num, self.den)

        def make():
            def bounded(a, b, x, y):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                width = min(len(x), len(y))
                return overlap_bound(a, b, folded(x, width), folded(y, width)) >= least_overlap(a, b, num, den)

            def work(n_u, n_v, bits_u, bits_v, parity_u, parity_v):
                near = equal_minima(planes(bits_u), planes(bits_v)) >= least
                return [bool(ok and bounded(*rest)) for ok, *rest in zip(near, n_u, n_v, parity_u, parity_v)]

            return work

        possible = row_function(self.spark, make, "boolean")
        met = join_unique(pairs, hubs, "u", "many").join(side("v"), "v")
        columns = [F.col(f"{x}_{c}") for c in ("n", "signature", "parity") for x in ("u", "v")]
        return met.withColumn("possible", possible(*columns)).where("possible").select(
            "u", "v", F.pmod(F.xxhash64("v"), F.ceil(F.col("many") / GROUP)).cast("int").alias("part"))

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose full sets are similar enough, staged.  A hub's text goes once to each group of about GROUP partners."""
        pairs = staged(pairs, "pairs")
        dealt = staged(self.estimated(pairs), "dealt")
        body = self.texts.select("node", "packed")
        partner = dealt.join(body.withColumnRenamed("node", "v"), "v").select("u", "part", "v", "packed")
        hub = dealt.select("u", "part").distinct().join(body.withColumnRenamed("node", "u"), "u").select(
            "u", "part", F.lit(None).cast("binary").alias("v"), "packed")
        rows = partner.union(hub).repartition("u", "part").sortWithinPartitions("u", "part", F.col("v").asc_nulls_first())
        words, num, den = self.words, self.num, self.den

        def check(batches):
            hashes = None
            for batch in batches:
                linked_u, linked_v = [], []
                for u, _, v, data in zip(*(c.to_pylist() for c in batch.columns)):
                    found = shingles(zlib.decompress(data), words)
                    if v is None:
                        hashes = found
                        continue
                    at = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
                    common = int((hashes[at] == found).sum())
                    if den * common >= num * (len(hashes) + len(found) - common):
                        linked_u.append(u)
                        linked_v.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(linked_u, pa.binary()), pa.array(linked_v, pa.binary())], ["u", "v"])

        links = staged(rows.mapInArrow(released(check), LINK), "links")
        discard(pairs, dealt)
        return links

    def labels(self) -> DataFrame:
        """(node, comp) of the nodes that link with another."""
        comps = None

        def merged(pairs: DataFrame) -> DataFrame:
            links = self.confirmed(pairs)
            # earlier components stand for earlier links
            return components(links if comps is None else links.union(comps.select(F.col("node").alias("u"), F.col("comp").alias("v"))))

        for turn in range(ROUNDS):
            comps = merged(self.hubs(comps, turn))
        most, waiting, tried = 1, None, None
        while True:
            found = staged(self.across(comps, most, waiting), "partners")
            pairs = found.where(F.col("rank") <= most).select("u", "v")
            comps = merged(pairs)
            open_ = found.where(F.col("rank") > most).select("u").distinct()
            if open_.isEmpty():
                break
            tried = pairs if tried is None else pairs.union(tried)
            waiting = staged(
                tried.join(open_, "u", "left_semi").groupBy(F.col("u").alias("node")).agg(F.collect_list("v").alias("tried")), "waiting")
            tried = waiting.select(F.col("node").alias("u"), F.explode("tried").alias("v"))
            most *= MORE
        discard(self.members, self.texts)
        return comps


def near_duplicates(
    docs: DataFrame, words: int = 5, num: int = 85, den: int = 100, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (the component's smallest id) of every row.

    Rows link when den * intersection >= num * union of their sets; component_id is the smallest doc_id that links reach,
    itself included.  Rows that repeat a kept id are kept like it."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), utf8(F.col(text)).alias("text"))
    # written, so that a row keeps its number whatever is computed again
    sets = staged(sketches(rows, words, bands_for(num, den)).withColumn("row", F.monotonically_increasing_id()), "sketches")
    labels = _Candidates(sets, num, den, words).labels()
    nodes = sets.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("own"), F.count("*").alias("copies"))
    nodes = nodes.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = nodes.groupBy("comp").agg(F.min("own").alias("least"), F.count("*").alias("many"))
    named = staged(join_unique(nodes, least, "comp", "many").select("node", "copies", "least"), "names")
    found = join_unique(sets.where("node is not null").select("doc_id", "n", "node"), named, "node", "copies").select("doc_id", "n", "least")
    alone = sets.where("node is null").select("doc_id", "n", F.col("doc_id").alias("least"))
    name = F.coalesce("least", "doc_id")
    return found.union(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), name.alias("component_id"), F.col("doc_id").eqNullSafe(name).alias("kept"))
