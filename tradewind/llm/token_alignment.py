"""Alignment of two tokenizers' tokens over a corpus, each distinct text once.

Rows are shuffled by their whole text and counted; a distinct text is tokenised and aligned once and stands for as many
documents.  Tokenizer A gets a space and the text, tokenizer B the text, in front of which it puts the space itself; special
tokens' strings are plain text for both.  Token boundaries are byte offsets: where tokens of both end, a group ends, and
tokens whose bytes overlap are linked.

Both vocabularies begin a token at each single space between two characters that aren't white space, so a text is cut
there and its parts are aligned on their own, frequent ones once per worker.  The constructor checks this for B's
pieces; A's pre-tokenizer always cuts there.

A pair of ids counts the documents in which it is linked: tasks sum pairs over their texts, weighted by copies, before the
shuffle.  The most frequent pairs, a table of bounded size, go to every task, which sums them per text; the rest of a
text's pairs is joined with the counts.  Measures go back to rows by the text's SHA-256; those of texts that hold more than
a thousandth of the rows (at most a thousand) are broadcast.

Null and empty texts, and those that either tokenizer doesn't restore, have no tokens: zeros and empty groups.  Repeated
rows are documents of their own, under whatever id they have.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import join_unique, keep_for, row_function, ship, staged

REMEMBERED = 150_000  # parts kept per worker
LONGEST_REMEMBERED = 64
AT_ONCE = 500  # texts whose new parts are tokenised together, within a batch of rows
BUNDLE = 100  # parts that go to the tokenizers as one text
HELD = 2_000_000  # pair occurrences a task holds before it hands their sums on
HOT = 400_000  # pairs in the broadcast table, 17 bytes each
LOW = 32  # a pair is id of A << LOW | id of B
MEASURES = ("n_a", "n_b", "n_groups", "n_links")
ALIGNED = "struct<n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,groups:string,pairs:binary>"
SPACE = "▁"
_CUT = re.compile(r"(?<=\S) (?=\S)")
NOTHING = (0, 0, 0, 0, "", b"")


def byte_of_sign() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as their Latin-1 characters and the others, in order, from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Both tokenizers, and the alignment of the parts seen so far."""

    def __init__(self, a: str, b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a)
        self.a.encode_special_tokens = True
        signs = byte_of_sign()
        self.a_bytes = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for token, i in self.a.get_vocab(with_added_tokens=False).items():
            if all(c in signs for c in token):
                self.a_bytes[i] = bytes(map(signs.__getitem__, token))
        self.b = sentencepiece.SentencePieceProcessor(model_file=b)
        self.b_bytes: list[bytes] = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(SPACE, " ").encode())
            if SPACE in piece.lstrip(SPACE):
                raise ValueError("a piece of the second vocabulary reaches over the beginning of a word")
        self.a_size, self.b_size = (np.array(list(map(len, x))) for x in (self.a_bytes, self.b_bytes))
        numbers = np.array([str(i) for i in range(max(len(self.a_bytes), len(self.b_bytes)))], object)
        self.with_sign = {sign: numbers + sign for sign in ",|;"}
        self.known: dict[str, tuple | None] = {}

    @staticmethod
    def parts(text: str) -> list[str]:
        """Cuts a space and the text; every part begins with a space that it doesn't show."""
        words = text.split(" ")
        # splitting at any white space gives the same words only if single spaces are all there is
        if words == text.split():
            return words
        return [w if i else w[1:] for i, w in enumerate(_CUT.split(" " + text))]

    def align(self, parts: list[str]) -> list[tuple | None]:
        """For each part (n_a, n_b, n_groups, n_links, groups, pairs); None if a tokenizer doesn't restore it."""
        odd = [p for p in parts if not p or p[0].isspace() or p[-1].isspace()]
        plain = list(set(parts).difference(odd))
        bundles = [[p] for p in odd] + [plain[i : i + BUNDLE] for i in range(0, len(plain), BUNDLE)]
        found = self._bundles(bundles)
        return [found[p] for p in parts]

    def _bundles(self, bundles: list[list[str]]) -> dict[str, tuple | None]:
        """Aligns bundles of parts.  A bundle is one text to the tokenizers, as both begin a token at the spaces between its parts."""
        texts = [" ".join(b) for b in bundles]
        ids_a = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        ids_b = self.b.encode(texts, num_threads=1)
        good, again, out = [], [], {}
        for k, (bundle, text, a, b) in enumerate(zip(bundles, texts, ids_a, ids_b)):
            body = (" " + text).encode("utf-8", "surrogatepass")
            if b"".join(map(self.a_bytes.__getitem__, a)) == body and b"".join(map(self.b_bytes.__getitem__, b)) == body:
                good.append(k)
            elif len(bundle) == 1:
                out[bundle[0]] = None
            else:
                again += [[p] for p in bundle]
        if good:
            out |= self._aligned([p for k in good for p in bundles[k]], [i for k in good for i in ids_a[k]], [i for k in good for i in ids_b[k]])
        return out | self._bundles(again) if again else out

    def _aligned(self, parts: list[str], a: list[int], b: list[int]) -> dict[str, tuple]:
        """Aligns parts whose tokens follow each other, by the byte offsets at which tokens end."""
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        ends_a, ends_b = self.a_size[a].cumsum(), self.b_size[b].cumsum()
        part_ends = np.array([1 + len(p.encode("utf-8", "surrogatepass")) for p in parts]).cumsum()
        # between two neighbouring ends of either kind lie bytes of one token of A and one of B: a link
        ends = np.union1d(ends_a, ends_b)
        pairs = (a[np.searchsorted(ends_a, ends)] << LOW | b[np.searchsorted(ends_b, ends)]).tobytes()
        group_ends = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(group_ends, ends_a), np.searchsorted(group_ends, ends_b)
        sign = self.with_sign
        signed = np.concatenate((
            np.where(group_ends[group_a] == ends_a, sign["|"][a], sign[","][a]), np.where(group_ends[group_b] == ends_b, sign[";"][b], sign[","][b])))
        signed = signed[np.argsort(np.concatenate((2 * group_a, 2 * group_b + 1)), kind="stable")].tolist()
        bounds = [np.searchsorted(e, part_ends, side="right").tolist() for e in (ends_a, ends_b, group_ends, ends)]
        out, before = {}, (0, 0, 0, 0)
        for part, *now in zip(parts, *bounds):
            text = "".join(signed[before[0] + before[1] : now[0] + now[1]])
            out[part] = (*(y - x for x, y in zip(before, now)), text[:-1], pairs[8 * before[3] : 8 * now[3]])
            before = now
        return out

    def texts(self, texts: list[str]) -> list[tuple[int, int, int, int, str, np.ndarray]]:
        cuts = [self.parts(t) if t else [] for t in texts]
        new = list(set().union(*cuts).difference(self.known))
        once: dict[str, tuple | None] = {}
        for part, found in zip(new, self.align(new) if new else ()):
            if len(self.known) < REMEMBERED and len(part) <= LONGEST_REMEMBERED:
                self.known[part] = found
            else:
                once[part] = found
        out = []
        for cut in cuts:
            found = [once[p] if p in once else self.known[p] for p in cut] if once else list(map(self.known.__getitem__, cut))
            if not found or None in found:
                out.append(NOTHING[:5] + (np.empty(0, np.int64),))
                continue
            n_a, n_b, n_groups, n_links, groups, pairs = zip(*found)
            out.append((sum(n_a), sum(n_b), sum(n_groups), sum(n_links), ";".join(groups), np.frombuffer(b"".join(pairs), np.int64)))
        return out


@lru_cache(maxsize=1)
def _aligner(a: str, b: str) -> Aligner:
    return Aligner(a, b)


def aligner(a: str, b: str) -> Aligner:
    """One per worker process and pair of files."""
    keep_for("aligner", _aligner.cache_clear)
    return _aligner(a, b)


def default_files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def packed(pairs: np.ndarray) -> bytes:
    """Distinct pairs and how often each is linked."""
    values, times = np.unique(pairs, return_counts=True)
    return zlib.compress(np.diff(values, prepend=np.int64(0)).tobytes() + times.astype("<u4").tobytes(), 1) if len(values) else b""


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zlib.decompress(data) if data else b""
    n = len(raw) // 12
    return np.cumsum(np.frombuffer(raw, np.int64, n)), np.frombuffer(raw, "<u4", n, 8 * n)


def aligned_texts(
    docs: DataFrame, text: str = "text", files: tuple[str, str] | None = None, groups: Callable[[Column], Column] = lambda c: c,
) -> DataFrame:
    """One row for each distinct text that isn't null: same (its SHA-256), copies, n_a, n_b, n_groups, n_links, groups
    (`a1,a2|b1;a3|b2,b3`: ids of A and B, in order, or what the function `groups` makes of that), and its packed pairs."""
    a, b = files or default_files()

    def make():
        own = aligner(a, b)

        def work(texts):
            names = (*MEASURES, "groups", "pairs")
            return [dict(zip(names, (*found[:5], packed(found[5])))) for found in own.texts(texts)]

        return work

    distinct = docs.select(F.col(text).cast("string").alias("text")).where("text is not null").groupBy("text").agg(F.count("*").alias("copies"))
    found = distinct.withColumn("found", row_function(docs.sparkSession, make, ALIGNED, AT_ONCE)(F.col("text")))
    return found.select(
        F.unhex(F.sha2("text", 256)).alias("same"), "copies", *(f"found.{m}" for m in MEASURES),
        groups(F.col("found.groups")).alias("groups"), "found.pairs")


def pair_counts(texts: DataFrame) -> DataFrame:
    """(pair, n_docs, best) of every linked pair of ids: documents that hold it, and whether no pair of its A id has more."""

    def summed(batches):
        def handed(pairs, copies):
            values, at = np.unique(np.concatenate(pairs), return_inverse=True)
            # exact: weights are added up as integers
            n = np.zeros(len(values), np.int64)
            np.add.at(n, at, np.concatenate(copies))
            return pa.RecordBatch.from_arrays([pa.array(values), pa.array(n)], ["pair", "n_docs"])

        pairs, copies, held = [], [], 0
        for batch in batches:
            for data, n in zip(*(c.to_pylist() for c in batch.columns)):
                values, _ = unpacked(data)
                if not len(values):
                    continue
                pairs.append(values)
                copies.append(np.full(len(values), n))
                held += len(values)
                if held > HELD:
                    yield handed(pairs, copies)
                    pairs, copies, held = [], [], 0
        if pairs:
            yield handed(pairs, copies)

    counts = texts.select("pairs", "copies").mapInArrow(summed, "pair bigint, n_docs bigint").groupBy("pair").agg(F.sum("n_docs").alias("n_docs"))
    counts = staged(counts.withColumn("a", F.shiftright("pair", LOW)), "pair-counts")
    most = counts.groupBy("a").agg(F.max("n_docs").alias("most"))
    return counts.join(most, "a").select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))


def _hot(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The most frequent pairs, at most HOT, in order, with their counts and marks."""
    graded = counts.withColumn("level", F.floor(F.log2("n_docs") * 8).cast("int"))
    room, least = HOT, 0
    for r in graded.groupBy("level").count().orderBy(F.desc("level")).collect():  # at most 512 levels
        if r["count"] > room:
            least = r.level + 1
            break
        room -= r["count"]
    found = graded.where(F.col("level") >= least).select("pair", "n_docs", "best").toArrow()
    pair = found.column("pair").to_numpy()
    order = np.argsort(pair)
    return pair[order], found.column("n_docs").to_numpy()[order], found.column("best").to_numpy(zero_copy_only=False)[order]


SCORED = "struct<n_best:bigint,count_sum:bigint,rest:array<struct<pair:bigint,times:bigint>>>"


def scored_texts(texts: DataFrame, counts: DataFrame) -> DataFrame:
    """`texts` with n_best (links whose pair is a best one of its A id) and count_sum (over links) instead of pairs."""
    spark = texts.sparkSession
    hot = spark.sparkContext.broadcast(_hot(counts))

    def make():
        known, n_docs, best = hot.value

        def one(data):
            pairs, times = unpacked(data)
            if not len(pairs):
                return {"n_best": 0, "count_sum": 0, "rest": []}
            at = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
            met = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
            at, n = at[met], times[met].astype(np.int64)
            rest = [{"pair": p, "times": t} for p, t in zip(pairs[~met].tolist(), times[~met].tolist())]
            return {"n_best": int(n[best[at]].sum()), "count_sum": int((n * n_docs[at]).sum()), "rest": rest}

        return lambda datas: [one(d) for d in datas]

    # a function of the row alone, so that both branches agree whatever is computed again
    scored = staged(texts.withColumn("scored", row_function(spark, make, SCORED)(F.col("pairs"))).drop("pairs"), "scored-texts")
    rest = scored.select("same", F.explode("scored.rest").alias("r")).select("same", "r.*").join(counts, "pair").groupBy("same").agg(
        F.sum(F.col("times") * F.col("best").cast("bigint")).alias("more_best"), F.sum(F.col("times") * F.col("n_docs")).alias("more"))
    return scored.join(rest, "same", "left").select(
        "same", "copies", *MEASURES, (F.col("scored.n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("scored.count_sum") + F.coalesce("more", F.lit(0))).alias("count_sum"), "groups")


def alignment(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", files: tuple[str, str] | None = None,
    groups: Callable[[Column], Column] = lambda c: c,
) -> DataFrame:
    """doc_id, the measures n_a, n_b, n_groups, n_links, n_best, count_sum, and the groups, of every row.  What the
    function `groups` makes of them travels to the rows, so pass a digest where the groups aren't needed."""
    ship(docs.sparkSession)
    texts = staged(aligned_texts(docs, text, files, groups), "aligned-texts")
    found = staged(scored_texts(texts, staged(pair_counts(texts), "pairs")), "measures")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.unhex(F.sha2(F.col(text).cast("string"), 256)).alias("same"))
    met = join_unique(rows, found, "same", "copies", "left")
    zero = {m: F.coalesce(m, F.lit(0)).cast("bigint").alias(m) for m in (*MEASURES, "n_best", "count_sum")}
    return met.select("doc_id", *zero.values(), F.coalesce("groups", groups(F.lit(""))).alias("groups"))
