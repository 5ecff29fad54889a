"""SentencePiece (BPE) encoding with seeded merge-dropout, and decoding.

A text is normalised as the model's identity normaliser does (a space in front, spaces as U+2581) and cut
where a space follows a word: no piece of such a vocabulary goes over that boundary, so the parts are
independent.  A part is cut further where no piece has its two neighbouring symbols side by side.  What remains is a chain of
symbols; an agenda holds its candidate merges by rank and place.  Each candidate taken from it is skipped with the
dropout rate.

The candidates of a document are counted in the order in which they are taken, over all of its chains, and the gaps between
those skipped are geometric variates, drawn from a hash of (seed, document's key, number of the gap).  So each
candidate of each occurrence has a draw of its own, and every rerun has the same ones.  Documents without a key have
their text as key.  What is remembered doesn't depend on draws: the ids a chain has after given skips, and how many
candidates follow the last of them; an occurrence without a skip among its candidates needs no agenda.
With `variants` = N a key counts by its hash modulo N only, so that equal texts have N segmentations at most.
With dropout 0 the result is the library's own.  Symbols outside the vocabulary become byte pieces.

Decoding joins the pieces' bytes and takes the first space away.  A U+2581 of the text itself, which the library takes
for a space, becomes its three byte pieces in `encode`, so that every text is restored; `Pieces.encode` does the same with
`exact`, and without it does as the library does.  Null texts count as empty and have no pieces.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import keep_for, row_function

DROPOUT = 0.1
VARIANTS = None
SEED = 17
REMEMBERED = 300_000  # parts, chains and chains after skips kept per worker
SHORT = 64  # symbols up to which a list serves as agenda
LONGEST_REMEMBERED = 48
GAPS, MOST_GAPS = 32, 2048  # drawn at a time: first, and later in a long text
NEVER = 1 << 62
PACKED = "struct<n_pieces:bigint,ids:binary,lossless:boolean>"
SPACE = "▁"
LITERAL = "\ud800"  # stands for a U+2581 of the text itself: no valid text holds a lone surrogate, no piece either
_PARTS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Draws:
    """The draws of one document: `left` candidates stay until the next one is skipped."""

    __slots__ = ("left", "more")

    def __init__(self, gaps: Iterator[int]) -> None:
        self.more = gaps.__next__
        self.left = self.more()


def _uniform(key: int, first: int, n: int) -> np.ndarray:
    """Numbers first, first + 1, ... of a key's sequence, above 0 and at most 1."""
    x = np.arange(first, first + n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) + 1) / 2**53


class Pieces:
    """Encoder and decoder of one model file."""

    def __init__(self, model: str, dropout: float, variants: int | None, seed: int) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.dropout, self.variants, self.seed = dropout, variants, seed
        self.id_of: dict[str, int] = {}
        self.rank: dict[str, float] = {}
        self.bytes_of: list[bytes] = []
        self.byte_id = [0] * 256
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.bytes_of.append(b"")
            else:
                self.id_of[piece] = i
                self.rank[piece] = -sp.get_score(i)
                self.bytes_of.append(piece.replace(SPACE, " ").encode())
        # remembered: the first parts and chains that come, so the frequent ones are among them: number of
        # candidates, ids if none of them is skipped, own number, chains if there are several.  A chain after
        # skips is found by the number of the entry before its last skip and the gap to it.
        self.memory: dict[str | int, tuple[int, bytes, int, list[str] | None]] = {}
        self.joined = {p[i : i + 2] for p in self.id_of for i in range(len(p) - 1)}

    def draws(self, key) -> Draws:
        if self.dropout <= 0:
            return Draws(iter(lambda: NEVER, None))
        number = int.from_bytes(hashlib.blake2b(str(key).encode("utf-8", "surrogatepass"), digest_size=8).digest())
        if self.variants:
            number %= self.variants
        both = hashlib.blake2b(f"{self.seed} {number}".encode(), digest_size=8).digest()
        return Draws(self._gaps(int.from_bytes(both)))

    def _gaps(self, key: int) -> Iterator[int]:
        """Candidates before each one that is skipped."""
        scale = 1 / math.log1p(-self.dropout) if self.dropout < 1 else 0.0
        first, more = 0, GAPS
        while True:
            yield from np.minimum(np.log(_uniform(key, first, more)) * scale, NEVER).astype(np.int64).tolist()
            first, more = first + more, min(2 * more, MOST_GAPS)

    def cut(self, part: str) -> list[str]:
        """The part cut wherever no piece of the vocabulary has its two neighbouring symbols side by side."""
        joined = self.joined
        ends = [i for i in range(1, len(part)) if part[i - 1 : i + 1] not in joined]
        return [part[a:b] for a, b in zip([0, *ends], [*ends, len(part)])]

    def _remember(self, at: str | int, n: int, ids: bytes, chains: list[str] | None = None) -> None:
        if len(self.memory) < REMEMBERED:
            self.memory[at] = (n, ids, len(self.memory), chains)

    def part(self, part: str, draws: Draws) -> bytes:
        """Ids of one part as little-endian 32-bit integers."""
        known = self.memory.get(part)
        if known is None:
            chains = self.cut(part)
        elif draws.left >= known[0]:
            draws.left -= known[0]
            return known[1]
        else:
            chains = known[3] or [part]
        if len(chains) == 1:
            return self.chain(part, draws)
        ids = b"".join([self.chain(c, draws) for c in chains])
        if known is None and len(part) <= LONGEST_REMEMBERED:
            entries = [self.memory.get(c) for c in chains]
            if None not in entries:
                self._remember(part, sum(e[0] for e in entries), b"".join([e[1] for e in entries]), chains)
        return ids

    def chain(self, chain: str, draws: Draws) -> bytes:
        at: str | int = chain
        gaps = [draws.left]
        known = self.memory.get(at)
        while known is not None:
            if gaps[-1] >= known[0]:
                draws.left = gaps[-1] - known[0]
                return known[1]
            at = known[2] << 16 | gaps[-1]
            gaps.append(draws.more())
            known = self.memory.get(at)
        symbols = list(chain)
        skips = n = 0
        if len(symbols) > 1:
            symbols, skips, n = (self._short if len(symbols) <= SHORT else self._long)(symbols, draws, gaps)
        else:
            draws.left = gaps[-1]
        ids: list[int] = []
        for s in symbols:
            i = self.id_of.get(s)
            if i is not None:
                ids.append(i)
            else:
                ids += [self.byte_id[b] for b in (SPACE if s == LITERAL else s).encode()]
        packed = struct.pack(f"<{len(ids)}I", *ids)
        # as many skips as lead to `at`: what comes after them is what `at` stands for
        if len(chain) <= LONGEST_REMEMBERED and skips == len(gaps) - 1:
            self._remember(at, n, packed)
        return packed

    def _short(self, symbols: list[str], draws: Draws | int, gaps: list[int] | None = None) -> tuple[list[str], int, int]:
        """The agenda as a list by place: the best rank is its minimum, the leftmost one comes first.

        `draws` may also be a document's key.  `gaps` come before those that are still to be drawn.  Returns the
        symbols, how many candidates were skipped, and how many were taken after the last of them."""
        draws = self.draws(draws) if isinstance(draws, int) else draws
        gaps = gaps or [draws.left]
        left, skips, n = gaps[0], 0, 0
        rank, none = self.rank.get, float("inf")
        agenda = [rank(a + b, none) for a, b in zip(symbols, symbols[1:])]
        while agenda:
            best = min(agenda)
            if best == none:
                break
            i = agenda.index(best)
            if n == left:
                skips, n = skips + 1, 0
                left = gaps[skips] if skips < len(gaps) else draws.more()
                agenda[i] = none
                continue
            n += 1
            symbols[i] += symbols.pop(i + 1)
            del agenda[i]
            if i:
                agenda[i - 1] = rank(symbols[i - 1] + symbols[i], none)
            if i < len(agenda):
                agenda[i] = rank(symbols[i] + symbols[i + 1], none)
        draws.left = left - n
        return symbols, skips, n

    def _long(self, symbols: list[str | None], draws: Draws | int, gaps: list[int] | None = None) -> tuple[list[str], int, int]:
        """The agenda as a heap over linked symbols; the same merges and skips in the same order."""
        draws = self.draws(draws) if isinstance(draws, int) else draws
        gaps = gaps or [draws.left]
        left, skips, n = gaps[0], 0, 0
        size = len(symbols)
        after = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        agenda: list[tuple[float, int, str, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < size:
                merged = symbols[i] + symbols[j]
                r = self.rank.get(merged)
                if r is not None:
                    heapq.heappush(agenda, (r, i, merged, j))

        for i in range(size - 1):
            offer(i)
        while agenda:
            _, i, merged, j = heapq.heappop(agenda)
            if symbols[i] is None or after[i] != j or symbols[j] is None or len(symbols[i]) + len(symbols[j]) != len(merged):
                continue  # what it would merge is merged otherwise by now
            if n == left:
                skips, n = skips + 1, 0
                left = gaps[skips] if skips < len(gaps) else draws.more()
                continue
            n += 1
            symbols[i], symbols[j] = merged, None
            after[i] = after[j]
            if after[j] < size:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        draws.left = left - n
        return [s for s in symbols if s is not None], skips, n

    def encode(self, text: str | None, key=None, exact: bool = False) -> bytes:
        if not text:
            return b""
        draws = self.draws(text if key is None else key)
        if exact:
            text = text.replace(SPACE, LITERAL)
        words = text.split(" ")
        if "" in words or SPACE in text:
            parts = _PARTS.findall(SPACE + text.replace(" ", SPACE))
        else:
            parts = [SPACE + w for w in words]
        out = []
        known = self.memory.get
        for p in parts:
            entry = known(p)
            if entry is not None and draws.left >= entry[0]:
                draws.left -= entry[0]
                out.append(entry[1])
            else:
                out.append(self.part(p, draws))
        return b"".join(out)

    def decode(self, ids: bytes | np.ndarray) -> bytes:
        numbers = np.frombuffer(ids, "<u4") if isinstance(ids, (bytes, bytearray)) else np.asarray(ids)
        joined = b"".join(map(self.bytes_of.__getitem__, numbers.tolist()))
        return joined[1:] if joined[:1] == b" " else joined


@lru_cache(maxsize=2)
def _pieces(model: str, dropout: float, variants: int | None, seed: int) -> Pieces:
    return Pieces(model, dropout, variants, seed)


def pieces(model: str, dropout: float, variants: int | None, seed: int) -> Pieces:
    """One per worker process and setting, so that remembered parts serve later tasks too."""
    keep_for("pieces", _pieces.cache_clear)
    return _pieces(model, dropout, variants, seed)


def encode(
    docs: DataFrame, text: str = "text", key: str = "doc_id", into: str = "encoded", model: str | None = None,
    dropout: float = DROPOUT, variants: int | None = VARIANTS, seed: int = SEED,
) -> DataFrame:
    """`docs` with `into`: n_pieces, ids (little-endian unsigned 32-bit integers), and whether they decode to the text."""
    model = model or default_model()

    def make():
        own = pieces(model, dropout, variants, seed)

        def work(texts, keys):
            done = [own.encode(t, k, exact=True) for t, k in zip(texts, keys)]
            return [
                {"n_pieces": len(b) // 4, "ids": b, "lossless": own.decode(b) == (t or "").encode("utf-8", "replace")}
                for b, t in zip(done, texts)]

        return work

    return docs.withColumn(
        into, row_function(docs.sparkSession, make, PACKED)(F.col(text).cast("string"), F.col(key).cast("string")))


def decode(encoded: DataFrame, ids: str | Column, into: str = "decoded", model: str | None = None) -> DataFrame:
    """`encoded` with the text of packed ids; null ids give null."""
    model = model or default_model()

    def make():
        own = pieces(model, 0.0, 1, 0)
        return lambda packed: [None if b is None else own.decode(b).decode("utf-8", "replace") for b in packed]

    column = F.col(ids) if isinstance(ids, str) else ids
    return encoded.withColumn(into, row_function(encoded.sparkSession, make, "string")(column))
