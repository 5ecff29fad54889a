"""Token counts without token ids per document.

Every distinct pre-token of the corpus is tokenised once.  The counts of the most frequent ones, a table of
bounded size, go to every task, which sums them while it cuts its texts; the rest of a document's
pre-token frequencies is joined with the counts and summed per document.

Null and empty texts have 0 tokens.  Rows are counted on their own, repeated or not.  A special token's
string in a text counts as that token.
"""

from __future__ import annotations

from collections import Counter
from itertools import repeat

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm import byte_bpe
from tradewind.llm.common import fresh, row_function, ship, staged

HOT = 200_000  # pre-tokens in the broadcast table, at most
HOT_BYTES = 64  # longer ones are never in it, so it holds at most HOT x (HOT_BYTES + 8) bytes
HELD = 400_000  # distinct words a task counts before it hands them on
CUT = "struct<n_bytes:bigint,known:bigint,tail:array<struct<piece:string,n:bigint>>>"


def pre_tokens(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """(piece, n) of every distinct pre-token of the corpus."""
    ship(docs.sparkSession)
    path = path or byte_bpe.default_path()

    def count(batches):
        own = byte_bpe.words(path)

        def handed(words: Counter, pieces: Counter) -> pa.RecordBatch:
            for w, n in words.items():
                for p in own.pieces_of_word(w):
                    pieces[p] += n
            return pa.RecordBatch.from_arrays(
                [pa.array(list(pieces), pa.string()), pa.array(list(pieces.values()), pa.int64())], ["piece", "n"])

        words, pieces = Counter(), Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                if not t:
                    continue
                if own.is_special(t):
                    parts = own.split_special(t)
                    for part in parts:
                        pieces.update([part] if part in own.special else own.pieces(part))
                    continue
                first, rest, last, _ = own.cut(t, own.pieces_of)
                words.update(rest)
                pieces.update(own.pieces(first))
                for part in last:
                    pieces.update(own.pieces(part))
                if len(words) > HELD:
                    yield handed(words, pieces)
                    words, pieces = Counter(), Counter()
        yield handed(words, pieces)

    rows = docs.select(F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(count, "piece string, n bigint").groupBy("piece").agg(F.sum("n").alias("n"))


def _token_number(docs: DataFrame, path: str) -> Column:
    def make():
        own = byte_bpe.words(path)
        return lambda pieces: [len(ids) for ids in own.tokenise(pieces)]

    return row_function(docs.sparkSession, make, "bigint")(F.col("piece"))


def _hot(table: DataFrame) -> dict[str, int]:
    short = table.where(F.octet_length("piece") <= HOT_BYTES).withColumn("level", F.floor(F.log2("n") * 8).cast("int"))
    room, least = HOT, 0
    for r in short.groupBy("level").count().orderBy(F.desc("level")).collect():  # at most 512 levels
        if r["count"] > room:
            least = r.level + 1
            break
        room -= r["count"]
    found = short.where(F.col("level") >= least).select("piece", "tokens").toArrow()
    return dict(zip(found.column(0).to_pylist(), found.column(1).to_pylist()))


def count_tokens(
    docs: DataFrame, text: str = "text", into: str = "n_tokens", bytes_into: str | None = None, path: str | None = None,
) -> DataFrame:
    """`docs`, without its text, with the number of tokens of each row and on wish its bytes."""
    spark = docs.sparkSession
    path = path or byte_bpe.default_path()
    table = staged(pre_tokens(docs, text, path).withColumn("tokens", _token_number(docs, path)), "pre-tokens")
    hot = spark.sparkContext.broadcast(_hot(table))

    def make():
        own = byte_bpe.words(path)
        counts = hot.value
        number: dict[str, int] = {}  # words whose pre-tokens are all in the table
        mixed: dict[str, tuple[int, tuple[str, ...]]] = {}

        def resolve(pieces):
            return sum(map(counts.get, pieces, repeat(0))), tuple(p for p in pieces if p not in counts)

        def cut(text):
            if not text:
                return {"n_bytes": 0, "known": 0, "tail": []}
            tail: Counter = Counter()
            known = 0
            plain = []
            if own.is_special(text):
                for part in own.split_special(text):
                    plain += [part] if part in own.special else own.pieces(part)
            else:
                first, rest, last, new = own.cut(text, number)
                plain += own.pieces(first)
                for part in last:
                    plain += own.pieces(part)
                odd = {}
                for w in new:
                    found = mixed.get(w) or resolve(own.pieces_of_word(w))
                    short = len(w) <= byte_bpe.LONGEST_REMEMBERED
                    if not found[1] and short and len(number) < byte_bpe.REMEMBERED:
                        number[w] = found[0]
                        continue
                    if short and len(mixed) < byte_bpe.REMEMBERED // 4:
                        mixed[w] = found
                    odd[w] = found
                known += sum(map(number.get, rest, repeat(0)))
                if odd:
                    for w in rest:
                        if w in odd:
                            known += odd[w][0]
                            tail.update(odd[w][1])
            more, rare = resolve(plain)
            tail.update(rare)
            return {"n_bytes": len(text.encode("utf-8", "surrogatepass")), "known": known + more,
                    "tail": [{"piece": p, "n": n} for p, n in tail.items()]}

        return lambda texts: [cut(t) for t in texts]

    row, cut_, n_ = (fresh(docs, x) for x in ("_row", "_cut", "_rest"))
    body = F.col(text).cast("string")
    counted = docs.withColumn(cut_, row_function(spark, make, CUT)(body)).drop(text)
    # written, so that a row keeps its number whatever is computed again
    counted = staged(counted.withColumn(row, F.monotonically_increasing_id()), "cut-texts")
    rest = (
        counted.select(row, F.explode(f"{cut_}.tail").alias("t")).select(row, "t.piece", F.col("t.n").alias("times"))
        .join(table.select("piece", "tokens"), "piece")
        .groupBy(row).agg(F.sum(F.col("times") * F.col("tokens")).alias(n_)))
    total = (F.col(f"{cut_}.known") + F.coalesce(F.col(n_), F.lit(0))).cast("bigint")
    keep = counted.drop(*([into] if into in docs.columns else []))
    out = keep.join(rest, row, "left").withColumn(into, total)
    if bytes_into:
        out = out.withColumn(bytes_into, F.col(f"{cut_}.n_bytes"))
    return out.drop(row, cut_, n_)
