"""Language identification as inference of a mixture.

A document's character trigrams are taken as drawn from a mixture of languages.  Training counts hashed
trigrams per language over all training documents.  For a document, expectation-maximisation estimates the
languages' proportions from the trigram likelihoods; nested sets of the likeliest languages are then fitted
and the set with the least penalised likelihood (-2 log L + 3 (k - 1) log (n + 1)) is kept.  The prediction is the
language of the largest proportion in that set; the score is that proportion, shrunk towards an even spread
in short texts.

Null texts, and texts without a letter, are `und` with score 0; so is every text if nothing was learned.
Ties go to the language that sorts first.  Training rows without text or language are left out.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import row_function, ship

BUCKETS = 1 << 14
MAX_LANGUAGES = 1000  # bound of the model that is broadcast: MAX_LANGUAGES x BUCKETS float32
UNKNOWN = "und"
SMOOTHING = 0.5
ROUNDS = 12
LEAST_SHARE = 0.02  # languages below this share after the first fit are not candidates
PRIOR = 1.0
RESULT = "struct<lang:string,score:double,shares:map<string,double>>"

_NOT_LETTERS = re.compile(r"[\W\d_]+")
_WEIGHTS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def trigrams(text: str) -> np.ndarray:
    """Bucket of every character trigram; runs of other characters than letters count as one space."""
    plain = " " + _NOT_LETTERS.sub(" ", text.lower()).strip() + " "
    code = np.frombuffer(plain.encode("utf-32-le", "replace"), np.uint32)
    if len(code) < 3:
        return np.empty(0, np.int64)
    h = code[:-2] * _WEIGHTS[0] + (code[1:-1] ^ np.uint32(0x5BD1)) * _WEIGHTS[1] + (code[2:] ^ np.uint32(0xA3C5)) * _WEIGHTS[2]
    h ^= h >> np.uint32(15)
    return (h * _WEIGHTS[1] >> np.uint32(18)).astype(np.int64)


@dataclass
class Model:
    languages: list[str]
    log_likelihood: np.ndarray  # buckets x languages

    def predict(self, text: str | None) -> tuple[str, float, dict[str, float]]:
        if not text or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, {}
        counts = np.bincount(trigrams(text), minlength=BUCKETS)
        seen = np.flatnonzero(counts)
        n = counts[seen].astype(np.float64)
        total = n.sum()
        if not total:
            return UNKNOWN, 0.0, {}
        log_l = self.log_likelihood[seen]
        peak = log_l.max(1)
        like = np.exp(log_l - peak[:, None])
        base = n @ peak
        shares, _ = _fit(like, n, total, ROUNDS)
        order = np.argsort(-shares, kind="stable")
        order = order[: max(1, int((shares > LEAST_SHARE).sum()))]
        best = None
        for k in range(1, len(order) + 1):
            chosen = order[:k]
            part = like[:, chosen]
            if k == 1:
                p, fit = np.ones(1), base + n @ np.log(np.maximum(part[:, 0], 1e-300))
            else:
                p, fit = _fit(part, n, total, ROUNDS)
                fit += base
            cost = -2 * fit + (k - 1) * np.log(total + 1) * 3
            if best is None or cost < best[0]:
                best = cost, chosen, p
            elif k > best[1].size + 1:
                break
        _, chosen, p = best
        top = int(np.argmax(p))
        score = (p[top] * total + PRIOR) / (total + PRIOR * max(2, len(self.languages)))
        return (self.languages[chosen[top]], float(score),
                {self.languages[c]: float(x) for c, x in zip(chosen, p)})


def _fit(like: np.ndarray, n: np.ndarray, total: float, rounds: int) -> tuple[np.ndarray, float]:
    """Proportions by expectation-maximisation, and the log likelihood."""
    p = np.full(like.shape[1], 1 / like.shape[1])
    for _ in range(rounds):
        mixed = like @ p + 1e-300
        new = p * ((n / mixed) @ like) / total
        if np.abs(new - p).max() < 1e-4:
            p = new
            break
        p = new
    return p, float(n @ np.log(like @ p + 1e-300))


def _count(batches):
    """Trigram counts per language of one task: one row per language and bucket seen."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = counts.get(lang)
            if own is None:
                own = counts[lang] = np.zeros(BUCKETS, np.int64)
            own += np.bincount(trigrams(text), minlength=BUCKETS)
    for lang, own in counts.items():
        seen = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(seen), pa.string()), pa.array(seen, pa.int64()), pa.array(own[seen], pa.int64())],
            ["lang", "bucket", "n"])


def train(labelled: DataFrame, lang: str = "lang", text: str = "text") -> Model:
    """Learns from all rows of `labelled` that have both.  Only the model reaches the driver: its size is
    languages x BUCKETS, and more than MAX_LANGUAGES languages are refused."""
    ship(labelled.sparkSession)
    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")).dropna()
    counts = rows.mapInArrow(_count, "lang string, bucket bigint, n bigint")
    per_lang = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).groupBy("lang").agg(
        F.collect_list("bucket").alias("buckets"), F.collect_list("n").alias("counts"))
    found = per_lang.limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    found.sort(key=lambda r: r.lang)
    table = np.full((BUCKETS, len(found)), SMOOTHING)
    for i, r in enumerate(found):
        table[r.buckets, i] += r.counts
    return Model([r.lang for r in found], np.log(table / table.sum(0)).astype(np.float32))


def identify(docs: DataFrame, model: Model, text: str = "text", into: str = "language") -> DataFrame:
    """`docs` with `into`: lang, score and the shares of the chosen language set."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def make():
        own = shared.value

        def work(texts):
            return [
                {"lang": lang, "score": score, "shares": list(shares.items())} for lang, score, shares in map(own.predict, texts)]

        return work

    return docs.withColumn(into, row_function(spark, make, RESULT)(F.col(text).cast("string")))


def rejected(found: Column) -> Column:
    """No language.  The score says nothing here: in short texts it falls with the number of learned languages."""
    return found["lang"] == UNKNOWN
