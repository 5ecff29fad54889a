"""Quality rules with an isolation forest over their statistics.

The base rules count words, symbols, repeated lines and repeated word windows.  An isolation forest is
grown on a bounded random sample (TREES x SAMPLE rows, the method's own sub-sampling); a document's mean path
length over the random splits tells how easily it is isolated.  All documents with a quality label calibrate
the cut: the most documents are dropped such that at most `max_loss` of the good ones would be.

Words: `[^\\x20\\x09-\\x0D]+`.  Null and empty texts have no words and fail the base rules.  Without labels of good
documents nothing but the base rules decides.  Documents labelled more than once count as often; null
labels don't count.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import count

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import row_function, utf8

TREES, SAMPLE = 64, 256
BINS = 2_000
MAX_LOSS = 0.01
MIN_WORDS = 50
FEATURES = ("log_words", "word_length", "symbols", "dup_lines", "repeats", "upper", "marks", "pipes")
STATS = (
    "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,"
    "features:array<double>>")

_SPACES, _SYMBOLS, _UPPER, _MARKS = (np.zeros(256, np.uint8) for _ in range(4))
_SPACES[[32, *range(9, 14)]] = 1
_SYMBOLS[list(b"#*$%&|<>")] = 1
_UPPER[65:91] = 1
_MARKS[list(b"!?;:\"'()[]{}=_~^/\\")] = 1


def repeated_words(words: list[bytes]) -> int:
    """Words in 3-word windows that the text has twice or more."""
    n = len(words)
    if n < 3:
        return 0
    first: dict[bytes, int] = {}
    ids = np.fromiter(map(first.setdefault, words, count()), np.int64, n)
    if n < 1 << 20:
        code = (ids[:-2] * n + ids[1:-1]) * n + ids[2:]
    else:
        _, pair = np.unique(ids[:-2] * n + ids[1:-1], return_inverse=True)
        code = pair * n + ids[2:]
    _, inverse, times = np.unique(code, return_inverse=True, return_counts=True)
    again = times[inverse] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= again
    return int(covered.sum())


def statistics(text: bytes | None) -> dict:
    text = text or b""
    words = text.split()
    n = len(words)
    raw = np.frombuffer(text, np.uint8)
    word_chars = int(np.count_nonzero((raw & 0xC0) != 0x80) - _SPACES[raw].sum(dtype=np.int64))
    symbols = int(_SYMBOLS[raw].sum(dtype=np.int64))
    seen: set[bytes] = set()
    lines = dup = 0
    for line in text.split(b"\n"):
        if line.strip():
            lines += 1
            dup += line in seen
            seen.add(line)
    repeats = repeated_words(words)
    per_word, per_char = max(n, 1), max(word_chars, 1)
    features = [
        float(np.log1p(n)), word_chars / per_word, symbols / per_word, dup / max(lines, 1), repeats / per_word,
        float(_UPPER[raw].sum(dtype=np.int64)) / per_char, float(_MARKS[raw].sum(dtype=np.int64)) / per_char,
        text.count(b"|") / per_word]
    return {"n_words": n, "word_chars": word_chars, "n_symbols": symbols, "n_dup_lines": dup, "n_repeat_words": repeats,
            "features": features}


def rule_statistics(docs: DataFrame, text: str = "text", into: str = "rules") -> DataFrame:
    """`docs` with the rules' counts and the forest's features."""
    return docs.withColumn(
        into, row_function(docs.sparkSession, lambda: lambda texts: [statistics(t) for t in texts], STATS)(utf8(F.col(text))))


def base_failed(rules: Column) -> Column:
    return (rules["n_words"] < MIN_WORDS) | (100 * rules["n_repeat_words"] > 50 * rules["n_words"])


def mean_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search among n rows."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1), (n == 2) * 1.0)


@dataclass
class Forest:
    """Trees as arrays: feature (-1: leaf), split value, children, path length at a leaf."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    size: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; the shorter the mean path, the nearer to 1."""
        depth = np.zeros(len(x))
        every = np.arange(len(x))
        for feature, value, child, path in self.trees:
            at = np.zeros(len(x), np.int64)
            while True:
                f = feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                right = x[every, np.maximum(f, 0)] >= value[at]
                at = np.where(inner, child[at] + right, at)
            depth += path[at]
        return 2 ** (-depth / max(len(self.trees), 1) / max(float(mean_path(self.size)), 1e-9))


def grow(rows: np.ndarray, trees: int, sample: int, seed: int = 5) -> Forest:
    rng = np.random.default_rng(seed)
    sample = min(sample, len(rows))
    limit = int(np.ceil(np.log2(max(sample, 2))))
    out = []
    for _ in range(trees):
        own = rows[rng.choice(len(rows), sample, replace=False)]
        feature, value, child, path = [-1], [0.0], [0], [0.0]
        todo = [(0, own, 0)]
        while todo:
            node, part, depth = todo.pop()
            low, high = part.min(0), part.max(0)
            usable = np.flatnonzero(high > low)
            if depth >= limit or not len(usable):
                path[node] = depth + float(mean_path(len(part)))
                continue
            f = int(rng.choice(usable))
            cut = float(rng.uniform(low[f], high[f]))
            if cut <= low[f]:
                cut = float(high[f])
            right = part[:, f] >= cut
            feature[node], value[node], child[node] = f, cut, len(feature)
            for half in (part[~right], part[right]):
                todo.append((len(feature), half, depth + 1))
                for column, x in ((feature, -1), (value, 0.0), (child, 0), (path, 0.0)):
                    column.append(x)
        out.append((np.array(feature), np.array(value), np.array(child), np.array(path)))
    return Forest(out, sample)


def fit(stats: DataFrame, rules: str = "rules", trees: int = TREES, sample: int = SAMPLE, doc_id: str = "doc_id") -> Forest | None:
    """Grown on the trees x sample rows whose id and statistics hash lowest: a bounded random sample, the same one however the rows lie in
    files.  Rows that repeat an id and statistics hash alike, so they are in it together, as far as it reaches."""
    wanted = trees * sample
    picked = stats.select(F.col(f"{rules}.features").alias("f"), F.col(doc_id).cast("string").alias("id")).select(
        "f", F.pmod(F.xxhash64("id", "f", F.lit(11)), F.lit(1 << 40)).alias("u"))
    # twice as many as wanted get this far, so that no task sends much of its own to the driver
    share = min(1.0, 2 * wanted / max(stats.count(), 1))
    rows = picked.where(F.col("u") <= int(share * (1 << 40))).orderBy("u", "f").limit(wanted).select("f").collect()
    return grow(np.array([r.f for r in rows]), trees, sample) if rows else None


def scored(stats: DataFrame, forest: Forest | None, rules: str = "rules", into: str = "anomaly") -> DataFrame:
    if forest is None:
        return stats.withColumn(into, F.lit(0.0))
    shared = stats.sparkSession.sparkContext.broadcast(forest)

    def make():
        own = shared.value

        def work(features):
            x = np.array([f or [0.0] * len(FEATURES) for f in features], float).reshape(-1, len(FEATURES))
            return own.score(x).tolist()

        return work

    return stats.withColumn(into, row_function(stats.sparkSession, make, "double")(F.col(f"{rules}.features")))


def calibrate(
    scores: DataFrame, labels: DataFrame, doc_id: str = "doc_id", anomaly: str = "anomaly", label_id: str = "doc_id",
    quality: str = "quality", max_loss: float = MAX_LOSS,
) -> float:
    """The lowest cut that loses at most `max_loss` of the good documents, from a histogram over all labelled
    rows; 1.0 (nothing is cut) without good ones.  Documents that fail the base rules don't count."""
    marked = labels.select(F.col(label_id).alias("_id"), F.col(quality).cast("int").alias("_good")).dropna()
    bins = (
        scores.where(~base_failed(F.col("rules"))).select(F.col(doc_id).alias("_id"), F.ceil(F.col(anomaly) * BINS).alias("bin"))
        .join(marked, "_id").groupBy("bin").agg(F.sum(F.when(F.col("_good") > 0, 1).otherwise(0)).alias("good"))
        .orderBy(F.desc("bin")).collect())
    total = sum(r.good for r in bins)
    cut, lost = 1.0, 0
    if not total:
        return cut
    for r in bins:
        lost += r.good
        if lost > max_loss * total:
            break
        cut = (r.bin - 1) / BINS
    return cut


def assess(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, rules, anomaly, base_failed and kept of every document; repeated rows are judged alike."""
    from tradewind.llm.common import staged

    stats = staged(rule_statistics(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))).select("doc_id", "rules"), "rules")
    scores = scored(stats, fit(stats))
    cut = calibrate(scores, labels, label_id=doc_id)
    failed = base_failed(F.col("rules"))
    return scores.select(
        "doc_id", "rules", "anomaly", failed.alias("base_failed"), (~failed & (F.col("anomaly") <= cut)).alias("kept"))
