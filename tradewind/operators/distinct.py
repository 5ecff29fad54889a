"""Exact distinct counts that roll up: sets of integer ids as 64-bit words.

A set is rows (keys, word, bits): id >> 6 and the bits of the ids in that word.  Words are merged by a bitwise or, a plain
hash aggregate that tasks apply before the shuffle, so a set of days rolls up to weeks, months and periods without looking at
rows again, and a dense set is an eighth of a byte per id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INTEGERS = {"tinyint", "smallint", "int", "bigint"}


def id_words(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """(keys, word, bits) of the distinct ids per key; null ids are left out."""
    number = F.col(column).cast("bigint")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), number.bitwiseAND(F.lit(63)).cast("int"))
    return df.filter(F.col(column).isNotNull()).groupBy(*keys, F.shiftright(number, 6).alias("word")).agg(F.bit_or(bit).alias("bits"))


def merged(words: DataFrame, keys: list[str | Column]) -> DataFrame:
    """The sets of coarser keys."""
    return words.groupBy(*keys, "word").agg(F.bit_or("bits").alias("bits"))


def set_sizes(words: DataFrame, keys: list[str], out: str) -> DataFrame:
    """Ids per key of sets that are merged to these keys."""
    return words.groupBy(*keys).agg(F.sum(F.bit_count("bits")).cast("bigint").alias(out))


def distinct_counts(df: DataFrame, keys: list[str], column: str, out: str) -> DataFrame:
    """Distinct non-null values per key: words for integer ids, a single distinct aggregate for others."""
    if dict(df.dtypes)[column] in INTEGERS:
        return set_sizes(id_words(df, keys, column), keys, out)
    return df.filter(F.col(column).isNotNull()).groupBy(*keys).agg(F.countDistinct(column).alias(out))
