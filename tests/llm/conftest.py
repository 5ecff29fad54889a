from __future__ import annotations

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> str:
    import random

    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and blank texts, one very long text, repeated rows, equal ids, odd characters, and columns whose
    names clash with those that operators use."""
    base = prose(1, 120)
    rows = [
        (1, base, "en", "a"), (2, base, "en", "b"), (2, base, "en", "b"), (3, base + " tail", None, None), (4, None, "en", "a"),
        (5, "", "fr", "a"), (6, " \n\t ", None, "b"), (7, prose(2, 20_000), "en", "c"), (8, "one", "de", None), (9, "one two", "de", "c"),
        (None, prose(3, 60), "en", "a"), (10, "x" * 50_000, "en", "a"), (11, "<|endoftext|> a<|endoftext|>", "en", "d"),
        (12, "tab\tand  two spaces \n\n new　line\x85 ▁ \x1c end ", "en", "d"), (13, "日本語のテキスト é ñ 'll don't", None, "e"),
        (14, "same line\nsame line\nother line\n", "en", "f"), (3, prose(4, 70), "en", "a")]
    schema = (
        "doc_id bigint, text string, lang string, source string, row string, node bigint, h string, pos int, comp string, _cut int,"
        " matches string, spans string, language string, encoded string, rules string, anomaly double, key string, n bigint, shard string")
    return spark.createDataFrame([r + (None,) * 15 for r in rows], schema)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.where("false")


@pytest.fixture(scope="session", autouse=True)
def few_partitions(spark):
    """Small tables: as many shuffle partitions as pay here."""
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")
