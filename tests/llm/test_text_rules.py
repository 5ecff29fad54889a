"""Personal data, language, quality and decontamination against plain versions."""

from __future__ import annotations

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from tradewind.llm import language_mixture, pii, quality_forest, queries, suffix_decontam

SF = "/root/testdata/sf0.01"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else True,
                "card": 12 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], list(PATTERNS).index(s[0])))


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a1.@-+ 0(9%é4", max_size=40) | st.lists(st.sampled_from(
    ["1.2.3.4", "256.1.1.1", ".", "@", "a@b.co", "4111 1111 1111 1111", "+1 (235) 555-3833", "-", " ", "é", "4111111111111111", "+", "9"]),
    max_size=9).map("".join))
def test_base_spans_equal_the_patterns(text):
    found = [s for s in pii.Finder().spans(text) if s[0] in pii.BASE]
    assert found == plain_spans(text)


def test_added_kinds_and_mask(spark):
    text = "IBAN: GB82 WEST 1234 5698 7654 32 or account no. 12345678, see https://ann:pw@host.example/x and https://plain.example/"
    found = [(k, text[s:e]) for k, s, e in pii.Finder().spans(text) if k not in pii.BASE]
    assert found == [("account", "GB82 WEST 1234 5698 7654 32"), ("account", "12345678"), ("url", "https://ann:pw@host.example/x")]
    masked = pii.mask(spark.createDataFrame([(text,), (None,), ("",)], "text string")).collect()
    assert masked[0].text == "IBAN: <account> or account no. <account>, see <url> and https://plain.example/"
    assert masked[1].text is None and masked[2].text == ""


def test_pii_takes_awkward_rows(awkward, nothing):
    out = pii.pii(awkward)
    assert out.columns == awkward.columns and out.count() == awkward.count() and pii.pii(nothing).count() == 0


def test_languages_are_learned(spark, awkward, nothing):
    rows = queries.op5_language_mixture(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    got = rows.where("held_out").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double")), F.min("score"), F.max("score")).first()
    assert got[0] >= 0.95 and got[1] >= 0 and got[2] <= 1
    model = language_mixture.train(awkward)
    out = {(r.doc_id, (r.text or "")[:3]): r.language.lang for r in language_mixture.identify(awkward, model).collect()}
    assert out[4, ""] == out[5, ""] == "und" and out[6, " \n\t"] == "und" and out[1, awkward.first().text[:3]] in ("en", "fr", "de")
    empty = language_mixture.train(nothing)
    assert {r.language.lang for r in language_mixture.identify(awkward, empty).collect()} == {"und"}


def test_mixture_shares(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_mixture.train(docs)
    texts = {r.lang: r.text for r in docs.where("length(text) > 3000").groupBy("lang").agg(F.first("text").alias("text")).collect()}
    lang, score, shares = model.predict(texts["en"][:2000] + " " + texts["de"][:1000])
    assert lang == "en" and set(shares) == {"en", "de"} and 0.5 < score < 0.8
    assert abs(shares["en"] - 2 / 3) < 0.1


def plain_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab \n\x1c\x85é|#$<", max_size=60))
def test_rule_counts(text):
    s = quality_forest.statistics(text.encode())
    assert (s["n_words"], s["word_chars"], s["n_symbols"], s["n_dup_lines"], s["n_repeat_words"]) == plain_statistics(text)


def test_quality_keeps_the_good(spark, awkward, nothing):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = queries.op7_quality_forest(spark, SF).join(labels, "doc_id").where("not base_failed")
    good = rows.where("quality = 1").agg(F.avg(F.col("kept").cast("double"))).first()[0]
    bad = rows.where("quality = 0").agg(F.avg(F.col("kept").cast("double"))).first()[0]
    assert good >= 0.98 and bad < good
    out = quality_forest.assess(awkward, labels.where("false"))
    assert out.count() == awkward.count() and out.where("doc_id = 4 and base_failed and not kept").count() == 1
    assert quality_forest.assess(nothing, labels).count() == 0


def plain_hits(text, items, window):
    words = suffix_decontam.words_of(text)
    hit, names = set(), set()
    for name, t in items:
        own = suffix_decontam.words_of(t)
        k = min(window, len(own))
        for i in range(len(own) - k + 1) if k else ():
            for j in range(len(words) - k + 1):
                if words[j : j + k] == own[i : i + k]:
                    hit |= set(range(j, j + k))
                    names.add(name)
    return len(words), len(hit), sorted(names)


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_hits_equal_plain_search(spark, block_bytes):
    rng = random.Random(3)
    items = [(str(i), prose(100 + i, rng.choice([1, 2, 5, 9, 14])).encode()) for i in range(12)] + [("0", b"mu nu xi"), ("99", b" ")]
    docs = []
    for i in range(60):
        words = prose(i, 40).split()
        for _ in range(rng.randrange(3)):
            own = rng.choice(items)[1].decode().split()
            at = rng.randrange(len(words))
            words[at:at] = own[rng.randrange(2) :]
        docs.append((i, " ".join(words)))
    docs += [(60, None), (61, ""), (62, items[4][1].decode())]
    bench = spark.createDataFrame([(n, t.decode()) for n, t in items] + [(None, "alpha beta"), ("77", None)], "item_id string, text string")
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = suffix_decontam.matches(frame, bench, window=5, block_bytes=block_bytes).collect()
    for r in got:
        want = plain_hits((r.text or "").encode(), items, 5)
        assert (r.matches.n_words, r.matches.n_hit, r.matches["items"]) == want, r.doc_id


def test_longest_match_and_awkward_rows(spark, awkward, nothing):
    text = prose(7, 30)
    bench = spark.createDataFrame([("q", text)], "item_id string, text string")
    docs = spark.createDataFrame([(1, "before " + " ".join(text.split()[:20]) + " after")], "doc_id bigint, text string")
    (row,) = suffix_decontam.matches(docs, bench).collect()
    assert [(s.start, s.end, s.longest) for s in row.matches.spans] == [(1, 21, 20)]
    clean = suffix_decontam.decontaminate(awkward, bench)
    assert clean.columns == awkward.columns and clean.count() == awkward.count()
    assert suffix_decontam.decontaminate(nothing, bench).count() == 0
    assert suffix_decontam.decontaminate(awkward, bench.where("false")).count() == awkward.count()


def test_clean_documents_stay_whatever_the_number_of_labels(spark):
    import random
    import string

    from tradewind.llm import language_mixture

    rng = random.Random(8)
    words = {f"l{i:02}": ["".join(rng.choices(string.ascii_lowercase, k=6)) for _ in range(30)] for i in range(40)}
    train = spark.createDataFrame([(k, " ".join(w * 3)) for k, w in words.items()], "lang string, text string")
    docs = [w[0] + " " + w[1] for w in words.values()]
    docs += [" ".join(words["l01"][:8] + words["l02"][:6] + words["l03"][:6])]
    frame = spark.createDataFrame([(t,) for t in [*docs, "12 34", "", None]], "text string")
    found = language_mixture.identify(frame, language_mixture.train(train))
    kept = found.where(~language_mixture.rejected(F.col("language"))).collect()
    assert sorted(r.text for r in kept) == sorted(docs)


def test_forest_does_not_depend_on_files(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    found = [
        {(r.doc_id, r.anomaly, r.kept) for r in quality_forest.assess(docs.repartition(n), labels).select("doc_id", "anomaly", "kept").collect()}
        for n in (1, 9)]
    assert found[0] == found[1]


def test_batch_bound_may_have_a_unit(spark):
    from tradewind.llm import common

    before = spark.conf.get(common.BATCH_KEY)
    try:
        for given, left in (("64m", str(common.BATCH_BYTES)), ("1m", "1m")):
            spark.conf.set(common.BATCH_KEY, given)
            common.ship(spark)
            assert spark.conf.get(common.BATCH_KEY) == left
    finally:
        spark.conf.set(common.BATCH_KEY, before)
