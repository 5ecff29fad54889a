"""Token counts, token files and pieces against the libraries themselves."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tradewind.llm import byte_bpe, piece_dropout, token_counts, token_file

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
SF = "/root/testdata/sf0.001"


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def docs(spark, awkward):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").withColumn("doc_id", F.col("doc_id") + 100).union(
        awkward.select("doc_id", "text"))


ODD = st.lists(st.sampled_from([*"ab .,'\n\t\r  \x1c\x85\u3000\u2003é9日s▁", "<|endoftext|>", " the"]), max_size=30).map("".join)


@settings(max_examples=400, deadline=None)
@given(ODD)
def test_words_give_the_librarys_ids(text):
    own = byte_bpe.words(byte_bpe.default_path())
    assert np.frombuffer(own.ids(text), "<u4").tolist() == ids_of(text)


def test_counts_equal_the_librarys(docs):
    rows = token_counts.count_tokens(docs, bytes_into="n_bytes").collect()
    want = sorted((r.doc_id or -1, len((r.text or "").encode()), len(ids_of(r.text))) for r in docs.collect())
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in rows) == want


def test_counts_without_a_broadcast_table(docs, monkeypatch):
    monkeypatch.setattr(token_counts, "HOT", 10)
    rows = token_counts.count_tokens(docs).collect()
    assert sorted(r.n_tokens for r in rows) == sorted(len(ids_of(r.text)) for r in docs.collect())


def test_counts_keep_clashing_columns(awkward, nothing):
    out = token_counts.count_tokens(awkward)
    assert set(awkward.columns) - {"text"} <= set(out.columns) and out.count() == awkward.count()
    assert token_counts.count_tokens(nothing).count() == 0


def test_files_give_every_id_back(spark, docs, tmp_path):
    manifest = token_file.write_tokens(docs, str(tmp_path / "files"))
    rows = token_file.read_tokens(spark, manifest).orderBy("start").collect()
    keys = [(-1 if r.doc_id is None else r.doc_id) for r in rows]
    assert keys == sorted(keys)
    want = sorted((-1 if r.doc_id is None else r.doc_id, r.text or "") for r in docs.collect())
    start = 0
    for r, (key, text) in zip(rows, want, strict=True):
        ids = [*ids_of(text), 0]
        assert (r.start, r.n_tokens, list(r.ids)) == (start, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert not [p for p in (tmp_path / "files").iterdir() if p.name.startswith("_")]


def test_no_documents_give_no_files(spark, nothing, tmp_path):
    manifest = token_file.write_tokens(nothing, str(tmp_path / "none"))
    assert token_file.read_tokens(spark, manifest).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=70))
def test_coding_round_trip(values):
    ranks = np.array(values, np.uint32)
    control, data = token_file.pack(ranks)
    assert len(control) == -(-len(values) // 4)
    assert token_file.unpack(control, data, len(values)).tolist() == values


SP = sentencepiece.SentencePieceProcessor(model_file=piece_dropout.default_model())


@settings(max_examples=300, deadline=None)
@given(ODD | st.text(max_size=30))
def test_pieces_without_dropout_are_the_librarys(text):
    own = piece_dropout.pieces(piece_dropout.default_model(), 0.0, 1, 0)
    if "\x00" in text:
        return
    assert np.frombuffer(own.encode(text), "<u4").tolist() == SP.encode(text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60), st.integers(0, 9))
def test_pieces_with_dropout_restore_the_text(text, key):
    own = piece_dropout.pieces(piece_dropout.default_model(), 0.3, 3, 5)
    assert own.decode(own.encode(text, key)).decode() == text.replace("▁", " ")


def test_dropout_varies_but_repeats(spark, awkward, nothing):
    text = awkward.where("doc_id = 1").select("text").first().text
    frame = spark.createDataFrame([(i, text) for i in range(40)], "doc_id bigint, text string")
    one = {r.doc_id: bytes(r.encoded.ids) for r in piece_dropout.encode(frame).collect()}
    two = {r.doc_id: bytes(r.encoded.ids) for r in piece_dropout.encode(frame).collect()}
    assert one == two and len(set(one.values())) > 1
    assert all(len(v) > 4 * len(SP.encode(text)) for v in one.values())
    assert piece_dropout.encode(nothing).count() == 0
    back = piece_dropout.decode(piece_dropout.encode(frame), "encoded.ids").select("encoded.lossless", "decoded").distinct().collect()
    assert [(r.lossless, r.decoded) for r in back] == [(True, text)]
    out = piece_dropout.encode(awkward)
    assert out.count() == awkward.count() and out.where("text is null and encoded.n_pieces = 0").count() == 1


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="the ioninga", min_size=2, max_size=30), st.integers(0, 3))
def test_both_agendas_merge_alike(text, key):
    own = piece_dropout.pieces(piece_dropout.default_model(), 0.2, 3, 5)
    assert own._short(list(text), key) == own._long(list(text), key)


def test_every_occurrence_has_its_own_draws(spark):
    frame = spark.createDataFrame([(i, "international information " * 20) for i in range(60)], "doc_id bigint, text string")
    ids = [bytes(r.encoded.ids) for r in piece_dropout.encode(frame).collect()]
    assert len(set(ids)) == 60
    own = piece_dropout.pieces(piece_dropout.default_model(), 0.1, None, 17)
    draws = own.draws("one document")
    assert len({own.part("▁international", draws) for _ in range(400)}) > 20


@pytest.mark.parametrize("dropout", [0.1, 0.5, 1.0])
def test_candidates_are_skipped_at_the_rate(dropout):
    own = piece_dropout.pieces(piece_dropout.default_model(), dropout, None, 17)
    n = 20_000
    skipped = len(own.encode("a " * (n - 1) + "a", "key")) // 4 - n  # one candidate in each word
    assert abs(skipped - dropout * n) <= 5 * (dropout * (1 - dropout) * n) ** 0.5


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="the ioninga,é", max_size=100), min_size=1, max_size=12))
def test_what_is_remembered_changes_nothing(texts):
    with pytest.MonkeyPatch.context() as patch:
        own = piece_dropout.pieces(piece_dropout.default_model(), 0.3, None, 5)
        patch.setattr(own, "memory", {})
        warm = [own.encode(t, k) for k in range(3) for t in texts]
        again = [own.encode(t, k) for k in range(3) for t in texts]
        patch.setattr(own, "memory", {})
        patch.setattr(piece_dropout, "REMEMBERED", 0)
        assert warm == again == [own.encode(t, k) for k in range(3) for t in texts] and not own.memory


BARS = ["▁▂▃▅▇ load", "a▁b", "▁", " ▁ ▁▁", "▁start", "end ▁"]


@pytest.mark.parametrize("dropout", [0.0, 0.1])
def test_texts_with_u2581_are_restored(spark, dropout):
    frame = spark.createDataFrame(list(enumerate(BARS)), "doc_id bigint, text string")
    rows = piece_dropout.decode(piece_dropout.encode(frame, dropout=dropout), "encoded.ids").collect()
    assert sorted((r.doc_id, r.decoded, r.encoded.lossless) for r in rows) == [(i, t, True) for i, t in enumerate(BARS)]
    assert all(SP.decode(np.frombuffer(r.encoded.ids, "<u4").tolist()) == r.text for r in rows if not r.text.startswith(" "))


@settings(max_examples=200, deadline=None)
@given(ODD | st.text(max_size=60), st.integers(0, 9))
def test_exact_pieces_restore_the_unchanged_text(text, key):
    own = piece_dropout.pieces(piece_dropout.default_model(), 0.3, None, 5)
    assert own.decode(own.encode(text, key, exact=True)).decode() == text


def test_known_words_are_looked_up_once():
    """Known words come with their ids; the places of the others are given, and odd ones are cut as before."""
    own = byte_bpe.Words(byte_bpe.default_path())
    text = "first alpha beta, alpha gamma beta,"
    whole = own.ids(text)
    first, middle, last, new = own._cut(text + " delta")
    assert (first, last, new, middle[-1]) == ("first", [], [5], "delta") and all(isinstance(m, bytes) for m in middle[:-1])
    assert own.ids(text) == whole == np.array(own.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    for odd in ("a  b", " a b ", "a \n b\tc d", "\x85 a b", "a b \x1c"):
        assert own.ids(odd) == np.array(own.tokenizer.encode(odd, add_special_tokens=False).ids, "<u4").tobytes()
