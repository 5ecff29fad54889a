"""Cross-tokenizer alignment against a plain program that works on whole texts."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tradewind.llm import queries, token_alignment

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def whole(text, libraries):
    """Groups and links of one text, by byte ranges of every token."""
    a, b = libraries
    if not text:
        return None
    signs = token_alignment.byte_of_sign()
    body = (" " + text).encode()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(signs[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") and b.is_byte(b.piece_to_id(p)) else p.replace("▁", " ").encode()
               for p in map(b.id_to_piece, ids_b)]
    if b"".join(bytes_a) != body or b"".join(bytes_b) != body:
        return None

    def ranges(parts):
        at, out = 0, []
        for p in parts:
            out.append((at, at + len(p)))
            at += len(p)
        return out

    ra, rb = ranges(bytes_a), ranges(bytes_b)
    ends = sorted({e for _, e in ra} & {e for _, e in rb})
    groups, start = [], 0
    for end in ends:
        groups.append(",".join(str(i) for i, r in zip(ids_a, ra) if start <= r[0] < end) + "|" + ",".join(
            str(i) for i, r in zip(ids_b, rb) if start <= r[0] < end))
        start = end
    links = [(i, j) for i, x in zip(ids_a, ra) for j, y in zip(ids_b, rb) if x[0] < y[1] and y[0] < x[1]]
    return ids_a, ids_b, groups, links


def plain(rows, libraries):
    found = [(d, whole(t, libraries)) for d, t in rows]
    counts = Counter(p for _, w in found if w for p in set(w[3]))
    most = defaultdict(int)
    for (i, _), n in counts.items():
        most[i] = max(most[i], n)
    out = []
    for d, w in found:
        if not w:
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
            continue
        out.append((
            d, len(w[0]), len(w[1]), len(w[2]), len(w[3]), sum(counts[p] == most[p[0]] for p in w[3]), sum(counts[p] for p in w[3]),
            hashlib.sha256(";".join(w[2]).encode()).hexdigest()))
    return out


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def digest(c):
    from pyspark.sql import functions as F

    return F.when(c == "", c).otherwise(F.sha2(c, 256))


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("ab é日 \t\n 　▁.,'<|s>0ﬁ́\x00😀"), min_size=1, max_size=30))
def test_parts_align_as_whole_texts(text):
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")) if not _kept else _kept[0]
    if not _kept:
        a.encode_special_tokens = True
        _kept.extend([a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))])
    own = token_alignment.aligner(*token_alignment.default_files()).texts([text])[0]
    expected = whole(text, _kept)
    if expected is None:
        assert own[:5] == (0, 0, 0, 0, "")
    else:
        assert own[:5] == (len(expected[0]), len(expected[1]), len(expected[2]), len(expected[3]), ";".join(expected[2]))
        assert sorted(own[5].tolist()) == sorted(i << 32 | j for i, j in expected[3])


_kept: list = []


@pytest.mark.parametrize("hot", [token_alignment.HOT, 50, 0])
def test_equals_plain_program(spark, libraries, monkeypatch, hot):
    monkeypatch.setattr(token_alignment, "HOT", hot)
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 1500")
    docs = docs.unionByName(docs.where("doc_id % 3 = 0"))
    expected = plain([tuple(r) for r in docs.select("doc_id", "text").collect()], libraries)
    assert found(token_alignment.alignment(docs, groups=digest)) == sorted(expected, key=str)


def test_awkward_rows(spark, awkward, nothing, libraries):
    short = awkward.where("text is null or length(text) < 3000")
    columns = "doc_id", "text"
    expected = plain([tuple(r) for r in short.select(*columns).collect()], libraries)
    assert found(token_alignment.alignment(short, groups=digest)) == sorted(expected, key=str)
    long = {r.doc_id: r for r in token_alignment.alignment(awkward).collect()}
    assert long[7].n_a > 20_000 and long[10].n_groups > 0 and long[10].groups.count(";") == long[10].n_groups - 1
    assert token_alignment.alignment(nothing).count() == 0


def test_query_columns(spark):
    df = queries.op11_token_alignment(spark, SF)
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert dict(df.dtypes)["count_sum"] == "bigint" and df.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
