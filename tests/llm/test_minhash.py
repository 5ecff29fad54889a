"""b-bit MinHash: estimates, planted similarities, and components against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tests.llm.conftest import prose
from tests.llm.test_corpus import order, plain_components
from tradewind.llm import minhash_dedup as md
from tradewind.llm.jaccard_join import shingles


def random_sets(rng, common, apart):
    both = rng.integers(0, 2**64, common + 2 * apart, dtype=np.uint64)
    return both[: common + apart], np.concatenate((both[:common], both[common + apart :]))


@pytest.mark.parametrize("common,apart", [(100, 0), (850, 75), (600, 200), (40, 20), (10, 500)])
def test_corrected_estimate_is_unbiased(common, apart):
    rng = np.random.default_rng(common)
    true = common / (common + 2 * apart)
    found = []
    for _ in range(60):
        x, y = random_sets(rng, common, apart)
        a, b = (md.planes([md.packed(md.minima(s))]) for s in (x, y))
        found.append(md.similarity(int(md.equal_minima(a, b)[0])))
    assert abs(np.mean(found) - true) < 0.015
    if true >= 0.85:
        assert all(md.K * (2.0**-md.BITS + (1 - 2.0**-md.BITS) * f) >= md.least_equal(85, 100) for f in found)


@pytest.mark.parametrize("common,apart", [(100, 0), (850, 75), (60, 40), (0, 9), (30_000, 9_000)])
def test_parities_bound_the_overlap(common, apart):
    rng = np.random.default_rng(apart)
    x, y = random_sets(rng, common, apart)
    bound = md.overlap_bound(len(x), len(y), md.parity(x), md.parity(y))
    assert common <= bound <= common + apart
    if 0 < apart < 1000:
        assert bound <= common + 0.5 * apart


def test_pairs_at_the_threshold_share_a_band():
    """Of 400 pairs a little above 0.85 none may be lost; few bands alone would lose some."""
    rng = np.random.default_rng(1)
    bands = md.bands_for(85, 100)
    assert (1 - 0.85**md.ROWS) ** bands <= md.MISSED and bands * md.ROWS <= md.K
    lost = 0
    for _ in range(400):
        x, y = random_sets(rng, 171, 15)  # 171 / 201
        a, b = (md.minima(s)[: bands * md.ROWS].reshape(bands, md.ROWS) for s in (x, y))
        lost += not (a == b).all(1).any()
    assert lost == 0


def fixture_docs(seed, n):
    rng = random.Random(seed)
    common, docs = prose(999, 25), []
    for i in range(n):
        if docs and rng.random() < 0.6:
            words = (rng.choice(docs)[1] or "x").split()
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                words[rng.randrange(len(words))] = f"new{rng.randrange(999)}"
            text = " ".join(words)
        else:
            text = prose(seed * 1000 + i, rng.choice([1, 3, 5, 40, 120, 300])) + rng.choice(["", " " + common])
        docs.append((i + 1, rng.choice([text, text, text.upper(), "  " + text + "\n"])))
    return docs + [(n + 1, None), (n + 2, ""), (n + 3, " \t")]


@pytest.mark.parametrize("num,block,group", [(85, 2048, 256), (85, 2, 2), (75, 3, 1)])
def test_components_equal_brute_force(spark, monkeypatch, num, block, group):
    monkeypatch.setattr(md, "BLOCK", block)
    monkeypatch.setattr(md, "GROUP", group)
    monkeypatch.setattr(md, "ROUNDS", 2 if block > 100 else 1)
    docs = fixture_docs(num + block, 150)
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = [(r.doc_id, r.n_shingles, r.component_id) for r in md.near_duplicates(table, 5, num, 100).collect()]
    assert order(found) == order(plain_components(docs, 5, num, 100))


def test_awkward_rows(spark, awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]
    found = md.near_duplicates(awkward).collect()
    expected = plain_components(rows, 5, 85, 100)
    expected = [(d, n, d if c is None else c) for d, n, c in expected]
    assert order([(r.doc_id, r.n_shingles, r.component_id) for r in found]) == order(expected)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    assert md.near_duplicates(nothing).count() == 0


def test_chain_is_one_component_and_copies_don_t_pair(spark):
    """Each text is near its neighbours only; each comes in many copies."""
    words = prose(50, 160).split()
    docs = []
    for i in range(12):
        words = words.copy()
        words[(i * 13) % 160] = f"step{i}"
        docs += [(1000 * i + c, " ".join(words)) for c in range(40)]
    found = md.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"), 5, 85, 100).collect()
    sets = [shingles(t.encode(), 5) for _, t in docs[::40]]
    ends = len(np.intersect1d(sets[0], sets[-1])) / len(np.union1d(sets[0], sets[-1]))
    assert ends < 0.85 and {r.component_id for r in found} == {0} and sum(r.kept for r in found) == 1


def test_pairs_of_a_cluster_do_not_grow_with_its_square(spark, monkeypatch):
    """40 near copies, all within the threshold, give each round at most one pair a node, not all 780 at once."""
    monkeypatch.setattr(md, "ROUNDS", 0)
    rng, base, docs = random.Random(5), prose(77, 300).split(), []
    for i in range(40):
        words = list(base)
        words[rng.randrange(300)] = f"new{i}"
        docs.append((i + 1, " ".join(words)))
    counts, confirmed = [], md._Candidates.confirmed
    monkeypatch.setattr(md._Candidates, "confirmed", lambda own, pairs: counts.append(pairs.count()) or confirmed(own, pairs))
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert {r.component_id for r in md.near_duplicates(table, 5, 85, 100).collect()} == {1}
    assert counts and sum(counts) <= 2 * len(docs)


def test_partners_that_fail_give_way_to_the_next(spark, monkeypatch):
    """Every rejected partner is followed by others until none is left: links are those of brute force."""
    monkeypatch.setattr(md, "ROUNDS", 0)
    monkeypatch.setattr(md, "MORE", 2)
    rng, base, docs = random.Random(8), prose(55, 120).split(), []
    for i in range(45):
        words = list(base)
        for _ in range(rng.choice([1, 2, 3])):
            words[rng.randrange(120)] = f"new{rng.randrange(12)}"
        docs.append((i + 1, " ".join(words)))
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = [(r.doc_id, r.component_id) for r in md.near_duplicates(table, 5, 85, 100).collect()]
    expected = plain_components(docs, 5, 85, 100)
    assert sorted(found) == sorted((d[0], d[-1]) for d in expected)
    assert 1 < len({c for _, c in found}) < 45
