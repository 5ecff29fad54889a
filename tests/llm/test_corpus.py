"""Joins, line removal, sharding and the pipeline against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from tests.llm.conftest import prose
from tests.llm.test_text_rules import plain_hits
from tradewind.llm import jaccard_join, line_spread, piece_dropout, queries, shard_splitters, suffix_decontam

SF = "/root/testdata/sf0.001"


def plain_components(docs, k, num, den):
    def lower(t):
        return "".join(c.lower() if c.isascii() else c for c in t or "")

    sets = []
    for _, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set()))
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(docs)):
        groups[find(i)].append(docs[i][0])
    least = {r: min((x for x in ids if x is not None), default=None) for r, ids in groups.items()}
    return [(docs[i][0], len(sets[i]), least[find(i)]) for i in range(len(docs))]


def order(rows):
    return sorted(rows, key=lambda r: tuple(-1 if x is None else x for x in r))


@pytest.mark.parametrize("num,block", [(90, 1024), (60, 2)])
def test_components_equal_brute_force(spark, monkeypatch, num, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "HUB_GROUP", block)
    rng = random.Random(num)
    docs = []
    common = prose(999, 25)
    for i in range(160):
        if docs and rng.random() < 0.6:
            words = (rng.choice(docs)[1] or "x").split()
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                words[rng.randrange(len(words))] = rng.choice(["new", "word", "ALPHA"])
            docs.append((i, " ".join(words)))
        else:
            docs.append((i, prose(i, rng.choice([1, 2, 3, 6, 30, 90])) + (" " + common if rng.random() < 0.3 else "")))
    docs += [(900, None), (901, ""), (902, " \n"), (0, docs[0][1]), (3, prose(5, 9)), (None, docs[1][1])]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(frame, 3, num, 100).collect()]
    assert order(got) == order(plain_components(docs, 3, num, 100))


def test_bitmap_bounds_hold():
    a = jaccard_join.shingles(prose(1, 900).encode(), 3)
    b = jaccard_join.shingles((prose(1, 880) + prose(2, 30)).encode(), 3)
    x, y = jaccard_join.bitmap(a), jaccard_join.bitmap(b[:300])
    words = min(len(x), len(y))
    apart = int(sum(int(v).bit_count() for v in jaccard_join.folded(x, words) ^ jaccard_join.folded(y, words)))
    assert apart <= len(set(a.tolist()) ^ set(b[:300].tolist()))


def test_near_copies_of_awkward_rows(awkward, nothing):
    kept = jaccard_join.drop_near_copies(awkward)
    assert kept.columns == awkward.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[1] == 1 and 2 not in ids and ids[4] == ids[5] == ids[6] == 1 and ids[None] == 1
    assert jaccard_join.drop_near_copies(nothing).count() == 0


def test_near_copies_go_by_id_and_text(spark):
    a, b, c, d = (prose(i, 60) for i in (11, 12, 13, 14))
    rows = [(1, a, "x"), (3, a + " tail", "x"), (3, b, "x"), (None, c, "x"), (None, c + " tail", "y"), (5, d, "y"), (5, d, "x"),
            (None, d, "z"), (6, "", "x"), (6, "", "x"), (None, None, "x")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    kept = [tuple(r) for r in jaccard_join.drop_near_copies(frame).collect()]
    for start in (a, b, c, d):
        assert sum((t or "").startswith(start) for _, t, _ in kept) == 1
    assert {(1, a, "x"), (3, b, "x"), (5, d, "x")} <= set(kept)
    assert kept.count((6, "", "x")) == 2 and kept.count((None, None, "x")) == 1 and len(kept) == 7


def plain_lines(rows, least):
    sites, first = defaultdict(set), {}
    for doc_id, text, site in rows:
        for pos, line in enumerate((text or "").split("\n") if text is not None else []):
            if re.search(r"[^\x20\x09-\x0D]", line):
                sites[line].add(site or "")
                first[line] = min(first.get(line, (doc_id, pos)), (doc_id, pos))
    return [(d, None if t is None else "\n".join(
        x for p, x in enumerate(t.split("\n")) if len(sites[x]) < least or first[x] == (d, p))) for d, t, s in rows]


@pytest.mark.parametrize("near", [0.05, 0.9])
def test_spread_lines_equal_brute_force(spark, near, monkeypatch):
    monkeypatch.setattr(line_spread.boilerplate, "__defaults__", (3, line_spread.LG_K, near))
    rng = random.Random(4)
    lines = [prose(i, 6) for i in range(15)] + ["", "  "]
    rows = [(i, "\n".join(rng.choices(lines, k=rng.randrange(1, 6))), rng.choice(["a", "b", "c", "d", None])) for i in range(40)]
    rows += [(50, None, "a"), (51, "", "b"), (52, "\n\n", "c")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = sorted((r.doc_id, r.text) for r in line_spread.drop_spread_lines(frame, min_sites=3).where("text is not null").collect())
    assert got == sorted(x for x in plain_lines(rows, 3) if x[1] is not None)


def test_spread_of_awkward_rows(awkward, nothing):
    out = line_spread.drop_spread_lines(awkward)
    assert out.columns == awkward.columns and order((r.doc_id,) for r in out.collect()) == order((r.doc_id,) for r in awkward.collect())
    assert line_spread.drop_spread_lines(nothing).count() == 0


def shard_laws(rows, docs, longest):
    assert sorted((r.size, r.text_crc32) for r in rows) == sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in docs)
    total = sum(r.size for r in rows)
    sizes, slots = Counter(), defaultdict(list)
    for r in rows:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert set(sizes) <= set(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(abs(sizes[k] - total / 8) <= longest + 0.005 * total / 8 + 1 for k in range(8))


def test_shards_are_even(spark, awkward, nothing):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    for range_rows in (shard_splitters.RANGE_ROWS, 20):
        shard_laws(shard_splitters.shard(frame, range_rows=range_rows).collect(), docs, max(len(t.encode()) for _, t in docs))
    assert shard_splitters.shard(awkward).count() == awkward.count() and shard_splitters.shard(nothing).count() == 0


def test_a_hot_text_is_cut_and_small_groups_stay(spark):
    docs = [(i, "hot " * 5) for i in range(600)] + [(1000 + i, prose(i // 2, 12)) for i in range(1200)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    rows = shard_splitters.shard(frame, range_rows=50, whole_share=0.05).collect()
    shard_laws(rows, docs, 600)
    of = defaultdict(set)
    for r in rows:
        of[r.doc_id < 1000, r.text_crc32].add(r.shard)
    assert len(of[True, zlib.crc32(b"hot " * 5)]) > 1
    assert all(len(s) == 1 for (hot, _), s in of.items() if not hot)


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert 0.5 * before < out.count() <= docs.count()
        docs = out
    rows = corpus_pipeline.run(spark, SF).collect()
    assert len(rows) == docs.count() and all(r.lossless and len(r.ids) == 4 * r.n_pieces for r in rows)


def test_pipeline_takes_awkward_rows(spark, awkward, nothing):
    for frame in (awkward, nothing):
        docs = frame
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        docs.collect()


def test_every_query_is_registered():
    import __spark_entry__ as entry

    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(queries.ORACLE) <= set(entry.oracle_sql())


def planted():
    """(documents, benchmark items): clean rows, near copies, lines of eight sites, benchmark passages, texts without a letter."""
    item = prose(500, 30)
    line = "all rights reserved by the site " + prose(501, 4)
    clean = [(i, prose(600 + i, 60), f"s{i % 9}") for i in range(24)]
    docs = clean + [(100 + i, t + " tail", s) for i, t, s in clean[:5]] + [(110, clean[6][1], "s1"), (3, prose(700, 50), "s2")]
    docs += [(200 + i, line + "\n" + prose(800 + i, 50), f"s{i}") for i in range(9)] + [(220, line, "s3"), (221, line + "\n" + line, "s4")]
    docs += [(300 + i, prose(900 + i, 20) + " " + item + " " + prose(950 + i, 20), "s5") for i in range(3)]
    docs += [(310, " ".join(item.split()[:12]) + " " + prose(990, 40), "s6"), (400, "12 34 ...", "s7"), (401, "", "s7"), (402, None, "s8")]
    docs += [(403, "▁▂▃ load " + prose(991, 12), "s8"), (404, "a", "s1"), (None, prose(992, 30), "s1")]
    return docs, [("q1", item), ("q2", prose(502, 25))]


def plain_stages(docs, items):
    docs = [d for d in docs if d[1] is not None and any(c.isalpha() for c in d[1])]
    yield docs
    cut = plain_lines([(10**9 if i is None else i, t, s) for i, t, s in docs], line_spread.MIN_SITES)
    docs = [(i, t, s) for (i, old, s), (_, t) in zip(docs, cut, strict=True) if t == old or t]
    yield docs
    # ids are unlike for each row here, so that a component can be told by them
    parts = plain_components([(k, t) for k, (_, t, _) in enumerate(docs)], 5, 80, 100)
    groups = defaultdict(list)
    for k, _, least in parts:
        groups[least].append(docs[k])
    docs = [min(g, key=lambda d: (d[0] is None, d[0])) for g in groups.values()]
    yield docs
    hits = [(d, *plain_hits((d[1] or "").encode(), [(n, t.encode()) for n, t in items], suffix_decontam.WINDOW)[:2]) for d in docs]
    yield [d for d, words, hit in hits if not hit or 20 * hit < words]


def test_pipeline_equals_plain_stages(spark, tmp_path):
    rows, items = planted()
    frame = spark.createDataFrame(
        [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, sizes = spark.read.parquet(str(tmp_path / "documents.parquet")), [len(rows)]
    for k, ((name, stage), want) in enumerate(zip(corpus_pipeline.STAGES, plain_stages(rows, items))):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / f"out{k}"))
        docs = spark.read.parquet(str(tmp_path / f"out{k}"))
        got = [(r.doc_id, r.text, r.source) for r in docs.collect()]
        assert Counter(got) == Counter(want), name
        assert all(r.n_chars == len(r.text) for r in docs.collect()), name
        sizes.append(len(got))
    assert all(a > b for a, b in zip(sizes, sizes[1:])), sizes
    own = piece_dropout.pieces(piece_dropout.default_model(), 0.0, None, 0)
    coded = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    pieces = [(r.doc_id, own.decode(bytes(r.ids)).decode(), r.source) for r in coded]
    assert Counter(pieces) == Counter(want) and all(r.lossless for r in coded)
