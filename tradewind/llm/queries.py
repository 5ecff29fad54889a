"""The operators as registered queries over the whole sample tables, and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import (
    conversation_repair,
    jaccard_join,
    language_mixture,
    line_spread,
    minhash_dedup,
    piece_dropout,
    pii,
    quality_forest,
    shard_splitters,
    suffix_decontam,
    token_alignment,
    token_counts,
    token_file,
)
from tradewind.llm.common import crc_part, delete_at_end
from tradewind.sources.scratch import scratch_path

OVER_LIMIT = 512


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word shingles, similarity 0.9 or more."""
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"), 3, 90, 100).select(
        "doc_id", "n_shingles", "component_id")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, bytes_into="n_bytes").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > OVER_LIMIT).alias("over_limit"))


def _is_kind(kind: str):
    return lambda span: span["kind"] == kind


def op3_pii_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pii(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("spans")
    number = [F.size(F.filter(spans, _is_kind(k))).cast("bigint").alias(f"n_{k}") for k in pii.BASE]
    return found.select(
        "doc_id", *number, F.sha2(pii.digest(spans, pii.BASE), 256).alias("base_sha256"), pii.digest(spans).alias("spans"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    delete_at_end(spark, folder)
    manifest = token_file.write_tokens(_table(spark, sf_dir, "documents"), folder)
    return token_file.read_tokens(spark, manifest, with_ids=False)


def op5_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from the documents whose id's crc32 modulo 3 isn't 1."""
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_part(F.col("doc_id"), 3) == 1, F.lit(False))
    model = language_mixture.train(docs.where(~held_out))
    return language_mixture.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"),
        "language.shares")


def op6_piece_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segmentation with merge-dropout, decoded again and compared."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = piece_dropout.encode(docs)
    return coded.select(
        "doc_id", F.col("encoded.n_pieces").alias("n_pieces"), F.crc32(F.col("encoded.ids")).alias("ids_crc32"), "encoded.lossless",
        F.col("encoded.ids").alias("ids"))


def op7_quality_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_forest.assess(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id", "rules.n_words", "rules.word_chars", "rules.n_symbols", "rules.n_dup_lines", "rules.n_repeat_words",
        "base_failed", "kept", "anomaly")


def op8_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return line_spread.drop_spread_lines(docs, counts=("n_lines", "n_removed")).select("doc_id", "n_lines", "n_removed", "text")


def op9_suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_decontam.matches(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))
    hits = F.col("matches")
    return found.select(
        "doc_id", hits["n_words"].alias("n_words"), hits["n_hit"].alias("n_hit"), F.size(hits["items"]).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(hits["items"], ","), 256).alias("items_sha256"), suffix_decontam.contaminated(hits).alias("contaminated"))


def op10_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_splitters.shard(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = lambda c: F.when(c == "", c).otherwise(F.sha2(c, 256))
    found = token_alignment.alignment(_table(spark, sf_dir, "documents"), groups=digest)
    return found.withColumnRenamed("groups", "groups_sha256")


def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.85 or more."""
    return minhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"), 5, 85, 100)


def repaired_conversations(turns: DataFrame) -> DataFrame:
    """The report of every conversation of `turns` after damage and repair; one without rows left has zeros."""
    found = conversation_repair.summaries(conversation_repair.repair(conversation_repair.damaged(turns), "conv")).alias("r")
    ids = turns.select("conv_id").distinct()
    measures = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return ids.join(found, F.col("conv_id").eqNullSafe(F.col("r.conv")), "left").select(
        "conv_id", *(F.coalesce(F.col(m), F.lit(0)).cast("bigint").alias(m) for m in measures),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired_conversations(_table(spark, sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join, op2_token_counts, op3_pii_anchors, op4_token_files, op5_language_mixture, op6_piece_dropout,
        op7_quality_forest, op8_line_spread, op9_suffix_decontamination, op10_sampled_splitters,
        op11_token_alignment, op12_minhash_dedup, op13_conversation_repair)
}

_ASCII_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = {
    "op1_ngram_jaccard_join": rf"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all({_ASCII_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (
            SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END)) AS sh FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
        common AS (
            SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        links AS (
            SELECT u, v FROM common JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 90 * (x.n + y.n - c)),
        reach AS (SELECT doc_id AS u, doc_id AS v FROM documents UNION SELECT r.u, l.v FROM reach r JOIN links l ON l.u = r.v)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.c AS component_id
        FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT u, min(v) AS c FROM reach GROUP BY 1) m ON m.u = d.doc_id""",
    "op8_line_spread": f"""
        WITH cut AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
        l AS (SELECT doc_id, coalesce(source, '') AS site, unnest(lines) AS line, unnest(range(0, len(lines))) AS pos FROM cut),
        boiler AS (
            SELECT line, min({{'d': doc_id, 'p': pos}}) AS first FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
            GROUP BY line HAVING count(DISTINCT site) >= {line_spread.MIN_SITES}),
        marked AS (
            SELECT l.doc_id, pos, l.line, first IS NOT NULL AND first <> {{'d': l.doc_id, 'p': pos}} AS gone
            FROM l LEFT JOIN boiler USING (line)),
        kept AS (
            SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
                coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text FROM marked GROUP BY 1)
        SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, kept.text
        FROM documents LEFT JOIN kept USING (doc_id)""",
    "op9_suffix_decontamination": rf"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all({_ASCII_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (
            SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id,
                regexp_extract_all({_ASCII_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        win AS (
            SELECT DISTINCT item_id, least(13, len(w)) AS k, unnest(list_transform(
                range(1, len(w) - least(13, len(w)) + 2), lambda i: array_to_string(w[i : i + least(13, len(w)) - 1], ' '))) AS g
            FROM b WHERE len(w) > 0),
        sizes AS (SELECT DISTINCT k FROM win),
        place AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k),
        hits AS (
            SELECT doc_id, i, win.k, item_id FROM place JOIN win ON win.k = place.k AND array_to_string(w[i : i + place.k - 1], ' ') = g),
        covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY 1),
        items AS (
            SELECT doc_id, count(*) AS n, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS h
            FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY 1)
        SELECT d.doc_id, coalesce(len(w), 0) AS n_words, coalesce(covered.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
            coalesce(h, sha256('')) AS items_sha256, coalesce(covered.n > 0 AND 20 * covered.n >= len(w), false) AS contaminated
        FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op12_minhash_dedup": rf"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all({_ASCII_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (
            SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END)) AS sh FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
        common AS (
            SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        links AS (
            SELECT u, v FROM common JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 85 * (x.n + y.n - c)),
        reach AS (SELECT doc_id AS u, doc_id AS v FROM documents UNION SELECT r.u, l.v FROM reach r JOIN links l ON l.u = r.v),
        m AS (SELECT u, min(v) AS c FROM reach GROUP BY 1)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
        FROM documents d LEFT JOIN n USING (doc_id) JOIN m ON m.u = d.doc_id""",
    "op13_conversation_repair": r"""
        WITH RECURSIVE k AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                xor(list_reduce(
                    list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ord(c)::BIGINT),
                    lambda crc, b: list_reduce(range(8), lambda x, bit: xor(x >> 1, 3988292384 * (x & 1)), xor(crc, b)),
                    4294967295::BIGINT), 4294967295) % 20 AS draw FROM conversations),
        d AS (
            SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
                CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                unnest(CASE WHEN draw = 3 THEN [1, 2] ELSE [1] END) AS copy FROM k WHERE draw <> 0),
        o AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
                row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen FROM d),
        f AS (
            SELECT conv_id, turn, i, role, text, left(role, 1) AS letter, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
                CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
                    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault FROM o),
        inserted(st, via, extra, lines) AS (VALUES
            ('0', '0', '', []), ('0', 'u', 'I', ['user:']), ('0', 'a', 'II', ['user:', 'assistant:']),
            ('s', 's', '', []), ('s', 'u', 'I', ['user:']), ('s', 'a', 'II', ['user:', 'assistant:']),
            ('u', 'u', '', []), ('u', 'a', 'I', ['assistant:']), ('a', 'a', '', []), ('a', 'u', 'I', ['user:'])),
        arc(via, letter, nxt) AS (VALUES ('0', 's', 's'), ('0', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')),
        moves AS (
            SELECT st, nxt, arc.letter, kind, 5 * len(extra) + (kind = 'R')::INT AS cost, extra || kind AS audit, lines
            FROM inserted JOIN arc USING (via), (VALUES ('K'), ('R')) kinds(kind) WHERE kind = 'K' OR arc.letter <> 's'
            UNION ALL SELECT st, st, '', 'D', 2, 'D', [] FROM (VALUES ('0'), ('s'), ('u'), ('a')) states(st)),
        r(conv_id, i, st, w) AS (
            SELECT DISTINCT conv_id, 0::BIGINT, '0', {'c': 0::BIGINT, 'a': '', 't': []::VARCHAR[]} FROM f
            UNION ALL
            SELECT r.conv_id, f.i, m.nxt, min({'c': w.c + m.cost + CASE WHEN fault = 'truncated' AND kind <> 'D' THEN 5 ELSE 0 END, 'a': w.a || m.audit,
                't': w.t || m.lines || CASE kind WHEN 'D' THEN []
                    WHEN 'K' THEN [role || ':' || text] ELSE [CASE m.letter WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text] END})
            FROM r JOIN f ON f.conv_id IS NOT DISTINCT FROM r.conv_id AND f.i = r.i + 1 JOIN moves m ON m.st = r.st
            WHERE kind = 'D' OR (fault IN ('', 'truncated') AND (kind = 'R' OR m.letter = f.letter))
            GROUP BY r.conv_id, f.i, m.nxt),
        n AS (
            SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                count(*) FILTER (fault = 'truncated') AS truncated,
                count(*) FILTER (before IS NOT NULL AND before || letter NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY 1),
        best AS (
            SELECT r.conv_id, min({'c': w.c + 5 * len(extra), 'a': w.a || extra, 't': w.t || lines}) AS w
            FROM r JOIN n ON n.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = n.n JOIN inserted USING (st) WHERE via IN ('0', 'a') GROUP BY 1)
        SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
            coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(w.c, 0) AS cost, coalesce(w.a, '') AS audit,
            sha256(coalesce(array_to_string(w.t, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
        LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM c.conv_id""",
}
