"""One query per operator over its whole table, with production parameters, and SQL where SQL can say it."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalyard.llm import (
    conversation_repair, decontaminate, lexical_search, line_dedup, minhash, packing, quality, substring_dedup, token_counts,
    token_files, toxicity, url_filter, warc,
)
from signalyard.llm.common import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Folder of the public vocabulary files, the same on every machine.
TOKENIZERS = os.environ.get("SIGNALYARD_TOKENIZERS", "")


def vocabulary(name: str) -> str:
    if TOKENIZERS:
        return f"{TOKENIZERS}/{name}"
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def _gram_sql(n: int) -> str:
    """Words of each document, and whether a window of ``n`` words found at least twice covers them."""
    run = " || chr(32) || ".join(["w"] + [f"lead(w, {k}) OVER d" for k in range(1, n)])
    return f"""
g{n} AS (SELECT doc_id, i, {run} AS g FROM words WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
r{n} AS (SELECT doc_id, i, g IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, g) > 1 AS again FROM g{n}),
c{n} AS (SELECT doc_id, i, max(again::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS {n - 1} PRECEDING) AS inside FROM r{n})"""


_LENGTHS = [3, *quality.GRAM_LIMITS]
_QUALITY_SQL = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
listed AS (SELECT doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws FROM texts),
words AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM listed),
{",".join(_gram_sql(n) for n in _LENGTHS)},
covered AS (
  SELECT doc_id, sum(c3.inside) AS n_repeat_words,
    {", ".join(f"sum(c{n}.inside * length(w)) AS dup_chars_{n}" for n in quality.GRAM_LIMITS)}
  FROM words {" ".join(f"JOIN c{n} USING (doc_id, i)" for n in _LENGTHS)} GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts),
filled AS (SELECT doc_id, line, count(*) AS n FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY ALL),
repeats AS (
  SELECT doc_id, sum(n - 1) AS n_dup_lines,
    sum(CASE WHEN n > 1 THEN n * length(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g')) ELSE 0 END) AS dup_line_chars
  FROM filled GROUP BY doc_id),
counted AS (
  SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(dup_line_chars, 0) AS dup_line_chars,
    {", ".join(f"coalesce(dup_chars_{n}, 0) AS dup_chars_{n}" for n in quality.GRAM_LIMITS)}
  FROM texts JOIN listed USING (doc_id) LEFT JOIN repeats USING (doc_id) LEFT JOIN covered USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, dup_line_chars::BIGINT AS dup_line_chars,
  {", ".join(f"dup_chars_{n}::BIGINT AS dup_chars_{n}" for n in quality.GRAM_LIMITS)}, base_failed,
  NOT base_failed AND 100 * dup_line_chars <= {quality.LINE_LIMIT} * word_chars
    {" ".join(f"AND 100 * dup_chars_{n} <= {share} * word_chars" for n, share in quality.GRAM_LIMITS.items())} AS kept
FROM judged
"""


@_query("op1_quality_rules", _QUALITY_SQL)
def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.repetition(load(spark, folder, "documents").select("doc_id", "text")).drop("text")


@_query(
    "op2_line_dedup",
    """
WITH lines AS (
  SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
shared AS (
  SELECT k, max(doc_id) AS owner FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT keyed.*, owner IS NOT NULL AND owner <> doc_id AS gone FROM keyed LEFT JOIN shared USING (k))
SELECT doc_id, count(*)::BIGINT AS n_lines, sum(gone::INT)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
)
def line_dedup_query(spark: SparkSession, folder: str) -> DataFrame:
    done = line_dedup.dedup_lines(load(spark, folder, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@_query(
    "op3_warc",
    """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS size, sha1(coalesce(html, '')) AS digest FROM pages),
w AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS owner FROM p)
SELECT page_id, size::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN size >= 1000 AND owner <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN size >= 1000 AND owner <> page_id THEN owner END AS refers_to
FROM w
""",
)
def warc_query(spark: SparkSession, folder: str) -> DataFrame:
    manifest = warc.write_warc(load(spark, folder, "pages"), warc.archive_folder(spark))
    return warc.read_warc(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query("op4_token_counts")
def token_counts_query(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(load(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"), limit=1024)


@_query("op5_near_duplicates")
def near_duplicates_query(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(load(spark, folder, "documents")).select("doc_id", "class_id")


@_query("op6_toxicity")
def toxicity_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    return toxicity.score_toxicity(docs, toxicity.train(docs, load(spark, folder, "labels")))


@_query("op7_url_filter")
def url_filter_query(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_urls(load(spark, folder, "pages"))


@_query("op8_packing")
def packing_query(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(load(spark, folder, "documents"), vocabulary("word_bpe_49k.json"), size=2048, end_id=1)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@_query(
    "op9_decontamination",
    """
WITH folded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
asked AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
sized AS (SELECT item_id, ws, least(13, len(ws)) AS n FROM asked WHERE len(ws) > 0),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS w
  FROM (SELECT item_id, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS i FROM sized)),
lengths AS (SELECT DISTINCT n FROM windows),
found AS (
  SELECT DISTINCT d.doc_id, d.i, d.n, windows.item_id
  FROM (SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS w
    FROM (SELECT doc_id, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS i FROM folded, lengths)) d
  JOIN windows USING (n, w)),
hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM found) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM folded LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
""",
)
def decontamination_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.match_benchmark(docs, load(spark, folder, "benchmark"))
    listed = F.array_sort(F.transform("item_ids", lambda i: i.cast("string")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", listed).cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


@_query("op10_token_files")
def token_files_query(spark: SparkSession, folder: str) -> DataFrame:
    manifest = token_files.write_tokens(
        load(spark, folder, "documents"), vocabulary("word_bpe_49k.json"), token_files.token_folder(spark), end_id=2
    )
    return token_files.read_tokens(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@_query(
    "op11_substring_dedup",
    f"""
WITH listed AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(ws[i:i + {substring_dedup.LENGTH - 1}], ' ') AS w
  FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - {substring_dedup.LENGTH - 1})) AS i FROM listed)),
earliest AS (SELECT *, first_value({{'d': doc_id, 'i': i}}) OVER (PARTITION BY w ORDER BY doc_id, i) AS f FROM windows),
gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(i, i + {substring_dedup.LENGTH - 1})) AS i FROM earliest WHERE f.d <> doc_id OR f.i <> i),
words AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM listed),
kept AS (
  SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS text, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM listed LEFT JOIN kept USING (doc_id)
""",
)
def substring_dedup_query(spark: SparkSession, folder: str) -> DataFrame:
    done = substring_dedup.remove_repeats(load(spark, folder, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


_REPAIR_SQL = """
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
chances AS (
  SELECT *, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(name, ''), lambda x: ord(x)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295::BIGINT) % 20 AS c FROM named),
damaged AS (
  SELECT conv_id, turn, CASE c WHEN 4 THEN 'user' ELSE role END AS role,
    CASE c WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(generate_series(1, CASE c WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) FROM chances)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth,
    regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS filled FROM placed),
rows AS (
  SELECT conv_id, turn, i, role, text, left(role, 1) AS r, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
    CASE WHEN filled = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
      WHEN right(filled, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM numbered),
insertions(p, q, extra, more, lines) AS (
  VALUES (0, 0, 0, '', []::VARCHAR[]), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []), (0, 2, 3, 'I', ['user:']),
    (1, 2, 3, 'I', ['user:']), (3, 2, 3, 'I', ['user:']), (2, 3, 3, 'I', ['assistant:']), (0, 3, 6, 'II', ['user:', 'assistant:']),
    (1, 3, 6, 'II', ['user:', 'assistant:'])),
edges(p, r, q) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
edits AS (
  SELECT conv_id, i, p, p AS q, 4 AS extra, 'D' AS more, []::VARCHAR[] AS lines FROM rows, (SELECT unnest([0, 1, 2, 3]) AS p)
  UNION ALL
  SELECT conv_id, i, p, q, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END, 'K', [role || ':' || text]
  FROM rows JOIN edges USING (r) WHERE fault NOT IN ('blank', 'duplicate')
  UNION ALL
  SELECT conv_id, i, p, q, 3 + CASE fault WHEN 'truncated' THEN 3 ELSE 0 END, 'R',
    [CASE edges.r WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text]
  FROM rows, edges WHERE edges.r <> 's' AND fault NOT IN ('blank', 'duplicate')),
steps AS (
  SELECT conv_id, i, edits.p, insertions.q, edits.extra + insertions.extra AS extra, edits.more || insertions.more AS more,
    edits.lines || insertions.lines AS lines
  FROM edits JOIN insertions ON edits.q = insertions.p),
states(conv_id, i, q, cost, audit, lines) AS (
  SELECT c.conv_id, 0::BIGINT, q, extra, more, lines FROM (SELECT DISTINCT conv_id FROM rows) c, insertions WHERE p = 0
  UNION ALL
  SELECT conv_id, i, q, cost, audit, lines FROM (
    SELECT s.conv_id, t.i, t.q, s.cost + t.extra AS cost, s.audit || t.more AS audit, s.lines || t.lines AS lines,
      row_number() OVER (PARTITION BY s.conv_id, t.q ORDER BY s.cost + t.extra, s.audit || t.more) AS n
    FROM states s JOIN steps t ON s.conv_id IS NOT DISTINCT FROM t.conv_id AND t.i = s.i + 1 AND t.p = s.q) WHERE n = 1),
ends AS (
  SELECT conv_id, cost, audit, lines FROM (
    SELECT s.*, row_number() OVER (PARTITION BY s.conv_id ORDER BY cost, audit) AS n
    FROM states s JOIN (SELECT conv_id, max(i) AS i FROM rows GROUP BY conv_id) l
      ON s.conv_id IS NOT DISTINCT FROM l.conv_id AND s.i = l.i WHERE q IN (0, 3)) WHERE n = 1),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 'blank') AS blank,
    count_if(fault = 'duplicate') AS duplicate, count_if(fault = 'truncated') AS truncated,
    count_if(before IS NOT NULL AND before || r NOT IN ('su', 'ua', 'au')) AS illegal FROM rows GROUP BY conv_id)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN counted c ON a.conv_id IS NOT DISTINCT FROM c.conv_id
  LEFT JOIN ends e ON a.conv_id IS NOT DISTINCT FROM e.conv_id
"""


@_query("op12_conversation_repair", _REPAIR_SQL)
def conversation_repair_query(spark: SparkSession, folder: str) -> DataFrame:
    talks = load(spark, folder, "conversations")
    report, repaired = conversation_repair.repair(conversation_repair.damaged(talks))
    every, hashed = talks.select("conv_id").distinct(), conversation_repair.digests(repaired)
    longs = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    found = every.join(report, every["conv_id"].eqNullSafe(report["conv_id"]), "left").drop(report["conv_id"])
    found = found.join(hashed, found["conv_id"].eqNullSafe(hashed["conv_id"]), "left").drop(hashed["conv_id"])
    return found.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in longs], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


_TERMS_SQL = """regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"""


@_query(
    "op13_lexical_search",
    f"""
WITH listed AS (SELECT doc_id, {_TERMS_SQL} AS ts FROM documents WHERE text IS NOT NULL),
sized AS (SELECT doc_id, len(ts)::BIGINT AS n, ts FROM listed WHERE len(ts) > 0),
totals AS (SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS l FROM sized),
asked AS (
  SELECT item_id, t, count(*) AS times FROM (
    SELECT item_id, unnest({_TERMS_SQL}) AS t FROM benchmark WHERE text IS NOT NULL) GROUP BY ALL),
tfs AS (
  SELECT doc_id, n, t, count(*)::BIGINT AS tf FROM (SELECT doc_id, n, unnest(ts) AS t FROM sized)
  WHERE t IN (SELECT t FROM asked) GROUP BY ALL),
weights AS (
  SELECT t, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT t, count(*) AS df FROM tfs GROUP BY t), totals),
scored AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nd) // l))))::BIGINT AS score
  FROM tfs JOIN asked USING (t) JOIN weights USING (t), totals GROUP BY item_id, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 20
""",
)
def lexical_search_query(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.search(load(spark, folder, "documents"), load(spark, folder, "benchmark"), k=20)
