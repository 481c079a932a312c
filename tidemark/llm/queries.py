"""The registered queries of the training-data operators, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, conversation_repair, decontamination, exact_dedup, language_id, language_model, periodic_runs
from tidemark.llm import pii, quality, simhash, top_k, toxicity, warc

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "documents")


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(_documents(spark, folder), _table(spark, folder, "labels"))


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.archived(_table(spark, folder, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(_documents(spark, folder))


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_documents(spark, folder), digest_all=True)


def op5_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.score_documents(_documents(spark, folder))


#: Words of a shingle, and bits in which linked fingerprints may differ.
SIMHASH = {"shingle": 3, "distance": 2}


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.digests(simhash.near_duplicates(_documents(spark, folder), **SIMHASH))


def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digests(pii.personal_data(_documents(spark, folder)))


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(_documents(spark, folder), public_tokenizers.path("piece_bpe_32k.model"))


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    items = _table(spark, folder, "benchmark")
    return decontamination.digests(decontamination.contamination(_documents(spark, folder), items))


def op10_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(bpe.encode_documents(_documents(spark, folder), path, public_tokenizers.PATTERN))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    texts = periodic_runs.repeated_tails(_documents(spark, folder))
    return periodic_runs.digests(periodic_runs.periodic_runs(texts))


#: What components are multiplied by, the divisor of the ids that are queries, and the length of their lists.
TOP_K = {"by": 256, "every": 50, "k": 5}


def op12_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings").select(
        "vec_id", top_k.scaled(F.col("embedding"), TOP_K["by"]).alias("weights")
    )
    return top_k.top_k(vectors, F.col("vec_id") % TOP_K["every"] == 0, TOP_K["k"])


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = conversation_repair.damaged(_table(spark, folder, "conversations"))
    repaired = conversation_repair.repair(rows, absent=F.col("absent"), texts=False)
    return repaired.withColumnRenamed("repaired", "repaired_sha256")


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_warc": op2_warc,
    "op3_quality": op3_quality,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_language_model": op5_language_model,
    "op6_simhash": op6_simhash,
    "op7_pii": op7_pii,
    "op8_language_id": op8_language_id,
    "op9_decontamination": op9_decontamination,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_top_k": op12_top_k,
    "op13_conversation_repair": op13_conversation_repair,
}

OP4_SQL = r"""WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS folded FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(folded) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY folded)"""

OP9_SQL = r"""WITH word_lists AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
item_lists AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, words[start : start + 9] AS wanted
  FROM (SELECT *, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS start FROM item_lists WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT len(wanted) AS size FROM windows),
runs AS (
  SELECT doc_id, start, words[start : start + size - 1] AS wanted, size
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS start FROM word_lists, sizes)),
found AS (SELECT doc_id, start, size, item_id FROM runs JOIN windows USING (wanted)),
hits AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(start, start + size)) AS place FROM found) GROUP BY doc_id),
owners AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
  FROM found GROUP BY doc_id),
tokens AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS place FROM word_lists),
spelled AS (SELECT wanted, unnest(wanted) AS word, unnest(range(len(wanted))) AS nth FROM (SELECT DISTINCT wanted FROM windows)),
postings AS (SELECT word, count(*) AS postings FROM tokens GROUP BY word),
rarest AS (SELECT wanted, word, nth FROM spelled JOIN postings USING (word)
  QUALIFY row_number() OVER (PARTITION BY wanted ORDER BY postings, nth) = 1),
begun AS (SELECT wanted, doc_id, place - nth AS start FROM rarest JOIN tokens USING (word)),
near AS (
  SELECT b.wanted, b.doc_id, b.start FROM begun b JOIN spelled s USING (wanted)
  JOIN tokens t ON t.doc_id = b.doc_id AND t.word = s.word AND abs(t.place - b.start - s.nth) <= 4
  GROUP BY b.wanted, b.doc_id, b.start HAVING count(DISTINCT s.nth) = len(b.wanted)),
neighbours AS (SELECT doc_id, count(DISTINCT item_id) AS n_near_items FROM near JOIN windows USING (wanted) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
       coalesce(n_near_items, 0) AS n_near_items
FROM word_lists LEFT JOIN hits USING (doc_id) LEFT JOIN owners USING (doc_id) LEFT JOIN neighbours USING (doc_id)"""

OP2_SQL = """WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
hashed AS (SELECT *, sha1(payload) AS hex, min(page_id) OVER (PARTITION BY payload) AS first FROM payloads)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 +
         ((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31) AS BIGINT), 1)), '')
         AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM hashed"""

#: The table of CRC-32, for SQL that has no such function.
CRC_SQL = """crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
  lambda c, step: xor(c >> 1, (c & 1) * 3988292384))) AS crcs)"""


def crc_sql(text: str) -> str:
    """CRC-32 of an ASCII text, beside `crc_table`."""
    return f"""xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({text}) + 1),
    lambda k: ascii({text}[k])::BIGINT)), lambda c, byte: xor(c >> 8, crcs[CAST((xor(c, byte) & 255) + 1 AS BIGINT)])))"""


OP11_SQL = rf"""WITH {CRC_SQL},
read AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws, {crc_sql("CAST(doc_id AS VARCHAR)")} AS h
  FROM documents, crc_table),
sized AS (SELECT doc_id, ws, len(ws) AS n, h, h // 10 AS g FROM read),
placed AS (SELECT *, g % nullif(n, 0) AS a FROM sized),
timed AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM placed),
changed AS (SELECT doc_id, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(0, n), lambda i: ws[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) ELSE ws END AS ws FROM timed),
tokens AS (SELECT doc_id, len(ws) AS n, unnest(ws) AS word, unnest(range(0, len(ws))) AS i FROM changed),
pairs AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM tokens x JOIN tokens y
  ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 2 * (y.i - x.i) <= x.n),
stretches AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS stretch FROM pairs),
found AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM stretches GROUP BY doc_id, q, stretch
  HAVING count(*) + q >= greatest(12, 2 * q)),
runs AS (SELECT doc_id, start, length, min(q) AS period FROM found GROUP BY doc_id, start, length),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
listed AS (SELECT doc_id, count(*) AS n_runs, first(struct_pack(start := start, length := length, period := period)
    ORDER BY length DESC, start, period) AS best,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS written FROM runs GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed
  FROM tokens ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length, best.period AS period,
       1000 * best.length // best.period AS exponent_milli, sha256(coalesce(written, '')) AS runs_sha256,
       sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM changed LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)"""

OP12_SQL = """WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS weights FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_sum(list_transform(list_zip(q.weights, v.weights),
         lambda pair: coalesce(pair[1] * pair[2], 0))) AS BIGINT) AS score
  FROM vectors q JOIN vectors v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id)
SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score FROM scores
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY rank <= 5"""

OP13_SQL = rf"""WITH RECURSIVE {CRC_SQL},
given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
drawn AS (SELECT *, {crc_sql("name")} % 20 AS lot FROM given, crc_table),
damaged AS (SELECT conv_id, turn, CASE WHEN lot = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN lot = 1 THEN '' WHEN lot = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN lot = 3 THEN 2 ELSE 1 END)) AS copy FROM drawn WHERE lot <> 0),
ordered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS place,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last FROM damaged),
marked AS (SELECT *, substr(role, 1, 1) AS initial, last = '' AS blank, last <> '' AND again AS duplicate,
    last <> '' AND NOT again AND last NOT IN ('.', '!', '?') AS truncated,
    lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY place) AS before FROM ordered),
counted AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(place) AS places
    FROM marked GROUP BY conv_id),
walk AS (
  SELECT conv_id, 0::BIGINT AS place, '' AS state, 0::BIGINT AS cost, '' AS audit, '' AS written FROM counted
  UNION ALL
  SELECT conv_id, place, state, cost, audit, written FROM (
    SELECT m.conv_id, m.place, CASE WHEN edit = 'D' THEN w.state ELSE into_state END AS state, w.cost + price AS cost,
      w.audit || edit AS audit, CASE WHEN edit = 'D' THEN w.written ELSE w.written || CASE WHEN w.written = '' THEN '' ELSE chr(10) END
        || CASE WHEN edit = 'K' THEN m.role WHEN into_state = 'u' THEN 'user' ELSE 'assistant' END || ':' || m.text END AS written,
      row_number() OVER (PARTITION BY m.conv_id, CASE WHEN edit = 'D' THEN w.state ELSE into_state END
        ORDER BY w.cost + price, w.audit || edit) AS choice
    FROM (SELECT * FROM walk UNION ALL
          SELECT conv_id, place, CASE WHEN state = 'u' THEN 'a' ELSE 'u' END, cost + 2, audit || 'I',
            written || CASE WHEN written = '' THEN '' ELSE chr(10) END || CASE WHEN state = 'u' THEN 'assistant:' ELSE 'user:' END
          FROM walk) w
    JOIN marked m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.place = w.place + 1
    JOIN (VALUES ('D', ''), ('K', 's'), ('K', 'u'), ('K', 'a'), ('R', 'u'), ('R', 'a')) edits(edit, into_state) ON
      edit = 'D' OR (NOT m.blank AND NOT m.duplicate AND (edit = 'R' OR m.initial = into_state)
        AND (w.state, into_state) IN (('', 's'), ('', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')))
    JOIN (VALUES ('D', 3), ('K', 0), ('R', 2)) prices(priced, base) ON priced = edit
    JOIN (VALUES (true), (false)) broken(off) ON off = (m.truncated AND edit <> 'D'),
    LATERAL (SELECT base + CASE WHEN off THEN 1 ELSE 0 END AS price)) WHERE choice = 1),
ends AS (SELECT conv_id, cost, audit, written FROM walk JOIN counted USING (conv_id) WHERE place = places AND state IN ('', 'a')
  UNION ALL SELECT conv_id, cost + 2, audit || 'I', written || chr(10) || 'assistant:' FROM walk JOIN counted USING (conv_id)
    WHERE place = places AND state = 'u'
  UNION ALL SELECT conv_id, cost + 4, audit || 'II', written || chr(10) || 'user:' || chr(10) || 'assistant:'
    FROM walk JOIN counted USING (conv_id) WHERE place = places AND state = 's'),
cheapest AS (SELECT * FROM ends QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) = 1)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(written, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN counted USING (conv_id) LEFT JOIN cheapest USING (conv_id)"""

ORACLE_SQL: dict[str, str] = {
    "op2_warc": OP2_SQL,
    "op9_decontamination": OP9_SQL,
    "op4_exact_dedup": OP4_SQL,
    "op11_periodic_runs": OP11_SQL,
    "op12_top_k": OP12_SQL,
    "op13_conversation_repair": OP13_SQL,
}
