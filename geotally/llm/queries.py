"""The queries of this subpackage by name, and their SQL where SQL can express them over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geotally.llm import (
    chat,
    collocations,
    conversation_repair,
    decontamination,
    exact_dedup,
    language_id,
    line_dedup,
    packing,
    pii,
    quality_crf,
    simhash,
    suffix_dedup,
    toxicity,
)
from geotally.llm.common import table


#: File of the tokenizer that packing counts in.
TOKENIZER = "byte_bpe_50k.json"


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, radius=3)


def op3_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_crf.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents")).drop("terms")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.repeated_units(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]")
    hard = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text")
    )
    read = chat.read_back(chat.chats_from_events(chat.events_of_rows(rows.unionByName(hard))))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("spans", "items")


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest_of_kept(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversation_repair.repair_report(conversation_repair.damaged(rows), rows)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_simhash": op2_simhash,
    "op3_quality_crf": op3_quality_crf,
    "op4_pii": op4_pii,
    "op5_toxicity": op5_toxicity,
    "op6_line_dedup": op6_line_dedup,
    "op7_packing": op7_packing,
    "op8_chat": op8_chat,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_decontamination": op10_decontamination,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_collocations": op12_collocations,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLES: dict[str, str] = {
    "op6_line_dedup": r"""
WITH l AS (
  SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '([.!?]) ', '\1' || chr(10), 'g'), chr(10)) AS units FROM documents
), u AS (
  SELECT doc_id, unnest(units) AS unit, generate_subscripts(units, 1) AS k FROM l
), p AS (
  SELECT *, coalesce(sum(length(unit) + 1) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
    regexp_extract_all(translate(unit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM u
), f AS (
  SELECT *, array_to_string(w, ' ') AS norm FROM p WHERE len(w) >= 8
), r AS (
  SELECT *, row_number() OVER g AS n, first_value(doc_id) OVER g AS keep_doc_id, first_value(start) OVER g AS keep_start
  FROM f WINDOW g AS (PARTITION BY norm ORDER BY doc_id, start)
)
SELECT doc_id, start, start + length(unit) AS "end", len(w) AS n_words, keep_doc_id, keep_start FROM r WHERE n > 1
""",
    "op8_chat": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, length(regexp_replace(role, '([<\[])(\**/?(s>|INST\]))', '\1*\2', 'g'))
    + length(regexp_replace(text, '([<\[])(\**/?(s>|INST\]))', '\1*\2', 'g')) + 20 AS chars
  FROM c
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
""",
    "op9_exact_dedup": r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), k AS (
  SELECT doc_id, norm,
    first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS keep_id,
    count(*) OVER (PARTITION BY norm) AS group_size
  FROM t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM k
""",
    "op10_decontamination": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), p AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[k : k + least(10, len(w)) - 1], ' ') AS win
  FROM i, LATERAL (SELECT unnest(range(1, len(w) - least(10, len(w)) + 2)) AS k) WHERE len(w) > 0
), s AS (SELECT DISTINCT size FROM p), x AS (
  SELECT doc_id, k, size, array_to_string(w[k : k + size - 1], ' ') AS win
  FROM d, s, LATERAL (SELECT unnest(range(1, len(w) - size + 2)) AS k) WHERE len(w) >= size
), h AS (SELECT DISTINCT doc_id, item_id, k, size FROM x JOIN p USING (size, win)), c AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + size)) AS word FROM h) GROUP BY doc_id
), m AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN m USING (doc_id)
""",
    "op11_suffix_dedup": r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), s AS (
  SELECT doc_id, unnest(range(0, len(h) // 2 - 199)) AS pos, h FROM d WHERE len(h) >= 400
), w AS (
  SELECT doc_id, pos, md5(substr(h, 2 * pos + 1, 400)) AS m FROM s
), r AS (
  SELECT doc_id, pos FROM w QUALIFY count(*) OVER (PARTITION BY m) > 1
), e AS (
  SELECT doc_id, pos, pos - lag(pos, 1, -1000) OVER (PARTITION BY doc_id ORDER BY pos) > 200 AS fresh FROM r
), g AS (
  SELECT doc_id, pos, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM e
), x AS (
  SELECT doc_id, run, min(pos) AS a, max(pos) + 200 AS z FROM g GROUP BY doc_id, run
), k AS (
  SELECT d.doc_id, d.h, coalesce(a, 0) AS a, coalesce(z, 0) AS z, x.run, lag(z, 1, 0) OVER (PARTITION BY d.doc_id ORDER BY a) AS before
  FROM d LEFT JOIN x USING (doc_id)
), t AS (
  SELECT doc_id, any_value(h) AS h, count(run) AS n_spans, sum(z - a)::BIGINT AS n_removed, max(z) AS last,
    string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head
  FROM k GROUP BY doc_id
)
SELECT doc_id, len(h) // 2 AS n_bytes, n_removed, n_spans, sha256(unhex(coalesce(head, '') || substr(h, 2 * last + 1))) AS kept_sha256 FROM t
""",
    "op12_collocations": r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p
), n AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang
), g AS (
  SELECT lang, k, unnest([array_to_string(w[i : i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
  FROM w, range(1, 6) AS sizes(k) WHERE len(w) >= k
), f AS (
  SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100
), c AS (
  SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1
), s AS (
  SELECT lang, k, phrase, a, j, array_to_string(w[1 : j], ' ') AS head, array_to_string(w[j + 1 : k], ' ') AS tail
  FROM c, range(1, 5) AS cuts(j) WHERE j < k
), x AS (
  SELECT s.lang, s.k, s.phrase, s.a, s.j, h.a AS l, t.a AS r, n.n,
    (1000::HUGEINT * s.a * n.n // (h.a::HUGEINT * t.a))::BIGINT AS score
  FROM s JOIN f h ON h.lang = s.lang AND h.phrase = s.head AND h.k = s.j
  JOIN f t ON t.lang = s.lang AND t.phrase = s.tail AND t.k = s.k - s.j JOIN n ON n.lang = s.lang
), b AS (
  SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), inside AS (
  SELECT c.lang, array_to_string(c.w[i : i + m - 1], ' ') AS phrase, max(c.a) AS longer
  FROM c, range(2, 5) AS sizes(m), range(1, 5) AS places(i) WHERE m < c.k AND i + m - 1 <= c.k GROUP BY 1, 2
), kept AS (
  SELECT b.* FROM b LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * b.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000
""",
}
