"""The registered queries of the operators, and SQL where it can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableloom.llm import (
    byte_bpe, decontaminate, language_id, lexical_search, line_dedup, prefix_trie, quality_classifier, quality_rules, sharding,
    simhash, token_files, url_filter, warc,
)

BYTE_RANKS = "byte_bpe_50k.tiktoken"
WORD_TOKENIZER = "word_bpe_49k.json"
RULES = [
    url_filter.Rule("allow", "com", "/"),
    url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(folds: int):
    return F.crc32(F.col("doc_id").cast("string")) % folds


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "host_failed",
    )


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))


def bpe_digests(docs: DataFrame) -> DataFrame:
    decoded = byte_bpe.round_trip(docs, public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = language_id.fit(docs, where=fold(4) != 2)
    held = docs.select(F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"), F.struct("doc_id").alias("row"), "text")
    predicted = language_id.predict(held.select(F.struct("row", "held_out").alias("key"), "text"), profiles, "key")
    return predicted.select(
        F.col("key.row.doc_id").alias("doc_id"), F.col("key.held_out").alias("held_out"), "lang_pred", "score", "rejected"
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), RULES)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_classifier.fit(docs, labels, "quality", fold(5) != 0)
    scored = quality_classifier.predict(docs, model)
    return scored.select(
        "doc_id", F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(WORD_TOKENIZER)
    read = token_files.stored_documents(table(spark, sf_dir, "documents"), path)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = prefix_trie.placed_turns(table(spark, sf_dir, "conversations"))
    nodes = prefix_trie.trie(*prefix_trie.share_heads(placed))
    return nodes.withColumnRenamed("saved", "saved_tokens")


OP1_SQL = r"""
WITH texts AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT doc_id, source, text, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM texts),
grams AS (
  SELECT doc_id, i, list_aggregate(words[i:i + 2], 'string_agg', ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM split)),
found AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM grams),
repeated AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM found, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY 1),
measured AS (
  SELECT s.doc_id, source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM split s LEFT JOIN repeated r ON r.doc_id = s.doc_id),
ruled AS (
  SELECT *, n_words < 50 AS r1, 100 * n_repeat_words > 50 * n_words AS r2, 100 * n_symbols > 20 * n_words AS r3,
    100 * n_dup_lines > 50 * n_lines AS r4, word_chars < 2 * n_words OR word_chars > 20 * n_words AS r5
  FROM measured),
rules AS (
  SELECT source, rule, count(*) AS n, sum(failed::INT) AS f
  FROM (SELECT source, unnest([1, 2, 3, 4, 5]) AS rule, unnest([r1, r2, r3, r4, r5]) AS failed FROM ruled WHERE source IS NOT NULL)
  GROUP BY 1, 2),
totals AS (
  SELECT rule, sum(n) AS n, count(*) AS hosts, sum(n * n) AS nn, sum(f) / sum(n) AS mean, sum(f * f / n) AS q FROM rules GROUP BY 1),
spreads AS (
  SELECT rule, mean, CASE WHEN n - nn / n > 0
    THEN greatest(0, (q - n * mean * mean - (hosts - 1) * mean * (1 - mean)) / (n - nn / n)) ELSE 0 END AS between_hosts
  FROM totals),
priors AS (
  SELECT rule, mean, CASE WHEN between_hosts <= 0 THEN 1e9
    ELSE least(1e9, greatest(0, mean * (1 - mean) / between_hosts - 1)) END AS weight
  FROM spreads),
bad AS (
  SELECT DISTINCT source FROM rules JOIN priors USING (rule) WHERE (f + mean * weight) / (n + weight) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, r1 OR r2 AS base_failed,
  NOT (r1 OR r2) AND b.source IS NULL AS kept, b.source IS NOT NULL AS host_failed
FROM ruled LEFT JOIN bad b ON b.source = ruled.source
"""

OP3_SQL = """
WITH hashed AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
largest AS (SELECT body, max(page_id) AS first FROM hashed GROUP BY 1)
SELECT page_id, strlen(h.body)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::INT) >> (15 - 5 * (i % 4))::INT) & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM hashed h JOIN largest l ON l.body = h.body
"""

OP9_SQL = r"""
WITH norm_docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
norm_items AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(13, len(words)) AS size,
    array_to_string(words[i:i + least(13, len(words)) - 1], ' ') AS win
  FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 13, 0) + 2)) AS i FROM norm_items WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT doc_id, size, i, array_to_string(words[i:i + size - 1], ' ') AS win
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM norm_docs, sizes)),
hits AS (SELECT doc_id, p.size, i, item FROM places p JOIN windows w ON w.win = p.win AND w.size = p.size),
hit_words AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS j FROM hits) GROUP BY 1),
hit_items AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM hits GROUP BY 1)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM norm_docs d LEFT JOIN hit_words w ON w.doc_id = d.doc_id LEFT JOIN hit_items i ON i.doc_id = d.doc_id
"""

OP11_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
counts AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY 1, 2),
sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM counts GROUP BY 1),
totals AS (SELECT count(*) AS all_docs, sum(n)::BIGINT AS all_terms FROM sizes),
items AS (
  SELECT DISTINCT item_id, term FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(all_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM counts, totals WHERE term IN (SELECT term FROM items) GROUP BY 1),
scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * all_docs) // all_terms))))::BIGINT AS score
  FROM items JOIN weights USING (term) JOIN counts USING (term) JOIN sizes USING (doc_id), totals GROUP BY 1, 2),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

OP12_SQL = r"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
placed AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM split),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM placed),
repeated AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20 GROUP BY 1 HAVING count(DISTINCT doc_id) >= 3)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (doc_id <> last) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (last IS NULL OR doc_id = last), '')) AS kept_sha256
FROM keyed LEFT JOIN repeated USING (key)
GROUP BY 1
"""

OP13_SQL = r"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS i,
    coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY i) AS turns FROM turns GROUP BY 1),
hashed AS (
  SELECT conv_id, turns, conv_id - conv_id % 100 AS base,
    xor(list_reduce(list_concat([4294967295::BIGINT], range(8 * length(conv_id::VARCHAR))), lambda x, k:
      CASE WHEN xor(x, CASE WHEN k % 8 = 0 THEN ascii(substr(conv_id::VARCHAR, (1 + k // 8)::INT, 1)) ELSE 0 END) & 1 = 1
        THEN xor(xor(x, CASE WHEN k % 8 = 0 THEN ascii(substr(conv_id::VARCHAR, (1 + k // 8)::INT, 1)) ELSE 0 END) >> 1, 3988292384)
        ELSE xor(x, CASE WHEN k % 8 = 0 THEN ascii(substr(conv_id::VARCHAR, (1 + k // 8)::INT, 1)) ELSE 0 END) >> 1 END), 4294967295) % 6 AS h
  FROM own),
rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.turns[1:a.h], []), a.turns[a.h + 1:]) AS turns
  FROM hashed a LEFT JOIN own b ON b.conv_id = a.base),
prefixes AS (SELECT conv_id, len(turns) AS length, unnest(range(len(turns) + 1)) AS depth, turns FROM rebuilt),
keyed AS (SELECT conv_id, length, depth, turns[1:depth] AS path FROM prefixes),
nodes AS (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (length = depth), '')) AS ends_sha256,
    (count(*) - 1) * CASE WHEN depth > 0 THEN length(any_value(path[depth]).text) ELSE 0 END AS saved
  FROM keyed GROUP BY depth, path),
children AS (SELECT path[1:depth - 1] AS above, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
counted AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.above = n.path),
spread AS (SELECT path[1:k] AS path, n_children, saved FROM (SELECT path, n_children, saved, unnest(range(depth + 1)) AS k FROM counted)),
sums AS (SELECT path, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM spread GROUP BY 1)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM counted n JOIN sums s ON s.path = n.path LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[1:n.depth - 1]
"""

QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_warc": op3_warc,
    "op4_language_id": op4_language_id,
    "op5_simhash": op5_simhash,
    "op6_url_filter": op6_url_filter,
    "op7_sharding": op7_sharding,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_decontamination": op9_decontamination,
    "op10_token_files": op10_token_files,
    "op11_lexical_search": op11_lexical_search,
    "op12_line_dedup": op12_line_dedup,
    "op13_conversation_trie": op13_conversation_trie,
}
ORACLES = {
    "op1_quality_rules": OP1_SQL, "op3_warc": OP3_SQL, "op9_decontamination": OP9_SQL,
    "op11_lexical_search": OP11_SQL, "op12_line_dedup": OP12_SQL,
    "op13_conversation_trie": OP13_SQL,
}
