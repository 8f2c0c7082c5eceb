"""One query per operator, over its whole table with production parameters, and SQL for them."""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.durable import scratch_path
from . import (
    bpe,
    chat,
    decontamination,
    divergence,
    html_text,
    line_dedup,
    near_dedup,
    prefix_trie,
    pseudonyms,
    toxicity,
    url_rules,
    warc,
    winnowing,
)

Query = Callable[[SparkSession, str], DataFrame]


# Rows that go to a Python worker at once. Texts are long: the default of 10,000 rows takes
# tens of megabytes several times over, on both sides.
BATCH_ROWS = "1000"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    checked = decontamination.contamination(docs, _table(spark, sf_dir, "benchmark"))
    return checked.select(
        "doc_id",
        "contamination.n_words",
        "contamination.n_hit",
        F.size("contamination.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("contamination.items", ","), 256).alias("items_sha256"),
        "contamination.contaminated",
    )


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.fingerprints(_table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_repeated_runs(docs)


def op4_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key is a setting of the session; the one given here is public, for test tables only."""
    key = spark.conf.get("spark.sievemark.pseudonym.key", "")
    if not key:
        warnings.warn("spark.sievemark.pseudonym.key is not set: anyone can reveal these pseudonyms", stacklevel=2)
        key = "public test tables"
    key = key.encode()
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymize(docs, key).withColumn("n_found", F.size("pii"))


LISTED = [
    url_rules.Listed("block", "net/"),
    url_rules.Listed("allow", "example.net/en/"),
    url_rules.Listed("block", "example.com/de/"),
    url_rules.Listed("allow", "org/fr/"),
]


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages that listed rules decide are the labels: those of the tables are of documents, not of URLs."""
    return url_rules.judge(_table(spark, sf_dir, "pages"), None, LISTED)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = toxicity.judge(docs, _table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "held_out", "score", "predicted", "threshold", "rejected")


def tokenizer_path() -> str:
    """Where the public tokenizer file lies; not part of this repository."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, tokenizer_path())
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), k=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    messages = chat.text_messages(given.unionByName(extra))
    return chat.read_back(chat.format_turns(messages))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages").select("page_id", "html"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    archives = scratch_path(spark, "archives")
    warc.write_archives(warc.decided(pages), archives)
    found = warc.captures(warc.read_records(spark, archives))
    return found.select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to")


def op12_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents").select("lang", "source", "text"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return prefix_trie.trie(prefix_trie.with_group_heads(prefix_trie.sequences(turns)))


QUERIES: dict[str, Query] = {
    "op1_decontamination": op1_decontamination,
    "op2_fingerprints": op2_fingerprints,
    "op3_line_dedup": op3_line_dedup,
    "op4_pseudonyms": op4_pseudonyms,
    "op5_url_rules": op5_url_rules,
    "op6_toxicity": op6_toxicity,
    "op7_bpe": op7_bpe,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_html_text": op10_html_text,
    "op11_warc": op11_warc,
    "op12_divergence_audit": op12_divergence_audit,
    "op13_prefix_trie": op13_prefix_trie,
}

_OP1 = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item, len(w) < 10 AS short, least(len(w), 10) AS n,
    unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + 9], ' '))) AS content
  FROM item WHERE len(w) > 0
), place AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS content
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)
), hit AS (
  SELECT doc_id, i, n, item FROM place JOIN win USING (n, content)
), word AS (
  SELECT doc_id, count(DISTINCT spot) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS spot FROM hit) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN named USING (doc_id)
"""

# Escaped characters get one more; a turn has 17 characters around its role and text.
_OP9 = r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'),
    (-7, 1, 'assistant', '\### Assistant: </turn> ok')
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(17 + length(role) + length(regexp_replace(role, '[^\\<#>\n]', '', 'g'))
    + length(text) + length(regexp_replace(text, '[^\\<#]', '', 'g'))) AS BIGINT) AS formatted_chars
FROM given GROUP BY conv_id
"""

_OP11 = """
WITH page AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages
), least AS (
  SELECT digest, min(page_id) AS first FROM page WHERE n >= 100 GROUP BY digest HAVING count(*) > 1
), judged AS (
  SELECT page.*, first IS NOT NULL AND page_id IS DISTINCT FROM first AS again, first
  FROM page LEFT JOIN least USING (digest)
)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
  CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first END AS refers_to
FROM judged
"""

_OP12 = r"""
WITH doc AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), word AS (
  SELECT id, lang, source, unnest(w) AS term FROM doc
), kept AS (
  SELECT lang, term, count(*) AS n FROM word GROUP BY lang, term HAVING count(DISTINCT id) >= 30
), langs AS (
  SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang
), mine AS (
  SELECT lang, source, term, count(*) AS n FROM word SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), groups AS (
  SELECT g.lang, g.source, coalesce(max(l.v), 0) AS v, coalesce(sum(m.n), 0) AS n
  FROM (SELECT DISTINCT lang, source FROM doc) AS g LEFT JOIN langs AS l ON g.lang = l.lang
  LEFT JOIN mine AS m ON g.lang = m.lang AND g.source = m.source GROUP BY g.lang, g.source
), cells AS (
  SELECT g.lang, g.source, k.term, coalesce(m.n, 0) AS n,
    1 + 1000000000 * (coalesce(m.n, 0) + 5)::HUGEINT // (g.n + 5 * g.v)::HUGEINT AS p,
    1 + 1000000000 * (k.n + 5)::HUGEINT // (l.n + 5 * l.v)::HUGEINT AS q
  FROM groups AS g JOIN kept AS k ON g.lang = k.lang JOIN langs AS l ON g.lang = l.lang
  LEFT JOIN mine AS m ON g.lang = m.lang AND g.source = m.source AND k.term = m.term
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
    coalesce((SELECT sum(abs(x.p - y.p)) FROM cells AS x JOIN cells AS y ON x.lang = y.lang AND x.term = y.term
      WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
  FROM groups AS a JOIN groups AS b ON a.lang = b.lang AND a.source <> b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM cells WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50
"""

# The CRC goes bit by bit; a node is named by the digests of its turns.
_OP13 = r"""
WITH given AS (
  SELECT conv_id, turn, sha256(concat(strlen(coalesce(role, '')), ':', role, text)) AS id,
    strlen(coalesce(text, '')) AS size
  FROM conversations WHERE conv_id IS NOT NULL
), conv AS (
  SELECT conv_id, list({'id': id, 'size': size} ORDER BY turn NULLS FIRST, id) AS turns FROM given GROUP BY conv_id
), headed AS (
  SELECT c.conv_id, c.turns, f.turns AS head,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(c.conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 9 AS h
  FROM conv AS c LEFT JOIN conv AS f ON f.conv_id = c.conv_id - c.conv_id % 5
), rebuilt AS (
  SELECT conv_id, list_concat(CASE WHEN head IS NULL THEN [] ELSE head[1:h] END, turns[h + 1:]) AS turns FROM headed
), step AS (
  SELECT conv_id, len(turns) AS length, depth, coalesce(turns[depth].size, 0) AS size,
    sha256(array_to_string(list_transform(turns[1:depth], lambda t: t.id), '')) AS node,
    CASE WHEN depth > 0 THEN sha256(array_to_string(list_transform(turns[1:depth - 1], lambda t: t.id), '')) END AS parent
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt)
), node AS (
  SELECT node, depth, any_value(parent) AS parent, any_value(size) AS size, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (length = depth), '')) AS ends_sha256
  FROM step GROUP BY node, depth
), children AS (
  SELECT parent AS node, count(*) AS n FROM node WHERE depth > 0 GROUP BY parent
), below AS (
  SELECT DISTINCT a.node AS top, u.node FROM step AS a JOIN step AS u USING (conv_id) WHERE a.depth <= u.depth
), sums AS (
  SELECT top, count(*) FILTER (c.n IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.size) AS saved_tokens
  FROM below AS b JOIN node AS n USING (node) LEFT JOIN children AS c USING (node) GROUP BY top
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, s.n_leaves,
  CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM node AS n JOIN sums AS s ON s.top = n.node LEFT JOIN node AS p ON p.node = n.parent
LEFT JOIN children AS c ON c.node = n.node
"""

ORACLES: dict[str, str] = {
    "op9_chat_formatting": _OP9,
    "op1_decontamination": _OP1,
    "op11_warc": _OP11,
    "op12_divergence_audit": _OP12,
    "op13_prefix_trie": _OP13,
}
