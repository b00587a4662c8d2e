"""The queries of this subpackage by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from newsprep.llm import (
    byte_shards,
    compression_bands,
    conversation_repair,
    decontamination,
    lm_scoring,
    packing,
    page_blocks,
    pii_votes,
    simhash_tiles,
    spelling_variants,
    token_counts,
    toxicity_neighbours,
    warc_members,
)
from newsprep.llm.shared import table
from newsprep.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(build: Query) -> Query:
    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(configure(spark), sf_dir)

    QUERIES[build.__name__] = run
    return run


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_binary_packing(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return packing.pack_binary(documents, tokenizer("word_bpe_49k.json"))


@query
def op2_backoff_automaton(spark, sf_dir):
    return lm_scoring.backoff_scores(table(spark, sf_dir, "documents"))


@query
def op3_fm_index(spark, sf_dir):
    documents, benchmark = (table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    found = decontamination.decontaminate(documents, benchmark, keep=["doc_id"])
    return found.drop("removal_spans")


@query
def op4_compression_bands(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return compression_bands.compression_verdicts(documents, keep=["doc_id"])


@query
def op5_simhash_tiles(spark, sf_dir):
    return simhash_tiles.simhash_components(table(spark, sf_dir, "documents"))


@query
def op6_pii_votes(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return pii_votes.find_personal_data(documents, keep=["doc_id"], with_text=False)


@query
def op7_token_counts(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return token_counts.token_counts(documents, tokenizer("byte_bpe_50k.json"))


@query
def op8_warc_members(spark, sf_dir):
    return warc_members.warc_round_trip(table(spark, sf_dir, "pages"))


@query
def op9_byte_shards(spark, sf_dir):
    return byte_shards.byte_shards(table(spark, sf_dir, "documents"))


@query
def op10_toxicity_neighbours(spark, sf_dir):
    documents, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    return toxicity_neighbours.score_toxicity(documents, labels).drop("neighbours")


@query
def op11_block_tree(spark, sf_dir):
    return page_blocks.extract_main_text(table(spark, sf_dir, "pages"))


@query
def op12_bloom_variants(spark, sf_dir):
    return spelling_variants.spelling_variants(table(spark, sf_dir, "documents"))


@query
def op13_suffix_dawg(spark, sf_dir):
    return conversation_repair.repair_conversations(table(spark, sf_dir, "conversations"))


ORACLES["op3_fm_index"] = r"""
WITH words AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
    FROM documents
), items AS (
    SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), phrases AS (
    SELECT DISTINCT item, least(13, len(w)) AS k,
        array_to_string(w[s : s + least(13, len(w)) - 1], ' ') AS phrase
    FROM items, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS t(s)
    WHERE len(w) > 0
), widths AS (
    SELECT DISTINCT k FROM phrases
), windows AS (
    SELECT r, s, k, array_to_string(w[s : s + k - 1], ' ') AS phrase
    FROM words, widths, unnest(range(1, len(w) - k + 2)) AS t(s)
), found AS (
    SELECT r, s, k, item FROM windows JOIN phrases USING (k, phrase)
), hit AS (
    SELECT r, count(DISTINCT place) AS n_hit
    FROM found, unnest(range(s, s + k)) AS t(place) GROUP BY r
), named AS (
    SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS digest
    FROM (SELECT DISTINCT r, item FROM found) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    coalesce(digest, sha256('')) AS items_sha256,
    coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM words LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""

ORACLES["op8_warc_members"] = """
WITH payloads AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
        list_transform(string_split(sha1(coalesce(html, '')), ''),
            lambda h: strpos('0123456789abcdef', h) - 1) AS hex
    FROM pages
), digests AS (
    SELECT page_id, payload_bytes, list_aggregate(list_transform(range(32), lambda i: substr(
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + ((16 * hex[1 + 5 * i // 4] + hex[2 + 5 * i // 4]) >> (3 - 5 * i % 4)) % 32, 1)),
        'string_agg', '') AS payload_digest
    FROM payloads
), firsts AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM digests
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END
        AS record_type,
    CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM firsts
"""

# What lies in the article element of the given pages, whose references are few.
ORACLES["op11_block_tree"] = r"""
WITH pieces AS (
    SELECT page_id, url, list_transform(
        regexp_split_to_array(regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's'), '</?(?:p|h1)>'),
        lambda p: trim(regexp_replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
            p, '<[^>]*>', ' ', 'g'), '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'),
            '&amp;', '&'), '&amp', '&'), '\s+', ' ', 'g'))) AS blocks
    FROM pages
), texts AS (
    SELECT page_id, url, array_to_string(list_filter(blocks, lambda b: b <> ''), chr(10) || chr(10)) AS text FROM pieces
)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM texts
"""
