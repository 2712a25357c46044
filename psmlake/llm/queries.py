"""The operators as queries over the driver's tables, with their production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import embedding_dedup, exact_dedup, jaccard_join, language_id, lm_scoring, mixing, packing, pii, prefix_trie, repeated_passages, token_counts, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_groups(table(spark, sf_dir, "embeddings"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similarity_groups(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.severity(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op6_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages.without_repeats(table(spark, sf_dir, "documents")).drop("spans")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language_id.fit(table(spark, sf_dir, "documents"))
    return language_id.page_languages(table(spark, sf_dir, "pages"), model).select("page_id", "language", "chance", "accepted")


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_secret", "n_term", "private")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_scores(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_exact_dedup, op2_embedding_dedup, op3_jaccard_join, op4_toxicity, op5_packing, op6_repeated_passages, op7_mixing, op8_token_counts, op9_language_id, op10_personal_data, op11_prefix_trie, op12_lm_scoring)}

SQL: dict[str, str] = {
    "op1_exact_dedup": r"""
        WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, h AS text_sha256
        FROM d WINDOW w AS (PARTITION BY h)
    """,
    # crc32 by its definition, bit by bit; nodes by the digest of all turns so far
    "op11_prefix_trie": r"""
        WITH t AS (
            SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos, coalesce(role, '') AS r, coalesce(text, '') AS x
            FROM conversations WHERE conv_id IS NOT NULL
        ), s AS (SELECT conv_id, count(*) AS own FROM t GROUP BY conv_id), c AS (
            SELECT conv_id, conv_id - conv_id % 100 AS base,
                xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
                    lambda acc, b: list_reduce(list_prepend(xor(acc, b), range(8)), lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295::BIGINT) % 6 AS h
            FROM s
        ), d AS (SELECT c.*, least(h, coalesce(s.own, 0)) AS head FROM c LEFT JOIN s ON s.conv_id = c.base), u AS (
            SELECT d.conv_id, pos, r, x FROM d JOIN t ON t.conv_id = d.base AND pos < head
            UNION ALL SELECT d.conv_id, pos - h + head, r, x FROM d JOIN t USING (conv_id) WHERE pos >= h
        ), p AS (
            SELECT conv_id, pos + 1 AS depth, length(x) AS chars, sha256(string_agg(sha256(r) || sha256(x), '') OVER (PARTITION BY conv_id ORDER BY pos)) AS node FROM u
            UNION ALL SELECT conv_id, 0, 0, '' FROM d
        ), n AS (SELECT node, min(depth) AS depth, min(chars) AS chars, min(conv_id) AS conv_id, count(*) AS n_convs FROM p GROUP BY node),
        links AS (SELECT DISTINCT a.node, b.node AS up FROM p a JOIN p b ON b.conv_id = a.conv_id AND b.depth = a.depth - 1),
        kids AS (SELECT up AS node, count(*) AS n_children FROM links GROUP BY up),
        lines AS (SELECT DISTINCT a.node, b.node AS top FROM p a JOIN p b ON b.conv_id = a.conv_id AND b.depth <= a.depth),
        below AS (
            SELECT top AS node, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves, sum((n_convs - 1) * chars) AS saved_tokens
            FROM lines JOIN n USING (node) LEFT JOIN kids USING (node) GROUP BY top
        ), ends AS (
            SELECT p.node, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256
            FROM p JOIN (SELECT conv_id, max(depth) AS depth FROM p GROUP BY conv_id) USING (conv_id, depth) GROUP BY p.node
        )
        SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
        FROM n LEFT JOIN links USING (node) LEFT JOIN n up ON up.node = links.up LEFT JOIN kids ON kids.node = n.node JOIN below ON below.node = n.node LEFT JOIN ends ON ends.node = n.node
    """,
}
