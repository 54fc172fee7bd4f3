"""Registered queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from landfall.llm.bwt_merge import repeat_digest
from landfall.llm.cap_filters import vector_classes
from landfall.llm.decontaminate import contaminated
from landfall.llm.language_id import languages_of
from landfall.llm.packing import packed
from landfall.llm.quality import quality_scores
from landfall.llm.sentencepiece_codec import encoding_digest
from landfall.llm.simhash import simhash_classes
from landfall.llm.suffix_trees import shared_window_digest
from landfall.llm.tables import read_table as table
from landfall.llm.token_files import token_files
from landfall.llm.toxicity import toxic_scores
from landfall.llm.turn_trie import prefix_trie
from landfall.llm.whitening import whitened


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_classes(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages_of(table(spark, sf_dir, "documents"))


def op1_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_classes(table(spark, sf_dir, "embeddings"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding_digest(table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_bwt_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digest(table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_window_digest(table(spark, sf_dir, "documents"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op12_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op6_substring_dedup": op6_substring_dedup,
    "op10_bwt_dedup": op10_bwt_dedup,
    "op8_decontaminate": op8_decontaminate,
    "op9_token_files": op9_token_files,
    "op5_sentencepiece": op5_sentencepiece,
    "op1_cap_filters": op1_cap_filters,
    "op2_language_id": op2_language_id,
    "op7_toxicity": op7_toxicity,
    "op3_quality": op3_quality,
    "op4_simhash": op4_simhash,
    "op11_packing": op11_packing,
    "op12_turn_trie": op12_turn_trie,
    "op13_whitening": op13_whitening,
}

SQL: dict[str, str] = {
    "op1_cap_filters": """
        WITH RECURSIVE vectors AS MATERIALIZED (
            SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
        ),
        pairs AS MATERIALIZED (
            SELECT a.vec_id AS one, b.vec_id AS other FROM vectors a JOIN vectors b
            ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9
        ),
        reached AS (
            SELECT vec_id AS node, vec_id AS origin FROM vectors
            UNION
            SELECT p.other, r.origin FROM reached r JOIN pairs p ON p.one = r.node
        ),
        classes AS (SELECT node, min(origin) AS component_id FROM reached GROUP BY node),
        counts AS (SELECT one, count(*) AS n FROM pairs GROUP BY one)
        SELECT node AS vec_id, coalesce(n, 0) AS n_links, component_id, node = component_id AS kept
        FROM classes LEFT JOIN counts ON one = node
    """,
    "op6_substring_dedup": r"""
        WITH split AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
        ),
        windows AS (
            SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS content
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM split)
        ),
        first AS (SELECT content, min(doc_id) AS earliest FROM windows GROUP BY content),
        covered AS (
            SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS place
            FROM windows JOIN first USING (content) WHERE doc_id > earliest
        ),
        placed AS (
            SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM split
        ),
        kept AS (
            SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS text
            FROM placed ANTI JOIN covered USING (doc_id, place) GROUP BY doc_id
        )
        SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
               sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM split LEFT JOIN kept USING (doc_id)
    """,
    "op12_turn_trie": """
        WITH RECURSIVE whole AS (
            SELECT conv_id, list({'r': r, 'x': x} ORDER BY turn NULLS FIRST, r, x) AS turns
            FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)
            GROUP BY conv_id
        ),
        -- crc32 of the decimal id, bit by bit: each digit comes in before its eight steps.
        split AS (
            SELECT *, (xor(list_reduce(
                flatten(list_transform(range(1, len(conv_id::VARCHAR) + 1),
                    lambda i: [ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
                lambda a, b: xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1)), 4294967295), 4294967295) % 9)::BIGINT AS h
            FROM whole
        ),
        rebuilt AS (
            SELECT own.conv_id, list_concat(coalesce(first.turns[1:own.h], []), own.turns[own.h + 1:]) AS turns
            FROM split own LEFT JOIN whole first ON first.conv_id = own.conv_id - own.conv_id % 5
        ),
        members AS (
            SELECT conv_id, d, turns[1:d] AS path, len(turns) = d AS ending
            FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)
        ),
        nodes AS (
            SELECT d, path, min(conv_id) AS conv_id, count(*) AS n,
                   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ending), '')) AS ends,
                   CASE WHEN d > 0 THEN (count(*) - 1) * strlen(path[d].x) ELSE 0 END AS saved
            FROM members GROUP BY d, path
        ),
        children AS (
            SELECT d - 1 AS d, path[1:d - 1] AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL
        ),
        under AS (
            SELECT a AS d, path[1:a] AS path, sum(leaf::INT) AS leaves, sum(saved) AS saved
            FROM (
                SELECT unnest(range(0, n.d + 1)) AS a, n.path, c.n IS NULL AS leaf, n.saved
                FROM nodes n LEFT JOIN children c ON c.d = n.d AND c.path = n.path
            ) GROUP BY ALL
        )
        SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n::BIGINT AS n_convs,
               coalesce(c.n, 0)::BIGINT AS n_children, u.leaves::BIGINT AS n_leaves, u.saved::BIGINT AS saved_tokens, n.ends AS ends_sha256
        FROM nodes n JOIN under u ON u.d = n.d AND u.path = n.path
        LEFT JOIN children c ON c.d = n.d AND c.path = n.path
        LEFT JOIN nodes p ON p.d = n.d - 1 AND p.path = n.path[1:n.d - 1]
    """,
}
