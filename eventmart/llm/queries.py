"""Registered queries of the operators, with their fixed parameters, and SQL twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm import (
    ann,
    language,
    lattice_lm,
    mixing,
    order_minhash,
    packing,
    quality,
    simhash,
    spelling,
    token_counts,
    toxicity,
    turn_trie,
    vantage,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    pieces = packing.token_pieces(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return packing.pack_lengths(packing.stored(packing.checksum(pieces)))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents; labels of rows with crc32 mod 3 of 1 are held out."""
    return quality.predict(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents; labels of rows with crc32 mod 4 of 2 are held out."""
    return toxicity.predict(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_multiprobe_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for each vector whose id is divisible by 20."""
    return ann.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of tokens of all documents."""
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op6_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probabilities of all documents; rows with crc32 mod 7 of 2 are held out."""
    return lattice_lm.predict(_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all texts and their edited texts."""
    return simhash.edited_likeness(_table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents; rows with crc32 mod 5 of 0 are held out."""
    return language.predict(_table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed with weights 1, 2, 3 in turn, each source at most three times."""
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of near-duplicates of each document."""
    return order_minhash.classes(_table(spark, sf_dir, "documents"))


def op11_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all rebuilt conversations."""
    return turn_trie.prefix_nodes(_table(spark, sf_dir, "conversations"))


def op12_vantage_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and the components of those within three bits."""
    return vantage.near_components(_table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of the documents with the frequent words that they are variants of."""
    return spelling.group_spellings(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_quality_classifier,
        op3_toxicity,
        op4_multiprobe_ann,
        op5_token_counts,
        op6_lattice_lm,
        op7_simhash,
        op8_language_id,
        op9_mixing,
        op10_order_minhash,
        op11_turn_trie,
        op12_vantage_simhash,
        op13_spelling_variants,
    )
}

# crc32 of decimal digits, bit by bit; the polynomial is fixed by the checksum.
_CRC = """xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda state, byte: list_reduce(
      list_prepend(xor(state, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda crc, bit: xor(crc // 2, (crc % 2) * 3988292384))), 4294967295)"""

ORACLE_SQL: dict[str, str] = {
    "op11_turn_trie": f"""WITH own AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
lenders AS (SELECT conv_id AS base, turns AS lent FROM own),
rebuilt AS (
  SELECT conv_id, list_concat(coalesce(lent[1:h], []), turns[h + 1:]) AS turns
  FROM (SELECT conv_id, turns, {_CRC} % 4 AS h FROM own)
  LEFT JOIN lenders ON base = conv_id - conv_id % 20),
prefixes AS (
  SELECT conv_id, len(turns) AS size, unnest(range(len(turns) + 1)) AS depth, turns FROM rebuilt),
nodes AS (
  SELECT depth, turns[1:depth] AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = depth), '')) AS ends_sha256,
    CASE WHEN depth > 0 THEN len(regexp_extract_all(any_value(turns[depth].text), '[^\\x20\\x09-\\x0D]+')) ELSE 0 END AS words
  FROM prefixes GROUP BY depth, path),
kids AS (
  SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
full_nodes AS (
  SELECT nodes.*, coalesce(kids.n_children, 0) AS n_children
  FROM nodes LEFT JOIN kids ON nodes.path = kids.path),
sums AS (
  SELECT path[1:above] AS path, count(*) FILTER (n_children = 0) AS n_leaves,
    CAST(sum((n_convs - 1) * words) AS BIGINT) AS saved_tokens
  FROM (SELECT path, n_children, n_convs, words, unnest(range(depth + 1)) AS above FROM full_nodes) GROUP BY ALL)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves,
  s.saved_tokens, n.ends_sha256
FROM full_nodes AS n JOIN sums AS s ON n.path = s.path
LEFT JOIN nodes AS p ON n.depth > 0 AND p.path = n.path[1:n.depth - 1]""",
}
