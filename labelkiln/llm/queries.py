"""The queries of the pipeline operators and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from labelkiln.llm import (
    alignment, chat, exact_dedup, fingerprints, line_dedup, mixing, near_dedup, packing, quality, shards, spelling,
    token_files, toxicity,
)
from labelkiln.llm.common import documents, labels


def _tokenizer(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_order_minhash": lambda s, d: fingerprints.fingerprint_report(documents(s, d)),
    "op2_histogram_sort": lambda s, d: shards.shard_report(documents(s, d)),
    "op3_simple8b_tokens": lambda s, d: token_files.token_report(documents(s, d), _tokenizer()),
    "op4_super_minhash": lambda s, d: near_dedup.near_groups(documents(s, d), width=4),
    "op5_chunk_recipes": lambda s, d: exact_dedup.exact_groups(documents(s, d)),
    "op6_best_fit_packing": lambda s, d: packing.best_fit_pack(documents(s, d)),
    "op7_line_similarity": lambda s, d: line_dedup.line_report(documents(s, d)),
    "op8_compression_toxicity": lambda s, d: toxicity.toxicity_report(documents(s, d), labels(s, d)),
    "op9_source_mixing": lambda s, d: mixing.mix_report(documents(s, d)),
    "op10_fourier_quality": lambda s, d: quality.quality_report(documents(s, d), labels(s, d)),
    "op11_typed_chat": lambda s, d: chat.chat_report(s.read.parquet(f"{d}/conversations.parquet")),
    "op12_pair_bitmaps": lambda s, d: alignment.alignment_report(
        documents(s, d), _tokenizer(), _tokenizer("piece_bpe_32k.model")),
    "op13_spelling_variants": lambda s, d: spelling.variant_groups(documents(s, d)),
}

SQL: dict[str, str] = {
    "op5_chunk_recipes": r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t
  FROM documents),
f AS (
  SELECT *, count(*) OVER (PARTITION BY t) AS group_size,
    first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id NULLS LAST) AS keep_id,
    row_number() OVER (PARTITION BY t, doc_id ORDER BY n DESC) AS nth
  FROM n)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AND nth = 1 AS kept, sha256(t) AS text_sha256
FROM f
""",
    "op9_source_mixing": mixing.MIX_SQL,
    "op11_typed_chat": chat.CHAT_SQL,
}
