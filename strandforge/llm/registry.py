"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import html, jaccard, licenses, media, mixing, packing, quality, sharding, tokens, toxicity

QUERIES = {
    "op3_ngram_jaccard": jaccard.op3_ngram_jaccard,
    "op8_html_wrappers": html.op8_html_wrappers,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_license_scan": licenses.op7_license_scan,
    "op5_media_columns": media.op5_media_columns,
    "op1_pack_hierarchical": packing.op1_pack_hierarchical,
    "op4_token_counts": tokens.op4_token_counts,
    "op2_shard_by_splitters": sharding.op2_shard_by_splitters,
    "op9_mix_sources": mixing.op9_mix_sources,
    "op10_quality_rules": quality.op10_quality_rules,
}
SQL = {
    "op9_mix_sources": mixing.OP9_SQL,
    "op10_quality_rules": quality.OP10_SQL,
}
