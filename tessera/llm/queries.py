"""Queries of this subpackage, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from tessera.llm.bitpack import op8_bit_packed_tokens
from tessera.llm.bpe import op3_streaming_bpe
from tessera.llm.decontaminate import OP5_SQL, op5_fm_index_decontamination
from tessera.llm.language import op6_evidence_fusion_language
from tessera.llm.resample import op1_importance_resampling
from tessera.llm.secrets import op2_character_network_secrets
from tessera.llm.sharding import op4_feistel_shards
from tessera.llm.simhash import op7_simhash_components
from tessera.llm.topk import OP10_SQL, op10_uniform_threshold_topk
from tessera.llm.toxicity import op9_compression_toxicity

QUERIES = {
    "op1_importance_resampling": op1_importance_resampling,
    "op2_character_network_secrets": op2_character_network_secrets,
    "op3_streaming_bpe": op3_streaming_bpe,
    "op4_feistel_shards": op4_feistel_shards,
    "op5_fm_index_decontamination": op5_fm_index_decontamination,
    "op6_evidence_fusion_language": op6_evidence_fusion_language,
    "op7_simhash_components": op7_simhash_components,
    "op8_bit_packed_tokens": op8_bit_packed_tokens,
    "op9_compression_toxicity": op9_compression_toxicity,
    "op10_uniform_threshold_topk": op10_uniform_threshold_topk,
}

SQL: dict[str, str] = {"op5_fm_index_decontamination": OP5_SQL, "op10_uniform_threshold_topk": OP10_SQL}
