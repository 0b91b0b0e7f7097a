"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from loanweave.llm import (
    aho_corasick,
    conversation_repair,
    external_shuffle,
    licences,
    multi_index,
    nbsvm,
    norm_buckets,
    oracles,
    page_templates,
    presence_masks,
    secrets,
    sentencepiece_chunks,
    superminhash,
    toxicity,
)

QUERIES = {
    "op1_toxicity": toxicity.digests,
    "op2_licences": licences.digests,
    "op3_page_templates": page_templates.digests,
    "op4_secret_ownership": secrets.digests,
    "op5_external_shuffle": external_shuffle.digests,
    "op6_decontamination": aho_corasick.digests,
    "op7_quality": nbsvm.digests,
    "op8_sentencepiece_chunks": sentencepiece_chunks.digests,
    "op9_superminhash": superminhash.digests,
    "op10_multi_index": multi_index.digests,
    "op11_conversation_repair": conversation_repair.digests,
    "op12_presence_masks": presence_masks.digests,
    "op13_norm_buckets": norm_buckets.digests,
}

ORACLES: dict[str, str] = {
    "op6_decontamination": oracles.DECONTAMINATION,
    "op9_superminhash": oracles.NEAR_DUPLICATES,
    "op12_presence_masks": oracles.RANKED_SEARCH,
    "op13_norm_buckets": oracles.LARGEST_PRODUCTS,
}
