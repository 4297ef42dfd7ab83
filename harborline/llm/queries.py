"""The registered queries of this subpackage and their DuckDB text."""

from __future__ import annotations

from harborline.llm.best_fit_packing import op1_best_fit_packing
from harborline.llm import conversation_trie, decontamination, entropy_secrets, merkle_manifest, substring_dedup
from harborline.llm.conversation_trie import op13_conversation_trie
from harborline.llm.decontamination import op10_decontamination
from harborline.llm.disclosure import op4_disclosure
from harborline.llm.entropy_secrets import op5_entropy_secrets
from harborline.llm.gru_lm import op9_gru_lm
from harborline.llm.imatch import op2_imatch
from harborline.llm.jaccard_join import op7_jaccard_join
from harborline.llm.kd_shards import op12_kd_shards
from harborline.llm.merkle_manifest import op11_merkle_manifest
from harborline.llm.substring_dedup import op8_substring_dedup
from harborline.llm.token_files import op6_token_files
from harborline.llm.toxicity import op3_toxicity

QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_imatch": op2_imatch,
    "op3_toxicity": op3_toxicity,
    "op4_disclosure": op4_disclosure,
    "op5_entropy_secrets": op5_entropy_secrets,
    "op6_token_files": op6_token_files,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_gru_lm": op9_gru_lm,
    "op10_decontamination": op10_decontamination,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_kd_shards": op12_kd_shards,
    "op13_conversation_trie": op13_conversation_trie,
}

#: None where SQL can't state the result: tokenizers, learned models, random
#: lexicons. Those are held against brute force in ``tests/llm``.
ORACLES: dict[str, str] = {
    "op5_entropy_secrets": entropy_secrets.oracle_sql(),
    "op8_substring_dedup": substring_dedup.oracle_sql(),
    "op10_decontamination": decontamination.oracle_sql(),
    "op11_merkle_manifest": merkle_manifest.oracle_sql(),
    "op13_conversation_trie": conversation_trie.oracle_sql(),
}
