"""The registered queries of this subpackage and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline
from tessera.llm.chat import OP10_SQL, op10_chat_round_trip
from tessera.llm.decontam import op7_wu_manber_decontamination
from tessera.llm.licenses import op4_license_scan
from tessera.llm.linetree import OP9_SQL, op9_log_template_lines
from tessera.llm.packing import op3_best_fit_packing
from tessera.llm.quality import op13_quality_random_indexing
from tessera.llm.runs import op11_periodic_runs
from tessera.llm.simhash import op2_simhash_near_dedup
from tessera.llm.substring import op5_substring_dedup
from tessera.llm.tokenfile import op8_token_file
from tessera.llm.topk import OP1_SQL, op1_ball_tree_top_k
from tessera.llm.toxicity import op6_toxicity_fm
from tessera.llm.trie import OP12_SQL, op12_conversation_prefix_trie

QUERIES = {
    "op1_ball_tree_top_k": op1_ball_tree_top_k,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_license_scan": op4_license_scan,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_toxicity_fm": op6_toxicity_fm,
    "op7_wu_manber_decontamination": op7_wu_manber_decontamination,
    "op8_token_file": op8_token_file,
    "op9_log_template_lines": op9_log_template_lines,
    "op10_chat_round_trip": op10_chat_round_trip,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_conversation_prefix_trie": op12_conversation_prefix_trie,
    "op13_quality_random_indexing": op13_quality_random_indexing,
    "pipeline": corpus_pipeline.run,
}

ORACLE: dict[str, str] = {
    "op1_ball_tree_top_k": OP1_SQL,
    "op9_log_template_lines": OP9_SQL,
    "op10_chat_round_trip": OP10_SQL,
    "op12_conversation_prefix_trie": OP12_SQL,
}
