"""The subpackage's registered queries and their DuckDB equivalents."""

from __future__ import annotations

from .conversation_trie import OP13_SQL, op13_conversation_trie
from .decontaminate import op7_decontaminate
from .exact_dedup import OP9_SQL, op9_exact_dedup
from .hard_negatives import OP11_SQL, op11_hard_negatives
from .kd_shards import op2_kd_shards
from .lm_score import op3_lm_score
from .mixing import op8_mixing
from .near_dedup import op6_near_dedup
from .quality import op4_quality
from .secrets import op1_secret_scan
from .token_file import op5_token_file
from .toxicity import op10_toxicity
from .word_bpe import op12_word_bpe

QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_kd_shards, op3_lm_score, op4_quality, op5_token_file, op6_near_dedup,
    op7_decontaminate, op8_mixing, op9_exact_dedup, op10_toxicity,
    op11_hard_negatives, op12_word_bpe, op13_conversation_trie)}

# The others (spans with positions, trees, trained models, encoded files, similarity
# components, edit distance, fitted rates) have no SQL form; tests/llm holds brute force.
ORACLE = {"op9_exact_dedup": OP9_SQL, "op11_hard_negatives": OP11_SQL, "op13_conversation_trie": OP13_SQL}
