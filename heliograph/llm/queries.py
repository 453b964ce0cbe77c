"""Queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from .html_text import op10_html_text
from .mixing import op3_mix_sources
from .near_duplicates import op2_near_duplicates
from .near_vectors import ORACLE_SQL as OP13_SQL, op13_near_vectors
from .nearest import op1_nearest
from .prefix_trie import ORACLE_SQL as OP11_SQL, op11_prefix_trie
from .quality_classifier import op6_quality_classifier
from .quality_rules import ORACLE_SQL as OP5_SQL, op5_quality_rules
from .sampled_pieces import op8_sampled_pieces
from .secret_scan import op9_secret_scan
from .substring_dedup import op4_substring_dedup
from .token_alignment import op12_token_alignment
from .toxicity import op7_toxicity

QUERIES = {
    f.__name__: f
    for f in (
        op1_nearest, op2_near_duplicates, op3_mix_sources, op4_substring_dedup, op5_quality_rules,
        op6_quality_classifier, op7_toxicity, op8_sampled_pieces, op9_secret_scan, op10_html_text,
        op11_prefix_trie, op12_token_alignment, op13_near_vectors,
    )
}

# The others train models, walk texts byte by byte, search approximately or walk a rank order: tests compare them with brute force.
ORACLES: dict[str, str] = {"op5_quality_rules": OP5_SQL, "op11_prefix_trie": OP11_SQL, "op13_near_vectors": OP13_SQL}
