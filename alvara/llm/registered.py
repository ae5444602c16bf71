"""The queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from .embeddings import op8_embedding_near_dedup
from .html_text import op10_html_extraction
from .lm_scores import OP3_SQL, op3_lm_scores
from .mixing import op5_mixing
from .pieces import op2_sentencepiece
from .prefix_trie import OP11_SQL, op11_prefix_trie
from .quality_rules import op6_quality_rules
from .quality_trees import op12_quality_classifier
from .repeats import op4_suffix_dedup
from .secrets import op9_secret_scan
from .sharding import op1_sharding
from .simhash import op7_simhash_near_dedup
from .spelling import OP13_SQL, op13_spelling_variants

QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_lm_scores": op3_lm_scores,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_mixing": op5_mixing,
    "op6_quality_rules": op6_quality_rules,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op8_embedding_near_dedup": op8_embedding_near_dedup,
    "op9_secret_scan": op9_secret_scan,
    "op10_html_extraction": op10_html_extraction,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_quality_classifier": op12_quality_classifier,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE: dict[str, str] = {
    "op3_lm_scores": OP3_SQL, "op11_prefix_trie": OP11_SQL, "op13_spelling_variants": OP13_SQL}
