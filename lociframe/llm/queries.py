"""The queries of this subpackage and, where SQL can express them on whole tables, their SQL."""

from __future__ import annotations

from lociframe.llm.divergence import OP11_SQL, op11_source_divergence
from lociframe.llm.embedding_dedup import op1_embedding_dedup
from lociframe.llm.hard_negatives import op13_hard_negatives
from lociframe.llm.imatch import op12_document_fingerprints
from lociframe.llm.mixing import op8_mix_sources
from lociframe.llm.pieces import op4_sentencepiece
from lociframe.llm.quality_classifier import op6_quality_classifier
from lociframe.llm.quality_rules import op10_quality_rules
from lociframe.llm.substring_dedup import op7_substring_dedup
from lociframe.llm.simhash import op5_simhash_near_dedup
from lociframe.llm.suffix_dedup import op3_suffix_array_dedup
from lociframe.llm.token_output import op2_token_output
from lociframe.llm.url_filter import OP9_SQL, op9_url_filters

QUERIES = {f.__name__: f for f in (op1_embedding_dedup, op2_token_output, op3_suffix_array_dedup, op4_sentencepiece, op5_simhash_near_dedup, op6_quality_classifier, op7_substring_dedup, op8_mix_sources, op9_url_filters, op10_quality_rules, op11_source_divergence, op12_document_fingerprints, op13_hard_negatives)}
ORACLE_SQL = {"op9_url_filters": OP9_SQL, "op11_source_divergence": OP11_SQL}
