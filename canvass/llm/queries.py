"""The queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

import corpus_pipeline
from canvass.llm.context_tree import op3_context_tree
from canvass.llm.decontaminate import op6_benchmark_hits
from canvass.llm.divergence import op13_source_divergence
from canvass.llm.factorization import op11_quality_classifier
from canvass.llm.lexical_search import op12_lexical_search
from canvass.llm.licences import op10_licence_scan
from canvass.llm.line_dedup import op7_line_dedup
from canvass.llm.mixing import op2_mix_sources
from canvass.llm.oracle import BENCHMARK_HITS, LEXICAL_SEARCH, SOURCE_DIVERGENCE, SUBSTRING_DEDUP
from canvass.llm.quality import op8_quality_rules
from canvass.llm.simhash import op5_simhash_groups
from canvass.llm.substring_dedup import op1_substring_dedup
from canvass.llm.suffix_dedup import op9_suffix_dedup
from canvass.llm.wrappers import op4_html_articles

QUERIES = {f.__name__: f for f in (op1_substring_dedup, op2_mix_sources, op3_context_tree, op4_html_articles, op5_simhash_groups, op6_benchmark_hits, op7_line_dedup, op8_quality_rules, op9_suffix_dedup, op10_licence_scan, op11_quality_classifier, op12_lexical_search, op13_source_divergence)}
QUERIES["pipeline"] = corpus_pipeline.run
ORACLE: dict[str, str] = {"op1_substring_dedup": SUBSTRING_DEDUP, "op6_benchmark_hits": BENCHMARK_HITS, "op12_lexical_search": LEXICAL_SEARCH, "op13_source_divergence": SOURCE_DIVERGENCE}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
