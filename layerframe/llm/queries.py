"""The registered queries of this folder, and SQL where it can express one."""

from __future__ import annotations

from layerframe.llm.audit import OP12_SQL, op12_filter_audit
from layerframe.llm.counts import op8_token_counts
from layerframe.llm.forest import op5_random_projection_forest
from layerframe.llm.html import op13_html_extraction
from layerframe.llm.language import op9_language_id
from layerframe.llm.near_duplicates import op2_near_duplicates
from layerframe.llm.packing import op3_curve_packing
from layerframe.llm.pieces import op1_sentencepiece
from layerframe.llm.quality import op10_quality
from layerframe.llm.runs import op11_periodic_runs
from layerframe.llm.topk import OP4_SQL, op4_exact_topk
from layerframe.llm.toxicity import op6_toxicity
from layerframe.llm.urls import op7_url_filter

QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_curve_packing": op3_curve_packing,
    "op4_exact_topk": op4_exact_topk,
    "op5_random_projection_forest": op5_random_projection_forest,
    "op6_toxicity": op6_toxicity,
    "op7_url_filter": op7_url_filter,
    "op8_token_counts": op8_token_counts,
    "op9_language_id": op9_language_id,
    "op10_quality": op10_quality,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_filter_audit": op12_filter_audit,
    "op13_html_extraction": op13_html_extraction,
}
ORACLE: dict[str, str] = {"op4_exact_topk": OP4_SQL, "op12_filter_audit": OP12_SQL}
