"""The registered corpus queries, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from llm.audit import ORACLE_OP11, op11_filter_audit
from llm.classifier import op13_quality_classifier
from llm.licenses import op3_license_scan
from llm.lm import op4_interpolated_lm
from llm.mixing import op8_source_mixture
from llm.neardup import op5_near_duplicates
from llm.packing import op2_best_fit_packing
from llm.phrases import ORACLE_OP12, op12_collocations
from llm.pii import op9_personal_data
from llm.quality import op7_line_quality
from llm.topk import ORACLE_OP6, op6_exact_top_k
from llm.toxicity import op1_toxicity
from llm.urls import op10_url_verdicts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_license_scan": op3_license_scan,
    "op4_interpolated_lm": op4_interpolated_lm,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_exact_top_k": op6_exact_top_k,
    "op7_line_quality": op7_line_quality,
    "op8_source_mixture": op8_source_mixture,
    "op9_personal_data": op9_personal_data,
    "op10_url_verdicts": op10_url_verdicts,
    "op11_filter_audit": op11_filter_audit,
    "op12_collocations": op12_collocations,
    "op13_quality_classifier": op13_quality_classifier,
}
ORACLE_SQL: dict[str, str] = {
    "op6_exact_top_k": ORACLE_OP6,
    "op11_filter_audit": ORACLE_OP11,
    "op12_collocations": ORACLE_OP12,
}
