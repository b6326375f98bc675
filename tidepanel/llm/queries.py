"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidepanel.llm.align import op12_cross_tokenizer
from tidepanel.llm.chat import op13_chat_formatting
from tidepanel.llm.exact import op8_exact_dedup
from tidepanel.llm.html import op9_html_extraction
from tidepanel.llm.licences import op1_licence_scan
from tidepanel.llm.lines import op5_line_dedup
from tidepanel.llm.merkle import op11_merkle_manifest
from tidepanel.llm.mixing import op6_mix_sources
from tidepanel.llm.neardup import op3_minhash_near_dedup
from tidepanel.llm.oracles import ORACLES
from tidepanel.llm.packing import op10_best_fit_packing
from tidepanel.llm.quality import op2_quality_rules
from tidepanel.llm.repeats import op7_suffix_array_dedup
from tidepanel.llm.toxicity import op4_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_licence_scan, op2_quality_rules, op3_minhash_near_dedup, op4_toxicity, op5_line_dedup, op6_mix_sources,
        op7_suffix_array_dedup, op8_exact_dedup, op9_html_extraction, op10_best_fit_packing,
        op11_merkle_manifest, op12_cross_tokenizer, op13_chat_formatting,
    )
}

__all__ = ["ORACLES", "QUERIES"]
