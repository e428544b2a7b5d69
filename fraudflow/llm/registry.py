"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .debruijn_dedup import op7_substring_dedup
from .decontaminate import OP4_SQL, op4_decontamination
from .fill_middle import OP12_SQL, op12_fill_in_middle
from .filter_audit import OP11_SQL, op11_filter_audit
from .html_text import op6_html_extraction
from .language_id import op13_language_id
from .near_dedup import op10_minhash_near_dedup
from .packing import op2_best_fit_packing
from .pii import op3_pii_pseudonyms
from .quality import OP5_SQL, op5_quality_rules
from .suffix_dedup import op1_suffix_dedup
from .toxicity import op9_toxicity
from .warc import OP8_SQL, op8_warc

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_suffix_dedup": op1_suffix_dedup,
        "op2_best_fit_packing": op2_best_fit_packing,
        "op3_pii_pseudonyms": op3_pii_pseudonyms,
        "op4_decontamination": op4_decontamination,
        "op5_quality_rules": op5_quality_rules,
        "op6_html_extraction": op6_html_extraction,
        "op7_substring_dedup": op7_substring_dedup,
        "op8_warc": op8_warc,
        "op9_toxicity": op9_toxicity,
        "op10_minhash_near_dedup": op10_minhash_near_dedup,
        "op11_filter_audit": op11_filter_audit,
        "op12_fill_in_middle": op12_fill_in_middle,
        "op13_language_id": op13_language_id,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_decontamination": OP4_SQL, "op5_quality_rules": OP5_SQL, "op8_warc": OP8_SQL, "op11_filter_audit": OP11_SQL, "op12_fill_in_middle": OP12_SQL}
