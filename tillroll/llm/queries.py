"""The registered corpus queries and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm.alignment import alignment_query
from tillroll.llm.ann import ann_query
from tillroll.llm.collocations import COLLOCATION_SQL, collocation_query
from tillroll.llm.decontaminate import DECONTAMINATION_SQL, decontamination_query
from tillroll.llm.language import language_query
from tillroll.llm.licenses import license_query
from tillroll.llm.line_dedup import LINE_DEDUP_SQL, line_dedup_query
from tillroll.llm.mixing import mixing_query
from tillroll.llm.near_dup import NEAR_DUP_SQL, near_dup_query
from tillroll.llm.quality import quality_query
from tillroll.llm.secret_scan import secret_query
from tillroll.llm.simhash import simhash_query
from tillroll.llm.suffix_dedup import suffix_dedup_query

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": license_query,
    "op2_near_dup": near_dup_query,
    "op3_decontamination": decontamination_query,
    "op4_mixing": mixing_query,
    "op5_nearest_neighbours": ann_query,
    "op6_line_dedup": line_dedup_query,
    "op7_secret_scan": secret_query,
    "op8_quality": quality_query,
    "op9_language_id": language_query,
    "op10_suffix_dedup": suffix_dedup_query,
    "op11_collocations": collocation_query,
    "op12_simhash": simhash_query,
    "op13_alignment": alignment_query,
}

ORACLE_SQL: dict[str, str] = {
    "op2_near_dup": NEAR_DUP_SQL,
    "op3_decontamination": DECONTAMINATION_SQL,
    "op6_line_dedup": LINE_DEDUP_SQL,
    "op11_collocations": COLLOCATION_SQL,
}
