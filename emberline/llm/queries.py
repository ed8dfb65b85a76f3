"""The registered queries of this package and the SQL that says what they return, where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .decontamination import ORACLE as DECONTAMINATION_SQL
from .decontamination import op10_decontamination
from .line_labels import op5_line_labels
from .mixing import ORACLE as MIXING_SQL
from .mixing import op9_mixing
from .passages import op8_passages
from .rule_quality import op4_rule_quality
from .simhash import op6_simhash
from .site_lines import ORACLE as SITE_LINES_SQL
from .site_lines import op7_site_lines
from .token_counts import op2_token_counts
from .token_output import op1_token_records
from .toxicity import op3_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_records": op1_token_records,
    "op2_token_counts": op2_token_counts,
    "op3_toxicity": op3_toxicity,
    "op4_rule_quality": op4_rule_quality,
    "op5_line_labels": op5_line_labels,
    "op6_simhash": op6_simhash,
    "op7_site_lines": op7_site_lines,
    "op8_passages": op8_passages,
    "op9_mixing": op9_mixing,
    "op10_decontamination": op10_decontamination,
}

ORACLE_SQL: dict[str, str] = {
    "op7_site_lines": SITE_LINES_SQL,
    "op9_mixing": MIXING_SQL,
    "op10_decontamination": DECONTAMINATION_SQL,
}
