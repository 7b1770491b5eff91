"""Operators of a training-data pipeline and their registered queries."""

from __future__ import annotations

from .op01_warc import ORACLE as OP1_SQL, op1_warc
from .op02_token_counts import op2_token_counts
from .op03_chat import ORACLE as OP3_SQL, op3_chat
from .op04_ann import ORACLE as OP4_SQL, op4_ann
from .op05_packing import op5_packing
from .op06_quality import op6_quality
from .op07_simhash import op7_simhash
from .op08_toxicity import op8_toxicity
from .op09_suffix import op9_suffix
from .op10_tiling import op10_decontaminate
from .op11_importance import op11_resampling
from .op12_path_ratios import op12_extraction
from .op13_audit import ORACLE as OP13_SQL, op13_filter_audit

QUERIES = {
    "op1_warc": op1_warc,
    "op2_token_counts": op2_token_counts,
    "op3_chat": op3_chat,
    "op4_ann": op4_ann,
    "op5_packing": op5_packing,
    "op6_quality": op6_quality,
    "op7_simhash": op7_simhash,
    "op8_toxicity": op8_toxicity,
    "op9_suffix": op9_suffix,
    "op10_decontaminate": op10_decontaminate,
    "op11_resampling": op11_resampling,
    "op12_extraction": op12_extraction,
    "op13_filter_audit": op13_filter_audit,
}

ORACLES: dict[str, str] = {"op1_warc": OP1_SQL, "op3_chat": OP3_SQL, "op4_ann": OP4_SQL, "op13_filter_audit": OP13_SQL}
