"""Queries and SQL of this subpackage: every operator module names its query, and the pipeline is added last."""

from __future__ import annotations

import importlib

MODULES = (
    "op1_secrets", "op2_quality", "op3_language_id", "op4_toxicity", "op5_exact_dedup", "op6_decontamination",
    "op7_sentencepiece", "op8_html", "op9_token_files", "op10_simhash", "op11_merkle", "op12_packing",
    "op13_vector_codes",
)


def _operators():
    return [importlib.import_module(f"{__package__}.{m}") for m in MODULES]


def queries() -> dict:
    return {m.NAME: m.query for m in _operators()}


def oracle_sql() -> dict[str, str]:
    return {m.NAME: m.ORACLE for m in _operators() if getattr(m, "ORACLE", None)}
