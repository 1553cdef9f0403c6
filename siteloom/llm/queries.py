"""Queries of this subpackage and, where SQL can express them, their DuckDB equivalents."""

from __future__ import annotations

from importlib import import_module

_MODULES = {
    "op1_pii_crf": "pii", "op2_license_dice": "licenses", "op3_fingerprints": "fingerprints", "op4_toxicity": "toxicity",
    "op5_quality_qda": "quality", "op6_probminhash": "probminhash", "op7_suffix_dedup": "suffixes", "op8_packing": "packing",
    "op9_block_knn": "neighbours", "op10_curriculum": "mixing",
}


def queries() -> dict:
    return {name: getattr(import_module(f"siteloom.llm.{module}"), name) for name, module in _MODULES.items()}


def oracle_sql() -> dict[str, str]:
    found = {name: getattr(import_module(f"siteloom.llm.{module}"), "SQL", None) for name, module in _MODULES.items()}
    return {name: sql for name, sql in found.items() if sql}
