"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from importlib import import_module

#: query name -> module of this package that holds query() and, where SQL can say it, ORACLE_SQL
MODULES = {
    "op1_url_filter": "url_filter",
    "op2_fingerprints": "fingerprints",
    "op3_warc": "warc",
    "op4_suffix_dedup": "suffix_dedup",
    "op5_nearest_neighbours": "nearest_neighbours",
    "op6_language_id": "language_id",
    "op7_piece_tokens": "piece_tokens",
    "op8_quality_classifier": "quality_classifier",
    "op9_source_mixing": "source_mixing",
    "op10_near_duplicates": "near_duplicates",
}


def queries() -> dict:
    return {name: import_module(f"loomspan.llm.{module}").query for name, module in MODULES.items()}


def oracle_sql() -> dict[str, str]:
    found = {name: getattr(import_module(f"loomspan.llm.{module}"), "ORACLE_SQL", None) for name, module in MODULES.items()}
    return {name: sql for name, sql in found.items() if sql}
