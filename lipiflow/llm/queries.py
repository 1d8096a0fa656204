"""The registered queries of this subpackage and their SQL, where SQL can express one."""

from __future__ import annotations

from lipiflow.llm import decontamination, exact_dedup, language_id, license_scan, line_dedup, mixing, secret_scan, simhash_dedup, token_store, toxicity


def queries() -> dict:
    return {
        "op1_language_id": language_id.query,
        "op2_source_mixing": mixing.query,
        "op3_decontamination": decontamination.query,
        "op4_simhash_dedup": simhash_dedup.query,
        "op5_line_dedup": line_dedup.query,
        "op6_token_store": token_store.query,
        "op7_secret_scan": secret_scan.query,
        "op8_toxicity": toxicity.query,
        "op9_license_scan": license_scan.query,
        "op10_exact_dedup": exact_dedup.query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_source_mixing": mixing.SQL,
        "op5_line_dedup": line_dedup.SQL,
        "op7_secret_scan": secret_scan.SQL,
        "op9_license_scan": license_scan.SQL,
        "op10_exact_dedup": exact_dedup.SQL,
    }
