"""Registered queries of the training-data operators and their DuckDB twins."""

from __future__ import annotations

from claimlens.llm import bwt_dedup, decontaminate, filter_audit, gif, interpolation, minhash, mixing, quality, secret_scan, seed_extend, sharding, token_align, url_rules


def queries() -> dict:
    return {
        "op1_quality": quality.op1,
        "op2_bwt_dedup": bwt_dedup.op2,
        "op3_mixing": mixing.op3,
        "op4_minhash": minhash.op4,
        "op5_decontamination": decontaminate.op5,
        "op6_secrets": secret_scan.op6,
        "op7_seed_extend": seed_extend.op7,
        "op8_gif": gif.op8,
        "op9_interpolation": interpolation.op9,
        "op10_hilbert_shards": sharding.op10,
        "op11_url_rules": url_rules.op11,
        "op12_filter_audit": filter_audit.op12,
        "op13_token_align": token_align.op13,
    }


def oracle_sql() -> dict:
    return {
        "op7_seed_extend": seed_extend.SQL,
        "op11_url_rules": url_rules.SQL,
        "op12_filter_audit": filter_audit.SQL,
    }
