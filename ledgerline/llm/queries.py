"""The operators' queries over the driver's tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from ledgerline.llm import bpe, decontaminate, embed, exact_dedup, filter_audit, importance, license_scan, lm, mixing, simhash, token_count, token_store, toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_bpe": bpe.op1_bpe,
        "op2_toxicity": toxicity.op2_toxicity,
        "op3_exact_dedup": exact_dedup.op3_exact_dedup,
        "op4_simhash": simhash.op4_simhash,
        "op5_lm": lm.op5_lm,
        "op6_embed": embed.op6_embed,
        "op7_license_scan": license_scan.op7_license_scan,
        "op8_token_store": token_store.op8_token_store,
        "op9_mixing": mixing.op9_mixing,
        "op10_token_count": token_count.op10_token_count,
        "op11_filter_audit": filter_audit.op11_filter_audit,
        "op12_importance": importance.op12_importance,
        "op13_decontaminate": decontaminate.op13_decontaminate,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_exact_dedup": exact_dedup.OP3_SQL,
        "op9_mixing": mixing.OP9_SQL,
        "op11_filter_audit": filter_audit.OP11_SQL,
        "op13_decontaminate": decontaminate.OP13_SQL,
    }
