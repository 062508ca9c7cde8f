"""The thin query of each operator, by its registered name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from homestat.llm import (chat, decontam, lexical, licensescan, linededup, neardup, packing, phrases, quality, secretscan, topk, toxicity,
                          urlfilter)
from homestat.llm.oracles import ORACLES

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_quality_rules": quality.op1,
    "op2_decontamination": decontam.op2,
    "op3_license_scan": licensescan.op3,
    "op4_url_filter": urlfilter.op4,
    "op5_secret_scan": secretscan.op5,
    "op6_chat_formatting": chat.op6,
    "op7_toxicity": toxicity.op7,
    "op8_line_dedup": linededup.op8,
    "op9_near_dedup": neardup.op9,
    "op10_packing": packing.op10,
    "op11_top_k_search": topk.op11,
    "op12_phrase_mining": phrases.op12,
    "op13_lexical_search": lexical.op13,
}


def queries() -> dict[str, Query]:
    return QUERIES | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    sql = dict(ORACLES)
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql
