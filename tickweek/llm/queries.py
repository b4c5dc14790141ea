"""The corpus queries by name, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickweek.llm import (
    binary,
    centroids,
    decontaminate,
    fingerprint,
    langid,
    licenses,
    linededup,
    neardup,
    oracle,
    packing,
    periodic,
    quality,
    sharding,
    suffixtree,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_packing": packing.op1_packing,
        "op2_language": langid.op2_language,
        "op3_fingerprints": fingerprint.op3_fingerprints,
        "op4_quality": quality.op4_quality,
        "op5_licenses": licenses.op5_licenses,
        "op6_binary": binary.op6_binary,
        "op7_decontamination": decontaminate.op7_decontamination,
        "op8_line_dedup": linededup.op8_line_dedup,
        "op9_sharding": sharding.op9_sharding,
        "op10_near_duplicates": neardup.op10_near_duplicates,
        "op11_centroids": centroids.op11_centroids,
        "op12_runs": periodic.op12_runs,
        "op13_scores": suffixtree.op13_scores,
    }


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
