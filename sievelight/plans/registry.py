"""All registered queries, by area."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

AREAS = ["q_sources", "q_delivery", "q_observe", "q_redaction", "q_normalize", "q_mods", "q_exports", "q_state",
         "q_audits", "q_evaluation"]


def _modules():
    here = Path(__file__).parent
    return [import_module(f"sievelight.plans.{a}") for a in AREAS if (here / f"{a}.py").exists()]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for m in _modules() for name, fn in m.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql.strip() for m in _modules() for name, sql in m.ORACLES.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sievelight.plans.q_redaction import restricted_sources

    return restricted_sources(spark, sf_dir)
