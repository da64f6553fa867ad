"""Named row expectations that keep every row and count the failures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def expectation_metrics(df: DataFrame, rules: dict[str, str | Column]) -> DataFrame:
    """One row per rule: ``rule``, ``passed``, ``failed``; a condition that is NULL has failed.

    All rules are counted in one pass.
    """
    counted = df.agg(*_counters(rules))
    lines = [
        F.struct(F.lit(name).alias("rule"), F.col(f"p{i}").alias("passed"), F.col(f"f{i}").alias("failed"))
        for i, name in enumerate(rules)
    ]
    return counted.select(F.inline(F.array(*lines)))


def expect(df: DataFrame, rules: dict[str, str | Column]) -> tuple[DataFrame, Observation]:
    """``df`` unchanged, and an observation whose ``get`` holds ``<rule>_passed`` and ``<rule>_failed``
    after the first action on it."""
    observation = Observation()
    return df.observe(observation, *_counters(rules, list(rules))), observation


def expect_stream(df: DataFrame, name: str, rules: dict[str, str | Column]) -> DataFrame:
    """The stream ``df`` unchanged; the counts of each micro-batch are in the progress of its query,
    under ``observedMetrics[name]``."""
    return df.observe(name, *_counters(rules, list(rules)))


def _counters(rules: dict[str, str | Column], names: list[str] | None = None) -> list[Column]:
    counters = []
    for i, rule in enumerate(rules.values()):
        holds = F.coalesce(F.expr(rule) if isinstance(rule, str) else rule, F.lit(False))
        passed, failed = (f"{names[i]}_passed", f"{names[i]}_failed") if names else (f"p{i}", f"f{i}")
        counters += [F.count_if(holds).alias(passed), F.count_if(~holds).alias(failed)]
    return counters
