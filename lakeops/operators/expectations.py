"""Data-quality expectations on an operator's output (Q1-Q4).

Three actions, as in declarative pipelines:

* ``warn`` -- keep every row, count violations;
* ``drop`` -- remove violating rows, count them;
* ``fail`` -- any violating row aborts.

A condition that evaluates to null counts as a violation (``null >= 0`` is
not a pass). Counting uses ``DataFrame.observe``: the counts are filled in by
the same job that computes or writes the data, with no second pass. To gate
a publication, write the new rows aside, call ``check`` on the observation,
and only then overwrite the table (``lakeops.operators.upsert.full_refresh``).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Expectation:
    name: str
    condition: str  # SQL boolean expression
    action: str = "warn"  # warn | drop | fail

    def passed(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


class ExpectationFailed(RuntimeError):
    pass


def expect(name: str, condition: str) -> Expectation:
    return Expectation(name, condition, "warn")


def expect_or_drop(name: str, condition: str) -> Expectation:
    return Expectation(name, condition, "drop")


def expect_or_fail(name: str, condition: str) -> Expectation:
    return Expectation(name, condition, "fail")


def violation_counts(rules: Sequence[Expectation]) -> list[Column]:
    """Aggregates to observe: ``rows`` and each rule's violations."""
    return [F.count(F.lit(1)).alias("rows"), *(F.count_if(~r.passed()).alias(r.name) for r in rules)]


def guarded(df: DataFrame, rules: Sequence[Expectation], guard_fail: bool = True) -> DataFrame:
    """Without the rows that a ``drop`` rule removes; with ``guard_fail`` a row
    that violates a ``fail`` rule raises inside the job."""
    for r in rules:
        if r.action == "fail" and guard_fail:
            df = df.filter(F.when(r.passed(), F.lit(True)).otherwise(
                F.raise_error(F.lit(f"expectation {r.name} failed: {r.condition}"))))
    for r in rules:
        if r.action == "drop":
            df = df.filter(r.passed())
    return df


def apply_expectations(df: DataFrame, rules: Sequence[Expectation],
                       guard_fail: bool = True) -> tuple[DataFrame, Observation]:
    """Attach the rules to ``df``.

    Returns the (filtered) DataFrame and an Observation that, once an action
    ran, holds ``rows`` (input rows) and ``<rule>`` violation counts.
    With ``guard_fail`` a failing row also raises inside the job.
    """
    obs = Observation(f"expect_{uuid.uuid4().hex[:8]}")
    return guarded(df.observe(obs, *violation_counts(rules)), rules, guard_fail), obs


def check(obs: Observation, rules: Sequence[Expectation]) -> dict:
    """Raise when a ``fail`` rule has violations; return all counts."""
    got = obs.get
    for r in rules:
        if r.action == "fail" and got.get(r.name, 0):
            raise ExpectationFailed(f"{r.name}: {got[r.name]} violating rows")
    return got


def expectation_report(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """One row per rule: (rule, action, rows, violations) in a single pass."""
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(~r.passed()).alias(f"_v{i}") for i, r in enumerate(rules)])
    entries = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"),
                                 F.col(f"_v{i}").alias("violations"))
                        for i, r in enumerate(rules)])
    return (agg.select(F.col("_rows").alias("rows"), F.inline(entries))
            .select("rule", "action", "rows", "violations"))
