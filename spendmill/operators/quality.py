"""Data-quality rules, measured together in one aggregation, and the gate that acts on them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import parse_instant, unix_hours_between

# Rule types and the threshold each one reads.
THRESHOLD_OF = {"null_rate": "max_rate", "uniqueness": None, "freshness": "max_age_hours"}


class DataQualityError(Exception):
    """A gate failed; the message lists every failed rule or check."""


@dataclass(frozen=True)
class Rule:
    type: str
    column: str
    threshold: float | None = None

    @classmethod
    def of(cls, spec: Rule | Mapping[str, object]) -> Rule:
        """From a ``Rule`` or a dict such as ``{"type": "null_rate", "column": "c", "max_rate": 0.05}``."""
        if isinstance(spec, Rule):
            rule = spec
        else:
            kind = str(spec.get("type"))
            limit = spec.get(THRESHOLD_OF.get(kind) or "")
            rule = cls(kind, str(spec["column"]), None if limit is None else float(limit))
        if rule.type not in THRESHOLD_OF:
            raise ValueError(f"unknown rule type {rule.type!r}; known: {sorted(THRESHOLD_OF)}")
        if THRESHOLD_OF[rule.type] and rule.threshold is None:
            raise ValueError(f"{rule.type} needs {THRESHOLD_OF[rule.type]}")
        return rule


def _as_instant(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, T.StringType):
        return parse_instant(name)
    return F.col(name).cast("timestamp")


def _now(now: Column | dt.datetime | str | None) -> Column:
    if now is None:
        return F.current_timestamp()
    if isinstance(now, Column):
        return now
    if isinstance(now, dt.datetime):
        now = (now if now.tzinfo else now.replace(tzinfo=dt.timezone.utc)).isoformat()
    return F.to_timestamp(F.lit(now))


def dq_report(df: DataFrame, rules: Sequence[Rule | Mapping], now: Column | dt.datetime | str | None = None) -> DataFrame:
    """One row per rule: (rule_no, rule, column, threshold, actual_value, passed).

    Null rates, freshness and the row count share one aggregation over ``df``; each column that must be unique is
    made distinct on its own, so no row is multiplied by the rules. Uniqueness counts NULL as one value. Freshness is
    hours from the newest instant to ``now`` (default: the clock); without any instant its value is
    NULL and it fails. An empty frame has null rate 0.
    """
    parsed = [Rule.of(r) for r in rules]
    if not parsed:
        raise ValueError("no rules given")
    total = F.count(F.lit(1)).cast("double")
    measures: list[Column] = [total.alias("_rows")]
    distinct: dict[str, DataFrame] = {}
    for i, rule in enumerate(parsed):
        c = F.col(rule.column)
        if rule.type == "null_rate":
            measure = F.coalesce(F.count_if(c.isNull()) / F.nullif(total, F.lit(0.0)), F.lit(0.0))
        elif rule.type == "uniqueness":
            distinct[f"_m{i}"] = df.select(c).distinct().agg(F.count(F.lit(1)).cast("double"))
            continue
        else:
            measure = unix_hours_between(F.max(_as_instant(df, rule.column)), _now(now))
        measures.append(measure.alias(f"_m{i}"))
    lines = []
    for i, rule in enumerate(parsed):
        value = F.col(f"_m{i}")
        limit = F.col("_rows") if rule.type == "uniqueness" else F.lit(rule.threshold)
        ok = value == limit if rule.type == "uniqueness" else value <= limit
        lines.append(
            F.struct(
                F.lit(i).alias("rule_no"),
                F.lit(rule.type).alias("rule"),
                F.lit(rule.column).alias("column"),
                F.lit(rule.threshold).cast("double").alias("threshold"),
                value.alias("actual_value"),
                F.coalesce(ok, F.lit(False)).alias("passed"),
            )
        )
    measured = df.agg(*measures)
    for name, count in distinct.items():
        # One row each: the counts stand side by side.
        measured = measured.join(F.broadcast(count.toDF(name)))
    return measured.select(F.inline(F.array(*lines)))


def run_dq_checks(
    df: DataFrame, rules: Sequence[Mapping], now: Column | dt.datetime | str | None = None
) -> list[dict[str, object]]:
    """The report as a list of ``{"rule", "actual_value", "passed"}``, in the order of ``rules``.

    Runs one job and brings back one row per rule.
    """
    rows = dq_report(df, rules, now).orderBy("rule_no").collect() if rules else []
    return [{"rule": rules[r.rule_no], "actual_value": r.actual_value, "passed": r.passed} for r in rows]


def enforce(report: DataFrame) -> None:
    """Raise ``DataQualityError`` if any row of a rule or check report did not pass."""
    failed = report.where(~F.col("passed")).toJSON().collect()
    if failed:
        raise DataQualityError("; ".join(failed))
