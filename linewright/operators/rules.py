"""Declarative quality rules and the lossless dead-letter split."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    tag: str
    name: str
    constraint: str


# Rule names and limits.
RULES = [
    Rule("inspections", "unit_id_not_null", "unit_id IS NOT NULL"),
    Rule("inspections", "temperature_valid", "temperature_celsius BETWEEN 150 AND 300"),
    Rule("inspections", "pressure_valid", "pressure_bar BETWEEN 0.5 AND 10.0"),
    Rule("inspections", "vibration_valid", "vibration_mm_s BETWEEN 0.0 AND 15.0"),
    Rule("inspections", "voltage_valid", "voltage_v BETWEEN 2.5 AND 4.5"),
    Rule("inspections", "humidity_valid", "humidity_pct BETWEEN 20.0 AND 80.0"),
    Rule("inspections", "solder_thickness_valid", "solder_thickness_um BETWEEN 50 AND 250"),
    Rule("inspections", "alignment_error_valid", "alignment_error_um BETWEEN 0 AND 100"),
    Rule("inspections", "machine_id_not_null", "machine_id IS NOT NULL"),
    Rule("inspections", "line_id_valid", "line_id IN ('LINE_A', 'LINE_B', 'LINE_C', 'LINE_D')"),
    Rule("inspections", "shift_valid", "shift IN ('morning', 'afternoon', 'night')"),
    Rule("inspections", "tool_wear_valid", "tool_wear_pct BETWEEN 0 AND 100"),
    Rule("inspections", "production_speed_valid", "production_speed_pct BETWEEN 50 AND 130"),
    Rule("inspections", "timestamp_not_null", "timestamp IS NOT NULL"),
    Rule("labels", "unit_id_not_null", "unit_id IS NOT NULL"),
    Rule("labels", "is_defective_valid", "is_defective IN (0, 1)"),
    Rule("labels", "label_available_date_not_null", "label_available_date IS NOT NULL"),
]


def rules_for(tag: str, rules: Iterable[Rule] = RULES) -> list[Rule]:
    """Rules of one tag. A name may recur under another tag without replacing this one."""
    return [rule for rule in rules if rule.tag == tag]


def quarantine_flag(rules: Iterable[Rule]) -> Column:
    """True unless every rule holds. A rule that cannot be decided (NULL input) does not hold."""
    holds = [F.expr(rule.constraint) for rule in rules]
    return ~F.coalesce(reduce(lambda a, b: a & b, holds, F.lit(True)), F.lit(False))


def flag_quarantine(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    return df.withColumn("is_quarantined", quarantine_flag(rules))


def split_quarantine(df: DataFrame, rules: Iterable[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid, dead letters): every input row is in exactly one of them."""
    flagged = flag_quarantine(df, list(rules))
    valid = flagged.filter(~F.col("is_quarantined")).drop("is_quarantined")
    dead = flagged.filter("is_quarantined").drop("is_quarantined")
    return valid, dead.withColumn("quarantine_timestamp", F.current_timestamp())


def rule_violations(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Violations and undecided rows per rule, counted in one pass."""
    rules = list(rules)
    counts = []
    for i, rule in enumerate(rules):
        holds = F.expr(rule.constraint)
        counts += [F.count_if(~holds).alias(f"v{i}"), F.count_if(holds.isNull()).alias(f"u{i}")]
    rows = [
        F.struct(
            F.lit(rule.name).alias("rule"),
            F.col(f"v{i}").alias("violations"),
            F.col(f"u{i}").alias("unknowns"),
        )
        for i, rule in enumerate(rules)
    ]
    return df.agg(*counts).select(F.inline(F.array(*rows)))
