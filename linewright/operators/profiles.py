"""Catalogue profiles with historical defect rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import defect_rate_all, defect_rate_labelled


def defect_history(facts: DataFrame, key: str, label: str) -> DataFrame:
    """Rows, defects and both defect rates per key, combined before the shuffle."""
    return facts.groupBy(key).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(label) == 1).alias("defective_rows"),
        defect_rate_all(label).alias("defect_rate_all_pct"),
        defect_rate_labelled(label).alias("defect_rate_labelled_pct"),
    )


def profile(catalog: DataFrame, facts: DataFrame, key: str, label: str) -> DataFrame:
    """Every catalogue row, with its history where it has one."""
    return catalog.join(defect_history(facts, key, label), key, "left")


def machine_profile(
    machines: DataFrame, lines: DataFrame, maintenance: DataFrame, facts: DataFrame, as_of: str
) -> DataFrame:
    """Machine type, age and days since maintenance on the day ``as_of``, clean-room class and
    defect history. Maintenance after that day is not counted."""
    day = F.lit(as_of).cast("date")
    last = (
        maintenance.filter(F.col("maintenance_date").cast("date") <= day)
        .groupBy("machine_id")
        .agg(F.max(F.col("maintenance_date").cast("date")).alias("_last"))
    )
    static = (
        machines.join(last, "machine_id", "left")
        .join(lines.select("line_id", "clean_room_class"), "line_id", "left")
        .select(
            "machine_id",
            "machine_type",
            "clean_room_class",
            "vibration_baseline_mm_s",
            F.date_diff(day, "installation_date").alias("machine_age_days"),
            F.date_diff(day, "_last").alias("last_maintenance_days"),
        )
    )
    history = profile(static, facts, "machine_id", "is_defective")
    return history.withColumnsRenamed(
        {
            "total_rows": "historical_total_inspections",
            "defect_rate_all_pct": "machine_defect_rate_all_pct",
            "defect_rate_labelled_pct": "machine_defect_rate_labelled_pct",
        }
    ).drop("defective_rows")


def supplier_profile(suppliers: DataFrame, facts: DataFrame, as_of: str, new_within_days: int = 365) -> DataFrame:
    """Expected quality and solder thickness, whether the supplier started within the last
    year, and defect history."""
    static = suppliers.select(
        "supplier_id",
        "expected_quality",
        "solder_thickness_mean_um",
        (F.date_diff(F.lit(as_of).cast("date"), "start_date") < new_within_days).alias("is_new_supplier"),
    )
    history = profile(static, facts, "supplier_id", "is_defective")
    return history.withColumnsRenamed(
        {
            "defect_rate_all_pct": "supplier_defect_rate_all_pct",
            "defect_rate_labelled_pct": "supplier_defect_rate_labelled_pct",
        }
    ).drop("total_rows", "defective_rows")


def spine(labelled: DataFrame, extra: list[str]) -> DataFrame:
    """Unit, time, label, the lookup keys, and the measurements of the unit itself."""
    return labelled.select("unit_id", "timestamp", "is_defective", "machine_id", "supplier_id", *extra)
