"""Explicit schemas of every source table."""

from __future__ import annotations

from pyspark.sql.types import StructType

RESCUED = "_rescued_data"

# Documented column names and types of the source tables.
CATALOGS = {
    "machines": "machine_id string, machine_type string, line_id string, installation_date date, "
    "vibration_baseline_mm_s double",
    "lines": "line_id string, daily_capacity int, clean_room_class string",
    "suppliers": "supplier_id string, start_date date, expected_quality double, solder_thickness_mean_um double",
    "operators": "operator_id string, experience_level string, shift string",
    "maintenance": "maintenance_id string, machine_id string, maintenance_date timestamp, maintenance_type string",
}

# The fifteen sensor and process columns.
SENSORS = [
    "temperature_celsius",
    "pressure_bar",
    "vibration_mm_s",
    "voltage_v",
    "current_ma",
    "humidity_pct",
    "particle_count_m3",
    "solder_thickness_um",
    "alignment_error_um",
    "optical_density",
    "tool_wear_pct",
    "time_since_maintenance_h",
    "production_speed_pct",
    "operator_experience_yrs",
    "cycle_time_s",
]

# Column names and types of the records.
INSPECTION_KEYS = ["unit_id", "timestamp", "machine_id", "line_id", "shift", "supplier_id", "material_batch_id"]
LABEL_COLUMNS = ["unit_id", "is_defective", "label_available_date"]


def _ddl(columns: list[str], types: dict[str, str], default: str) -> str:
    return ", ".join(f"`{name}` {types.get(name, default)}" for name in columns)


EVENTS = {
    "inspections": _ddl(INSPECTION_KEYS, {}, "string")
    + ", "
    + _ddl(SENSORS, {"particle_count_m3": "bigint"}, "double"),
    "labels": "unit_id string, is_defective int, label_available_date string",
}


def catalog_schema(name: str) -> StructType:
    return StructType.fromDDL(CATALOGS[name])


def event_schema(name: str, rescue: bool = True) -> StructType:
    """Event columns; with ``rescue`` also the column that keeps records that do not fit."""
    schema = StructType.fromDDL(EVENTS[name])
    return schema.add(RESCUED, "string") if rescue else schema
