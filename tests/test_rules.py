import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Row

from linewright.operators.rules import RULES, Rule, rule_violations, rules_for, split_quarantine
from linewright.schemas import event_schema

GOOD = dict(
    unit_id="u",
    timestamp="2024-01-01 00:00:00",
    machine_id="m",
    line_id="LINE_A",
    shift="morning",
    supplier_id="s",
    material_batch_id="b",
    temperature_celsius=200.0,
    pressure_bar=5.0,
    vibration_mm_s=1.0,
    voltage_v=3.0,
    current_ma=1.0,
    humidity_pct=50.0,
    particle_count_m3=1,
    solder_thickness_um=100.0,
    alignment_error_um=5.0,
    optical_density=1.0,
    tool_wear_pct=10.0,
    time_since_maintenance_h=1.0,
    production_speed_pct=100.0,
    operator_experience_yrs=1.0,
    cycle_time_s=1.0,
)

BREAKS = {
    "unit_id_not_null": ("unit_id", None),
    "temperature_valid": ("temperature_celsius", 149.9),
    "pressure_valid": ("pressure_bar", 10.1),
    "vibration_valid": ("vibration_mm_s", -0.1),
    "voltage_valid": ("voltage_v", 4.6),
    "humidity_valid": ("humidity_pct", 19.9),
    "solder_thickness_valid": ("solder_thickness_um", 251.0),
    "alignment_error_valid": ("alignment_error_um", 100.1),
    "machine_id_not_null": ("machine_id", None),
    "line_id_valid": ("line_id", "LINE_E"),
    "shift_valid": ("shift", "noon"),
    "tool_wear_valid": ("tool_wear_pct", 101.0),
    "production_speed_valid": ("production_speed_pct", 49.0),
    "timestamp_not_null": ("timestamp", None),
}


def frame(spark, rows):
    return spark.createDataFrame([Row(**r) for r in rows], event_schema("inspections", rescue=False))


def test_same_name_under_two_tags_keeps_both_rules():
    assert len(rules_for("inspections")) == 14 and len(rules_for("labels")) == 3
    assert {r.name for r in rules_for("inspections")} == set(BREAKS)
    assert len(RULES) == 17


def test_each_rule_alone_sends_its_row_to_quarantine(spark):
    rows = [GOOD] + [{**GOOD, column: value} for column, value in BREAKS.values()]
    valid, dead = split_quarantine(frame(spark, rows), rules_for("inspections"))
    assert valid.count() == 1 and dead.count() == len(BREAKS)
    assert "quarantine_timestamp" in dead.columns and "is_quarantined" not in valid.columns


def test_null_sensor_and_double_fault_are_not_lost(spark):
    rows = [{**GOOD, "voltage_v": None}, {**GOOD, "voltage_v": None, "shift": "x"}, GOOD]
    valid, dead = split_quarantine(frame(spark, rows), rules_for("inspections"))
    assert (valid.count(), dead.count()) == (1, 2)


def test_limits_are_closed(spark):
    rows = [{**GOOD, "temperature_celsius": t} for t in (150.0, 300.0)]
    valid, _ = split_quarantine(frame(spark, rows), rules_for("inspections"))
    assert valid.count() == 2


def test_violations_and_unknowns(spark):
    rows = [GOOD, {**GOOD, "voltage_v": None}, {**GOOD, "voltage_v": 9.0}]
    found = {r["rule"]: (r["violations"], r["unknowns"]) for r in rule_violations(
        frame(spark, rows), rules_for("inspections")).collect()}
    assert found["voltage_valid"] == (1, 1)
    assert found["unit_id_not_null"] == (0, 0)


@pytest.mark.parametrize("value,quarantined", [(0, False), (1, False), (2, True), (None, True)])
def test_label_rules(spark, value, quarantined):
    df = spark.createDataFrame(
        [("u", value, "2024-01-01")], "unit_id string, is_defective int, label_available_date string"
    )
    _, dead = split_quarantine(df, rules_for("labels"))
    assert (dead.count() == 1) == quarantined


def test_no_rules_means_valid(spark):
    valid, dead = split_quarantine(spark.range(3), [])
    assert valid.count() == 3 and dead.count() == 0
    assert Rule("t", "n", "true").tag == "t"


VALUES = {
    "voltage_v": st.one_of(st.none(), st.floats(0, 10), st.just(float("nan"))),
    "shift": st.one_of(st.none(), st.sampled_from(["morning", "noon"])),
    "unit_id": st.one_of(st.none(), st.just("u")),
}


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.fixed_dictionaries(VALUES), min_size=1, max_size=20))
def test_every_row_is_in_exactly_one_table(spark, changes):
    rows = [{**GOOD, **c} for c in changes]
    valid, dead = split_quarantine(frame(spark, rows), rules_for("inspections"))
    good = sum(
        c["unit_id"] is not None
        and c["shift"] == "morning"
        and c["voltage_v"] is not None
        and 2.5 <= c["voltage_v"] <= 4.5
        for c in changes
    )
    assert (valid.count(), dead.count()) == (good, len(rows) - good)
