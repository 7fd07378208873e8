"""The plant's tables from landing files to training set, in bounded and in streaming form.

Landing layout: ``<landing>/<catalogue>/*.csv`` and, for inspections and labels,
``<landing>/<name>/history/...`` and ``<landing>/<name>/production/...`` with JSON lines.

Warehouse layout: ``<warehouse>/<version>/<layer>/<table>`` and the file ``<warehouse>/CURRENT`` with the version that readers see.
A rebuild writes a version of its own; streams keep one version and its checkpoints for good. Either makes its version the
current one when all its tables are written, so both may run on one warehouse, in any order, and each sees its own files only.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import parse_timestamp
from ..operators.joins import FeatureLookup, inspection_labels, training_set
from ..operators.profiles import machine_profile, spine, supplier_profile
from ..operators.rules import flag_quarantine, rules_for
from ..operators.windows import window_family
from ..schemas import CATALOGS, INSPECTION_KEYS, LABEL_COLUMNS, SENSORS
from ..session import materialize
from ..sources import (
    append_flows,
    overwrite,
    read_catalog,
    read_events,
    stream_events,
    stream_table,
    with_month_partitions,
)
from ..sources.pointer import children, point, pointed, remove
from ..streaming import labelled_stream, quarantine_stream, run_to_end, windowed_stream

# Window widths of the feature tables.
WINDOW_SIZES = {"1h": "1 hour", "24h": "24 hours", "7d": "7 days", "30d": "30 days"}
EVENT_TIMES = {"inspections": "timestamp", "labels": "label_available_date"}
FLOWS = ("history", "production")

# Windows of labelled rows: a row leaves the label join up to 30 days of range and 30 days of
# watermark after its event, so a shorter delay would discard it as late.
LABELLED_DELAY = "60 days"


def _is_dead() -> Column:
    """Of a partition column, so either side of the split reads its own files only."""
    return F.col("is_quarantined").cast("boolean")


@dataclass(frozen=True)
class TableInfo:
    layer: str
    comment: str
    partition_by: tuple[str, ...] = ()


TABLES = {
    **{f"bronze_{name}": TableInfo("bronze", f"Catalogue of {name}, re-read on every run") for name in CATALOGS},
    "bronze_inspections": TableInfo("bronze", "Inspection records as they arrived", ("year", "month")),
    "bronze_labels": TableInfo("bronze", "Label records as they arrived", ("year", "month")),
    "silver_inspections": TableInfo("silver", "Inspections, valid and quarantined", ("is_quarantined",)),
    "silver_labels": TableInfo("silver", "Labels, valid and quarantined", ("is_quarantined",)),
    "silver_inspections_labeled": TableInfo("silver", "Valid inspections beside their labels", ("year", "month")),
    "gold_inspection_spine": TableInfo("gold", "Unit, time, label, lookup keys and measurements", ("year", "month")),
    **{
        f"gold_machine_agg_{tag}": TableInfo("gold", f"Sensor means and defect rate per machine and {size}")
        for tag, size in WINDOW_SIZES.items()
    },
    "gold_machine_profile": TableInfo("gold", "Machine data with defect history"),
    "gold_supplier_profile": TableInfo("gold", "Supplier data with defect history"),
    "gold_inspection_training_dataset": TableInfo("gold", "Spine with features known at inspection time", ("year", "month")),
}


#: The version that streams append to.
STREAM = "stream"


class Plant:
    """Paths and readers of one warehouse folder."""

    def __init__(self, spark: SparkSession, landing: str, warehouse: str) -> None:
        self.spark, self.landing, self.warehouse = spark, landing.rstrip("/"), warehouse.rstrip("/")
        self._written: str | None = None
        self._schemas: dict[str, StructType] = {}

    @property
    def version(self) -> str:
        """The version that is being written, else the current one."""
        found = self._written or pointed(self.spark, f"{self.warehouse}/CURRENT")
        if found is None:
            raise FileNotFoundError(f"nothing has been written to {self.warehouse} yet")
        return found

    @contextmanager
    def writing(self, version: str) -> Iterator[None]:
        """All paths are those of a version, which becomes the current one if nothing fails."""
        self._written = version
        try:
            yield
            point(self.spark, f"{self.warehouse}/CURRENT", version)
        finally:
            self._written = None

    def sweep(self, keep: int = 2) -> None:
        """Delete rebuilt versions but the newest ones and the current one; a reader of the one before may still be at work."""
        rebuilt = sorted(v for v in children(self.spark, self.warehouse) if v.startswith("batch-"))
        for version in rebuilt[:-keep]:
            if version != self.version:
                remove(self.spark, f"{self.warehouse}/{version}")

    def path(self, table: str) -> str:
        return f"{self.warehouse}/{self.version}/{TABLES[table].layer}/{table}"

    def checkpoint(self, table: str) -> str:
        return f"{self.warehouse}/{self.version}/_checkpoints/{table}"

    def read(self, table: str) -> DataFrame:
        try:
            return self.spark.read.parquet(self.path(table))
        except AnalysisException:  # a stream that has not closed a window yet has no files
            if self._written is None or table not in self._schemas:
                raise
            return self.spark.createDataFrame([], self._schemas[table])

    def write(self, table: str, df: DataFrame, gather: bool = False) -> None:
        overwrite(df, self.path(table), list(TABLES[table].partition_by), gather)

    def append_stream(self, table: str, df: DataFrame) -> None:
        self._schemas[table] = df.schema
        run_to_end(df, self.path(table), self.checkpoint(table), list(TABLES[table].partition_by))

    def valid(self, name: str) -> DataFrame:
        return self.read(f"silver_{name}").filter(~_is_dead())

    def quarantined(self, name: str) -> DataFrame:
        return self.read(f"silver_{name}").filter(_is_dead())

    def register(self, database: str) -> None:
        """Catalogue entries with comment and layer for the tables of the current version; to be called again after a run."""
        for name, info in TABLES.items():
            try:
                self.spark.read.parquet(self.path(name)).schema
            except AnalysisException:
                continue
            full = f"{database}.{name}"
            self.spark.sql(f"DROP TABLE IF EXISTS {full}")  # an external table: its files stay
            self.spark.sql(f"CREATE TABLE {full} USING parquet LOCATION '{self.path(name)}'")
            if info.partition_by:
                self.spark.sql(f"MSCK REPAIR TABLE {full}")
            comment = info.comment.replace("'", "\\'")
            self.spark.sql(f"COMMENT ON TABLE {full} IS '{comment}'")
            self.spark.sql(f"ALTER TABLE {full} SET TBLPROPERTIES ('quality' = '{info.layer}')")


def write_catalogs(plant: Plant) -> None:
    for name in CATALOGS:
        plant.write(f"bronze_{name}", read_catalog(plant.spark, name, f"{plant.landing}/{name}"))


def _by_arrival_month(df: DataFrame, name: str) -> DataFrame:
    return with_month_partitions(df.withColumn("_at", parse_timestamp(EVENT_TIMES[name])), "_at").drop("_at")


def _labelled_columns() -> list[str]:
    return [*INSPECTION_KEYS, *SENSORS]


def write_gold(plant: Plant, as_of: str, digits: int | None = None) -> None:
    """Window tables and profiles from the labelled inspections. The window tables are rolled
    up from one pass; their rates count only labels known when the window closed. ``digits``
    makes means exact whole-number totals, which must fit 64 bits per window."""
    facts = plant.read("silver_inspections_labeled")
    family = window_family(
        facts,
        ["machine_id"],
        "timestamp",
        list(WINDOW_SIZES.values()),
        SENSORS,
        "is_defective",
        label_known="label_available_date",
        digits=digits,
        keep=materialize,
    )
    for tag, size in WINDOW_SIZES.items():
        plant.write(f"gold_machine_agg_{tag}", family[size])
    write_profiles(plant, as_of)


def write_profiles(plant: Plant, as_of: str) -> None:
    facts = plant.read("silver_inspections_labeled")
    machines, lines = plant.read("bronze_machines"), plant.read("bronze_lines")
    plant.write(
        "gold_machine_profile", machine_profile(machines, lines, plant.read("bronze_maintenance"), facts, as_of)
    )
    plant.write("gold_supplier_profile", supplier_profile(plant.read("bronze_suppliers"), facts, as_of))


def write_training_dataset(plant: Plant) -> None:
    """Spine plus profiles (as of their day) plus the newest closed window of each width."""
    lookups = [
        FeatureLookup(plant.read("gold_machine_profile"), ("machine_id",)),
        FeatureLookup(plant.read("gold_supplier_profile"), ("supplier_id",)),
    ] + [
        FeatureLookup(plant.read(f"gold_machine_agg_{tag}"), ("machine_id",), f"w{tag}_", window=size)
        for tag, size in WINDOW_SIZES.items()
    ]
    rows = plant.read("gold_inspection_spine").drop("year", "month")
    found = training_set(rows, lookups, "timestamp", "is_defective", exclude=("unit_id",))
    plant.write("gold_inspection_training_dataset", with_month_partitions(found, "timestamp"), gather=True)


def run_batch(plant: Plant, as_of: str, only_first_label: bool = False, digits: int | None = None) -> None:
    """Rebuild every table from the landing files, as a version of its own."""
    now = datetime.now(timezone.utc)
    with plant.writing(f"batch-{now:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"):
        _rebuild(plant, as_of, only_first_label, digits)
    plant.sweep()


def _rebuild(plant: Plant, as_of: str, only_first_label: bool, digits: int | None) -> None:
    spark = plant.spark
    write_catalogs(plant)
    for name, time in EVENT_TIMES.items():
        flows = [read_events(spark, name, f"{plant.landing}/{name}/{flow}") for flow in FLOWS]
        plant.write(f"bronze_{name}", _by_arrival_month(append_flows(*flows), name))
        parsed = plant.read(f"bronze_{name}").drop("year", "month").withColumn(time, parse_timestamp(time))
        flagged = flag_quarantine(parsed, rules_for(name))
        stamped = F.when(F.col("is_quarantined"), F.current_timestamp())
        plant.write(f"silver_{name}", flagged.withColumn("quarantine_timestamp", stamped))
    joined = inspection_labels(
        plant.valid("inspections").select(*_labelled_columns()),
        plant.valid("labels").select(*LABEL_COLUMNS),
        only_first_label,
    )
    plant.write("silver_inspections_labeled", with_month_partitions(joined, "timestamp"), gather=True)
    plant.write("gold_inspection_spine", _spine(plant.read("silver_inspections_labeled")))
    write_gold(plant, as_of, digits)
    write_training_dataset(plant)


def _spine(labelled: DataFrame) -> DataFrame:
    return with_month_partitions(spine(labelled, ["line_id", "shift", *SENSORS]), "timestamp")


def run_streams(plant: Plant, as_of: str, digits: int | None = None) -> None:
    """One triggered run: every stream takes what is new since its checkpoint, and profiles and the training set are
    recomputed. Open windows and inspections that may still get a label wait in state."""
    with plant.writing(STREAM):
        _advance(plant, as_of, digits)


def _advance(plant: Plant, as_of: str, digits: int | None) -> None:
    spark = plant.spark
    write_catalogs(plant)
    for name, time in EVENT_TIMES.items():
        flows = [stream_events(spark, name, f"{plant.landing}/{name}/{flow}") for flow in FLOWS]
        plant.append_stream(f"bronze_{name}", _by_arrival_month(append_flows(*flows), name))
        arrived = stream_table(spark, plant.path(f"bronze_{name}")).drop("year", "month")
        plant.append_stream(f"silver_{name}", quarantine_stream(arrived, name, time))

    def valid(name: str, columns: list[str]) -> DataFrame:
        return stream_table(spark, plant.path(f"silver_{name}")).filter(~_is_dead()).select(*columns)

    joined = labelled_stream(valid("inspections", _labelled_columns()), valid("labels", LABEL_COLUMNS))
    plant.append_stream("silver_inspections_labeled", with_month_partitions(joined, "timestamp"))
    labelled = stream_table(spark, plant.path("silver_inspections_labeled"))
    plant.append_stream("gold_inspection_spine", _spine(labelled))
    for tag, size in WINDOW_SIZES.items():
        windows = windowed_stream(
            labelled,
            ["machine_id"],
            "timestamp",
            size,
            SENSORS,
            "is_defective",
            "label_available_date",
            delay=LABELLED_DELAY,
            digits=digits,
        )
        plant.append_stream(f"gold_machine_agg_{tag}", windows)
    write_profiles(plant, as_of)
    write_training_dataset(plant)


__all__ = ["Plant", "TABLES", "WINDOW_SIZES", "run_batch", "run_streams", "write_training_dataset"]
