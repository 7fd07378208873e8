"""Landing files to training set, bounded and streaming."""

from datetime import timedelta

import pytest
from plant_files import T0, inspection, label, write_flush, write_landing, write_lines

from linewright.plans.medallion import TABLES, WINDOW_SIZES, Plant, run_batch, run_streams
from linewright.sources import stream_to_table
from linewright.streaming import run_to_end, windowed_stream


@pytest.fixture(scope="module")
def batch(spark, tmp_path_factory):
    home = tmp_path_factory.mktemp("batch")
    write_landing(str(home / "landing"))
    plant = Plant(spark, str(home / "landing"), str(home / "warehouse"))
    run_batch(plant, as_of="2024-01-10")
    return plant


@pytest.fixture(scope="module")
def streamed(spark, tmp_path_factory):
    home = tmp_path_factory.mktemp("stream")
    write_landing(str(home / "landing"))
    write_flush(str(home / "landing"))
    plant = Plant(spark, str(home / "landing"), str(home / "warehouse"))
    run_streams(plant, as_of="2024-01-10")
    return plant


def test_every_table_is_written(batch):
    assert len(TABLES) == 18
    for name in TABLES:
        assert batch.read(name).count() > 0, name


def test_quarantine_loses_nothing(batch):
    assert batch.read("bronze_inspections").count() == 77
    assert batch.valid("inspections").count() == 72
    dead = {r.unit_id for r in batch.quarantined("inspections").collect()}
    assert dead == {"b1", "b2", "b3", "b4", None}
    assert batch.quarantined("labels").count() == 1
    assert batch.quarantined("inspections").filter("quarantine_timestamp IS NULL").count() == 0


def test_valid_rows_read_their_own_files_only(batch):
    plan = batch.valid("inspections")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(is_quarantined" in plan or "PartitionFilters: [NOT cast(is_quarantined" in plan


def test_labels_join(batch):
    joined = batch.read("silver_inspections_labeled")
    assert joined.count() == 73  # one unit has two labels
    assert joined.filter("is_defective IS NULL").count() == 24


def test_window_rates_hold_only_known_labels(batch):
    joined = [r for r in batch.read("silver_inspections_labeled").collect()]
    for tag, hours in (("1h", 1), ("24h", 24)):
        for row in batch.read(f"gold_machine_agg_{tag}").collect():
            mine = [
                j
                for j in joined
                if j.machine_id == row.machine_id and row.window_start <= j.timestamp < row.window_end
            ]
            known = [
                j.is_defective
                for j in mine
                if j.is_defective is not None and j.label_available_date <= row.window_end
            ]
            rate = 100 * sum(known) / len(known) if known else None
            assert row.defect_rate_labelled_pct == (pytest.approx(rate) if known else None)
            assert row.inspection_count == len(mine)
            assert row.avg_voltage_v == pytest.approx(sum(j.voltage_v for j in mine) / len(mine))


def test_profiles(batch):
    machines = {r.machine_id: r for r in batch.read("gold_machine_profile").collect()}
    assert machines["m1"].last_maintenance_days == 8 and machines["m2"].last_maintenance_days is None
    assert machines["m2"].machine_age_days == 9 and machines["m1"].clean_room_class == "ISO5"
    suppliers = {r.supplier_id: r.is_new_supplier for r in batch.read("gold_supplier_profile").collect()}
    assert suppliers == {"s1": False, "s2": True}


def test_training_rows_see_only_closed_windows(batch):
    train = batch.read("gold_inspection_training_dataset")
    assert train.columns[-2:] == ["year", "month"]  # folders
    train = train.drop("year", "month")
    assert train.count() == 73 and "unit_id" not in train.columns and train.columns[-1] == "is_defective"
    hourly = {(r.machine_id, r.window_end): r.avg_voltage_v for r in batch.read("gold_machine_agg_1h").collect()}
    for row in train.collect():
        closed = [(end, v) for (m, end), v in hourly.items() if m == row.machine_id and end <= row.timestamp]
        assert row.w1h_avg_voltage_v == (max(closed)[1] if closed else None)
    assert "temperature_celsius" in train.columns


def test_register(batch, spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS plant")
    batch.register("plant")
    assert spark.table("plant.silver_inspections").count() == 77
    tables = [r.tableName for r in spark.sql("SHOW TABLES IN plant").collect()]
    assert set(tables) == set(TABLES)
    spark.sql("DROP DATABASE plant CASCADE")


def plain(df, *columns, skip="flush"):
    rows = [tuple(r) for r in df.select(*columns).collect()]
    return sorted((r for r in rows if skip not in r), key=str)


def test_stream_equals_batch_after_a_flush(batch, streamed):
    columns = ["unit_id", "timestamp", "machine_id", "is_defective", "label_available_date"]
    table = "silver_inspections_labeled"
    assert plain(streamed.read(table), *columns) == plain(batch.read(table), *columns)
    for name in ("inspections", "labels"):
        assert plain(streamed.quarantined(name), "unit_id") == plain(batch.quarantined(name), "unit_id")
    keys = ["machine_id", "window_start", "inspection_count", "defect_rate_labelled_pct"]
    for tag in WINDOW_SIZES:
        table = f"gold_machine_agg_{tag}"
        assert plain(streamed.read(table), *keys) == plain(batch.read(table), *keys)
    assert streamed.read("gold_inspection_training_dataset").filter("machine_id <> 'flush'").count() == 73


def test_second_run_takes_new_files_only(streamed, spark):
    before = streamed.read("bronze_inspections").count()
    when = T0 + timedelta(days=401)
    write_lines(f"{streamed.landing}/inspections/production/2025/02/new.json", [inspection("n1", when)])
    write_lines(f"{streamed.landing}/labels/production/2025/02/new.json", [label("n1", 1, when)])
    run_streams(streamed, as_of="2025-02-10")
    spark.catalog.clearCache()
    assert streamed.read("bronze_inspections").count() == before + 1
    units = [r.unit_id for r in streamed.read("silver_inspections_labeled").collect()]
    assert units.count("n1") == 1 and len(units) == 75


def test_rebuilds_and_streams_share_a_warehouse(spark, tmp_path):
    """Batch, stream, batch, stream: after each run all rows that have landed are there once, and nothing of the other's."""
    landing = str(tmp_path / "landing")
    write_landing(landing)
    write_flush(landing)
    plant = Plant(spark, landing, str(tmp_path / "warehouse"))
    with pytest.raises(FileNotFoundError):
        plant.read("bronze_labels")

    def seen():
        units = [r.unit_id for r in plant.read("silver_inspections_labeled").collect()]
        return plant.read("bronze_inspections").count(), len(units), len(set(units)), plant.read("gold_inspection_training_dataset").count()

    run_batch(plant, as_of="2024-01-10")
    first = plant.version
    assert seen() == (78, 74, 73, 74)
    run_streams(plant, as_of="2024-01-10")
    assert plant.version == "stream" and seen() == (78, 74, 73, 74)
    when = T0 + timedelta(days=401)
    write_lines(f"{landing}/inspections/production/2025/02/new.json", [inspection("n1", when)])
    write_lines(f"{landing}/labels/production/2025/02/new.json", [label("n1", 1, when)])
    run_batch(plant, as_of="2025-02-10")
    assert plant.version not in (first, "stream") and seen() == (79, 75, 74, 75)
    run_streams(plant, as_of="2025-02-10")
    assert seen() == (79, 75, 74, 75)
    # a rebuild that fails leaves readers where they were
    write_lines(f"{landing}/machines/machines.csv", ["machine_id\n"])
    with pytest.raises(Exception):  # noqa: B017
        run_batch(plant, as_of="2025-02-10")
    assert plant.version == "stream" and seen() == (79, 75, 74, 75)


def test_rows_behind_the_watermark_are_left_out(spark, tmp_path):
    schema = "machine_id string, timestamp timestamp, v double"
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        run_to_end(windowed_stream(stream, ["machine_id"], "timestamp", "1 hour", ["v"]), sink, checkpoint)

    arrive([("m", T0, 1.0), ("m", T0 + timedelta(hours=10), 1.0)])
    arrive([("m", T0 + timedelta(minutes=5), 100.0), ("m", T0 + timedelta(hours=9), 5.0)])  # late; in time
    arrive([("m", T0 + timedelta(hours=30), 1.0)])
    got = {r.window_start: (r.avg_v, r.inspection_count) for r in spark.read.parquet(sink).collect()}
    assert got == {
        T0: (1.0, 1),
        T0 + timedelta(hours=9): (5.0, 1),
        T0 + timedelta(hours=10): (1.0, 1),
    }


def test_sliding_stream(spark, tmp_path):
    schema = "machine_id string, timestamp timestamp, v double"
    source = str(tmp_path / "in")
    rows = [("m", T0 + timedelta(hours=h), float(h)) for h in (0, 1, 2, 50)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(schema).parquet(source)
    windows = windowed_stream(stream, ["machine_id"], "timestamp", "2 hours", ["v"], slide="1 hour")
    run_to_end(windows, str(tmp_path / "out"), str(tmp_path / "cp"))
    got = {r.window_start: r.avg_v for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {T0 + timedelta(hours=h): v for h, v in ((-1, 0.0), (0, 0.5), (1, 1.5), (2, 2.0))}


def test_continuous_trigger_is_the_same_code(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([("m", T0, 1.0)], "machine_id string, timestamp timestamp, v double").write.parquet(source)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    query = stream_to_table(stream, str(tmp_path / "out"), str(tmp_path / "cp"), every="1 second")
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
