import pytest
from plant_files import inspection, write_catalogs, write_lines
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from linewright import sources
from linewright.schemas import CATALOGS, RESCUED, event_schema
from linewright.session import materialize, shared_dir
from linewright.sources import pointer


@pytest.fixture()
def landing(tmp_path):
    return str(tmp_path / "landing")


def test_catalogs(spark, landing):
    write_catalogs(landing)
    for name in CATALOGS:
        df = sources.read_catalog(spark, name, f"{landing}/{name}")
        assert df.count() >= 1
        assert df.columns[-2:] == ["ingestion_timestamp", "source_file"]
    machines = sources.read_catalog(spark, "machines", f"{landing}/machines")
    assert dict(machines.dtypes)["installation_date"] == "date"
    assert machines.first().source_file.endswith("machines.csv")


def test_catalog_columns_follow_their_header(spark, tmp_path):
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.csv").write_text("clean_room_class,line_id,daily_capacity\nISO7,L1,100\n")
    row = sources.read_catalog(spark, "lines", str(tmp_path / "lines")).first()
    assert (row.line_id, row.daily_capacity, row.clean_room_class) == ("L1", 100, "ISO7")
    (tmp_path / "lines" / "a.csv").write_text("line_id,daily_capacity\nL1,100\n")
    with pytest.raises(Exception, match="clean_room_class"):
        sources.read_catalog(spark, "lines", str(tmp_path / "lines"))


def test_records_that_do_not_fit_are_kept(spark, landing):
    write_lines(
        f"{landing}/x/2024/01/a.json",
        [inspection("ok", "2024-01-01"), '{"unit_id": "half", "voltage_v": "high"}', "{broken"],
    )
    rows = {r.unit_id: r for r in sources.read_events(spark, "inspections", f"{landing}/x").collect()}
    assert rows["ok"][RESCUED] is None
    assert rows["half"].voltage_v is None and "high" in rows["half"][RESCUED]
    assert rows[None][RESCUED] == "{broken"


def test_flows_of_different_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, extra string")
    b = spark.createDataFrame([(2,)], "id int")
    assert sorted(map(tuple, sources.append_flows(a, b).collect())) == [(1, "x"), (2, None)]


def test_inferred_schema_is_kept(spark, landing, tmp_path):
    write_lines(f"{landing}/y/a.json", [{"a": 1, "b": 2.5, "c": "t"}])
    stored = str(tmp_path / "schema")
    schema = sources.infer_schema(spark, f"{landing}/y", stored)
    assert sources.load_schema(spark, stored) == schema
    assert {f.name: f.dataType.simpleString() for f in schema} == {"a": "bigint", "b": "double", "c": "string"}


def test_catalogue_files_may_order_their_columns_apart(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    (folder / "a.csv").write_text("line_id,daily_capacity,clean_room_class\nL1,100,ISO5\n")
    (folder / "b.csv").write_text("\ufeffclean_room_class,line_id,daily_capacity\r\nISO8,L2,200\r\n")
    (folder / "c.csv").write_text("daily_capacity,extra,line_id,clean_room_class\nmany,x,L3,ISO1\n")
    got = sources.read_catalog(spark, "lines", str(folder)).collect()
    rows = sorted((r.line_id, r.daily_capacity, r.clean_room_class, r.source_file.rsplit("/")[-1]) for r in got)
    assert rows == [("L1", 100, "ISO5", "a.csv"), ("L2", 200, "ISO8", "b.csv"), ("L3", None, "ISO1", "c.csv")]
    (folder / "d.csv").write_text("line_id,daily_capacity\nL4,1\n")
    with pytest.raises(AnalysisException):
        sources.read_catalog(spark, "lines", str(folder)).collect()


def test_pointer_is_replaced(spark, tmp_path):
    path = str(tmp_path / "deep" / "CURRENT")
    assert pointer.pointed(spark, path) is None
    for name in ("one", "zw\u00e9i", ""):
        pointer.point(spark, path, name)
        assert pointer.pointed(spark, path) == name
    assert [c for c in pointer.children(spark, str(tmp_path / "deep")) if not c.endswith(".crc")] == ["CURRENT"]


def test_month_partitions_prune(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.sql("SELECT timestamp'2024-01-15' + make_interval(0, id) AS t FROM range(4)")
    sources.overwrite(sources.with_month_partitions(df, "t"), path, ["year", "month"])
    read = spark.read.parquet(path).filter("year = 2024 AND month = 3")
    assert read.count() == 1 and len(read.inputFiles()) == 4
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    sources.overwrite(df.selectExpr("t", "1 AS other"), path)
    assert spark.read.parquet(path).columns == ["t", "other"]


def test_changed_rows_are_null_safe(spark):
    old = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0), (4, None)], "k int, v double")
    new = spark.createDataFrame([(1, 1.0), (2, None), (3, 4.0), (4, 5.0), (5, None)], "k int, v double")
    got = sorted(map(tuple, sources.changed_rows(old, new, ["k"]).collect()))
    assert got == [(3, "U", 4.0), (4, "U", 5.0), (5, "I", None)]
    assert sorted(map(tuple, sources.changed_rows(new, old, ["k"]).collect()))[-1] == (5, "D", None)


def test_applied_changes_give_the_new_snapshot(spark):
    old = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0), (6, 6.0)], "k int, v double")
    new = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, None), (5, None)], "k int, v double")
    got = sources.apply_changes(old, sources.changed_rows(old, new, ["k"]), ["k"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, new.collect()))


def test_latest_row_is_one_row(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("a", 3, None)], "k string, t int, v string")
    assert tuple(sources.latest_per_key(df, ["k"], ["t"]).first()) == ("a", 3, None)


def test_fingerprint_ignores_order_and_sees_changes(spark):
    df = spark.range(1000).withColumn("v", F.col("id") * 2)
    first = sources.fingerprint(df).first()
    assert sources.fingerprint(df.repartition(9).orderBy(F.col("id").desc())).first() == first
    assert sources.fingerprint(df.withColumn("v", F.when(F.col("id") == 7, 0).otherwise(F.col("v")))).first() != first


def test_properties_and_comment(spark):
    spark.sql("CREATE TABLE props (id int) USING parquet")
    try:
        sources.set_properties(spark, "props", {"ml.version": 3, "it's": "o'k"})
        found = sources.get_properties(spark, "props")
        assert found["ml.version"] == "3" and found["it's"] == "o'k"
        sources.comment_table(spark, "props", "the baseline's rows")
        detail = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED props").collect()}
        assert detail["Comment"] == "the baseline's rows"
    finally:
        spark.sql("DROP TABLE props")


def test_exports(spark, tmp_path):
    coefficients = spark.createDataFrame([("a", 0.1), ("b", -3.0), ("c", 2.0)], "feature string, coefficient double")
    sources.export_coefficients(coefficients, str(tmp_path / "c"))
    assert [r.feature for r in spark.read.csv(str(tmp_path / "c"), header=True).collect()] == ["b", "c", "a"]
    sources.export_examples(spark.range(100), str(tmp_path / "e"), 5)
    assert spark.read.parquet(str(tmp_path / "e")).count() == 5


def test_scratch_tables_live_in_the_shared_folder(spark):
    folder = shared_dir(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    kept = materialize(spark.range(5), "five")
    assert kept.count() == 5 and folder in kept.inputFiles()[0]


def test_event_schema_has_the_documented_columns():
    assert len(event_schema("inspections", rescue=False)) == 22
    assert len(event_schema("labels", rescue=False)) == 3


def test_bucketed_tables_join_without_a_shuffle(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("bucket_a", "bucket_b"):
            rows = spark.range(500).select(F.col("id").cast("string").alias("unit_id"), F.lit(name).alias(name))
            sources.overwrite_table(rows, name, buckets=4, bucket_by=["unit_id"])
        joined = spark.table("bucket_a").join(spark.table("bucket_b"), "unit_id", "left")
        assert joined.count() == 500
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE IF EXISTS bucket_a")
        spark.sql("DROP TABLE IF EXISTS bucket_b")
