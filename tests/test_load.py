import uuid
from unittest.mock import MagicMock

import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as st

from twinloom.errors import CodedError, LoadError, SpecError
from twinloom.operators.align import align_to_schema, select_load_columns, strict_casts
from twinloom.plans.layout import RunLayout
from twinloom.sinks import targets
from twinloom.sinks.artifacts import failures_recorded, materialize_query, stage_query, stage_table
from twinloom.sinks.targets import TableLoad, load_table, load_tables, write_target
from twinloom.sources.tables import is_partitioned, partition_columns, table_provider
from twinloom.sources.texts import read_diagnostics, read_text


def fails(code):
    return pytest.raises(CodedError, check=lambda error: error.code == code)


@pytest.fixture
def target(spark):
    names = []

    def create(columns="a bigint, b string, dt string", partitioned="dt"):
        names.append(f"t_{uuid.uuid4().hex}")
        parts = f"PARTITIONED BY ({partitioned})" if partitioned else ""
        spark.sql(f"CREATE TABLE {names[-1]} ({columns}) USING PARQUET {parts}")
        return names[-1]

    yield create
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def rows(spark, *data):
    return spark.createDataFrame(list(data), "a bigint, b string, dt string")


def content(spark, name):
    return sorted(tuple(r) for r in spark.table(name).collect())


def test_partition_facts(spark, target):
    parted, flat = target(), target(partitioned="")
    assert is_partitioned(spark, parted) and not is_partitioned(spark, flat)
    assert partition_columns(spark, parted) == ["dt"] and table_provider(spark, flat) == "parquet"


def test_append_and_overwrites(spark, target):
    name = target()
    write_target(rows(spark, (1, "x", "d1"), (2, "y", "d2")), name, "APPEND")
    write_target(rows(spark, (1, "x", "d1")), name, "APPEND")
    assert content(spark, name) == [(1, "x", "d1"), (1, "x", "d1"), (2, "y", "d2")]
    write_target(rows(spark, (9, "z", "d1"), (8, "w", "d3")), name, "OVERWRITE_PARTITIONS")
    assert content(spark, name) == [(2, "y", "d2"), (8, "w", "d3"), (9, "z", "d1")]
    write_target(rows(spark, (5, "v", "d2")), name, "OVERWRITE_TABLE")
    assert content(spark, name) == [(5, "v", "d2")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_v2_tables_use_the_v2_writer(spark, monkeypatch):
    """No V2 catalog is available here, so only the chosen call is checked."""
    for name, value in (("table_provider", "iceberg"), ("is_partitioned", True)):
        monkeypatch.setattr(targets, name, lambda *_, value=value: value)
    for mode, call in (("APPEND", "append"), ("OVERWRITE_TABLE", "overwrite"), ("OVERWRITE_PARTITIONS", "overwritePartitions")):
        frame = MagicMock()
        write_target(frame, "cat.db.t", mode)
        frame.writeTo.assert_called_once_with("cat.db.t")
        assert [c[0] for c in frame.writeTo.return_value.method_calls] == [call]


def test_write_mode_errors(spark, target):
    flat = target(partitioned="")
    with fails("PARTITIONED_TARGET_REQUIRED"):
        write_target(rows(spark, (1, "x", "d")), flat, "OVERWRITE_PARTITIONS")
    with fails("UNSUPPORTED_WRITE_MODE"):
        write_target(rows(spark, (1, "x", "d")), flat, "MERGE")


def test_partitioned_write_splits_a_hot_partition_instead_of_one_task(spark, target):
    name = target()
    plan = rows(spark, (1, "x", "d1")).hint("rebalance", "dt")._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan
    write_target(spark.range(1000).selectExpr("id", "'b'", "if(id % 3 = 0, 'hot', cast(id % 5 as string))"), name, "APPEND")
    assert spark.table(name).count() == 1000


def test_select_load_columns(spark):
    source = spark.createDataFrame([(1, 2)], "Aa int, b int")
    assert select_load_columns(source, ["B", "aA"]).columns == ["B", "aA"]
    with fails("LOAD_COLUMNS_MISSING_IN_PARQUET"):
        select_load_columns(source, ["c"])
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        with fails("LOAD_COLUMNS_AMBIGUOUS_BY_CASE"):
            select_load_columns(spark.createDataFrame([(1, 2)], "A int, a int"), ["a"])
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_alignment(spark):
    source = spark.createDataFrame([("7", 1.5)], "ID string, price double")
    schema = st.StructType.fromDDL("price decimal(5,1), extra date, id bigint, flag boolean NOT NULL, code string NOT NULL")
    aligned = align_to_schema(source, schema)
    assert aligned.columns == ["price", "extra", "id", "flag", "code"]
    row = aligned.first()
    assert (float(row.price), row.extra, row.id, row.flag, row.code) == (1.5, None, 7, False, "N/A")
    with fails("LOAD_COLUMNS_ABSENT_IN_TARGET"):
        align_to_schema(source, st.StructType.fromDDL("id bigint"))
    with fails("LOAD_NON_NULLABLE_TARGET_COLUMN_MISSING"):
        align_to_schema(source, st.StructType.fromDDL("id bigint, price double, tags array<string> NOT NULL"))


def test_strict_casts_fail_on_bad_values_and_restore(spark):
    source = spark.createDataFrame([("x",)], "a string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert align_to_schema(source, st.StructType.fromDDL("a int")).first().a is None
        with strict_casts(spark):
            strict = align_to_schema(source, st.StructType.fromDDL("a int"))
        assert spark.conf.get("spark.sql.ansi.enabled") == "false"
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            strict.collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_load_table(spark, target, tmp_path):
    name = target("a int, note string, dt string")
    uri = str(tmp_path / "staged")
    stage_table(spark.createDataFrame([("1", "d1"), ("2", "d2")], "A string, dt string"), uri)
    load_tables(spark, [TableLoad(uri, name, "OVERWRITE_PARTITIONS", ("dt", "a"))])
    assert content(spark, name) == [(1, None, "d1"), (2, None, "d2")]
    with fails("TARGET_TABLE_NOT_FOUND"):
        load_table(spark, TableLoad(uri, "no_such_table", "APPEND", ("a",)))


def test_query_text_and_result(spark, tmp_path):
    query, result = str(tmp_path / "q.sql"), str(tmp_path / "r")
    stage_query(spark, "  select 1 AS one,\n'ü' AS u\n", query)
    assert read_text(spark, query).strip() == "select 1 AS one,\n'ü' AS u"
    materialize_query(spark, query, result)
    assert [tuple(r) for r in spark.read.parquet(result).collect()] == [(1, "ü")]
    stage_query(spark, "select nope", query)
    with fails("COMPARISON_RESULT_MATERIALIZATION_FAILED"):
        materialize_query(spark, query, result)


def test_columns_named_like_the_catalog_s_own_rows(spark, tmp_path):
    spark.sql(f"CREATE TABLE odd (`Provider` string, `# Partitioning` string, v int) USING PARQUET LOCATION '{tmp_path}/odd'")
    assert table_provider(spark, "odd") == "parquet" and not is_partitioned(spark, "odd")
    write_target(spark.createDataFrame([("a", "b", 1)], "`Provider` string, `# Partitioning` string, v int"), "odd", "APPEND")
    assert spark.table("odd").count() == 1
    spark.sql(f"CREATE TABLE odder (v int, `Provider` string) USING PARQUET PARTITIONED BY (`Provider`) LOCATION '{tmp_path}/odder'")
    assert table_provider(spark, "odder") == "parquet" and is_partitioned(spark, "odder")
    spark.sql("DROP TABLE odd")
    spark.sql("DROP TABLE odder")


def test_repeated_names_are_ambiguous(spark):
    with fails("LOAD_COLUMNS_AMBIGUOUS_BY_CASE"):
        select_load_columns(spark.createDataFrame([(1,)], "a int"), ["a", "a"])


def test_diagnostics_keep_the_original_error(spark, tmp_path):
    layout = RunLayout(str(tmp_path), "run_1")

    def bad():
        raise LoadError("TARGET_TABLE_NOT_FOUND", "no table")

    def worse():
        raise ValueError("secret detail")

    with fails("TARGET_TABLE_NOT_FOUND"):
        with failures_recorded(spark, layout, "load"):
            bad()
    with pytest.raises(ValueError, match="secret"):
        with failures_recorded(spark, layout, "compare"):
            worse()
    with failures_recorded(spark, layout, "fine"):
        pass
    found = {r.task_id: r for r in read_diagnostics(spark, layout.diagnostics).collect()}
    assert found["load"].code == "TARGET_TABLE_NOT_FOUND" and found["load"].message == "no table"
    assert found["compare"].code == "TECHNICAL_FAILURE" and "secret" not in found["compare"].message


def test_diagnostics_scan_skips_what_is_malformed(spark, tmp_path):
    folder = tmp_path / "runs" / "r1" / "result" / "diagnostics"
    folder.mkdir(parents=True)
    texts = {
        "ok": '{"run_id":"r1","task_id":"t","code":"C","message":"m"}',
        "other": '{"run_id":"r2","task_id":"t","code":"C","message":"m"}',
        "blank": '{"run_id":"r1","task_id":"","code":"C","message":"m"}',
        "broken": '{"run_id":',
        "missing": '{"run_id":"r1"}',
    }
    for name, text in texts.items():
        (folder / f"{name}.json").write_text(text)
    assert [tuple(r) for r in read_diagnostics(spark, f"{folder}/*.json").collect()] == [("r1", "t", "C", "m")]


def test_staged_files_declare_types_and_required_columns(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", None), (2, "b", 0.5)], "n bigint, `a.b` string, x double")
    schema = st.StructType([st.StructField("a.b", st.StringType(), False), st.StructField("n", st.LongType(), False), st.StructField("x", st.DoubleType())])
    stage_table(rows, str(tmp_path / "t"), schema=schema)
    files = [pq.ParquetFile(path).schema_arrow for path in (tmp_path / "t").glob("*.parquet")]
    assert files and all([(f.name, f.nullable) for f in file] == [("a.b", False), ("n", False), ("x", True)] for file in files)
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "t")).collect())) == [("a", 1, None), ("b", 2, 0.5)]
    strict = st.StructType([st.StructField(f.name, f.dataType, False) for f in schema.fields])
    with pytest.raises(Exception, match="NULL in column x"):
        stage_table(rows, str(tmp_path / "u"), schema=strict)
    for wrong in (rows.drop("x"), rows.withColumn("y", rows.n), rows.withColumn("n", rows.n.cast("int"))):
        with pytest.raises(SpecError):
            stage_table(wrong, str(tmp_path / "v"), schema=schema)
