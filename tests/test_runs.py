import pytest
from pyspark.sql import functions as F

from headrace.catalogue.base import objects_frame, sources_frame
from headrace.operators import runlog, target
from headrace.operators.landing import land, landing_format, object_path
from headrace.plans.ingest import IngestFailed, ingest_all, raise_for_failures
from headrace.session import new_dir, new_schema
from headrace.sources.registry import register_reader


def run(spark, schema, *objects, source=None, **options):
    sources = sources_frame(spark, {"source_id": 1, "source_name": "My Source", "source_type": "TEST"} | (source or {}))
    rows = [{"source_system_id": 1, "target_schema": schema, "target_table": "t"} | o for o in objects]
    return ingest_all(spark, sources, objects_frame(spark, *rows), f"{schema}.runs", **options)


@pytest.fixture
def schema(spark):
    return new_schema(spark)


@pytest.mark.parametrize("file_format", ["parquet", "json", "csv", "fixed_width"])
@pytest.mark.parametrize("mode", ["append", "merge"])
def test_the_source_is_read_once(spark, schema, file_format, mode):
    """A source that gives other values each time it is read: landing and target must agree."""
    register_reader("TEST", lambda s, source, obj: s.range(20).withColumn("v", F.expr("uuid()")))
    base = new_dir(spark)
    result = run(spark, schema, {"ingestion_object_id": 1, "source_object_name": "nums*", "write_mode": mode,
                                 "primary_key_cols": "id", "file_format": file_format}, landing_base=base).first()
    assert (result.status, result.rows_read, result.rows_copied) == ("SUCCESS", 20, 20)
    fmt = landing_format(file_format)
    landed = spark.read.format(fmt).option("header", True).load(object_path(base, "My Source", None, "nums*"))
    assert landed.filter(F.col("run_id") == result.run_id).count() == 20
    both = landed.select("v").join(spark.table(f"{schema}.t"), "v")
    assert both.count() == 20
    if fmt == "parquet":
        stamps = landed.select("_ingested_at").union(spark.table(f"{schema}.t").select("_ingested_at"))
        assert stamps.distinct().count() == 1
    tables = [r.tableName for r in spark.sql(f"SHOW TABLES IN {schema}").collect()]
    assert not [t for t in tables if "__scratch_" in t]


@pytest.mark.parametrize("values, moved", [(3, False), (40, True)])
def test_a_landed_batch_of_few_partition_values_is_not_shuffled(spark, schema, monkeypatch, values, moved):
    register_reader("TEST", lambda s, source, obj: s.range(0, 400, 1, 4).withColumn("Day", F.col("id") % values))
    shuffled, rebalance, key = [], target._rebalance, "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    monkeypatch.setattr(target, "_rebalance", lambda df, by: (shuffled.append(by), rebalance(df, by))[1])
    for _ in range(2):
        raise_for_failures(run(spark, schema, {"ingestion_object_id": 1, "source_object_name": "days",
                                               "partition_column": "day"}, landing_base=new_dir(spark)))
    assert bool(shuffled) == moved and spark.conf.get(key) == before
    got = spark.table(f"{schema}.t").groupBy("Day").count().collect()
    assert sorted(map(tuple, got)) == [(v, 800 // values + (2 if v < 400 % values else 0)) for v in range(values)]


def test_failures_are_isolated_and_logged(spark, schema):
    def reader(s, source, obj):
        if obj.source_object_name == "bad":
            raise RuntimeError("cannot connect")
        return s.range(3)
    register_reader("TEST", reader)
    results = run(spark, schema, {"ingestion_object_id": 2, "source_object_name": "bad"},
                  {"ingestion_object_id": 1, "source_object_name": "good"}, pipeline_name=None, trigger_type="EVENT")
    assert [(r.ingestion_object_id, r.status) for r in results.collect()] == [(1, "SUCCESS"), (2, "FAILED")]
    with pytest.raises(IngestFailed, match=r"\[2\]"):
        raise_for_failures(results)
    events = spark.table(f"{schema}.runs")
    runs = runlog.current_runs(events)
    assert events.count() == 4 and runs.count() == 2
    assert runlog.last_status_of(runs, 2) == "FAILED" and runlog.last_status_of(runs, 9) is None
    failed = runs.filter("status = 'FAILED'").first()
    assert failed.error == "cannot connect" and failed.trigger_type == "EVENT" and failed.rows_read == 0
    assert runs.filter("status = 'SUCCESS'").first().execution_duration_sec > 0


def test_objects_that_share_a_target_take_turns(spark, schema):
    register_reader("TEST", lambda s, source, obj: s.range(10).withColumn("o", F.lit(obj.ingestion_object_id)))
    results = run(spark, schema, *[{"ingestion_object_id": i, "source_object_name": "n"} for i in range(1, 6)])
    assert results.filter("status = 'SUCCESS'").count() == 5
    assert spark.table(f"{schema}.t").groupBy("o").count().filter("count = 10").count() == 5


def test_look_back_without_merge_is_refused(spark, schema):
    register_reader("TEST", lambda s, source, obj: s.range(3))
    result = run(spark, schema, {"ingestion_object_id": 1, "load_type": "incremental", "incremental_column": "id",
                                 "watermark_lag_sec": 5}).first()
    assert result.status == "FAILED" and "merge" in result.error


def test_incremental_runs_continue_from_the_target(spark, schema):
    size = {"n": 5}
    register_reader("TEST", lambda s, source, obj: s.range(size["n"]))
    obj = {"ingestion_object_id": 1, "load_type": "incremental", "incremental_column": "ID",
           "incremental_end_value": "-1"}
    reads = []
    for size["n"] in (5, 5, 8):
        reads.append(run(spark, schema, obj).first().rows_read)
    assert reads == [5, 0, 3] and spark.table(f"{schema}.t").count() == 8


def test_nothing_selected(spark, schema):
    assert run(spark, schema, {"ingestion_object_id": 1}, source_type="none").count() == 0


def test_nested_rows_cannot_land_as_csv(spark, schema):
    register_reader("TEST", lambda s, source, obj: s.range(1).withColumn("a", F.array("id")))
    result = run(spark, schema, {"ingestion_object_id": 1, "source_object_name": "n", "file_format": "csv"},
                 landing_base=new_dir(spark)).first()
    assert result.status == "FAILED"


def test_landing_folders_are_safe():
    assert object_path("/base/", "A b/c", "..", "x*.csv") == "/base/A_b_c/__/x_.csv"


def test_csv_landing_keeps_text(spark):
    from datetime import date
    texts = [' lead "q" ', 'a,b\nc\r\nd', 'back\\"slash\\', "", None, '""', "\\"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    path = land(df, new_dir(spark), "s", None, "o", date(2024, 1, 1), "r", "csv")
    back = spark.read.schema(df.schema).options(header=True, escape='"', multiLine=True).csv(path)
    # CSV has one spelling for an empty and a missing text; targets are never built from it
    assert [r.t for r in back.orderBy("id").collect()] == [t or None for t in texts]


def test_command_line(spark, schema, capsys):
    from headrace.__main__ import arguments, run as run_command
    register_reader("TEST", lambda s, source, obj: s.range(4))
    sources_frame(spark, {"source_id": 1, "source_name": "S", "source_type": "test"}).write.saveAsTable(f"{schema}.src")
    objects_frame(spark, {"ingestion_object_id": 1, "source_system_id": 1, "source_object_name": "n",
                          "target_schema": schema, "target_table": "t"},
                  {"ingestion_object_id": 2, "source_system_id": 1, "source_object_name": "n", "write_mode": "merge",
                   "target_schema": schema, "target_table": "u"}).write.saveAsTable(f"{schema}.obj")
    args = arguments(["--sources", f"{schema}.src", "--objects", f"{schema}.obj", "--run-log", f"{schema}.log",
                      "--source-type", "test"])
    assert run_command(spark, args) == 1
    assert "2 objects, 1 failed" in capsys.readouterr().out
    assert spark.table(f"{schema}.t").count() == 4
    assert spark.table(f"{schema}.log").select("trigger_type").distinct().first()[0] == "SCHEDULED"


@pytest.mark.parametrize("mode", ["append", "merge", "overwrite"])
@pytest.mark.parametrize("where", ["before the target", "after the target"])
def test_a_crash_takes_no_file_in_twice(spark, schema, monkeypatch, mode, where):
    """The target says which files it has, so neither order of failure loses or repeats any."""
    root, write = new_dir(spark), target.write
    crash = {"now": True}

    def failing(*args, **options):
        if crash["now"] and where == "before the target":
            raise RuntimeError("lost")
        result = write(*args, **options)
        if crash["now"]:
            raise RuntimeError("lost")
        return result

    monkeypatch.setattr(target, "write", failing)

    def drops(*ids):
        spark.createDataFrame([(i,) for i in ids], "id long").coalesce(1).write.mode("append").parquet(f"{root}/d")
        return run(spark, schema, {"ingestion_object_id": 7, "source_schema": "d", "source_object_name": "*.parquet",
                                   "file_format": "parquet", "write_mode": mode, "primary_key_cols": "id"},
                   source={"source_type": "SFTP", "root_path": root}, ledger=f"{schema}.ledger").first()

    assert drops(1, 2).error == "lost"
    crash["now"] = False
    late = drops(3)
    held = sorted(r.id for r in spark.table(f"{schema}.t").collect())
    again = drops(4)
    assert late.status == again.status == "SUCCESS" and again.rows_read == 1
    if mode == "overwrite":
        assert held == ([1, 2, 3] if where == "before the target" else [3])
        assert [r.id for r in spark.table(f"{schema}.t").collect()] == [4]
    else:
        assert held == [1, 2, 3] and late.rows_read == (3 if where == "before the target" else 1)
        assert sorted(r.id for r in spark.table(f"{schema}.t").collect()) == [1, 2, 3, 4]


def test_what_the_run_log_is_told(spark, schema):
    register_reader("TEST", lambda s, source, obj: s.range(5))
    obj = {"ingestion_object_id": 1, "write_mode": "overwrite"}
    for _ in range(2):
        run(spark, schema, obj, frequency="DAILY", department_id=12)
    got = runlog.current_runs(spark.table(f"{schema}.runs")).orderBy("trigger_time").collect()
    assert [(r.frequency, r.department_id, r.rows_deleted) for r in got] == [("DAILY", 12, 0), ("DAILY", 12, 5)]


def test_deleted_rows_are_counted_from_footers(spark, schema):
    """The count before an overwrite reads no column, even of a target whose last merge replaced places."""
    name = f"{schema}.t"
    target.append(spark.range(9).withColumn("v", F.col("id") % 3), name, partition_column="v")
    target.merge(spark.range(2).withColumn("v", F.col("id") % 3), name, ["id"])
    counted = spark.table(name).agg(F.count(F.lit(1)))
    assert counted.first()[0] == 9
    scan = next(x for x in counted._jdf.queryExecution().executedPlan().toString().splitlines() if "Scan parquet" in x)
    assert "ReadSchema: struct<>" in scan
    assert target.overwrite(spark.range(3).withColumn("v", F.col("id")), name).deleted == 9
