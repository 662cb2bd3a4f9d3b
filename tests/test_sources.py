from datetime import datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from headrace.catalogue.base import one_object, one_source
from headrace.catalogue.relational import _to_derby
from headrace.operators import target
from headrace.operators.landing import landing_format
from headrace.plans.ingest import extract, incremental_column
from headrace.session import new_dir, new_schema
from headrace.sources.documents import _is_split, collection_of, read_json_documents
from headrace.sources.file_drop import (drop_directory, drop_pattern, list_files, pending_files, read_files,
                                        read_file_drop, select_files)
from headrace.sources.registry import read_source, register_reader
from headrace.sources.relational import read_jdbc


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kind", ["POSTGRES", "PostgreSQL", "pg", "MySQL", "ORACLE", "MSSQL", "SQLServer"])
def test_relational_names(spark, kind):
    spark.range(3).createOrReplaceTempView("three")
    source = one_source(spark, source_id=1, source_name="s", source_type=kind, options={"catalog": ""})
    assert read_source(spark, source, one_object(spark, source_object_name="three")).count() == 3


def test_unknown_source_type(spark):
    with pytest.raises(ValueError, match="no reader"):
        read_source(spark, one_source(spark, source_id=1, source_name="s", source_type="fax"), None)


def test_registered_reader(spark):
    register_reader("numbers", lambda session, source, obj: session.range(int(source.options["n"])))
    source = one_source(spark, source_id=1, source_name="s", source_type="Numbers", options={"n": "4"})
    assert read_source(spark, source, one_object(spark)).count() == 4


def test_relational_without_connection(spark):
    with pytest.raises(ValueError, match="neither a JDBC url nor a catalog"):
        read_source(spark, one_source(spark, source_id=1, source_name="s", source_type="pg"), one_object(spark))


@pytest.fixture(scope="module")
def derby(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    return _to_derby(events, "events", "event_type VARCHAR(32), props VARCHAR(256)")


def test_jdbc_pushdown_and_column_pruning(spark, derby):
    source = one_source(spark, source_id=1, source_name="s", source_type="ORACLE", options=derby)
    df = extract(spark, source, one_object(
        spark, source_object_name="events", load_type="INCREMENTAL", incremental_column="event_id",
        incremental_end_value="10", target_schema="none", target_table="t"))
    text = plan(df.select("value"))
    assert "GreaterThan(event_id,10)" in text and "user_id" not in text


def test_jdbc_query_filter_and_pages(spark, derby):
    df = read_jdbc(spark, derby, query='SELECT "event_id", "value" FROM events;', source_filter='"event_id" >= 10',
                   page_column='"event_id"', pages=4, fetch_size=100)
    assert df.rdd.getNumPartitions() == 4
    assert df.agg(F.min("event_id")).first()[0] == 10
    empty = read_jdbc(spark, derby, name="events", source_filter='"event_id" < 0', page_column='"event_id"', pages=4)
    assert empty.count() == 0


def test_pages_are_cut_above_the_watermark(spark, derby):
    source = one_source(spark, source_id=1, source_name="s", source_type="ORACLE", options=derby | {"pages": "4"})
    last = spark.read.parquet("/root/testdata/sf0.001/events.parquet").agg(F.max("event_id")).first()[0]
    df = extract(spark, source, one_object(
        spark, source_object_name="events", load_type="INCREMENTAL", incremental_column="event_id",
        incremental_end_value=str(last - 40), page_column='"event_id"', target_schema="none", target_table="t"))
    rows = df.groupBy(F.spark_partition_id()).count().collect()
    assert len(rows) == 4 and sum(r["count"] for r in rows) == 40 and max(r["count"] for r in rows) <= 12


def page_sizes(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


@pytest.fixture(scope="module")
def odd_keys(spark):
    """Text keys that bunch at their beginnings, with quotes, some NULL; a number key with one far value."""
    rows = spark.range(2000).selectExpr(
        "CASE WHEN id % 100 <> 7 THEN concat('cust\\'', lpad(CAST(id AS STRING), 9, '0')) ELSE 'none' END AS k",
        "CASE WHEN id = 5 THEN 1000000000 ELSE id * id END AS n", "CAST(id * 10 AS STRING) AS at",
        "concat('2024-01-', lpad(CAST(id % 28 + 1 AS STRING), 2, '0')) AS day")
    return _to_derby(rows, "odd_keys", "k VARCHAR(32), at VARCHAR(16), day VARCHAR(10)")


def test_text_keys_are_cut_into_even_pages(spark, odd_keys):
    rows = """SELECT NULLIF("k", 'none') AS "k", "n" FROM odd_keys"""
    df = read_jdbc(spark, odd_keys, query=rows, page_column='"k"', pages=8)
    sizes = page_sizes(df)
    assert len(sizes) == 8 and sum(sizes) == 2000 and sizes[-1] <= 2 * 2000 / 8
    assert df.select("n").distinct().count() == 2000
    assert read_jdbc(spark, odd_keys, name="odd_keys", page_column='"k"', source_filter='"n" < 0').count() == 0
    one = read_jdbc(spark, odd_keys, query=rows, source_filter='"k" IS NULL', page_column='"k"')
    assert one.count() == 20


def test_skewed_keys_above_a_watermark(spark, odd_keys):
    """Equal ranges would put all rows but one in one page."""
    source = one_source(spark, source_id=1, source_name="s", source_type="MYSQL",
                        options=odd_keys | {"pages": "5", "page_bounds": "quantiles"})
    df = extract(spark, source, one_object(
        spark, source_object_name="odd_keys", load_type="INCREMENTAL", incremental_column="n", primary_key_cols="n",
        incremental_end_value=str(999 * 999), target_schema="none", target_table="t"))
    sizes = page_sizes(df)
    assert len(sizes) == 5 and sum(sizes) == 1001 and sizes[-1] <= 2 * 1001 / 5
    with pytest.raises(ValueError, match="page_bounds"):
        read_jdbc(spark, odd_keys, name="odd_keys", page_column='"n"', page_bounds="even")


@pytest.mark.parametrize("column,declared,watermark,lag,want", [
    ("at", "bigint", "19900", None, 9), ("at", "int", "19900", 100, 19), ("at", "decimal(12,2)", "19899.5", None, 10),
    ("at", "double", "1.99e4", None, 9), ("day", "date", "2024-01-27", None, 71), ("day", "date", "2024-01-27", 86400, 142)])
def test_text_watermarks_run_in_the_database(spark, odd_keys, column, declared, watermark, lag, want):
    source = one_source(spark, source_id=1, source_name="s", source_type="ORACLE", options=odd_keys | {"pages": "3"})
    df = extract(spark, source, one_object(
        spark, source_object_name="odd_keys", load_type="INCREMENTAL", incremental_column=column, write_mode="merge",
        incremental_column_type=declared, incremental_end_value=watermark, watermark_lag_sec=lag, primary_key_cols="k",
        target_schema="none", target_table="t"))
    assert df.count() == want
    assert "Filter (" not in plan(df)
    assert len(page_sizes(df)) == 3  # the pages are cut above it


def test_text_that_is_compared_by_spark(spark, odd_keys):
    """Zoned times depend on the session, so the database does not compare them."""
    source = one_source(spark, source_id=1, source_name="s", source_type="ORACLE", options=odd_keys)
    df = extract(spark, source, one_object(
        spark, source_object_name="odd_keys", load_type="INCREMENTAL", incremental_column="day",
        incremental_column_type="timestamp", incremental_end_value="2024-01-27", target_schema="none", target_table="t"))
    assert df.count() == 71 and "Filter (" in plan(df)


def test_document_wrappers(spark):
    path = new_dir(spark)
    spark.createDataFrame([
        ('{"_id": {"$oid": "a1"}, "at": {"$date": "2024-01-02T03:04:05.678Z"}, "n": {"$numberLong": "9007199254740993"},'
         ' "d": {"$numberDecimal": "1.25"}, "tags": ["x"], "o": {"k": 1}, "s": "{\\"$x\\": 1}"}',),
        ('{"_id": "b2", "at": "2024-01-02T03:04:05.678Z", "n": 7, "d": 1.5, "s": "plain"}',),
        ('{"_id": "c3", "at": {"$date": {"$numberLong": "1704164645678"}}, "n": null}',),
    ], "value string").write.text(path)
    got = read_json_documents(spark, path, "_id string, at timestamp_ntz, n long, d decimal(5,2), "
                                           "tags array<string>, o struct<k: int>, s string").orderBy("_id").collect()
    at = datetime(2024, 1, 2, 3, 4, 5, 678000)
    assert [r.at for r in got] == [at, at, at]
    assert [r.n for r in got] == [9007199254740993, 7, None]
    assert [str(r.d) for r in got] == ["1.25", "1.50", "None"]
    assert [r._id for r in got] == ["a1", "b2", "c3"] and got[0].tags == ["x"] and got[0].o.k == 1
    assert [r.s for r in got] == ['{"$x": 1}', "plain", None]


def test_inferred_documents(spark):
    path = new_dir(spark)
    spark.createDataFrame([('{"_id": {"$oid": "a1"}, "at": {"$date": "2024-01-02T03:04:05Z"}, "o": {"k": 1}}',)],
                          "value string").write.text(path)
    df = read_json_documents(spark, path)
    assert df.schema["at"].dataType.simpleString() == "timestamp"
    assert df.first().asDict(True) == {"_id": "a1", "at": datetime(2024, 1, 2, 3, 4, 5), "o": {"k": 1}}


def test_collection_name():
    source = SimpleNamespace(default_collection="events")
    for name, want in (("orders", "orders"), ("__default__", "events"), (None, "events")):
        assert collection_of(source, SimpleNamespace(source_object_name=name)) == want


@pytest.mark.parametrize("name,default,want", [
    ("daily_*.csv", "*.txt", "daily_*.csv"), ("a?.csv", None, "a?.csv"), ("report.csv", "*", "report.csv"),
    ("report", "*.csv", "*.csv"), ("report", None, "*"), (None, None, "*")])
def test_drop_pattern(name, default, want):
    assert drop_pattern(name, default) == want


def test_drop_directory():
    assert drop_directory("/up/", "/daily/") == "/up/daily"
    assert drop_directory(None, None) == ""


def test_no_matching_file(spark):
    root = new_dir(spark)
    spark.range(1).write.parquet(f"{root}/d")
    source = one_source(spark, source_id=1, source_name="s", source_type="SFTP", root_path=root)
    with pytest.raises(FileNotFoundError, match="no unread file"):
        read_source(spark, source, one_object(spark, source_schema="d", source_object_name="*.csv"))


def test_consumed_files_and_deliveries_under_an_old_name(spark):
    root = new_dir(spark)
    spark.range(1).coalesce(1).write.parquet(root)
    files = list_files(spark, root, "*.parquet")
    assert files.columns == ["file_path", "modified"] and files.count() == 1
    assert pending_files(files, files).count() == 0
    older = files.withColumn("modified", F.expr("modified - INTERVAL 1 HOUR"))
    assert pending_files(files, older).count() == 1
    source = one_source(spark, source_id=1, source_name="s", source_type="SFTP", root_path=root)
    kept = one_object(spark, source_object_name="*.parquet", source_filter=" NO_ARCHIVE ")
    assert len(select_files(spark, source, kept, files)) == 1


def test_listing_reads_no_content(spark):
    root = new_dir(spark)
    spark.range(1).write.parquet(root)
    assert "content" not in plan(list_files(spark, root, "*"))


def test_unsupported_format(spark):
    with pytest.raises(ValueError, match="unsupported file_format"):
        read_files(spark, "/nowhere", "xlsx")


def test_fixed_width_without_layout_is_headerless_csv(spark):
    path = new_dir(spark)
    spark.createDataFrame([("ab 12",)], "value string").write.text(path)
    assert [tuple(r) for r in read_files(spark, path, "fixedwidth").collect()] == [("ab 12",)]
    cut = read_files(spark, path, "fixed_width", layout="a:3:string; n:2:int; rest:5:string")
    assert [tuple(r) for r in cut.collect()] == [("ab", 12, None)]


def test_which_objects_are_incremental(spark):
    def column(kind, **obj):
        source = one_source(spark, source_id=1, source_name="s", source_type=kind)
        return incremental_column(source, one_object(spark, incremental_column="c", **obj))
    assert column("pg", load_type="incremental") == "c"
    assert column("pg", load_type="full") is None
    assert column("pg", load_type="incremental", custom_query="SELECT 1") == "c"
    assert column("mongo", load_type="incremental") == "c"
    assert column("mongo", load_type="incremental", custom_query="SELECT 1") is None
    assert column("sftp", load_type="incremental") is None
    assert column("s3", load_type="incremental") is None


def _folder_with(tmp_path, **files):
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    return str(tmp_path)


def test_hidden_files_that_match_are_an_error(spark, tmp_path):
    root = _folder_with(tmp_path, **{"a.csv": "k\n1\n", "_b.csv": "k\n2\n", "_SUCCESS": ""})
    source = one_source(spark, source_id=1, source_name="s", source_type="SFTP", root_path=root)
    with pytest.raises(ValueError, match="_b.csv"):
        read_file_drop(spark, source, one_object(spark, source_object_name="*.csv"))
    assert read_file_drop(spark, source, one_object(spark, source_object_name="a*.csv")).count() == 1


def test_chosen_paths_are_taken_literally(spark, tmp_path):
    root = _folder_with(tmp_path, **{"c[1].csv": "k\n1\n", "c1.csv": "k\n2\n", "d{x}?.csv": "k\n3\n"})
    source = one_source(spark, source_id=1, source_name="s", source_type="SFTP", root_path=root)
    rows = read_file_drop(spark, source, one_object(spark, source_object_name="*.csv")).collect()
    assert sorted(r.k for r in rows) == [1, 2, 3]


@pytest.mark.parametrize("fmt,bad", [("csv", "n\n1\nzz\n"), ("json", '{"n": 1}\n{"n": "zz"}\n')])
def test_malformed_values_fail_unless_asked_for(spark, tmp_path, fmt, bad):
    root = _folder_with(tmp_path, **{f"a.{fmt}": bad})
    with pytest.raises(Exception, match="(?i)malformed"):
        read_files(spark, root, fmt, schema="n int").collect()
    assert [r.n for r in read_files(spark, root, fmt, schema="n int", mode="PERMISSIVE").collect()] == [1, None]


def lines(spark, *texts):
    path = new_dir(spark)
    spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.text(path)
    return path


@pytest.mark.parametrize("settings", [{}, {"schema": "a int"}, {"variant": "d"}, {"schema": "a int", "variant": "d"}])
def test_a_broken_document_fails_the_read(spark, settings):
    path = lines(spark, '{"a": 1}', '{"a": 2, broken', '{"a": 3}')
    with pytest.raises(Exception, match="MALFORMED"):
        read_json_documents(spark, path, **settings).collect()


def test_variant_documents(spark):
    """One pass without inference, whatever the fields; typed columns with their wrappers taken off."""
    path = lines(spark, '{"_id": {"$oid": "a1"}, "at": {"$date": "2024-01-02T03:04:05.678Z"}, "n": {"$numberLong": "9007199254740993"},'
                 ' "o": {"k": 1}, "tags": ["x"], "odd name\'s": 1.5}', '{"_id": "b2", "n": 7, "new": {"deep": [1, {"x": true}]}}', "{}")
    schema = "_id string, at timestamp_ntz, n long, o struct<k: int>, tags array<string>, `odd name's` double"
    jobs = spark.sparkContext.statusTracker()
    before = len(jobs.getJobIdsForGroup())
    df = read_json_documents(spark, path, schema, variant="d")
    assert len(jobs.getJobIdsForGroup()) == before
    got = {r._id: r for r in df.withColumn("deep", F.variant_get("d", "$.new.deep[1].x", "boolean")).collect()}
    assert got["a1"].at == datetime(2024, 1, 2, 3, 4, 5, 678000) and got["a1"].n == 9007199254740993
    assert got["a1"].o.k == 1 and got["a1"].tags == ["x"] and got["a1"]["odd name's"] == 1.5
    assert got["b2"].n == 7 and got["b2"].deep is True and got[None].n is None


def report_run(spark, schema, path, mode="append", evolution="merge", **more):
    source = one_source(spark, source_id=1, source_name="s", source_type="S3")
    obj = one_object(spark, source_path=path, target_schema=schema, target_table="t", write_mode=mode,
                     schema_evolution_mode=evolution, **more)
    rows = extract(spark, source, obj)
    target.write(rows, f"{schema}.t", mode, evolution=evolution)
    return rows


def test_types_of_reports_are_the_targets(spark):
    """`1` and then `3000000000`: whether the second run passes is the evolution mode's matter alone."""
    schema = new_schema(spark)
    first = lines(spark, "a,b", "1,2024-01-01", "2,")
    report_run(spark, schema, first)
    assert spark.table(f"{schema}.t").schema["a"].dataType.simpleString() == "int"
    later = lines(spark, "C,B,A", "x,,4")
    rows = report_run(spark, schema, later)
    assert [f.dataType.simpleString() for f in rows.schema] == ["string", "date", "int"]
    for mode, evolution in (("append", "merge"), ("append", "none"), ("overwrite", "none")):
        with pytest.raises(Exception, match="MALFORMED|schema differs"):
            report_run(spark, schema, lines(spark, "a,b,c", "3000000000,,"), mode, evolution)
    assert spark.table(f"{schema}.t").count() == 3
    report_run(spark, schema, lines(spark, "a,b,c", "3000000000,,"), "overwrite", "overwrite")
    assert spark.table(f"{schema}.t").select("a").collect() == [(3000000000,)]


def test_headers_of_all_files_are_compared(spark):
    schema, path = new_schema(spark), lines(spark, "a,b", "1,2")
    report_run(spark, schema, path)
    spark.createDataFrame([("b,a",), ("5,6",)], "value string").coalesce(1).write.mode("append").text(path)
    with pytest.raises(Exception, match="header|HEADER"):
        report_run(spark, schema, path)
    assert spark.table(f"{schema}.t").count() == 1


def test_landing_formats():
    assert [landing_format(f) for f in (None, "CSV", "json", "fixed_width")] == ["parquet", "csv", "json", "parquet"]
    for other in ("delta", "orc", "x"):
        with pytest.raises(ValueError, match="cannot land"):
            landing_format(other)


@pytest.mark.parametrize("codec, multiline, split", [("none", False, True), ("bzip2", False, True), ("gzip", False, False),
                                                     ("none", True, False)])
def test_documents_are_paged_where_spark_cannot_split_their_files(spark, codec, multiline, split):
    path = new_dir(spark)
    spark.range(20).write.option("compression", codec).json(path)
    options = {"multiLine": "true"} if multiline else {}
    documents = read_json_documents(spark, path, "id long", **options)
    assert _is_split(documents.filter("id > 3"), options) == split
