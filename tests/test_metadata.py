import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from headrace.catalogue.base import objects_frame, one_object, sources_frame
from headrace.functions.values import key_list
from headrace.plans.ingest import extract
from headrace.plans.metadata import (adapt_reports, discover, normalise_sources, object_by_id, source_by_id,
                                     target_name)


@pytest.fixture(scope="module")
def sources(spark):
    return sources_frame(spark, {"source_id": 0, "source_name": "Zero", "source_type": "pg"},
                         {"source_id": 1, "source_name": "One", "source_type": "mysql", "is_active": False})


@pytest.fixture(scope="module")
def objects(spark):
    return objects_frame(spark, {"ingestion_object_id": 5, "source_system_id": 0},
                         {"ingestion_object_id": 6, "source_system_id": 1},
                         {"ingestion_object_id": 7, "source_system_id": 0, "is_enabled": False})


def test_lookups(sources, objects):
    assert source_by_id(sources, 0).source_type == "PG"
    with pytest.raises(ValueError, match="no active source"):
        source_by_id(sources, 1)
    assert object_by_id(objects, 7).write_mode == "append"
    with pytest.raises(ValueError, match="no object"):
        object_by_id(objects, 8)


def test_id_zero_is_a_filter_and_inactive_sources_never_count(sources, objects):
    def ids(**chosen):
        return [r.ingestion_object_id for r in discover(objects, sources, **chosen).collect()]
    assert ids() == ids(source_id=0) == ids(source_name="zero") == [5]
    assert ids(source_id=1) == []


def test_a_quote_in_a_name_is_only_text(sources, objects):
    assert discover(objects, sources, source_name="O'Neil", pipeline_name="' OR 1=1 --").count() == 0


def test_activity_defaults(spark):
    rows = spark.createDataFrame([(1, "a", "pg")], "source_id long, source_name string, source_type string")
    assert normalise_sources(rows).first().is_active
    assert not normalise_sources(rows.withColumn("is_active", F.lit(None).cast("boolean"))).first().is_active


def test_key_list(spark):
    df = spark.createDataFrame([(" a, b ,,",), ("",), (None,)], "k string").select(key_list(F.col("k")).alias("k"))
    assert [r.k for r in df.collect()] == [["a", "b"], None, None]


def test_a_report_without_bucket_fails_when_read(spark, sources):
    report = adapt_reports(spark.createDataFrame([(3, 0, "daily", "x.csv")],
                           "config_master_id int, source_system_id int, report_name string, external_path string"),
                           "spark_catalog")
    source = sources_frame(spark, {"source_id": 0, "source_name": "S", "source_type": "s3"}).first()
    with pytest.raises(ValueError, match="neither a full path nor a bucket"):
        extract(spark, source, report.first())


def test_target_name(spark):
    assert target_name(one_object(spark, target_schema="b", target_table="t")) == "b.t"
    assert target_name(one_object(spark, target_catalog="spark_catalog", target_schema="b", target_table="t")) == "b.t"
    assert target_name(one_object(spark, target_catalog="main", target_schema="b", target_table="t")) == "main_b.t"


def test_other_column_names(spark):
    rows = spark.createDataFrame(
        [(1, "a", "oracle", "jdbc:x", "d.Driver", "db", "/up", "*.csv", "events", '{"authSource": "admin", "url": "jdbc:y"}'),
         (2, "b", "sftp", None, None, None, None, None, None, None)],
        "source_id long, source_name string, source_type string, connection_uri string, driver_class string, "
        "database_name string, sftp_root_path string, sftp_file_pattern string, nosql_collection_name string, "
        "extra_params string")
    one, two = normalise_sources(rows).orderBy("source_id").collect()
    assert one.options == {"authSource": "admin", "url": "jdbc:y", "driver": "d.Driver", "database": "db"}
    assert (one.root_path, one.default_pattern, one.default_collection) == ("/up", "*.csv", "events")
    assert two.options == {} and two.root_path is None


@pytest.mark.parametrize("names", [(None, "t"), ("s", None), ("", "t")])
def test_target_needs_names(names):
    obj = Row(ingestion_object_id=1, target_catalog=None, target_schema=names[0], target_table=names[1])
    with pytest.raises(ValueError, match="names no target"):
        target_name(obj)
