"""Queries over relational objects: full, custom-query and incremental reads."""

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headrace.catalogue.base import CATALOG_SOURCE, one_object, one_source, query, schema_with, table
from headrace.operators import target
from headrace.operators.incremental import resolve_watermark, with_metrics
from headrace.operators.landing import land
from headrace.plans.ingest import extract
from headrace.session import new_dir, new_schema, single_process


def _read(spark: SparkSession, sf_dir: str, names: tuple[str, ...], **obj) -> DataFrame:
    """What a run on a catalog source reads for an object."""
    schema = schema_with(spark, sf_dir, *names)
    settings = {"source_schema": schema, "target_schema": schema, "target_table": "bronze"} | obj
    if "custom_query" in obj:
        settings["custom_query"] = obj["custom_query"].format(schema=schema)
    return extract(spark, one_source(spark, **CATALOG_SOURCE), one_object(spark, **settings))


@query("SELECT * FROM lineitem")
def full_extract(spark, sf_dir):
    return _read(spark, sf_dir, ("lineitem",), source_object_name="lineitem")


@query("SELECT c.*, n.n_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey")
def custom_query_extract(spark, sf_dir):
    return _read(
        spark, sf_dir, ("customer", "nation"), source_object_name="customers", source_object_type="query",
        custom_query="SELECT c.*, n.n_name FROM {schema}.customer c "
                     "JOIN {schema}.nation n ON c.c_nationkey = n.n_nationkey")


@query("""SELECT * FROM (SELECT o.*, c.c_mktsegment FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)
WHERE o_orderdate > TIMESTAMP '2000-06-30' AND c_mktsegment <> 'BUILDING'""")
def custom_query_incremental(spark, sf_dir):
    return _read(
        spark, sf_dir, ("orders", "customer"), source_object_name="orders", load_type="incremental",
        custom_query="SELECT o.*, c.c_mktsegment FROM {schema}.orders o "
                     "JOIN {schema}.customer c ON o.o_custkey = c.c_custkey",
        source_filter="c_mktsegment != 'BUILDING'", incremental_column="o_orderdate",
        incremental_end_value="2000-06-30 00:00:00")


@query("SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '2001-01-01' AND o_orderstatus <> 'P'")
def incremental_extract(spark, sf_dir):
    return _read(spark, sf_dir, ("orders",), source_object_name="orders", load_type="incremental",
                 source_filter="o_orderstatus != 'P'", incremental_column="o_orderdate",
                 incremental_end_value="2001-01-01 00:00:00")


@query("SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1970-01-01'")
def incremental_initial_value(spark, sf_dir):
    return _read(spark, sf_dir, ("orders",), source_object_name="orders", load_type="incremental",
                 incremental_column="o_orderdate", incremental_end_value="1970-01-01T00:00:00Z")


@query("""SELECT * FROM orders WHERE o_orderdate >
(SELECT max(o_orderdate) FROM orders WHERE o_orderdate <= TIMESTAMP '2001-07-01') - INTERVAL 172800 SECOND""")
def incremental_with_lag(spark, sf_dir):
    """Two days before the newest row of the target are read again."""
    schema = schema_with(spark, sf_dir, "orders")
    target.append(spark.table(f"{schema}.orders").filter("o_orderdate <= TIMESTAMP_NTZ '2001-07-01'"),
                  f"{schema}.bronze", watermark_column="o_orderdate")
    obj = one_object(spark, source_schema=schema, source_object_name="orders", target_schema=schema,
                     target_table="bronze", load_type="incremental", write_mode="merge",
                     primary_key_cols="o_orderkey", incremental_column="o_orderdate",
                     incremental_end_value="1970-01-01", watermark_lag_sec=172800)
    return extract(spark, one_source(spark, **CATALOG_SOURCE), obj)


@query("SELECT o.*, CAST(o_totalprice AS VARCHAR) AS price_text FROM orders o WHERE o_totalprice > 99999.5")
def numeric_watermark(spark, sf_dir):
    """Numbers kept as text compare as numbers, as the declared type says."""
    return _read(spark, sf_dir, ("orders",), source_object_name="orders", load_type="incremental",
                 custom_query="SELECT o.*, CAST(o_totalprice AS STRING) AS price_text FROM {schema}.orders o",
                 incremental_column="price_text", incremental_column_type="double",
                 incremental_end_value="99999.5")


@query("SELECT max(o_orderdate) AS watermark FROM orders WHERE o_orderstatus = 'F'")
def watermark_from_target(spark, sf_dir):
    name = f"{new_schema(spark)}.bronze"
    target.append(table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'"), name)
    found = resolve_watermark(spark, name, "o_orderdate", initial="1970-01-01")
    return spark.range(1).select(F.lit(found).cast("timestamp_ntz").alias("watermark"))


def _observed(spark: SparkSession, rows: DataFrame, column: str, name: str) -> DataFrame:
    """Metrics of a batch, taken while it is landed."""
    observed, metrics = with_metrics(rows, column)
    land(observed, new_dir(spark), "sales", None, name, date(2024, 1, 1), uuid.uuid4().hex)
    seen = metrics.get
    return spark.range(1).select(F.lit(name).alias("batch"), F.lit(seen["rows"]).cast("long").alias("rows"),
                                 F.lit(seen["watermark"]).cast("timestamp_ntz").alias("watermark"))


@query("SELECT max(l_shipdate) AS watermark FROM lineitem")
def batch_watermark(spark, sf_dir):
    return _observed(spark, table(spark, sf_dir, "lineitem"), "l_shipdate", "lineitem").select("watermark")


@query("""SELECT 'all' AS batch, count(*) AS rows, max(ts) AS watermark FROM events
UNION ALL SELECT 'none', 0, NULL""")
def batch_metrics(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return _observed(spark, events, "ts", "all").unionByName(
        _observed(spark, events.filter("event_id IS NULL"), "ts", "none"))


def _to_derby(rows: DataFrame, name: str, types: str) -> dict[str, str]:
    """Copy rows to an in-memory database of this process and return its read options.

    Only the process that made such a database sees it, so these queries need local[n].
    Against a server the reader is the same with another url.
    """
    spark = rows.sparkSession
    if not single_process(spark):
        raise ValueError("the embedded database is visible to one process only: use local[n]")
    options = {"url": f"jdbc:derby:memory:hr_{uuid.uuid4().hex[:12]};create=true",
               "driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    for field in rows.schema:
        if field.dataType.simpleString() == "timestamp_ntz":
            rows = rows.withColumn(field.name, F.col(field.name).cast("timestamp"))
    rows.write.format("jdbc").options(**options, dbtable=name, createTableColumnTypes=types,
                                      batchsize="10000").save()
    return options | {"preferTimestampNTZ": "true"}


def _read_derby(spark: SparkSession, options: dict[str, str], **obj) -> DataFrame:
    source = one_source(spark, source_id=1, source_name="Sales", source_type="oracle", options=options)
    return extract(spark, source, one_object(spark, target_schema="none", target_table="bronze", **obj))


@query("SELECT * FROM supplier")
def jdbc_roundtrip(spark, sf_dir):
    options = _to_derby(table(spark, sf_dir, "supplier"), "supplier", "s_name VARCHAR(64)")
    return _read_derby(spark, options, source_object_name="supplier", data_read_size=50000)


@query("SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '2000-01-01' AND o_orderstatus <> 'P'")
def jdbc_incremental_extract(spark, sf_dir):
    """The static filter runs in the database; Spark pushes the watermark down to it."""
    options = _to_derby(table(spark, sf_dir, "orders"), "orders",
                        "o_orderstatus VARCHAR(8), o_orderpriority VARCHAR(32)")
    return _read_derby(spark, options, source_object_name="orders", load_type="incremental",
                       source_filter="\"o_orderstatus\" <> 'P'", incremental_column="o_orderdate",
                       incremental_end_value="2000-01-01 00:00:00", data_read_size=50000)


@query("SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-25' AND event_type <> 'error'")
def jdbc_incremental_paged_extract(spark, sf_dir):
    """Four pages between bounds above the watermark, so that no page is empty by design."""
    options = _to_derby(table(spark, sf_dir, "events"), "events",
                        "event_type VARCHAR(32), props VARCHAR(256)")
    return _read_derby(spark, options | {"pages": "4"}, source_object_name="events", load_type="incremental",
                       source_filter="\"event_type\" <> 'error'", incremental_column="ts",
                       incremental_end_value="2024-01-25 00:00:00", page_column='"event_id"')


@query("""SELECT o.*, CAST(o_totalprice AS VARCHAR) AS price_text FROM orders o
WHERE o_totalprice > 99999.5 AND o_orderstatus <> 'P'""")
def jdbc_text_watermark(spark, sf_dir):
    """Numbers kept as text: the database converts and compares them."""
    orders = table(spark, sf_dir, "orders").withColumn("price_text", F.col("o_totalprice").cast("string"))
    options = _to_derby(orders, "orders",
                        "o_orderstatus VARCHAR(8), o_orderpriority VARCHAR(32), price_text VARCHAR(32)")
    return _read_derby(spark, options, source_object_name="orders", load_type="incremental",
                       source_filter="\"o_orderstatus\" <> 'P'", incremental_column="price_text",
                       incremental_column_type="double", incremental_end_value="99999.5")


@query("SELECT * FROM customer")
def jdbc_text_key_pages(spark, sf_dir):
    """Pages of one size on a text key, between quantiles the database finds."""
    options = _to_derby(table(spark, sf_dir, "customer"), "customer", "c_name VARCHAR(64), c_mktsegment VARCHAR(32)")
    return _read_derby(spark, options | {"pages": "4"}, source_object_name="customer", primary_key_cols="c_name,c_custkey")


@query("SELECT * FROM events")
def paged_extract(spark, sf_dir):
    """Four range pages over the key, read in parallel between bounds the database finds."""
    options = _to_derby(table(spark, sf_dir, "events"), "events",
                        "event_type VARCHAR(32), props VARCHAR(256)")
    return _read_derby(spark, options | {"pages": "4"}, source_object_name="events",
                       page_column='"event_id"')
