"""Metadata tables as DataFrames: schemas, defaults, discovery, delimited reports."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headrace.functions.values import key_list

SOURCE_SCHEMA = """source_id long, source_name string, source_type string, ingest_method string,
options map<string,string>, root_path string, default_pattern string, default_collection string,
is_active boolean"""

OBJECT_SCHEMA = """ingestion_object_id long, source_system_id long, source_system_name string,
source_schema string, source_object_name string, source_object_type string, custom_query string,
source_filter string, load_type string, write_mode string, incremental_column string,
incremental_column_type string, incremental_end_value string, watermark_lag_sec int,
primary_key_cols string, page_column string, partition_column string, data_read_size long,
file_format string, reader_options map<string,string>, target_catalog string, target_schema string,
target_table string, delta_layer string, target_medallion_layer string,
schema_evolution_mode string, pipeline_name string, source_path string, column_delimiter string,
first_row_header boolean, landing_path string, is_enabled boolean, key_columns array<string>"""

REPORT_SCHEMA = """config_master_id int, source_system_id int, report_name string, key_column string,
source_name string, source_bucket_name string, external_path string, load_type string,
raw_sink_bucket_name string, raw_sink_file_path string, column_delimiter string,
first_row_header boolean, bronze_sink_schema_name string, bronze_sink_table_name string,
is_active boolean, pipeline_name string"""

# Defaults of the metadata columns.
DEFAULT_METHOD = "JDBC"
DEFAULT_OBJECT_TYPE = "TABLE"
DEFAULT_LOAD = "FULL"
DEFAULT_MODE = "append"
DEFAULT_LAYER = "BRONZE"
REPORT_PIPELINE = "s3_ingestion"


# Other names the columns go by, and columns that are reader options.
_ALIASES = {"root_path": ("sftp_root_path",), "default_pattern": ("sftp_file_pattern",),
            "default_collection": ("nosql_collection_name", "nosql_collection")}
_OPTION_COLUMNS = {"url": ("connection_uri",), "driver": ("driver_class",),
                   "database": ("database_name", "nosql_database"), "file_format": ("sftp_file_format",)}


def conform(df: DataFrame, schema: str) -> DataFrame:
    """Exactly the schema's columns, in order; absent ones are NULL."""
    have = set(df.columns)

    def column(name: str) -> Column:
        known = [F.col(n) for n in (name, *_ALIASES.get(name, ())) if n in have]
        return F.coalesce(*known) if known else F.lit(None)

    return df.select(*[column(f.name).cast(f.dataType).alias(f.name)
                       for f in T.StructType.fromDDL(schema).fields])


def _reader_options(sources: DataFrame) -> Column:
    """``options``, else the JSON of ``extra_params``; then whatever columns of their own add."""
    have = set(sources.columns)
    maps = [F.col("options")] if "options" in have else []
    if "extra_params" in have:
        maps.append(F.from_json("extra_params", "map<string,string>"))
    given = F.coalesce(*maps, F.create_map().cast("map<string,string>"))
    own = {option: [F.col(c).cast("string") for c in columns if c in have]
           for option, columns in _OPTION_COLUMNS.items()}
    own = {option: F.coalesce(*columns) for option, columns in own.items() if columns}
    if not own:
        return given
    more = F.map_from_arrays(F.array(*map(F.lit, own)), F.array(*own.values()))
    return F.map_concat(given, F.map_filter(
        more, lambda option, value: value.isNotNull() & ~F.map_contains_key(given, option)))


def _default(name: str, value) -> Column:
    return F.coalesce(F.col(name), F.lit(value))


def normalise_sources(sources: DataFrame) -> DataFrame:
    """Upper-case types, JDBC as the default method; without an activity column all are active."""
    if "is_active" not in sources.columns:
        sources = sources.withColumn("is_active", F.lit(True))
    sources = sources.withColumn("options", _reader_options(sources))
    return conform(sources, SOURCE_SCHEMA).withColumns({
        "source_type": F.upper("source_type"),
        "ingest_method": F.upper(_default("ingest_method", DEFAULT_METHOD)),
        "is_active": _default("is_active", False),
    })


def normalise_objects(objects: DataFrame) -> DataFrame:
    """Defaults and letter case of every object column the engine branches on."""
    return conform(objects, OBJECT_SCHEMA).withColumns({
        "source_object_type": F.upper(_default("source_object_type", DEFAULT_OBJECT_TYPE)),
        "load_type": F.upper(_default("load_type", DEFAULT_LOAD)),
        "write_mode": F.lower(_default("write_mode", DEFAULT_MODE)),
        "schema_evolution_mode": F.lower(_default("schema_evolution_mode", "none")),
        "delta_layer": F.upper(F.coalesce("delta_layer", "target_medallion_layer", F.lit(DEFAULT_LAYER))),
        "is_enabled": _default("is_enabled", True),
        "key_columns": key_list(F.col("primary_key_cols")),
    })


def _set(name: str) -> Column:
    """A text that is neither NULL nor empty."""
    return F.col(name).isNotNull() & (F.col(name) != "")


def _strip(name: str, pattern: str) -> Column:
    return F.regexp_replace(F.col(name), pattern, "")


def adapt_reports(reports: DataFrame, target_catalog: str) -> DataFrame:
    """Delimited reports as objects: CSV files, merged if they have a key, else appended."""
    path = F.trim(F.coalesce("external_path", F.lit("")))
    return normalise_objects(conform(reports, REPORT_SCHEMA).select(
        F.col("config_master_id").cast("long").alias("ingestion_object_id"),
        F.col("source_system_id").cast("long").alias("source_system_id"),
        F.col("source_name").alias("source_system_name"),
        F.col("report_name").alias("source_object_name"),
        F.lit("FILE").alias("source_object_type"),
        F.when(_set("load_type"), F.col("load_type")).alias("load_type"),
        F.when(_set("key_column"), "merge").otherwise("append").alias("write_mode"),
        F.col("key_column").alias("primary_key_cols"),
        F.lit("csv").alias("file_format"),
        F.lit(target_catalog).alias("target_catalog"),
        F.col("bronze_sink_schema_name").alias("target_schema"),
        F.col("bronze_sink_table_name").alias("target_table"),
        F.lit(DEFAULT_LAYER).alias("delta_layer"),
        F.when(_set("pipeline_name"), F.col("pipeline_name")).otherwise(REPORT_PIPELINE).alias("pipeline_name"),
        F.when(path.rlike("^[a-z][a-z0-9+.-]*://"), path)
         .when(_set("source_bucket_name"),
               F.concat(F.lit("s3://"), _strip("source_bucket_name", "^/+|/+$"), F.lit("/"),
                        F.regexp_replace(path, "^/+", ""))).alias("source_path"),
        "column_delimiter",
        "first_row_header",
        F.when(_set("raw_sink_bucket_name") & _set("raw_sink_file_path"),
               F.concat(F.lit("s3://"), _strip("raw_sink_bucket_name", "^/+|/+$"), F.lit("/"),
                        _strip("raw_sink_file_path", "^/+|/+$"))).alias("landing_path"),
        _default("is_active", False).alias("is_enabled"),
    ))


def discover(objects: DataFrame, sources: DataFrame, source_type: str | None = None,
             source_id: int | None = None, source_name: str | None = None,
             pipeline_name: str | None = None) -> DataFrame:
    """Enabled objects of active sources; the given filters are ANDed.

    Both inputs are normalised frames. A semi join cannot multiply objects, whatever the
    source table holds; Spark broadcasts the sources if their size allows.
    """
    chosen = sources.filter("is_active")
    if source_id is not None:
        chosen = chosen.filter(F.col("source_id") == source_id)
    if source_type is not None:
        chosen = chosen.filter(F.col("source_type") == source_type.upper())
    if source_name is not None:
        chosen = chosen.filter(F.lower("source_name") == source_name.lower())
    wanted = objects.filter("is_enabled")
    if pipeline_name is not None:
        wanted = wanted.filter(F.col("pipeline_name") == pipeline_name)
    return wanted.join(chosen.select(F.col("source_id").alias("source_system_id")),
                       "source_system_id", "left_semi").select(*objects.columns)


def discover_reports(reports: DataFrame, target_catalog: str, source_type: str | None = None,
                     source_id: int | None = None, source_name: str | None = None,
                     pipeline_name: str | None = None) -> DataFrame:
    """Active delimited reports; the name is the report table's own."""
    chosen = adapt_reports(reports, target_catalog).filter("is_enabled")
    if source_type is not None and source_type.upper() != "S3":
        return chosen.filter(F.lit(False))
    if source_id is not None:
        chosen = chosen.filter(F.col("source_system_id") == source_id)
    if source_name is not None:
        chosen = chosen.filter(F.lower("source_system_name") == source_name.lower())
    if pipeline_name is not None:
        chosen = chosen.filter(F.col("pipeline_name") == pipeline_name)
    return chosen


def source_by_id(sources: DataFrame, source_id: int):
    """One active source."""
    row = sources.filter((F.col("source_id") == source_id) & F.col("is_active")).first()
    if row is None:
        raise ValueError(f"no active source with source_id={source_id}")
    return row


def object_by_id(objects: DataFrame, object_id: int):
    """One object, enabled or not."""
    row = objects.filter(F.col("ingestion_object_id") == object_id).first()
    if row is None:
        raise ValueError(f"no object with ingestion_object_id={object_id}")
    return row


def target_name(obj) -> str:
    """Where the object lands in the session catalog, whose names have two levels.

    Another catalog's name becomes a prefix of the schema's.
    """
    catalog = obj.target_catalog
    schema = obj.target_schema
    if not schema or not obj.target_table:
        raise ValueError(f"object {obj.ingestion_object_id} names no target schema or table")
    if catalog and catalog != "spark_catalog":
        schema = f"{catalog}_{schema}"
    return f"{schema}.{obj.target_table}"
