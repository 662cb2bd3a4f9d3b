"""Queries over files: documents, delimited reports, file drops, landing."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headrace.catalogue.base import one_object, one_source, query, shown, table
from headrace.operators import target
from headrace.operators.landing import land, object_path
from headrace.operators.layout import load_layout
from headrace.plans.ingest import extract
from headrace.plans.metadata import adapt_reports
from headrace.session import new_dir, new_schema
from headrace.sources.file_drop import read_selected, select_files
from headrace.streaming import file_drop as drop_stream

_EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
_MICROS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
_SINCE = "ts > TIMESTAMP '2024-01-15'"


def _documents(spark: SparkSession, sf_dir: str) -> str:
    """Events as extended-JSON documents of a collection; returns the store's folder."""
    root = new_dir(spark)
    events = table(spark, sf_dir, "events")
    documents = events.select(
        F.struct(F.col("event_id").cast("string").alias("$numberLong")).alias("event_id"),
        F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("$date")).alias("ts"),
        "user_id", "event_type", "value", "props")
    documents.write.json(f"{root}/readings/events")
    return root


def _read_documents(spark: SparkSession, sf_dir: str, **obj) -> DataFrame:
    source = one_source(spark, source_id=1, source_name="Analytics", source_type="mongodb",
                        root_path=_documents(spark, sf_dir), default_collection="events")
    return extract(spark, source, one_object(
        spark, source_schema="readings", target_schema="none", target_table="bronze",
        **({"source_object_name": "__default__", "reader_options": {"schema": _EVENTS}} | obj)))


@query("SELECT * FROM events")
def document_extract(spark, sf_dir):
    return _read_documents(spark, sf_dir)


@query(f"SELECT * FROM events WHERE {_SINCE}")
def document_variant(spark, sf_dir):
    """Whole documents as VARIANT values beside a typed column for the watermark; what they hold is taken out later."""
    name = f"{new_schema(spark)}.bronze"
    rows = _read_documents(spark, sf_dir, load_type="incremental", incremental_column="ts",
                           incremental_end_value="2024-01-15T00:00:00Z",
                           reader_options={"schema": "event_id long, ts timestamp_ntz", "variant": "document"})
    target.append(rows, name)
    fields = ("user_id long", "event_type string", "value double", "props string")
    return shown(spark, name).select("event_id", "ts", *[
        F.variant_get("document", f"$.{field}", dtype).alias(field) for field, dtype in map(str.split, fields)])


@query("SELECT * FROM events")
def document_paged_extract(spark, sf_dir):
    return _read_documents(spark, sf_dir, page_column="event_type")


@query(f"""SELECT * FROM events WHERE {_SINCE} AND CAST(json_extract_string(props, '$.k') AS INTEGER) >= 50""")
def document_match_extract(spark, sf_dir):
    return _read_documents(spark, sf_dir, load_type="incremental", incremental_column="ts",
                           incremental_end_value="2024-01-15T00:00:00Z",
                           source_filter="CAST(get_json_object(props, '$.k') AS INT) >= 50")


@query("""SELECT user_id, event_type, count(*) AS n, max(ts) AS last_ts FROM events
WHERE value >= 10 GROUP BY user_id, event_type""")
def document_custom_query(spark, sf_dir):
    """The query runs verbatim: neither the watermark nor the filter is added."""
    return _read_documents(
        spark, sf_dir, source_object_name="events", load_type="incremental", incremental_column="ts",
        incremental_end_value="2024-01-15", source_filter="user_id < 0",
        custom_query="SELECT user_id, event_type, count(*) AS n, max(ts) AS last_ts FROM events "
                     "WHERE value >= 10 GROUP BY user_id, event_type")


def _report(spark: SparkSession, path: str, schema: str, **options):
    """An object adapted from a delimited-report row whose path is a full URI."""
    reports = spark.createDataFrame(
        [(1, 1, "events", f"file://{path}" if path.startswith("/") else path, "|", True, "none", "bronze", True)],
        "config_master_id int, source_system_id int, report_name string, external_path string, "
        "column_delimiter string, first_row_header boolean, bronze_sink_schema_name string, "
        "bronze_sink_table_name string, is_active boolean")
    settings = F.create_map(*[F.lit(v) for pair in ({"schema": schema} | options).items() for v in pair])
    return adapt_reports(reports, "spark_catalog").withColumn("reader_options", settings).first()


@query("SELECT * FROM events")
def delimited_extract(spark, sf_dir):
    path = new_dir(spark)
    table(spark, sf_dir, "events").write.options(header=True, sep="|", escape='"', **_MICROS).csv(path)
    source = one_source(spark, source_id=1, source_name="Reports", source_type="s3")
    return extract(spark, source, _report(spark, path, _EVENTS, escape='"', **_MICROS))


@query("SELECT *, CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN o_orderpriority || '!' END AS note FROM orders")
def delimited_second_run(spark, sf_dir):
    """The second report has its columns in another order and one more: types are the target's, none is inferred."""
    path, schema = new_dir(spark), new_schema(spark)
    orders = table(spark, sf_dir, "orders")
    source = one_source(spark, source_id=1, source_name="Reports", source_type="s3")
    obj = one_object(spark, source_path=f"{path}/report", source_object_name="orders", reader_options={"escape": '"'},
                     target_schema=schema, target_table="bronze", schema_evolution_mode="merge")
    late = F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")
    second = orders.filter(late).withColumn("note", F.concat("o_orderpriority", F.lit("!")))
    for batch in (orders.filter(~late), second.select(*reversed(second.columns))):
        batch.write.mode("overwrite").options(header=True, escape='"').csv(f"{path}/report")
        target.append(extract(spark, source, obj), f"{schema}.bronze", "merge")
    typed = {f.name: F.col(f.name).cast(f.dataType) for f in orders.schema}
    return shown(spark, f"{schema}.bronze").withColumns(typed).select(*orders.columns, "note")


@query("SELECT * FROM pages")
def delimited_multiline_extract(spark, sf_dir):
    """Whole web pages, with line breaks, delimiters and quotes inside the fields."""
    base = new_dir(spark)
    path = land(table(spark, sf_dir, "pages").select("page_id", "url", "html"), base, "web", None, "pages",
                date(2024, 1, 1), "r1", "csv")
    source = one_source(spark, source_id=1, source_name="Web", source_type="s3")
    obj = _report(spark, path, "page_id long, url string, html string", escape='"', multiLine="true")
    return extract(spark, source, obj.__class__(**(obj.asDict() | {"column_delimiter": ","})))


def _drop(spark: SparkSession, sf_dir: str, fmt: str) -> str:
    """A drop folder: one file set of a shift per event type, plus files no shift glob matches."""
    root = new_dir(spark)
    events = table(spark, sf_dir, "events")
    for kind in ("error", "view", "signup", "purchase", "click"):
        # Spark names its own files, so each set is a folder whose name carries the date role.
        prefix = "other" if kind == "error" else "shift"
        writer = events.filter(F.col("event_type") == kind).write.options(**_MICROS)
        if fmt == "csv":
            writer = writer.options(header=True, escape='"')
        writer.format(fmt).save(f"{root}/inbox/{prefix}_{kind}")
    return root


def _read_drop(spark: SparkSession, sf_dir: str, fmt: str, **reader_options) -> DataFrame:
    options = {"recursiveFileLookup": "true", **reader_options}
    source = one_source(spark, source_id=1, source_name="Files", source_type="sftp",
                        root_path=_drop(spark, sf_dir, fmt), default_pattern="*")
    return extract(spark, source, one_object(
        spark, source_schema="inbox/shift_*", source_object_name=f"part-*.{fmt}*", file_format=fmt,
        target_schema="none", target_table="bronze", reader_options=options))


_DAILY = "SELECT * FROM events WHERE event_type <> 'error'"


@query(_DAILY)
def file_drop_extract(spark, sf_dir):
    return _read_drop(spark, sf_dir, "csv", schema=_EVENTS, escape='"', **_MICROS)


@query(_DAILY)
def file_drop_json(spark, sf_dir):
    return _read_drop(spark, sf_dir, "json", schema=_EVENTS, **_MICROS)


@query(_DAILY)
def file_drop_parquet(spark, sf_dir):
    return _read_drop(spark, sf_dir, "parquet")


@query("SELECT * FROM events WHERE event_type IN ('signup', 'purchase', 'click')")
def file_drop_pending(spark, sf_dir):
    """Files a ledger already holds are not read again."""
    source = one_source(spark, source_id=1, source_name="Files", source_type="sftp",
                        root_path=_drop(spark, sf_dir, "parquet"))
    obj = one_object(spark, source_schema="inbox/*", source_object_name="part-*.parquet",
                     file_format="parquet", target_schema="none", target_table="bronze")
    files = spark.createDataFrame(select_files(spark, source, obj), "file_path string, modified timestamp")
    ledger = files.filter(F.col("file_path").rlike("shift_view|other_error"))
    return read_selected(spark, source, obj, select_files(spark, source, obj, ledger))


@query("SELECT * FROM orders")
def fixed_width_extract(spark, sf_dir):
    root = new_dir(spark)
    orders = table(spark, sf_dir, "orders")
    orders.select(F.concat(
        F.lpad(F.col("o_orderkey").cast("string"), 20, " "), F.lpad(F.col("o_custkey").cast("string"), 20, " "),
        F.rpad("o_orderstatus", 4, " "), F.rpad("o_orderpriority", 20, " "),
        F.lpad(F.col("o_totalprice").cast("string"), 24, " "),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))).write.text(f"{root}/fixed")
    source = one_source(spark, source_id=1, source_name="Files", source_type="sftp", root_path=root)
    return extract(spark, source, one_object(
        spark, source_schema="fixed", source_object_name="part-*.txt", file_format="fixed_width",
        target_schema="none", target_table="bronze",
        reader_options={"layout": "o_orderkey:20:bigint; o_custkey:20:bigint; o_orderstatus:4:string; "
                                  "o_orderpriority:20:string; "
                                  "o_totalprice:24:double; o_orderdate:19:timestamp_ntz"}))


@query("""SELECT documents.*, run_id, ingest_date
FROM documents, (VALUES ('r1', DATE '2024-01-01'), ('r2', DATE '2024-01-02')) runs(run_id, ingest_date)""")
def landing_roundtrip(spark, sf_dir):
    """Two runs land side by side; landing the first again replaces its files only."""
    base, documents = new_dir(spark), table(spark, sf_dir, "documents")
    for run, day in (("r1", date(2024, 1, 1)), ("r2", date(2024, 1, 2)), ("r1", date(2024, 1, 1))):
        land(documents, base, "Web Crawl", "raw", "documents*", day, run)
    return spark.read.parquet(object_path(base, "Web Crawl", "raw", "documents*"))


@query("""SELECT vec_id, label, unnest(range(len(embedding))) AS place, CAST(unnest(embedding) AS DOUBLE) AS value
FROM embeddings""")
def landing_nested(spark, sf_dir):
    """Nested columns pass through landing unchanged."""
    path = land(table(spark, sf_dir, "embeddings"), new_dir(spark), "vectors", None, "embeddings",
                date(2024, 1, 1), "r1")
    values = spark.read.parquet(path).select("vec_id", "label", F.posexplode("embedding").alias("place", "value"))
    return values.withColumns({"place": F.col("place").cast("long"), "value": F.col("value").cast("double")})


@query(_DAILY)
def stream_file_drop(spark, sf_dir):
    """A second run of the stream finds nothing new."""
    root, name = _drop(spark, sf_dir, "parquet"), f"{new_schema(spark)}.bronze"
    checkpoint = new_dir(spark)
    for _ in range(2):
        rows = drop_stream.read_drop_stream(spark, f"{root}/inbox/shift_*", "part-*.parquet", "parquet", _EVENTS)
        drop_stream.stream_file_drop(rows, name, checkpoint)
    return shown(spark, name)


@query("""SELECT * REPLACE (CASE WHEN event_type IN ('view', 'error') THEN value + 1 ELSE value END AS value)
FROM events""")
def stream_merge(spark, sf_dir):
    """Deliveries that update what came before them; a replay of the whole stream's last batch changes nothing."""
    root, name, checkpoint = new_dir(spark), f"{new_schema(spark)}.bronze", new_dir(spark)
    events = table(spark, sf_dir, "events")
    newer = events.filter("event_type IN ('view', 'error')").withColumn("value", F.col("value") + 1)
    for batch in (events.filter("event_type <> 'error'"), newer):
        batch.write.mode("append").parquet(f"{root}/drop")
        rows = drop_stream.read_drop_stream(spark, f"{root}/drop", "part-*.parquet", "parquet", _EVENTS)
        drop_stream.stream_file_drop(rows, name, checkpoint, keys=["event_id"])
    stream, number = next(iter(load_layout(spark, name).applied.items()))
    target.merge(events, name, ["event_id"], batch_of=(stream, number))
    return shown(spark, name)
