"""File drops: the files of a folder that match a glob, each consumed once."""

import re

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headrace.sources.delimited import known_columns, read_csv

# Format names, glob characters of a name, and the filter that keeps files unconsumed.
FORMATS = ("csv", "json", "parquet", "fixed_width")
_GLOB = set("*?[]")
KEEP = "no_archive"

# What Spark's own writers leave beside their files.
_MARKERS = re.compile(r"_SUCCESS|_temporary|_(started|committed)_.*|\..*\.crc")

# Files by the number of the write that took them in; it is the target that says which numbers it has.
LEDGER_SCHEMA = "file_path string, modified timestamp, run_id string, object_key string, number int"


def drop_directory(root: str | None, schema: str | None) -> str:
    folder = (root or "/").rstrip("/")
    return f"{folder}/{schema.strip('/')}" if schema else folder


def drop_pattern(name: str | None, default: str | None) -> str:
    """The object's own glob or literal file name; else the source's pattern; else all files."""
    if name and (_GLOB & set(name) or "." in name):
        return name
    return default or "*"


def list_files(spark: SparkSession, directory: str, pattern: str) -> DataFrame:
    """Path and modification time of the matching files; no content is read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(directory)
            .select(F.col("path").alias("file_path"), F.col("modificationTime").alias("modified")))


def hidden_files(spark: SparkSession, directory: str, pattern: str) -> list[str]:
    """Files the glob asks for that Spark's readers would skip: their names begin with ``_`` or a dot."""
    if pattern[0] not in "_.*?[{":
        return []
    fs = spark._jvm.org.apache.hadoop.fs
    place, wanted = fs.Path(f"{directory}/[._]*"), fs.GlobFilter(pattern)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place) or []
    return sorted(f.getPath().toString() for f in found if f.isFile() and wanted.accept(f.getPath())
                  and not _MARKERS.fullmatch(f.getPath().getName()))


def literal_path(path: str) -> str:
    """A path whose glob characters stand for themselves."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def pending_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files the ledger does not hold. A file delivered again under its old name is new."""
    return files.join(ledger.select("file_path", "modified"), ["file_path", "modified"], "left_anti")


def cut_lines(lines: DataFrame, layout: str) -> DataFrame:
    """Lines cut by position. ``layout`` is ``name:width:type`` fields, ``;`` between them."""
    columns, start = [], 1
    for field in layout.split(";"):
        name, width, dtype = (p.strip() for p in field.split(":", 2))
        text = F.trim(F.substring("value", start, int(width)))
        columns.append(F.when(text != "", text).cast(T.DataType.fromDDL(dtype)).alias(name))
        start += int(width)
    return lines.select(*columns)


def read_files(spark: SparkSession, paths, file_format: str | None, schema: str | None = None,
               layout: str | None = None, known: T.StructType | None = None, **options) -> DataFrame:
    """Load files of one of the known formats; `known` gives types to CSV columns, see ``read_csv``."""
    fmt = (file_format or "csv").lower().replace("fixedwidth", "fixed_width")
    if fmt not in FORMATS:
        raise ValueError(f"unsupported file_format {file_format!r}; supported: {', '.join(FORMATS)}")
    if fmt == "csv":
        return read_csv(spark, paths, schema=schema, known=known, **options)
    if fmt == "fixed_width":
        if layout:
            return cut_lines(spark.read.text(paths), layout)
        return read_csv(spark, paths, header=False, schema=schema, **options)
    reader = spark.read.option("mode", "FAILFAST").options(**options)
    if schema:
        reader = reader.schema(schema)
    return reader.json(paths) if fmt == "json" else reader.parquet(*([paths] if isinstance(paths, str) else paths))


def refuse_hidden(spark: SparkSession, directory: str, pattern: str) -> None:
    if hidden := hidden_files(spark, directory, pattern):
        raise ValueError(f"{pattern!r} matches files Spark does not read, by their names: {hidden[:20]}")


def select_files(spark: SparkSession, source: Row, obj: Row, ledger: DataFrame | None = None) -> list[Row]:
    """The files a run reads. Like Spark's own file index, the list is driver metadata."""
    directory = drop_directory(source.root_path, obj.source_schema)
    pattern = drop_pattern(obj.source_object_name, source.default_pattern)
    refuse_hidden(spark, directory, pattern)
    files = list_files(spark, directory, pattern)
    if ledger is not None and consumes(obj):
        files = pending_files(files, ledger)
    found = files.collect()
    if not found:
        raise FileNotFoundError(f"no unread file matches {pattern!r} in {directory}")
    return found


def consumes(obj: Row) -> bool:
    """Whether the object reads each file once."""
    return (obj.source_filter or "").strip().lower() != KEEP


def read_selected(spark: SparkSession, source: Row, obj: Row, files: list[Row]) -> DataFrame:
    """The chosen files in the object's format, else the source's, else CSV."""
    file_format = obj.file_format or (source.options or {}).get("file_format")
    options = dict(obj.reader_options or {})
    known = None if "schema" in options or "layout" in options else known_columns(spark, obj)
    return read_files(spark, [literal_path(f.file_path) for f in files], file_format, known=known, **options)


def read_file_drop(spark: SparkSession, source: Row, obj: Row) -> DataFrame:
    """All matching files, without a ledger."""
    return read_selected(spark, source, obj, select_files(spark, source, obj))
