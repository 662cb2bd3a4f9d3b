"""Which reader serves which source type."""

from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession

from headrace.sources.delimited import read_delimited
from headrace.sources.documents import read_documents
from headrace.sources.file_drop import read_file_drop
from headrace.sources.relational import read_relational

Reader = Callable[[SparkSession, Row, Row], DataFrame]

# The source types a metadata row may name.
_RELATIONAL = ("POSTGRES", "POSTGRESQL", "PG", "MYSQL", "ORACLE", "MSSQL", "SQLSERVER")
_DOCUMENT = ("MONGODB", "MONGO")

_readers: dict[str, Reader] = {
    **dict.fromkeys(_RELATIONAL, read_relational),
    **dict.fromkeys(_DOCUMENT, read_documents),
    "SFTP": read_file_drop,
    "S3": read_delimited,
}


def register_reader(source_type: str, reader: Reader) -> None:
    """Serve a source type with ``reader(spark, source, obj) -> DataFrame``."""
    _readers[source_type.upper()] = reader


def read_source(spark: SparkSession, source: Row, obj: Row) -> DataFrame:
    """The object's rows, before the incremental predicate."""
    reader = _readers.get(source.source_type.upper())
    if reader is None:
        raise ValueError(f"no reader for source_type {source.source_type!r}; known: {sorted(_readers)}")
    return reader(spark, source, obj)
