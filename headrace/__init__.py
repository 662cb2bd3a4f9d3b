"""Config-driven batch ingestion on Spark DataFrames."""

from headrace.plans.ingest import IngestFailed, ingest_all, ingest_object
from headrace.sources.registry import read_source, register_reader

__all__ = ["IngestFailed", "ingest_all", "ingest_object", "read_source", "register_reader"]
