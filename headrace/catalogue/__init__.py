"""One query per operator, over the test tables, with the SQL that must agree."""

from headrace.catalogue import audit, bronze, files, metadata, relational, runs
from headrace.catalogue.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "audit", "bronze", "files", "metadata", "relational", "runs"]
