"""Where this library may write: the shared folder the cluster names."""

import tempfile
import uuid

from pyspark.sql import SparkSession

# Folders made for local sessions that name none, by application.
_local: dict[str, str] = {}


def single_process(spark: SparkSession) -> bool:
    """Whether driver and executors are one process."""
    master = spark.conf.get("spark.master", "")
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; one of our own only for an unset, local session."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _local:
        _local[context.applicationId] = tempfile.mkdtemp(prefix="headrace-")
    return _local[context.applicationId]


def new_dir(spark: SparkSession) -> str:
    """A fresh folder name below the shared one."""
    return f"{shared_dir(spark)}/hr_{uuid.uuid4().hex[:12]}"


def new_schema(spark: SparkSession) -> str:
    """A fresh catalog schema whose tables live in the shared folder."""
    name = f"hr_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{shared_dir(spark)}/{name}'")
    return name
