"""Shared steps: written intermediates, gapless numbers without one big sort, buffered groups."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headrace.session import new_dir


class Workspace:
    """Tables of one call in a fresh folder of the shared directory.

    A written table cuts lineage: any executor can read it again after a loss.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = new_dir(spark)
        self._written = 0

    def save(self, df: DataFrame, *by: str) -> DataFrame:
        """The table, written; with columns `by`, in a folder for each of their values."""
        self._written += 1
        path = f"{self.folder}/t{self._written}"
        df.write.partitionBy(*by).parquet(path)
        saved = self.spark.read.schema(df.schema).parquet(path)
        saved._workspace_path = path
        return saved

    def save_tidy(self, df: DataFrame, *by: str) -> DataFrame:
        """`save`, and the shuffle files of the write are deleted with it: nothing reads them again."""
        conf, key = self.spark.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
        before = conf.get(key, "false")
        conf.set(key, "true")
        try:
            return self.save(df, *by)
        finally:
            conf.set(key, before)

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that nothing will read again."""
        for df in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(df._workspace_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


_shipped: set[str] = set()


def ship_library(spark: SparkSession) -> None:
    """Hand this package to the Python workers of a session that does not find it installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="headrace-")) / "headrace_library.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_row_numbers(work: Workspace, docs: DataFrame) -> DataFrame:
    """Rows (_row, _number): all columns, and a number of its own for every row, written down."""
    return work.save(docs.select(F.struct("*").alias("_row"), F.monotonically_increasing_id().alias("_number")))


def hash01(*columns: Column | str) -> Column:
    """A number in [0, 1) from the columns' values, the same on every run."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 52)) / F.lit(float(1 << 52))


def numbered(df: DataFrame, group: list[str], spread: Column, order: list[Column], name: str) -> DataFrame:
    """Gapless numbers from 0 within each group, in an order of buckets and then of `order`.

    Each group is cut into buckets by `spread`; their counts (groups x buckets rows) give the
    offsets, so that no task sorts a whole group. `df` is read twice and must be stable.
    """
    buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = df.withColumn("_bucket", F.pmod(spread, F.lit(buckets)).cast("int"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (cut.groupBy(*group, "_bucket").agg(F.count("*").alias("_n"))
               .select(*group, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")))
    within = Window.partitionBy(*group, "_bucket").orderBy(*order)
    ranked = cut.withColumn("_rank", F.row_number().over(within) - 1)
    return (ranked.join(offsets, [*group, "_bucket"])
            .withColumn(name, (F.col("_offset") + F.col("_rank")).cast("long"))
            .drop("_bucket", "_rank", "_offset"))


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole groups, some at a time, from batches in which equal keys follow each other.

    A table ends where a key ends; only the last group of a batch waits for the next batch.
    """
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = [batch.column(k)[batch.num_rows - 1] for k in keys]
        first = _first_of(batch, keys, last)
        if first or (waiting and any(waiting[-1].column(k)[0] != v for k, v in zip(keys, last))):
            whole = pa.Table.from_batches([*waiting, batch.slice(0, first)])
            if whole.num_rows:
                yield whole
            waiting = []
        waiting.append(batch.slice(first))
    if waiting:
        yield pa.Table.from_batches(waiting)


def _first_of(batch: pa.RecordBatch, keys: list[str], last: list) -> int:
    """Where the run of rows equal to the last one begins."""
    low, high = 0, batch.num_rows - 1
    columns = [batch.column(k) for k in keys]
    while low < high:
        mid = (low + high) // 2
        if all(c[mid] == v for c, v in zip(columns, last)):
            high = mid
        else:
            low = mid + 1
    return low
