"""Small driver-side rows as frames."""

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def small_frame(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """Metadata-sized rows as a local relation, which needs no job and no Python worker.

    Fields a row lacks are NULL.
    """
    fields = T.StructType.fromDDL(schema)
    plain = [{f.name: list(v.items()) if isinstance(v := row.get(f.name), dict) else v for f in fields}
             for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(plain, schema=to_arrow_schema(fields)), fields)
