"""Raw landing: one folder per object, day and run."""

import re
from datetime import date

from pyspark.sql import DataFrame

FORMATS = ("parquet", "json", "csv")

# Layouts of source files that nothing is written in; their rows land as Parquet.
_READ_ONLY = ("fixed_width", "fixedwidth")

# Full precision; the text formats' defaults stop at milliseconds.
_TEXT_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _folder(name: str) -> str:
    """A name that is safe as one folder."""
    return re.sub(r"[^A-Za-z0-9_.-]", "_", name).replace("..", "__")


def landing_format(file_format: str | None) -> str:
    """The object's format, Parquet by default; one that cannot be landed in is refused."""
    fmt = (file_format or "parquet").lower()
    if fmt not in (*FORMATS, *_READ_ONLY):
        raise ValueError(f"rows cannot land as {file_format!r}; supported: {', '.join(FORMATS)}")
    return fmt if fmt in FORMATS else "parquet"


def object_path(base: str, source_name: str, source_schema: str | None, object_name: str) -> str:
    names = [n for n in (source_name, source_schema, object_name) if n]
    return "/".join([base.rstrip("/"), *map(_folder, names)])


def land(df: DataFrame, base: str, source_name: str, source_schema: str | None, object_name: str,
         ingest_date: date, run_id: str, file_format: str | None = None) -> str:
    """Write the batch and return its folder. A retry of the same run replaces its files."""
    fmt = landing_format(file_format)
    path = (f"{object_path(base, source_name, source_schema, object_name)}"
            f"/ingest_date={ingest_date:%Y-%m-%d}/run_id={run_id}")
    writer = df.write.format(fmt).mode("overwrite")
    if fmt != "parquet":
        writer = writer.options(**_TEXT_OPTIONS)
    if fmt == "csv":
        # Quotes are doubled and blanks kept, so that any text survives.
        writer = writer.options(header=True, escape='"', ignoreLeadingWhiteSpace=False,
                                ignoreTrailingWhiteSpace=False)
    writer.save(path)
    return path
