"""Landing-zone intake: read delimited or JSON files with the declared feed
schema and keep malformed records instead of failing or dropping them.

A record that does not fit the schema gets NULL fields and its raw text in
the rescue column; well-formed records get NULL there.  Reading is a plain
parallel scan (one task per file split); nothing is inferred.

With ``level="field"`` columns are matched by name and only what does not fit is
rescued: unknown fields and values of the wrong type, see ``rescue``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from strata.sources.rescue import FORMATS, parse_lines, read_lines

RESCUE_COLUMN = "_rescued_data"


def with_rescue(schema: StructType, rescue: str = RESCUE_COLUMN) -> StructType:
    if rescue in schema.fieldNames():
        return schema
    return StructType(list(schema.fields) + [StructField(rescue, StringType(), True)])


def read_landing(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "csv",
    rescue: str = RESCUE_COLUMN,
    level: str = "record",
    **options: str,
) -> DataFrame:
    """Read ``path`` (file, folder or glob) in ``csv`` or ``json``; rescue whole
    records (``level="record"``) or single fields (``level="field"``, where the
    only option is ``sep``)."""
    if fmt not in FORMATS:
        raise ValueError(f"read_landing: unsupported format {fmt!r}")
    if level == "field":
        return parse_lines(read_lines(spark, path), schema, fmt, rescue, **options)
    if level != "record":
        raise ValueError(f"read_landing: unknown level {level!r}")
    reader = (
        spark.read.schema(with_rescue(schema, rescue))
        .format(fmt)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", rescue)
    )
    if fmt == "csv":
        reader = reader.option("header", "true")
    return reader.options(**options).load(path)
