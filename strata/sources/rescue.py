"""Field-level rescue: landing records parsed by field name, nothing lost.

Landing files of JSON lines or CSV (with a header line each) are read as lines of
text.  Every record becomes a map of field names to texts, and the declared
columns are cast out of that map one by one.  What no declared column takes goes to
the rescue column:

* fields that the schema does not declare, and values that do not fit their
  declared type (that column is NULL, the others keep their values), as one JSON
  object of texts, in the record's own order;
* a record that cannot be parsed at all, as its raw text, with all columns NULL.

CSV columns are matched by each file's own header, so added, missing and
reordered columns of single files are told apart.  Cells beyond the header are
rescued as ``_c<place>``, and a repeated header name gets ``#<place>``.  A data line
equal to its file's header counts as a header.  Empty CSV cells are NULL.

Scale: JSON is one map over the scan.  CSV reads the headers first (one row per
file, an aggregate over the first block of each file) and joins them by file; the
planner broadcasts them below its measured threshold.  Only the greatest
number of header cells reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, StructType

LINE, FILE, START, PLACE = "_line", "_file", "_start", "_place"
EXTRA_CELLS = 16  # cells beyond the longest header that are told apart
END = "\x01end\x02"  # marks the end of a CSV line's cells
FORMATS = ("csv", "json")


def with_origin(text: DataFrame) -> DataFrame:
    """Lines of a ``text`` source (batch or stream) with file and place."""
    return text.select(
        F.col("value").alias(LINE),
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(START),
    ).where(F.trim(LINE) != "")


def with_place(lines: DataFrame) -> DataFrame:
    """Lines numbered in reading order (needed for CSV headers)."""
    return lines.withColumn(PLACE, F.monotonically_increasing_id())


def parse_lines(lines: DataFrame, schema: StructType, fmt: str, rescue: str, sep: str = ",") -> DataFrame:
    """The declared columns and ``rescue`` from lines as ``with_origin`` gives."""
    if fmt not in FORMATS:
        raise ValueError(f"parse_lines: unsupported format {fmt!r}")
    fields = [f for f in schema.fields if f.name != rescue]
    if fmt == "json":
        parsed = lines.withColumn(
            "_fields",
            F.when(
                F.expr(f"try_parse_json({LINE})").isNotNull(),
                F.from_json(LINE, "map<string,string>"),
            ),
        )
    else:
        parsed = _csv_fields(lines, sep)
    m = F.col("_fields")
    typed = [_typed(m, f).alias(f.name) for f in fields]
    misfit = F.array_compact(
        F.array(*(F.when(F.try_element_at(m, F.lit(f.name)).isNotNull() & _typed(m, f).isNull(), f.name) for f in fields))
    )
    declared = F.array(*(F.lit(f.name) for f in fields))
    unknown_null = fmt == "json"  # an empty cell holds nothing to rescue
    rest = F.map_filter(
        m,
        lambda k, v: (~F.array_contains(declared, k) & (F.lit(unknown_null) | v.isNotNull()))
        | F.array_contains(misfit, k),
    )
    kept = F.when(m.isNull(), F.col(LINE)).when(F.size(rest) > 0, F.to_json(rest))
    return parsed.select(*typed, kept.alias(rescue))


def _typed(m: Column, field) -> Column:
    text = F.try_element_at(m, F.lit(field.name))
    if isinstance(field.dataType, AtomicType):
        return text.try_cast(field.dataType)
    return F.from_json(text, field.dataType)


def _cells(line: Column, width: int, sep: str) -> Column:
    """Cells of a CSV line; NULL if it does not parse or has over ``width``."""
    names = [f"c{i}" for i in range(width + 1)]
    row = F.from_csv(
        F.concat(line, F.lit(sep + END)), ", ".join(f"{c} string" for c in names), {"sep": sep}
    )
    cells = F.array(*(row[c] for c in names))
    size = F.array_position(cells, F.lit(END)).cast("int") - 1
    return F.when(size >= 0, F.slice(cells, F.lit(1), size))


def _csv_fields(lines: DataFrame, sep: str) -> DataFrame:
    if PLACE not in lines.columns:
        lines = with_place(lines)
    headers = (
        lines.where(F.col(START) == 0)
        .groupBy(FILE)
        .agg(F.min_by(LINE, PLACE).alias("_header"))
    )
    separators = F.size(F.split("_header", "[" + ("\\" if sep in "\\^]-" else "") + sep + "]"))
    width = (headers.agg(F.max(separators)).first()[0] or 0) + EXTRA_CELLS
    named = headers.withColumn("_names", _cells(F.regexp_replace("_header", "^﻿", ""), width, sep))
    joined = lines.join(named, FILE, "left").where(~F.col(LINE).eqNullSafe(F.col("_header")))
    cells = joined.withColumn("_cells", _cells(F.col(LINE), width, sep))
    n = F.size("_cells")
    names = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.coalesce(
            F.when(
                F.array_position("_names", F.get("_names", i)) == i + 1, F.get("_names", i)
            ).otherwise(F.concat(F.get("_names", i), F.lit("#"), (i + 1).cast("string"))),
            F.concat(F.lit("_c"), (i + 1).cast("string")),
        ),
    )
    return cells.withColumn("_fields", F.when(n > 0, F.map_from_arrays(names, F.col("_cells"))))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return with_origin(spark.read.text(path))
