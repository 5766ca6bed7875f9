"""Small shared helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.session import ensure_checkpoint_dir

SPAN_TYPE = "array<struct<kind:string,start:int,end:int>>"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with files in the session's shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _column(values, kind: pa.DataType) -> pa.Array:
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, type=kind)


def boxed(docs: DataFrame) -> DataFrame:
    """``row`` (all other columns, whatever their names) and ``text``."""
    return docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("row"), "text"
    )


def unboxed(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like`` from a boxed frame."""
    return df.select(
        *(F.col(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in like.columns)
    )


def map_batches(
    df: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch], Iterator[dict[str, list]]]],
    schema: StructType,
    *,
    last: bool = False,
) -> DataFrame:
    """``mapInArrow`` where ``make()`` runs once a task and its result turns a
    batch into dictionaries of output columns; with ``last`` it is called once
    more with None after the last batch."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches):
        step = make()
        for batch in chain(batches, [None] if last else []):
            for out in step(batch):
                yield pa.RecordBatch.from_arrays(
                    [_column(out[f.name], f.type) for f in arrow], schema=arrow
                )

    return df.mapInArrow(run, schema)


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def of_kinds(spans: Column, kinds: tuple[str, ...]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
