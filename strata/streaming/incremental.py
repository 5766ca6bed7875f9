"""Incremental intake: new files in a landing folder are upserted into a
table by a Structured Streaming query.

``readStream`` tracks which files were already processed in the query's
checkpoint; each micro-batch goes through ``transform`` and is upserted on
the table keys inside ``foreachBatch``.

* A batch is read once: it is stored beside the stream's checkpoint first and
  everything that follows reads that copy.  The next batch replaces it.
* A ledger table (``<table>__applied``, one row per stream) holds the last batch
  that was applied in full; a batch that is delivered again after that is
  skipped without any write.

* Several versions of a key in one batch: with ``order_by`` the latest is
  taken; without, the batch fails (an upsert has one row per key).
* Rows with a NULL key (malformed records among them) are not upserted, for
  they would be inserted again whenever a batch is replayed.  They go to the
  table ``<table>__rejected``, partitioned by batch; a replayed batch replaces
  its own partition.
* A batch that failed half way is applied again as a whole, which leaves both
  tables as one application would: at-least-once delivery gives an exactly-once
  table state.
* With ``rescue="field"`` CSV and JSON lines are matched by field name and only
  what does not fit is rescued (see ``sources.rescue``).
* Every batch leaves a row in ``<table>__runs`` (stream, epoch, input, valid and
  quarantined records, valid share), counted while the rejected rows are written,
  without a pass of its own.  ``rules`` says what is valid; a row without a key never
  is.  A replayed batch replaces its row.
* Each batch rewrites only the key buckets it touches; new tables are stored
  by ``key_buckets`` buckets, existing ones keep their own layout.

The checkpoint lives under the session's shared ``spark.checkpoint.dir``, at
the same place in every session, unless a location is given.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from strata.operators.quality import Rule, all_pass, rate_pct
from strata.operators.upsert import keep_last
from strata.session import state_location
from strata.sources.intake import RESCUE_COLUMN, with_rescue
from strata.sources.rescue import FORMATS, parse_lines, with_origin, with_place
from strata.sources.tables import (
    DEFAULT_KEY_BUCKETS,
    TableDoc,
    buckets_for,
    read_fresh,
    replace_partitions,
    save_overwrite,
    save_upsert,
    table_exists,
)

BATCH = "_batch"


def save_batch(rows: DataFrame, table: str, epoch: int) -> None:
    """Store a batch's rows as the table's partition of that batch, replacing
    what an earlier attempt stored."""
    rows = rows.withColumn(BATCH, F.lit(epoch).cast("long"))
    if table_exists(rows.sparkSession, table):
        replace_partitions(rows, table)
    else:  # one partition: nothing to rebalance, so the rows are not shuffled
        rows.write.partitionBy(BATCH).saveAsTable(table)


def note_run(spark: SparkSession, runs: str, stream: str, epoch: int, counts: dict[str, int]) -> None:
    """The batch's row of the run table."""
    total, valid = counts["input_records"], counts["valid_records"]
    row = spark.range(1).select(
        F.lit(total).cast("long").alias("input_records"),
        F.lit(valid).cast("long").alias("valid_records"),
        F.lit(total - valid).cast("long").alias("quarantined_records"),
        F.lit(rate_pct(valid, total)).cast("double").alias("processing_rate_pct"),
        F.lit(stream).alias("stream"),
        F.lit(epoch).cast("long").alias("epoch"),
    )
    if table_exists(spark, runs):
        replace_partitions(row, runs)
    else:
        save_overwrite(row, runs, partition_by=["stream", "epoch"])


def stream_id(spark: SparkSession) -> str:
    """Id of the streaming query whose batch this is (kept in its checkpoint)."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""


def was_applied(spark: SparkSession, ledger: str, stream: str, epoch: int) -> bool:
    if not table_exists(spark, ledger):
        return False
    last = read_fresh(spark, ledger).where(F.col("stream") == stream).agg(F.max("epoch")).first()[0]
    return last is not None and epoch <= last


def note_applied(spark: SparkSession, ledger: str, stream: str, epoch: int) -> None:
    """Replace the stream's row of the ledger."""
    row = spark.range(1).select(F.lit(epoch).cast("long").alias("epoch"), F.lit(stream).alias("stream"))
    if table_exists(spark, ledger):
        replace_partitions(row, ledger)
    else:
        save_overwrite(row, ledger, partition_by=["stream"])


def stage_batch(batch: DataFrame, path: str) -> DataFrame:
    """The batch, stored: its source is read this once."""
    batch.write.mode("overwrite").parquet(path)
    return batch.sparkSession.read.schema(batch.schema).parquet(path)


def start_incremental_upsert(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    table: str,
    keys: Sequence[str],
    transform: Callable[[DataFrame], DataFrame] | None = None,
    fmt: str = "parquet",
    checkpoint: str | None = None,
    doc: TableDoc | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    key_buckets: int | None = DEFAULT_KEY_BUCKETS,
    order_by: str | None = None,
    rescue: str = "record",
    rules: Sequence[Rule] = (),
) -> StreamingQuery:
    """Start the intake query.  ``rules`` (over the transformed rows) only count;
    rows that fail them are upserted like others.  With ``available_now`` it processes every
    file present at start (in bounded batches) and stops."""
    by_field = rescue == "field" and fmt in FORMATS
    if by_field:
        reader = spark.readStream.format("text")
    elif fmt in FORMATS:
        # Text landing files keep malformed records: NULL fields plus the raw
        # text in the rescue column, as in batch intake.
        reader = (
            spark.readStream.schema(with_rescue(schema, RESCUE_COLUMN))
            .format(fmt)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", RESCUE_COLUMN)
        )
    else:
        reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv" and not by_field:
        reader = reader.option("header", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(landing)
    if by_field:
        stream = with_origin(stream)
    elif transform is not None:
        stream = transform(stream)
    where = checkpoint or state_location(spark, f"intake/{table}")
    ledger = f"{table}__applied"

    def upsert_batch(batch: DataFrame, epoch: int) -> None:
        own = batch.sparkSession
        stream_key = stream_id(own)
        if was_applied(own, ledger, stream_key, epoch):
            return
        rows = stage_batch(with_place(batch) if by_field else batch, f"{where.rstrip('/')}/staged")
        if by_field:
            rows = parse_lines(rows, schema, fmt, RESCUE_COLUMN)
            rows = transform(rows) if transform is not None else rows
        present = F.lit(True)
        for key in keys:
            present = present & F.col(key).isNotNull()
        counts = Observation(f"batch {epoch} of {table}")
        counted = rows.observe(
            counts,
            F.count(F.lit(1)).alias("input_records"),
            F.count_if(present & all_pass(rules)).alias("valid_records"),
        )
        save_batch(counted.filter(~present), f"{table}__rejected", epoch)
        note_run(own, f"{table}__runs", stream_key, epoch, counts.get)
        rows = rows.filter(present)
        if order_by is not None:
            rows = keep_last(rows, keys, order_by)
        save_upsert(rows, table, keys, doc=doc, key_buckets=buckets_for(own, table, key_buckets))
        note_applied(own, ledger, stream_key, epoch)

    writer = (
        stream.writeStream.foreachBatch(upsert_batch)
        .option("checkpointLocation", where)
        .queryName(f"intake_{table.replace('.', '_')}")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute"
    )
    return writer.start()
