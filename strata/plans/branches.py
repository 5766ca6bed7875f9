"""Independent steps of a job, side by side, and the record of what is done.

``run_branches`` runs steps that do not depend on each other in threads of one
session, so that a step with few tasks does not leave the cluster idle.  Each
has its own scheduler pool (they share the executors evenly under
``spark.scheduler.mode=FAIR``) and its own job tag.  A step that fails has the
jobs cancelled that it left running; the others go on and keep what they wrote,
then ``BranchError`` tells what failed.

``StepLog`` keeps one row per finished step of a named run in
``<schema>.job_steps``; a rerun under the same name goes on at the steps that
are missing.  The rows are written by the calling thread only.

Only step names and row counts pass through the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor, as_completed

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from strata.sources.tables import read_fresh, replace_partitions, save_overwrite, table_exists

MAX_PARALLEL = 4
# rows written, and whatever else the step reports
Result = tuple[int, dict[str, object]]
Step = Callable[[], Result]


class BranchError(RuntimeError):
    """``failed``: step name -> its exception."""

    def __init__(self, failed: Mapping[str, BaseException]):
        self.failed = dict(failed)
        super().__init__("; ".join(f"{name}: {e}" for name, e in self.failed.items()))


def run_branches(
    spark: SparkSession,
    branches: Mapping[str, Step],
    finished: Callable[[str, Result], None],
    parallel: int = MAX_PARALLEL,
) -> None:
    """Run the steps, at most ``parallel`` at once; ``finished`` is called here, in
    the calling thread, as each one ends well."""
    sc = spark.sparkContext
    run = uuid.uuid4().hex

    def branch(name: str, step: Step) -> Result:
        tag = f"{name}-{run}"
        sc.setLocalProperty("spark.scheduler.pool", name)
        sc.addJobTag(tag)
        try:
            return step()
        except BaseException:
            sc.cancelJobsWithTag(tag)
            raise
        finally:
            sc.removeJobTag(tag)
            sc.setLocalProperty("spark.scheduler.pool", None)

    failed: dict[str, BaseException] = {}
    with ThreadPoolExecutor(max_workers=parallel) as threads:
        running = {
            threads.submit(inheritable_thread_target(spark)(branch), name, step): name
            for name, step in branches.items()
        }
        for future in as_completed(running):
            name = running[future]
            error = future.exception()
            if error is None:
                finished(name, future.result())
            else:
                failed[name] = error
    if failed:
        raise BranchError(failed)


class StepLog:
    """Finished steps of run ``run`` of ``job``; without a name nothing is kept."""

    def __init__(self, spark: SparkSession, schema: str, job: str, run: str | None):
        self.spark, self.table, self.job, self.run = spark, f"{schema}.job_steps", job, run
        self.done: dict[str, Result] = {}
        if run is not None and table_exists(spark, self.table):
            mine = (F.col("job") == job) & (F.col("run") == run)
            for r in read_fresh(spark, self.table).where(mine).collect():  # a row a step
                self.done[r["step"]] = (r["rows"], json.loads(r["report"]))

    def note(self, step: str, result: Result) -> None:
        self.done[step] = result
        if self.run is None:
            return
        rows, report = result
        row = self.spark.range(1).select(
            F.lit(rows).cast("long").alias("rows"),
            F.lit(json.dumps(report)).alias("report"),
            F.lit(self.job).alias("job"),
            F.lit(self.run).alias("run"),
            F.lit(step).alias("step"),
        )
        if table_exists(self.spark, self.table):
            replace_partitions(row, self.table)
        else:
            save_overwrite(row, self.table, partition_by=["job", "run", "step"])

    def run_missing(self, steps: Mapping[str, Step], parallel: int = MAX_PARALLEL) -> None:
        """Run those of ``steps``, which do not depend on each other, that are not done."""
        missing = {name: step for name, step in steps.items() if name not in self.done}
        run_branches(self.spark, missing, self.note, parallel)
