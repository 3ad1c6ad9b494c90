"""Incremental fact load: the monthly run over only the arrival files not loaded yet.

Arrival data comes as a new batch of parquet files every month. Instead of
rebuilding the whole fact table, a Structured Streaming file source keeps
track (in its checkpoint) of which files were already processed; each run
(``availableNow`` trigger) builds the fact rows of the new files only, with
the same :func:`build_fact` as the batch job, and stops.

Files that are not parquet are passed over, and null keys are written and counted,
as in the whole run. Each micro-batch overwrites its own ``load_batch=<id>`` folder, so a batch
that is retried after a failure replaces its earlier partial output instead
of appending twice. Reading the target folder yields the fact table plus
the ``load_batch`` column.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from arrivals_mart.operators.quality import counted
from arrivals_mart.operators.sinks import overwrite
from arrivals_mart.plans.marts import build_fact
from arrivals_mart.schemas import ARRIVALS, FACT_IMMIGRATION, enforce
from arrivals_mart.session import scratch_path


def incremental_fact_load(
    spark: SparkSession,
    arrivals_dir: str,
    ports: DataFrame,
    target: str,
    checkpoint: str | None = None,
    max_files_per_batch: int | None = None,
    report: list[dict] | None = None,
) -> int:
    """Load the fact rows of arrival files not seen before into ``target``.

    ``checkpoint`` must stay the same between runs (it records the files
    already loaded) and belongs to ``target``: losing only the checkpoint
    would load every file again under new batch ids, so both are kept or
    reset together. By default it is a fresh folder below the session's
    checkpoint folder, which suits a one-off run. ``report`` receives the row
    count and the null keys of each batch, counted by its write. Returns the
    number of micro-batches that ran.
    """
    ckpt = checkpoint or scratch_path(spark, "incremental-fact-checkpoint")
    # new deliveries may arrive as sub-folders of arrivals_dir
    reader = spark.readStream.schema(ARRIVALS).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    arrivals = reader.parquet(arrivals_dir)
    batches: list[int] = []

    def load(batch: DataFrame, batch_id: int) -> None:
        fact = enforce(build_fact(batch, ports), FACT_IMMIGRATION, "fact_immigration", check_nulls=False)
        fact, counts = counted(fact, "immigration_id")
        overwrite(fact, os.path.join(target, f"load_batch={batch_id}"))
        batches.append(batch_id)
        if report is not None:
            found = counts()
            report.append({"batch": batch_id, "row_count": found.get("row_count") or 0, "null_keys": found.get("null_keys") or 0})

    query = (
        arrivals.writeStream.foreachBatch(load)
        .option("checkpointLocation", ckpt)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len(batches)
