"""Batches of unprocessed listings from a collection landed by day, without reading the days that are done.

Layout::

    raw/landed=D/                the landed collection
    done/run_id=R/landed=D/      what run R made of its batch: cleaned fields and the reason of rejected listings
    closed/run_id=R/             days that run R found to be done

What a run writes is its own ledger, in one write, so no crash leaves cleaned rows that the ledger lacks. A run reads
the open days only, of the collection and of the ledger: a day is read while it is open, and the work of all
runs together follows the landed data, not its square. The driver handles names of days.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.operators.clean import CLEAN_COLUMNS, project_listing, unprocessed, with_checks
from parcelle.session import folder_names, path_exists
from parcelle.sources import files

DAY = "landed"


@dataclass(frozen=True)
class QueuePaths:
    raw: str
    done: str
    closed: str


def open_days(spark: SparkSession, paths: QueuePaths, run_id: str) -> list[str]:
    """The landed days that no other run has closed, oldest first; from folder names and the list of closed days."""
    landed = {n.removeprefix(f"{DAY}=") for n in folder_names(spark, paths.raw) if n.startswith(f"{DAY}=")}
    if path_exists(spark, paths.closed):
        closed = spark.read.schema(f"{DAY} string, run_id string").parquet(paths.closed).filter(F.col("run_id") != F.lit(run_id))
        landed -= {r[0] for r in closed.select(DAY).distinct().toLocalIterator()}
    return sorted(landed)


def _of_days(rows: DataFrame, days: Sequence[str]) -> DataFrame:
    return rows.withColumn(DAY, F.col(DAY).cast("string")).filter(F.col(DAY).isin(list(days)))


def pending(spark: SparkSession, paths: QueuePaths, days: Sequence[str], run_id: str | None = None) -> DataFrame:
    """Unprocessed listings of the given days that no run (other than ``run_id``) has in its ledger. An id is one
    listing within its day."""
    raw = unprocessed_rows(_of_days(files.read_listings(spark, paths.raw), days))
    if not path_exists(spark, paths.done):
        return raw
    done = spark.read.schema(f"Id string, {DAY} string, run_id string").parquet(paths.done)
    done = done.filter(F.col("run_id") != F.lit(run_id)) if run_id is not None else done
    done = _of_days(done, days).select(F.col("Id").alias("_id"), DAY)
    return raw.join(done, [DAY, "_id"], "left_anti")


def unprocessed_rows(raw: DataFrame) -> DataFrame:
    return raw.filter(~F.coalesce(F.col("processed"), F.lit(False)))


def queue_run(spark: SparkSession, paths: QueuePaths, run_id: str, limit: int | None = None, before: str | None = None) -> list[str]:
    """Clean the next batch, the first ``limit`` listings by day and id, and close the days before ``before`` that
    have nothing left (days from it on may still receive files). Returns the days that the run closed.

    A run that is retried ignores its own ledger and replaces what it wrote."""
    days = open_days(spark, paths, run_id)
    batch = pending(spark, paths, days, run_id)
    if limit is not None:
        batch = batch.orderBy(DAY, "_id").limit(limit)
    # the day travels with its row as a part of the id
    named = batch.withColumn("_id", F.struct(F.col("_id").alias("id"), F.col(DAY).alias("day")))
    checked = with_checks(project_listing(unprocessed(named))).withColumn(DAY, F.col("Id.day")).withColumn("Id", F.col("Id.id"))
    (checked.select("Id", *CLEAN_COLUMNS, "reason", DAY).write.mode("overwrite").partitionBy(DAY).parquet(f"{paths.done}/run_id={run_id}"))
    left = {r[0] for r in pending(spark, paths, days).select(DAY).distinct().toLocalIterator()}
    closed = [d for d in days if d not in left and before is not None and d < before]
    spark.createDataFrame([(d,) for d in closed], f"{DAY} string").coalesce(1).write.mode("overwrite").parquet(f"{paths.closed}/run_id={run_id}")
    return closed
