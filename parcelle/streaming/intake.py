"""Incremental intake of landed listing files (process each listing once).

A file-source stream with ``trigger(availableNow=True)`` picks up the files that its checkpoint has not seen. A
keyed state in the stream holds the ids that went through, so an id landed in two files, in one run or years
apart, goes through once. What a batch writes goes to a folder named by the stream's own identity and the
batch's number, in one write: a batch that is run again after a crash replaces its folder. A stream
whose checkpoint was lost, or a second stream into the same output, is a new identity: it never touches the
folders of another one, and the ids found there are left out.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parcelle.operators.clean import CLEAN_COLUMNS, project_listing, unprocessed, with_checks
from parcelle.schema import LISTINGS_RAW
from parcelle.session import ensure_checkpoint_dir, path_exists

# Written by every batch: the cleaned fields, and the reason of a rejected listing (null where it is clean).
TABLE = "listings"
# Local property in which Spark names the running query; it is kept in the query's checkpoint.
QUERY_ID = "sql.streaming.queryId"


def written_elsewhere(spark: SparkSession, output_path: str, stream: str) -> DataFrame | None:
    """Ids that other streams wrote to the output; ``None`` while there is no output. Only the folders of other
    streams are read, so a stream never scans what it wrote itself."""
    path = f"{output_path}/{TABLE}"
    if not path_exists(spark, path):
        return None
    return spark.read.parquet(path).filter(F.col("stream") != F.lit(stream)).select("Id")


def clean_batch(batch: DataFrame, batch_id: int, output_path: str, stream: str) -> None:
    """Clean one micro-batch of ids that are new to the stream and write clean and rejected listings, in one
    table and one write, to ``listings/stream=S/batch_id=N``."""
    spark = batch.sparkSession
    seen = written_elsewhere(spark, output_path, stream)
    if seen is not None:
        batch = batch.join(seen, F.col("_id").eqNullSafe(F.col("Id")), "left_anti")
    checked = with_checks(project_listing(unprocessed(batch)))
    (checked.select("Id", *CLEAN_COLUMNS, "reason")
     .write.mode("overwrite").parquet(f"{output_path}/{TABLE}/stream={stream}/batch_id={batch_id}"))


def intake_name(source_path: str, output_path: str) -> str:
    """The name of the intake of a source into an output."""
    return hashlib.sha1(f"{source_path}\n{output_path}".encode()).hexdigest()[:16]


def default_checkpoint(spark: SparkSession, source_path: str, output_path: str) -> str:
    """Stream checkpoint folder of an intake under the configured
    ``spark.checkpoint.dir``, the same one for every application."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/intake-{intake_name(source_path, output_path)}"


def new_listings(landed: DataFrame) -> DataFrame:
    """The unprocessed rows of a stream of landed listings, in the cleaning fields, each id once in the stream's life.

    Only the fields that cleaning reads move: what a batch gets is not pruned any more. The ids are the stream's state, spread over its partitions by hash. Rows without an id cannot be told apart
    and count as one. Of rows with one id that land together one goes through; which one is not promised."""
    return unprocessed(landed).dropDuplicates(["_id"])


def run_intake(spark: SparkSession, source_path: str, output_path: str, checkpoint_path: str | None = None,
               fmt: str = "parquet", schema: StructType = LISTINGS_RAW,
               max_files_per_trigger: int | None = None) -> None:
    """Process every landed file not processed yet, then stop.

    ``checkpoint_path`` defaults to a folder under the session's shared
    ``spark.checkpoint.dir``, named after the source and output paths, so two
    intakes never share a file ledger and a rerun of the same one resumes. One
    stream at a time may write to an output."""
    if checkpoint_path is None:
        checkpoint_path = default_checkpoint(spark, source_path, output_path)
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def write(batch: DataFrame, batch_id: int) -> None:
        clean_batch(batch, batch_id, output_path, batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID))

    query = (new_listings(reader.load(source_path)).writeStream
             .trigger(availableNow=True)
             .option("checkpointLocation", checkpoint_path)
             .foreachBatch(write)
             .start())
    query.awaitTermination()


def read_intake(spark: SparkSession, output_path: str, part: str = "clean") -> DataFrame:
    """What all batches wrote so far: the ``clean`` listings, or the ``rejected`` ones (id and reason); ``stream`` and
    ``batch_id`` say where each comes from."""
    rows = spark.read.parquet(f"{output_path}/{TABLE}")
    if part == "clean":
        return rows.filter(F.col("reason").isNull()).drop("reason")
    return rows.filter(F.col("reason").isNotNull()).select("Id", "reason", "stream", "batch_id")
