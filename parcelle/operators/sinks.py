"""Sinks: clean-table append, run statistics, versioned keyed state.

Writes are done by the executors in parallel (one connection or file per
partition); a failed task is retried by Spark, so there is no manual batching
or driver-side buffer. Outputs that must survive a rerun are written to a new
path per version / run, which makes a retried job idempotent.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from parcelle.operators.clean import CLEAN_COLUMNS
from parcelle.schema import RUN_STATS

# Batch sizes used by the source for database writes.
CLEAN_BATCH_SIZE = 500


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None,
               batchsize: int = CLEAN_BATCH_SIZE, mode: str = "append") -> None:
    """Append the 8 clean columns to a database table, ``batchsize`` rows per
    insert batch, one connection per partition."""
    missing = [c for c in CLEAN_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"missing clean columns: {', '.join(missing)}")
    (df.select(*CLEAN_COLUMNS).write
       .option("batchsize", batchsize).mode(mode)
       .jdbc(url, table, properties=dict(properties or {})))


def append_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | None = None) -> None:
    """Append rows (run statistics, ledgers) to a table folder."""
    w = df.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.save(path)


def write_run_stats(stats: DataFrame, path: str, run_col: str = "run_id") -> None:
    """Write the statistics rows of the runs in ``stats``, one folder per run:
    a retried run replaces its own row and leaves the others."""
    columns = [f.name for f in RUN_STATS.fields]
    missing = [c for c in columns if c not in stats.columns]
    if missing:
        raise ValueError(f"missing run statistics: {', '.join(missing)}")
    (stats.select(*columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy(run_col).parquet(path))


def state_path(base: str, version: int) -> str:
    return f"{base.rstrip('/')}/version={version}"


def write_state_version(state: DataFrame, base: str, version: int, key: str = "listing_url",
                        partitions: int | None = None) -> str:
    """Write a new state version to its own folder, clustered by key hash.

    The previous version stays readable until the new one is complete, so a
    failed or retried upsert never leaves a half-written state. Clustering by
    the key keeps each key's row in one file per partition; for repeated
    upserts against a catalog table prefer ``save_bucketed``.
    """
    out = state_path(base, version)
    data = state.repartition(partitions, key) if partitions else state.repartition(key)
    data.write.mode("overwrite").parquet(out)
    return out


def save_bucketed(df: DataFrame, table: str, buckets: int, key: str = "listing_url",
                  mode: str = "overwrite") -> None:
    """Save as a table bucketed and sorted by the key: later joins on the key
    (the next upsert) read it without a shuffle. Choose ``buckets`` by the
    state's size: a bucket is read by one task."""
    df.write.mode(mode).bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def checkpoint_cut(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Cut a long lineage (for example after many chained upserts) with a
    reliable checkpoint in the shared folder named by ``spark.checkpoint.dir``."""
    from parcelle.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    return df.checkpoint(eager=True)
