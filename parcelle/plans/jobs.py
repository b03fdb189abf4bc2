"""End-to-end batch jobs composed from the operators.

Each job is restartable: its outputs go to folders named by the run id (or
the state version) and are overwritten as a whole, so a job retried after a
failure or a lost executor rewrites the same result instead of appending a
second copy. Ids never leave Spark: the ledger of processed ids is a table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.functions.dates import month_start
from parcelle.operators import buckets, sinks, state, stats
from parcelle.operators import normalise as nz
from parcelle.operators.clean import CLEAN_COLUMNS, project_listing, unprocessed, with_checks
from parcelle.sources import files

LEDGER_SCHEMA = "Id string, run_id string"


@dataclass(frozen=True)
class CleaningPaths:
    raw: str            # landed raw listing collection
    clean: str          # clean table, one folder per run
    rejected: str       # rejected ids with reason, one folder per run
    ledger: str         # processed ids, one folder per run


def _done(spark: SparkSession, path: str, run_id: str, first_run: bool) -> DataFrame:
    """Ids that other runs recorded at ``path``. Only a declared first run may
    find nothing there; a missing folder raises otherwise."""
    if first_run:
        return spark.createDataFrame([], "_id string")
    rows = spark.read.schema(LEDGER_SCHEMA).parquet(path)
    return rows.filter(F.col("run_id") != F.lit(run_id)).select(F.col("Id").alias("_id"))


def cleaning_run(spark: SparkSession, paths: CleaningPaths, run_id: str, limit: int | None = None,
                 fmt: str = "parquet", first_run: bool = False) -> dict[str, str]:
    """Clean the next batch of unprocessed listings.

    Rows flagged processed in the collection or recorded in the ledger by an
    earlier run are skipped, as are ids an earlier run rejected; with a
    ``limit`` the batch is the first ids in id order. ``first_run`` says that
    no run has written the ledger yet.
    The ledger entries of ``run_id`` itself are ignored, so a retried run
    selects the same batch and rewrites the same three outputs: clean rows,
    rejects with reason, and ledger ids. The checked batch is persisted
    once and feeds the three writes; a lost cached block is recomputed from
    the same deterministic batch."""
    raw = files.read_listings(spark, paths.raw, fmt)
    ledger = (_done(spark, paths.ledger, run_id, first_run)
              .unionAll(_done(spark, paths.rejected, run_id, first_run)))
    batch = unprocessed(raw.join(ledger, "_id", "left_anti"), limit)
    checked = with_checks(project_listing(batch)).persist()
    try:
        out = {
            "clean": f"{paths.clean}/run_id={run_id}",
            "rejected": f"{paths.rejected}/run_id={run_id}",
            "ledger": f"{paths.ledger}/run_id={run_id}",
        }
        clean = checked.filter(F.col("reason").isNull())
        clean.select("Id", *CLEAN_COLUMNS).write.mode("overwrite").parquet(out["clean"])
        checked.filter(F.col("reason").isNotNull()).select("Id", "reason") \
               .write.mode("overwrite").parquet(out["rejected"])
        clean.select("Id").write.mode("overwrite").parquet(out["ledger"])
    finally:
        checked.unpersist()
    return out


def open_data_run(spark: SparkSession, sale_files: Sequence[str], state_base: str, version: int,
                  now: str, run_stats_path: str | None = None, partitions: int | None = None,
                  stale_days: int = state.STALE_DAYS) -> str:
    """Yearly sale files to a new state version.

    Reads the files as one relation, normalises them, upserts into state
    version ``version - 1`` (or loads it initially), deactivates listings not
    seen for ``stale_days``, writes version ``version`` to its own folder and
    optionally writes the run counters to ``run_stats_path/version=N``. Every
    output is a whole folder of its version, so a retry rewrites it."""
    rows = files.read_sales(spark, list(sale_files), partitions)
    listings = nz.normalise_sales(rows, now).listings
    previous = None
    if version > 0:
        previous = spark.read.parquet(sinks.state_path(state_base, version - 1))
    new_state = state.deactivate(state.upsert(previous, listings), now, stale_days)
    out = sinks.write_state_version(new_state, state_base, version, partitions=partitions)
    if run_stats_path:
        # the version is the folder's partition value, not a data column
        counters = state.upsert_counters(previous, listings)
        counters.write.mode("overwrite").parquet(sinks.state_path(run_stats_path, version))
    return out


# Keys of the kept partial sums: every level, the monthly series and the drill-down are answered from them.
SUM_KEYS = ["ZipCode", "City", "Logement", "month"]


def listing_sums(listings: DataFrame) -> DataFrame:
    """Partial sums of the listings of a state that pass the cleaning checks, per ``SUM_KEYS`` (month of the
    last-seen day)."""
    rows = listings.withColumn("scraped_at", F.lit(None).cast("string"))
    clean = with_checks(project_listing(rows)).filter(F.col("reason").isNull())
    return stats.partial_sums(clean, [*SUM_KEYS[:3], month_start(F.col("Date")).alias("month")])


def kept_sums(spark: SparkSession, base: str, version: int) -> DataFrame:
    """The partial sums of a version, for ``stats.geo_stats_of``, ``drilldown_of`` and ``timeseries_of``."""
    return spark.read.parquet(f"{base}/sums/version={version}")


def maintained_run(spark: SparkSession, base: str, batch: DataFrame, version: int, bucket_count: int = 64) -> int:
    """Apply a batch to the bucketed state under ``base`` and carry the statistics along.

    The rows of the touched buckets are taken out of the partial sums as they
    were and put in as they are; the rest of the state is not read. Sums
    are exact, so they stay equal, to the bit, to sums over the whole state.
    Every output is a folder of its version; a retry rewrites it. Returns how
    many buckets were written."""
    n = buckets.apply_batch(spark, f"{base}/state", batch, version, bucket_count)
    before, after = buckets.changed(spark, f"{base}/state", version)
    sums = listing_sums(after)
    if before is not None:
        sums = kept_sums(spark, base, version - 1).unionByName(sums).unionByName(stats.negated(listing_sums(before)))
    with buckets.once(spark):
        stats.merge_sums(sums, SUM_KEYS).write.mode("overwrite").option("compression", buckets.COMPRESSION).parquet(f"{base}/sums/version={version}")
    return n


def collector_run(spark: SparkSession, base: str, listings: DataFrame, log: DataFrame, run_id: str, version: int, now: str,
                  reason: str = "finished", bucket_count: int = 64) -> DataFrame:
    """What a collector does when a run closes: save its listings, then write the run's statistics row.

    ``log`` has a row per fetched page (``items``, ``fetched_at``). The listings
    become ``version`` of the state (``maintained_run``), and ``runs/run_id=R`` gets
    one row: duration, pages, listings in all, new and updated, rates, the time
    and the ``reason`` the run ended. New and updated are told from the touched
    buckets alone. A retry replaces the version and the row. Returns the row."""
    maintained_run(spark, base, listings, version, bucket_count)
    before, after = buckets.changed(spark, f"{base}/state", version)
    held = after.limit(0) if before is None else before
    counters = state.run_counters(held, listings.withColumn("run_id", F.lit(run_id)))
    sinks.write_run_stats(stats.run_statistics(log.withColumn("run_id", F.lit(run_id)), counters, now, reason), f"{base}/runs")
    return spark.read.parquet(f"{base}/runs").filter(F.col("run_id") == F.lit(run_id))


def current_listings(spark: SparkSession, base: str, version: int, now: str, stale_days: int = state.STALE_DAYS) -> DataFrame:
    """The state of a version as of ``now``: listings not seen for ``stale_days`` are inactive. Whether a listing is
    stale follows from when it was last seen, so no bucket is rewritten for it."""
    return state.deactivate(buckets.read_state(spark, f"{base}/state", version), now, stale_days)
