"""Keyed state in hash buckets: an upsert reads and rewrites only the buckets that its batch touches.

Layout under a base folder::

    batch/version=V/bucket=K/    the aggregated batch of version V
    data/version=V/bucket=K/     the buckets that version V rewrote
    manifest/version=V/          for every bucket that holds rows, the version that wrote it last

The bucket is Spark's own bucket function of the key, so the files are those of a bucketed table: the join with a
batch takes both as they lie: the batch moves once, when it is aggregated into buckets of its own, the state never. What
a job shuffled is removed when it ends. Files are never changed. A version exists once its manifest is written, which is the last step; a run that failed before is run
again with the same version number and replaces what it left. The driver handles one entry per bucket, a
number fixed when the state is made.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.operators import state as st
from parcelle.session import folder_names, path_exists, settings

STORED_KEY = st.STORED_KEY
# Fixed value: rows that one task reads, sorts and writes.
ROWS_A_BUCKET = 500_000
BUCKET = "bucket"
MANIFEST = "bucket int, written int, buckets int"
COMPRESSION = "zstd"


def buckets_for(rows: int, least: int = 8) -> int:
    """The number of buckets for a state of so many rows: a task's share stays the same when the state grows."""
    return max(least, -(-rows // ROWS_A_BUCKET))


def _bucket(buckets: int) -> Column:
    """Spark's bucket number of the stored key."""
    return F.pmod(F.hash(STORED_KEY), F.lit(buckets))


def _manifest(spark: SparkSession, base: str, version: int) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{base}/manifest/version={version}")


def latest_version(spark: SparkSession, base: str) -> int | None:
    """The newest complete version; ``None`` without any."""
    if not path_exists(spark, f"{base}/manifest"):
        return None
    return spark.read.parquet(f"{base}/manifest").agg(F.max("version")).first()[0]


def once(spark: SparkSession, **more):
    """Settings for a job that writes a version: what it shuffles is of no use to another job."""
    return settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled=True, **more)


def _table_name(base: str, version: int) -> str:
    return "state_" + hashlib.sha1(f"{base}\n{version}".encode()).hexdigest()[:24]


def _bucketed(spark: SparkSession, name: str, base: str, buckets: int, places: dict[int, str]) -> DataFrame:
    """Bucket files as a bucketed table: its partitions lie in the given folders."""
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(next(iter(places.values()))).schema)
        spark.sql(f"CREATE TABLE {name} ({columns}, {BUCKET} int) USING parquet PARTITIONED BY ({BUCKET}) "
                  f"CLUSTERED BY ({STORED_KEY}) SORTED BY ({STORED_KEY}) INTO {buckets} BUCKETS LOCATION '{base}/data/unused'")
        added = " ".join(f"PARTITION ({BUCKET}={bucket}) LOCATION '{place}'" for bucket, place in places.items())
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {added}")
    return spark.table(name)


def _table(spark: SparkSession, base: str, version: int) -> DataFrame:
    """The stored rows of a version as a bucketed table whose partitions lie in the folders the manifest names."""
    entries = list(_manifest(spark, base, version).orderBy(BUCKET).toLocalIterator())
    if not entries:
        raise ValueError(f"no rows in version {version} of {base}")
    return _bucketed(spark, _table_name(base, version), base, entries[0].buckets,
                     {e.bucket: f"{base}/data/version={e.written}/bucket={e.bucket}" for e in entries})


def _touched(spark: SparkSession, base: str, version: int) -> list[int]:
    """The buckets that the stored batch of a version holds rows for."""
    folders = folder_names(spark, f"{base}/batch/version={version}")
    return sorted(int(n.removeprefix(f"{BUCKET}=")) for n in folders if n.startswith(f"{BUCKET}="))


def _batch(spark: SparkSession, base: str, version: int, buckets: int) -> DataFrame:
    """The stored batch of a version as a bucketed table."""
    places = {b: f"{base}/batch/version={version}/bucket={b}" for b in _touched(spark, base, version)}
    if not places:
        return spark.read.parquet(f"{base}/batch/version={version}")
    return _bucketed(spark, "batch_" + _table_name(base, version), base, buckets, places)


def _write(spark: SparkSession, rows: DataFrame, base: str, version: int, buckets: int, kind: str = "data") -> None:
    """The given stored rows as the bucket files of a version, one file per bucket."""
    name = "writing_" + hashlib.sha1(f"{base}\n{version}".encode()).hexdigest()[:24]
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    (rows.withColumn(BUCKET, _bucket(buckets)).write.mode("overwrite").option("compression", COMPRESSION).partitionBy(BUCKET)
     .bucketBy(buckets, STORED_KEY).sortBy(STORED_KEY).option("path", f"{base}/{kind}/version={version}").saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")


def read_state(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """The whole state at a version, the newest by default."""
    version = latest_version(spark, base) if version is None else version
    if version is None:
        raise ValueError(f"no state in {base}")
    return _original(_table(spark, base, version))


def _original(rows: DataFrame) -> DataFrame:
    return rows.select(st.ID, st.original_key(F.col(STORED_KEY)).alias(st.KEY), *[c for c in rows.columns if c not in (st.ID, STORED_KEY, BUCKET)])


def _held(spark: SparkSession, base: str, version: int) -> DataFrame:
    """What the buckets that the stored batch of ``version`` touches held before it."""
    return _table(spark, base, version - 1).filter(F.col(BUCKET).isin(_touched(spark, base, version)))


def changed(spark: SparkSession, base: str, version: int) -> tuple[DataFrame | None, DataFrame]:
    """The rows of the buckets that ``version`` rewrote, before (``None`` for version 0) and after it."""
    before = _original(_held(spark, base, version)) if version > 0 else None
    return before, _original(spark.read.parquet(f"{base}/data/version={version}"))


def merged(spark: SparkSession, base: str, version: int) -> DataFrame:
    """The touched buckets after the stored batch of ``version``: the state side of the join is the bucket files of
    the version before, pruned to the batch's buckets."""
    batch = _batch(spark, base, version, _manifest(spark, base, version - 1).first().buckets)
    return st.merge_state(_held(spark, base, version).drop(BUCKET), batch.drop(BUCKET), STORED_KEY, null_keys=False)


def apply_batch(spark: SparkSession, base: str, batch: DataFrame, version: int, buckets: int = 64, key: str = st.KEY) -> int:
    """Apply ``batch`` as ``version``: version 0 makes the state in ``buckets`` hash buckets, version V extends
    version V - 1, whose number of buckets it keeps. Returns how many buckets it wrote.

    Results are those of ``state.upsert``. Choose ``buckets`` by the state's size (``buckets_for``): a bucket is read
    and written by one task. Applying a version again gives the same files.
    """
    if version > 0:
        if not path_exists(spark, f"{base}/manifest/version={version - 1}"):
            raise ValueError(f"version {version - 1} of {base} is not complete")
        buckets = _manifest(spark, base, version - 1).first().buckets
    for name in (_table_name(base, version), "batch_" + _table_name(base, version)):
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # registered by an earlier try
    if st.ID not in batch.columns:
        batch = batch.withColumn(st.ID, F.col(key).cast("string"))
    keyed = st.aggregate_batch(batch.withColumn(STORED_KEY, st.stored_key(F.col(key))), STORED_KEY)
    # a bucket a task: the aggregate deals its rows as buckets are dealt, so they need not move again
    with once(spark, spark__sql__shuffle__partitions=buckets, spark__sql__adaptive__coalescePartitions__enabled=False):
        _write(spark, keyed, base, version, buckets, "batch")
    # Spark would give up the buckets of a scan that no join or aggregate stands on
    with once(spark, spark__sql__sources__bucketing__autoBucketedScan__enabled=False):
        rows = merged(spark, base, version) if version > 0 else st.merge_state(None, _batch(spark, base, version, buckets).drop(BUCKET), STORED_KEY)
        _write(spark, rows, base, version, buckets)
    found = _touched(spark, base, version)
    touched = spark.createDataFrame([(b,) for b in found], f"{BUCKET} int")
    written = touched.select(BUCKET, F.lit(version).alias("written"), F.lit(buckets).alias("buckets"))
    if version > 0:
        written = written.unionByName(_manifest(spark, base, version - 1).join(touched, BUCKET, "left_anti").select(BUCKET, "written", "buckets"))
    written.coalesce(1).write.mode("overwrite").parquet(f"{base}/manifest/version={version}")
    return len(found)
