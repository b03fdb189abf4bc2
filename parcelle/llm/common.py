"""Helpers shared by the training-data operators: table reading, shared folder, materialised tables, components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_BYTES, BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Where it is unset, a temporary folder is made on a plain local master only
    (tests); any other master raises.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    base = "file://" + tempfile.mkdtemp(prefix="parcelle-llm-")
    spark.conf.set("spark.checkpoint.dir", base)
    return base


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def place(table: DataFrame) -> Column:
    """The place of a row in a Parquet table: its file and its position there. Unlike a running number it is the
    same in every scan, however the files are split, which follows the number of executors at that moment."""
    at = table.metadataColumn("_metadata")
    return F.struct(F.xxhash64(at.getField("file_path")).alias("file"), at.getField("row_index").alias("at"))


def has_place(df: DataFrame) -> bool:
    """Whether ``df`` reads a Parquet table, so that its rows have a place."""
    try:
        df.select(place(df))
        return True
    except AnalysisException:
        return False


def in_batches(rows: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` with batches of at most ``BATCH``. A batch is held by the JVM, while its vectors double, and by
    the worker, as a message and as Python values, in every task at once; Spark's own bound of 64 MB is many times
    that for an executor. The setting is read when the frame runs, so it stays in the session; one that the session
    has already is kept."""
    conf = rows.sparkSession.conf
    if conf.get(BATCH_BYTES, None) is None:
        conf.set(BATCH_BYTES, BATCH)
    return rows.mapInArrow(run, schema)


def filter_rows(docs: DataFrame, make) -> DataFrame:
    """The rows of ``docs`` that a test of whole batches keeps, whatever the names of the columns.

    ``make()`` runs in the task and returns a function from a text column's values to a list of booleans.
    """
    at, names = docs.columns.index("text"), [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)

    def run(batches):
        import pyarrow as pa
        test = make()
        for batch in batches:
            yield batch.filter(pa.array(test(batch.column(at).to_pylist()), pa.bool_()))

    return in_batches(plain, run, plain.schema).toDF(*docs.columns)


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of undirected ``links``: rows (node, component), the component named by its
    smallest node; nodes without links are absent.

    Alternating large-star and small-star rounds over a materialised edge table. A round groups by node
    with partial aggregates only (the least neighbour of each node), so a hub is combined map-side.
    Stops when a round leaves the edges unchanged; only two counters reach the driver.
    """
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges, before = materialise(edges, "edges"), None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: every larger neighbour of a node is linked to the least of the node and its neighbours
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        # small star: every smaller neighbour, and the node itself, is linked to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v")))
                 .where("u <> v").distinct())
        edges = materialise(small, "edges")
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = state
