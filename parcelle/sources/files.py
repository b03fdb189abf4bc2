"""Sources over landed files and databases.

All readers use explicit schemas (no inference pass over the data) and return
DataFrames; nothing is buffered on the driver.
"""

from __future__ import annotations

import csv
import logging
import re
from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from parcelle.operators.clean import unprocessed
from parcelle.schema import GEOJSON, LISTINGS_RAW, SALE_ROWS

log = logging.getLogger(__name__)

# Fixed value: the type of each member of a feature collection.
FEATURE_MARK = '"Feature"'


# ------------------------------------------------------------------ A1
def read_listings(spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet") -> DataFrame:
    """The raw listing collection as landed (Parquet or JSON lines).

    Fields of the listing schema that a landing lacks are null, in the whole
    collection or in some of its files; Parquet keeps further fields it has."""
    schema = LISTINGS_RAW
    if fmt == "parquet":
        found = spark.read.parquet(path).schema
        schema = StructType([*found.fields, *[f for f in LISTINGS_RAW.fields if f.name not in found.names]])
    return spark.read.format(fmt).schema(schema).load(path)


def read_unprocessed(spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet",
                     limit: int | None = None) -> DataFrame:
    """Unprocessed listings, an ordered batch of ``limit`` rows, projected to
    the cleaning fields. Filter and projection reach the scan (Parquet
    pushdown); the limit over a total order is a distributed top-k."""
    return unprocessed(read_listings(spark, path, fmt), limit)


# ------------------------------------------------------------------ A2 / H1
def sale_headers(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``header, files``: the files of each distinct header line, from one distributed scan.

    The header is the first line of a file that names a sale column; a file without such a line has none of the
    columns and is left out. Lines that name no column, which is nearly all, cost one substring search."""
    lines = spark.read.option("encoding", "UTF-8").text(paths)
    named = F.col("value").contains("_") & reduce(lambda a, c: a | F.col("value").contains(c), SALE_ROWS.names, F.lit(False))
    first = (lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
             .withColumn("at", F.monotonically_increasing_id()).filter(named)
             .groupBy("file").agg(F.min_by("value", F.struct("block", "at")).alias("header")))
    return first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"))


def header_names(line: str) -> list[str]:
    """The column names of a header line; of a repeated name the later ones get a name that no reader asks for."""
    names = next(csv.reader([line.removeprefix("\ufeff")]))
    return [n if n and n not in names[:i] else f"_unnamed{i}" for i, n in enumerate(names)]


def _plain_path(uri: str) -> str:
    """The path of a file that a scan named, with pattern characters taken as they are."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", unquote(uri))


def read_sales(spark: SparkSession, paths: str | Sequence[str], partitions: int | None = None) -> DataFrame:
    """Yearly open-data CSV files (header, comma, UTF-8, all columns strings),
    read as one relation (union of the years). ``paths`` are files, folders or
    globs. Columns are found by the name in each file's own header, so years
    with other columns or another order may lie in one folder; other columns
    are ignored, a missing one is empty. One scan finds the headers, then the
    files of each distinct header are one read: the number of reads follows
    the formats, not the files. Gzip files are not splittable:
    each one is a single scan task, so pass ``partitions`` to spread the rows
    before the per-row work."""
    def one(header: str, files: list[str]) -> DataFrame:
        names = header_names(header)
        rows = (spark.read.schema(StructType([StructField(n, StringType()) for n in names])).option("header", True).option("sep", ",")
                .option("encoding", "UTF-8").option("mode", "PERMISSIVE").csv(files))
        # CSV gives null for an empty cell; the source treats it as an empty string
        return rows.select(*[(F.coalesce(F.col(f"`{c}`"), F.lit("")) if c in names else F.lit("")).alias(c) for c in SALE_ROWS.names])

    # the driver holds the file names, as it does for any scan of them; they come as URIs
    found = [one(r.header, [_plain_path(f) for f in r.files]) for r in sale_headers(spark, paths).orderBy("header").toLocalIterator()]
    if not found:
        return spark.createDataFrame([], SALE_ROWS)
    df = reduce(DataFrame.unionAll, found)
    return df.repartition(partitions) if partitions else df


# ------------------------------------------------------------------ A3 / A4 landed pages
def read_payload_files(spark: SparkSession, path: str | Sequence[str], department: str | None = None) -> DataFrame:
    """One row per landed file (``page_id`` = file path, ``payload`` = text);
    a page is small and bounded, so whole-file rows are safe."""
    df = spark.read.option("wholetext", True).text(path)
    out = df.select(F.input_file_name().alias("page_id"), F.col("value").alias("payload"))
    if department is not None:
        out = out.withColumn("department", F.lit(department))
    return out


def read_page_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Landed HTML result pages: ``page_id``, ``url`` (file path), ``html``."""
    df = spark.read.option("wholetext", True).text(path)
    return df.select(F.input_file_name().alias("page_id"), F.input_file_name().alias("url"),
                     F.col("value").alias("html"))


# ------------------------------------------------------------------ A5
def read_query(spark: SparkSession, query: str, args: Mapping | Sequence | None = None) -> DataFrame:
    """Parametrised SQL over registered tables (bound parameters, no string
    formatting). Errors are logged and re-raised."""
    try:
        return spark.sql(query, args=args)
    except Exception:
        log.exception("query failed: %s", query)
        raise


def read_jdbc(spark: SparkSession, url: str, query: str, properties: Mapping[str, str] | None = None,
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """A database query as a DataFrame; with a partition column the read is
    split into ``num_partitions`` parallel range queries."""
    reader = spark.read.format("jdbc").option("url", url)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (reader.option("dbtable", f"({query}) q").option("partitionColumn", partition_column)
                  .option("lowerBound", lower).option("upperBound", upper)
                  .option("numPartitions", num_partitions))
    else:
        reader = reader.option("query", query)
    try:
        return reader.load()
    except Exception:
        log.exception("jdbc query failed: %s", query)
        raise


# ------------------------------------------------------------------ A6
def read_dimension(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """``SELECT *`` of a dimension table (catalog name or path)."""
    if "/" in name_or_path:
        return spark.read.format(fmt).load(name_or_path)
    return spark.table(name_or_path)


# ------------------------------------------------------------------ A7
def read_geojson(spark: SparkSession, path: str | Sequence[str], split: bool = True) -> DataFrame:
    """Feature collections to rows ``code, nom, geometry`` (geometry kept as
    its JSON text).

    A file is cut at the features' own ``"Feature"`` marks, so a large one is
    read by many tasks. That needs ``type`` to be the first member of each
    feature, as exporters write it, and no other value of that text; a feature
    that cannot be read so raises. ``split=False`` takes any order, a file a task."""
    if not split:
        fc = spark.read.option("multiLine", True).schema(GEOJSON).json(path)
        f = fc.select(F.explode("features").alias("f"))
    else:
        parts = spark.read.option("lineSep", FEATURE_MARK).text(path)
        # a mark follows the start of its feature, or is none; the last part ends the file
        end = F.substring("value", -200, 200)
        fits = end.rlike(r'\{\s*"type"\s*:\s*$') | end.rlike(r"[}\]]\s*$") | F.col("value").rlike(r"^[\s\ufeff]*$")
        wrong = F.raise_error(F.concat(F.lit("not a feature that starts with its type, after: "), end)).cast("boolean")
        parts = parts.filter(F.when(fits, F.lit(True)).otherwise(wrong))
        # what stands before the first mark opens the collection; a parser stops at the end of the feature
        parts = parts.filter(F.col("value").rlike(r"^\s*,"))
        feature = GEOJSON["features"].dataType.elementType
        schema = StructType([*feature.fields, StructField("_bad", StringType())])
        read = F.from_json(F.concat(F.lit('{"type":' + FEATURE_MARK), "value"), schema, {"columnNameOfCorruptRecord": "_bad"})
        f = parts.select(read.alias("f"))
        bad = F.raise_error(F.concat(F.lit("not a feature: "), F.substring("f._bad", 1, 200))).cast("boolean")
        f = f.filter(F.when(F.col("f._bad").isNull(), F.lit(True)).otherwise(bad))
    return f.select(F.col("f.properties.code").alias("code"), F.col("f.properties.nom").alias("nom"),
                    F.col("f.geometry").alias("geometry"))
