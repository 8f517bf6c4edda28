"""Files of the lake: raw snapshots, static documents, partitioned parquet, metrics."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import LOCAL_ZONE
from ..schemas import RAW_POSITION

CORRUPT = "_corrupt_record"


def read_snapshots(spark: SparkSession, path: str, date: str) -> DataFrame:
    """Raw snapshots (gzip JSON arrays named HHMMSS) of a date with the time in each file's
    name. Identifiers are strings by schema; broken records keep their text in
    _corrupt_record, unreadable files are passed over."""
    schema = T.StructType([*RAW_POSITION.fields, T.StructField(CORRUPT, T.StringType())])
    raw = spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("ignoreCorruptFiles", True).json(path)
    clock = F.regexp_extract("_metadata.file_name", r"(\d{6})", 1)
    at = F.to_utc_timestamp(F.to_timestamp(F.concat(F.lit(f"{date} "), clock), "yyyy-MM-dd HHmmss"), LOCAL_ZONE)
    return raw.withColumn("SnapshotTime", F.date_format(at, "yyyy-MM-dd'T'HH:mm:ssXXX"))


def write_raw(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("compression", "gzip").json(path)


def read_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Static documents, gzip JSON arrays."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def write_partitioned(df: DataFrame, path: str, *partitions: str, order: tuple[str, ...] = (), files: int | None = None, mode: str = "overwrite") -> None:
    """Partitioned parquet, zstd. Dynamic overwrite replaces only the partitions present.
    With files, so many for each partition value at most; rows are ordered within files."""
    if files:
        df = df.repartition(*[F.col(c) for c in partitions], F.pmod(F.hash(*df.columns), F.lit(files)))
    if order:
        df = df.sortWithinPartitions(*partitions, *order)
    df.write.mode(mode).option("compression", "zstd").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def append_metrics(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def table_metadata(spark: SparkSession, table: str) -> DataFrame:
    """Columns of a catalog table: name, type, whether null, whether a partition."""
    rows = [(c.name, c.dataType, c.nullable, c.isPartition) for c in spark.catalog.listColumns(table)]
    return spark.createDataFrame(rows, "name string, type string, nullable boolean, is_partition boolean")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder of spark.checkpoint.dir. Where it is unset, a
    local session, which is one process, gets a folder of its own; a cluster's raises."""
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("the session names no spark.checkpoint.dir")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-"))
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df written to a new folder of the shared ones, and read back."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """df numbered from 1 in a total order. Rows go into ranges of it, each numbered by itself
    from where the ranges before it end, so no task holds all."""
    ranged = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    rows = written(ranged, "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = rows.groupBy("_range").agg(F.count("*").alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return rows.withColumn("_row", own).join(F.broadcast(starts), "_range").withColumn(name, (F.col("_start") + F.col("_row")).cast("int")).drop("_range", "_row", "_start")


def write_table(df: DataFrame, name: str, partitions: Sequence[str], order: Sequence[str]) -> None:
    """df as a table of the catalog, replaced if it exists: partitioned, and sorted within
    files by the columns that are looked up, so that files and row groups can be passed over.
    Tasks have ranges of that order, not whole partitions, of which there may be a few large
    ones; a range in two partitions is two files."""
    rows = df.repartitionByRange(*partitions, *order).sortWithinPartitions(*partitions, *order)
    rows.write.mode("overwrite").option("compression", "zstd").partitionBy(*partitions).saveAsTable(name)


def write_clustered(df: DataFrame, name: str, keys: Sequence[str], buckets: int, order: Sequence[str] = ()) -> None:
    """df as a table of the catalog, replaced if it exists, in buckets by keys and sorted in each:
    joins and aggregations by all of the keys read a bucket a task and shuffle nothing, joins with
    tables of as many buckets included. A bucket is one file."""
    rows = df.repartition(buckets, *keys).sortWithinPartitions(*keys, *order)
    rows.write.mode("overwrite").option("compression", "zstd").bucketBy(buckets, *keys).sortBy(*keys, *order).saveAsTable(name)


def read_table(spark: SparkSession, name: str, columns: Sequence[str]) -> DataFrame:
    """Some columns of a catalog table; partitions and columns not asked for are not read."""
    return spark.table(name).select(*columns)


def row_counts(df: DataFrame) -> DataFrame:
    """Rows of each file of a table; no column is read for it."""
    return df.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("n_rows"))
