"""Reading layer tables (Parquet)."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sinks.writers import bucket_mark


def read_table(spark: SparkSession, path: str, merge_schema: bool = True) -> DataFrame:
    """A Parquet table, plain or hive-partitioned (partition columns inferred).

    ``mergeSchema`` unions the schemas of all files, so a column added on a
    later day is not lost (without it Spark takes one file's schema)."""
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def footer_counts(spark: SparkSession, path: str, by: str) -> DataFrame:
    """(``by``, rows) of a Parquet table partitioned by ``by``, from its files' footers.

    The count is pushed down into the scan (Parquet statistics, the
    data source's second version), so no column of any file is read.  Its
    settings belong to a session of its own: the caller's stay as they are."""
    own = spark.newSession()
    for key, value in (("spark.sql.sources.useV1SourceList", ""), ("spark.sql.parquet.aggregatePushdown", "true")):
        own.conf.set(key, value)
    return own.read.parquet(path).groupBy(by).agg(F.count(F.lit(1)).alias("rows"))


def read_if_exists(spark: SparkSession, path: str, merge_schema: bool = True) -> DataFrame | None:
    """The table at ``path``, or None if there is none (on any filesystem)."""
    try:
        df = read_table(spark, path, merge_schema)
        df.schema  # resolves the file listing
        return df
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def read_bucketed(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame | None:
    """``read_if_exists`` of a table that ``writers.replace_bucketed`` wrote: joins and sums by
    ``keys`` read its buckets as they are.  A folder without the mark is read as a plain table.

    Buckets are known through a catalog entry only; it is made for this frame and dropped again."""
    df = read_if_exists(spark, path, merge_schema=False)
    if df is None:
        return None
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    mark = bucket_mark(keys)
    counts = [int(n.removeprefix(mark)) for n in names if n.startswith(mark)]
    if len(counts) != 1:
        return df
    entry, by = f"strata_{uuid.uuid4().hex}", ", ".join(f"`{k}`" for k in keys)
    location = fs.makeQualified(folder).toString().replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {entry} ({df.schema.toDDL()}) USING parquet CLUSTERED BY ({by}) INTO {counts[0]} BUCKETS LOCATION '{location}'")
    table = spark.table(entry)
    spark.sql(f"DROP TABLE {entry}")
    return table
