"""Writing layer tables and delimited extracts."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

DIRECT_COMMIT = ("mapreduce.fileoutputcommitter.algorithm.version", "2")
# layer tables are mostly text and near-unique keys, which snappy hardly shrinks
CODEC = ("compression", "zstd")
# landing bytes (perhaps compressed) for one task of a backfill that is dealt by day
TASK_BYTES = 32 << 20


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Full overwrite of a Parquet table (optionally partitioned; a
    partitioned table is clustered by its partition columns first, see
    ``cluster_by``).  Partitions that ``df`` doesn't have go too, whatever
    the session's overwrite mode."""
    if partition_by:
        (cluster_by(df, *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "static").option(*CODEC)
         .partitionBy(*partition_by).parquet(path))
    else:
        df.write.mode("overwrite").option(*CODEC).parquet(path)


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """``write_table`` for a frame that may read the table it replaces: the new
    table is written beside the old one, which goes only when it is complete."""
    path = path.rstrip("/")
    write_table(df, f"{path}__next", partition_by)
    _put_in_place(df.sparkSession, path)


def replace_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """``replace_table``, the rows hashed into ``buckets`` by ``keys``; a frame that is already
    dealt by them into as many tasks is written without an exchange, one file per bucket.

    The folder says by its mark how it is bucketed, so ``tables.read_bucketed`` needs no
    catalog entry of an earlier session; to every other reader it is a plain Parquet table."""
    spark, path = df.sparkSession, path.rstrip("/")
    fs, following = _file_system(spark, f"{path}__next")
    entry = f"strata_{uuid.uuid4().hex}"
    (df.write.mode("overwrite").format("parquet").option(*CODEC).option("path", fs.makeQualified(following).toString())
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(entry))
    spark.sql(f"DROP TABLE {entry}")  # an outside table: the files stay
    if any(f.getPath().getName().startswith("part-") for f in fs.listStatus(following)):
        fs.create(_file_system(spark, f"{path}__next/{bucket_mark(keys)}{buckets}")[1]).close()
    else:  # no row, so no bucket has a file to hold the schema
        write_table(spark.createDataFrame([], df.schema), f"{path}__next")
    _put_in_place(spark, path)


def bucket_mark(keys: Sequence[str]) -> str:
    """Name, but for the number of buckets, of the hidden file that marks a bucketed folder; a plain overwrite takes it away with the rows."""
    return f"_buckets-{'+'.join(keys)}-"


def _put_in_place(spark: SparkSession, path: str) -> None:
    fs, folder = _file_system(spark, path)
    following = _file_system(spark, f"{path}__next")[1]
    if fs.exists(folder):
        fs.delete(folder, True)
    if not fs.rename(following, folder):
        raise OSError(f"{path}__next could not be put in place of {path}")


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """A catalog table at ``path``, hashed into ``buckets`` by ``keys`` and sorted by them inside each.

    Joins on and sums by these keys then read matching buckets side by side,
    without an exchange or sort of their own.  Rows are dealt by the same hash
    first, so every bucket is one file.  The table is read back and returned."""
    (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))
    return df.sparkSession.table(table)


def write_observed(df: DataFrame, path: str, flags: Sequence[str], partition_by: Sequence[str] = ()) -> dict[str, int]:
    """``write_table``, counting the rows and those with each flag true as they pass: no second scan."""
    seen = Observation()
    write_table(df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(f)).alias(f) for f in flags]), path, partition_by)
    return {name: int(n) for name, n in seen.get.items()}


def cluster_by(df: DataFrame, *cols: str) -> DataFrame:
    """Gather rows by ``cols`` before a partitioned write (a ``REBALANCE``).

    Each value of ``cols`` then lands in few files instead of one file per
    writing task.  Adaptive execution sizes the result: a value holding a
    large share of the rows is split over several tasks, small ones are
    packed together, so a hot day never ends up in one task."""
    return df.hint("rebalance", *cols)


def spread_days(df: DataFrame, sizes: Mapping[str, int], day_col: str = "ingest_date", tasks: int | None = None) -> DataFrame:
    """Pack many days of known bytes into ``tasks`` (default: the cluster's slots, more for a load of
    more than ``TASK_BYTES`` a slot, so that no task's sort outgrows its memory) for a partitioned write.

    A backfill of thousands of small days costs a file each, not their bytes, so the
    days are dealt over all tasks (``cluster_by`` goes by bytes and would leave
    them to one).  A day above a task's even share is split over as many tasks as shares it holds."""
    total = sum(sizes.values())
    if tasks is None:
        slots = df.sparkSession.sparkContext.defaultParallelism
        tasks = max(min(slots, len(sizes)), -(-total // TASK_BYTES))
    else:
        tasks = min(tasks, len(sizes))
    tasks = max(1, tasks)
    share = max(1, -(-total // tasks))
    parts = {day: min(tasks, -(-size // share)) for day, size in sizes.items() if size > share}
    part = F.lit(0).cast("long")
    for n in sorted(set(parts.values())):
        days = [F.lit(day).cast("date") for day, k in parts.items() if k == n]
        part = F.when(F.col(day_col).isin(days), F.pmod(F.xxhash64(*df.columns), F.lit(n).cast("long"))).otherwise(part)
    return df.repartition(tasks, F.col(day_col), part)


def write_days(df: DataFrame, path: str, day_col: str = "ingest_date", cluster: bool = False, sizes: Mapping[str, int] | None = None) -> None:
    """Replace only the days present in ``df`` (dynamic partition overwrite).

    Re-running a load, or a task retry, rewrites its days instead of
    appending them a second time, so a load is idempotent.  A daily load
    writes map-side (one file per input split, no shuffle); ``cluster=True``
    suits a backfill of many days, where that would mean one file per task
    and day (see ``cluster_by``; with the days' ``sizes``, ``spread_days``).  A path that a streaming query writes is
    refused: its readers follow the stream's log and would not see these files.

    Tasks commit straight into the staging folder that a dynamic overwrite
    publishes from (committer version 2): with one file per day, renaming each a
    second time on the driver costs more than writing it, and nobody reads the staging folder."""
    if _exists(df.sparkSession, f"{path.rstrip('/')}/_spark_metadata"):
        raise ValueError(f"{path} is written by a streaming query; load it with that query only")
    out = df
    if cluster:
        out = spread_days(df, sizes, day_col) if sizes else cluster_by(df, day_col)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option(*DIRECT_COMMIT).option(*CODEC)
     .partitionBy(day_col).parquet(path))


def clear_days(spark: SparkSession, path: str, days: Sequence[str], day_col: str = "ingest_date") -> None:
    """Remove whole days from a table partitioned by ``day_col``."""
    for day in days:
        fs, folder = _file_system(spark, f"{path.rstrip('/')}/{day_col}={day}")
        fs.delete(folder, True)


def _file_system(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def _exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _file_system(spark, path)
    return fs.exists(folder)


def export_days(df: DataFrame, path: str, day_col: str = "ingest_date", delimiter: str = ";") -> None:
    """Delimited extracts of a table by day, ``<path>/<day_col>=<d>/``; only
    the days of ``df`` are replaced.  The day is a column of the files too."""
    names = df.columns
    out = cluster_by(df.withColumn(f"__{day_col}", F.col(day_col)), f"__{day_col}")
    out = out.select(*names, F.col(f"__{day_col}"))
    folders = out.withColumnsRenamed({day_col: f"{day_col} ", f"__{day_col}": day_col})
    (folders.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("header", True)
     .option("delimiter", delimiter).partitionBy(day_col).csv(path))


def export_csv(df: DataFrame, path: str, delimiter: str = ";", header: bool = True,
               single_file: bool = False, trim_edges: bool = True) -> None:
    """Delimited extract of a table.

    ``single_file=True`` moves all rows to one task for the write (a
    ``repartition(1)``: the stage computing ``df`` keeps its parallelism,
    unlike ``coalesce(1)``, which would pull it into that one task too);
    keep it for small outputs.
    ``trim_edges`` is Spark's default on write (leading/trailing blanks are
    dropped); pass False to keep text exactly.
    """
    out = df.repartition(1) if single_file else df
    (out.write.mode("overwrite")
     .option("header", header)
     .option("delimiter", delimiter)
     .option("ignoreLeadingWhiteSpace", trim_edges)
     .option("ignoreTrailingWhiteSpace", trim_edges)
     .csv(path))
