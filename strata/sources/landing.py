"""Landing zone -> bronze: read daily CSV drops, stamp lineage, load by day.

Layout: ``<root>/ingest_date=<yyyy-MM-dd>/<entity>.csv`` (one file, or a
folder of part files, per entity per day).  One read covers every day of an
entity: the day comes from the path as an inferred ``date`` partition column,
so there is no driver loop over days and a new day is just another folder.

Every column is read as text (nothing inferred; typing happens in silver).
CSV columns bind by *position* inside one read, so files are grouped by their
header line first (``by_header``, the default) and the groups are joined by
name: a column inserted, appended or moved on a later day is safe.  A read by
position checks every file's header against the expected columns and fails on
a mismatch.
"""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField

from strata.sinks.writers import clear_days, write_days
from strata.sources.contracts import LINEAGE_COLUMNS, all_text
from strata.sources.tables import read_table

DEFAULT_PATTERN = "ingest_date=*/{entity}.csv"
CORRUPT = "_corrupt_record"
FILE_BYTES = 8 << 20


def lineage(df: DataFrame, ingestion_ts: Column | None = None) -> DataFrame:
    """Stamp ``ingestion_ts`` (now) and ``source_file`` (the file each row came from).

    ``ingest_date`` is the partition column of the landing path.  A frame
    read by ``read_landing`` already carries ``source_file`` (the file
    metadata column only resolves directly above a scan)."""
    stamps = {"ingestion_ts": ingestion_ts if ingestion_ts is not None else F.current_timestamp()}
    if "source_file" not in df.columns:
        stamps["source_file"] = F.col("_metadata.file_path")
    return df.withColumns(stamps)


def _with_source(df: DataFrame) -> DataFrame:
    return df.withColumn("source_file", F.col("_metadata.file_path"))


def _reader(spark: SparkSession, base: str, delimiter: str):
    return (spark.read.option("header", True).option("delimiter", delimiter)
            .option("basePath", base).option("mode", "PERMISSIVE"))


def _base_path(root: str, pattern: str, entity: str) -> str:
    """The folder above the ``ingest_date=`` level (where partition discovery starts)."""
    prefix = pattern.format(entity=entity).split("ingest_date=")[0].strip("/")
    return f"{root}/{prefix}" if prefix else root


def header_names(line: str, delimiter: str = ",") -> tuple[str, ...]:
    """Column names of a CSV header line (quotes and a byte-order mark removed).

    An empty line, an empty or repeated name, or a name that the load adds
    itself can't be a header: reading on would lose or overwrite columns."""
    fields = next(csv.reader([line.lstrip("﻿").strip()], delimiter=delimiter), [])
    names = tuple(f.strip() for f in fields)
    if not names or not all(names) or len({n.lower() for n in names}) < len(names):
        raise ValueError(f"not a header line: {line!r}")
    if reserved := {n.lower() for n in names} & {*LINEAGE_COLUMNS, CORRUPT}:
        raise ValueError(f"header names reserved columns {sorted(reserved)}: {line!r}")
    return names


def file_headers(spark: SparkSession, glob: str, base: str) -> DataFrame:
    """(file, ingest_date, header, size): the first line and the bytes of every landing file.

    One distributed text scan (so any codec Spark reads works), reduced to a
    row per file inside the tasks."""
    lines = spark.read.option("basePath", base).text(glob)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                         F.col("_metadata.file_size").alias("size"), F.monotonically_increasing_id().alias("place"), "ingest_date", "value")
    return lines.filter("block = 0").groupBy("file", "ingest_date").agg(F.min_by("value", "place").alias("header"), F.max("size").alias("size"))


def header_drift(spark: SparkSession, root: str, entity: str, expected: Sequence[str], pattern: str = DEFAULT_PATTERN,
                 delimiter: str = ",") -> DataFrame:
    """(ingest_date, change, column): how each day's headers differ from ``expected``.

    ``added`` and ``missing`` compare names without case; ``renamed`` are names that differ in case only; ``moved``
    are expected columns whose place among the header's expected columns is not that of the contract.
    Headers are reduced to the distinct ones of a day first; a day that agrees has no row."""
    root = root.rstrip("/")
    headers = file_headers(spark, f"{root}/{pattern.format(entity=entity)}", _base_path(root, pattern, entity)).select("ingest_date", "header").distinct()
    names = F.transform(F.split(F.regexp_replace("header", "^\ufeff", ""), F.lit(f"[{delimiter}]")), lambda c: F.regexp_replace(F.trim(c), '^"(.*)"$', "$1"))
    agreed = F.array(*[F.lit(c) for c in expected])
    low = F.transform("names", lambda c: F.lower(c))
    low_agreed = F.transform(agreed, lambda c: F.lower(c))

    def rows(change: str, columns: Column) -> Column:
        return F.transform(columns, lambda c: F.struct(F.lit(change).alias("change"), c.alias("column")))

    found = F.filter(low, lambda c: F.array_contains(low_agreed, c))  # the expected columns in the header's order
    due = F.filter(agreed, lambda c: F.array_contains(low, F.lower(c)))  # and in the contract's
    changes = F.concat(
        rows("added", F.filter("names", lambda c: ~F.array_contains(low_agreed, F.lower(c)))),
        rows("missing", F.filter(agreed, lambda c: ~F.array_contains(low, F.lower(c)))),
        rows("renamed", F.filter("names", lambda c: F.array_contains(low_agreed, F.lower(c)) & ~F.array_contains(agreed, c))),
        rows("moved", F.filter(due, lambda c: F.array_position(found, F.lower(c)) != F.array_position(due, c))))
    return headers.select("ingest_date", names.alias("names")).select("ingest_date", F.explode(changes).alias("c")).select("ingest_date", "c.*").distinct()


def _groups(spark: SparkSession, glob: str, base: str, delimiter: str) -> tuple[dict[tuple[str, ...], list[str]], dict[str, int], int]:
    """Paths to read by header, the bytes of each day, and the number of files.  Only days and their distinct
    headers reach the driver; single files only for days that mix several headers."""
    found = file_headers(spark, glob, base)
    days = found.groupBy("ingest_date").agg(F.collect_set("header").alias("headers"), F.sum("size").alias("size"), F.count(F.lit(1)).alias("files")).collect()
    files = sum(r["files"] for r in days)
    sizes = {str(r["ingest_date"]): r["size"] for r in days}
    named = {r["ingest_date"]: {header_names(h, delimiter) for h in r["headers"]} for r in days}
    headers = {h for hs in named.values() for h in hs}
    if len(headers) == 1:
        return {headers.pop(): [glob]}, sizes, files
    groups: dict[tuple[str, ...], list[str]] = {}
    pure: dict[tuple[str, ...], list[str]] = {}
    for day, hs in named.items():
        if len(hs) == 1:
            pure.setdefault(next(iter(hs)), []).append(str(day))
    for header, some in pure.items():
        groups[header] = [_for_days(glob, some)]
    mixed = [day for day, hs in named.items() if len(hs) > 1]
    if mixed:
        for r in found.filter(F.col("ingest_date").isin(mixed)).select("file", "header").collect():
            groups.setdefault(header_names(r["header"], delimiter), []).append(r["file"])
    return groups, sizes, files


def _for_days(glob: str, days: Sequence[str]) -> str:
    head, _, tail = glob.partition("ingest_date=")
    return f"{head}ingest_date={{{','.join(sorted(days))}}}/{tail.partition('/')[2]}"


def read_landing(
    spark: SparkSession,
    root: str,
    entity: str,
    columns: Sequence[str] | None = None,
    pattern: str = DEFAULT_PATTERN,
    delimiter: str = ",",
    by_header: bool = True,
    days: Sequence[str] | None = None,
    keep_corrupt: bool = False,
) -> DataFrame:
    """All days (or only ``days``) of one entity as text columns plus the
    ``ingest_date`` partition and ``source_file``.

    Empty fields read as null.  ``by_header`` binds columns by name, whatever
    their order in a file; without it ``columns`` (default: one file's header)
    bind by position, and a file whose header differs fails the read.
    ``keep_corrupt`` adds ``_corrupt_record`` with the text of rows that
    don't fit their header.  With ``days`` the path glob names those day
    folders, so only they are listed, however many days the zone holds."""
    return _read(spark, root, entity, columns, pattern, delimiter, by_header, days, keep_corrupt)[0]


def _read(spark: SparkSession, root: str, entity: str, columns: Sequence[str] | None, pattern: str, delimiter: str, by_header: bool,
          days: Sequence[str] | None, keep_corrupt: bool) -> tuple[DataFrame, dict[str, int], int]:
    """``read_landing`` and, as far as the header scan tells, the bytes of each day and the number of files."""
    root = root.rstrip("/")
    glob = f"{root}/{pattern.format(entity=entity)}"
    if days:
        glob = _for_days(glob, days)
    base = _base_path(root, pattern, entity)

    def schema_of(names: Sequence[str]):
        return all_text([*names, *([CORRUPT] if keep_corrupt else [])]).add(StructField("ingest_date", DateType(), True))

    if by_header:
        groups, sizes, files = _groups(spark, glob, base, delimiter)
        if not groups:
            raise FileNotFoundError(glob)
        out = None
        for header, paths in groups.items():
            frame = _with_source(_reader(spark, base, delimiter).schema(schema_of(header)).csv(paths))
            out = frame if out is None else out.unionByName(frame, allowMissingColumns=True)
        return out, sizes, files
    reader = _reader(spark, base, delimiter).option("enforceSchema", False)
    if columns is None:
        columns = [f.name for f in reader.option("inferSchema", False).csv(glob).schema.fields if f.name != "ingest_date"]
    return _with_source(reader.schema(schema_of(columns)).csv(glob)), {}, 0


def gathered(sizes: Mapping[str, int], files: int) -> bool:
    """Whether landing files hold whole days, or large parts of them, so that writing a file
    for each as it is read leaves a day in few files: up to two a day, and one per ``FILE_BYTES``."""
    return 0 < files <= 2 * len(sizes) + sum(sizes.values()) // FILE_BYTES


def ingest_entity(
    spark: SparkSession,
    landing_root: str,
    bronze_path: str,
    entity: str,
    columns: Sequence[str] | None = None,
    pattern: str = DEFAULT_PATTERN,
    days: Sequence[str] | None = None,
    by_header: bool = True,
    keep_corrupt: bool = False,
    cluster: bool = False,
) -> DataFrame:
    """Load one entity into bronze and return the written table.

    Only the days carried are replaced; with ``days`` only those folders are
    listed and read, and each of them is replaced even if it has no rows any
    more.  Running it twice leaves one copy.

    ``cluster`` gathers each day of a backfill before the write, unless its files hold
    whole days as they are (see ``gathered``): those are written as they are read, without an exchange."""
    df, sizes, files = _read(spark, landing_root, entity, columns, pattern, ",", by_header, days, keep_corrupt)
    if days:
        df = df.filter(F.col("ingest_date").isin([F.lit(d).cast("date") for d in days]))
    seen = Observation()
    out = lineage(df).observe(seen, F.collect_set(F.col("ingest_date").cast("string")).alias("days"))
    write_days(out, bronze_path, cluster=cluster and not gathered(sizes, files), sizes=sizes)
    if days:
        clear_days(spark, bronze_path, sorted(set(days) - set(seen.get["days"])))
    return read_table(spark, bronze_path)


def ingest_audit(df: DataFrame, day_col: str = "ingest_date", sort: bool = True) -> DataFrame:
    """Rows per day (a small result: one row per day), oldest first unless
    ``sort=False`` (for a result that is combined further anyway); with the
    number of ``corrupt_rows`` if the table keeps them."""
    counts = [F.count(F.lit(1)).alias("rows")]
    if CORRUPT in df.columns:
        counts.append(F.count(CORRUPT).alias("corrupt_rows"))
    out = df.groupBy(day_col).agg(*counts)
    return out.orderBy(day_col) if sort else out


def lineage_audit(df: DataFrame, day_col: str = "ingest_date") -> DataFrame:
    """Per day: rows, distinct load stamps, rows without a stamp, and rows
    whose source file doesn't lie in the day's folder."""
    inside = F.col("source_file").contains(F.concat(F.lit(f"/{day_col}="), F.col(day_col).cast("string"), F.lit("/")))
    return df.groupBy(day_col).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("ingestion_ts").alias("stamps"),
        F.count_if(F.col("ingestion_ts").isNull()).alias("unstamped"), F.count_if(~F.coalesce(inside, F.lit(False))).alias("misplaced"))
