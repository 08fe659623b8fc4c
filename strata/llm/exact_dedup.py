"""Exact duplicate removal by a tree merge of sorted digest runs.

Every partition of the scan is one run: its distinct texts' SHA-256 digests
with the largest id seen and the number of rows.  Runs then merge in rounds;
in round ``k`` the runs whose number agrees above ``k`` times ``log2(fan_in)``
bits meet, as in a binomial tree, and every round keeps one entry per digest
with the best id.  Rows move by (run group, digest), sorted inside the tasks, so a
merge is never one task's work, and a digest that holds a third of all rows
has one entry per run after the first step.

Texts are equal when identical (null reads as the empty text).  An entry
stands for one (digest, length in bytes) pair: two texts share it only if they are
the same text, SHA-256 having no known collisions.

Defined results: of equal texts the row with the largest id stays; a null
id is smaller than any other; among rows that also share the id one stays
(rows are told apart by their place in the digest table, which is written
once); an empty table gives an empty result; other columns are ignored by
``duplicates`` and passed through by ``drop_duplicates``, whatever their names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import scratch_path

FAN_IN_BITS = 3


def text_digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of the text's UTF-8 bytes; null is the empty text."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per row of ``docs``, written once: ids, digest, run and place."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.unhex(text_digest(F.col(text_col))).alias("digest"),
                       F.coalesce(F.octet_length(text_col), F.lit(0)).alias("size"))
    path = scratch_path(spark, "digests")
    rows.withColumns({"run": F.spark_partition_id(), "place": F.monotonically_increasing_id()}).write.parquet(path)
    return spark.read.schema("id long, digest binary, size int, run int, place long").parquet(path)


def merge_runs(digests: DataFrame, fan_in_bits: int = FAN_IN_BITS) -> DataFrame:
    """(digest, size, best, n): the row that stays and the number of rows, per text."""
    last = digests.agg(F.max("run")).first()[0] or 0
    runs = (digests.withColumn("best", F.struct("id", "place"))
            .groupBy("run", "digest", "size").agg(F.max("best").alias("best"), F.count(F.lit(1)).alias("n")))
    while last:
        last >>= fan_in_bits
        # the runs of a group meet: same digests side by side, merged into one entry each
        runs = (runs.withColumn("run", F.shiftright("run", fan_in_bits))
                .groupBy("run", "digest", "size").agg(F.max("best").alias("best"), F.sum("n").alias("n")))
    return runs.select("digest", "size", "best", "n")


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in_bits: int = FAN_IN_BITS) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256."""
    digests = _digests(docs, id_col, text_col)
    groups = merge_runs(digests, fan_in_bits)
    return (digests.join(groups, ["digest", "size"])
            .select(F.col("id").alias(id_col), F.col("best.id").alias("keep_id"), F.col("n").alias("group_size"),
                    (F.col("place") == F.col("best.place")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in_bits: int = FAN_IN_BITS) -> DataFrame:
    """The rows of ``docs`` that stay, all their columns as they are."""
    names = docs.columns
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    own = own.withColumns({"digest": F.unhex(text_digest(F.col(f"row.`{text_col}`"))), "id": _known(F.col(f"row.`{id_col}`").cast("long"))})
    best = merge_runs(_digests(docs, id_col, text_col), fan_in_bits).select("digest", _known(F.col("best.id")).alias("id"))
    # copies differ in id, so a hot text is dealt over all tasks; rows that repeat
    # both text and id lie together already, and one of them stays
    kept = own.join(best, ["digest", "id"], "left_semi").groupBy("digest", "id").agg(F.first("row").alias("row"))
    return kept.select("row.*")


def _known(id_: Column) -> Column:
    return F.coalesce(id_, F.lit(-(1 << 63)))
