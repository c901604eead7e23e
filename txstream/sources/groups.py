"""Consumer groups over file-backed streams (topic tables, the file log).

A group is a checkpoint folder.  Its start point is fixed when the group is first
created: ``earliest`` takes every file, ``latest`` skips the files committed by then.
For ``latest`` the list of those files is written once as a Parquet table inside the
group folder and later anti-joined away on the file of each row
(``_metadata.file_path``); a restart reuses it, so the start never moves.  The list is
complete -- there is no time limit -- so a file committed after the group was created
is read however long ago its task began to write it.  For a stream-written topic the
listing is that of its own metadata log (its last committed batch).  Files are matched
on their last two path components (directory and name), which are the same whatever
URI form a path is reported in.  The list is as long as the topic has files; the join
is a broadcast when that is small and a shuffle join otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from txstream.sources.fs import has_data_files, list_names, path_exists

STARTS = ("earliest", "latest")


def start_marker(group: str) -> str:
    return f"{group}/_group_start"


def create_group(spark: SparkSession, path: str, group: str, start: str = "earliest") -> None:
    """Create the group once; an existing group keeps its original start point."""
    if start not in STARTS:
        raise ValueError(f"start must be one of {STARTS}, not {start!r}")
    marker = start_marker(group)
    if path_exists(spark, f"{marker}/_SUCCESS"):
        return
    files = spark.createDataFrame([], "file string")
    if start == "latest" and has_data_files(spark, path):
        files = spark.read.parquet(path).select(
            _tail_col(F.col("_metadata.file_path")).alias("file")).distinct()
    files.write.mode("overwrite").parquet(marker)


def _tail_col(path_col):
    return F.substring_index(path_col, "/", -2)


def skip_group_start(spark: SparkSession, stream: DataFrame, group: str) -> DataFrame:
    """Drop rows of files that existed when a ``latest`` group was created."""
    seen = spark.read.parquet(start_marker(group)).withColumnRenamed("file", "_file")
    return (stream.withColumn("_file", _tail_col(F.col("_metadata.file_path")))
            .join(seen, "_file", "left_anti").drop("_file"))


def taken_files(spark: SparkSession, group: str) -> DataFrame:
    """``file``: directory and name of every file in the group's finished batches, read from its
    checkpoint (the file source's log and the commit log)."""
    done = [int(n) for n in list_names(spark, f"{group}/commits") if n.isdigit()]
    if not done or not path_exists(spark, f"{group}/sources/0"):
        return spark.createDataFrame([], "file string")
    lines = spark.read.text(f"{group}/sources/0").where("value like '{%'")
    entry = F.from_json("value", "path string, batchId long")
    return (lines.select(entry.alias("e")).where(F.col("e.batchId") <= max(done))
            .select(_tail_col(F.col("e.path")).alias("file")).distinct())


def group_lag(spark: SparkSession, topic: str, group: str, schema, by: str = "partition") -> DataFrame:
    """Per partition of the topic: records at its end, records the group has finished or skipped at
    its start, and the rest, its lag.

    Records are counted a file, from Parquet footers; a file belongs to a group's finished batches
    as a whole.
    """
    counted = (spark.read.schema(schema).parquet(topic)
               .groupBy(F.col(by), _tail_col(F.col("_metadata.file_path")).alias("file"))
               .agg(F.count(F.lit(1)).alias("n")))
    taken = taken_files(spark, group)
    if path_exists(spark, f"{start_marker(group)}/_SUCCESS"):
        taken = taken.unionByName(spark.read.schema("file string").parquet(start_marker(group))).distinct()
    both = counted.join(taken.withColumn("_t", F.lit(1)), "file", "left")
    done = F.coalesce(F.sum(F.when(F.col("_t") == 1, F.col("n"))), F.lit(0))
    return both.groupBy(by).agg(F.sum("n").alias("records"), done.alias("finished"),
                                (F.sum("n") - done).alias("lag"))
