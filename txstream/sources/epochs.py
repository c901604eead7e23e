"""Consumer groups over the library's epoch tables (``streaming.epoch_sink``).

The table's own commit log tells what to read: a group follows the commit files, one an epoch,
and opens only the data files they list.  ``start="latest"`` notes the last committed epoch when the
group is created -- the names of the commit folders are listed, nothing is opened -- and prunes the
commit log by it, so neither commit files nor data files of the past are ever opened, however long
the backlog is.  An epoch committed later has a higher number and is read, however long ago its
tasks began.  A group is a checkpoint folder; a restart goes on behind the last finished batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from txstream.sources.fs import list_dirs, mkdirs, path_exists, read_text, write_text
from txstream.sources.groups import STARTS
from txstream.streaming.epoch_sink import COMMIT_SCHEMA, COMMITS, DATA


def last_epoch(spark: SparkSession, path: str) -> int:
    """Number of the newest committed epoch, -1 before the first."""
    names = [n for n in list_dirs(spark, f"{path}/{COMMITS}") if n.startswith("epoch=")]
    done = sorted((int(n[6:]) for n in names), reverse=True)
    return next((e for e in done if path_exists(spark, f"{path}/{COMMITS}/epoch={e}/commit.json")), -1)


def create_group(spark: SparkSession, path: str, group: str, start: str = "earliest") -> int:
    """Create the group once; returns the epoch after which it reads (an existing group's stays)."""
    if start not in STARTS:
        raise ValueError(f"start must be one of {STARTS}, not {start!r}")
    marker = f"{group}/_group_start/after"
    if path_exists(spark, marker):
        return int(read_text(spark, marker))
    after = last_epoch(spark, path) if start == "latest" else -1
    mkdirs(spark, f"{group}/_group_start")
    write_text(spark, marker, str(after))
    return after


def consume(spark: SparkSession, path: str, schema, group: str, fn, start: str = "earliest",
            max_epochs_per_trigger: int = 100) -> DataStreamWriter:
    """Hand the rows of newly committed epochs to ``fn(rows, batch_id)``, batch by batch.

    A batch is delivered at least once: make ``fn``'s writes idempotent by the batch id.  The files of
    a batch's epochs are listed on the driver, as a file source does.
    """
    after = create_group(spark, path, group, start)
    mkdirs(spark, f"{path}/{COMMITS}")
    commits = (spark.readStream.schema(COMMIT_SCHEMA).option("maxFilesPerTrigger", max_epochs_per_trigger)
               .option("pathGlobFilter", "commit.json").json(f"{path}/{COMMITS}")
               .where(F.col("epoch") > after))

    def each(batch: DataFrame, batch_id: int) -> None:
        names = [r["name"] for r in batch.select(F.explode("files.name").alias("name")).where("name != ''").collect()]
        if names:
            rows = spark.read.schema(schema).parquet(*[f"{path}/{DATA}/{n}" for n in sorted(names)])
        else:
            rows = spark.createDataFrame([], schema)
        fn(rows, batch_id)

    return commits.writeStream.option("checkpointLocation", group).foreachBatch(each)
