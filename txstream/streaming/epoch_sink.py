"""A streaming sink of one's own: a Python data source whose epochs are all or nothing.

``df.writeStream.format("txstream-epochs").option("path", folder)``.  Every task writes its
rows to one new Parquet file (``data/``; never under a name another attempt uses) and tells the driver
in its commit message the file and its rows.  When all tasks of an epoch have succeeded, the
driver writes one commit file (``_commits/epoch=<id>/commit.json``) that lists the files; only
listed files are part of the table.  So

* a killed or repeated task leaves a file that no commit names,
* a failed epoch leaves none that is named (and ``abort`` deletes those it knows),
* a replayed epoch finds its commit file and changes nothing: exactly once.

``option("keep", "false")`` keeps no rows: a null sink that still counts what it took, by
task and epoch, from the commit messages (``ledger``).

``path`` is a folder all machines share, as a local path or a URI that ``pyarrow.fs`` opens.
Files without a commit are deleted by :func:`vacuum`.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import DataStreamWriter

from txstream.session import ship_package
from txstream.sources.fs import delete, list_names, modification_ms, path_exists

FORMAT = "txstream-epochs"
DATA, COMMITS = "data", "_commits"
COMMIT_SCHEMA = "epoch long, files array<struct<name: string, rows: long>>"


def _filesystem(path: str):
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path.replace("file:/", "file:///", 1)
                                        if path.startswith("file:/") and not path.startswith("file:///") else path)
    return pafs.LocalFileSystem(), path


@dataclass
class Written(WriterCommitMessage):
    """What one task wrote: its file ("" if it keeps none) and its number of rows."""

    name: str
    rows: int


class EpochWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str, keep: bool, first_epoch: int = 0):
        self.path, self.keep, self.first_epoch = path, keep, first_epoch

    def write(self, iterator) -> Written:
        name, rows, writer = "", 0, None
        fs, root = _filesystem(self.path)
        try:
            for batch in iterator:
                rows += batch.num_rows
                if self.keep and batch.num_rows:
                    if writer is None:
                        name = f"{uuid.uuid4().hex}.parquet"
                        fs.create_dir(posixpath.join(root, DATA), recursive=True)
                        writer = pq.ParquetWriter(posixpath.join(root, DATA, name), batch.schema, filesystem=fs)
                    writer.write_table(pa.Table.from_batches([batch]))
        finally:
            if writer is not None:
                writer.close()
        return Written(name, rows)

    def commit(self, messages, batchId) -> None:
        fs, root = _filesystem(self.path)
        done, epoch = [m for m in messages if m is not None], self.first_epoch + batchId
        folder = posixpath.join(root, COMMITS, f"epoch={epoch}")
        final = posixpath.join(folder, "commit.json")
        if fs.get_file_info(final).type != pafs.FileType.NotFound:       # a replay: written before
            self.abort(messages, batchId)
            return
        fs.create_dir(folder, recursive=True)
        body = json.dumps({"epoch": epoch, "files": [{"name": m.name, "rows": m.rows} for m in done]})
        tmp = posixpath.join(folder, f".{uuid.uuid4().hex}.tmp")
        with fs.open_output_stream(tmp) as out:
            out.write(body.encode())
        fs.move(tmp, final)

    def abort(self, messages, batchId) -> None:
        fs, root = _filesystem(self.path)
        for m in messages:
            if m is not None and m.name:
                name = posixpath.join(root, DATA, m.name)
                if fs.get_file_info(name).type != pafs.FileType.NotFound:
                    fs.delete_file(name)


class EpochSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema, overwrite):
        if "path" not in self.options:
            raise ValueError(f"{FORMAT} needs the option path")
        # options are kept in lower case
        return EpochWriter(self.options["path"].rstrip("/"), self.options.get("keep", "true").lower() != "false",
                           int(self.options.get("firstepoch", "0")))


def epoch_writer(stream: DataFrame, path: str, checkpoint: str, keep: bool = True,
                 first_epoch: int = 0) -> DataStreamWriter:
    """The stream into the sink; every epoch of the query is committed whole or not at all.

    A query with a new checkpoint counts its batches from 0: give it the number its first epoch
    shall have in a table that has epochs already (and the same one at every restart).
    """
    spark = stream.sparkSession
    ship_package(spark)
    spark.dataSource.register(EpochSource)
    return (stream.writeStream.format(FORMAT).option("path", path).option("keep", str(keep).lower())
            .option("firstEpoch", first_epoch).option("checkpointLocation", checkpoint))


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """epoch, tasks, files, rows of every committed epoch, from its commit messages."""
    return _commits(spark, path).select(
        "epoch", F.size("files").cast("long").alias("tasks"),
        F.size(F.filter("files", lambda f: f["name"] != "")).cast("long").alias("files"),
        F.aggregate("files", F.lit(0).cast("long"), lambda s, f: s + f["rows"]).alias("rows"))


def _commits(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, f"{path}/{COMMITS}"):
        return spark.createDataFrame([], COMMIT_SCHEMA)
    return spark.read.schema(COMMIT_SCHEMA).option("recursiveFileLookup", "true") \
        .option("pathGlobFilter", "commit.json").json(f"{path}/{COMMITS}")


def read_epochs(spark: SparkSession, path: str, schema) -> DataFrame:
    """Rows of the committed epochs (``schema`` as written) and ``epoch``."""
    named = _commits(spark, path).select("epoch", F.explode("files").alias("f")) \
        .where("f.name != ''").select("epoch", F.col("f.name").alias("_file"))
    if not path_exists(spark, f"{path}/{DATA}"):
        return spark.createDataFrame([], schema).withColumn("epoch", F.lit(None).cast("long"))
    rows = spark.read.schema(schema).parquet(f"{path}/{DATA}").withColumn("_file", F.col("_metadata.file_name"))
    return rows.join(named, "_file").drop("_file")


def vacuum(spark: SparkSession, path: str, older_than_s: float, now_ms: float) -> int:
    """Delete files that no commit names and that were old at ``now_ms``; returns their number."""
    found = [n for n in list_names(spark, f"{path}/{DATA}") if n.endswith(".parquet")]
    old = [n for n in found if modification_ms(spark, f"{path}/{DATA}/{n}") < now_ms - older_than_s * 1000]
    if not old:
        return 0
    named = _commits(spark, path).select(F.explode("files.name").alias("n"))
    gone = spark.createDataFrame([(n,) for n in old], "n string").join(named, "n", "left_anti").collect()
    for r in gone:
        delete(spark, f"{path}/{DATA}/{r['n']}")
    return len(gone)
