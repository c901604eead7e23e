"""Streaming sinks: insert-once documents with dead letters, bucketed text, console, noop.

``foreachBatch`` delivers each micro-batch at least once; every write below is
keyed by the batch id (a directory it overwrites), which makes a replay write
the same rows again -- effectively once.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from txstream.functions.clock import ms_to_ntz
from txstream.operators import keyed_store
from txstream.operators.documents import compact, vacuum_covered
from txstream.operators.enrich import DEFAULT_FEE, enrich_fee, to_document
from txstream.operators.routing import route
from txstream.sources.topic import DEFAULT_PARTITIONS, PARTITION, assign_partition

DOCUMENT_COLUMNS = ["_id", "amount", "timestamp", "transactionFee"]
DEAD_LETTER_COLUMNS = ["accountId", "timestamp", "amount", "event_id"]


def process_batch(batch: DataFrame, batch_id: int, documents: str, dead_letters: str,
                  fee: int = DEFAULT_FEE, num_partitions: int = DEFAULT_PARTITIONS,
                  compact_every: int | None = None, writer: str = "",
                  background: bool = False) -> None:
    """Route one micro-batch: main rows -> enriched documents (insert once),
    the rest -> the dead-letter topic (keyed by accountId).

    Documents go to a levelled store (``operators.keyed_store``; ``compact_every`` is its
    fan-out, 8 if not given).  With ``compact_every=k`` the dead-letter store folds every batch
    before this one into its base each ``k`` batches (those batches are committed).  Read
    both with ``operators.documents.read_documents``.  ``background=True`` merges and folds on
    other threads beside the next batches; the dead letters' folded folders are then deleted only at
    the next fold.
    """
    main, dead = route(batch)       # two reads of the batch's files, each with its filter pushed down
    docs = to_document(enrich_fee(main, fee), keep=["event_id"])
    cols = [c for c in DEAD_LETTER_COLUMNS if c in dead.columns]
    dead_out = assign_partition(dead.select(*cols), "accountId", num_partitions)

    spark, fan_out = batch.sparkSession, max(2, compact_every or keyed_store.FAN_OUT)

    def write_documents():
        keyed_store.insert(docs, documents, batch_id, key="_id", columns=DOCUMENT_COLUMNS, writer=writer)
        if background:
            keyed_store.merge_later(spark, documents, fan_out)
        else:
            while keyed_store.merge(spark, documents, fan_out) is not None:
                pass

    def write_dead_letters():
        dead_out.write.mode("overwrite").partitionBy(PARTITION) \
            .parquet(f"{dead_letters}/batch={batch_id}")

    def fold_dead_letters():
        vacuum_covered(spark, dead_letters)
        compact(spark, dead_letters, batch_id - 1, vacuum=False)

    with ThreadPoolExecutor(max_workers=2) as pool:     # concurrent jobs
        for f in [pool.submit(write_documents), pool.submit(write_dead_letters)]:
            f.result()
    if compact_every and batch_id > 0 and batch_id % compact_every == 0:
        if background:
            keyed_store.run_later(dead_letters, fold_dead_letters)
        else:
            compact(spark, dead_letters, batch_id - 1)


def process_writer(stream: DataFrame, documents: str, dead_letters: str, checkpoint: str,
                   fee: int = DEFAULT_FEE, num_partitions: int = DEFAULT_PARTITIONS,
                   compact_every: int | None = None, background: bool = False) -> DataStreamWriter:
    def each(batch: DataFrame, batch_id: int) -> None:
        process_batch(batch, batch_id, documents, dead_letters, fee, num_partitions,
                      compact_every, writer=checkpoint, background=background)
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each)


# Fixed value: the time-bucket layout of the rolling text sink (hourly folders).
HOURLY_BUCKET = "yyyy-MM-dd--HH"


def text_writer(stream: DataFrame, line: Column, path: str, checkpoint: str,
                time_ms: str = "timestamp", bucket_format: str = HOURLY_BUCKET,
                max_records_per_file: int = 100_000,
                num_partitions: int | None = None) -> DataStreamWriter:
    """One UTF-8 line per row into ``bucket=<time bucket>/`` folders (UTC buckets).

    Each micro-batch is range-partitioned on ``(bucket, time, hash)`` before the
    write: every task receives a contiguous run of buckets, so a batch writes
    about ``buckets + tasks`` files instead of ``buckets x tasks``, and a hot
    bucket is split over several tasks rather than landing on one.
    ``num_partitions=0`` writes from the input tasks as they are.
    Files roll per micro-batch and at ``max_records_per_file`` lines (Spark has
    no byte-size or idle roll; the trigger interval plays the time roll).
    """
    spark = stream.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions")) if num_partitions is None \
        else num_partitions
    out = stream.select(line.alias("value"),
                        F.date_format(ms_to_ntz(time_ms), bucket_format).alias("bucket"),
                        F.col(time_ms).alias("_t"))
    if n > 0:
        out = out.repartitionByRange(n, "bucket", "_t", F.xxhash64("value"))
    out = out.drop("_t")
    return (out.writeStream.format("text").partitionBy("bucket")
            .option("path", path).option("checkpointLocation", checkpoint)
            .option("maxRecordsPerFile", max_records_per_file))


def console_writer(stream: DataFrame, line: Column | None = None,
                   num_rows: int = 20) -> DataStreamWriter:
    out = stream.select(line.alias("value")) if line is not None else stream
    return out.writeStream.format("console").option("truncate", "false") \
        .option("numRows", num_rows)


def noop_writer(stream: DataFrame, checkpoint: str) -> DataStreamWriter:
    """Accept and discard rows: a read-throughput harness."""
    return stream.writeStream.format("noop").option("checkpointLocation", checkpoint)


def keyed_batch_writer(stream: DataFrame, keys, order, fn, checkpoint: str,
                       num_partitions: int | None = None) -> DataStreamWriter:
    """Hand every micro-batch to ``fn(batch, batch_id)`` with each key's rows
    contiguous and in ``order`` inside its partitions.

    Streaming frames reject sorts, so the ordering is applied per micro-batch
    (``keyed_order``: range partitioning on ``(keys, order)``, so a hot key is
    spread over several contiguous tasks rather than one).
    """
    from txstream.operators.ordering import keyed_order

    def each(batch: DataFrame, batch_id: int) -> None:
        fn(keyed_order(batch, keys, order, num_partitions), batch_id)
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each)
