"""Running lag histogram over a stream: the newest ``n`` samples per group.

Each micro-batch is merged with the previous state -- the newest ``n`` rows per
group, a table of at most ``n x groups`` rows -- by the two-round top-``n`` of
``metrics.last_n`` (map-side partial limits, so a hot group never lands whole
in one task).  The merged state and the histogram of it are written under the
batch id, which makes a replayed batch rewrite the same rows; states and histograms
older than the previous batch are removed, so storage stays bounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from txstream.operators.metrics import HISTOGRAM_QUANTILES, RING_BUFFER_SIZE, lag_histogram, \
    last_n
from txstream.sources.fs import delete, list_dirs, path_exists


def _state(out: str, batch_id: int) -> str:
    return f"{out}/_state/batch={batch_id}"


def update_histogram(batch: DataFrame, batch_id: int, out: str, by: str = "partition",
                     order: str = "event_id", lag: str = "lag", n: int = RING_BUFFER_SIZE,
                     quantiles=HISTOGRAM_QUANTILES) -> None:
    spark = batch.sparkSession
    rows = batch.select(by, order, lag)
    if batch_id > 0:
        if not path_exists(spark, f"{_state(out, batch_id - 1)}/_SUCCESS"):
            raise FileNotFoundError(f"the state before batch {batch_id} is missing under {out}")
        rows = rows.unionByName(spark.read.parquet(_state(out, batch_id - 1)))
    last_n(rows, by, order, n).write.mode("overwrite").parquet(_state(out, batch_id))
    state = spark.read.parquet(_state(out, batch_id))
    lag_histogram(state, by, order, lag, n, quantiles).write.mode("overwrite") \
        .parquet(f"{out}/histogram/batch={batch_id}")
    for kind in ("_state", "histogram"):
        for name in list_dirs(spark, f"{out}/{kind}"):
            if name.startswith("batch=") and int(name[6:]) < batch_id - 1:
                delete(spark, f"{out}/{kind}/{name}")


def histogram_writer(stream: DataFrame, out: str, checkpoint: str, by: str = "partition",
                     order: str = "event_id", lag: str = "lag",
                     n: int = RING_BUFFER_SIZE) -> DataStreamWriter:
    def each(batch: DataFrame, batch_id: int) -> None:
        update_histogram(batch, batch_id, out, by, order, lag, n)
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each)


def latest_histogram(spark, out: str) -> DataFrame:
    """The histogram after the newest batch that has one."""
    batches = sorted(int(d[6:]) for d in list_dirs(spark, f"{out}/histogram")
                     if d.startswith("batch=")
                     and path_exists(spark, f"{out}/histogram/{d}/_SUCCESS"))
    if not batches:
        raise FileNotFoundError(f"no histogram under {out}")
    return spark.read.parquet(f"{out}/histogram/batch={batches[-1]}")
