import random

import pytest
from pyspark.sql import Window, functions as F

from txstream.operators.ordering import keyed_positions
from txstream.sources.fs import list_dirs
from txstream.streaming import positions
from txstream.streaming.runner import run_available_now


def test_twenty_batches_number_as_one_and_replays_change_nothing(spark, scratch):
    root, rng = scratch("pos"), random.Random(1)
    rows, event = [], 0
    for b in range(20):
        for _ in range(rng.randint(0, 30)):
            key = rng.choice([None, 0, 0, 0, 1, 2, 2**53 + 1, 2**53])
            rows.append((b, event, key, b * 100 + rng.randint(0, 50)))
            event += 1
    frame = spark.createDataFrame(rows, "b long, event_id long, k long, ts long").cache()
    for b in range(20):
        part = frame.where(F.col("b") == b).drop("b")
        for _ in range(2 if b in (0, 7, 8, 19) else 1):
            positions.number_batch(part, b, ["k"], ["ts", "event_id"], f"{root}/out", f"{root}/state",
                                   fold_every=4, num_partitions=3)
    got = spark.read.parquet(f"{root}/out").drop("batch")
    w = Window.partitionBy("k").orderBy("ts", "event_id")
    want = frame.drop("b").withColumn("seq", F.row_number().over(w).cast("long"))
    assert got.count() == len(rows)
    assert got.select(*want.columns).exceptAll(want).count() == 0
    assert len(list_dirs(spark, f"{root}/state")) <= 10 and len(list_dirs(spark, f"{root}/state/_base")) <= 2


def test_stream_over_files_with_two_keys(spark, scratch):
    root = scratch("stream")
    for i in range(5):
        spark.range(i * 40, i * 40 + 40).selectExpr("id", "id % 2 a", "cast(id % 3 as string) b") \
            .coalesce(1).write.parquet(f"{root}/in/f{i}")
    s = (spark.readStream.schema("id long, a long, b string").option("maxFilesPerTrigger", 1)
         .option("recursiveFileLookup", "true").parquet(f"{root}/in"))
    run_available_now(positions.positions_writer(s, ["a", "b"], ["id"], f"{root}/out", f"{root}/state",
                                                 f"{root}/ck", fold_every=2))
    got = spark.read.parquet(f"{root}/out")
    assert got.count() == 200 and got.select("batch").distinct().count() == 5
    per = got.groupBy("a", "b").agg(F.max("seq").alias("m"), F.countDistinct("seq").alias("d"),
                                    F.count(F.lit(1)).alias("n")).collect()
    assert all(r.m == r.d == r.n for r in per) and len(per) == 6


@pytest.mark.parametrize("kind", ["double", "float"])
def test_nan_keys_are_one_key_as_in_a_window(spark, kind):
    nan = float("nan")
    keys = [nan, 1.0, None, nan, -0.0, 0.0, nan, None, float("inf"), 1.0] * 6
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], f"event_id long, k {kind}")
    got = keyed_positions(df.repartition(3), ["k"], ["event_id"], "seq", num_partitions=7)
    want = df.withColumn("seq", F.row_number().over(Window.partitionBy("k").orderBy("event_id")))
    assert {r.event_id: r.seq for r in got.collect()} == {r.event_id: r.seq for r in want.collect()}
