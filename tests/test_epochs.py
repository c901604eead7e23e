import glob
import os

import pytest
from pyspark.sql import functions as F

from txstream.sources import epochs, groups
from txstream.streaming import epoch_sink as es
from txstream.streaming.runner import run_available_now

SCHEMA = "id long, v string"


def fill(spark, root, first, n, k=2):
    for i in range(n):
        a = first + i * 10
        spark.range(a, a + 10).selectExpr("id", "concat('v', id) v").repartition(k).write.parquet(f"{root}/in/f{a}")
    s = (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", k).option("recursiveFileLookup", "true")
         .parquet(f"{root}/in"))
    run_available_now(es.epoch_writer(s, f"{root}/t", f"{root}/ck"))


def reader(spark, root, group, start):
    def keep(rows, batch_id):
        rows.write.mode("overwrite").parquet(f"{root}/{group}-out/batch={batch_id}")
    run_available_now(epochs.consume(spark, f"{root}/t", SCHEMA, f"{root}/{group}", keep, start, 2))
    if not glob.glob(f"{root}/{group}-out/*"):
        return []
    return sorted(r.id for r in spark.read.schema(SCHEMA).parquet(f"{root}/{group}-out").collect())


def test_a_latest_group_never_opens_the_past(spark, scratch):
    root = scratch("epochs")
    fill(spark, root, 0, 3)
    past = glob.glob(f"{root}/t/data/*.parquet")
    assert epochs.last_epoch(spark, f"{root}/t") == 2
    assert epochs.create_group(spark, f"{root}/t", f"{root}/late", "latest") == 2
    for f in past:                                      # any read of them would fail
        with open(f, "wb") as out:
            out.write(b"no parquet")
    for f in glob.glob(f"{root}/t/_commits/epoch=[01]/commit.json"):
        with open(f, "w") as out:
            out.write("{broken")
    assert reader(spark, root, "late", "latest") == []
    fill(spark, root, 100, 2)
    assert reader(spark, root, "late", "latest") == list(range(100, 120))
    assert reader(spark, root, "late", "earliest") == list(range(100, 120))      # its start stays
    fill(spark, root, 200, 1)
    assert reader(spark, root, "late", "latest") == [*range(100, 120), *range(200, 210)]


def test_an_earliest_group_reads_everything_and_late_commits(spark, scratch):
    import pyarrow as pa
    root = scratch("all")
    assert reader(spark, root, "early", "earliest") == []
    w = es.EpochWriter(f"{root}/t", keep=True)
    batch = pa.RecordBatch.from_pydict({"id": pa.array([1, 2], pa.int64()), "v": pa.array(["a", "b"])})
    began = w.write(iter([batch]))                      # written long before it is committed
    w.commit([w.write(iter([batch])), w.write(iter([]))], 0)
    assert epochs.create_group(spark, f"{root}/t", f"{root}/late", "latest") == 0
    w.commit([began], 1)
    assert reader(spark, root, "late", "latest") == [1, 2]
    assert reader(spark, root, "early", "earliest") == [1, 1, 2, 2]
    with pytest.raises(ValueError):
        epochs.create_group(spark, f"{root}/t", f"{root}/x", "newest")


def test_group_lag_at_three_points_of_a_run(spark, scratch):
    root, schema = scratch("lag"), "id long, partition long"
    topic = f"{root}/topic"

    def append(lo, hi):
        spark.range(lo, hi).withColumn("partition", F.col("id") % 3).repartition(2) \
            .write.mode("append").partitionBy("partition").parquet(topic)

    def lag(group):
        return {r.partition: (r.records, r.finished, r.lag)
                for r in groups.group_lag(spark, topic, group, schema).collect()}

    def counts(lo, hi):
        return {p: sum(i % 3 == p for i in range(lo, hi)) for p in range(3)}

    append(0, 100)
    first, late = f"{root}/first", f"{root}/late"
    groups.create_group(spark, topic, first)
    groups.create_group(spark, topic, late, "latest")
    n = counts(0, 100)
    assert lag(first) == {p: (n[p], 0, n[p]) for p in n} and lag(late) == {p: (n[p], n[p], 0) for p in n}
    s = spark.readStream.schema(schema).parquet(topic)
    run_available_now(s.writeStream.format("noop").option("checkpointLocation", first))
    assert lag(first) == {p: (n[p], n[p], 0) for p in n}
    append(100, 150)
    m, new = counts(0, 150), counts(100, 150)
    assert lag(first) == {p: (m[p], n[p], new[p]) for p in n} == lag(late)
    one = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(topic)
    run_available_now(one.writeStream.format("noop").option("checkpointLocation", first))
    assert lag(first) == {p: (m[p], m[p], 0) for p in n}
    # a batch that was planned but not finished does not count
    last = max(int(x) for x in os.listdir(f"{first}/commits") if x.isdigit())
    os.remove(f"{first}/commits/{last}")
    assert sum(x[2] for x in lag(first).values()) > 0
