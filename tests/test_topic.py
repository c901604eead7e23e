from pyspark.sql import functions as F, types as T

from txstream import schemas
from txstream.plans import fixtures as fx
from txstream.sources import topic as topics
from txstream.streaming.runner import run_available_now

from tests.conftest import SF_SMALL

REC = schemas.with_fields(schemas.TRANSACTION, T.StructField("event_id", T.LongType()))


def _drain(spark, stream, root, name):
    run_available_now(stream.writeStream.format("parquet").option("path", f"{root}/{name}")
                      .option("checkpointLocation", f"{root}/ck_{name}"))
    return spark.read.parquet(f"{root}/{name}")


def test_same_key_same_partition(spark):
    tx = fx.with_partition(fx.transactions(spark, SF_SMALL))
    assert tx.groupBy("accountId").agg(F.countDistinct("partition").alias("n")) \
             .filter("n > 1").count() == 0
    assert tx.agg(F.min("partition"), F.max("partition")).first() == (0, 3)


def test_latest_group_skips_existing_and_restart_reads_nothing_twice(spark, scratch):
    root = scratch("topic")
    topic, group = f"{root}/topic", f"{root}/group"
    tx = fx.transactions(spark, SF_SMALL)
    topics.append(tx, topic, "accountId")
    topics.create_group(spark, topic, group, start="latest")
    topics.append(fx.customer_transactions(spark, SF_SMALL), topic, "accountId")
    out = _drain(spark, topics.scan(spark, topic, REC, group=group, start="latest"), root, "o")
    n_new = fx.customer_transactions(spark, SF_SMALL).count()
    assert out.count() == n_new
    # restart with the same group: no new files, nothing re-read
    out = _drain(spark, topics.scan(spark, topic, REC, group=group, start="latest"), root, "o")
    assert out.count() == n_new
    # a third append is read exactly once
    topics.append(tx.limit(7), topic, "accountId")
    out = _drain(spark, topics.scan(spark, topic, REC, group=group, start="latest"), root, "o")
    assert out.count() == n_new + 7


def test_earliest_group_reads_all(spark, scratch):
    root = scratch("topic")
    tx = fx.transactions(spark, SF_SMALL)
    topics.append(tx, f"{root}/topic", "accountId")
    out = _drain(spark, topics.scan(spark, f"{root}/topic", REC, group=f"{root}/g"), root, "o")
    assert out.count() == tx.count()
    assert out.select("event_id").exceptAll(tx.select("event_id")).count() == 0


def test_partition_pruning(spark, scratch):
    root = scratch("topic")
    topics.append(fx.transactions(spark, SF_SMALL), f"{root}/topic", "accountId")
    df = topics.scan(spark, f"{root}/topic", REC, stream=False, partitions=[1])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition" in plan and "IN (1)" in plan.replace(
        "= 1", "IN (1)")
    assert df.filter("partition != 1").count() == 0


def test_stream_written_topic_rejects_batch_append(spark, scratch):
    root = scratch("topic")
    tx = fx.transactions_from_events(fx.events_stream(spark, SF_SMALL))
    run_available_now(topics.topic_writer(tx, f"{root}/topic", "accountId", f"{root}/ck"))
    try:
        topics.append(fx.transactions(spark, SF_SMALL), f"{root}/topic", "accountId")
        raise AssertionError("expected a refusal")
    except ValueError:
        pass
    back = topics.scan(spark, f"{root}/topic", REC, stream=False)
    assert back.count() == fx.transactions(spark, SF_SMALL).count()


def test_file_log_latest_start(spark, scratch):
    from txstream.functions.codec import to_log_record
    from txstream.sources.log import read_log, scan_values
    root = scratch("log")
    tx = fx.transactions(spark, SF_SMALL)
    to_log_record(tx, keep=["event_id"]).write.parquet(f"{root}/log")
    extra = [T.StructField("event_id", T.LongType())]
    s = read_log(spark, f"{root}/log", starting="latest", group=f"{root}/g", extra_fields=extra)
    to_log_record(tx.limit(5), keep=["event_id"]).write.mode("append").parquet(f"{root}/log")
    decoded, _ = scan_values(s, keep=["event_id"])
    out = _drain(spark, decoded, root, "o")
    assert out.count() == 5
    s2 = read_log(spark, f"{root}/log", group=f"{root}/g2", extra_fields=extra)
    assert _drain(spark, s2, root, "o2").count() == tx.count() + 5


def test_latest_group_reads_late_commits_whatever_their_age(spark, scratch):
    """A file committed after the group exists is read, however old its time stamp."""
    import os
    root = scratch("topic")
    topic, group = f"{root}/topic", f"{root}/group"
    tx = fx.transactions(spark, SF_SMALL)
    topics.append(tx, topic, "accountId")
    topics.create_group(spark, topic, group, start="latest")
    before = {os.path.join(d, f) for d, _, fs in os.walk(topic) for f in fs}
    topics.append(tx.limit(1), topic, "accountId")
    for d, _, files in os.walk(topic):
        for f in files:
            if os.path.join(d, f) not in before and f.endswith(".parquet"):
                os.utime(os.path.join(d, f), (0, 0))
    s = topics.scan(spark, topic, REC, group=group, start="latest")
    assert _drain(spark, s, root, "o").count() == 1


def test_null_keys_stay_in_the_topic(spark, scratch):
    root = scratch("topic")
    df = spark.createDataFrame([(1, 5), (None, 6), (0, 7)], "accountId long, event_id long")
    topics.append(df, f"{root}/topic", "accountId")
    rec = T.StructType([T.StructField("accountId", T.LongType()), T.StructField("event_id", T.LongType())])
    back = topics.scan(spark, f"{root}/topic", rec, stream=False).collect()
    assert len(back) == 3 and all(r.partition >= 0 for r in back)
    assert len({r.partition for r in back if not r.accountId}) == 1


class _Recorder:
    """Stands in for a stream reader or writer and keeps what it is told."""

    def __init__(self):
        self.said = {}

    def format(self, name):
        self.said["format"] = name
        return self

    def option(self, key, value):
        self.said[key] = value
        return self

    def load(self):
        return self


def test_both_ends_of_the_chain_take_the_broker(spark, scratch, monkeypatch):
    """The connector jar is not here, so only the options passed are looked at."""
    import types
    from txstream.plans.chain import ChainPaths
    from txstream.sources.log import log_writer, read_log
    paths = ChainPaths.under(scratch("k"))
    paths.log_name = "tx-log"
    options = {"kafka.bootstrap.servers": "host:9092"}
    end = _Recorder()
    log_writer(types.SimpleNamespace(writeStream=end), paths.log_address("kafka"), "ck", "kafka", options)
    assert end.said == {"checkpointLocation": "ck", "format": "kafka", "topic": "tx-log", **options}
    start = _Recorder()
    read_log(types.SimpleNamespace(readStream=start), paths.log_address("kafka"), "kafka",
             kafka_options=options, max_offsets_per_trigger=5000)
    assert start.said == {"format": "kafka", "subscribe": "tx-log", "startingOffsets": "earliest",
                          "maxOffsetsPerTrigger": 5000, **options}
    assert paths.log_address("parquet") == paths.log


def test_topic_scans_prune_the_quarantine_partition(spark, scratch):
    from txstream.plans.chain import ChainPaths, read_quarantine, topic_stage
    root = scratch("q")
    paths = ChainPaths.under(root)
    spark.createDataFrame([(1, b"1", b'{"accountId":1,"timestamp":2,"amount":3}'),
                           (2, b"x", b"{bad")], "event_id long, key binary, value binary") \
        .write.parquet(paths.log)
    run_available_now(topic_stage(spark, paths))
    df = topics.scan(spark, paths.topic, REC, stream=False)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition" in plan and ">= 0" in plan
    assert [r.event_id for r in df.collect()] == [1]
    assert [(r.event_id, r.value) for r in read_quarantine(spark, paths).collect()] == [(2, "{bad")]
