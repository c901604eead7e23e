import pytest
from pyspark.sql import functions as F

from txstream.functions.codec import row_to_line
from txstream.operators.metrics import observe_counter
from txstream.plans import fixtures as fx
from txstream.plans.chain import ChainPaths, process_stage, run_chain
from txstream.sources.generators import generate_stream
from txstream.streaming.runner import run_available_now
from txstream.streaming.sinks import noop_writer, text_writer

from tests.conftest import SF_SMALL


def test_deterministic_generator_stream(spark, scratch):
    root = scratch("gen")
    s = generate_stream(spark, "transactions", rows_per_second=50, num_partitions=2,
                        deterministic=True, start_ms=1704067200000)
    run_available_now(s.writeStream.format("parquet").option("path", f"{root}/o")
                      .option("checkpointLocation", f"{root}/ck"))
    out = spark.read.parquet(f"{root}/o")
    assert out.count() == 50
    assert out.filter("amount = 0").count() == 5
    assert out.agg(F.min("timestamp")).first()[0] == 1704067200000


def test_payload_and_sequence_generators(spark):
    from txstream.sources.generators import generate
    p = generate(spark, 3, "payload_events", payload_size=4).collect()
    assert [r.id for r in p] == ["0", "1", "2"] and p[0].payload == "****"
    assert generate(spark, 1, "payload_events", payload_size=0).first().payload == ""
    s = generate(spark, 3, "sequence_events").collect()
    assert [r.payload for r in s] == ["0", "1", "2"]


def test_stream_equals_batch_for_chain(spark):
    tx_stream = fx.transactions_from_events(fx.events_stream(spark, SF_SMALL))
    paths = run_chain(spark, tx_stream)
    tx = fx.transactions(spark, SF_SMALL)
    from txstream.operators.documents import first_per_key
    from txstream.operators.enrich import enrich_fee, to_document
    from txstream.operators.routing import route
    main, dead = route(tx)
    want_docs = first_per_key(to_document(enrich_fee(main), keep=["event_id"]), "_id") \
        .drop("event_id")
    docs = spark.read.parquet(paths.documents).drop("batch")
    assert docs.count() == want_docs.count()
    assert docs.exceptAll(want_docs.select(*docs.columns)).count() == 0
    dl = spark.read.parquet(paths.dead_letters)
    assert sorted(r.event_id for r in dl.collect()) == sorted(r.event_id for r in dead.collect())
    from txstream.plans.chain import read_quarantine
    assert read_quarantine(spark, paths).count() == 0
    # restart on the same checkpoint processes nothing again
    run_available_now(process_stage(spark, paths))
    assert spark.read.parquet(paths.documents).count() == docs.count()


def test_chain_quarantines_bad_log_records(spark, scratch):
    root = scratch("chain")
    paths = ChainPaths.under(root)
    rows = [(1, b"1", b'{"accountId":1,"timestamp":2,"amount":3}'), (2, b"x", b"junk"),
            (3, b"1", b'{"accountId":1,"timestamp":2,"amount":3.5}'),
            (4, b"7", b'{"accountId":7}')]
    spark.createDataFrame(rows, "event_id long, key binary, value binary") \
        .write.parquet(paths.log)
    from txstream.plans.chain import read_quarantine, topic_stage
    run_available_now(topic_stage(spark, paths))
    run_available_now(process_stage(spark, paths))
    q = {r.event_id: r.value for r in read_quarantine(spark, paths).collect()}
    assert sorted(q) == [2, 3] and q[2] == "junk"
    assert [r._id for r in spark.read.parquet(paths.documents).collect()] == [1]
    assert [r.event_id for r in spark.read.parquet(paths.dead_letters).collect()] == [4]


def test_text_sink_and_noop_and_observed_metrics(spark, scratch):
    root = scratch("sinks")
    e = fx.events_stream(spark, SF_SMALL)
    seq = e.select(F.col("event_id").alias("id"), F.lit(1704067200000).alias("timestamp"),
                   F.col("event_id").cast("string").alias("payload"))
    run_available_now(text_writer(seq, row_to_line("sequence_event"), f"{root}/lines",
                                  f"{root}/ck1", max_records_per_file=100))
    lines = spark.read.schema("value string, bucket string").text(f"{root}/lines")
    n = fx.table(spark, SF_SMALL, "events").count()
    assert lines.count() == n
    assert [r.bucket for r in lines.select("bucket").distinct().collect()] == ["2024-01-01--00"]
    q = run_available_now(noop_writer(observe_counter(seq, "seen"), f"{root}/ck2"))
    observed = [p.observedMetrics["seen"]["events"] for p in q.recentProgress
                if "seen" in p.observedMetrics]
    assert sum(observed) == n


def test_streaming_rate_equals_batch_on_closed_windows(spark, scratch):
    from txstream.operators import metrics
    root = scratch("rate")
    tx = fx.with_partition(fx.transactions_from_events(fx.events_stream(spark, SF_SMALL)))
    r = metrics.rate_sliding_stream(tx, "partition", window="1 hour", slide="15 minutes",
                                    window_seconds=3600, watermark="0 seconds")
    run_available_now(r.writeStream.format("parquet").option("path", f"{root}/o")
                      .option("checkpointLocation", f"{root}/ck"))
    got = spark.read.parquet(f"{root}/o")
    batch_tx = fx.with_partition(fx.transactions(spark, SF_SMALL))
    last = batch_tx.agg(F.max("timestamp")).first()[0]
    want = metrics.rate_sliding(batch_tx, "partition", window="1 hour", slide="15 minutes",
                                window_seconds=3600).filter(F.col("window_end_ms") <= last)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_load_feedback_lags_and_counter(spark, scratch):
    from txstream.operators import metrics
    from txstream.plans.load import COUNTER, load_writers, read_samples
    from txstream.sources.generators import generate_stream
    root = scratch("load")
    ev = generate_stream(spark, "payload_events", rows_per_second=200, num_partitions=2,
                         deterministic=True, start_ms=0, payload_size=10)
    writer, reader = load_writers(spark, ev, root, num_partitions=2)
    run_available_now(writer)
    q = run_available_now(reader())
    samples = read_samples(spark, root)
    assert samples.count() == 200
    assert samples.filter("lag < 0").count() == 0        # processed after generated
    seen = sum(p.observedMetrics[COUNTER]["events"] for p in q.recentProgress
               if COUNTER in p.observedMetrics)
    assert seen == 200
    h = metrics.lag_histogram(samples, "partition", "timestamp", "lag", n=1000)
    assert sorted(r["count"] for r in h.collect()) == sorted(
        r["count"] for r in samples.groupBy("partition").count().collect())


def test_console_sink_prints(tmp_path):
    """The sink prints from the JVM, so a process of its own is run and its output read."""
    import subprocess
    import sys
    from pathlib import Path
    code = ("from txstream.session import get_session\n"
            "from txstream.plans import fixtures as fx\n"
            "from txstream.functions.codec import row_to_line\n"
            "from txstream.streaming.sinks import console_writer\n"
            "from txstream.streaming.runner import run_available_now\n"
            "s = get_session('local[2]')\n"
            f"t = fx.transactions_from_events(fx.events_stream(s, {SF_SMALL!r}))\n"
            "run_available_now(console_writer(t, row_to_line('transaction'), num_rows=3)"
            f".option('checkpointLocation', {str(tmp_path / 'ck')!r}))\n")
    out = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[1],
                         capture_output=True, text=True, timeout=300)
    assert out.stdout.count("Transaction{accountId=") == 3, out.stderr[-2000:]


def test_continuous_chain_reaches_the_same_result(spark, scratch):
    import time
    from txstream.plans.chain import start_chain
    root = scratch("cont")
    tx = fx.transactions_from_events(fx.events_stream(spark, SF_SMALL))
    n = fx.table(spark, SF_SMALL, "events").count()
    queries = start_chain(spark, tx, root, trigger_interval="200 milliseconds")
    try:
        paths = ChainPaths.under(root)
        deadline = time.time() + 120
        done = 0
        while time.time() < deadline:
            for q in queries.values():
                assert q.exception() is None
            try:
                done = (spark.read.parquet(paths.documents).count() > 0 and
                        spark.read.parquet(paths.dead_letters).count() +
                        spark.read.parquet(paths.topic).filter("amount > 0").count())
            except Exception:  # noqa: BLE001 - tables appear as the stages commit
                done = 0
            if done == n:
                break
            time.sleep(1)
    finally:
        for q in queries.values():
            q.stop()
    assert done == n
    want = fx.transactions(spark, SF_SMALL).filter("amount > 0") \
        .select("accountId").distinct().count()
    assert spark.read.parquet(paths.documents).count() == want


def test_process_stage_with_small_batches_and_compaction(spark):
    from txstream.operators.documents import latest_base, read_documents
    tx_stream = fx.transactions_from_events(fx.events_stream(spark, SF_SMALL))
    paths = run_chain(spark, tx_stream)
    again = paths.with_outputs("2")
    q = run_available_now(process_stage(spark, again, max_files_per_trigger=1, compact_every=2))
    batches = [p for p in q.recentProgress if p.numInputRows > 0]
    assert len(batches) >= 3
    from txstream.operators import keyed_store
    assert any(r.level > 0 for r in keyed_store.load(spark, again.documents).runs)
    a = read_documents(spark, paths.documents, ["_id", "amount", "timestamp", "transactionFee"])
    b = read_documents(spark, again.documents, ["_id", "amount", "timestamp", "transactionFee"])
    # small batches: the earliest *batch* wins; the key set and count do not change
    assert a.count() == b.count()
    assert a.select("_id").exceptAll(b.select("_id")).count() == 0
    from txstream.operators.documents import read_documents as read_store
    assert latest_base(spark, again.dead_letters) is not None
    assert read_store(spark, again.dead_letters).count() == \
        spark.read.parquet(paths.dead_letters).count()


def test_late_rows_are_dropped_and_counted(spark, scratch):
    from txstream.operators import metrics
    from txstream.streaming.runner import rows_dropped_by_watermark
    root = scratch("late")
    base = 1704067200000
    schema = "partition long, timestamp long"
    files = [[(0, base + i * 1000) for i in range(120)],          # on time
             [(0, base + i * 1000) for i in range(120, 130)],     # on time, moves watermark
             [(0, base + 5_000), (0, base + 15_000)]]             # late, two windows
    for i, rows in enumerate(files):   # one file per trigger, in order
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/in/f{i}")
    s = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
         .option("recursiveFileLookup", "true").parquet(f"{root}/in"))
    r = metrics.rate_sliding_stream(s, "partition", window="10 seconds", slide="10 seconds",
                                    window_seconds=10, watermark="5 seconds")
    q = run_available_now(r.writeStream.format("parquet").option("path", f"{root}/o")
                          .option("checkpointLocation", f"{root}/ck"))
    out = spark.read.parquet(f"{root}/o")
    # late rows reach the state store as one partial aggregate per window
    assert rows_dropped_by_watermark(q) == 2
    counts = {r.window_start_ms - base: r.events for r in out.collect()}
    assert counts[0] == 10 and counts[10_000] == 10     # the late rows were not added


def test_running_histogram_over_several_batches(spark, scratch):
    from txstream.operators import metrics
    from txstream.streaming.metrics_sink import histogram_writer, latest_histogram
    from txstream.sources.fs import list_dirs
    root = scratch("hist")
    data = spark.range(3000).select(F.col("id").alias("event_id"),
                                    (F.col("id") % 2).alias("partition"),
                                    ((F.col("id") * 37) % 1000).alias("lag"))
    for i in range(4):   # four files -> four micro-batches
        data.filter((F.col("event_id") >= i * 750) & (F.col("event_id") < (i + 1) * 750)) \
            .coalesce(1).write.parquet(f"{root}/in/f{i}")
    s = (spark.readStream.schema(data.schema).option("maxFilesPerTrigger", 1)
         .option("recursiveFileLookup", "true").parquet(f"{root}/in"))
    q = run_available_now(histogram_writer(s, f"{root}/out", f"{root}/ck", n=500))
    assert len([p for p in q.recentProgress if p.numInputRows > 0]) == 4
    got = {r.partition: r for r in latest_histogram(spark, f"{root}/out").collect()}
    want = {r.partition: r for r in metrics.lag_histogram(data, n=500).collect()}
    for p in (0, 1):
        assert got[p]["count"] == 500 and abs(got[p].p99 - want[p].p99) < 1e-9
        assert abs(got[p].mean - want[p].mean) < 1e-9
    assert len(list_dirs(spark, f"{root}/out/_state")) <= 2


def test_chain_on_empty_input(spark, scratch):
    root = scratch("empty")
    schema = fx.table(spark, SF_SMALL, "events").schema
    spark.createDataFrame([], schema).write.parquet(f"{root}/events.parquet")
    tx = fx.transactions_from_events(fx.events_stream(spark, root))
    paths = run_chain(spark, tx)
    from txstream.sources.fs import has_data_files
    for p in (paths.documents, paths.dead_letters):
        assert not has_data_files(spark, p) or spark.read.parquet(p).count() == 0


def test_chain_from_generator_stream_invariants(spark):
    n = 1234
    gen = generate_stream(spark, "transactions", rows_per_second=n, num_partitions=3,
                          deterministic=True, start_ms=1704067200000)
    paths = run_chain(spark, gen)
    dead = spark.read.parquet(paths.dead_letters)
    docs = spark.read.parquet(paths.documents)
    assert dead.count() == -(-n // 10)
    assert docs.count() == n - -(-n // 10)
    assert docs.agg(F.min("transactionFee"), F.max("transactionFee")).first() == (5, 5)
    # one partition per key in the dead-letter topic
    assert dead.groupBy("accountId").agg(F.countDistinct("partition").alias("p")) \
               .filter("p > 1").count() == 0


def test_rate_source_defaults_per_kind(spark, scratch):
    import time
    from txstream.sources.generators import DEFAULT_RATES
    root = scratch("rate")
    s = generate_stream(spark, "sequence_events")
    q = (s.writeStream.format("parquet").option("path", f"{root}/o")
         .option("checkpointLocation", f"{root}/ck").trigger(processingTime="1 second").start())
    try:
        time.sleep(6)
    finally:
        q.stop()
    out = spark.read.parquet(f"{root}/o")
    assert DEFAULT_RATES["sequence_events"] == 1
    assert 1 <= out.count() <= 10
    assert out.filter("payload != cast(id as string)").count() == 0


def test_keyed_batch_writer_orders_each_batch(spark, scratch):
    from txstream.streaming.sinks import keyed_batch_writer
    root = scratch("keyed")
    seen = []

    def check(batch, batch_id):
        def per_part(it):
            import pandas as pd
            for pdf in it:
                yield pd.DataFrame({"ok": [bool((pdf[["accountId", "timestamp", "event_id"]]
                                                 .apply(tuple, axis=1).is_monotonic_increasing))],
                                    "n": [len(pdf)]})
        res = batch.mapInPandas(per_part, "ok boolean, n long").collect()
        seen.append((batch_id, all(r.ok for r in res), sum(r.n for r in res)))

    s = fx.transactions_from_events(fx.events_stream(spark, SF_SMALL))
    run_available_now(keyed_batch_writer(s, ["accountId"], ["timestamp", "event_id"], check,
                                         f"{root}/ck", num_partitions=4))
    n = fx.table(spark, SF_SMALL, "events").count()
    assert seen and all(ok for _, ok, _ in seen) and sum(k for _, _, k in seen) == n


def test_text_sink_spreads_a_hot_bucket(spark, scratch):
    import glob
    root = scratch("hot")
    base = 1704067200000
    rows = [(i, base + (0 if i % 3 == 0 else 3_600_000 * (i % 50 + 1)), str(i))
            for i in range(3000)]                     # a third of all rows in one hour
    spark.createDataFrame(rows, "id long, timestamp long, payload string") \
        .coalesce(1).write.parquet(f"{root}/in")
    s = spark.readStream.schema("id long, timestamp long, payload string").parquet(f"{root}/in")
    run_available_now(text_writer(s, row_to_line("sequence_event"), f"{root}/lines",
                                  f"{root}/ck", num_partitions=8))
    hot = glob.glob(f"{root}/lines/bucket=2024-01-01--00/*.txt")
    assert len(hot) >= 2                               # the hot hour came from several tasks
    lines = spark.read.schema("value string, bucket string").text(f"{root}/lines")
    assert lines.count() == 3000
    assert lines.filter("bucket = '2024-01-01--00'").count() == 1000


def test_run_all_available_now_runs_independent_queries(spark, scratch):
    from txstream.streaming.runner import run_all_available_now
    root = scratch("many")
    s = fx.transactions_from_events(fx.events_stream(spark, SF_SMALL))
    writers = [s.filter(cond).writeStream.format("parquet").option("path", f"{root}/o{i}")
               .option("checkpointLocation", f"{root}/ck{i}")
               for i, cond in enumerate(["amount > 0", "amount <= 0 or amount is null"])]
    qs = run_all_available_now(writers)
    assert all(not q.isActive for q in qs)
    n = fx.table(spark, SF_SMALL, "events").count()
    assert spark.read.parquet(f"{root}/o0").count() + spark.read.parquet(f"{root}/o1").count() == n


@pytest.mark.parametrize("by", ["partition", None])
def test_chained_rates_equal_the_batch_query_with_late_data(spark, scratch, by):
    """Six micro-batches, events up to 50 s late under a watermark of 60 s."""
    import random
    from txstream.operators import metrics
    root, rng, base = scratch("chained"), random.Random(2), 1704067200000
    schema = "partition long, timestamp long"
    rows = [(i % 3, base + i * 900) for i in range(1200)]
    order = sorted(range(1200), key=lambda i: i * 0.9 + rng.uniform(0, 50))
    for f in range(6):
        part = [rows[i] for i in order[f * 200:(f + 1) * 200]]
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{root}/in/f{f}")
    s = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
         .option("recursiveFileLookup", "true").parquet(f"{root}/in"))
    r = metrics.rate_sliding_stream(s, by, watermark="60 seconds")
    q = run_available_now(r.writeStream.format("parquet").option("path", f"{root}/o")
                          .option("checkpointLocation", f"{root}/ck"))
    got = spark.read.parquet(f"{root}/o")
    closed = max(t for _, t in rows) - 60_000
    df = spark.createDataFrame(rows, schema)
    full = metrics.rate_sliding(df, by) if by else metrics.rate_total(df)
    want = full.where(F.col("window_end_ms") <= closed)
    assert got.count() == want.count() > 100
    assert got.exceptAll(want.select(*got.columns)).count() == 0
    # the first operator holds a row per open slide, the second one per open window
    states = [[o.numRowsTotal for o in p.stateOperators] for p in q.recentProgress if p.numInputRows]
    groups = 3 if by else 1
    slides, windows = 60 // 5 + 200 * 9 // 50, (60 + 180 + 60) // 5
    assert all(len(x) == 2 and min(x) <= slides * groups * 2 and max(x) <= windows * groups * 2 for x in states)
