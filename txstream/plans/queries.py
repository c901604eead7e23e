"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each reads the driver's tables (or what Spark derives from them) in full.
Queries that exercise a streaming path run it to completion with
``availableNow`` into a fresh folder under ``spark.checkpoint.dir`` and return
a batch read of what the stream wrote.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from txstream import schemas
from txstream.functions.clock import lag_ms, now_ms, ntz_to_ms
from txstream.functions.codec import decode_json, encode_json, row_to_line, to_log_record
from txstream.operators import audit, intervals, keyed_store, metrics
from txstream.operators.documents import first_per_key, read_documents
from txstream.operators.enrich import enrich_fee, exact_duplicates, to_document
from txstream.operators.ordering import keyed_positions
from txstream.operators.routing import route, split_counts
from txstream.plans import fixtures as fx
from txstream.plans import recovery
from txstream.plans.chain import (ChainPaths, log_stage, process_stage, read_quarantine,
                                  run_chain, topic_stage)
from txstream.plans.load import load_writers, read_samples
from txstream.session import scratch_path
from txstream.sources import epochs, groups
from txstream.sources import generators as gen
from txstream.sources import log as logsrc
from txstream.sources import topic as topics
from txstream.streaming import rolling
from txstream.streaming.dedup import unique_writer
from txstream.streaming.epoch_sink import epoch_writer, ledger, read_epochs
from txstream.streaming.metrics_sink import histogram_writer, latest_histogram
from txstream.streaming.positions import number_batch
from txstream.streaming.progress import observed_total, run_logged
from txstream.streaming.runner import run_available_now
from txstream.streaming.sinks import keyed_batch_writer, noop_writer, process_batch, text_writer

TX_EID = schemas.with_fields(schemas.TRANSACTION, T.StructField("event_id", T.LongType()))
ROUND = 6  # doubles are compared at 6 decimals

# rate windows used on the test tables (events span a month)
RATE_WINDOW, RATE_SLIDE, RATE_SECONDS = "1 hour", "15 minutes", 3600


def _gen_clock() -> F.Column:
    return F.lit(fx.GENERATED_EPOCH_MS) + F.col("event_id") * fx.GENERATED_STEP_MS


# ---------------------------------------------------------------- sources A1-A3
def gen_transactions(spark, sf):
    return gen.generate_from(fx.table(spark, sf, "events"), "event_id", "transactions",
                             clock=_gen_clock())


def gen_payload_events(spark, sf):
    return gen.generate_from(fx.table(spark, sf, "events"), "event_id", "payload_events",
                             clock=_gen_clock())


def gen_sequence_events(spark, sf):
    return gen.generate_from(fx.table(spark, sf, "events"), "event_id", "sequence_events",
                             clock=_gen_clock())


# ---------------------------------------------------------- routing C1-C3, C11
def route_positive(spark, sf):
    return route(fx.transactions(spark, sf))[0]


def route_dead_letter(spark, sf):
    return route(fx.transactions(spark, sf))[1]


def route_dead_letter_negative(spark, sf):
    return route(fx.customer_transactions(spark, sf))[1]


def enrich_fee_q(spark, sf):
    return enrich_fee(route(fx.transactions(spark, sf))[0])


def document_projection(spark, sf):
    return to_document(enrich_fee(route(fx.transactions(spark, sf))[0]))


def split_counts_q(spark, sf):
    return split_counts(fx.with_partition(fx.transactions(spark, sf)))


def exact_duplicates_q(spark, sf):
    tx = fx.transactions(spark, sf)
    doubled = tx.unionByName(tx.filter(F.col("event_id") % 10 == 0))
    return exact_duplicates(doubled.drop("event_id"))


# --------------------------------------------------------------- codecs C8-C12
def json_encode(spark, sf):
    rec = to_log_record(fx.transactions(spark, sf), keep=["event_id"])
    return rec.select("event_id", F.col("key").cast("string").alias("key"),
                      F.col("value").cast("string").alias("value"))


def json_round_trip(spark, sf):
    rec = to_log_record(fx.transactions(spark, sf), keep=["event_id"])
    decoded, _ = logsrc.scan_values(rec, schemas.TRANSACTION, keep=["event_id"])
    return decoded


def decode_ok(spark, sf):
    return decode_json(fx.raw_records(spark, sf), schemas.TRANSACTION, keep=["event_id"])[0]


def decode_quarantine(spark, sf):
    return decode_json(fx.raw_records(spark, sf), schemas.TRANSACTION, keep=["event_id"])[1]


def row_to_line_q(spark, sf):
    tx = fx.transactions(spark, sf)
    seq = fx.sequence_events(spark, sf)
    return (tx.select("event_id", F.lit("transaction").alias("kind"),
                      row_to_line("transaction").alias("line"))
            .unionByName(enrich_fee(tx).select("event_id", F.lit("enriched").alias("kind"),
                                               row_to_line("enriched").alias("line")))
            .unionByName(seq.select(F.col("id").alias("event_id"),
                                    F.lit("sequence_event").alias("kind"),
                                    row_to_line("sequence_event").alias("line"))))


# ------------------------------------------------------ ordering & partitioning
def keyed_order_q(spark, sf):
    tx = fx.transactions(spark, sf)
    return keyed_positions(tx, ["accountId"], ["timestamp", "event_id"], "seq") \
        .select("event_id", "accountId", "timestamp", "seq")


def keyed_order_streamed(spark, sf):
    """D1 on a stream: the order in which a micro-batch's rows are handed over
    (``keyed_batch_writer``) is written down as it is -- the row's place in its batch --
    and an account's positions follow from these places alone.  All files come in
    one batch; with several, positions would start anew in each."""
    root = scratch_path(spark, "keyed_stream")
    out = f"{root}/out"

    def number(batch, batch_id):
        batch.withColumn("place", F.monotonically_increasing_id()) \
            .write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    tx = fx.transactions_from_events(fx.events_stream(spark, sf))
    run_available_now(keyed_batch_writer(tx, ["accountId"], ["timestamp", "event_id"], number,
                                         f"{root}/_ck"))
    return keyed_positions(spark.read.parquet(out), ["batch", "accountId"], ["place"], "seq") \
        .select("event_id", "accountId", "timestamp", "seq")


def keyed_order_continued(spark, sf):
    """D1 over micro-batches: the month in ten batches, one of them replayed; an account's
    positions go on from batch to batch and equal those of the whole table."""
    root = scratch_path(spark, "keyed_continued")
    for b, part in _cuts(fx.transactions(spark, sf), 10):
        for _ in range(2 if b == 6 else 1):
            number_batch(part, b, ["accountId"], ["timestamp", "event_id"], f"{root}/out",
                         f"{root}/state", fold_every=4)
    return spark.read.parquet(f"{root}/out").select("event_id", "accountId", "timestamp", "seq")


def topic_partition_counts(spark, sf):
    root = scratch_path(spark, "topic_counts")
    topics.append(fx.transactions(spark, sf), f"{root}/topic", "accountId")
    t = topics.scan(spark, f"{root}/topic", TX_EID, stream=False)
    return t.groupBy("partition").agg(F.count(F.lit(1)).alias("records"),
                                      F.countDistinct("accountId").alias("keys"))


def _stream_topic(spark, sf, root) -> str:
    """Write the events stream as transactions into a stream-written topic."""
    tx = fx.transactions_from_events(fx.events_stream(spark, sf))
    run_available_now(topics.topic_writer(tx, f"{root}/topic", "accountId",
                                          f"{root}/_ck/writer"))
    return f"{root}/topic"


def _drain(spark, stream: DataFrame, root: str, name: str) -> DataFrame:
    out = f"{root}/{name}"
    run_available_now(stream.writeStream.format("parquet").option("path", out)
                      .option("checkpointLocation", f"{root}/_ck/{name}"))
    return spark.read.parquet(out)


def topic_round_trip(spark, sf):
    root = scratch_path(spark, "topic_round_trip")
    topic = _stream_topic(spark, sf, root)
    s = topics.scan(spark, topic, TX_EID, group=f"{root}/_ck/group", start="earliest")
    return _drain(spark, s, root, "out")


def topic_scan_all(spark, sf):
    root = scratch_path(spark, "topic_scan_all")
    topics.append(fx.transactions(spark, sf), f"{root}/topic", "accountId")
    s = topics.scan(spark, f"{root}/topic", TX_EID, group=f"{root}/_ck/group")
    return _drain(spark, s, root, "out")


def topic_scan_latest(spark, sf):
    """A group created after the topic's first rows sees only later appends."""
    root = scratch_path(spark, "topic_scan_latest")
    topic, group = f"{root}/topic", f"{root}/_ck/group"
    topics.append(fx.transactions(spark, sf), topic, "accountId")
    topics.create_group(spark, topic, group, start="latest")
    topics.append(fx.customer_transactions(spark, sf), topic, "accountId")
    s = topics.scan(spark, topic, TX_EID, group=group, start="latest")
    return _drain(spark, s, root, "out")


def topic_scan_epochs_latest(spark, sf):
    """A group on an epoch table, created after its first rows: it reads what is committed later,
    from the commit log alone."""
    root = scratch_path(spark, "epochs_latest")
    table, group = f"{root}/table", f"{root}/_ck/group"

    def keep(rows, batch_id):
        rows.write.mode("overwrite").parquet(f"{root}/out/batch={batch_id}")

    run_available_now(epoch_writer(fx.transactions_from_events(fx.events_stream(spark, sf)), table,
                                   f"{root}/_ck/writer"))
    epochs.create_group(spark, table, group, start="latest")
    fx.customer_transactions(spark, sf).write.parquet(f"{root}/more")
    both = spark.readStream.schema(TX_EID).option("recursiveFileLookup", "true").parquet(f"{root}/more")
    # epochs of another query have numbers of their own: they go on behind the table's last one
    run_available_now(epoch_writer(both, table, f"{root}/_ck/writer2", first_epoch=epochs.last_epoch(spark, table) + 1))
    run_available_now(epochs.consume(spark, table, TX_EID, group, keep, start="latest"))
    return spark.read.schema(TX_EID).parquet(f"{root}/out").drop("batch")


def topic_group_lag(spark, sf):
    """records of each partition that a group has finished and that it has yet to read, from
    its checkpoint, after the topic has grown behind its last batch."""
    root = scratch_path(spark, "group_lag")
    topic, group = f"{root}/topic", f"{root}/_ck/group"
    topics.append(fx.transactions(spark, sf), topic, "accountId")
    s = topics.scan(spark, topic, TX_EID, group=group)
    run_available_now(noop_writer(s, group))
    topics.append(fx.customer_transactions(spark, sf), topic, "accountId")
    return groups.group_lag(spark, topic, group, topics.topic_schema(TX_EID))


def log_scan_earliest(spark, sf):
    root = scratch_path(spark, "log_scan")
    paths = ChainPaths.under(root)
    run_available_now(log_stage(fx.transactions_from_events(fx.events_stream(spark, sf)), paths))
    log = logsrc.read_log(spark, paths.log, extra_fields=[T.StructField("event_id", T.LongType())])
    decoded, _ = logsrc.scan_values(log, schemas.TRANSACTION, keep=["event_id"])
    return _drain(spark, decoded, root, "out")


# ------------------------------------------------------------ documents B3, F*
def document_insert_once(spark, sf):
    """Two micro-batches (first and second half of the month), the second replayed."""
    root = scratch_path(spark, "documents")
    store = f"{root}/documents"
    docs = to_document(enrich_fee(route(fx.transactions(spark, sf))[0]), keep=["event_id"])
    cut = fx.GENERATED_EPOCH_MS + 15 * 86_400_000
    cols = ["_id", "amount", "timestamp", "transactionFee"]
    keyed_store.insert(docs.filter(F.col("timestamp") < cut), store, 0, columns=cols)
    keyed_store.insert(docs.filter(F.col("timestamp") >= cut), store, 1, columns=cols)
    keyed_store.insert(docs.filter(F.col("timestamp") >= cut), store, 1, columns=cols)  # replay
    return read_documents(spark, store)


def _cuts(rows: DataFrame, n: int):
    """``rows`` cut into ``n`` parts of equal length in event time, none if there are no rows."""
    span = rows.agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi")).first()
    if span["lo"] is None:
        return
    width = (span["hi"] - span["lo"]) // n + 1
    for b in range(n):
        lo = span["lo"] + b * width
        yield b, rows.filter((F.col("timestamp") >= lo) & (F.col("timestamp") < lo + width))


def document_store_levels(spark, sf):
    """Twelve micro-batches in the order of time, every third one replayed, merged whenever a level
    has three runs: runs of up to nine batches replace the single ones."""
    store = f"{scratch_path(spark, 'levels')}/documents"
    docs = to_document(enrich_fee(route(fx.transactions(spark, sf))[0]), keep=["event_id"])
    cols = ["_id", "amount", "timestamp", "transactionFee"]
    for b, part in _cuts(docs, 12):
        for _ in range(2 if b % 3 == 2 else 1):
            keyed_store.insert(part, store, b, columns=cols, buckets=4)
        keyed_store.merge(spark, store, fan_out=3)
    return keyed_store.read(spark, store, schema=schemas.DOCUMENT)


def _chain_output(spark, paths: ChainPaths) -> DataFrame:
    docs = read_documents(spark, paths.documents)
    dead = read_documents(spark, paths.dead_letters)
    return (docs.select(F.lit("document").alias("kind"), F.col("_id").alias("accountId"),
                        "timestamp", "amount", "transactionFee")
            .unionByName(dead.select(F.lit("dead_letter").alias("kind"), "accountId",
                                     "timestamp", "amount",
                                     F.lit(None).cast("bigint").alias("transactionFee"))))


def chain_end_to_end(spark, sf):
    tx = fx.transactions_from_events(fx.events_stream(spark, sf))
    return _chain_output(spark, run_chain(spark, tx))


def restart_no_reprocess(spark, sf):
    """Run the chain, restart its last stage on the same checkpoint, and replay
    micro-batch 0 by hand: the outputs must not change."""
    tx = fx.transactions_from_events(fx.events_stream(spark, sf))
    paths = run_chain(spark, tx)
    run_available_now(process_stage(spark, paths))          # restart: nothing new
    topic_rows = topics.scan(spark, paths.topic, TX_EID, stream=False)
    process_batch(topic_rows, 0, paths.documents, paths.dead_letters)  # forced replay
    return _chain_output(spark, paths)


def chain_small_batches_compacted(spark, sf):
    """The chain's topic processed in five micro-batches and both stores compacted every
    two.  The batches are cut by event time, so an account's first row is in the first
    batch that has it, whatever the topic's files hold: the stores must hold the same
    rows as with one large batch."""
    tx = fx.transactions_from_events(fx.events_stream(spark, sf))
    paths = run_chain(spark, tx)
    small = paths.with_outputs("_small")
    rows = topics.scan(spark, paths.topic, TX_EID, stream=False)
    for b, part in _cuts(rows, 5):
        process_batch(part, b, small.documents, small.dead_letters, compact_every=2)
    return _chain_output(spark, small)


def chain_conservation(spark, sf):
    """Rows in and out of the chain's stages, with faulty records: some accounts missing,
    some records undecodable, compaction every two batches.  In = documents +
    duplicates of an account + dead letters + quarantine, and nothing is lost."""
    root = scratch_path(spark, "conservation")
    paths = ChainPaths.under(root)
    tx = fx.transactions(spark, sf)
    no_account = F.col("event_id") % 11 == 0
    value = F.when(F.col("event_id") % fx.CORRUPT_EVERY == 0, F.lit(fx.CORRUPT_TEXT)).when(
        no_account, encode_json("timestamp", "amount")).otherwise(
        encode_json("accountId", "timestamp", "amount"))
    log = tx.select("event_id", F.col("accountId").cast("string").cast("binary").alias("key"),
                    value.cast("binary").alias("value"))
    log.write.parquet(paths.log)
    run_available_now(topic_stage(spark, paths))
    run_available_now(process_stage(spark, paths, max_files_per_trigger=1, compact_every=2))
    rows = topics.scan(spark, paths.topic, TX_EID, stream=False)
    main, _ = route(rows)
    docs = read_documents(spark, paths.documents, schema=schemas.DOCUMENT)
    letters = read_documents(spark, paths.dead_letters, schema=TX_EID)
    parts = {"log": log, "topic": rows, "quarantine": read_quarantine(spark, paths), "main": main,
             "documents": docs, "dead_letters": letters}
    counts = None
    for name, df in parts.items():
        one = df.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"))
        counts = one if counts is None else counts.unionByName(one)
    return counts.agg(*[F.max(F.when(F.col("name") == name, F.col("n"))).alias(name) for name in parts]) \
        .select("log", "topic", "quarantine", "documents",
                (F.col("main") - F.col("documents")).alias("duplicates"), "dead_letters",
                (F.col("log") - F.col("topic") - F.col("quarantine")).alias("lost_in_topic"),
                (F.col("topic") - F.col("main") - F.col("dead_letters")).alias("lost_in_stores"))


def bucketed_text_lines(spark, sf):
    root = scratch_path(spark, "text_sink")
    e = fx.events_stream(spark, sf)
    seq = e.select(F.col("event_id").alias("id"), ntz_to_ms("ts").alias("timestamp"),
                   F.col("event_id").cast("string").alias("payload"))
    run_available_now(text_writer(seq, row_to_line("sequence_event"), f"{root}/lines",
                                  f"{root}/_ck/lines"))
    out = spark.read.schema("value string, bucket string").text(f"{root}/lines")
    return out.select("bucket", F.col("value").alias("line"))


def text_rolling_lines(spark, sf):
    """B4 with files of 64 KB: the events in three micro-batches a minute apart, then the timer
    closes what is idle; all lines are in finished files."""
    root = scratch_path(spark, "rolling")
    out, state = f"{root}/lines", f"{root}/state"
    seq = fx.sequence_events(spark, sf)
    for b in range(3):
        rolling.roll_batch(seq.where(F.col("id") % 3 == b), b, out, state, b * 60_000, row_to_line("sequence_event"),
                           target=1 << 16)
    rolling.close_idle(spark, out, state, 10 * 60_000, target=1 << 16)
    return rolling.read_lines(spark, out).select("bucket", F.col("value").alias("line"))


# ------------------------------------------------------------- metrics E1-E6
def event_counter(spark, sf):
    return metrics.event_counter(fx.lag_samples(spark, sf), "partition")


def event_counter_observed(spark, sf):
    """E1 as a metric: a running count observed on the events stream (noop sink, one file
    a batch), summed over all progress reports a listener has seen."""
    root = scratch_path(spark, "observed")
    s = metrics.observe_counter(fx.events_stream(spark, sf, max_files_per_trigger=1), "event_counter")
    _, reports = run_logged(spark, noop_writer(s, f"{root}/_ck"))
    total = observed_total(reports, "event_counter")
    return spark.createDataFrame([(total,)], "events long")


def lag_over_timestamps(spark, sf):
    """C14: processed-at minus event time, both in ms, of every transaction."""
    tx = fx.transactions(spark, sf)
    processed = F.col("timestamp") + (F.col("event_id") * fx.LAG_FACTOR) % fx.LAG_MOD
    return tx.select("event_id", processed.alias("processed_at"), "timestamp") \
        .withColumn("lag_ms", lag_ms(F.col("processed_at")))


def wall_clock(spark, sf):
    """C7: the clock column on every event -- one value a query, between the driver's readings, and
    behind all event times."""
    before = int(time.time() * 1000)
    e = fx.transactions(spark, sf).select("timestamp", now_ms().alias("now"))
    return e.agg(F.count(F.lit(1)).alias("events"), F.countDistinct("now").alias("clocks"),
                 F.count_if(F.col("now") >= before).alias("not_before"),
                 F.count_if(F.col("now") > F.col("timestamp")).alias("behind_events"))


def _round(df: DataFrame, cols) -> DataFrame:
    return df.select(*[F.round(c, ROUND).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


HIST_DOUBLES = ["mean", "stddev", "p50", "p75", "p95", "p98", "p99", "p999"]


def lag_histogram(spark, sf):
    return _round(metrics.lag_histogram(fx.lag_samples(spark, sf)), HIST_DOUBLES)


def lag_histogram_n_plus_1(spark, sf):
    h = metrics.lag_histogram(fx.lag_samples(spark, sf), method="n_plus_1")
    return _round(h, HIST_DOUBLES)


def lag_histogram_streamed(spark, sf):
    """E2 on a stream: the lag samples arrive as a file stream; the running
    histogram after the last micro-batch is returned."""
    root = scratch_path(spark, "lag_stream")
    tx = fx.with_partition(fx.transactions_from_events(fx.events_stream(spark, sf)))
    samples = tx.select("event_id", "partition",
                        ((F.col("event_id") * fx.LAG_FACTOR) % fx.LAG_MOD).alias("lag"))
    run_available_now(histogram_writer(samples, f"{root}/out", f"{root}/_ck"))
    return _round(latest_histogram(spark, f"{root}/out"), HIST_DOUBLES)


def lag_p99(spark, sf):
    return _round(metrics.lag_p99(fx.lag_samples(spark, sf)), ["p99"])


def lag_p99_avg(spark, sf):
    return _round(metrics.lag_p99_avg(fx.lag_samples(spark, sf)), ["avg_p99"])


def lag_rolling_p99(spark, sf):
    r = metrics.rolling_quantile(fx.lag_samples(spark, sf), "partition", "event_id", "lag")
    return _round(r.select("event_id", "partition", "lag", "rolling_p99"), ["rolling_p99"])


def rate_sliding(spark, sf):
    r = metrics.rate_sliding(fx.with_partition(fx.transactions(spark, sf)), "partition",
                             window=RATE_WINDOW, slide=RATE_SLIDE, window_seconds=RATE_SECONDS)
    return _round(r, ["rate_per_sec"])


def rate_tumbling(spark, sf):
    r = metrics.rate_sliding(fx.with_partition(fx.transactions(spark, sf)), "partition",
                             window=RATE_WINDOW, slide=RATE_WINDOW, window_seconds=RATE_SECONDS)
    return _round(r, ["rate_per_sec"])


def rate_total(spark, sf):
    r = metrics.rate_total(fx.transactions(spark, sf), window=RATE_WINDOW, slide=RATE_SLIDE,
                           window_seconds=RATE_SECONDS)
    return _round(r, ["rate_per_sec"])


def rate_sliding_streamed(spark, sf):
    """E3 as a watermarked stream over the events file (append mode): every window
    closed by the final watermark (= the latest event time) is emitted once."""
    root = scratch_path(spark, "rate_stream")
    tx = fx.with_partition(fx.transactions_from_events(fx.events_stream(spark, sf)))
    r = metrics.rate_sliding_stream(tx, "partition", window=RATE_WINDOW, slide=RATE_SLIDE,
                                    window_seconds=RATE_SECONDS, watermark="0 seconds")
    out = _drain(spark, r, root, "out")
    return _round(out, ["rate_per_sec"])


def rate_total_streamed(spark, sf):
    """E4 as a stream: the slides' counts over all partitions, then the windows over them."""
    root = scratch_path(spark, "total_stream")
    tx = fx.transactions_from_events(fx.events_stream(spark, sf))
    r = metrics.rate_sliding_stream(tx, None, window=RATE_WINDOW, slide=RATE_SLIDE,
                                    window_seconds=RATE_SECONDS, watermark="0 seconds")
    return _round(_drain(spark, r, root, "out"), ["rate_per_sec"])


def lag_sketch_p99(spark, sf):
    """E5 over all events of a day, not the last 1000: p99 from merged sketches, told by its exact
    rank -- whether it lies within three times the sketches' rank error."""
    samples = fx.lag_samples(spark, sf)
    windows = metrics.sketch_windows(metrics.lag_sketches(samples, slide="1 hour"), window="1 day", slide="1 day")
    day = F.floor(F.col("timestamp") / 86_400_000) * 86_400_000
    ranked = samples.withColumn("window_start_ms", day).join(windows, ["partition", "window_start_ms"])
    off = 3 * metrics.RANK_ERROR
    return ranked.groupBy("partition", "window_start_ms").agg(
        F.count(F.lit(1)).alias("samples"), F.max("n").alias("n"),
        ((F.avg((F.col("lag") < F.col("p99")).cast("int")) <= 0.99 + off)
         & (F.avg((F.col("lag") <= F.col("p99")).cast("int")) >= 0.99 - off)).alias("within"))


def epoch_sink_round_trip(spark, sf):
    """The library's own sink: the events stream in epochs, read back from what was committed."""
    root = scratch_path(spark, "epochs")
    tx = fx.transactions_from_events(fx.events_stream(spark, sf))
    run_available_now(epoch_writer(tx, f"{root}/out", f"{root}/_ck"))
    run_available_now(epoch_writer(tx, f"{root}/out", f"{root}/_ck"))      # restart: nothing new
    return read_epochs(spark, f"{root}/out", TX_EID).drop("epoch")


def epoch_sink_counted(spark, sf):
    """The same sink without keeping rows: what it took, from its commit messages."""
    root = scratch_path(spark, "counted")
    run_available_now(epoch_writer(fx.events_stream(spark, sf, max_files_per_trigger=1), f"{root}/out",
                                   f"{root}/_ck", keep=False))
    return ledger(spark, f"{root}/out").agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("events"),
                                            F.coalesce(F.sum("files"), F.lit(0)).alias("files"))


def load_feedback(spark, sf):
    """Payload events -> topic (4 partitions, keyed by id text) -> read back in the
    same session; events per partition as seen by the reader."""
    root = scratch_path(spark, "load")
    ev = gen.generate_from(fx.events_stream(spark, sf), "event_id", "payload_events",
                           clock=_gen_clock())
    writer, reader = load_writers(spark, ev, root, num_partitions=fx.TOPIC_PARTITIONS)
    run_available_now(writer)
    run_available_now(reader())
    return metrics.event_counter(read_samples(spark, root), "partition")


# ---------------------------------------------------------------- audits R1-R4
def audit_missing(spark, sf):
    return audit.audit_missing(fx.sequence_events(spark, sf), fx.delivered(spark, sf))


def audit_duplicates(spark, sf):
    return audit.audit_duplicates(fx.delivered(spark, sf))


def delivered_once(spark, sf):
    """R2 on a stream: repeats are removed within the watermark, later ones by the keyed store."""
    root = scratch_path(spark, "delivered_once")
    stream = fx.delivered_from(fx.sequence_from_events(fx.events_stream(spark, sf)))
    run_available_now(unique_writer(stream, "id", f"{root}/store", f"{root}/_ck", delay="1 hour"))
    return keyed_store.read(spark, f"{root}/store", schema=schemas.SEQUENCE_EVENT)


def audit_gaps(spark, sf):
    return audit.audit_gaps(fx.delivered(spark, sf))


def audit_gaps_incremental(spark, sf):
    """R3 batch by batch: delivered ids in eight batches (each third one replayed) merge into a
    table of ranges; the gaps are read from the ranges after the last batch."""
    state = f"{scratch_path(spark, 'ranges')}/state"
    ids = fx.delivered(spark, sf).select("id")
    for b in range(8):
        part = ids.where(F.pmod(F.xxhash64("id"), F.lit(8)) == b)
        for _ in range(2 if b % 3 == 2 else 1):
            intervals.add_batch(part, b, state, bits=10)
    return intervals.gaps(intervals.ranges_after(spark, state))


def audit_missing_ranges(spark, sf):
    """R1 as ranges: produced less delivered ids, by one sweep over the ranges' ends."""
    missing = intervals.subtract(intervals.of_ids(fx.sequence_events(spark, sf)),
                                 intervals.of_ids(fx.delivered(spark, sf)))
    return intervals.stitched(missing).select(F.col("lo").alias("first"), F.col("hi").alias("last"),
                          (F.col("hi") - F.col("lo") + 1).alias("missing"))


def audit_payload(spark, sf):
    return audit.audit_payload(fx.delivered(spark, sf))


def recovery_audit(spark, sf):
    """Sequence events -> 1-partition topic -> text lines; the processor is
    restarted once and the producer re-run on its checkpoint; then the lines
    are parsed back and audited against what was produced."""
    root = scratch_path(spark, "recovery")
    events = fx.events_stream(spark, sf)
    seq = events.select(F.col("event_id").alias("id"), ntz_to_ms("ts").alias("timestamp"),
                        F.col("event_id").cast("string").alias("payload"))
    run_available_now(recovery.producer(seq, root))
    run_available_now(recovery.processor(spark, root))
    run_available_now(recovery.producer(seq, root))      # restart: nothing new
    run_available_now(recovery.processor(spark, root))   # restart: nothing re-read
    return recovery.summary(fx.sequence_events(spark, sf), recovery.delivered(spark, root))


def flagship(spark, sf):
    """Documents of the transaction flow: route, enrich, first row per account."""
    docs = to_document(enrich_fee(route(fx.transactions(spark, sf))[0]), keep=["event_id"])
    return first_per_key(docs, "_id").drop("event_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "gen_transactions": gen_transactions,
    "gen_payload_events": gen_payload_events,
    "gen_sequence_events": gen_sequence_events,
    "route_positive": route_positive,
    "route_dead_letter": route_dead_letter,
    "route_dead_letter_negative": route_dead_letter_negative,
    "enrich_fee": enrich_fee_q,
    "document_projection": document_projection,
    "split_counts": split_counts_q,
    "exact_duplicates": exact_duplicates_q,
    "json_encode": json_encode,
    "json_round_trip": json_round_trip,
    "decode_ok": decode_ok,
    "decode_quarantine": decode_quarantine,
    "row_to_line": row_to_line_q,
    "keyed_order": keyed_order_q,
    "keyed_order_streamed": keyed_order_streamed,
    "keyed_order_continued": keyed_order_continued,
    "topic_partition_counts": topic_partition_counts,
    "topic_round_trip": topic_round_trip,
    "topic_scan_all": topic_scan_all,
    "topic_scan_latest": topic_scan_latest,
    "topic_scan_epochs_latest": topic_scan_epochs_latest,
    "topic_group_lag": topic_group_lag,
    "log_scan_earliest": log_scan_earliest,
    "document_insert_once": document_insert_once,
    "document_store_levels": document_store_levels,
    "chain_end_to_end": chain_end_to_end,
    "restart_no_reprocess": restart_no_reprocess,
    "chain_small_batches_compacted": chain_small_batches_compacted,
    "bucketed_text_lines": bucketed_text_lines,
    "text_rolling_lines": text_rolling_lines,
    "chain_conservation": chain_conservation,
    "event_counter": event_counter,
    "lag_over_timestamps": lag_over_timestamps,
    "wall_clock": wall_clock,
    "event_counter_observed": event_counter_observed,
    "lag_histogram": lag_histogram,
    "lag_histogram_n_plus_1": lag_histogram_n_plus_1,
    "lag_histogram_streamed": lag_histogram_streamed,
    "lag_p99": lag_p99,
    "lag_p99_avg": lag_p99_avg,
    "lag_rolling_p99": lag_rolling_p99,
    "rate_sliding": rate_sliding,
    "rate_tumbling": rate_tumbling,
    "rate_total": rate_total,
    "rate_sliding_streamed": rate_sliding_streamed,
    "rate_total_streamed": rate_total_streamed,
    "lag_sketch_p99": lag_sketch_p99,
    "epoch_sink_round_trip": epoch_sink_round_trip,
    "epoch_sink_counted": epoch_sink_counted,
    "load_feedback": load_feedback,
    "audit_missing": audit_missing,
    "audit_duplicates": audit_duplicates,
    "delivered_once": delivered_once,
    "audit_gaps": audit_gaps,
    "audit_gaps_incremental": audit_gaps_incremental,
    "audit_missing_ranges": audit_missing_ranges,
    "audit_payload": audit_payload,
    "recovery_audit": recovery_audit,
    "document_first_per_account": flagship,
}
