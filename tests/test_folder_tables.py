"""Queries over an events table that is a folder of files must see every row of it."""

import shutil

import duckdb
import pytest

from tests.conftest import SF_SMALL
from txstream.plans import fixtures as fx
from txstream.plans.oracle import ORACLE
from txstream.plans.queries import QUERIES
from txstream.streaming.progress import observed_total, run_logged
from txstream.streaming.sinks import noop_writer
from txstream.operators.metrics import observe_counter

STREAMED = ["keyed_order_streamed", "topic_round_trip", "log_scan_earliest", "chain_end_to_end",
            "restart_no_reprocess", "chain_small_batches_compacted", "bucketed_text_lines",
            "event_counter_observed", "lag_histogram_streamed", "rate_sliding_streamed",
            "load_feedback", "recovery_audit", "chain_conservation"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The small tables with ``events`` as a folder of six files."""
    out = tmp_path_factory.mktemp("sf")
    spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(6).write.parquet(f"{out}/events.parquet")
    shutil.copy(f"{SF_SMALL}/customer.parquet", out / "customer.parquet")
    return str(out)


@pytest.mark.parametrize("name", STREAMED)
def test_streamed_queries_equal_their_oracle(spark, folder, name):
    from tools.check_oracle import rows_of
    got = QUERIES[name](spark, folder)
    rows = [tuple(r) for r in got.collect()]
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{folder}/events.parquet/*.parquet'")
    con.execute(f"create view customer as select * from '{folder}/customer.parquet'")
    cur = con.execute(ORACLE[name])
    want = cur.fetchall()
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(got.columns)
    assert rows_of(got.columns, rows) == rows_of(cols, want)


def test_counter_is_exact_over_many_batches(spark, folder, tmp_path):
    """More batches than ``recentProgress`` keeps."""
    src = tmp_path / "many"
    fx.table(spark, folder, "events").limit(130).repartition(130, "event_id") \
        .write.option("maxRecordsPerFile", 1).parquet(str(src))
    s = spark.readStream.schema(spark.read.parquet(str(src)).schema) \
        .option("maxFilesPerTrigger", 1).parquet(str(src))
    q, reports = run_logged(spark, noop_writer(observe_counter(s, "c"), str(tmp_path / "ck")))
    assert len(reports) >= 130 and observed_total(reports, "c") == 130
