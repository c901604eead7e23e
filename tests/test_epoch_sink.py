import glob
import json
import os
import time

import pytest

from txstream.streaming import epoch_sink as es
from txstream.streaming.runner import run_available_now

SCHEMA = "id long, v string"


@pytest.fixture()
def source(spark, scratch):
    root = scratch("epochs")
    for i in range(4):
        spark.range(i * 50, i * 50 + 50).selectExpr("id", "if(id % 7 = 0, null, concat('v', id)) v") \
            .repartition(2).write.parquet(f"{root}/in/f{i}")

    def stream():
        return (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 2)
                .option("recursiveFileLookup", "true").parquet(f"{root}/in"))
    return root, stream


def test_every_epoch_is_there_once(spark, source):
    root, stream = source
    out = f"{root}/out"
    assert es.read_epochs(spark, out, SCHEMA).count() == 0 and es.ledger(spark, out).count() == 0
    run_available_now(es.epoch_writer(stream(), out, f"{root}/ck"))
    run_available_now(es.epoch_writer(stream(), out, f"{root}/ck"))            # nothing new
    rows = es.read_epochs(spark, out, SCHEMA).collect()
    assert sorted(r.id for r in rows) == list(range(200))
    assert all(r.v == (None if r.id % 7 == 0 else f"v{r.id}") for r in rows)
    counts = {r.epoch: r.rows for r in es.ledger(spark, out).collect()}
    assert sum(counts.values()) == 200 and len(counts) == 4
    for e, n in counts.items():
        assert sum(r.epoch == e for r in rows) == n


def test_a_replayed_epoch_changes_nothing(spark, source):
    """The query's own commit log is cut back, so that Spark runs the last epoch again."""
    root, stream = source
    out, ck = f"{root}/out", f"{root}/ck"
    run_available_now(es.epoch_writer(stream(), out, ck))
    last = max(int(n) for n in os.listdir(f"{ck}/commits") if n.isdigit())
    before = sorted(tuple(r) for r in es.ledger(spark, out).collect())
    for name in (f"{ck}/commits/{last}", f"{ck}/commits/.{last}.crc"):
        if os.path.exists(name):
            os.remove(name)
    files = set(glob.glob(f"{out}/data/*"))
    run_available_now(es.epoch_writer(stream(), out, ck))
    assert sorted(tuple(r) for r in es.ledger(spark, out).collect()) == before
    assert sorted(r.id for r in es.read_epochs(spark, out, SCHEMA).collect()) == list(range(200))
    assert set(glob.glob(f"{out}/data/*")) == files          # the replay's files are gone


def test_killed_tasks_and_failed_epochs_leave_nothing_in_the_table(spark, scratch):
    root = scratch("killed")
    out = f"{root}/out"
    w = es.EpochWriter(out, keep=True)
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"id": pa.array([1, 2], pa.int64()), "v": pa.array(["a", None])})

    def dies():
        yield batch
        raise RuntimeError("executor lost")

    with pytest.raises(RuntimeError):
        w.write(dies())                               # its file stays, unnamed
    first, second = w.write(iter([batch])), w.write(iter([batch, batch]))
    w.abort([first, None], 0)                         # the epoch failed
    assert es.read_epochs(spark, out, SCHEMA).count() == 0
    again = w.write(iter([batch]))
    w.commit([again, second, w.write(iter([]))], 0)
    w.commit([w.write(iter([batch]))], 0)             # a replay
    assert es.read_epochs(spark, out, SCHEMA).count() == 6
    assert [tuple(r) for r in es.ledger(spark, out).collect()] == [(0, 3, 2, 6)]
    assert len(glob.glob(f"{out}/data/*.parquet")) == 3
    assert es.vacuum(spark, out, 3600, time.time() * 1000) == 0
    assert es.vacuum(spark, out, 0, time.time() * 1000 + 5000) == 1
    assert es.read_epochs(spark, out, SCHEMA).count() == 6


def test_a_failing_task_fails_the_query_and_a_restart_completes_it(spark, scratch):
    root = scratch("failing")
    spark.range(20).selectExpr("id", "'x' v").coalesce(1).write.parquet(f"{root}/in/f0")
    s = (spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(f"{root}/in"))
    broken = s.selectExpr("id", "if(id = 13, raise_error('lost'), v) v")
    with pytest.raises(Exception):
        run_available_now(es.epoch_writer(broken, f"{root}/out", f"{root}/ck"))
    assert es.read_epochs(spark, f"{root}/out", SCHEMA).count() == 0
    run_available_now(es.epoch_writer(s, f"{root}/out", f"{root}/ck"))
    assert es.read_epochs(spark, f"{root}/out", SCHEMA).count() == 20


def test_counting_without_keeping_rows(spark, source):
    root, stream = source
    run_available_now(es.epoch_writer(stream(), f"{root}/out", f"{root}/ck", keep=False))
    got = es.ledger(spark, f"{root}/out").collect()
    assert sum(r.rows for r in got) == 200 and sum(r.files for r in got) == 0
    assert not os.path.exists(f"{root}/out/data")
    body = json.loads(open(glob.glob(f"{root}/out/_commits/*/commit.json")[0]).read())
    assert set(body) == {"epoch", "files"}
