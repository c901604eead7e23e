import random

import pytest

from txstream.operators import keyed_store as ks
from txstream.operators.documents import insert_once, read_documents
from txstream.sources.fs import list_dirs, list_names

COLS = "event_id long, _id long, amount long, timestamp long"
DOC = ["_id", "amount", "timestamp"]


def rows_of(spark, store):
    return sorted(((r._id, r.amount, r.timestamp) for r in ks.read(spark, store).collect()), key=str)


def add(want, rows):
    """First row per key inside a batch by (timestamp, event_id); stored keys stay."""
    for e, k, a, t in sorted(rows, key=lambda r: (r[3], r[0])):
        want.setdefault(k, (k, a, t))


@pytest.mark.parametrize("few", [4096, 3])
def test_equals_a_dictionary_over_many_batches_replays_and_merges(spark, scratch, few):
    store, rng, want, event = scratch("store"), random.Random(few), {}, 0
    written = {}
    for b in range(14):
        rows = []
        for _ in range(rng.randint(0, 12)):
            event += 1
            rows.append((event, rng.choice([None, *range(-5, 25), 10**15 + b]), rng.randint(0, 9), rng.randint(0, 5)))
        frame = spark.createDataFrame(rows, COLS).coalesce(2)
        before = len(want)
        add(want, rows)
        assert ks.insert(frame, store, b, columns=DOC, buckets=4, few=few) == len(want) - before
        if b % 5 == 1:
            assert ks.insert(frame, store, b, columns=DOC, few=few) == 0        # a replay
        levels = {r.folder: r.level for r in ks.load(spark, store).runs}
        level = ks.merge(spark, store, fan_out=3, rows_per_bucket=8)
        after = {r.folder: r.level for r in ks.load(spark, store).runs}
        # only the runs of the full level are replaced
        assert {f for f in levels if f not in after} == {f for f, n in levels.items() if n == level}
        written = after
        assert rows_of(spark, store) == sorted(want.values(), key=str)
    assert max(written.values()) >= 2 and all(
        sum(n == level for n in written.values()) <= 3 for level in written.values())


def test_a_batch_opens_only_runs_and_buckets_of_its_keys(spark, scratch):
    store = scratch("store")
    for b in range(4):          # ids ascend from batch to batch
        frame = spark.range(b * 100, b * 100 + 100).selectExpr("id event_id", "id _id", "1L amount", "id timestamp")
        ks.insert(frame, store, b, columns=DOC, buckets=8)
    m = ks.load(spark, store)
    wanted = {"0": [250, 260]}
    assert [r.folder for r, _ in ks.touched(m, wanted, False)] == ["batch=2"]
    assert ks.touched(m, {"0": [1000, 2000]}, False) == [] and ks.touched(m, {}, False) == []
    assert ks.stored(spark, store, m, {"0": [1000, 2000]}) is None          # nothing is opened
    ks.merge(spark, store, fan_out=4, rows_per_bucket=50)
    m = ks.load(spark, store)
    (run,) = m.runs
    assert run.level == 1 and run.rows == 400 and set(run.spans) == {str(i) for i in range(8)}
    some = spark.range(7, 9).select(ks.bucket_of("id", 8).alias("b")).collect()
    wanted = {str(r.b): [7, 8] for r in some}
    assert run.cut == 8 and ks.touched(m, wanted, False) == [(run, sorted(wanted))]
    run.cut, spans = 4, run.spans
    run.spans = {str(i): [0, 399] for i in range(4)}          # a run of fewer buckets than the store's
    assert ks.touched(m, {"6": [7, 8], "2": [7, 8]}, False) == [(run, ["2"])]
    run.cut, run.spans = 8, spans
    df = ks.stored(spark, store, m, wanted, keys=[7, 8])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_bucket" in plan.replace("isnotnull(_bucket#", "_bucket") or "_bucket" in plan
    assert "In(_id, [7,8])" in plan and sorted(r._id for r in df.collect()) == [7, 8]
    files = {f.rsplit("/", 2)[-2] for f in df.inputFiles()}
    assert files <= {f"_bucket={i}" for i in range(8)}


def test_failed_attempts_and_other_writers(spark, scratch, monkeypatch):
    store = scratch("store")
    frame = spark.createDataFrame([(1, 1, 5, 1)], COLS)
    with monkeypatch.context() as patch:
        patch.setattr(ks, "_save", lambda *a: (_ for _ in ()).throw(OSError("no")))
        with pytest.raises(OSError):
            ks.insert(frame, store, 0, columns=DOC)        # files written, no manifest
    assert not ks.exists(spark, store)
    with monkeypatch.context() as patch:
        save, calls = ks._save, []
        patch.setattr(ks, "_save", lambda *a: save(*a) if not calls and not calls.append(1)
                      else (_ for _ in ()).throw(OSError("no")))
        with pytest.raises(OSError):
            ks.insert(frame, store, 0, columns=DOC)        # files written, but not committed
    assert list_dirs(spark, store) and ks.read(spark, store, schema=COLS).count() == 0
    assert ks.insert(frame, store, 0, columns=DOC, writer="a") == 1
    # batch 0 of another stream is another batch
    assert ks.insert(spark.createDataFrame([(1, 1, 6, 0), (2, 2, 6, 0)], COLS), store, 0, columns=DOC, writer="b") == 1
    assert rows_of(spark, store) == [(1, 5, 1), (2, 6, 0)]
    with monkeypatch.context() as patch:
        patch.setattr(ks, "_save", lambda *a: (_ for _ in ()).throw(OSError("no")))
        with pytest.raises(OSError):
            ks.merge(spark, store, fan_out=2)
    assert rows_of(spark, store) == [(1, 5, 1), (2, 6, 0)]
    assert len(list_dirs(spark, f"{store}/_levels")) == 1 and ks.vacuum(spark, store, older_than_s=3600) == 0
    assert ks.vacuum(spark, store, older_than_s=-10) == 1
    assert ks.merge(spark, store, fan_out=2) == 0 and ks.merge(spark, store, fan_out=2) is None
    assert ks.vacuum(spark, store, older_than_s=3600) == 0 and ks.vacuum(spark, store, older_than_s=-10) == 2
    assert rows_of(spark, store) == [(1, 5, 1), (2, 6, 0)]


def test_a_store_of_insert_once_is_taken_over(spark, scratch):
    from txstream.operators.documents import compact
    store = scratch("old")
    for b in range(4):
        insert_once(spark.createDataFrame([(b, b, b, 1), (9, 100, b, 2)], COLS), store, b, columns=DOC)
        if b == 1:
            compact(spark, store, 1)
    new = spark.createDataFrame([(5, 2, 77, 0), (6, 50, 6, 0), (7, 100, 7, 0)], COLS)
    assert ks.insert(new, store, 3, columns=DOC) == 0          # committed before
    assert ks.insert(new, store, 4, columns=DOC) == 1
    assert rows_of(spark, store) == sorted([(0, 0, 1), (1, 1, 1), (2, 2, 1), (3, 3, 1), (50, 6, 0), (100, 0, 2)], key=str)
    assert ks.merge(spark, store, fan_out=3) == 0
    assert read_documents(spark, store).count() == 6


def test_text_keys_empty_batches_and_background_merges(spark, scratch):
    store, seen = scratch("text"), set()
    with pytest.raises(FileNotFoundError):
        ks.read(spark, store)
    assert ks.read(spark, store, schema="_id string, v long").count() == 0
    for b in range(9):
        keys = [f"k{i * (b + 1) % 23:02d}é" for i in range(b)]
        frame = spark.createDataFrame([(k, 1, i) for i, k in enumerate(keys)], "_id string, v long, timestamp long")
        got = ks.insert(frame, store, b, columns=["_id", "v"], order=("timestamp",), buckets=3)
        assert got == len(set(keys) - seen)
        seen |= set(keys)
        ks.merge_later(spark, store, fan_out=2)
    ks.settle(store)
    while ks.merge(spark, store, fan_out=2) is not None:
        pass
    assert sorted(r._id for r in ks.read(spark, store, ["_id"]).collect()) == sorted(seen)
    assert len(ks.load(spark, store).runs) <= 4
    assert len(list_names(spark, f"{store}/_manifest")) <= 2 * ks.KEPT_MANIFESTS + 2
    with pytest.raises(ValueError):
        ks.insert(frame, store, 99, key="v")


def test_a_failed_background_merge_is_raised_by_the_next_call():
    def fail():
        raise RuntimeError("merge")
    ks.run_later("nowhere", fail)
    with pytest.raises(RuntimeError, match="merge"):
        ks.settle("nowhere")


def test_many_keys_are_joined_by_shuffle(spark, scratch):
    store = scratch("large")
    one = spark.range(20_000).selectExpr("id event_id", "id * 3 _id", "1L amount", "id timestamp")
    two = spark.range(20_000).selectExpr("id event_id", "id * 2 _id", "2L amount", "id timestamp")
    assert ks.insert(one, store, 0, columns=DOC) == 20_000
    assert ks.insert(two, store, 1, columns=DOC) == 20_000 - 6667
    assert ks.read(spark, store).groupBy("_id").count().where("count > 1").count() == 0


def test_a_batch_of_thousands_of_keys_is_pushed_in_short_lists(spark, scratch):
    """One list of 4096 keys overflowed the stack of a task in Parquet's filters."""
    store, want = scratch("store"), 0
    for b, (low, new) in enumerate([(0, 4000), (2000, 2000), (1000, 0), (5500, 3500)]):
        frame = spark.range(low, low + 4000).selectExpr("id event_id", "id _id", "1L amount", "id timestamp")
        assert ks.insert(frame, store, b, columns=DOC, buckets=4) == new
        want += new
        ks.merge(spark, store, fan_out=2)
    assert ks.read(spark, store).count() == want
    for keys in (list(range(4096)), [float(i) for i in range(600)], [str(i) for i in range(257)]):
        frame = spark.createDataFrame([(k,) for k in (keys[0], keys[-1])], ["k"])
        found = frame.where(ks._in_list("k", keys))
        assert found.count() == 2 and frame.where(ks._in_list("k", keys[1:-1])).count() == 0
        plan = found._jdf.queryExecution().analyzed().toString()
        assert all(part.count(",") < ks.IN_KEYS + 9 for part in plan.split(" IN (")[1:]) and plan.count(" IN (") > 1
    assert int(spark.conf.get(ks.IN_LIMIT)) <= ks.IN_KEYS
