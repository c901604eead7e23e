import pytest

from txstream.operators.documents import first_per_key, insert_once, read_documents

COLS = "event_id long, _id long, amount long, timestamp long, transactionFee long"
DOC = ["_id", "amount", "timestamp", "transactionFee"]


def test_first_per_key_lowest_timestamp_then_event_id(spark):
    df = spark.createDataFrame([(3, 1, 10, 5, 5), (2, 1, 20, 5, 5), (1, 1, 30, 9, 5),
                                (4, 2, 1, 1, 5)], COLS)
    got = {r._id: r.event_id for r in first_per_key(df, "_id").collect()}
    assert got == {1: 2, 2: 4}


def test_insert_once_first_batch_wins_and_replay_is_idempotent(spark, scratch):
    store = scratch("docs")
    b0 = spark.createDataFrame([(1, 1, 10, 5, 5), (2, 1, 11, 4, 5), (3, 2, 12, 7, 5)], COLS)
    b1 = spark.createDataFrame([(4, 1, 99, 1, 5), (5, 3, 13, 8, 5)], COLS)
    insert_once(b0, store, 0, columns=DOC)
    assert read_documents(spark, store).count() == 2
    insert_once(b0, store, 0, columns=DOC)          # replay of batch 0
    assert read_documents(spark, store).count() == 2
    insert_once(b1, store, 1, columns=DOC)
    insert_once(b1, store, 1, columns=DOC)          # replay of batch 1
    docs = {r._id: r.amount for r in read_documents(spark, store).collect()}
    assert docs == {1: 11, 2: 12, 3: 13}             # account 1 keeps batch 0's row


def test_insert_once_empty_batch(spark, scratch):
    store = scratch("docs")
    insert_once(spark.createDataFrame([], COLS), store, 0, columns=DOC)
    b1 = spark.createDataFrame([(1, 1, 10, 5, 5)], COLS)
    insert_once(b1, store, 1, columns=DOC)
    assert read_documents(spark, store).count() == 1


def test_first_per_key_is_partial_aggregation(spark):
    df = spark.createDataFrame([(1, 1, 1, 1, 5)], COLS)
    plan = first_per_key(df, "_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") + plan.count("ObjectHashAggregate") + \
        plan.count("SortAggregate") >= 2   # partial + final: a hot key is reduced map-side
    assert "Window" not in plan


def test_compaction_keeps_results_and_bounds_directories(spark, scratch):
    from txstream.operators.documents import compact, latest_base
    from txstream.sources.fs import list_dirs
    store = scratch("docs")
    rows = [(i, i % 7, 10 + i, i, 5) for i in range(40)]
    for b in range(4):
        insert_once(spark.createDataFrame(rows[b * 10:(b + 1) * 10], COLS), store, b, columns=DOC)
    before = sorted(tuple(r) for r in read_documents(spark, store, DOC).collect())
    compact(spark, store, 2)
    assert latest_base(spark, store) == 2
    assert sorted(d for d in list_dirs(spark, store) if d.startswith("batch=")) == ["batch=3"]
    assert sorted(tuple(r) for r in read_documents(spark, store, DOC).collect()) == before
    # a later batch still sees compacted keys; a replay of a compacted batch adds nothing
    insert_once(spark.createDataFrame([(99, 1, 1, 0, 5), (98, 50, 1, 0, 5)], COLS), store, 4,
                columns=DOC)
    insert_once(spark.createDataFrame(rows[0:10], COLS), store, 1, columns=DOC)
    after = {r._id: r.amount for r in read_documents(spark, store).collect()}
    assert after[1] == dict((r[0], r[1]) for r in before)[1] and after[50] == 1
    assert len(after) == len(before) + 1
    compact(spark, store, 4)
    assert latest_base(spark, store) == 4 and not [d for d in list_dirs(spark, store)
                                                   if d.startswith("batch=")]
    assert len(read_documents(spark, store).collect()) == len(after)


@pytest.mark.parametrize("pattern", range(8))
def test_stores_survive_every_pattern_of_empty_batches(spark, scratch, pattern):
    """Dead letters in some batches only; compaction every two batches loses none."""
    from txstream.operators.documents import read_documents
    from txstream.streaming.sinks import process_batch
    root = scratch("patterns")
    dead_in = [b for b in range(4) if (pattern * 2 + 1) >> b & 1 or b == 3 and pattern % 2]
    want = []
    for b in range(4):
        rows = [(100 + b, b, 5, b * 10)]
        if b in dead_in:
            rows.append((b, b, 0, b * 10 + 1))
            want.append(b)
        batch = spark.createDataFrame(rows, "accountId long, timestamp long, amount long, event_id long")
        process_batch(batch, b, f"{root}/d", f"{root}/dl", compact_every=2)
        got = read_documents(spark, f"{root}/dl", schema="accountId long")
        assert sorted(r.accountId for r in got.collect()) == want
    assert sorted(r._id for r in read_documents(spark, f"{root}/d").collect()) == [100, 101, 102, 103]


def test_null_key_is_one_document(spark, scratch):
    store = scratch("nulls")
    for b in range(3):
        df = spark.createDataFrame([(None, 1, b, b), (b, 1, b, b + 10)],
                                   "_id long, amount long, timestamp long, event_id long")
        insert_once(df, store, b)
    ids = [r._id for r in spark.read.parquet(store).collect()]
    assert sorted(ids, key=str) == [0, 1, 2, None]
