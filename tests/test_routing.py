from pyspark.sql import functions as F

from txstream.operators.enrich import enrich_fee, exact_duplicates, to_document
from txstream.operators.routing import route, split_counts


def _tx(spark, rows):
    return spark.createDataFrame(rows, "event_id long, accountId long, timestamp long, amount long")


def test_route_zero_negative_null_are_dead_letters(spark):
    df = _tx(spark, [(1, 1, 2, 3), (2, 1, 2, 0), (3, 1, 2, -1), (4, 7, None, None)])
    main, dead = route(df)
    assert [r.event_id for r in main.collect()] == [1]
    assert sorted(r.event_id for r in dead.collect()) == [2, 3, 4]


def test_route_conserves_rows(spark):
    from tests.conftest import SF_TEST
    from txstream.plans import fixtures as fx
    tx = fx.with_partition(fx.transactions(spark, SF_TEST))
    main, dead = route(tx)
    assert main.count() + dead.count() == tx.count()
    assert main.join(dead, "event_id").count() == 0
    s = split_counts(tx).agg(F.sum("n_in"), F.sum("n_main"), F.sum("n_dead")).first()
    assert s[0] == s[1] + s[2] == 10_000 and s[2] == 178


def test_generated_dead_letters_are_every_tenth(spark):
    from txstream.sources.generators import generate
    for n in (1, 10, 11, 1234):
        main, dead = route(generate(spark, n, num_partitions=3))
        assert dead.count() == -(-n // 10)


def test_route_empty(spark):
    main, dead = route(_tx(spark, []))
    assert main.count() == 0 and dead.count() == 0


def test_main_filter_pushed_to_parquet_scan(spark, scratch):
    path = scratch("route")
    _tx(spark, [(1, 1, 2, 3), (2, 1, 2, 0)]).write.parquet(path)
    main, _ = route(spark.read.parquet(path))
    plan = main.select("accountId")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(amount,0)" in plan
    assert "ReadSchema: struct<accountId:bigint,amount:bigint>" in plan


def test_enrich_and_document(spark):
    df = _tx(spark, [(1, 9, 2, 3)])
    doc = to_document(enrich_fee(df)).first()
    assert doc.asDict() == {"_id": 9, "amount": 3, "timestamp": 2, "transactionFee": 5}
    assert enrich_fee(df, fee=7).first().transactionFee == 7


def test_exact_duplicates(spark):
    df = _tx(spark, [(1, 1, 2, 3), (1, 1, 2, 3), (2, 1, 2, 3)])
    out = exact_duplicates(df).collect()
    assert len(out) == 1 and out[0].copies == 2
