from pyspark.sql import functions as F

from txstream.functions.clock import ms_to_ntz, ntz_to_ms


def test_clock_helpers_ignore_session_time_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            df = spark.sql("select timestamp_ntz'2024-07-01 12:00:00.123456' as summer, "
                           "timestamp_ntz'2024-01-01 00:00:00' as winter, "
                           "cast(1719835200123 as bigint) as ms")
            r = df.select(ntz_to_ms("summer").alias("a"), ntz_to_ms("winter").alias("b"),
                          F.date_format(ms_to_ntz("ms"), "yyyy-MM-dd HH:mm:ss.SSS").alias("c"),
                          F.date_format(ms_to_ntz("ms"), "yyyy-MM-dd--HH").alias("d")).first()
            assert (r.a, r.b, r.c, r.d) == (1719835200123, 1704067200000,
                                            "2024-07-01 12:00:00.123", "2024-07-01--12"), tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_callable_generators(spark):
    from pyspark.sql import functions as F
    from txstream.sources.generators import generate
    rows = generate(spark, 3, lambda i, clock: [(i * 2).alias("twice"), clock.alias("at")],
                    clock=F.lit(7)).collect()
    assert [tuple(r) for r in rows] == [(0, 7), (2, 7), (4, 7)]


def test_rates_count_slides_before_windows(spark):
    from txstream.operators.metrics import rate_sliding
    df = spark.range(1000).selectExpr("id * 777 as timestamp", "id % 3 as partition")
    fast = rate_sliding(df, window="1 minute", slide="5 seconds")
    plan = fast._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Expand") < plan.rindex("HashAggregate")
    whole = rate_sliding(df, window="60000 milliseconds", slide="5 seconds")
    assert fast.exceptAll(whole).count() == 0 and whole.exceptAll(fast).count() == 0


def test_last_n_is_limited_map_side_at_any_n(spark):
    from txstream.operators.metrics import last_n
    df = spark.range(20_000).selectExpr("id as event_id", "id % 2 as partition")
    for n in (1000, 1001, 5000):
        got = last_n(df, "partition", "event_id", n)
        assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()
        assert got.count() == 2 * n
