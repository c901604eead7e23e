from pyspark.sql import Observation, Window, functions as F

from txstream.operators import metrics


def _lags(spark, n=5000, parts=3):
    return spark.range(n).select(F.col("id").alias("event_id"),
                                 (F.col("id") % parts).alias("partition"),
                                 ((F.col("id") * 37) % 1000).alias("lag"),
                                 (F.lit(1704067200000) + F.col("id") * 1000).alias("timestamp"))


def test_rolling_quantile_chunks_and_halo_match_window(spark):
    df = _lags(spark)
    n = 100
    got = metrics.rolling_quantile(df, "partition", "event_id", "lag", q=0.99, n=n,
                                   chunk_rows=150, num_partitions=7)
    w = Window.partitionBy("partition").orderBy("event_id").rowsBetween(-(n - 1), 0)
    want = df.withColumn("want", F.percentile("lag", 0.99).over(w))
    joined = got.join(want, ["event_id", "partition", "lag", "timestamp"])
    assert joined.count() == df.count() == got.count()
    assert joined.filter(F.abs(F.col("rolling_p99") - F.col("want")) > 1e-9).count() == 0


def test_last_n_is_limited_before_shuffle(spark):
    plan = metrics.last_n(_lags(spark), "partition", "event_id", 1000) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_histogram_counts_only_last_n(spark):
    h = {r.partition: r for r in metrics.lag_histogram(_lags(spark), n=1000).collect()}
    assert all(r["count"] == 1000 for r in h.values())
    import numpy as np
    pdf = _lags(spark).toPandas()
    p0 = pdf[pdf.partition == 0].sort_values("event_id").lag.to_numpy()[-1000:]
    assert abs(h[0].p99 - np.percentile(p0, 99)) < 1e-9
    assert abs(h[0].stddev - p0.std(ddof=1)) < 1e-9


def test_n_plus_1_quantile(spark):
    import numpy as np
    h = {r.partition: r for r in
         metrics.lag_histogram(_lags(spark), n=1000, method="n_plus_1").collect()}
    pdf = _lags(spark).toPandas()
    s = np.sort(pdf[pdf.partition == 1].sort_values("event_id").lag.to_numpy()[-1000:])
    pos = 0.99 * (len(s) + 1)
    lo = int(np.floor(pos))
    want = s[lo - 1] + (pos - lo) * (s[lo] - s[lo - 1])
    assert abs(h[1].p99 - want) < 1e-9


def test_p99_avg_is_mean_of_groups(spark):
    p = [r.p99 for r in metrics.lag_p99(_lags(spark)).collect()]
    a = metrics.lag_p99_avg(_lags(spark)).first()
    assert abs(a.avg_p99 - sum(p) / len(p)) < 1e-9 and a.groups == 3


def test_rates(spark):
    df = _lags(spark, n=600, parts=2)   # one row per second for 10 minutes
    r = metrics.rate_sliding(df, "partition", window="1 minute", slide="5 seconds")
    full = r.filter((F.col("window_start_ms") >= 1704067200000) &
                    (F.col("window_end_ms") <= 1704067200000 + 600_000))
    assert full.agg(F.min("events"), F.max("events")).first() == (30, 30)
    t = metrics.rate_total(df, window="1 minute", slide="5 seconds")
    tot = t.filter(F.col("window_start_ms") == 1704067200000).first()
    assert tot.events == 60 and abs(tot.rate_per_sec - 1.0) < 1e-12


def test_event_counter_and_observation(spark):
    df = _lags(spark, n=100)
    assert {r.partition: r.events for r in metrics.event_counter(df).collect()} == \
        {0: 34, 1: 33, 2: 33}
    obs = Observation("events")
    metrics.observe_counter(df, obs).count()
    assert obs.get["events"] == 100


def test_two_round_top_n_equals_single_window(spark):
    df = spark.range(0, 20000, 1, 40).select(
        F.col("id").alias("event_id"), (F.col("id") % 3).alias("partition"),
        ((F.col("id") * 7919) % 100003).alias("lag"))
    got = metrics.last_n(df, "partition", "lag", n=700, fan_in=3)
    w = Window.partitionBy("partition").orderBy(F.col("lag").desc())
    want = df.withColumn("r", F.row_number().over(w)).filter("r <= 700").drop("r")
    assert got.count() == want.count() == 2100
    assert got.exceptAll(want).count() == 0


def test_rolling_quantile_keeps_wide_ids_and_nulls(spark):
    wide = [2**53 + 1, None, 2**53 + 3, 2**53 - 1, -2**63, 2**62 + 1]
    rows = [(i, wide[i % 6], None if i % 4 == 0 else wide[(i + 1) % 6], i % 3) for i in range(90)]
    df = spark.createDataFrame(rows, "event_id long, p long, extra long, lag long")
    got = metrics.rolling_quantile(df.repartition(3), "p", "event_id", "lag", n=4, chunk_rows=5, num_partitions=4)
    assert sorted(map(tuple, got.select("event_id", "p", "extra", "lag").collect())) == sorted(rows)
    w = Window.partitionBy("p").orderBy("event_id").rowsBetween(-3, 0)
    want = {r.event_id: r.q for r in df.withColumn("q", F.percentile("lag", 0.99).over(w)).collect()}
    assert all(abs(r.rolling_p99 - want[r.event_id]) < 1e-9 for r in got.collect())


def test_rolling_quantile_of_null_values(spark):
    df = spark.createDataFrame([(i, 1, None if i < 3 else float(i)) for i in range(8)],
                               "event_id long, p long, lag double")
    got = {r.event_id: r.rolling_p99 for r in
           metrics.rolling_quantile(df, "p", "event_id", "lag", q=0.5, n=2, chunk_rows=3).collect()}
    assert got == {0: None, 1: None, 2: None, 3: 3.0, 4: 3.5, 5: 4.5, 6: 5.5, 7: 6.5}


def test_merged_sketches_stay_within_their_rank_error(spark):
    """Skewed lags, one group with most rows: ranks of p50 and p99 against the exact ones."""
    df = spark.range(60_000).selectExpr(
        "id event_id", "if(id % 10 < 8, 0, id % 10) partition",
        "cast(pow(1.0003, id % 30011) * 10 as long) lag", "1704067200000 + id * 60 timestamp")
    slides = metrics.lag_sketches(df.repartition(5), slide="5 minutes")
    for by in ("partition", None):
        got = metrics.sketch_windows(slides, by, "30 minutes", "10 minutes", (0.5, 0.99)).collect()
        assert len(got) > 7
        exact = df.toPandas()
        for r in got:
            part = exact[(exact.timestamp >= r.window_start_ms) & (exact.timestamp < r.window_end_ms)]
            if by:
                part = part[part.partition == r.partition]
            assert r.n == len(part)
            for q, v in ((0.5, r.p50), (0.99, r.p99)):
                assert (part.lag < v).mean() <= q + 3 * metrics.RANK_ERROR
                assert (part.lag <= v).mean() >= q - 3 * metrics.RANK_ERROR
