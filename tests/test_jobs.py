from txstream import jobs


def test_jobs_chain_from_the_command_line(spark, scratch):
    root = scratch("jobs")
    jobs.run(spark, ["generate", "--root", root, "--rows-per-second", "40",
                     "--max-records", "20", "--trigger", "500 milliseconds"])
    jobs.run(spark, ["log-to-topic", "--root", root, "--available-now"])
    jobs.run(spark, ["process", "--root", root, "--available-now"])
    docs = spark.read.parquet(f"{root}/documents")
    dead = spark.read.parquet(f"{root}/dead_letters")
    assert docs.count() == 18 and dead.count() == 2       # ids 0..19, amount = id % 10


def test_recovery_jobs_from_the_command_line(spark, scratch):
    from txstream.plans import recovery
    root = scratch("jobs")
    jobs.run(spark, ["recovery-producer", "--root", root, "--rows-per-second", "30",
                     "--max-records", "12", "--trigger", "500 milliseconds"])
    jobs.run(spark, ["recovery-processor", "--root", root, "--available-now"])
    got = recovery.delivered(spark, root)
    assert sorted(r.id for r in got.collect()) == list(range(12))


def test_load_test_and_report(spark, scratch):
    root = scratch("jobs")
    jobs.run(spark, ["load-test", "--root", root, "--rows-per-second", "100",
                     "--max-records", "50", "--parallelism", "2", "--payload-size", "8",
                     "--trigger", "500 milliseconds"])
    jobs.run(spark, ["load-report", "--root", root])
    samples = spark.read.parquet(f"{root}/lag")
    assert samples.count() >= 50
    p99 = spark.read.parquet(f"{root}/report/lag_p99")
    assert p99.count() == samples.select("partition").distinct().count()
    avg = spark.read.parquet(f"{root}/report/lag_p99_avg").first()
    assert avg.avg_p99 >= 0 and avg.groups == p99.count()
    total = spark.read.parquet(f"{root}/report/rate_total")
    assert total.agg({"events": "max"}).first()[0] >= 1


def test_checkpoint_root_moves_the_checkpoints(spark, scratch):
    import os
    root, ck = scratch("jobs"), scratch("ck")
    jobs.run(spark, ["generate", "--root", root, "--checkpoint-root", ck,
                     "--rows-per-second", "20", "--max-records", "10",
                     "--trigger", "500 milliseconds"])
    jobs.run(spark, ["log-to-topic", "--root", root, "--checkpoint-root", ck, "--available-now"])
    assert os.path.isdir(f"{ck}/log/offsets") and os.path.isdir(f"{ck}/topic/offsets")
    assert not os.path.exists(f"{root}/_checkpoints")
    assert spark.read.parquet(f"{root}/topic").filter("partition >= 0").count() == 10
