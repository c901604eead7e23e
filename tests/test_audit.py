from txstream.operators import audit


def _seq(spark, ids, alter=()):
    return spark.createDataFrame([(i, 0, str(i) + ("!" if i in alter else "")) for i in ids],
                                 "id long, timestamp long, payload string")


def test_audits(spark):
    produced = _seq(spark, range(20))
    delivered = _seq(spark, [0, 1, 2, 5, 6, 6, 9, 10, 11, 15, 19, 19, 19], alter={10})
    assert sorted(r.id for r in audit.audit_missing(produced, delivered).collect()) == \
        [3, 4, 7, 8, 12, 13, 14, 16, 17, 18]
    assert {r.id: r.copies for r in audit.audit_duplicates(delivered).collect()} == {6: 2, 19: 3}
    gaps = sorted(tuple(r) for r in audit.audit_gaps(delivered, bucket_bits=8).collect())
    assert gaps == [(3, 4, 2), (7, 8, 2), (12, 14, 3), (16, 18, 3)]
    assert [r.id for r in audit.audit_payload(delivered).collect()] == [10]


def test_recovery_summary_counts_faults(spark):
    from txstream.plans.recovery import summary
    produced = _seq(spark, range(10))
    got = _seq(spark, [0, 1, 1, 2, 4, 5, 6, 7, 8, 9, 9, 9, 42], alter={5, 42})
    r = summary(produced, got).first()
    assert r.asDict() == {"produced": 10, "delivered": 13, "missing": 1, "duplicated": 2,
                          "altered": 2}


def test_parse_sequence_line_round_trip(spark):
    from pyspark.sql import functions as F
    from txstream.functions.codec import parse_sequence_line, row_to_line
    ev = _seq(spark, [3, 12], alter={12})
    back = ev.select(row_to_line("sequence_event").alias("value")) \
        .select(*parse_sequence_line("value"))
    assert sorted(tuple(r) for r in back.collect()) == [(3, 0, "3"), (12, 0, "12!")]
    bad = spark.createDataFrame([("junk",)], "value string").select(*parse_sequence_line())
    assert tuple(bad.first()) == (None, None, None)
    assert F


def test_gaps_with_negative_ids_and_bucket_edges(spark):
    ids = [-9, -8, -5, -1, 0, 3, 4, 8, 9, 10, 17]
    got = sorted(tuple(r) for r in
                 audit.audit_gaps(_seq(spark, ids), bucket_bits=8).collect())
    want = sorted((a + 1, b - 1, b - a - 1) for a, b in zip(ids, ids[1:]) if b - a > 1)
    assert got == want
