"""Property tests: operators against brute force on random small inputs."""

import pandas as pd
from hypothesis import HealthCheck, given, settings, strategies as st

from txstream.operators.documents import first_per_key
from txstream.operators.ordering import keyed_positions
from txstream.operators.routing import route

ROWS = st.lists(st.tuples(st.integers(0, 5), st.integers(0, 50),
                          st.one_of(st.none(), st.integers(-3, 3))),
                min_size=0, max_size=40)
SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _frame(spark, rows):
    data = [(i, k, t, a) for i, (k, t, a) in enumerate(rows)]
    return spark.createDataFrame(data, "event_id long, accountId long, timestamp long, "
                                       "amount long")


@SETTINGS
@given(rows=ROWS)
def test_route_is_an_exact_split(spark, rows):
    df = _frame(spark, rows)
    main, dead = route(df)
    got_main = sorted(r.event_id for r in main.collect())
    got_dead = sorted(r.event_id for r in dead.collect())
    assert got_main == [i for i, (_, _, a) in enumerate(rows) if a is not None and a > 0]
    assert sorted(got_main + got_dead) == list(range(len(rows)))


@SETTINGS
@given(rows=ROWS)
def test_first_per_key_matches_brute_force(spark, rows):
    df = _frame(spark, rows)
    got = {r.accountId: r.event_id for r in first_per_key(df, "accountId").collect()}
    want = {}
    for i, (k, t, _) in sorted(enumerate(rows), key=lambda x: (x[1][0], x[1][1], x[0])):
        want.setdefault(k, i)
    assert got == want


@SETTINGS
@given(rows=ROWS, parts=st.integers(1, 6))
def test_keyed_positions_match_brute_force(spark, rows, parts):
    df = _frame(spark, rows)
    got = {r.event_id: r.seq for r in
           keyed_positions(df, ["accountId"], ["timestamp", "event_id"], "seq", parts).collect()}
    pdf = pd.DataFrame([(i, k, t) for i, (k, t, _) in enumerate(rows)],
                       columns=["event_id", "k", "t"])
    want = {}
    if len(pdf):
        pdf = pdf.sort_values(["k", "t", "event_id"])
        pdf["seq"] = pdf.groupby("k").cumcount() + 1
        want = dict(zip(pdf.event_id, pdf.seq))
    assert got == want


@settings(max_examples=6, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 1000)), min_size=1,
                       max_size=120),
       n=st.integers(1, 12), extra=st.integers(0, 20), parts=st.integers(1, 5))
def test_rolling_quantile_matches_brute_force(spark, values, n, extra, parts):
    import numpy as np
    from txstream.operators.metrics import rolling_quantile
    rows = [(i, g, v) for i, (g, v) in enumerate(values)]
    df = spark.createDataFrame(rows, "event_id long, grp long, v long")
    got = {r.event_id: r.q for r in rolling_quantile(df, "grp", "event_id", "v", q=0.9, n=n,
                                                     out="q", chunk_rows=n + extra,
                                                     num_partitions=parts).collect()}
    want = {}
    for g in {g for _, g, _ in rows}:
        seq = [(i, v) for i, gg, v in rows if gg == g]
        for k, (i, _) in enumerate(seq):
            window = [v for _, v in seq[max(0, k - n + 1):k + 1]]
            want[i] = float(np.percentile(window, 90))
    assert got.keys() == want.keys()
    assert all(abs(got[i] - want[i]) < 1e-9 for i in want)


@SETTINGS
@given(ids=st.lists(st.integers(-40, 40), min_size=0, max_size=40),
       bits=st.sampled_from([3, 8, 20]))
def test_gaps_match_brute_force(spark, ids, bits):
    from txstream.operators.audit import audit_gaps
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    got = sorted(tuple(r) for r in audit_gaps(df, bucket_bits=bits).collect())
    u = sorted(set(ids))
    want = sorted((a + 1, b - 1, b - a - 1) for a, b in zip(u, u[1:]) if b - a > 1)
    assert got == want


def test_gaps_of_sparse_wide_ids(spark):
    from txstream.operators.audit import audit_gaps
    ids = sorted({0, 1, 5, -7, 2**20, 2**20 + 1, 2**40, 2**62, 2**63 - 1, -2**63 + 1, 3 * 2**55})
    df = spark.createDataFrame([(i,) for i in ids] + [(None,)], "id long")
    got = {(r.gap_start, r.gap_end) for r in audit_gaps(df).collect()}
    assert got == {(a + 1, b - 1) for a, b in zip(ids, ids[1:]) if b - a > 1}
