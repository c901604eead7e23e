from txstream.functions.clock import event_time
from txstream.operators import keyed_store
from txstream.streaming import dedup
from txstream.streaming.runner import run_available_now

BASE = 1704067200000
SCHEMA = "id long, timestamp long, v string"


def test_repeats_near_and_far_appear_once_and_state_is_bounded(spark, scratch):
    """Every id twice in its file, again in the next one, and once more long after."""
    root, n = scratch("dedup"), 8
    for f in range(n):
        rows = [(f * 50 + i, BASE + f * 600_000 + i, f"first{f}") for i in range(50)]
        again = [(max(0, f - 1) * 50 + i, BASE + f * 600_000 + i, "near") for i in range(0, 50, 2)]
        far = [(max(0, f - 5) * 50 + i, BASE + f * 600_000 + i, "far") for i in range(0, 50, 3)]
        spark.createDataFrame(rows + rows[:20] + (again if f else []) + (far if f > 4 else []), SCHEMA) \
            .coalesce(1).write.parquet(f"{root}/in/f{f}")
    s = (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1)
         .option("recursiveFileLookup", "true").parquet(f"{root}/in"))
    q = run_available_now(dedup.unique_writer(s, "id", f"{root}/store", f"{root}/ck", delay="15 minutes", fan_out=3,
                                              arrival=event_time("timestamp")))
    got = keyed_store.read(spark, f"{root}/store").collect()
    assert sorted(r.id for r in got) == list(range(n * 50))
    assert all(r.v == f"first{r.id // 50}" for r in got)
    states = [p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.numInputRows]
    assert max(states) < n * 50 - 100                # not every key ever seen
    run_available_now(dedup.unique_writer(s, "id", f"{root}/store", f"{root}/ck", delay="15 minutes",
                                          arrival=event_time("timestamp")))
    assert keyed_store.read(spark, f"{root}/store").count() == n * 50
