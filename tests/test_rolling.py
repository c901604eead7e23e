import glob
import os
import random

from pyspark.sql import functions as F

from txstream.streaming import rolling
from txstream.streaming.runner import run_available_now

BASE = 1704067200000
HOUR = 3_600_000


def sizes(out):
    return {f.split(f"{out}/")[1].rsplit("/", 1)[0]: os.path.getsize(f) for f in glob.glob(f"{out}/*/*/*.txt")}


def frame(spark, rows):
    return spark.createDataFrame(rows, "timestamp long, text string")


def lines(spark, out):
    return sorted(r.value for r in rolling.read_lines(spark, out).collect())


def test_files_fill_to_the_target_and_idle_ones_close(spark, scratch):
    root, rng = scratch("roll"), random.Random(3)
    out, state, want, longest = f"{root}/out", f"{root}/state", [], 0
    opts = {"target": 1000, "idle_ms": 60_000, "age_ms": 10**9, "line": F.col("text")}
    for b in range(5):
        rows = []
        for i in range(120):         # a third of all lines in one hour
            hour = 0 if i % 3 == 0 else rng.randrange(1, 4)
            rows.append((BASE + hour * HOUR + i, f"{b} {i} " + "x" * rng.randrange(40) + "é"))
        want += [t for _, t in rows]
        longest = max(longest, *(len(t.encode()) + 1 for _, t in rows))
        for _ in range(2 if b == 2 else 1):                 # a replay
            rolling.roll_batch(frame(spark, rows).repartition(3), b, out, state, BASE + b * 1000, **opts)
    got = sizes(out)
    assert len(got) > 12 and all(1000 - longest <= n <= 1000 + longest for n in got.values())
    assert len(glob.glob(f"{out}/*/*/*.txt")) == len(got)          # one file a part
    left = rolling.waiting(spark, state).count()
    assert left > 0 and len(lines(spark, out)) + left == len(want)
    opts.pop("line")
    assert rolling.close_idle(spark, out, state, BASE + 4000 + 59_000, **opts)         # not yet
    assert rolling.waiting(spark, state).count() == left
    assert not rolling.close_idle(spark, out, state, BASE + 4000 + 60_000, **opts)
    assert lines(spark, out) == sorted(want)
    assert not rolling.close_idle(spark, out, state, BASE + 10**9, **opts)
    assert lines(spark, out) == sorted(want)


def test_age_closes_a_bucket_that_is_never_idle(spark, scratch):
    root = scratch("age")
    out, state = f"{root}/out", f"{root}/state"
    for b in range(7):
        rolling.roll_batch(frame(spark, [(BASE, f"line {b}")]), b, out, state, BASE + b * 50_000, F.col("text"),
                           target=10**6, idle_ms=60_000, age_ms=250_000)
    assert lines(spark, out) == [f"line {b}" for b in range(6)]          # the first had waited for 250 s
    assert [r.value for r in rolling.waiting(spark, state).collect()] == ["line 6"]


def test_a_batch_goes_on_after_ticks_and_null_times_have_a_bucket(spark, scratch):
    root = scratch("ticks")
    out, state = f"{root}/out", f"{root}/state"
    opts = {"target": 10**6, "idle_ms": 1000, "age_ms": 10**9}
    rolling.roll_batch(frame(spark, [(None, "n"), (BASE, "a")]), 0, out, state, 0, F.col("text"), **opts)
    assert not rolling.close_idle(spark, out, state, 5000, **opts)
    rolling.roll_batch(frame(spark, [(BASE, "b")]), 1, out, state, 6000, F.col("text"), **opts)
    rolling.roll_batch(frame(spark, [(BASE, "b")]), 1, out, state, 6000, F.col("text"), **opts)
    rolling.roll_batch(frame(spark, []), 2, out, state, 9000, F.col("text"), **opts)
    assert lines(spark, out) == ["a", "b", "n"] and rolling.waiting(spark, state).count() == 0


def test_stream_with_a_manual_clock(spark, scratch):
    root, now = scratch("clock"), [0]
    for i in range(3):
        frame(spark, [(BASE, f"f{i} {k}") for k in range(5)]).coalesce(1).write.parquet(f"{root}/in/f{i}")
    s = (spark.readStream.schema("timestamp long, text string").option("maxFilesPerTrigger", 1)
         .option("recursiveFileLookup", "true").parquet(f"{root}/in"))

    def clock():
        now[0] += 40_000
        return now[0]

    run_available_now(rolling.rolling_text_writer(s, F.col("text"), f"{root}/out", f"{root}/state", f"{root}/ck",
                                                  clock, target=20))
    done = lines(spark, f"{root}/out")
    assert 0 < 15 - len(done) == rolling.waiting(spark, f"{root}/state").count() <= 3
    rolling.close_idle(spark, f"{root}/out", f"{root}/state", now[0] + 60_000, target=20)
    assert len(lines(spark, f"{root}/out")) == 15
