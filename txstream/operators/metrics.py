"""Event counters, lag histograms and rates over an event table or stream.

* ``event_counter``      -- events per group (map-side partial counts).
* ``last_n``             -- the newest ``n`` rows per group (a ring buffer's
                            contents); planned as a partial ``WindowGroupLimit``
                            on every map task before the shuffle, so at most
                            ``n`` rows per group and task cross the network.
* ``lag_histogram``      -- count/min/max/mean/stddev/quantiles over ``last_n``.
* ``rolling_quantile``   -- quantile over the trailing ``n`` rows of every row,
                            per group, split into bounded chunks with a halo.
* ``rate_sliding`` / ``rate_total`` -- events per second over sliding windows.
"""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, Window, functions as F, types as T

from txstream.functions.clock import event_time
from txstream.operators.ordering import keyed_positions
from txstream.session import ship_package

# The quantiles a sample histogram reports, its ring-buffer size,
# and the dashboard's rate window and sampling step.
HISTOGRAM_QUANTILES = (0.5, 0.75, 0.95, 0.98, 0.99, 0.999)
RING_BUFFER_SIZE = 1000
RATE_WINDOW, RATE_STEP, RATE_WINDOW_SECONDS = "1 minute", "5 seconds", 60


def event_counter(df: DataFrame, by: str = "partition") -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("events"))


def observe_counter(df: DataFrame, name: str | Observation = "event_counter") -> DataFrame:
    """Attach a running event count to ``df`` without changing its rows.

    On a stream the metric appears in ``query.lastProgress["observedMetrics"]``;
    on a batch pass an ``Observation`` and read ``.get`` after an action.
    """
    return df.observe(name, F.count(F.lit(1)).alias("events"))


# Spark's setting: the largest limit it pushes below the shuffle.
GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def _cover_group_limit(df: DataFrame, n: int) -> None:
    """Raise the session's threshold to ``n``, so that any ``n`` is limited map-side."""
    conf = df.sparkSession.conf
    if 0 <= int(conf.get(GROUP_LIMIT)) < n:
        conf.set(GROUP_LIMIT, str(n))


def last_n(df: DataFrame, by: str, order: str, n: int = RING_BUFFER_SIZE,
           fan_in: int = 256) -> DataFrame:
    """Newest ``n`` rows per ``by`` by descending ``order``.

    Two rounds of top-``n``: first per group and block of ``fan_in`` input tasks,
    then per group.  Each round is planned with a partial ``WindowGroupLimit``
    ahead of its shuffle, so no task ever receives more than about
    ``n * fan_in`` rows of a group, however many input tasks there are.
    """
    _cover_group_limit(df, n)
    newest = F.col(order).desc()
    blocked = df.withColumn("_blk", F.floor(F.spark_partition_id() / F.lit(fan_in)))
    w1 = Window.partitionBy(by, "_blk").orderBy(newest)
    first = (blocked.withColumn("_rn", F.row_number().over(w1))
                    .filter(F.col("_rn") <= n).drop("_rn", "_blk"))
    w2 = Window.partitionBy(by).orderBy(newest)
    return first.withColumn("_rn", F.row_number().over(w2)).filter(F.col("_rn") <= n).drop("_rn")


def _qname(q: float) -> str:
    return "p" + f"{q:g}".split(".")[1].ljust(2, "0") if q < 1 else "p100"


def lag_histogram(df: DataFrame, by: str = "partition", order: str = "event_id",
                  lag: str = "lag", n: int = RING_BUFFER_SIZE,
                  quantiles=HISTOGRAM_QUANTILES, method: str = "linear") -> DataFrame:
    """Histogram statistics over the newest ``n`` samples per group.

    ``method="linear"`` interpolates at ``q*(k-1)`` (Spark ``percentile``);
    ``method="n_plus_1"`` at ``q*(k+1)`` (the estimator of common sample
    histograms), computed from the sorted sample array of at most ``n`` values.
    """
    recent = last_n(df, by, order, n)
    aggs = [F.count(lag).alias("count"), F.min(lag).alias("min"), F.max(lag).alias("max"),
            F.avg(lag).alias("mean"), F.stddev_samp(lag).alias("stddev")]
    if method == "linear":
        aggs += [F.percentile(lag, q).alias(_qname(q)) for q in quantiles]
        return recent.groupBy(by).agg(*aggs)
    if method != "n_plus_1":
        raise ValueError(method)
    out = recent.groupBy(by).agg(*aggs, F.sort_array(F.collect_list(F.col(lag).cast("double")))
                                 .alias("_s"))
    return out.select(by, "count", "min", "max", "mean", "stddev",
                      *[_quantile_n_plus_1("_s", q).alias(_qname(q)) for q in quantiles])


def _quantile_n_plus_1(arr: str, q: float):
    """Quantile of a sorted array at position ``q*(k+1)`` (1-based), clamped."""
    k = F.size(arr)
    pos = F.lit(q) * (k + 1)
    lo = F.floor(pos).cast("int")
    frac = pos - lo
    at = lambda i: F.element_at(arr, F.least(F.greatest(i, F.lit(1)), k))
    return (F.when(k == 0, F.lit(None))
             .when(pos < 1, at(F.lit(1)))
             .when(pos >= k, at(k))
             .otherwise(at(lo) + frac * (at(lo + 1) - at(lo))))


def lag_p99(df: DataFrame, by: str = "partition", order: str = "event_id", lag: str = "lag",
            n: int = RING_BUFFER_SIZE) -> DataFrame:
    return (last_n(df, by, order, n).groupBy(by)
            .agg(F.percentile(lag, 0.99).alias("p99")))


def lag_p99_avg(df: DataFrame, by: str = "partition", order: str = "event_id",
                lag: str = "lag", n: int = RING_BUFFER_SIZE) -> DataFrame:
    """Mean over groups of the per-group p99 (not a global p99)."""
    return (lag_p99(df, by, order, lag, n)
            .agg(F.avg("p99").alias("avg_p99"), F.count(F.lit(1)).alias("groups")))


def _rolling_chunk(value: str, q: float, n: int, out: str):
    """One chunk as an Arrow table: only the value leaves it (as double), all other columns keep
    their type and every bit."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("_seq")
        vals = pd.Series(table.column(value).cast(pa.float64()).to_numpy())
        res = vals.rolling(n, min_periods=1).quantile(q, interpolation="linear")
        table = table.append_column(out, pa.array(res, pa.float64(), from_pandas=True))
        return table.filter(pc.invert(table.column("_halo"))).drop_columns(["_halo", "_chunk"])
    return run


def rolling_quantile(df: DataFrame, by: str, order: str, value: str, q: float = 0.99,
                     n: int = RING_BUFFER_SIZE, out: str = "rolling_p99",
                     chunk_rows: int = 1 << 16, num_partitions: int | None = None) -> DataFrame:
    """Quantile of ``value`` over each row's trailing ``n`` rows (itself included).

    Equals ``percentile(value, q) over (partition by by order by order rows
    between n-1 preceding and current row)`` but never puts a whole group into
    one task: rows get their position within the group (``keyed_positions``),
    are cut into chunks of ``chunk_rows``, and the last ``n-1`` rows of every
    chunk are copied into the next one as a halo.  Each chunk (at most
    ``chunk_rows + n - 1`` rows) is then evaluated by a sliding-window quantile
    in O(rows * log n), against O(rows * n) for a recomputed window frame.
    """
    if chunk_rows < n:
        raise ValueError("chunk_rows must be >= n")
    ship_package(df.sparkSession)
    pos = keyed_positions(df, [by], [order], "_seq", num_partitions)
    chunk = F.expr(f"(_seq - 1) div {int(chunk_rows)}")
    in_tail = ((F.col("_seq") - 1) % chunk_rows) >= (chunk_rows - (n - 1))
    # one pass: every row goes to its chunk, tail rows also to the next one
    targets = F.when(in_tail, F.array(chunk, chunk + 1)).otherwise(F.array(chunk))
    both = (pos.withColumn("_chunk", F.explode(targets))
               .withColumn("_halo", F.col("_chunk") != chunk))
    fields = [f for f in both.schema.fields if f.name not in ("_halo", "_chunk")]
    schema = T.StructType(fields + [T.StructField(out, T.DoubleType())])
    return (both.groupBy(by, "_chunk")
                .applyInArrow(_rolling_chunk(value, q, n, out), schema)
                .drop("_seq"))


# Size parameter of the sketches and the rank error that belongs to it: an estimate of quantile
# q has a rank within q +- RANK_ERROR with 99 % probability (2.296 / k ^ 0.9021).
SKETCH_K = 4096
RANK_ERROR = 2.296 / SKETCH_K ** 0.9021


def lag_sketches(df: DataFrame, by: str = "partition", time_ms: str = "timestamp", lag: str = "lag",
                 slide: str = RATE_STEP) -> DataFrame:
    """A quantile sketch of all lags per group and slide: ``by``, slide, n, sketch.

    Unlike the last 1000 samples it covers every event.  Sketches are made on the map side,
    so a hot group sends one small sketch a task, and they merge across tasks, micro-batches and slides.
    """
    return (df.groupBy(by, F.window(event_time(time_ms), slide).alias("slide"))
              .agg(F.count(lag).alias("n"), F.kll_sketch_agg_bigint(F.col(lag), F.lit(SKETCH_K)).alias("sketch")))


def sketch_windows(sketches: DataFrame, by: str | None = "partition", window: str = RATE_WINDOW,
                   slide: str = RATE_STEP, quantiles=(0.99,)) -> DataFrame:
    """Quantiles over sliding windows (whole numbers of slides) from :func:`lag_sketches`.

    ``by=None`` merges the groups too.  Each estimate's rank is off by at most ``RANK_ERROR``
    (with 99 % probability); empty windows have no row.
    """
    keys = [by] if by else []
    merged = (sketches.where("n > 0").groupBy(*keys, F.window("slide.start", window, slide).alias("window"))
              .agg(F.sum("n").alias("n"), F.kll_merge_agg_bigint("sketch").alias("sketch")))
    return merged.select(*keys, F.unix_millis("window.start").alias("window_start_ms"),
                         F.unix_millis("window.end").alias("window_end_ms"), "n",
                         *[F.kll_sketch_get_quantile_bigint("sketch", F.lit(q)).alias(_qname(q)) for q in quantiles])


def _window_cols(window_seconds: int):
    return [F.unix_millis(F.col("window.start")).alias("window_start_ms"),
            F.unix_millis(F.col("window.end")).alias("window_end_ms")]


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def _seconds(duration: str) -> int | None:
    """Length of a duration such as ``"5 seconds"``; None for other forms."""
    parts = duration.split()
    unit = _UNIT_SECONDS.get(parts[1].rstrip("s").lower()) if len(parts) == 2 else None
    return int(parts[0]) * unit if unit and parts[0].isdigit() else None


def _windowed_counts(df: DataFrame, by: list[str], time_ms: str, window: str, slide: str) -> DataFrame:
    """Events per group and sliding window.

    If the window is a whole number of slides, all events of a slide are in the same
    windows: they are counted per slide first, and only these counts go to several
    windows.  Otherwise every event goes to each of its windows.
    """
    w, s = _seconds(window), _seconds(slide)
    if not (w and s and w % s == 0):
        return (df.groupBy(*by, F.window(event_time(time_ms), window, slide))
                  .agg(F.count(F.lit(1)).alias("events")))
    slides = (df.groupBy(*by, F.window(event_time(time_ms), slide).alias("_slide"))
                .agg(F.count(F.lit(1)).alias("_n")))
    return (slides.groupBy(*by, F.window(F.col("_slide.start"), window, slide).alias("window"))
                  .agg(F.sum("_n").alias("events")))


def rate_sliding(df: DataFrame, by: str = "partition", time_ms: str = "timestamp",
                 window: str = RATE_WINDOW, slide: str = RATE_STEP,
                 window_seconds: int = RATE_WINDOW_SECONDS) -> DataFrame:
    """Events per second per group over sliding windows (count / window length).

    Plain count divided by the window length -- no extrapolation at the edges.
    """
    return (_windowed_counts(df, [by], time_ms, window, slide)
              .select(by, *_window_cols(window_seconds), "events",
                      (F.col("events") / F.lit(float(window_seconds))).alias("rate_per_sec")))


def rate_total(df: DataFrame, time_ms: str = "timestamp", window: str = RATE_WINDOW,
               slide: str = RATE_STEP, window_seconds: int = RATE_WINDOW_SECONDS) -> DataFrame:
    """Sum over groups of :func:`rate_sliding`: window counts without the group."""
    return (_windowed_counts(df, [], time_ms, window, slide)
              .select(*_window_cols(window_seconds), "events",
                      (F.col("events") / F.lit(float(window_seconds))).alias("rate_per_sec")))


def rate_sliding_stream(stream: DataFrame, by: str | None = "partition",
                        time_ms: str = "timestamp", window: str = RATE_WINDOW,
                        slide: str = RATE_STEP, window_seconds: int = RATE_WINDOW_SECONDS,
                        watermark: str = "1 minute") -> DataFrame:
    """Streaming form of :func:`rate_sliding` (``by=None`` gives :func:`rate_total`).

    If the window is a whole number of slides, two stateful operators follow each other under
    one watermark: the first counts events per slide, so that an event touches one state row,
    the second adds a slide's count, once the watermark has closed it, to its windows.
    Otherwise every event goes to each of its windows.

    The watermark bounds the state: a window is emitted once (append mode) when
    the watermark passes its end; rows whose slide (or window) the watermark has closed are
    dropped by Spark and counted in ``numRowsDroppedByWatermark`` of the
    query progress -- see ``streaming.runner.rows_dropped_by_watermark``.
    """
    keyed = stream.withColumn("_et", event_time(time_ms)).withWatermark("_et", watermark)
    by_cols = [by] if by else []
    w, s = _seconds(window), _seconds(slide)
    if w and s and w % s == 0 and w > s:
        slides = (keyed.groupBy(*by_cols, F.window("_et", slide).alias("_slide"))
                       .agg(F.count(F.lit(1)).alias("_n")))
        counts = (slides.groupBy(*by_cols, F.window(F.window_time("_slide"), window, slide).alias("window"))
                        .agg(F.sum("_n").alias("events")))
    else:
        counts = keyed.groupBy(*by_cols, F.window("_et", window, slide)).agg(F.count(F.lit(1)).alias("events"))
    return counts.select(*by_cols, *_window_cols(window_seconds), "events",
                         (F.col("events") / F.lit(float(window_seconds))).alias("rate_per_sec"))
