"""Write PLANS.md: the executed physical plan shape of every registered query.

    python tools/plan_report.py [sf_dir]

Each query is run once (``noop`` sink) so that adaptive plans are final; the
report lists shuffles, join strategies, aggregates, windows, Python stages and
what reached the Parquet scans.  Queries that run a stream or write tables first
return a read of what was written; the plans of their micro-batches and writes
come from Spark's event log and are listed in the last column.
"""

from __future__ import annotations

import json
import re
import sys
import tempfile
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from txstream.plans.queries import QUERIES  # noqa: E402
from txstream.session import get_session  # noqa: E402

STREAMED = {"topic_round_trip", "topic_scan_all", "topic_scan_latest", "log_scan_earliest",
            "chain_end_to_end", "restart_no_reprocess", "bucketed_text_lines",
            "rate_sliding_streamed", "load_feedback", "lag_histogram_streamed", "recovery_audit",
            "chain_small_batches_compacted", "keyed_order_streamed", "event_counter_observed",
            "chain_conservation"}
WRITTEN = {"topic_partition_counts", "document_insert_once", "keyed_order", "lag_rolling_p99"}
NODES = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition",
         "Exchange RoundRobinPartitioning", "BroadcastExchange", "BroadcastHashJoin",
         "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct",
         "HashAggregate", "ObjectHashAggregate", "SortAggregate", "WindowGroupLimit", "Window",
         "Expand", "Generate", "MapInArrow", "MapInPandas", "FlatMapGroupsInPandas", "ArrowEvalPython",
         "BatchEvalPython", "AQEShuffleRead"]


def shape(plan: str) -> str:
    c = Counter()
    for line in plan.splitlines():
        body = re.sub(r"^[\s:+\-*()\d]*", "", line)
        for n in NODES:
            if body == n or body[len(n):len(n) + 1] in (" ", "(", "[", ",") \
                    and body.startswith(n):
                c[n] += 1
                break
    return ", ".join(f"{n} ×{k}" if k > 1 else n for n, k in c.items()) or "scan/project only"


def scans(plan: str) -> str:
    out = []
    for m in re.finditer(r"FileScan parquet \[[^\]]*\][^\n]*?Location: \w+\(\d+ paths\)\[([^\]]*)\]"
                         r"[^\n]*?PushedFilters: \[([^\]]*)\][^\n]*?ReadSchema: struct<([^>]*)>",
                         plan):
        first = m.group(1).split(",")[0].strip().rstrip("/").rstrip(".")
        where = re.sub(r"-[0-9a-f]{12}$", "", first.split("/")[-1])
        cols = len(m.group(3).split(",")) if m.group(3) else 0
        pushed = m.group(2) or "none"
        out.append(f"{where}: {cols} col(s), pushed: {pushed}")
    return re.sub(r"#\d+", "", "; ".join(dict.fromkeys(out))) or "–"


def logged_shapes(folder: str, spans: list[tuple[str, float, float]]) -> dict[str, str]:
    """Per query, the nodes of all plans that ran in its time span, and how many plans."""
    began, plans = {}, {}
    for path in Path(folder).iterdir():
        for line in path.open(errors="replace"):
            if "sparkPlanInfo" in line:
                e = json.loads(line)
                began.setdefault(e["executionId"], e.get("time", 0) / 1000)
                plans[e["executionId"]] = e["sparkPlanInfo"]      # the last one is final

    def nodes(info):
        yield info["simpleString"]
        for child in info["children"]:
            yield from nodes(child)

    out = {}
    for name, start, end in spans:
        mine = [p for k, p in plans.items() if start <= began[k] <= end]
        out[name] = f"{len(mine)} plans: {shape(chr(10).join(x for p in mine for x in nodes(p)))}"
    return out


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    log = tempfile.mkdtemp(prefix="plan-report-")
    spark = get_session(conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log}",
                              "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})
    rows, spans = [], []
    for name, fn in QUERIES.items():
        start = time.time()
        df = fn(spark, sf)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        final = re.sub(r"AdaptiveSparkPlan isFinalPlan=\w+", "", plan)
        kind = ("stream, then read" if name in STREAMED else
                "tables written, then read" if name in WRITTEN else "batch")
        spans.append((name, start, time.time()))
        rows.append((name, kind, f"| `{name}` | {kind} | {shape(final)} | {scans(final)} |"))
    spark.stop()      # completes the event log
    logged = logged_shapes(log, spans)
    rows = [f"{row} {logged[name] if kind != 'batch' else '–'} |" for name, kind, row in rows]
    text = ["# Physical plans of the registered queries",
            "",
            f"Generated by `tools/plan_report.py` on `{sf}` (local mode, AQE on). "
            "Counts are per executed plan; \"pushed\" lists the filters that reached the Parquet "
            "reader, and the column count is the pruned read schema.",
            "",
            "| query | kind | operators | scans | all plans of micro-batches and written tables |",
            "|---|---|---|---|---|", *rows, ""]
    Path(__file__).resolve().parents[1].joinpath("PLANS.md").write_text("\n".join(text))


if __name__ == "__main__":
    main()
