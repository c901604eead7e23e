"""DuckDB twins of the registered queries (same column names, same values)."""

from __future__ import annotations

from txstream.plans import fixtures as fx
from txstream.plans.queries import RATE_SECONDS

TX = f"({fx.TX_SQL})"
CTX = f"({fx.CUSTOMER_TX_SQL})"
LAG = f"({fx.LAG_SQL})"
SEQ = f"({fx.SEQ_SQL})"
DELIVERED = f"({fx.DELIVERED_SQL})"
PART = fx.PART_SQL
MAIN = "coalesce(amount > 0, false)"
GEN_CLOCK = f"{fx.GENERATED_EPOCH_MS} + event_id * {fx.GENERATED_STEP_MS}"
SLIDE_MS, WINDOW_MS = 15 * 60 * 1000, RATE_SECONDS * 1000
QS = {"p50": 0.5, "p75": 0.75, "p95": 0.95, "p98": 0.98, "p99": 0.99, "p999": 0.999}

LAST_1000 = (f"(select * from {LAG} l qualify row_number() over "
             f"(partition by partition order by event_id desc) <= 1000)")

FIRST_DOCS = (f"select accountId as _id, amount, timestamp, cast(5 as bigint) as transactionFee "
              f"from {TX} t where {MAIN} qualify row_number() over "
              f"(partition by accountId order by timestamp, event_id) = 1")

CHAIN = (f"select 'document' as kind, accountId, timestamp, amount, "
         f"cast(5 as bigint) as transactionFee from {TX} t where {MAIN} "
         f"qualify row_number() over (partition by accountId order by timestamp, event_id) = 1 "
         f"union all select 'dead_letter' as kind, accountId, timestamp, amount, "
         f"cast(null as bigint) as transactionFee from {TX} t2 where not {MAIN}")

TX_LINE = ("'Transaction{accountId=' || accountId || ', timestamp=' || timestamp "
           "|| ', amount=' || amount || '}'")
ENRICHED_LINE = ("'EnrichedTransaction{accountId=' || accountId || ', timestamp=' || timestamp "
                 "|| ', amount=' || amount || ', transactionFee=5}'")
SEQ_LINE = "'ChaosEvent(id=' || id || ', timestamp=' || timestamp || ', payload=' || payload || ')'"


def _n_plus_1(q: float) -> str:
    pos = f"({q} * (len(s) + 1))"
    lo = f"cast(floor({pos}) as bigint)"
    return (f"case when len(s) = 0 then null when {pos} < 1 then s[1] "
            f"when {pos} >= len(s) then s[len(s)] "
            f"else s[{lo}] + ({pos} - {lo}) * (s[{lo} + 1] - s[{lo}]) end")


def _hist(method: str) -> str:
    common = ("partition, count(lag) as count, min(lag) as min, max(lag) as max, "
              "round(avg(lag), 6) as mean, round(stddev_samp(lag), 6) as stddev")
    if method == "linear":
        qs = ", ".join(f"round(quantile_cont(lag, {q}), 6) as {n}" for n, q in QS.items())
        return f"select {common}, {qs} from {LAST_1000} r group by partition"
    qs = ", ".join(f"round({_n_plus_1(q)}, 6) as {n}" for n, q in QS.items())
    return (f"select partition, count, min, max, mean, stddev, {qs} from "
            f"(select {common}, list_sort(list(cast(lag as double))) as s "
            f"from {LAST_1000} r group by partition) h")


def _rate(by_partition: bool, slide_ms: int) -> str:
    n = WINDOW_MS // slide_ms
    p = "partition, " if by_partition else ""
    start = f"(t // {slide_ms} - k) * {slide_ms}"
    return (f"select {p}{start} as window_start_ms, {start} + {WINDOW_MS} as window_end_ms, "
            f"count(*) as events, round(count(*) / {float(RATE_SECONDS)}, 6) as rate_per_sec "
            f"from (select timestamp as t, {PART} as partition from {TX} x) e "
            f"cross join range({n}) r(k) group by all")


ORACLE: dict[str, str] = {
    "gen_transactions": f"select event_id as accountId, {GEN_CLOCK} as timestamp, "
                        f"event_id % 10 as amount from events",
    "gen_payload_events": f"select cast(event_id as varchar) as id, {GEN_CLOCK} as timestamp, "
                          f"repeat('*', 100) as payload from events",
    "gen_sequence_events": f"select event_id as id, {GEN_CLOCK} as timestamp, "
                           f"cast(event_id as varchar) as payload from events",
    "route_positive": f"select * from {TX} t where {MAIN}",
    "route_dead_letter": f"select * from {TX} t where not {MAIN}",
    "route_dead_letter_negative": f"select * from {CTX} t where not {MAIN}",
    "enrich_fee": f"select *, cast(5 as bigint) as transactionFee from {TX} t where {MAIN}",
    "document_projection": f"select accountId as _id, amount, timestamp, "
                           f"cast(5 as bigint) as transactionFee from {TX} t where {MAIN}",
    "split_counts": f"select partition, count(*) as n_in, count(*) filter (where {MAIN}) as n_main, "
                    f"count(*) filter (where not {MAIN}) as n_dead "
                    f"from (select *, {PART} as partition from {TX} t) p group by partition",
    "exact_duplicates": f"select accountId, timestamp, amount, count(*) as copies from "
                        f"(select * from {TX} a union all select * from {TX} b "
                        f"where event_id % 10 = 0) u group by accountId, timestamp, amount "
                        f"having count(*) > 1",
    "json_encode": f"select event_id, cast(accountId as varchar) as key, "
                   f"'{{\"accountId\":' || accountId || ',\"timestamp\":' || timestamp || "
                   f"',\"amount\":' || amount || '}}' as value from {TX} t",
    "json_round_trip": f"select * from {TX} t",
    "decode_ok": f"select * from {TX} t where event_id % {fx.CORRUPT_EVERY} <> 0",
    "decode_quarantine": f"select event_id, '{fx.CORRUPT_TEXT}' as value from events "
                         f"where event_id % {fx.CORRUPT_EVERY} = 0",
    "row_to_line": f"select event_id, 'transaction' as kind, {TX_LINE} as line from {TX} a "
                   f"union all select event_id, 'enriched' as kind, {ENRICHED_LINE} as line "
                   f"from {TX} b union all select id as event_id, 'sequence_event' as kind, "
                   f"{SEQ_LINE} as line from {SEQ} c",
    "keyed_order": f"select event_id, accountId, timestamp, row_number() over "
                   f"(partition by accountId order by timestamp, event_id) as seq from {TX} t",
    "keyed_order_streamed": f"select event_id, accountId, timestamp, row_number() over "
                            f"(partition by accountId order by timestamp, event_id) as seq "
                            f"from {TX} t",
    "topic_partition_counts": f"select {PART} as partition, count(*) as records, "
                              f"count(distinct accountId) as keys from {TX} t group by 1",
    "topic_round_trip": f"select *, {PART} as partition from {TX} t",
    "topic_scan_all": f"select *, {PART} as partition from {TX} t",
    "topic_scan_latest": f"select *, {PART} as partition from {CTX} t",
    "log_scan_earliest": f"select * from {TX} t",
    "document_insert_once": FIRST_DOCS,
    "document_first_per_account": FIRST_DOCS,
    "chain_end_to_end": CHAIN,
    "restart_no_reprocess": CHAIN,
    "chain_small_batches_compacted": CHAIN,
    "bucketed_text_lines": f"select strftime(ts, '%Y-%m-%d--%H') as bucket, "
                           f"'ChaosEvent(id=' || event_id || ', timestamp=' || "
                           f"(epoch_us(ts) // 1000) || ', payload=' || event_id || ')' as line "
                           f"from events",
    "event_counter": f"select partition, count(*) as events from {LAG} l group by partition",
    "event_counter_observed": "select count(*) as events from events",
    "lag_histogram": _hist("linear"),
    "lag_histogram_n_plus_1": _hist("n_plus_1"),
    "lag_histogram_streamed": _hist("linear"),
    "lag_p99": f"select partition, round(quantile_cont(lag, 0.99), 6) as p99 "
               f"from {LAST_1000} r group by partition",
    "lag_p99_avg": f"select round(avg(p99), 6) as avg_p99, count(*) as groups from "
                   f"(select partition, quantile_cont(lag, 0.99) as p99 from {LAST_1000} r "
                   f"group by partition) p",
    "lag_rolling_p99": f"select event_id, partition, lag, round(quantile_cont(lag, 0.99) over "
                       f"(partition by partition order by event_id rows between 999 preceding "
                       f"and current row), 6) as rolling_p99 from {LAG} l",
    "rate_sliding": _rate(True, SLIDE_MS),
    "rate_tumbling": _rate(True, WINDOW_MS),
    "rate_total": _rate(False, SLIDE_MS),
    "rate_sliding_streamed": f"select * from ({_rate(True, SLIDE_MS)}) w where window_end_ms <= "
                             f"(select max(epoch_us(ts) // 1000) from events)",
    "load_feedback": f"select {fx.partition_of_sql('cast(event_id as varchar)', fx.TOPIC_PARTITIONS)} "
                     f"as partition, count(*) as events from events group by 1",
    "recovery_audit": "select count(*) as produced, count(*) as delivered, cast(0 as bigint) as "
                      "missing, cast(0 as bigint) as duplicated, cast(0 as bigint) as altered "
                      "from events",
    "audit_missing": f"select id from {SEQ} s where not exists "
                     f"(select 1 from {DELIVERED} d where d.id = s.id)",
    "audit_duplicates": f"select id, count(*) as copies from {DELIVERED} d group by id "
                        f"having count(*) > 1",
    "audit_gaps": f"select id + 1 as gap_start, nxt - 1 as gap_end, nxt - id - 1 as missing from "
                  f"(select id, lead(id) over (order by id) as nxt from "
                  f"(select distinct id from {DELIVERED} d) u) g where nxt - id > 1",
    "audit_payload": f"select * from {DELIVERED} d where payload is distinct from "
                     f"cast(id as varchar)",
}

# faulty records: every 97th cannot be decoded, every 11th has no account (account 0)
_GOOD = (f"(select case when event_id % 11 = 0 then 0 else accountId end as accountId, amount "
         f"from {TX} t where event_id % {fx.CORRUPT_EVERY} <> 0)")
ORACLE["chain_conservation"] = (
    f"select (select count(*) from {TX} t) as log, (select count(*) from {_GOOD} g) as topic, "
    f"(select count(*) from {TX} t where event_id % {fx.CORRUPT_EVERY} = 0) as quarantine, "
    f"(select count(distinct accountId) from {_GOOD} g where {MAIN}) as documents, "
    f"(select count(*) - count(distinct accountId) from {_GOOD} g where {MAIN}) as duplicates, "
    f"(select count(*) from {_GOOD} g where not {MAIN}) as dead_letters, "
    f"cast(0 as bigint) as lost_in_topic, cast(0 as bigint) as lost_in_stores")
ORACLE["lag_over_timestamps"] = (
    f"select event_id, timestamp + (event_id * {fx.LAG_FACTOR}) % {fx.LAG_MOD} as processed_at, "
    f"timestamp, (event_id * {fx.LAG_FACTOR}) % {fx.LAG_MOD} as lag_ms from {TX} t")

ORACLE["document_store_levels"] = FIRST_DOCS
ORACLE["keyed_order_continued"] = ORACLE["keyed_order"]
ORACLE["rate_total_streamed"] = (f"select * from ({_rate(False, SLIDE_MS)}) w where window_end_ms <= "
                                 f"(select max(epoch_us(ts) // 1000) from events)")
ORACLE["lag_sketch_p99"] = (
    f"select partition, timestamp // 86400000 * 86400000 as window_start_ms, count(*) as samples, "
    f"count(*) as n, true as within from {LAG} l group by all")
ORACLE["epoch_sink_round_trip"] = f"select * from {TX} t"
ORACLE["epoch_sink_counted"] = "select count(*) as events, cast(0 as bigint) as files from events"
ORACLE["audit_gaps_incremental"] = ORACLE["audit_gaps"]
ORACLE["audit_missing_ranges"] = (
    f"select min(id) as first, max(id) as last, count(*) as missing from "
    f"(select id, id - row_number() over (order by id) as g from {SEQ} s where not exists "
    f"(select 1 from {DELIVERED} d where d.id = s.id)) m group by g")
ORACLE["topic_scan_epochs_latest"] = f"select * from {CTX} t"
ORACLE["topic_group_lag"] = (
    f"select partition, count(*) as records, count(*) filter (where old) as finished, "
    f"count(*) filter (where not old) as lag from (select {PART} as partition, true as old from {TX} a "
    f"union all select {PART} as partition, false as old from {CTX} b) u group by partition")
ORACLE["text_rolling_lines"] = ORACLE["bucketed_text_lines"]
ORACLE["delivered_once"] = f"select distinct id, timestamp, payload from {DELIVERED} d"
ORACLE["wall_clock"] = ("select count(*) as events, cast(1 as bigint) as clocks, count(*) as not_before, "
                        "count(*) as behind_events from events")
