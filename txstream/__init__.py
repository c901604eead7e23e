"""txstream: transaction and event-stream operators as plain Spark DataFrame transforms.

Every transform takes and returns a DataFrame and works unchanged on batch and
Structured Streaming input; sources and sinks are the only places where the
connector (Parquet topic table, file-backed log, ``kafka``) is chosen.
"""

from txstream.functions.codec import decode_json, encode_json, row_to_line, to_log_record
from txstream.functions.partitioning import partition_of
from txstream.operators.audit import audit_duplicates, audit_gaps, audit_missing, audit_payload
from txstream.operators.documents import compact, first_per_key, insert_once, read_documents
from txstream.operators.enrich import enrich_fee, exact_duplicates, to_document
from txstream.operators.metrics import (event_counter, lag_histogram, lag_p99, lag_p99_avg,
                                        last_n, observe_counter, rate_sliding,
                                        rate_sliding_stream, rate_total, rolling_quantile)
from txstream.operators.ordering import keyed_order, keyed_positions
from txstream.operators.routing import route, split_counts
from txstream.plans.chain import run_chain, start_chain
from txstream.session import checkpoint_root, cleanup_scratch, get_session, scratch_path

__all__ = [
    "audit_duplicates", "audit_gaps", "audit_missing", "audit_payload", "checkpoint_root",
    "cleanup_scratch", "compact", "decode_json", "encode_json", "enrich_fee", "event_counter",
    "exact_duplicates", "first_per_key", "get_session", "insert_once", "keyed_order",
    "keyed_positions", "lag_histogram", "lag_p99", "lag_p99_avg", "last_n", "observe_counter",
    "partition_of", "rate_sliding", "rate_sliding_stream", "rate_total", "read_documents",
    "rolling_quantile", "route", "row_to_line", "run_chain", "scratch_path", "split_counts",
    "start_chain", "to_document", "to_log_record",
]
