"""Fixed record schemas.  Never inferred from data."""

from pyspark.sql import types as T

L = T.LongType()
S = T.StringType()

TRANSACTION = T.StructType([
    T.StructField("accountId", L),
    T.StructField("timestamp", L),
    T.StructField("amount", L),
])

ENRICHED = T.StructType(TRANSACTION.fields + [T.StructField("transactionFee", L)])

SEQUENCE_EVENT = T.StructType([
    T.StructField("id", L),
    T.StructField("timestamp", L),
    T.StructField("payload", S),
])

PAYLOAD_EVENT = T.StructType([
    T.StructField("id", S),
    T.StructField("timestamp", L),
    T.StructField("payload", S),
])

LOG_RECORD = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
])

DOCUMENT = T.StructType([
    T.StructField("_id", L),
    T.StructField("amount", L),
    T.StructField("timestamp", L),
    T.StructField("transactionFee", L),
])

QUARANTINE = T.StructType([
    T.StructField("event_id", L),
    T.StructField("value", S),
])


def with_fields(schema: T.StructType, *extra: T.StructField) -> T.StructType:
    return T.StructType(list(schema.fields) + list(extra))
