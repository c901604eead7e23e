"""Record codecs: JSON encode/decode with quarantine, log records, text lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

CORRUPT = "_corrupt"


def _cols(names) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def encode_json(*fields: str | Column) -> Column:
    """JSON text of the given fields, one property per field, nulls kept."""
    return F.to_json(F.struct(*_cols(fields)), {"ignoreNullFields": "false"})


def to_log_record(df: DataFrame, key: str = "accountId",
                  fields=("accountId", "timestamp", "amount"), keep=()) -> DataFrame:
    """Message-log shape: key = decimal text of ``key`` as bytes, value = JSON bytes."""
    return df.select(*_cols(keep),
                     F.col(key).cast("string").cast("binary").alias("key"),
                     encode_json(*fields).cast("binary").alias("value"))


BAD = "_bad"


def parse_json(df: DataFrame, schema: T.StructType, value: str = "value",
               keep=()) -> DataFrame:
    """One parse of JSON text: ``keep`` columns, the raw ``value``, the fields of
    ``schema`` and a boolean ``_bad`` flag (see :func:`decode_json`)."""
    text = F.col(value).cast("string")
    parse_schema = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    parsed_struct = F.from_json(text, parse_schema, {"mode": "PERMISSIVE",
                                                     "columnNameOfCorruptRecord": CORRUPT})
    # ``inline`` of a one-element array is a plan barrier: filters on the flag
    # cannot be pushed under it, which would inline the parser into the filter
    # and parse every record twice.
    parsed = df.select(*_cols(keep), text.alias(value), F.inline(F.array(parsed_struct)))
    bad = (F.col(CORRUPT).isNotNull() | F.col(value).isNull() | (F.trim(F.col(value)) == ""))
    return parsed.withColumn(BAD, bad).drop(CORRUPT)


def decode_json(df: DataFrame, schema: T.StructType, value: str = "value",
                keep=()) -> tuple[DataFrame, DataFrame]:
    """Decode JSON text into ``schema``; return ``(decoded, quarantine)``.

    A record is quarantined when Spark cannot parse it into the schema
    (malformed JSON, a wrong type in any field such as ``"x"`` or ``3.5`` for a
    BIGINT), or when it is empty.  Missing fields decode to null and unknown
    fields are ignored.  Both outputs come from one parse of the input; the
    caller can persist or ``foreachBatch`` over it to avoid a second parse.
    """
    parsed = parse_json(df, schema, value, keep)
    decoded = parsed.filter(~F.col(BAD)).select(*_cols(keep),
                                                *[F.col(f.name) for f in schema.fields])
    quarantine = parsed.filter(F.col(BAD)).select(*_cols(keep), F.col(value))
    return decoded, quarantine


def decode_log_value(df: DataFrame, schema: T.StructType, keep=()) -> DataFrame:
    """Value-only decode of a log frame (key and metadata dropped), strict types."""
    decoded, _ = decode_json(df, schema, "value", keep)
    return decoded


# The three line layouts of a row's text form.
TRANSACTION_LINE = "Transaction{accountId=%d, timestamp=%d, amount=%d}"
ENRICHED_LINE = ("EnrichedTransaction{accountId=%d, timestamp=%d, amount=%d, "
                 "transactionFee=%d}")
SEQUENCE_EVENT_LINE = "ChaosEvent(id=%d, timestamp=%d, payload=%s)"

_LINE_FIELDS = {
    "transaction": (TRANSACTION_LINE, ("accountId", "timestamp", "amount")),
    "enriched": (ENRICHED_LINE, ("accountId", "timestamp", "amount", "transactionFee")),
    "sequence_event": (SEQUENCE_EVENT_LINE, ("id", "timestamp", "payload")),
}


def row_to_line(kind: str) -> Column:
    """One text line per row in the record's text layout (``kind`` from _LINE_FIELDS)."""
    fmt, fields = _LINE_FIELDS[kind]
    # format_string renders a null %s as "null" (as the JVM string concat does)
    return F.format_string(fmt, *[F.col(f) for f in fields])


def parse_sequence_line(line: str | Column = "value") -> list[Column]:
    """Inverse of ``row_to_line("sequence_event")``: ``id``, ``timestamp``, ``payload``.

    Lines that do not have the layout give nulls (an audit then reports them).
    """
    line = F.col(line) if isinstance(line, str) else line
    pattern = r"^ChaosEvent\(id=(-?\d+), timestamp=(-?\d+), payload=(.*)\)$"
    ok = line.rlike(pattern)
    part = lambda i: F.when(ok, F.regexp_extract(line, pattern, i))
    return [part(1).cast("bigint").alias("id"), part(2).cast("bigint").alias("timestamp"),
            part(3).alias("payload")]
