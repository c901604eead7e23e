"""Chat formatting by prefix-target expansion, with DataFrame functions only.

Every assistant turn becomes an example of its own: the text is all turns before
it plus the reply, and only the reply carries the loss.  Turns after the last
reply (or a conversation without one) become a last, context-only example with an
empty loss span, so that no turn is lost.

Template, one line of rules:  ``<s>`` header text trailer ``</s>`` per turn, where
system is ``[SYS] text [/SYS]``, user ``[INST] text [/INST]``, assistant
``[OUT] text`` and any other role ``[ROLE]role[/ROLE] text``.  A control string
inside a text or role gets one backslash after its bracket (``[INST]`` ->
``[\\INST]``, ``[\\INST]`` -> ``[\\\\INST]``), which ``unescape`` takes away again;
escaped text therefore holds no control string and the format is reversible.

Defined results: a null text or role is the empty string; a null conv_id is a
conversation of its own; rows of equal turn are ordered by role, then text, and
repeated rows are repeated turns; null turns come first; an empty table gives no
row; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The control strings of the template.
CONTROL = ["<s>", "</s>", "[SYS]", "[/SYS]", "[INST]", "[/INST]", "[OUT]", "[ROLE]", "[/ROLE]"]

_NAMES = "(/?s>|/?SYS\\]|/?INST\\]|OUT\\]|/?ROLE\\])"
_ESCAPE = r"([<\[])(\\*)" + _NAMES
_UNESCAPE = r"([<\[])\\(\\*)" + _NAMES


def escape(text: Column) -> Column:
    """Add one backslash inside every (already escaped or plain) control string."""
    return F.regexp_replace(text, _ESCAPE, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    """Inverse of ``escape``."""
    return F.regexp_replace(text, _UNESCAPE, r"$1$2$3")


def _head(role: Column) -> Column:
    return (F.when(role == "system", "<s>[SYS] ").when(role == "user", "<s>[INST] ")
            .when(role == "assistant", "<s>[OUT] ")
            .otherwise(F.concat(F.lit("<s>[ROLE]"), escape(role), F.lit("[/ROLE] "))))


def _tail(role: Column) -> Column:
    return (F.when(role == "system", " [/SYS]</s>").when(role == "user", " [/INST]</s>")
            .otherwise("</s>"))


def prefix_target_examples(conversations: DataFrame) -> DataFrame:
    """One row per example: conv_id, example (0, 1, ..), formatted, loss_start, loss_len.

    ``formatted[loss_start : loss_start + loss_len]`` (code points from 0) is the
    escaped reply.  One shuffle by conversation; the expansion happens after it.
    """
    role = F.coalesce(F.col("role"), F.lit(""))
    body = escape(F.coalesce(F.col("text"), F.lit("")))
    turns = conversations.select(
        "conv_id", "turn", role.alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
        _head(role).alias("head"), F.concat(body, _tail(role)).alias("rest"),
        F.length(body).alias("n_body"))
    grouped = (turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "turn", "role", "text", "head", "rest", "n_body"))).alias("t")))
    piece = grouped.select(
        "conv_id",
        F.expr("transform(t, x -> concat(x.head, x.rest))").alias("pieces"),
        F.expr("transform(t, x -> struct(x.role = 'assistant' AS reply, length(x.head) AS n_head,"
               " x.n_body AS n_body, length(x.head) + length(x.rest) AS n_all))").alias("m"))
    # start of every turn: running sum of the piece lengths, one pass over the turns
    placed = piece.withColumn("starts", F.expr(
        "aggregate(m, array(0), (acc, x) -> concat(acc, array(element_at(acc, -1) + x.n_all)))"))
    last = F.expr("size(m) - 1")
    cuts = placed.withColumn("ends", F.expr(
        "filter(sequence(0, size(m) - 1), i -> m[i].reply or i = size(m) - 1)"))
    return (cuts.select("conv_id", "pieces", "m", "starts", last.alias("last"),
                        F.posexplode("ends").alias("example", "i"))
            .select("conv_id", F.col("example").cast("long").alias("example"),
                    F.expr("array_join(slice(pieces, 1, i + 1), '')").alias("formatted"),
                    F.expr("CASE WHEN m[i].reply THEN starts[i] + m[i].n_head"
                           " ELSE starts[i + 1] END").cast("long").alias("loss_start"),
                    F.expr("CASE WHEN m[i].reply THEN m[i].n_body ELSE 0 END")
                    .cast("long").alias("loss_len")))


# Parses one piece; the numbers are the lengths of the fixed strings around the text.
_PARSE = ("CASE"
          " WHEN startswith(x, '[SYS] ') THEN struct('system' AS role,"
          " substring(x, 7, length(x) - 17) AS text)"
          " WHEN startswith(x, '[INST] ') THEN struct('user' AS role,"
          " substring(x, 8, length(x) - 19) AS text)"
          " WHEN startswith(x, '[OUT] ') THEN struct('assistant' AS role,"
          " substring(x, 7, length(x) - 10) AS text)"
          " ELSE struct(substring(x, 7, locate('[/ROLE] ', x) - 7) AS role,"
          " substring(x, locate('[/ROLE] ', x) + 8,"
          " length(x) - locate('[/ROLE] ', x) - 11) AS text) END")


def turns_of(examples: DataFrame, column: str = "formatted") -> DataFrame:
    """Add ``turns`` (array of role, text): a formatted column read back, unescaped."""
    raw = examples.withColumn("_raw", F.expr(
        f"transform(split(substr(`{column}`, 4), '<s>'), x -> {_PARSE})"))
    return raw.withColumn("turns", F.transform("_raw", lambda x: F.struct(
        unescape(x["role"]).alias("role"), unescape(x["text"]).alias("text")))).drop("_raw")


def digest(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from its examples: turn and loss digests.

    The last example holds every turn; the loss spans of all examples in order hold
    each reply once.  Grouping by conv_id reuses the examples' partitioning.
    """
    loss = unescape(F.expr("substring(formatted, cast(loss_start + 1 as int), cast(loss_len as int))"))
    e = examples.select("conv_id", "example", loss.alias("loss"),
                        F.length("formatted").alias("n"), "formatted")
    per = e.groupBy("conv_id").agg(
        F.expr("max_by(formatted, example)").alias("formatted"),
        F.sort_array(F.collect_list(F.struct("example", "loss"))).alias("losses"),
        F.sum("n").cast("long").alias("formatted_chars"),
        F.count(F.lit(1)).cast("long").alias("n_examples"))
    back = turns_of(per)
    whole = F.expr("array_join(transform(turns, x -> concat(x.role, '\\n', x.text, '\\n')), '')")
    target = F.expr("array_join(transform(losses, x -> x.loss), '')")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length(target).cast("long").alias("loss_chars"),
        F.sha2(target, 256).alias("loss_sha256"),
        "formatted_chars", "n_examples")
