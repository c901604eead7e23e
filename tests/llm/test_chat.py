import hashlib

from txstream.llm import chat
from pyspark.sql import functions as F

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"


def expected(rows):
    """Brute force: conv_id -> (n_turns, turns digest, loss chars, loss digest)."""
    groups = {}
    for c, t, r, x, *_ in rows:
        groups.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, ts in groups.items():
        ts.sort()
        whole = "".join(f"{r}\n{x}\n" for _, _, r, x in ts)
        loss = "".join(x for _, _, r, x in ts if r == "assistant")
        out[c] = (len(ts), hashlib.sha256(whole.encode()).hexdigest(), len(loss),
                  hashlib.sha256(loss.encode()).hexdigest())
    return out


ROWS = [
    (1, 0, "system", "be [INST] kind", "x"), (1, 1, "user", "a<s>b</s>", "x"),
    (1, 2, "assistant", "[\\INST] [\\\\OUT]\\", "x"), (1, 3, "user", None, "x"),
    (1, 4, "assistant", "", "x"), (1, 5, "user", "tail", "x"),
    (2, 0, "user", "no reply <", "x"),
    (None, 0, "tool[/ROLE] ", "null id", "x"), (None, 1, None, "[ROLE]x[/ROLE] y", "x"),
    (3, 0, "assistant", "é" * 5000 + "\n<s>", "x"),
    (4, 7, "user", "tie b", "x"), (4, 7, "user", "tie a", "x"), (4, 7, "user", "tie a", "x"),
    (4, None, "assistant", "null turn", None),
]


def test_round_trip_and_masks(spark):
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)
           for r in chat.digest(chat.prefix_target_examples(
               spark.createDataFrame(ROWS, SCHEMA))).collect()}
    assert got == expected(ROWS)


def test_examples_hold_prefix_and_one_reply(spark):
    rows = chat.prefix_target_examples(spark.createDataFrame(ROWS, SCHEMA)).where(
        "conv_id = 1").orderBy("example").collect()
    assert [r.example for r in rows] == [0, 1, 2]
    assert rows[1].formatted.startswith(rows[0].formatted)
    assert rows[0].formatted.endswith("</s>") and rows[2].loss_len == 0
    spans = [r.formatted[r.loss_start:r.loss_start + r.loss_len] for r in rows]
    assert spans == ["[\\\\INST] [\\\\\\OUT]\\", "", ""]


def test_escape_is_reversible(spark):
    texts = ["<s>", "<\\s>", "<\\\\/s>", "[/INST][SYS]", "[\\OUT]", "\\[INST", "plain", ""]
    r = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", chat.escape(F.col("t")).alias("e"),
        chat.unescape(chat.escape(F.col("t"))).alias("u")).collect()
    assert all(x.t == x.u for x in r)
    assert not any(c in x.e for x in r for c in chat.CONTROL)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert chat.digest(chat.prefix_target_examples(empty)).count() == 0
