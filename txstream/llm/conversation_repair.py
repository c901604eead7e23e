"""Cheapest repair of conversations by a suffix-shared automaton of their signatures.

A conversation's rows, ordered by turn, become a signature: one letter a row for its role's
initial and its fault.  ``S U A O`` are rows of system, user, assistant and other roles,
``s u a o`` the same ones truncated, ``x`` rows that must go (blank or repeated).  Equal
conversations have one signature, and signatures that end alike share their ends: sorted
from the end, each one shares a path with its neighbour, and a node (one distinct ending)
is entered once.  A node holds, for each of the four states of the grammar
``(s?(ua)+)?``, the cost to reach the end and the edits of its first row on the best way;
both follow from the node behind it, and nodes of equal relative costs share that
step.  The audit of a whole signature is read off by following the nodes.

Edits: K keeps a row (0), R gives it the role user or assistant (3), D deletes it (4), I
inserts an empty user or assistant row (3); a truncated row that stays costs 3 more.  Of
equally cheap repairs the one whose letters are least in ASCII is taken; at every place
the options begin with different letters, so this is decided there.

On Spark: rows are shuffled by conversation and streamed in order, so that a task holds a
letter a row of one conversation and never its texts; distinct signatures are range
partitioned from their ends, so a node is computed once but for those on the paths between
two ranges.  The repaired rows are streamed in the same way.

Defined results: null role and text are one space, null turns come first, rows of equal
turn stand by role, then text; a null conv_id is one conversation; a text without
characters but white space is blank, a row whose role and text occurred earlier in the
conversation is repeated, one whose last visible character is not one of ``.!?`` is
truncated (the first of these counts); conversations without rows need no repair; an empty
table gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from txstream.session import materialize

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)           # the grammar's states, by the last row
NAMES = {USER: "user", ASSISTANT: "assistant"}
WHITE = " \t\n\x0b\x0c\r"
NEXT = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}     # of R and I
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER},
        "a": {USER: ASSISTANT}, "o": {}}
PLAN = "signature string, cost long, audit string"
SIGNATURE = ("conv_id {id}, signature string, gaps long, blank long, duplicate long, truncated long,"
             " illegal long")


class Node:
    """Costs to the end from the four states, and per state the first row's edits and the
    state after them; at the end, the rows to insert."""

    __slots__ = ("costs", "moves", "after")

    def __init__(self, costs, moves):
        self.costs, self.moves, self.after = costs, moves, {}


def end_node() -> Node:
    """Behind the last row: a started pair is completed."""
    return Node((0, 2 * INSERT, INSERT, 0), (("", START), ("II", ASSISTANT), ("I", ASSISTANT), ("", ASSISTANT)))


def before(node: Node, letter: str) -> tuple[Node, int]:
    """The node one row earlier; costs are kept relative to the least, which is returned."""
    if letter not in node.after:
        extra = TRUNCATED if letter in "suao" else 0
        role = letter.lower()

        def first_edit(state):
            options = [(DELETE + node.costs[state], "D", state)]
            if letter != "x":
                to = KEPT[role].get(state)
                if to is not None:
                    options.append((KEEP + extra + node.costs[to], "K", to))
                to = NEXT[state]
                options.append((REROLE + extra + node.costs[to], "R", to))
            return min(options)

        best = []
        for state in range(4):
            options, at = [], state
            for n in range(4):           # inserted rows before this one
                cost, edit, to = first_edit(at)
                options.append((n * INSERT + cost, "I" * n + edit, to))
                at = NEXT[at]
            best.append(min(options))
        least = min(b[0] for b in best)
        costs = tuple(b[0] - least for b in best)
        node.after[letter] = Node(costs, tuple(b[1:] for b in best)), least
    return node.after[letter]


def shared(nodes: dict, node: Node) -> Node:
    """The one node of these costs and moves."""
    return nodes.setdefault((node.costs, node.moves), node)


def audits(backwards: Iterator[str]):
    """(cost, audit) of every signature; these come sorted and written from the end."""
    nodes: dict = {}
    path, spent, last = [shared(nodes, end_node())], [0], ""
    for text in backwards:
        common = 0
        for a, b in zip(text, last):
            if a != b:
                break
            common += 1
        del path[common + 1:], spent[common + 1:]
        for letter in text[common:]:
            node, cost = before(path[-1], letter)
            node = shared(nodes, node)
            path[-1].after[letter] = node, cost
            path.append(node)
            spent.append(spent[-1] + cost)
        last = text
        state, edits = START, []
        for node in reversed(path):
            more, state = node.moves[state]
            edits.append(more)
        yield spent[-1] + path[-1].costs[START], "".join(edits)


def _audit_stage(batches):
    """Arrow stage: sorted signatures from their ends -> signature, cost, audit."""
    def texts():
        for b in batches:
            yield from b.column("backwards").to_pylist()

    rows, seen = [], []

    def remembered():
        for t in texts():
            seen.append(t[::-1])
            yield t

    def out():
        got = pa.RecordBatch.from_arrays(
            [pa.array(seen), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows])],
            names=["signature", "cost", "audit"])
        rows.clear()
        seen.clear()
        return got

    size = 0
    for r in audits(remembered()):
        rows.append(r)
        size += len(r[1])
        if size > 1 << 20:
            yield out()
            size = 0
    if rows:
        yield out()


def _runs(ids: list) -> list[tuple[int, int]]:
    """Ranges of equal neighbouring ids."""
    cut = [0, *(i for i in range(1, len(ids)) if ids[i] != ids[i - 1]), len(ids)]
    return [(a, b) for a, b in zip(cut, cut[1:]) if b > a]


LETTERS = np.frombuffer(b"OSUAosua", np.uint8)      # role code, and 4 more if truncated
LEGAL = np.zeros((4, 4), bool)
LEGAL[[1, 2, 3], [2, 3, 2]] = True                  # su, ua, au


def _signature_stage(id_type):
    """Arrow stage: conv_id, turn, role (0 other, 1 s, 2 u, 3 a), fault (0 none, 1 blank,
    2 duplicate, 3 truncated), sorted -> a row a conversation."""

    def run(batches):
        open_, done = None, []

        def emit():
            if not done:
                return
            cols = list(zip(*done))
            done.clear()
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], id_type), pa.array(cols[1]), *(pa.array(c, pa.int64()) for c in cols[2:])],
                names=["conv_id", "signature", "gaps", "blank", "duplicate", "truncated", "illegal"])

        def close():
            c = open_
            done.append((c["id"], b"".join(c["letters"]).decode(),
                         c["max"] - c["min"] + 1 - c["turns"] if c["turns"] else 0,
                         *c["faults"], c["illegal"]))

        for b in batches:
            ids = b.column("conv_id").to_pylist()
            turn = b.column("turn")
            has = np.asarray(turn.is_valid().to_numpy(zero_copy_only=False), bool)
            turn = turn.fill_null(0).to_numpy(zero_copy_only=False)
            role = np.asarray(b.column("role"), np.int64)
            fault = np.asarray(b.column("fault"), np.int64)
            letters = np.where((fault == 1) | (fault == 2), ord("x"), LETTERS[role + 4 * (fault == 3)])
            letters = letters.astype(np.uint8)
            for i, j in _runs(ids):
                if open_ is None or open_["id"] != ids[i]:
                    if open_ is not None:
                        close()
                    open_ = {"id": ids[i], "letters": [], "turns": 0, "min": 0, "max": 0,
                             "faults": [0, 0, 0], "illegal": 0, "role": None}
                c = open_
                c["letters"].append(letters[i:j].tobytes())
                for k in range(3):
                    c["faults"][k] += int((fault[i:j] == k + 1).sum())
                r = role[i:j]
                c["illegal"] += int((~LEGAL[r[:-1], r[1:]]).sum())
                if c["role"] is not None:
                    c["illegal"] += int(not LEGAL[c["role"], r[0]])
                c["role"] = int(r[-1])
                t = turn[i:j][has[i:j]]
                if len(t):
                    new = 1 + int((t[1:] != t[:-1]).sum())
                    if c["turns"] == 0:
                        c["min"] = int(t[0])
                    elif c["max"] == int(t[0]):
                        new -= 1
                    c["turns"] += new
                    c["max"] = int(t[-1])
            yield from emit()
        if open_ is not None:
            close()
            yield from emit()

    return run


def normalised(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text; null roles and texts are one space."""
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"),
                       F.coalesce("role", F.lit(" ")).alias("role"),
                       F.coalesce("text", F.lit(" ")).alias("text"))


def signatures(rows: DataFrame) -> DataFrame:
    """Per conversation: conv_id, signature, gaps, blank, duplicate, truncated, illegal."""
    seen = Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    shown = F.rtrim("text", F.lit(WHITE))
    initial = F.substring("role", 1, 1)
    fault = (F.when(shown == "", 1).when(F.col("nth") > 1, 2)
             .when(~F.substring(shown, -1, 1).isin(".", "!", "?"), 3).otherwise(0))
    code = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(0)
    marked = (normalised(rows).repartition("conv_id")       # the window keeps this partitioning
              .withColumn("nth", F.row_number().over(seen))
              .sortWithinPartitions("conv_id", "turn", "role", "text")
              .select("conv_id", "turn", code.alias("role"), fault.alias("fault")))
    kind = rows.schema["conv_id"].dataType
    return marked.mapInArrow(_signature_stage(to_arrow_type(kind)),
                             SIGNATURE.format(id=kind.simpleString()))


def plans(found: DataFrame) -> DataFrame:
    """cost and audit of every conversation, beside the columns of :func:`signatures`."""
    distinct = found.select(F.reverse("signature").alias("backwards")).distinct()
    best = (distinct.repartitionByRange("backwards").sortWithinPartitions("backwards")
            .mapInArrow(_audit_stage, PLAN))
    return found.join(best, "signature")


def _repair_stage(id_type):
    """Arrow stage: per conversation its audit (kind 0), then its rows -> the repaired rows."""

    def run(batches):
        ids, roles, texts, edits, places, size = [], [], [], [], [], 0
        current, audit, at, state, place = None, "", 0, START, 0

        def add(role, text, edit):
            nonlocal place, size
            ids.append(current[0])
            roles.append(role)
            texts.append(text)
            edits.append(edit)
            places.append(place)
            place, size = place + 1, size + len(role) + len(text)

        def inserted():
            nonlocal at, state
            while at < len(audit) and audit[at] == "I":
                state = NEXT[state]
                add(NAMES[state], "", "I")
                at += 1

        def out():
            nonlocal size
            got = pa.RecordBatch.from_arrays(
                [pa.array(ids, id_type), pa.array(places, pa.int64()), pa.array(roles, pa.string()),
                 pa.array(texts, pa.string()), pa.array(edits, pa.string())],
                names=["conv_id", "place", "role", "text", "edit"])
            for x in (ids, roles, texts, edits, places):
                x.clear()
            size = 0
            return got

        for b in batches:
            for conv, kind, role, text, plan in zip(*(b.column(c).to_pylist() for c in (
                    "conv_id", "kind", "role", "text", "audit"))):
                if kind == 0:
                    if current is not None:
                        inserted()
                    current, audit, at, state, place = (conv,), plan, 0, START, 0
                    continue
                inserted()
                edit, at = audit[at], at + 1
                if edit == "R":
                    state = NEXT[state]
                    add(NAMES[state], text, edit)
                elif edit == "K":
                    state = KEPT[role[:1]][state]
                    add(role, text, edit)
                if size > 1 << 20:
                    yield out()
        if current is not None:
            inserted()
        if ids:
            yield out()

    return run


def repaired(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """The rows after repair: conv_id, place (from 0), role, text, edit (K, R or I).

    The rows of a conversation are contiguous and in order inside one partition.
    """
    kind = rows.schema["conv_id"].dataType
    none = F.lit(None).cast("string")
    both = normalised(rows).select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", none.alias("audit")) \
        .unionByName(planned.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"),
                                    none.alias("role"), none.alias("text"), "audit"))
    return (both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "text")
            .drop("turn").mapInArrow(_repair_stage(to_arrow_type(kind)),
                                     f"conv_id {kind.simpleString()}, place long, role string, text string, edit string"))


def _hash_stage(id_type):
    """Arrow stage: repaired rows in order -> sha256 of ``role:text`` joined by newlines."""

    def run(batches):
        current, digest = None, None
        for b in batches:
            done = []
            for conv, place, role, text in zip(*(b.column(c).to_pylist() for c in (
                    "conv_id", "place", "role", "text"))):
                if place == 0:
                    if digest is not None:
                        done.append((current, digest.hexdigest()))
                    current, digest = conv, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], id_type),
                                                  pa.array([d[1] for d in done])], names=["conv_id", "sha"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([current], id_type), pa.array([digest.hexdigest()])],
                                             names=["conv_id", "sha"])

    return run


def digests(rows: DataFrame) -> DataFrame:
    """conv_id, sha of the rows that :func:`repaired` returns."""
    kind = rows.schema["conv_id"].dataType
    return rows.select("conv_id", "place", "role", "text").mapInArrow(
        _hash_stage(to_arrow_type(kind)), f"conv_id {kind.simpleString()}, sha string")


def damage(rows: DataFrame) -> DataFrame:
    """Rows with repeatable faults, chosen by crc32 of ``conv_id:turn`` modulo 20 (nulls: one space)."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))      # noqa: E731
    n = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = rows.select("conv_id", "turn", "role", "text")
    return (rows.withColumn("_n", n).where("_n != 0").select(
        "conv_id", "turn", F.when(F.col("_n") == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(F.col("_n") == 1, F.lit("")).when(F.col("_n") == 2, F.regexp_replace(text, "[.!?]", ""))
         .otherwise(text).alias("text"),
        F.explode(F.when(F.col("_n") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"))
        .drop("_copy"))


def report(rows: DataFrame, original: DataFrame | None = None) -> DataFrame:
    """Per conversation of ``original`` (default: of ``rows``): faults, cost, audit and the
    sha256 of its repaired rows."""
    planned = materialize(plans(materialize(signatures(rows), "signatures")), "repairs")
    hashes = digests(repaired(rows, planned)).withColumnRenamed("conv_id", "_hashed")
    ids = (rows if original is None else original).select(F.col("conv_id").alias("_conv")).distinct()
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)        # noqa: E731
    out = (ids.join(planned, ids["_conv"].eqNullSafe(planned["conv_id"]), "left")
           .join(hashes, F.col("_conv").eqNullSafe(F.col("_hashed")), "left"))
    return out.select(F.col("_conv").alias("conv_id"), *map(zero, ("gaps", "blank", "duplicate", "truncated",
                                                                   "illegal", "cost")),
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
