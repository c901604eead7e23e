import hashlib
import itertools
import re
import zlib

import pytest

from txstream.llm import conversation_repair as cr

GRAMMAR = re.compile(r"(s?(ua)+)?$")


def faults_of(rows):
    """rows: (turn, role, text) in order -> letters and counts, by plain loops."""
    seen, letters, counts = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        shown = text.rstrip(cr.WHITE)
        if not shown:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        else:
            fault = "truncated" if shown[-1] not in ".!?" else ""
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
        letters += "x" if fault in ("blank", "duplicate") else letter if fault else letter.upper()
    return letters, counts


def enumerated(letters, most_inserts):
    """Cheapest, then least audit among all edit sequences, and its role initials."""
    best = None
    for slots in itertools.product(range(most_inserts + 1), repeat=len(letters) + 1):
        if sum(slots) > most_inserts:
            continue
        for edits in itertools.product(*["D" if x == "x" else "KRD" for x in letters]):
            audit = "".join("I" * n + e for n, e in zip(slots, [*edits, ""]))
            cost = 3 * sum(slots)
            shape = []
            for x, e in zip(letters, edits):
                cost += {"K": 0, "R": 3, "D": 4}[e] + (3 if e != "D" and x in "suao" else 0)
            row = 0
            for e in audit:
                if e == "I":
                    shape.append("ua")
                else:
                    if e == "K":
                        shape.append(letters[row].lower())
                    elif e == "R":
                        shape.append("ua")
                    row += 1
            if best is not None and (cost, audit) >= best[:2]:
                continue
            for roles in itertools.product(*shape):
                if GRAMMAR.match("".join(roles)):
                    best = (cost, audit, "".join(roles))
                    break
    return best


def test_automaton_equals_enumeration_of_all_edits():
    words = ["".join(w) for n in range(4) for w in itertools.product("SUAOuxa", repeat=n)]
    words += ["SUAU", "AAUU", "sUaU", "xUxA", "UUAA", "OsuA"]
    got = dict(zip(sorted(w[::-1] for w in words), cr.audits(iter(sorted(w[::-1] for w in words)))))
    for w in words:
        assert got[w[::-1]] == enumerated(w, 3)[:2], w


def test_shared_nodes_are_few():
    words = sorted("".join(w) for w in itertools.product("SUAOxua", repeat=4))
    node, nodes = cr.shared({}, cr.end_node()), {}
    todo = [node]
    while todo:
        n = todo.pop()
        if (n.costs, n.moves) in nodes:
            continue
        nodes[n.costs, n.moves] = n
        todo += [cr.before(n, x)[0] for x in "SUAOsuaox"]
    assert len(nodes) < 400 < len(words)       # relative costs and moves repeat


def brute(rows):
    """All of the report for (conv_id, turn, role, text) rows before damage."""
    convs = {}
    for conv, turn, role, text in rows:
        show = lambda v: " " if v is None else str(v)        # noqa: E731
        n = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        kept = convs.setdefault(conv, [])
        if n:
            row = (turn, "user" if n == 4 else role,
                   "" if n == 1 else re.sub("[.!?]", "", text) if n == 2 else text)
            kept += [row] * (2 if n == 3 else 1)
    out = {}
    for conv, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        letters, counts = faults_of(kept)
        turns = {r[0] for r in kept} - {None}
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(kept, kept[1:])]
        cost, audit, roles = enumerated(letters, 3)
        repaired, row, at = [], 0, 0
        for e in audit:
            if e in "KR":
                role = kept[row][1] if e == "K" else {"u": "user", "a": "assistant"}[roles[at]]
                repaired.append(f"{role}:{kept[row][2]}")
            elif e == "I":
                repaired.append({"u": "user:", "a": "assistant:"}[roles[at]])
            at += e != "D"
            row += e != "I"
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, counts["blank"],
                     counts["duplicate"], counts["truncated"],
                     sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                     hashlib.sha256("\n".join(repaired).encode()).hexdigest())
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_report_equals_brute_force_with_nulls_ties_and_odd_rows(spark):
    rows = []
    for c in range(60):
        n = c % 6
        rows += [(c, t, ["system", "user", "assistant", "tool", None, "Ass", "u"][(c * 7 + t * 3) % 7],
                  ["Fine.", "cut off", " \n", None, "Ok! \t", "Ünï?", "Fine."][(c + t * t) % 7]) for t in range(n)]
    rows += [(100, None, "user", "a."), (100, None, None, None), (100, 5, "assistant", "b."),
             (100, 5, "assistant", "b."), (None, 1, "user", "Who?"), (None, 2, "assistant", "Me."),
             (None, None, "", "."), (101, -3, "assistant", "x."), (101, 9, "user", "y")]
    df = spark.createDataFrame([(*r, "z") for r in rows],
                               "conv_id long, turn long, role string, text string, audit string")
    got = {r.conv_id: tuple(r[c] for c in COLUMNS)
           for r in cr.report(cr.damage(df.repartition(4)), df).collect()}
    want = brute(rows)
    assert got == want


def test_repaired_rows_follow_the_grammar_and_keep_texts(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    damaged = cr.damage(df)
    planned = cr.plans(cr.signatures(damaged))
    rows = cr.repaired(damaged, planned).collect()
    texts = {(r.conv_id, r.text) for r in damaged.collect()}
    convs = {}
    for r in rows:
        convs.setdefault(r.conv_id, []).append(r)
        assert r.edit == "I" or (r.conv_id, r.text) in texts
    for got in convs.values():
        got.sort(key=lambda r: r.place)
        assert [r.place for r in got] == list(range(len(got)))
        assert GRAMMAR.match("".join(r.role[0] for r in got))


def test_a_very_long_conversation_and_many_equal_ones(spark):
    long = spark.range(30_000).selectExpr(
        "1L conv_id", "id turn", "if(id % 2 = 0, 'user', 'assistant') role", "concat('row ', id, '.') text")
    same = spark.range(4000).selectExpr("id div 2 + 10 conv_id", "id % 2 turn",
                                        "if(id % 2 = 0, 'user', 'assistant') role", "'Hi.' text")
    got = {r.conv_id: r for r in cr.report(long.unionByName(same)).collect()}
    assert got[1].audit == "K" * 30_000 and got[1].cost == 0
    assert got[1].repaired_sha256 == hashlib.sha256("\n".join(
        f"{'assistant' if i % 2 else 'user'}:row {i}." for i in range(30_000)).encode()).hexdigest()
    assert len(got) == 2001 and {got[i].audit for i in range(10, 2010)} == {"KK"}


def test_no_conversations(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cr.report(cr.damage(df), df).count() == 0
    one = spark.createDataFrame([(1, 1, "user", "a.")], "conv_id long, turn int, role string, text string")
    assert cr.report(one.where("false"), one).first().repaired_sha256 == hashlib.sha256(b"").hexdigest()
    assert pytest.approx(cr.report(one).first().cost) == 3
