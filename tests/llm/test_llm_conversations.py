"""Conversation repair against a plain search over all edits."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

import odd
from loomtab.llm import conversations, queries  # noqa: F401 - registers the queries
from loomtab.plans.registry import QUERIES
from loomtab.sources.tables import Tables

FILLED = re.compile("[^\x20\x09-\x0D]")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        hit = zlib.crc32(name.encode()) % 20
        if hit == 1:
            text = ""
        if hit == 2:
            text = re.sub("[.!?]", "", text)
        if hit == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    return out


def row_hash(conv, turn, role, text):
    import json
    named = {k: v for k, v in (("conv", conv), ("turn", turn), ("role", role), ("text", text)) if v is not None}
    return hashlib.sha256(json.dumps(named, ensure_ascii=False, separators=(",", ":")).encode()).digest()


def plain(rows):
    """conv -> (gaps, blank, duplicate, truncated, illegal, cost, audit, digest); every (state, cost, letters) of the cheapest edits is followed."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in damaged(rows) if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], row_hash(*r)))
        if not own:
            out[conv] = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
            continue
        turns = [t for _, t, *_ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults, seen = [], set()
        for _, _, role, text in own:
            filled = FILLED.findall(text)
            faults.append("blank" if not filled else "duplicate" if (role, text) in seen else "truncated" if filled[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [r[2][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        best = inserted({"": (0, "", ())})
        for (_, _, role, text), fault in zip(own, faults):
            then = {}

            def offer(state, cost, letters, lines):
                if state not in then or (cost, letters) < then[state][:2]:
                    then[state] = cost, letters, lines

            for state, (cost, letters, lines) in best.items():
                offer(state, cost + 3, letters + "D", lines)
                if fault in ("", "truncated"):
                    extra = fault == "truncated"
                    for to, edit, price in ((role[:1], "K", 0), ("u", "R", 2), ("a", "R", 2)):
                        if (state, to) in GRAMMAR:
                            name = role if edit == "K" else {"u": "user", "a": "assistant"}[to]
                            offer(to, cost + price + extra, letters + edit, (*lines, f"{name}:{text}"))
            best = inserted(then)
        cost, audit, lines = min(best[s] for s in ("", "a") if s in best)
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


GRAMMAR = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}


def inserted(best):
    """With inserts, each of one or more rows, from every state; letters are compared as a whole since all lead to one place."""
    best = dict(best)
    for _ in range(4):
        for state, (cost, letters, lines) in list(best.items()):
            for to, name in (("u", "user:"), ("a", "assistant:")):
                if (state, to) in GRAMMAR:
                    new = cost + 2, letters + "I", (*lines, name)
                    if to not in best or new[:2] < best[to][:2]:
                        best[to] = new
    return best


def found(spark, rows, slice_rows=conversations.SLICE):
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "conv_id long, turn long, role string, text string, conv string, place int, id string").repartition(4)
    report, lines = conversations.repair(conversations.damage(df), rows=slice_rows)
    digests = {r["conv"]: r["sha256"] for r in conversations.digests(lines).collect()}
    return {r["conv"]: (*(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")), digests.get(r["conv"], hashlib.sha256(b"").hexdigest()))
            for r in report.collect()}


def drawn(seed, conversations_, rows_, texts=("Yes.", "no", "What?", " ", "", "It is so!  ", "a.b\n", "\u00a0")):
    r = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User", "under"]
    out = []
    for conv in range(conversations_):
        for turn in range(r.randint(1, rows_)):
            text = r.choice(texts) if r.random() < 0.5 else f"text {r.randint(0, 10 ** 6)}{r.choice('.!? x')}"
            out.append((conv, turn * r.choice([1, 1, 1, 2]) if r.random() < 0.95 else None, r.choice(roles), None if r.random() < 0.03 else text))
    return out


def expected(rows):
    return {conv: v for conv, v in plain(rows).items() if conv in {r[0] for r in damaged(rows)}}


def test_matrices_against_all_edits():
    r = random.Random(0)
    repair = conversations.Repair()
    for _ in range(300):
        roles = [r.choice(["system", "user", "assistant", "x"]) for _ in range(r.randint(1, 7))]
        faults = [r.choice([0, 0, 1, 2]) for _ in roles]
        items = [(conversations.symbol(role, fault), 1) for role, fault in zip(roles, faults)]
        matrix = repair.matrix(items)
        got = min(c + e for c, e in zip(matrix[:4], conversations.END))
        letters, _, _, cost = repair.unroll(items, conversations.END, conversations.START, True)
        best = inserted({"": (0, "", ())})
        for role, fault in zip(roles, faults):
            then = {}
            for state, (c, w, _) in best.items():
                options = [(state, c + 3, w + "D")]
                options += [(t, c + p + fault, w + e) for t, e, p in ((role[0], "K", 0), ("u", "R", 2), ("a", "R", 2)) if fault < 2 and (state, t) in GRAMMAR]
                for to, *new in options:
                    then[to] = min(then.get(to, (99, "", ())), (*new, ()))
            best = inserted(then)
        want = min(best[s][:2] for s in ("", "a") if s in best)
        assert (got, cost, "".join(letters)) == (want[0], *want)


def test_powers_of_long_runs():
    repair = conversations.Repair()
    for symbol, n in itertools.product(range(12), (1, 2, 3, 7, 64, 1000)):
        costs = (0.0, 4.0, 2.0, 0.0)
        for _ in range(n):
            costs = conversations.applied(conversations.row_matrix(symbol), costs)
        assert repair.before(symbol, n, (0.0, 4.0, 2.0, 0.0)) == costs
    letters = repair.unroll([(conversations.symbol("user", 0), 5000)], conversations.END, conversations.START, True)[0]
    assert "".join(letters) == "KR" * 2500


@pytest.mark.parametrize("slice_rows", [conversations.SLICE, 40])
def test_repair_of_odd_rows(spark, slice_rows):
    rows = drawn(1, 60, 12)
    rows += [(None, t, role, text) for _, t, role, text in rows[:9]] + rows[:5] + [(1000, None, "user", "a."), (1000, None, "assistant", "b."), (1001, 2 ** 62, "user", "x."), (1001, -2 ** 62, "user", "y.")]
    rows += [(1002, 5, "user", "same.")] * 30 + [(1003, i, "user", "same.") for i in range(50)] + [(1004, i, None, None) for i in range(9)]
    assert found(spark, rows, slice_rows) == expected(rows)


def test_one_conversation_over_many_slices(spark):
    rows = drawn(5, 1, 1) + [(7, i, r, f"{i % 90}{'.' if i % 5 else ''}") for i, r in enumerate(random.Random(2).choices(["user", "assistant", "system"], k=900))]
    assert found(spark, rows, 30) == expected(rows)


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "a."), (1, 1, "user", "b."), (2, 0, "assistant", "c"), (3, 0, "user", " "), (4, 0, "system", "s."), (5, 0, "user", "x."), (5, 1, "assistant", "y.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    report, lines = conversations.repair(df)
    got = {r["conv"]: (r["audit"], r["cost"]) for r in report.collect()}
    assert got == {1: ("KR", 2), 2: ("D", 3), 3: ("D", 3), 4: ("D", 3), 5: ("KK", 0)}
    made = [(r["conv"], r["role"], r["text"]) for r in lines.orderBy("conv", "slice", "place", "line").collect()]
    assert made == [(1, "user", "a."), (1, "assistant", "b."), (5, "user", "x."), (5, "assistant", "y.")]
    empty = conversations.repair(df.limit(0))
    assert empty[0].count() == 0 and conversations.digests(empty[1]).count() == 0


def test_op11_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in Tables(spark, sf_dir).conversations.select("conv_id", "turn", "role", "text").collect()]
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    got = [(r["conv_id"], *(r[n] for n in names)) for r in QUERIES["op11_conversation_repair"](spark, sf_dir).collect()]
    assert odd.plain(got) == odd.plain((conv, *v) for conv, v in plain(rows).items())
