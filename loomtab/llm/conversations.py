"""Repair of conversation structure by a run-length dynamic program.

A conversation may open with a system row; after it user and assistant rows take turns and an assistant row ends it. Edits of
rows lead from one of four states (nothing yet, after system, after user, after assistant) to another, so a row's
symbol (initial of its role and kind of fault) is a 4 x 4 matrix of cheapest costs, which adds up along a conversation in the
min-plus sense. Equal consecutive symbols are one run; a run's matrix is a product of cached binary powers. Costs to the end
are carried backwards over runs, then the choices are unrolled forwards, the smallest letter that stays cheapest each time.

Rows without their texts are sorted by conversation and turn over all tasks and cut into slices. A conversation that
lies in several slices is chained by one matrix, one cost vector and one state per slice, so none is held in one task. Texts
meet the choices by a hash of the row; only a digest of a whole repaired conversation has to read its lines in order.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loomtab.llm.common import map_batches, stored, tidy_groups
from loomtab.operators.ordered import keyed_join
from loomtab.session import setting

SLICE = 200_000
"""Rows of one slice, at most about."""
CHUNK = 1 << 20
SPACE = " \t\n\x0b\x0c\r"
FILLED = r"[^\x20\x09-\x0D]"

START, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
FOLLOWS = (USER, USER, ASSISTANT, USER)
"""What an inserted or changed row becomes, by state."""
KEPT = ((SYSTEM, USER), (USER,), (ASSISTANT,), (USER,))
FINE, CUT, GONE = range(3)
"""Faults: none, truncated (costs one if it stays), blank or duplicate (must go)."""
DELETE, INSERT, REROLE = 3, 2, 2
FAR = float("inf")
END = (0.0, 4.0, 2.0, 0.0)
"""Cost of the inserts that close a conversation, by state."""


def symbol(role: str, fault: int) -> int:
    return 3 * INITIALS.get(role[:1], START) + fault


def row_matrix(symbol: int) -> tuple:
    """Cheapest cost from state to state over one row and any inserts before it."""
    role, fault = divmod(symbol, 3)
    edit = [[FAR] * 4 for _ in range(4)]
    for q in range(4):
        edit[q][q] = DELETE
        if fault != GONE:
            edit[q][FOLLOWS[q]] = min(edit[q][FOLLOWS[q]], REROLE + fault)
            if role in KEPT[q]:
                edit[q][role] = min(edit[q][role], fault)
    inserts = [[FAR] * 4 for _ in range(4)]
    for q in range(4):
        at, cost = q, 0
        while inserts[q][at] == FAR:
            inserts[q][at] = cost
            at, cost = FOLLOWS[at], cost + INSERT
    return times(inserts, edit)


def times(a, b) -> tuple:
    return tuple(tuple(min(a[i][k] + b[k][j] for k in range(4)) for j in range(4)) for i in range(4))


def applied(matrix, vector: tuple) -> tuple:
    a, b, c, d = vector
    return tuple(min(m[0] + a, m[1] + b, m[2] + c, m[3] + d) for m in matrix)


class Repair:
    """Binary powers of the symbols' matrices, and steps met before."""

    def __init__(self):
        self.powers: dict[int, list] = {}
        self.known: dict = {}

    def power(self, symbol: int, k: int) -> tuple:
        held = self.powers.setdefault(symbol, [row_matrix(symbol)])
        while len(held) <= k:
            held.append(times(held[-1], held[-1]))
        return held[k]

    def before(self, symbol: int, n: int, costs: tuple) -> tuple:
        """Costs to the end before a run, from those after it."""
        least = min(costs)
        key = symbol, n, tuple(c - least for c in costs)
        if (found := self.known.get(key)) is None:
            if len(self.known) > 100_000:
                self.known.clear()
            found, k = key[2], 0
            while n >> k:
                if n >> k & 1:
                    found = applied(self.power(symbol, k), found)
                k += 1
            self.known[key] = found
        return tuple(c + least for c in found)

    def matrix(self, items: list) -> list[float]:
        """Matrix of a segment, row by row, from its (symbol, count) items."""
        runs = collapsed(items)
        columns = []
        for q in range(4):
            costs = tuple(0.0 if p == q else FAR for p in range(4))
            for s, n in reversed(runs):
                costs = self.before(s, n, costs)
            columns.append(costs)
        return [columns[j][i] for i in range(4) for j in range(4)]

    def unroll(self, items: list, after: tuple, state: int, last: bool) -> tuple[list[str], list[str], int, float]:
        """Letters and lines of each item, the state behind them and their cost; ``after`` holds the costs to the end behind them.

        A line is ``k`` for a kept row, ``u`` and ``a`` for a changed one, ``U`` and ``A`` for an inserted one.
        """
        ends, costs = [], after
        for s, run in reversed([(s, [n for _, n in run]) for s, run in groupby(items, lambda item: item[0])]):
            behind, held = costs, []
            costs = self.before(s, sum(run), costs)
            for n in reversed(run):
                held.append(behind)
                behind = self.before(s, n, behind) if len(held) < len(run) else None
            ends += held
        ends.reverse()
        start, letters, lines = costs[state], [], []
        for (s, n), then in zip(items, ends):
            role, fault = divmod(s, 3)
            if fault == GONE:  # a deletion sorts before an insert, so inserts wait
                letters.append("D" * n)
                lines.append("")
                continue
            word = line = ""
            for left in range(n - 1, -1, -1):
                behind = self.before(s, left, then)
                here = self.before(s, 1, behind)
                while True:
                    now, to = here[state], FOLLOWS[state]
                    if DELETE + behind[state] == now:
                        word += "D"
                    elif INSERT + here[to] == now:
                        word += "I"
                        line += ".SUA"[to]
                        state = to
                        continue
                    elif role in KEPT[state] and fault + behind[role] == now:
                        word, line, state = word + "K", line + "k", role
                    else:
                        word, line, state = word + "R", line + ".sua"[to], to
                    break
            letters.append(word)
            lines.append(line)
        behind = after[state]
        if last:
            while END[state] > 0:
                state = FOLLOWS[state]
                letters[-1] += "I"
                lines[-1] += ".SUA"[state]
        return letters, lines, state, start - (0.0 if last else behind)


def collapsed(items: list) -> list:
    return [(s, sum(n for _, n in run)) for s, run in groupby(items, lambda item: item[0])]


def legal(a: int, b: int) -> bool:
    return (a, b) in ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER))


def row_items(role: str, n: int, fault: int, first: bool) -> list:
    """(symbol, count) of equal rows: all but the first are duplicates."""
    if fault == GONE or not first:
        return [(symbol(role, GONE), n)]
    return [(symbol(role, fault), 1)] + ([(symbol(role, GONE), n - 1)] if n > 1 else [])


def conversations_of(table: pa.Table) -> list:
    """(conversation, rows in order) of a slice."""
    table = table.sort_by("place")
    rows = zip(*(table[c].to_pylist() for c in ("conv", "place", "id", "role", "n", "fault", "first")))
    return [(conv, list(run)) for conv, run in groupby(rows, lambda r: r[0])]


def slice_matrices(table: pa.Table) -> pa.Table:
    repair, out = Repair(), {c: [] for c in ("slice", "conv", "matrix", "opens", "closes", "illegal")}
    for conv, rows in conversations_of(table):
        roles = [(INITIALS.get(role[:1], START), n) for _, _, _, role, n, *_ in rows]
        wrong = sum((n - 1) * (not legal(r, r)) for r, n in roles) + sum(not legal(a, b) for (a, _), (b, _) in zip(roles, roles[1:]))
        matrix = repair.matrix([i for *_, role, n, fault, first in rows for i in row_items(role, n, fault, first)])
        for name, value in zip(out, (table["slice"][0].as_py(), conv, matrix, roles[0][0], roles[-1][0], wrong)):
            out[name].append(value)
    return pa.table({c: pa.array(v, table.schema.field("conv").type) if c == "conv" else typed(c, v) for c, v in out.items()})


def typed(name: str, values: list) -> pa.Array:
    kinds = {"slice": pa.int64(), "matrix": pa.list_(pa.float64()), "opens": pa.int32(), "closes": pa.int32(), "illegal": pa.int64(), "after": pa.list_(pa.float64()),
             "opening": pa.bool_(), "closing": pa.bool_(), "exits": pa.list_(pa.int32()), "entry": pa.int32(), "audit": pa.string(), "cost": pa.int64(),
             "rows": pa.list_(pa.struct([("place", pa.int64()), ("id", pa.binary()), ("role", pa.string()), ("made", pa.string())]))}
    return pa.array(values, kinds[name])


def backwards(batches):
    """Costs to the end behind each slice of a conversation; slices come last first."""
    known, after, opens = None, None, None
    for batch in batches:
        out = {c: [] for c in ("after", "closing", "illegal")}
        for conv, matrix, begins, closes, wrong in zip(*(batch.column(c).to_pylist() for c in ("conv", "matrix", "opens", "closes", "illegal"))):
            closing = known != (conv,)
            if closing:
                after = END
            out["after"].append(list(after))
            out["closing"].append(closing)
            out["illegal"].append(wrong + (not closing and not legal(closes, opens)))
            after = applied([matrix[4 * i:4 * i + 4] for i in range(4)], after)
            known, opens = (conv,), begins
        yield pa.RecordBatch.from_arrays([batch.column("slice"), batch.column("conv"), *(typed(c, v) for c, v in out.items())], ["slice", "conv", *out])


def slice_exits(table: pa.Table, chain: pa.Table) -> pa.Table:
    """State behind a slice for each state before it."""
    repair, after = Repair(), {r["conv"]: r for r in chain.to_pylist()}
    exits = {}
    for conv, rows in conversations_of(table):
        own = after[conv]
        items = [i for *_, role, n, fault, first in rows for i in row_items(role, n, fault, first)]
        # What closes a conversation is entered last, and nobody asks for the state behind it.
        exits[conv] = None if own["closing"] else [repair.unroll(items, tuple(own["after"]), q, False)[2] for q in range(4)]
    return chain.append_column("exits", typed("exits", [exits[c] for c in chain["conv"].to_pylist()]))


def forwards(batches):
    """State before each slice of a conversation; slices come first to last."""
    known, state = None, START
    for batch in batches:
        entry, opening = [], []
        for conv, exits in zip(batch.column("conv").to_pylist(), batch.column("exits").to_pylist()):
            opening.append(known != (conv,))
            if opening[-1]:
                state = START
            entry.append(state)
            known, state = (conv,), exits[state] if exits else START
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("slice", "conv", "after", "closing", "illegal")), typed("entry", entry), typed("opening", opening)],
                                         ["slice", "conv", "after", "closing", "illegal", "entry", "opening"])


def slice_choices(table: pa.Table, chain: pa.Table) -> pa.Table:
    repair, known = Repair(), {r["conv"]: r for r in chain.to_pylist()}
    out = {c: [] for c in ("slice", "conv", "opening", "closing", "illegal", "audit", "cost", "rows")}
    for conv, rows in conversations_of(table):
        own = known[conv]
        cut = [row_items(role, n, fault, first) for *_, role, n, fault, first in rows]
        letters, lines, _, cost = repair.unroll([i for items in cut for i in items], tuple(own["after"]), own["entry"], own["closing"])
        made, at = [], 0
        for items, (_, place, id_, role, *_) in zip(cut, rows):
            line = "".join(lines[at:at + len(items)])
            at += len(items)
            if line:
                made.append({"place": place, "id": id_, "role": role, "made": line})
        for name, value in zip(out, (own["slice"], conv, own["opening"], own["closing"], own["illegal"], "".join(letters), int(cost), made)):
            out[name].append(value)
    return pa.table({c: pa.array(v, table.schema.field("conv").type) if c == "conv" else typed(c, v) for c, v in out.items()})


def identified(df: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    own = df.select(F.col(conversation).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
                    F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"))
    return own.withColumns({name: F.substring(F.unhex(F.sha2(F.to_json(F.struct(*cols)), 256)), 1, 16)
                            for name, cols in (("id", ("conv", "turn", "role", "text")), ("said", ("conv", "role", "text")))})


def faulty(text: str):
    """0, 1 (the last character that is no white space ends no sentence) or 2 (there is none)."""
    ending = F.substring(F.rtrim(F.col(text), F.lit(SPACE)), -1, 1)
    return F.when(~F.col(text).rlike(FILLED), GONE).when(ending.isin(".", "!", "?"), FINE).otherwise(CUT)


def repair(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", rows: int = SLICE) -> tuple[DataFrame, DataFrame]:
    """Report of every conversation, and the repaired rows.

    The report has ``conv``, ``gaps`` (turns missing between the first and the last), ``blank``, ``duplicate``, ``truncated`` (first fault of each row),
    ``illegal`` (neighbours that may not follow each other), ``cost``, ``audit`` (edits in order: Keep, Rerole, Delete, Insert). The rows have
    ``conv``, ``slice``, ``place``, ``line`` (their order), ``whole`` (the conversation lies in one slice), ``role`` and ``text``.

    Rows are read by turn, NULL turns first, rows of one turn by role and hash of the text; rows that repeat as a whole are neighbours. A
    NULL role or text is one blank: such a role is none of the three, such a text is blank. A NULL conversation is one of its own. Roles
    are told by their first letter. Rows of unknown role can be changed or deleted. Gaps beyond 64 bits are NULL. A conversation that
    loses all rows has no repaired ones. An empty table gives empty ones. Other columns are not read.
    """
    spark = df.sparkSession
    texts = identified(df, conversation, turn, role, text)
    light = texts.groupBy("conv", "turn", "role", "id", "said", faulty("text").alias("fault")).agg(F.count("*").alias("n"))
    light = stored(light, "turns")
    tasks = max(setting(spark, "spark.sql.shuffle.partitions", 200), -(-light.count() // rows))
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("id")]
    placed = stored(light.repartitionByRange(tasks, *order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()), "sorted")
    firsts = placed.groupBy("said").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    marked = stored(placed.join(firsts, "place", "left").select(
        "conv", "turn", "place", F.shiftright("place", 33).alias("slice"), "id", "role", "n", "fault", F.coalesce("first", F.lit(False)).alias("first")), "marked")
    kind = df.schema[conversation].dataType.simpleString()
    held = marked.drop("turn").groupBy("slice")

    matrices = held.applyInArrow(tidy_groups(slice_matrices), f"slice long, conv {kind}, matrix array<double>, opens int, closes int, illegal long")
    ends = stored(map_batches(matrices.repartition("conv").sortWithinPartitions("conv", F.desc("slice")), backwards,
                              f"slice long, conv {kind}, after array<double>, closing boolean, illegal long"), "ends")
    exits = held.cogroup(ends.groupBy("slice")).applyInArrow(tidy_groups(slice_exits), f"slice long, conv {kind}, after array<double>, closing boolean, illegal long, exits array<int>")
    entries = stored(map_batches(exits.repartition("conv").sortWithinPartitions("conv", "slice"), forwards,
                                 f"slice long, conv {kind}, after array<double>, closing boolean, illegal long, entry int, opening boolean"), "entries")
    chosen = stored(held.cogroup(entries.groupBy("slice")).applyInArrow(
        tidy_groups(slice_choices), f"slice long, conv {kind}, opening boolean, closing boolean, illegal long, audit string, cost long, "
                                    "rows array<struct<place: long, id: binary, role: string, made: string>>"), "choices")

    counts = marked.groupBy("conv").agg(
        F.min("turn").alias("low"), F.max("turn").alias("high"), F.count_distinct("turn").alias("turns"),
        F.sum(F.when(F.col("fault") == GONE, F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("fault") != GONE, F.col("n") - F.col("first").cast("long")).otherwise(0)).alias("duplicate"),
        F.sum(F.when((F.col("fault") == CUT) & F.col("first"), 1).otherwise(0)).alias("truncated"))
    gaps = F.coalesce("high", F.lit(0)).cast("decimal(38,0)") - F.coalesce("low", F.lit(0)) + F.when(F.col("turns") > 0, 1).otherwise(0) - F.col("turns")
    audits = chosen.groupBy("conv").agg(
        F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("slice", "audit"))), lambda x: x["audit"]), "").alias("audit"))  # one entry per slice
    report = keyed_join(counts, audits, ["conv"]).select("conv", gaps.try_cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    made = chosen.select("conv", "slice", (F.col("opening") & F.col("closing")).alias("whole"), F.explode("rows").alias("r")) \
        .select("conv", "slice", "whole", "r.place", "r.id", F.col("r.role").alias("own"), "r.made")
    once = texts.groupBy("id").agg(F.first("text").alias("text"))
    lines = made.join(once, "id").select("conv", "slice", "whole", "place", "own", "text", F.posexplode(F.split("made", "(?<=.)(?=.)")).alias("line", "kind"))
    role_of = F.when(F.col("kind") == "k", F.col("own")).when(F.lower("kind") == "u", "user").otherwise("assistant")
    said = F.when(F.col("kind").isin("U", "A"), "").otherwise(F.col("text"))
    return report, lines.select("conv", "slice", "whole", "place", "line", role_of.alias("role"), said.alias("text"))


def digests(lines: DataFrame) -> DataFrame:
    """``conv`` and ``sha256`` of the lines ``role:text`` of each repaired conversation, joined by line ends.

    Lines are gathered by slice. A conversation of one slice is digested there; of a longer one blocks of bytes go on, which one
    task reads in order, as such a digest demands: it holds one block at a time.
    """
    kind = lines.schema["conv"].dataType.simpleString()

    def by_slice(batches):
        known, hashed, held, number, out = None, None, [], 0, []
        size = 0

        def close(all_=True):
            nonlocal held, size, number
            if known is not None and known[2]:
                if all_:
                    out.append((*known[:2], 0, hashed.hexdigest(), None))
            elif known is not None:
                out.append((*known[:2], number, None, b"".join(held)))
                held, size, number = [], 0, number + 1

        def batch_of():
            columns = list(zip(*out)) or [()] * 5
            kinds = [lines_type, pa.int64(), pa.int32(), pa.string(), pa.binary()]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["conv", "slice", "number", "sha256", "block"])

        lines_type = None
        for batch in batches:
            lines_type = batch.schema.field("conv").type
            for conv, part, whole, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "slice", "whole", "role", "text"))):
                line = f"{role}:{text}".encode()
                if known != (conv, part, whole):
                    close()
                    known, held, size, number = (conv, part, whole), [], 0, 0
                    hashed = hashlib.sha256(line)
                    if not whole:
                        held, size = [b"\n", line], len(line)
                    continue
                if whole:
                    hashed.update(b"\n" + line)
                    continue
                held += [b"\n", line]
                size += len(line) + 1
                if size > CHUNK:
                    close(False)
            if out:
                yield batch_of()
        if known is not None:
            if known[2] or held:
                close()
            if out:
                yield batch_of()

    parts = lines.repartition("conv", "slice").sortWithinPartitions("conv", "slice", "place", "line").select("conv", "slice", "whole", "role", "text")
    found = stored(map_batches(parts, by_slice, f"conv {kind}, slice long, number int, sha256 string, block binary"), "digests")

    def by_conversation(batches):
        known, hashed, kind_ = None, None, None
        for batch in batches:
            kind_, out = batch.schema.field("conv").type, []
            for conv, block in zip(batch.column("conv").to_pylist(), batch.column("block")):
                data = block.as_buffer()
                if known != (conv,):
                    if known is not None:
                        out.append((known[0], hashed.hexdigest()))
                    known, hashed, data = (conv,), hashlib.sha256(), data.slice(1)
                hashed.update(data)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], kind_), pa.array([h for _, h in out])], ["conv", "sha256"])
        if known is not None:
            yield pa.RecordBatch.from_arrays([pa.array([known[0]], kind_), pa.array([hashed.hexdigest()])], ["conv", "sha256"])

    cut = found.where("block is not null").repartition("conv").sortWithinPartitions("conv", "slice", "number").select("conv", "block")
    return found.where("block is null").select("conv", "sha256").unionByName(map_batches(cut, by_conversation, f"conv {kind}, sha256 string"))


def damage(df: DataFrame) -> DataFrame:
    """Rows of ``conv_id``, ``turn``, ``role``, ``text`` damaged by their number: one in twenty each is dropped, emptied, loses its ends of
    sentences, is repeated, becomes a user's. A NULL is one blank."""
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    drawn = df.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(name.cast("binary")) % 20).alias("hit"))
    return drawn.where("hit <> 0").select(
        "conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")
