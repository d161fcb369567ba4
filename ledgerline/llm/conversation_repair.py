"""Operator 12, repair of the turn structure of conversations, by Hirschberg's method.

A conversation is to read ``(s?(ua)+)?`` by the initials of its roles.  Edits: Keep (0),
Rerole to the user or assistant that is due (2), Delete (3, forced for blank and
duplicate rows), Insert an empty user or assistant turn (2); a truncated row that stays
costs 1 more.  The result is the cheapest script of edits; of several the one whose
string of initials is ASCII-least (its *audit*).

Four states (nothing yet, after system, after user, after assistant) follow the rows.
A forward vector has, for each state, the least cost and the rank of its least script
among the four; a backward vector has the least cost from each state to the end.  They
meet in the middle of the conversation: of the cheapest crossings the one with the
least rank is right, since scripts over the same rows that end with a row's own edit are
never prefixes of each other.  Both halves recurse with their ends fixed, so the space
is linear.

Conversations of up to ``LONG`` rows and ``LONG_BYTES`` of text are worked on one after
another, sorted within partitions.  A longer one is dealt by ranges of its turns: blocks
of ``BLOCK`` rows give their forward vectors from each of the four states, the vectors of a
conversation's blocks are joined to the crossings at block borders, and every block then
recurses by itself.  Only the digest of the repaired text, a sequential hash, passes a
long conversation through one task, streamed block by block.  Both ways give equal rows.

Defined cases: a null id is a conversation of its own; null role and text are read as one
space; rows of one turn are taken by role, then text (UTF-8); null turns come first and
take no part in gaps; a role that begins with none of s, u, a can only be reroled or
deleted; repeated rows are duplicates; a conversation without rows has zeros and an empty
audit; an empty table gives no rows; other columns take no part.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerline.llm.common import id_field, stored, tidied, tidied_group

#: Rows and bytes of text up to which a conversation is held by one task, and rows of a
#: block of a longer one.
LONG, LONG_BYTES, BLOCK = 10_000, 32 << 20, 4096

SPACE = " \t\n\v\f\r"
NONE, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: Initial of the role that is due in a state, and the state after it.
DUE = {NONE: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
AFTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
ROLE = {"u": "user", "a": "assistant"}
FAR = 1 << 50
#: Turns to insert at the end, and what they cost.
CLOSING = {NONE: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
GOAL = [2 * len(CLOSING[s]) for s in STATES]

# a row's code: what its initial is, and whether it stays whole, truncated or not at all
INITIALS = "sua?"
FINE, TRUNCATED, GONE = range(3)
SCRIPTS = sorted("I" * n + edit for n in range(3) for edit in "DKR")
RANK_BITS, SCRIPT_BITS = 2, 4


def code(initial: str, fault: int) -> int:
    return 3 * (INITIALS.find(initial) if initial in ("s", "u", "a") else 3) + fault


def _edges(initial: str, fault: int) -> list[tuple[int, int, int, int]]:
    """(state, next state, cost, index of script) of one row: the best script of each
    pair of states, inserts before the row's own edit included."""
    best: dict[tuple[int, int], tuple[int, int]] = {}
    for start in STATES:
        state = start
        for inserts in range(3):
            due = DUE[state]
            ends = [("D", state, 3)]
            if fault != GONE:
                ends.append(("R", AFTER[due], 2 + fault))
                if initial == due or (initial == "s" and state == NONE):
                    ends.append(("K", AFTER[initial], fault))
            for edit, end, cost in ends:
                found = (2 * inserts + cost, SCRIPTS.index("I" * inserts + edit))
                best[start, end] = min(best.get((start, end), found), found)
            state = AFTER[due]
    return [(s, t, *found) for (s, t), found in sorted(best.items())]


EDGES = [_edges(initial, fault) for initial in INITIALS for fault in range(3)]
SHIFT = RANK_BITS + SCRIPT_BITS
LOW = (1 << SHIFT) - 1
UNREACHED = FAR << SHIFT


def forward(codes: bytes, start: int) -> list[int]:
    """Per state ``cost << SHIFT | rank << SCRIPT_BITS`` of the best script over the rows."""
    at = [UNREACHED] * 4
    at[start] = 0
    for c in codes:
        new = [UNREACHED] * 4
        for s, t, cost, script in EDGES[c]:
            key = at[s] + (cost << SHIFT | script)
            if key < new[t] and at[s] < UNREACHED:
                new[t] = key
        order = sorted(key & LOW for key in new if key < UNREACHED)
        at = [key if key >= UNREACHED else (key & ~LOW) | order.index(key & LOW) << SCRIPT_BITS for key in new]
    return at


def backward(codes: bytes, goal: list[int]) -> list[int]:
    """Per state the least cost of the rows and the goal after them."""
    for c in reversed(codes):
        new = [FAR] * 4
        for s, t, cost, _ in EDGES[c]:
            if goal[t] + cost < new[s]:
                new[s] = goal[t] + cost
        goal = new
    return goal


def crossing(at: list[int], after: list[int]) -> int:
    """State in which the least of the cheapest scripts passes."""
    return min(STATES, key=lambda s: ((at[s] >> SHIFT) + after[s], at[s] & LOW))


def only(state: int) -> list[int]:
    return [0 if s == state else FAR for s in STATES]


def script(codes: bytes, start: int, goal: list[int]) -> str:
    """Cheapest edits of the rows from ``start`` to ``goal``, ties ASCII-least."""
    out: list[str] = []

    def part(low: int, high: int, start: int, goal: list[int]) -> None:
        if high - low == 1:
            out.append(SCRIPTS[min((cost + goal[t], x) for s, t, cost, x in EDGES[codes[low]] if s == start)[1]])
            return
        middle = (low + high) // 2
        meet = crossing(forward(codes[low:middle], start), backward(codes[middle:high], goal))
        part(low, middle, start, only(meet))
        part(middle, high, meet, goal)

    if codes:
        part(0, len(codes), start, goal)
    return "".join(out)


def applied(edits: str, rows: list[tuple[str, str]], state: int) -> tuple[list[str], int]:
    """``role:text`` lines that the edits leave, and the state after them."""
    lines, left = [], iter(rows)
    for edit in edits:
        if edit == "I":
            initial, role, text = DUE[state], ROLE[DUE[state]], ""
        else:
            role, text = next(left)
            if edit == "D":
                continue
            initial = role[0] if edit == "K" else DUE[state]
            role = role if edit == "K" else ROLE[initial]
        lines.append(f"{role}:{text}")
        state = AFTER[initial]
    return lines, state


def fault_of(text: str, seen: bool) -> str | None:
    body = text.strip(SPACE)
    if not body:
        return "blank"
    if seen:
        return "duplicate"
    return None if body[-1] in ".!?" else "truncated"


FAULTS = {None: FINE, "truncated": TRUNCATED, "blank": GONE, "duplicate": GONE}
LEGAL = {"su", "ua", "au"}


def illegal(rows: list[tuple[str, str]]) -> int:
    return sum(a[0][:1] + b[0][:1] not in LEGAL for a, b in zip(rows, rows[1:], strict=False))


def cost_of(edits: str, faults: list) -> int:
    left = iter(faults)
    return sum({"I": 2, "D": 3, "R": 2, "K": 0}[e] + (e != "I" and next(left) == "truncated" and e != "D") for e in edits)


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def repaired(rows: list[tuple]) -> tuple:
    """``COUNTS``, audit and repaired text of one conversation's ordered (turn, role,
    text) rows; no line at all is a null text."""
    turns = {turn for turn, _, _ in rows if turn is not None}
    seen: set = set()
    faults, codes, plain = [], bytearray(), []
    for _, role, text in rows:
        fault = fault_of(text, (role, text) in seen)
        seen.add((role, text))
        faults.append(fault)
        codes.append(code(role[:1], FAULTS[fault]))
        plain.append((role, text))
    edits = script(bytes(codes), NONE, GOAL)
    lines, state = applied(edits, plain, NONE)
    closing = CLOSING[state]
    lines += applied(closing, [], state)[0]
    edits += closing
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal(plain),
            cost_of(edits, faults), edits, "\n".join(lines) if lines else None)


def damaged(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turn, role, text, copies`` after damage by crc32 of ``conv_id:turn`` modulo
    20; a dropped row stays with 0 copies, so that its conversation is known."""
    def shown(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown(id_col), F.lit(":"), shown(turn_col)).cast("binary")) % 20
    rows = df.select(F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"), shown(role_col).alias("role"),
                     shown(text_col).alias("text"), kind.alias("kind"))
    text = (F.when(F.col("kind").isin(0, 1), F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    return rows.select("conv_id", "turn", *[F.when(F.col("kind") != 0, c).alias(name) for c, name in ((role, "role"), (text, "text"))],
                       F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("copies"))


def _order() -> list:
    return [F.col("turn").asc_nulls_first(), "role", "text"]


def _short(rows: DataFrame) -> DataFrame:
    """One row per conversation, from rows sorted within partitions."""
    schema = T.StructType([id_field(rows, "conv_id", "conv_id"), *[T.StructField(c, T.LongType()) for c in COUNTS],
                           T.StructField("audit", T.StringType()), T.StructField("repaired", T.StringType())])

    def run(batches):
        held: list = []
        current, begun = None, False

        def columns(out):
            ids, results = [i for i, _ in out], [r for _, r in out]
            cols = list(zip(*results, strict=True))
            return pa.record_batch([pa.array(ids, id_type), *[pa.array(c, pa.int64()) for c in cols[:6]],
                                    *[pa.array(c, pa.string()) for c in cols[6:]]], names=schema.names)

        id_type, done, size = None, [], 0
        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for conv, turn, role, text, copies in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "copies")], strict=True):
                if not begun or conv != current:
                    if begun:
                        done.append((current, repaired(held)))
                        size += len(done[-1][1][-1] or "")
                    held, current, begun = [], conv, True
                    if size > 4 << 20 or len(done) >= 4096:
                        yield columns(done)
                        done, size = [], 0
                held += [(turn, role, text)] * copies
        if begun:
            done.append((current, repaired(held)))
        if done:
            yield columns(done)

    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", *_order())
    return dealt.mapInArrow(tidied(run), schema)


def _blocks(rows: DataFrame, block: int) -> DataFrame:
    """Rows of long conversations in order: ``at`` rises along the whole table, ``block``
    cuts it; equal rows are one row with their number of copies, ``again`` is true where
    an earlier turn has the same role and text."""
    once = rows.where(F.col("copies") > 0).groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    earlier = Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    marked = once.withColumn("again", F.row_number().over(earlier) > 1)
    dealt = marked.repartitionByRange(F.col("conv_id"), *_order()).sortWithinPartitions("conv_id", *_order())
    return stored(dealt.withColumn("at", F.monotonically_increasing_id()).withColumn("block", F.floor(F.col("at") / block)), "conversation-rows")


def _unfolded(table: pa.Table) -> list[tuple]:
    """(turn, role, text, fault) of a block's rows, copies spelt out."""
    out = []
    for turn, role, text, copies, again in zip(*[table.sort_by("at").column(c).to_pylist() for c in ("turn", "role", "text", "copies", "again")],
                                               strict=True):
        out.append((turn, role, text, fault_of(text, again)))
        out += [(turn, role, text, fault_of(text, True))] * (copies - 1)
    return out


def _codes(rows: list[tuple]) -> bytes:
    return bytes(code(role[:1], FAULTS[fault]) for _, role, _, fault in rows)


SUMMARY = ["blank", "duplicate", "truncated", "illegal", "turns"]


def _summary(rows: list[tuple]) -> dict:
    faults, turns = [r[3] for r in rows], [r[0] for r in rows if r[0] is not None]
    codes = _codes(rows)
    return {**{c: faults.count(c) for c in SUMMARY[:3]}, "illegal": illegal([r[1:3] for r in rows]), "turns": len(set(turns)),
            "low": turns[0] if turns else None, "high": turns[-1] if turns else None,
            "first": rows[0][1][:1], "last": rows[-1][1][:1], "vectors": [v for s in STATES for v in forward(codes, s)]}


def joined(at: list[int], vectors: list[int]) -> list[int]:
    """Forward vector after a block, from the one before it and the block's four."""
    found = []
    for t in STATES:
        reach = [((at[s] >> SHIFT) + (vectors[4 * s + t] >> SHIFT), at[s] & LOW, vectors[4 * s + t] & LOW)
                 for s in STATES if at[s] < UNREACHED and vectors[4 * s + t] < UNREACHED]
        found.append(min(reach, default=None))
    order = sorted(f[1:] for f in found if f)
    return [UNREACHED if f is None else f[0] << SHIFT | order.index(f[1:]) << SCRIPT_BITS for f in found]


def _borders(blocks: list[dict]) -> tuple[list, list[tuple[int, int]]]:
    """Counts of a conversation from its blocks' summaries, and (start, end) of each
    block; the end of the last one is its state before the closing turns."""
    at = [0, UNREACHED, UNREACHED, UNREACHED]
    before = []
    for b in blocks:
        before.append(at)
        at = joined(at, b["vectors"])
    end = crossing(at, GOAL)
    cost, ends = (at[end] >> SHIFT) + GOAL[end], []
    for vector, b in zip(reversed(before), reversed(blocks), strict=True):
        to = [(b["vectors"][4 * s + end] >> SHIFT) for s in STATES]
        start = crossing(vector, to)
        ends.append((start, end))
        end = start
    counts = {c: sum(b[c] for b in blocks) for c in SUMMARY}
    counts["illegal"] += sum(a["last"] + b["first"] not in LEGAL for a, b in zip(blocks, blocks[1:], strict=False))
    known = [b for b in blocks if b["turns"]]
    turns = counts["turns"] - sum(a["high"] == b["low"] for a, b in zip(known, known[1:], strict=False))
    gaps = known[-1]["high"] - known[0]["low"] + 1 - turns if known else 0
    return [gaps, *[counts[c] for c in SUMMARY[:4]], cost], ends[::-1]


def _long(rows: DataFrame, block: int) -> DataFrame:
    """``conv_id, block``, counts, audit and repaired text of each block; the counts of
    the conversation stand in every block."""
    own, turn = id_field(rows, "conv_id", "conv_id"), rows.schema["turn"].dataType
    lines = _blocks(rows, block)
    block_field = T.StructField("block", T.LongType())
    summary_schema = T.StructType([own, block_field, *[T.StructField(c, T.LongType()) for c in SUMMARY],
                                   T.StructField("low", turn), T.StructField("high", turn), T.StructField("first", T.StringType()),
                                   T.StructField("last", T.StringType()), T.StructField("vectors", T.ArrayType(T.LongType()))])
    border_schema = T.StructType([T.StructField("of", own.dataType), T.StructField("part", T.LongType()), *[T.StructField(c, T.LongType()) for c in COUNTS],
                                  T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("closes", T.BooleanType())])
    piece_schema = T.StructType([own, block_field, *[T.StructField(c, T.LongType()) for c in COUNTS],
                                 T.StructField("audit", T.StringType()), T.StructField("repaired", T.StringType())])

    def as_table(data: list[dict], schema: pa.Schema) -> pa.Table:
        return pa.Table.from_pylist(data, schema=schema)

    from pyspark.sql.pandas.types import to_arrow_schema
    arrow_summary, arrow_border, arrow_piece = map(to_arrow_schema, (summary_schema, border_schema, piece_schema))

    def summarise(table: pa.Table) -> pa.Table:
        row = {"conv_id": table.column("conv_id")[0].as_py(), "block": table.column("block")[0].as_py()}
        return as_table([row | _summary(_unfolded(table))], arrow_summary)

    def meet(table: pa.Table) -> pa.Table:
        blocks = table.sort_by("block").to_pylist()
        counts, ends = _borders(blocks)
        return as_table([{"of": b["conv_id"], "part": b["block"], **dict(zip(COUNTS, counts, strict=True)), "start": s, "end": e,
                          "closes": i == len(blocks) - 1} for i, (b, (s, e)) in enumerate(zip(blocks, ends, strict=True))], arrow_border)

    def recurse(table: pa.Table, border: pa.Table) -> pa.Table:
        known, rows = border.to_pylist()[0], _unfolded(table)
        edits = script(_codes(rows), known["start"], only(known["end"]))
        lines, state = applied(edits, [r[1:3] for r in rows], known["start"])
        if known["closes"]:
            lines += applied(CLOSING[state], [], state)[0]
            edits += CLOSING[state]
        return as_table([{"conv_id": known["of"], "block": known["part"], **{c: known[c] for c in COUNTS}, "audit": edits,
                          "repaired": "\n".join(lines) if lines else None}], arrow_piece)

    summaries = lines.groupBy("conv_id", "block").applyInArrow(tidied_group(summarise), summary_schema)
    borders = stored(summaries.groupBy("conv_id").applyInArrow(tidied_group(meet), border_schema), "conversation-borders")
    return (lines.groupBy("conv_id", "block").cogroup(borders.groupBy("of", "part"))
            .applyInArrow(tidied_group(recurse), piece_schema))


def _digested(pieces: DataFrame) -> DataFrame:
    """One row per long conversation: its audit, and the digest of its repaired text as a
    stream of blocks in order."""
    schema = T.StructType([id_field(pieces, "conv_id", "conv_id"), *[T.StructField(c, T.LongType()) for c in COUNTS],
                           T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])

    def run(batches):
        current = None

        def closed(held):
            conv, counts, audit, digest, _ = held
            return pa.record_batch([pa.array([conv], id_type), *[pa.array([c], pa.int64()) for c in counts],
                                    pa.array(["".join(audit)]), pa.array([digest.hexdigest()])], names=schema.names)

        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for row in batch.to_pylist():
                if current is None or row["conv_id"] != current[0]:
                    if current is not None:
                        yield closed(current)
                    current = [row["conv_id"], [row[c] for c in COUNTS], [], hashlib.sha256(), False]
                current[2].append(row["audit"])
                if row["repaired"] is not None:
                    current[3].update((("\n" if current[4] else "") + row["repaired"]).encode())
                    current[4] = True
        if current is not None:
            yield closed(current)

    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(tidied(run), schema)


def _dealt(rows: DataFrame, long_rows: int, long_bytes: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of short conversations, and of long ones if there are any."""
    sizes = rows.groupBy(F.col("conv_id").alias("of")).agg(F.sum("copies").alias("n"), F.sum(F.octet_length("text") * F.col("copies")).alias("bytes"))
    found = stored(sizes.where((F.col("n") > long_rows) | (F.col("bytes") > long_bytes)).select("of"), "long-conversations")
    if found.isEmpty():
        return rows, None
    same = rows["conv_id"].eqNullSafe(found["of"])
    return rows.join(found, same, "left_anti"), rows.join(found, same, "left_semi")


def repaired_pieces(rows: DataFrame, long_rows: int = LONG, long_bytes: int = LONG_BYTES, block: int = BLOCK) -> DataFrame:
    """Repaired conversations of ``conv_id, turn, role, text, copies`` rows: ``conv_id,
    block``, counts, ``audit`` and ``repaired`` (``role:text`` lines).  A short conversation
    is one row, a long one a row for each block in order."""
    short, long = _dealt(rows, long_rows, long_bytes)
    out = _short(short).withColumn("block", F.lit(0).cast("long"))
    return out if long is None else out.unionByName(_long(long, block))


def conversation_repairs(rows: DataFrame, long_rows: int = LONG, long_bytes: int = LONG_BYTES, block: int = BLOCK) -> DataFrame:
    """One row per conversation: counts, audit and the digest of the repaired text."""
    short, long = _dealt(rows, long_rows, long_bytes)
    out = _short(short).withColumn("repaired_sha256", F.sha2(F.coalesce("repaired", F.lit("")), 256)).drop("repaired")
    return out if long is None else out.unionByName(_digested(_long(long, block)))
