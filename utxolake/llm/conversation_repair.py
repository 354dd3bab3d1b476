"""Structure repair of conversations at least cost, with the ASCII-least audit.

A repaired conversation's role initials read ``(s?(ua)+)?``. Each message is kept (K, 0),
given the role user or assistant (R, 3) or deleted (D, 4; required where it is blank or
repeats an earlier role and text); a message not deleted that doesn't end in ``.``, ``!`` or
``?`` adds 3; empty messages of user or assistant are inserted anywhere (I, 3).

A conversation is a grid of nodes: a layer before each message and one at the end, four
states each (nothing yet, after s, after u, after a). Dynamic programming from the end
gives every node its least cost, and the arcs that reach it. Nodes of the optimal arcs are
ranked by their least audits of length 1, 2, 4, ...: a node's rank at twice the length is
the rank of the pair (own rank, rank of the node its pointer leads to), and its pointer is
followed twice. A node's optimal arcs bear different letters, so one pointer a node is
enough. At the end each node takes the arc of least letter and rank, and the audit of a
conversation is read off the doubled pointers, all conversations of a batch at once.

Messages are dealt by range of conversation and turn, so that a conversation of any length is
spread over tasks. A task solves those that lie inside its range and hold ``BLOCK_ROWS``
messages at most; all others go on as blocks. A block's costs form a 4 x 4 matrix (entry state
x exit state); the matrices of a conversation give each block the costs behind it, with which
it finds audit and exit of every entry state; these in turn tell its entry state. Only the
digest of a repaired conversation, and its audit, are put together by one task, in a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from utxolake.llm.common import stored

BLOCK_ROWS, BLOCK_BYTES = 16_384, 8 << 20
#: Messages of whole conversations that are solved together.
BATCH_ROWS = 8_192

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLANKS = " \t\n\v\f\r"
NONE, BLANK, DUPLICATE, CUT = range(4)
START, AFTER_S, AFTER_U, AFTER_A = range(4)
INITIALS = {"s": 1, "u": 2, "a": 3}
#: Neighbours' initials that are in order.
LEGAL = ((1, 2), (2, 3), (3, 2))
#: State after a kept message, by state and initial (other, s, u, a); -1: not allowed.
KEPT = np.array([[-1, AFTER_S, AFTER_U, -1], [-1, -1, AFTER_U, -1], [-1, -1, -1, AFTER_A], [-1, -1, AFTER_U, -1]])
#: State after a message whose role is chosen.
NEXT = np.array([AFTER_U, AFTER_U, AFTER_A, AFTER_U])
ROLE = {AFTER_U: "user", AFTER_A: "assistant"}
#: Costs and inserts that end a conversation, by state.
END_COST, END_AUDIT = (0, 2 * INSERT, INSERT, 0), ("", "II", "I", "")
FAR = 1 << 50


def code_of(role: str, fault: int) -> int:
    return 4 * fault + INITIALS.get(role[:1], 0)


def fault_of(text: str, seen: bool) -> int:
    last = text.rstrip(BLANKS)[-1:]
    return BLANK if not last else DUPLICATE if seen else NONE if last in ".!?" else CUT


def least_costs(codes: bytes, end: Iterable[int]) -> list[tuple[int, int, int, int]]:
    """Least cost from every layer and state, given those of the layer behind the last message. No inserts in that one."""
    c0, c1, c2, c3 = end
    out = [(c0, c1, c2, c3)]
    for code in reversed(codes):
        fault, initial = code >> 2, code & 3
        b0, b1, b2, b3 = c0 + DELETE, c1 + DELETE, c2 + DELETE, c3 + DELETE
        if fault in (NONE, CUT):
            keep = TRUNCATED if fault == CUT else 0
            to_u, to_a = keep + c2 + (0 if initial == 2 else REROLE), keep + c3 + (0 if initial == 3 else REROLE)
            b0, b1, b2, b3 = min(b0, to_u), min(b1, to_u), min(b2, to_a), min(b3, to_u)
            if initial == 1:
                b0 = min(b0, keep + c1)
        c2 = min(b2, b3 + INSERT)
        c0, c1, c3 = min(b0, c2 + INSERT), min(b1, c2 + INSERT), min(b3, b2 + INSERT)
        out.append((c0, c1, c2, c3))
    out.reverse()
    return out


def _optimal_arcs(codes: np.ndarray, cost: np.ndarray, last: np.ndarray) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(letter, whether the node has such an optimal arc, its target) in ASCII order. ``last`` marks exit layers, whose codes don't count."""
    n = len(codes)
    layer, state = np.arange(n)[:, None], np.arange(4)[None, :]
    behind = np.concatenate([cost[1:], np.full((1, 4), FAR)])
    fault, initial = codes >> 2, codes & 3
    inside = ~last[:, None]
    free = inside & np.isin(fault, (NONE, CUT))[:, None]
    keep = np.where(fault == CUT, TRUNCATED, 0)[:, None]
    kept = KEPT[:, initial].T
    delete = inside & (cost == behind + DELETE)
    insert = inside & (cost == cost[:, NEXT] + INSERT)
    keeping = free & (kept >= 0) & (cost == keep + np.take_along_axis(behind, np.maximum(kept, 0), axis=1))
    rerole = free & (cost == keep + REROLE + behind[:, NEXT])
    reachable = cost < FAR
    return [
        ("D", (delete & reachable).ravel(), (4 * (layer + 1) + state).ravel()),
        ("I", (insert & reachable).ravel(), (4 * layer + NEXT[state]).ravel()),
        ("K", (keeping & reachable).ravel(), (4 * (layer + 1) + kept).ravel()),
        ("R", (rerole & reachable).ravel(), (4 * (layer + 1) + NEXT[state]).ravel()),
    ]


def _least_arcs(arcs, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per node the optimal arc of least (letter, rank of its target): arc number from 1 (0: none), letter, target."""
    n = len(rank)
    best, number, letter, target = np.full(n, np.iinfo(np.int64).max), np.zeros(n, np.int64), np.zeros(n, np.uint8), np.arange(n)
    for k, (name, there, to) in enumerate(arcs, 1):
        to = np.where(there, to, 0)
        key = ord(name) * (n + 1) + rank[to]
        better = there & (key < best)
        best[better], number[better], letter[better], target[better] = key[better], k, ord(name), to[better]
    return number, letter, target


def least_audits(codes: list[bytes], ends: list[Iterable[int]], entries: list[list[int]]) -> list[list[tuple[str, int]]]:
    """For each block of codes, with the costs behind it, and each of its entry states: (least audit, exit state)."""
    lengths = np.array([len(c) + 1 for c in codes])
    stop = np.cumsum(lengths)
    flat = np.frombuffer(b"".join(c + b"\0" for c in codes), np.uint8).astype(np.int64)
    cost = np.array([layer for c, e in zip(codes, ends, strict=True) for layer in least_costs(c, e)], np.int64)
    last = np.zeros(len(flat), bool)
    last[stop - 1] = True
    arcs = _optimal_arcs(flat, cost, last)
    rank, _, pointer = _least_arcs(arcs, np.zeros(4 * len(flat), np.int64))  # audits of one letter
    doubled = [pointer]
    starts = np.array([4 * (s - n) + e for s, n, own in zip(stop, lengths, entries, strict=True) for e in own], np.int64)
    while not last[pointer[starts] // 4].all():
        rank = np.unique(rank * (int(rank.max()) + 1) + rank[pointer], return_inverse=True)[1]
        pointer = pointer[pointer]
        doubled.append(pointer)
    _, letter, chosen = _least_arcs(arcs, rank)
    path = starts[:, None]
    doubled[0] = chosen
    for p in doubled:
        path = np.concatenate([path, p[path]], axis=1)
    exits = (path[:, -1] % 4).tolist()
    found = [(row.tobytes().rstrip(b"\0").decode(), x) for row, x in zip(letter[path], exits, strict=True)]
    at = np.cumsum([0, *map(len, entries)])
    return [found[lo:hi] for lo, hi in zip(at, at[1:], strict=False)]


def apply_audit(audit: str, state: int, messages: Iterable[tuple[str, str]]) -> list[tuple[str, str]]:
    """The repaired messages of one block, entered in ``state``."""
    out, rest = [], iter(messages)
    for edit in audit:
        if edit == "I":
            state = int(NEXT[state])
            out.append((ROLE[state], ""))
            continue
        role, text = next(rest)
        if edit == "K":
            state = int(KEPT[state][INITIALS[role[:1]]])
            out.append((role, text))
        elif edit == "R":
            state = int(NEXT[state])
            out.append((ROLE[state], text))
    return out


def _lines(messages: list[tuple[str, str]]) -> bytes:
    return "\n".join([f"{role}:{text}" for role, text in messages]).encode("utf-8", "surrogatepass")


def _illegal(codes: bytes) -> int:
    initials = [c & 3 for c in codes]
    return sum(pair not in LEGAL for pair in zip(initials, initials[1:], strict=False))


class _Messages:
    """Messages of one conversation, or of a block of it."""

    def __init__(self, conv):
        self.conv, self.turns, self.rows, self.bytes = conv, [], [], 0

    def add(self, turn, role, text, copies):
        self.turns += [turn] * copies
        self.rows += [(role, text)] * copies
        self.bytes += copies * len(text)

    def codes(self) -> bytes:
        seen, out = set(), bytearray()
        for row in self.rows:
            out.append(code_of(row[0], fault_of(row[1], row in seen)))
            seen.add(row)
        return bytes(out)

    def turn_bounds(self) -> tuple:
        turns = [t for t in self.turns if t is not None]
        return (turns[0], turns[-1], len(set(turns))) if turns else (None, None, 0)


def _counts(codes: bytes) -> list[int]:
    return [sum(c >> 2 == fault for c in codes) for fault in (BLANK, DUPLICATE, CUT)]


class Repaired(NamedTuple):
    #: One row per conversation.
    conversations: DataFrame
    #: Repaired messages: conversation, ``part`` and ``block`` (order of the pieces of a split conversation), ``messages`` (array of role and text).
    messages: DataFrame | None


def damage(conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Faults by crc32 of ``conv:turn`` modulo 20, nulls being one space: 0 drops the message (``copies`` 0), 1 empties its text,
    2 takes ``.``, ``!`` and ``?`` out of it, 3 doubles it (``copies`` 2), 4 makes its role user."""
    conv, turn, role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv_col, turn_col, role_col, text_col))
    kind = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    return conversations.select(
        F.col(conv_col), F.col(turn_col), F.when(kind == 4, "user").otherwise(role).alias(role_col),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias(text_col), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def repair(
    rows: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    copies_col: str | None = None, block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES, with_messages: bool = False,
) -> Repaired:
    """Repair every conversation.

    ``conversations`` holds the id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 (of ``role:text``
    lines of the repaired messages). A conversation's messages are taken by turn, nulls first; messages of one turn by role
    and text. Null role or text counts as one space. ``copies_col`` tells how often a message stands there: with 0 it doesn't,
    but its conversation has a result (zeros, empty audit, digest of the empty string). Messages without a conversation
    id form one conversation. Extra columns are ignored; an empty table gives no rows. Messages in different
    blocks count as equal if 128-bit digests of conversation, role and text agree.
    """
    spark = rows.sparkSession
    conv_type = rows.schema[conv_col].dataType
    copies = F.col(copies_col).cast("int") if copies_col else F.lit(1)
    there = copies > 0
    space = F.lit(" ")
    ordered = rows.select(
        F.col(conv_col).alias("conv"), F.when(there, F.col(turn_col).cast("long")).alias("turn"), F.when(there, F.coalesce(F.col(role_col).cast("string"), space)).alias("role"),
        F.when(there, F.coalesce(F.col(text_col).cast("string"), space)).alias("text"), copies.alias("copies"),
    )
    ordered = ordered.repartitionByRange("conv", "turn", "role", F.xxhash64("text")).sortWithinPartitions("conv", "turn", "role", "text")

    totals = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    pairs = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))
    schema = _schema(conv_type, "part int, block int", longs=[*totals, "first_turn", "last_turn", "turns"], rest="audit string, repaired_sha256 string, codes binary, digests array<binary>")
    schema = schema.add("messages", pairs)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, own, edge, pending, n_pending = TaskContext.get().partitionId(), 0, None, True, [], 0

        def as_block(m: _Messages) -> pa.RecordBatch:
            nonlocal block
            block += 1
            first, last, n = m.turn_bounds()
            digests = sorted({_digest(m.conv, row) for row in m.rows})
            return _batch(schema, [{"conv": m.conv, "part": part, "block": block, "first_turn": first, "last_turn": last, "turns": n, "codes": m.codes(), "digests": digests, "messages": _pairs(m.rows)}])

        for batch in batches:
            for conv, turn, role, text, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own is None:
                    own = _Messages(conv)
                elif conv != own.conv:
                    if edge:
                        yield as_block(own)
                    else:
                        pending.append(own)
                        n_pending += len(own.rows) + 1
                        if n_pending >= BATCH_ROWS:
                            yield _batch(schema, _solve_whole(pending, totals, with_messages))
                            pending, n_pending = [], 0
                    own, edge = _Messages(conv), False
                while n > 0:  # a message may stand there more often than a block holds
                    room = min(n, max(1, block_rows - len(own.rows)))
                    own.add(turn, role, text, room)
                    n -= room
                    if len(own.rows) >= block_rows or own.bytes >= block_bytes:
                        yield as_block(own)
                        own, edge = _Messages(conv), True
        if pending:
            yield _batch(schema, _solve_whole(pending, totals, with_messages))
        if own is not None:
            yield as_block(own)

    solved = stored(ordered.mapInArrow(task, schema), "conversations")
    whole, blocks = solved.where(F.col("block").isNull()), solved.where(F.col("block").isNotNull())
    split, split_messages = _split_conversations(blocks, conv_type, totals, pairs)
    conversations = whole.select("conv", *totals, "audit", "repaired_sha256").unionByName(split).withColumnRenamed("conv", conv_col)
    messages = whole.select("conv", "part", "block", "messages").unionByName(split_messages).withColumnRenamed("conv", conv_col) if with_messages else None
    return Repaired(conversations, messages)


def _schema(conv_type: T.DataType, first: str, longs: Iterable[str] = (), rest: str = "") -> T.StructType:
    """conv, then the columns named."""
    ddl = ", ".join(filter(None, [first, *(f"{n} bigint" for n in longs), rest]))
    return T.StructType([T.StructField("conv", conv_type), *T._parse_datatype_string(ddl).fields])


def _batch(schema: T.StructType, records: list[dict]) -> pa.RecordBatch:
    arrow = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in records], f.type) for f in arrow], schema=arrow)


def _digest(conv, row: tuple[str, str]) -> bytes:
    return hashlib.blake2b(repr((conv, *row)).encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _pairs(messages: Iterable[tuple[str, str]]) -> list[dict]:
    return [{"role": role, "text": text} for role, text in messages]


def _solve_whole(group: list[_Messages], totals: list[str], with_messages: bool) -> list[dict]:
    """Results of whole conversations; those of about one length share a path matrix."""
    classes: dict[int, list[tuple[_Messages, bytes]]] = {}
    for m in group:
        classes.setdefault(len(m.rows).bit_length(), []).append((m, m.codes()))
    records = []
    for own in classes.values():
        codes = [c for _, c in own]
        for (m, c), [(audit, state)] in zip(own, least_audits(codes, [END_COST] * len(codes), [[START]] * len(codes)), strict=True):
            done, (lo, hi, n), cost = apply_audit(audit + END_AUDIT[state], START, m.rows), m.turn_bounds(), least_costs(c, END_COST)[0][START]
            record = dict(zip(totals, [hi - lo + 1 - n if n else 0, *_counts(c), _illegal(c), cost], strict=True))
            record |= {"conv": m.conv, "audit": audit + END_AUDIT[state], "repaired_sha256": hashlib.sha256(_lines(done)).hexdigest()}
            records.append(record | {"messages": _pairs(done) if with_messages else None})
    return records


def _split_conversations(blocks: DataFrame, conv_type: T.DataType, totals: list[str], pairs: T.DataType) -> tuple[DataFrame, DataFrame]:
    """Results of conversations that came as blocks, and their repaired messages by block."""
    key = ["part", "block"]  # names a block of any conversation
    place = F.struct(*key)
    seen = blocks.select(*key, F.explode("digests").alias("digest"))
    first = seen.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    later = seen.join(first, "digest").where(place > F.col("first")).groupBy(*key).agg(F.collect_list("digest").alias("later"))

    counted = ["first_turn", "last_turn", "turns", "blank", "duplicate", "truncated", "illegal"]
    matrix_schema = _schema(conv_type, "part int, block int", counted, "codes binary, matrix array<bigint>")

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                codes, again = bytearray(r["codes"]), set(r["later"] or ())
                for i, m in enumerate(r["messages"] if again else ()):
                    if codes[i] >> 2 in (NONE, CUT) and _digest(r["conv"], (m["role"], m["text"])) in again:
                        codes[i] = 4 * DUPLICATE + (codes[i] & 3)
                codes = bytes(codes)
                by_exit = [least_costs(codes, [0 if s == x else FAR for s in range(4)])[0] for x in range(4)]
                counts = dict(zip(("blank", "duplicate", "truncated"), _counts(codes), strict=True))
                out.append(r | counts | {"codes": codes, "illegal": _illegal(codes), "matrix": [min(by_exit[x][s], FAR) for s in range(4) for x in range(4)]})
            yield _batch(matrix_schema, out)

    rows = blocks.select("conv", *key, "first_turn", "last_turn", "turns", "codes", "messages").join(later, key, "left")
    matrix = stored(rows.mapInArrow(matrices, matrix_schema), "blocks")

    end_schema = _schema(conv_type, "part int, block int", ["cost"], "behind array<bigint>")

    def costs_behind(table: pa.Table) -> pa.Table:
        out, behind = [], list(END_COST)
        for r in sorted(table.to_pylist(), key=lambda r: (r["part"], r["block"]), reverse=True):
            out.append({"conv": r["conv"], "part": r["part"], "block": r["block"], "behind": behind})
            behind = [min(min(r["matrix"][4 * s + x] + behind[x] for x in range(4)), FAR) for s in range(4)]
            out[-1]["cost"] = behind[START]  # of the conversation, in its first block
        return pa.Table.from_batches([_batch(end_schema, out)])

    ends = matrix.select("conv", *key, "matrix").groupBy("conv").applyInArrow(costs_behind, end_schema)

    audit_schema = _schema(conv_type, "part int, block int", [*counted, "cost"], "first_code int, last_code int, exits array<int>, audits array<string>")

    def block_audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                [found] = least_audits([r["codes"]], [r["behind"]], [[s for s in range(4)]])
                edges = {"first_code": r["codes"][0] & 3, "last_code": r["codes"][-1] & 3} if r["codes"] else {}
                yield _batch(audit_schema, [r | edges | {"exits": [x for _, x in found], "audits": [a for a, _ in found]}])

    audits = stored(matrix.drop("matrix").join(ends.drop("conv"), key).mapInArrow(block_audits, audit_schema), "audits")

    entry_schema = _schema(conv_type, "part int, block int, entry int, last boolean", totals)

    def entries(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (r["part"], r["block"]))
        out, state, code, turn, first_turn, turns = [], START, None, None, None, 0
        total = dict.fromkeys(totals, 0) | {"cost": rows[0]["cost"]}
        for r in rows:
            out.append({"conv": r["conv"], "part": r["part"], "block": r["block"], "entry": state, "last": False})
            state = r["exits"][state]
            for n in ("blank", "duplicate", "truncated", "illegal"):
                total[n] += r[n]
            if r["first_code"] is not None:
                total["illegal"] += code is not None and (code, r["first_code"]) not in LEGAL
                code = r["last_code"]
            if r["turns"]:
                turns += r["turns"] - (turn == r["first_turn"])
                first_turn, turn = r["first_turn"] if first_turn is None else first_turn, r["last_turn"]
        total["gaps"] = turn - first_turn + 1 - turns if turns else 0
        out[-1] |= total | {"last": True}
        return pa.Table.from_batches([_batch(entry_schema, out)])

    steps = ["conv", *key, *counted, "cost", "first_code", "last_code", "exits"]
    entered = audits.select(*steps).groupBy("conv").applyInArrow(entries, entry_schema).drop("conv")
    chosen = audits.select(*key, "exits", "audits").join(entered, key)
    chosen = chosen.select(*key, "entry", "last", *totals, F.get("audits", "entry").alias("audit"), F.get("exits", "entry").alias("exit"))
    piece_schema = _schema(conv_type, "part int, block int", totals, "audit string, n_lines int, lines binary").add("messages", pairs)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                audit = r["audit"] + (END_AUDIT[r["exit"]] if r["last"] else "")
                done = apply_audit(audit, r["entry"], [(m["role"], m["text"]) for m in r["messages"]])
                yield _batch(piece_schema, [r | {"audit": audit, "n_lines": len(done), "lines": _lines(done), "messages": _pairs(done)}])

    repaired = stored(blocks.select("conv", *key, "messages").join(chosen, key).mapInArrow(pieces, piece_schema), "pieces")
    result_schema = _schema(conv_type, "", totals, "audit string, repaired_sha256 string")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces in order of conversation, part and block; the bytes of one piece are held at a time."""
        sha, audit, any_line, before = hashlib.sha256(), [], False, None

        def result() -> pa.RecordBatch:
            return _batch(result_schema, [before | {"audit": "".join(audit), "repaired_sha256": sha.hexdigest()}])

        for batch in batches:
            for r in batch.to_pylist():
                if before is not None and before["conv"] != r["conv"]:
                    yield result()
                    sha, audit, any_line = hashlib.sha256(), [], False
                if r["n_lines"]:
                    sha.update((b"\n" if any_line else b"") + r["lines"])
                    any_line = True
                audit.append(r["audit"])
                before = {n: r[n] for n in ("conv", *totals)}  # the last block's row has the totals
        if before is not None:
            yield result()

    in_order = repaired.drop("messages").repartition("conv").sortWithinPartitions("conv", *key)
    return in_order.mapInArrow(digest, result_schema), repaired.select("conv", *key, "messages")
