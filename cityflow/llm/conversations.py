"""Repair of damaged conversations by lightest derivations.

A repaired conversation reads `(system? (user assistant)+)?` by the initials of its roles.
Items are boundaries between rows with the state of that automaton; the weight of an item is
the lightest way to finish the conversation from there. An edit of a row is an axiom with a
weight, and a deduction has two antecedents: the edit and the item behind it (an inserted
turn has the item alone). Knuth's agenda (1977) pops items in order of weight, and a popped
item is final. Weights are (cost, steps, audit): a deduction puts its edit in front of the
audit and never makes cost plus steps smaller, so its function is superior, and of two audits
the smaller stays so with the same letter before both, so it is monotone.

Rows are sorted by range partitions. A conversation inside one partition and one chunk is
solved there; of others each chunk yields its lightest derivation from every state to every
state, a table of 16 axioms at most, and tables are joined by the same agenda in a tree of
`FAN_IN` chunks a node. So no task holds more than a chunk of texts, and a conversation with
a third of all rows is spread like the others.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from hashlib import sha256
from heapq import heappop, heappush
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from cityflow.llm.common import saved

CHUNK_ROWS = 256
CHUNK_CHARS = 1_000_000
FAN_IN = 32

# States by what was last said: nothing, a system turn, a user turn, an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {
    "s": {START: SYSTEM},
    "u": {START: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
}
COMPLETE = (START, ASSISTANT)
LEGAL = ("su", "ua", "au")
NAMES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
TRUNCATED = 1
_BLANKS = " \t\n\v\f\r"

Arc = tuple[int, int, int, str]  # from state, to state, cost, audit


class Row(NamedTuple):
    """Equal rows of one turn: the first has the fault, the further copies are duplicates."""

    role: str
    text: str
    seen: bool
    copies: int

    def fault(self) -> str:
        end = self.text.rstrip(_BLANKS)[-1:]
        if not end:
            return "blank"
        if self.seen:
            return "duplicate"
        return "" if end in ".!?" else "truncated"

    def arcs(self) -> list[Arc]:
        """The edits of this row and its copies, which are all deleted."""
        more, tail = DELETE * (self.copies - 1), "D" * (self.copies - 1)
        out = [(state, state, DELETE + more, "D" + tail) for state in range(4)]
        fault, own = self.fault(), self.role[:1]
        if fault in ("blank", "duplicate"):
            return out
        more += TRUNCATED if fault else 0
        out += [(q, r, KEEP + more, "K" + tail) for q, r in AFTER.get(own, {}).items()]
        for initial in NAMES:
            if initial != own:
                out += [(q, r, REROLE + more, "R" + tail) for q, r in AFTER[initial].items()]
        return out


_INSERTS = [(state, to) for initial in NAMES for state, to in AFTER[initial].items()]


def lightest(
    steps: Sequence[Iterable[Arc]],
    ends: Iterable[int],
    goals: Iterable[int],
    before_steps: bool,
    at_end: bool,
) -> dict[int, tuple[int, str]]:
    """(cost, audit) of the lightest derivation from each of the goal states before the first
    step to one of `ends` after the last. Turns may be inserted before each step and at the
    end. The agenda stops when the goals are final."""
    into: list[dict[int, list[Arc]]] = []
    for arcs in steps:
        by_end: dict[int, list[Arc]] = {}
        for arc in arcs:
            by_end.setdefault(arc[1], []).append(arc)
        into.append(by_end)
    last, wanted = len(steps), set(goals)
    agenda = [(0, 0, "", state) for state in ends]
    final: set[tuple[int, int]] = set()
    found: dict[int, tuple[int, str]] = {}
    while agenda and wanted:
        cost, done, audit, state = heappop(agenda)
        if (done, state) in final:
            continue
        final.add((done, state))
        if done == last and state in wanted:
            wanted.remove(state)
            found[state] = (cost, audit)
        if before_steps and done or at_end and not done:
            for origin, to in _INSERTS:
                if to == state:
                    heappush(agenda, (cost + INSERT, done, "I" + audit, origin))
        if done < last:
            for origin, _, more, edits in into[last - 1 - done].get(state, ()):
                heappush(agenda, (cost + more, done + 1, edits + audit, origin))
    return found


def whole(rows: Sequence[Row]) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    return lightest([r.arcs() for r in rows], COMPLETE, [START], True, True)[START]


def table(steps: Sequence[Iterable[Arc]], rows: bool) -> list[Arc]:
    """The lightest derivation over all steps from each state to each, as steps of their own.
    Turns inserted behind the last step belong to what follows."""
    out = []
    for end in range(4):
        got = lightest(steps, [end], range(4), rows, False)
        out += [(state, end, cost, audit) for state, (cost, audit) in got.items()]
    return out


def apply(rows: Iterable[Row], audit: str, said: int, system: bool) -> str:
    """The repaired turns as lines of `role:text`. `said`: turns before these rows; `system`:
    the conversation begins with a system turn."""
    out, edits = [], iter(audit)

    def emit(role: str | None, text: str) -> None:
        turn = said + len(out) - system
        out.append(f"{role if role is not None else NAMES['ua'[turn % 2]]}:{text}")

    def until_row() -> str:
        for edit in edits:
            if edit != "I":
                return edit
            emit(None, "")
        return ""

    for row in rows:
        edit = until_row()
        if edit == "K":
            emit(row.role, row.text)
        elif edit == "R":
            emit(None, row.text)
        for _ in range(row.copies - 1):
            until_row()
    until_row()
    return "\n".join(out)


# --- damaged rows ---


def damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by crc32 of `conv_id:turn` modulo 20: 0 drops the row, 1 empties its
    text, 2 takes `.`, `!` and `?` out, 3 repeats it, 4 makes its role `user`; nulls count as
    one space there, and a null role or text becomes one space."""

    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    key = F.concat_ws(":", spaced("conv_id"), spaced("turn"))
    kind = F.crc32(F.encode(key, "UTF-8")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(spaced("text"), ".!?", ""))
    rows = conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(spaced("role")).alias("role"),
        text.otherwise(spaced("text")).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("_times"),
    )
    return rows.select(
        "conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(1), F.col("_times")))
    ).drop("col")


def _ordered(rows: DataFrame) -> DataFrame:
    """Equal rows of a turn as one with their number, marked where an earlier turn of the
    conversation has the same role and text, in order over all partitions. Only the
    beginning of a text is used for the bounds of the ranges, which the driver samples."""
    rows = rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    again = (
        counted.groupBy("conv_id", "role", "text")
        .agg(
            F.count("*").alias("n"),
            F.min("turn").alias("first"),
            F.max(F.col("turn").isNull()).alias("null_first"),
        )
        .where("n > 1")
    )
    c, r = counted.alias("c"), again.alias("r")
    same = F.col("c.conv_id").eqNullSafe(F.col("r.conv_id"))
    for name in ("role", "text"):
        same &= F.col(f"c.{name}") == F.col(f"r.{name}")
    first = F.when(F.col("r.null_first"), F.col("c.turn").isNull()).otherwise(
        F.col("c.turn") == F.col("r.first")
    )
    marked = c.join(r, same, "left").select(
        *[F.col(f"c.{name}") for name in ("conv_id", "turn", "role", "text", "copies")],
        (F.col("r.n").isNotNull() & ~first).alias("seen"),
    )
    # nulls are first in an ascending order
    return marked.repartitionByRange(
        "conv_id", "turn", "role", F.substring("text", 1, 32)
    ).sortWithinPartitions("conv_id", "turn", "role", "text")


_FACTS = (
    "n_rows long, first_turn long, last_turn long, n_turns long, blank long, duplicate long, "
    "truncated long, illegal long, first_role string, last_role string"
)
_FACT_NAMES = [f.split()[0] for f in _FACTS.split(", ")]
_ARCS = "arcs array<struct<q: int, r: int, cost: bigint, audit: string>>"
_ROWS = "rows array<struct<role: string, text: string, seen: boolean, copies: bigint>>"
_SIZES = "sizes array<struct<part: bigint, chunk: bigint, n_rows: bigint>>"


def _facts(rows: Sequence[Row], turns: Sequence[int | None]) -> dict:
    """What is counted over rows in order; of nulls among the turns nothing is."""
    known = [t for t in turns if t is not None]
    faults = [r.fault() for r in rows]
    copies = sum(r.copies for r in rows)
    blanks = sum(r.copies for r, f in zip(rows, faults) if f == "blank")
    initials = [r.role[:1] for r in rows]
    pairs = zip(initials, initials[1:])
    return {
        "n_rows": copies,
        "first_turn": known[0] if known else None,
        "last_turn": known[-1] if known else None,
        "n_turns": len(set(known)),
        "blank": blanks,
        "duplicate": sum(r.copies for r, f in zip(rows, faults) if f == "duplicate")
        + sum(r.copies - 1 for r, f in zip(rows, faults) if f in ("", "truncated")),
        "truncated": faults.count("truncated"),
        "illegal": sum(x + y not in LEGAL for x, y in pairs) + copies - len(rows),
        "first_role": initials[0],
        "last_role": initials[-1],
    }


def _joined(parts: Sequence[Mapping]) -> dict:
    """The facts of consecutive parts of a conversation."""
    out = {k: parts[0][k] for k in _FACT_NAMES}
    for part in parts[1:]:
        for name in ("n_rows", "blank", "duplicate", "truncated", "illegal", "n_turns"):
            out[name] += part[name]
        out["illegal"] += out["last_role"] + part["first_role"] not in LEGAL
        if part["first_turn"] is not None:
            out["n_turns"] -= out["last_turn"] == part["first_turn"]
            out["last_turn"] = part["last_turn"]
            if out["first_turn"] is None:
                out["first_turn"] = part["first_turn"]
        out["last_role"] = part["last_role"]
    return out


def _result(facts: Mapping, cost: int, audit: str) -> dict:
    turns = (facts["last_turn"] or 0) - (facts["first_turn"] or 0) + 1 - facts["n_turns"]
    return {
        "gaps": turns if facts["first_turn"] is not None else 0,
        **{k: facts[k] for k in ("blank", "duplicate", "truncated", "illegal")},
        "cost": cost,
        "audit": audit,
    }


_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _conv_type(rows: DataFrame) -> str:
    return f"conv_id {rows.schema['conv_id'].dataType.simpleString()}"


def _emit(out: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(out, schema=schema)


def _arrow_schema(df: DataFrame, ddl: str) -> pa.Schema:
    return to_arrow_schema(df.sparkSession.createDataFrame([], ddl).schema)


def _chunks(rows: DataFrame) -> DataFrame:
    """Solved conversations, and chunks of those that reach over a chunk or a partition."""
    ddl = (
        f"{_conv_type(rows)}, part long, chunk long, whole boolean, {_RESULT}, repaired string, "
        f"facts struct<{_FACTS.replace(' long', ': bigint').replace(' string', ': string')}>, "
        f"{_ARCS}, {_ROWS}"
    )

    schema = _arrow_schema(rows, ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        conv = own = None  # the conversation at hand, and its rows since the last cut
        turns: list = []
        edge, size, out = True, 0, []  # edge: it may have begun before its rows at hand

        def close(end: bool) -> dict:
            """`end`: the conversation is known to end here."""
            nonlocal n
            n += 1
            facts = _facts(own, turns)
            base = {"conv_id": conv, "part": part, "chunk": n, "whole": end and not edge}
            if base["whole"]:
                cost, audit = whole(own)
                said = sum(e != "D" for e in audit)
                text = apply(own, audit, 0, said % 2 == 1)
                return base | _result(facts, cost, audit) | {"repaired": text}
            arcs = [dict(zip("qr", a[:2])) | {"cost": a[2], "audit": a[3]}
                    for a in table([r.arcs() for r in own], True)]
            return base | {"facts": facts, "arcs": arcs, "rows": [r._asdict() for r in own]}

        for batch in batches:
            for r in batch.to_pylist():
                if own is not None and r["conv_id"] != conv:
                    out.append(close(True))
                    own, turns, edge, size = None, [], False, 0
                elif own is not None and (len(own) >= CHUNK_ROWS or size >= CHUNK_CHARS):
                    out.append(close(False))
                    own, turns, edge, size = [], [], True, 0
                if own is None:
                    own, conv = [], r["conv_id"]
                own.append(Row(r["role"], r["text"], r["seen"], r["copies"]))
                turns.append(r["turn"])
                size += len(r["text"])
            if out:
                yield _emit(out, schema)
                out = []
        if own:
            yield _emit([close(False)], schema)

    return _ordered(rows).mapInArrow(run, ddl)


def _solved(chunks: DataFrame) -> DataFrame:
    """Results of conversations in several chunks, with the sizes of their chunks in order."""
    conv = _conv_type(chunks)
    level = f"{conv}, node long, {_FACTS}, {_ARCS}, {_SIZES}"
    ddl = f"{conv}, {_RESULT}, {_SIZES}"
    level_schema, schema = _arrow_schema(chunks, level), _arrow_schema(chunks, ddl)
    order = Window.partitionBy("conv_id").orderBy("part", "chunk")
    numbered = chunks.select("conv_id", "part", "chunk").withColumn(
        "node", (F.row_number().over(order) - 1).cast("long")
    )
    own = F.struct("part", "chunk", F.col("facts.n_rows").alias("n_rows"))
    nodes = numbered.drop("conv_id").join(chunks, ["part", "chunk"]).select(
        "conv_id", "node", "facts.*", "arcs", F.array(own).alias("sizes")
    )

    def steps(parts: Sequence[Mapping]) -> list[list[Arc]]:
        return [[(a["q"], a["r"], a["cost"], a["audit"]) for a in p["arcs"]] for p in parts]

    def join(group: pa.Table) -> pa.Table:
        parts = sorted(group.to_pylist(), key=lambda p: p["node"])
        arcs = [{"q": q, "r": r, "cost": c, "audit": a} for q, r, c, a in table(steps(parts), False)]
        row = _joined(parts) | {
            "conv_id": parts[0]["conv_id"],
            "node": parts[0]["node"] // FAN_IN,
            "arcs": arcs,
            "sizes": [s for p in parts for s in p["sizes"]],
        }
        return pa.Table.from_pylist([row], schema=level_schema)

    most = (numbered.agg(F.max("node")).first()[0] or 0) + 1
    while most > 1:
        most = -(-most // FAN_IN)
        parent = F.floor(F.col("node") / FAN_IN).cast("long")
        nodes = nodes.groupBy("conv_id", parent.alias("parent")).applyInArrow(join, level)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for p in batch.to_pylist():
                cost, audit = lightest(steps([p]), COMPLETE, [START], False, True)[START]
                row = {"conv_id": p["conv_id"], "sizes": p["sizes"]}
                out.append(row | _result(p, cost, audit))
            yield _emit(out, schema)

    return nodes.mapInArrow(finish, ddl)


def _repaired(chunks: DataFrame, solved: DataFrame) -> DataFrame:
    """The repaired turns of each chunk, by the share of the audit that falls to its rows."""
    ddl = "part long, chunk long, edits string, said long, system boolean"
    schema = _arrow_schema(chunks, ddl)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.to_pylist():
                audit, at, said, out = p["audit"], 0, 0, []
                system = (len(audit) - audit.count("D")) % 2 == 1
                for k, s in enumerate(p["sizes"]):
                    to, left = at, s["n_rows"]
                    while left:
                        left -= audit[to] != "I"
                        to += 1
                    to = len(audit) if k == len(p["sizes"]) - 1 else to
                    edits = audit[at:to]
                    out.append({"part": s["part"], "chunk": s["chunk"], "edits": edits,
                                "said": said, "system": system})
                    said += len(edits) - edits.count("D")
                    at = to
                yield _emit(out, schema)

    shares = solved.select("audit", "sizes").mapInArrow(deal, ddl)
    kind = _conv_type(chunks)
    repaired = f"{kind}, part long, chunk long, repaired string"
    mended = _arrow_schema(chunks, repaired)

    def mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.to_pylist():
                rows = [Row(**r) for r in p["rows"]]
                text = apply(rows, p["edits"], p["said"], p["system"])
                row = {k: p[k] for k in ("conv_id", "part", "chunk")}
                yield _emit([row | {"repaired": text}], mended)

    return chunks.select("conv_id", "part", "chunk", "rows").join(
        shares, ["part", "chunk"]
    ).mapInArrow(mend, repaired)


def _digests(parts: DataFrame) -> DataFrame:
    """SHA-256 over the parts of each conversation in order. The function is sequential, so
    one task reads a conversation, but as a stream: nothing of it is held."""
    ddl = f"{_conv_type(parts)}, repaired_sha256 string"
    schema = _arrow_schema(parts, ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, begun = None, None, False
        for batch in batches:
            out = []
            for p in batch.to_pylist():
                if state is None or p["conv_id"] != conv:
                    if state is not None:
                        out.append({"conv_id": conv, "repaired_sha256": state.hexdigest()})
                    conv, state, begun = p["conv_id"], sha256(), False
                if p["repaired"]:
                    state.update(("\n" * begun + p["repaired"]).encode())
                    begun = True
            yield _emit(out, schema)
        if state is not None:
            yield _emit([{"conv_id": conv, "repaired_sha256": state.hexdigest()}], schema)

    return (
        parts.repartition("conv_id").sortWithinPartitions("conv_id", "part", "chunk").mapInArrow(run, ddl)
    )


class Repair(NamedTuple):
    """`report`: a row for each conversation; `turns`: the repaired turns, lines of
    `role:text`, in one or several parts of a conversation, ordered by `part` and `chunk`."""

    report: DataFrame
    turns: DataFrame


def repair(rows: DataFrame) -> Repair:
    """Repair conversations given as rows of `conv_id`, `turn`, `role`, `text`.

    Rows stand in order of turn, nulls first, then role and text. Keep costs 0, another role
    2, a deletion 3, an inserted empty turn 2, a kept row that ends without `.`, `!` or `?`
    one more; blank rows and those whose role and text were seen before are deleted. The
    report has `gaps`, the rows by first fault (`blank`, `duplicate`, `truncated`), pairs of
    roles that may not follow each other (`illegal`), `cost`, `audit` (the initials of the
    cheapest edits, of several the ASCII-least) and `repaired_sha256`.

    Null roles and texts are one space, a row without a role cannot be kept as it is, a null `conv_id` is a conversation of its own, equal
    rows are duplicates of the first, texts of any length are kept whole, other columns are
    ignored, and no rows give an empty report.
    """
    chunks = saved(_chunks(rows), "conversation-chunks")
    alone = chunks.where("whole")
    parts = chunks.where("NOT whole")
    solved = saved(_solved(parts), "conversations-solved")
    mended = saved(_repaired(parts, solved), "conversations-mended")
    names = [f.split()[0] for f in _RESULT.split(", ")]
    digests = _digests(mended).alias("d")
    joined = solved.alias("s").join(digests, F.expr("s.conv_id <=> d.conv_id"))
    report = alone.select("conv_id", *names, F.sha2("repaired", 256).alias("repaired_sha256")).union(
        joined.select("s.conv_id", *[f"s.{n}" for n in names], "d.repaired_sha256")
    )
    columns = ["conv_id", "part", "chunk", "repaired"]
    return Repair(report, alone.select(*columns).union(mended.select(*columns)))
