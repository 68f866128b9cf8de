import random
import re
import sys
from functools import lru_cache
from hashlib import sha256
from itertools import product
from zlib import crc32

import pytest

from cityflow.llm import conversations as conv
from tests.llm.conftest import SF

sys.setrecursionlimit(20_000)  # for the plain version
VISIBLE = re.compile(r"[^\x20\x09-\x0D]")
GOAL = re.compile(r"(s?(ua)+)?")
AFTER = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}


def damaged(rows):
    out = []
    for c, turn, role, text in rows:
        key = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
        role, text = (" " if x is None else x for x in (role, text))
        kind = crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(c, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        last = VISIBLE.findall(text)[-1:]
        fault = "blank" if not last else "duplicate" if (role, text) in seen else "" if last[0] in ".!?" else "truncated"
        seen.add((role, text))
        out.append(fault)
    return out


def plain(rows):
    """The cheapest edits by recursion over (row, last initial)."""
    found = faults(rows)

    @lru_cache(None)
    def best(i, last, gifts):
        """(cost, audit, turns) from row i on; `gifts`: turns inserted since the last row."""
        options = []
        if i == len(rows) and last in ("", "a"):
            options.append((0, "", ()))
        for new in "ua":
            if gifts < 3 and (last, new) in AFTER:
                cost, audit, turns = best(i, new, gifts + 1)
                name = {"u": "user", "a": "assistant"}[new]
                options.append((cost + 2, "I" + audit, (name + ":", *turns)))
        if i < len(rows):
            _, _, role, text = rows[i]
            cost, audit, turns = best(i + 1, last, 0)
            options.append((cost + 3, "D" + audit, turns))
            if found[i] not in ("blank", "duplicate"):
                for letter, name, price in (("K", role, 0), ("R", "user", 2), ("R", "assistant", 2)):
                    if (last, name[:1]) in AFTER:
                        cost, audit, turns = best(i + 1, name[:1], 0)
                        more = price + (found[i] == "truncated")
                        options.append((cost + more, letter + audit, (f"{name}:{text}", *turns)))
        return min(options, default=(10**9, "", ()))

    return best(0, "", 0)


def expected(rows):
    """One row for each conversation of damaged rows."""
    out = {}
    for c in {r[0] for r in rows}:
        own = in_order([r for r in rows if r[0] == c])
        turns = [r[1] for r in own if r[1] is not None]
        kinds = faults(own)
        initials = [r[2][:1] for r in own]
        cost, audit, said = plain(tuple(own))
        out[c] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *[kinds.count(k) for k in ("blank", "duplicate", "truncated")],
            sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:])),
            cost, audit, sha256("\n".join(said).encode()).hexdigest(),
        )
    return out


def result(report):
    return {r.conv_id: tuple(r)[1:] for r in report.collect()}


def random_rows(n, seed, convs, turns=8):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "User", "", " ", "sys", "u"]
    texts = ["Hello.", "Hello", "", "  \n", "No!", "Why? ", "end .\t", "é", "王。", "a\nb."]
    return [
        (rng.randrange(convs), rng.choice([None, *range(turns)]), rng.choice(roles[: rng.choice([3, 9])]), rng.choice(texts))
        for _ in range(n)
    ]


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def test_agenda_equals_all_edits():
    """Every series of edits of short conversations is tried."""
    rng = random.Random(3)
    for _ in range(60):
        rows = in_order(random_rows(rng.randrange(4), rng.random(), 1, 3))
        kinds, found = faults(rows), []
        gaps = list(product(range(3), repeat=len(rows) + 1))
        for edits in product(*[["D"] if k in ("blank", "duplicate") else "KRD" for k in kinds]):
            for gifts in gaps:
                letters = "".join("I" * g + e for g, e in zip(gifts, (*edits, "")))
                cost = 2 * sum(gifts) + sum({"K": 0, "R": 2, "D": 3}[e] for e in edits)
                cost += sum(k == "truncated" and e != "D" for k, e in zip(kinds, edits))
                slots, row = [], 0
                for letter in letters:
                    if letter == "K":
                        slots.append([rows[row][2][:1] or "?"])
                    elif letter in "RI":
                        slots.append(["u", "a"])
                    row += letter != "I"
                if any(GOAL.fullmatch("".join(s)) for s in product(*slots)):
                    found.append((cost, letters))
        collapsed = [conv.Row(r[2], r[3], (r[2], r[3]) in {(x[2], x[3]) for x in rows[:i]}, 1) for i, r in enumerate(rows)]
        assert conv.whole(collapsed) == min(found) == plain(tuple(rows))[:2]


@pytest.mark.parametrize("chunk", [conv.CHUNK_ROWS, 1, 3])
def test_equals_brute_force(spark, monkeypatch, chunk):
    """Ties, nulls, repeated rows; conversations whole, in chunks and over partitions."""
    monkeypatch.setattr(conv, "CHUNK_ROWS", chunk)
    monkeypatch.setattr(conv, "FAN_IN", 2)
    rows = random_rows(250, 5, 30) + [(77, t % 5, "user", "Hi.") for t in range(20)] + [(78, None, "user", "x")]
    rows += [(None, 1, "user", "A."), (None, 2, "assistant", "B"), (80, 1, "", ""), (81, 5, "tool", "y" * 70_000)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = conv.repair(frame)
    assert result(got.report) == expected(rows)
    lines = {}
    for r in sorted(got.turns.collect(), key=lambda r: (r.part, r.chunk)):
        lines.setdefault(r.conv_id, []).extend([r.repaired] if r.repaired else [])
    for c, parts in lines.items():
        own = in_order([r for r in rows if r[0] == c])
        assert "\n".join(parts) == "\n".join(plain(tuple(own))[2])


def test_long_conversation(spark, monkeypatch):
    """A third of all rows in one conversation, most of them equal in one turn."""
    monkeypatch.setattr(conv, "CHUNK_ROWS", 16)
    monkeypatch.setattr(conv, "FAN_IN", 3)
    rows = [(1, k, ("user", "assistant", "tool")[k * k % 3], f"t{k % 90}" + "." * (k % 2)) for k in range(400)]
    rows += [(1, 7, "user", "same.")] * 300 + random_rows(300, 8, 60)
    rows = [r for r in rows if r[0] != 1 or r[3][:1] in ("t", "s")]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert result(conv.repair(frame).report) == expected(rows)


def test_damage(spark):
    rows = random_rows(400, 11, 50) + [(None, None, None, None), (3, None, None, "Hi. There!?")]
    got = conv.damage(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, damaged(rows)))


def test_no_rows_and_other_columns(spark):
    assert conv.repair(spark.createDataFrame([], SCHEMA)).report.collect() == []
    frame = spark.createDataFrame([("a", 1, "user", "Hi.", 2, 3)], "conv_id string, turn int, role string, text string, part int, cost int")
    assert result(conv.repair(frame).report) == expected([("a", 1, "user", "Hi.")])


def test_whole_table(spark, tmp_path):
    from cityflow.llm.queries import QUERIES

    source = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in source.select("conv_id", "turn", "role", "text").collect()]
    want = expected(damaged(rows))
    empty = (0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())
    got = result(QUERIES["op12_conversation_repair"](spark, SF))
    assert got == {c: want.get(c, empty) for c in {r[0] for r in rows}}
    # a conversation whose only row is dropped stays in the result
    lost = next(k for k in range(1000) if crc32(f"{k}:0".encode()) % 20 == 0)
    spark.createDataFrame([(lost, 0, "user", "x")], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert result(QUERIES["op12_conversation_repair"](spark, str(tmp_path))) == {lost: empty}
