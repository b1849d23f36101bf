"""Conversation repair against a plain search over all edits."""

import functools
import hashlib
import random
import re
import zlib

import pytest

from riskweave.llm import conversations as C
from riskweave.llm import queries
from tests.conftest import SF_SMALL

SCHEMA = "conv_id long, turn long, role string, text string, id string, at int, edits int"


def harm(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if code == 0:
            continue
        if code == 1:
            text = ""
        if code == 2:
            text = re.sub("[.!?]", "", text)
        out += [(conv, turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    return out


def best(rows):
    """(cost, letters) by trying every edit; rows are (initial, must go, truncated)."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}

    @functools.cache
    def rest(i, state, inserts):
        ways = [(0, "")] if i == len(rows) and state in (0, 3) else []
        want = 3 if state == 2 else 2
        if inserts < 3:
            c, e = rest(i, want, inserts + 1)
            ways.append((c + 5, "I" + e))
        if i < len(rows):
            initial, must, cut = rows[i]
            c, e = rest(i + 1, state, 0)
            ways.append((c + 2, "D" + e))
            if not must:
                c, e = rest(i + 1, want, 0)
                ways.append((c + 1 + 5 * cut, "R" + e))
                if (state, initial) in step:
                    c, e = rest(i + 1, step[state, initial], 0)
                    ways.append((c + 5 * cut, "K" + e))
        return min(ways, default=(10 ** 6, ""))

    for i in range(len(rows), 0, -20):  # keeps the recursion shallow
        rest(i, 0, 0)
    return rest(0, 0, 0)


def slow(rows):
    """The contract's columns by conversation, rows damaged already."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        seen, faults, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text in own:
            body = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = ("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None)
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            faults.append((role[:1], fault in ("blank", "duplicate"), int(fault == "truncated")))
        cost, letters = best(tuple(faults))
        lines, state, i = [], 0, 0
        for e in letters:
            if e == "I":
                state = 3 if state == 2 else 2
                lines.append(("user" if state == 2 else "assistant") + ":")
                continue
            _, _, role, text = own[i]
            i += 1
            if e == "R":
                state = 3 if state == 2 else 2
                lines.append(("user" if state == 2 else "assistant") + ":" + text)
            if e == "K":
                state = {"s": 1, "u": 2, "a": 3}[role[0]]
                lines.append(f"{role}:{text}")
        turns = {r[1] for r in own if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, letters,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


EMPTY = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def fast(spark, rows, ids=None, **kw):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    ids = df if ids is None else spark.createDataFrame([(i,) for i in ids], "conv_id long")
    got = [tuple(r) for r in C.audit(df.select("conv_id", "turn", "role", "text"), ids, **kw).collect()]
    assert len(got) == len({r[0] for r in got})
    return {r[0]: r[1:] for r in got}


def made(rng, convs, longest):
    rows = []
    for conv in convs:
        turn = 0
        for _ in range(rng.randrange(1, longest)):
            turn += rng.choice([0, 1, 1, 1, 2])
            rows.append((conv, None if rng.random() < 0.05 else turn, rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", "User"]),
                         rng.choice(["Yes.", "No!", "cut", "", " \t", "A long answer. ", "Another?\n", "é", "one.", "two.", "three.", "four."])))
    return rows


@pytest.mark.parametrize("piece_bits", [C.PIECE_BITS, 2])
def test_equals_a_search_over_all_edits(spark, piece_bits):
    rows = made(random.Random(3), [*range(60), None], 14)
    want = slow(rows)
    assert fast(spark, rows, piece_bits=piece_bits) == want


def test_pieces_and_partitions_of_a_long_conversation(spark):
    """One conversation with most rows is cut into many pieces over all partitions."""
    rng = random.Random(5)
    rows = [(7, i, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["x", "y z"]) + str(rng.randrange(150)) + rng.choice(["", ".", "!"]))
            for i in range(400)] + made(rng, range(20, 30), 6)
    assert fast(spark, rows, piece_bits=2) == slow(rows)
    assert fast(spark, rows, piece_bits=5) == slow(rows)


def test_copies_nulls_and_none(spark):
    rows = [(1, 0, "user", "Hi.")] * 40 + [(1, None, None, None), (2, 5, "assistant", "So."), (2, 2 ** 40, "user", "Well."), (3, 1, "", "")]
    want = slow([(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows])
    assert fast(spark, rows) == want
    got = fast(spark, rows[:40], ids=[9, None, 1])
    assert got[9] == got[None] == EMPTY and got[1][2] == 39
    assert fast(spark, []) == {}


def test_very_long_texts(spark):
    rows = [(1, 0, "user", "word " * 400_000 + "."), (1, 1, "assistant", " " * 300_000), (1, 2, "assistant", "ok.")]
    assert fast(spark, rows) == slow(rows)


def test_repaired_rows(spark):
    rows = made(random.Random(8), range(25), 12)
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    got = sorted(C.repair(df, piece_bits=2).collect(), key=lambda r: (r.conv_id, r["at"], r.nth))
    digests = {c: hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in got if r.conv_id == c).encode()).hexdigest() for c in range(25)}
    assert digests == {c: v[-1] for c, v in slow(rows).items()}
    assert all(re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in got if r.conv_id == c)) for c in range(25))


def test_query(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()]
    want = {c: EMPTY for c in {r[0] for r in rows}} | slow(harm(rows))
    got = {r.conv_id: tuple(r)[1:] for r in queries.op12_conversations(spark, SF_SMALL).collect()}
    assert got == want


def test_damage(spark):
    rows = made(random.Random(1), [*range(200), None], 5)
    rows += [(500 + i, None, None, None) for i in range(40)]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    assert sorted(map(repr, (tuple(r) for r in C.damaged(df).collect()))) == sorted(map(repr, harm(rows)))
