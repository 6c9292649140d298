"""Repair of conversations against a search over all edits, and pieces of any size against whole conversations."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from larder.llm import turns

COLUMNS = [c.split()[0] for c in turns.RESULT.split(", ")]
WHITE = " \t\n\x0b\x0c\r"


def damage(rows):
    """Rows after the damage per conversation, in order, and all conversations."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv]
        role, text = (" " if x is None else x for x in (role, text))
        d = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if d == 0:
            continue
        text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        out[conv] += [(turn, "user" if d == 4 else role, text)] * (2 if d == 3 else 1)
    for found in out.values():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0))
    return out


def accepts(initials):
    return re.fullmatch("(s?(ua)+)?", initials) is not None


def brute(rows):
    """Result of one conversation's rows: Dijkstra over (turn, output so far's state), least (cost, audit) first."""
    blank = duplicate = truncated = 0
    faults, seen = [], set()
    for _, role, text in rows:
        bare = text.strip(WHITE)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
    blank, duplicate, truncated = (faults.count(f) for f in ("blank", "duplicate", "truncated"))
    # any prefix of an allowed word, told apart by what may follow: nothing yet, s, ...u, ...a
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, tail, out = heapq.heappop(heap)
        if at == len(rows) and (tail == "" or tail == "a"):
            break
        if (at, tail) in done:
            continue
        done.add((at, tail))

        def push(price, edit, step, role, text, cost=cost, audit=audit, at=at, tail=tail, out=out):
            first = role[:1]
            if first == "u" and tail in ("", "s", "a") or first == "a" and tail == "u" or first == "s" and tail == "":
                heapq.heappush(heap, (cost + price, audit + edit, at + step, first, (*out, f"{role}:{text}")))

        for role in ("user", "assistant"):
            push(5, "I", 0, role, "")
        if at < len(rows):
            _, role, text = rows[at]
            heapq.heappush(heap, (cost + 2, audit + "D", at + 1, tail, out))
            if faults[at] not in ("blank", "duplicate"):
                extra = 5 * (faults[at] == "truncated")
                push(extra, "K", 1, role, text)
                for new in ("user", "assistant"):
                    push(1 + extra, "R", 1, new, text)
    named = [t for t, _, _ in rows if t is not None]
    gaps = max(named) - min(named) + 1 - len(set(named)) if named else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    assert accepts("".join(o[0] for o in out))
    return gaps, blank, duplicate, truncated, illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


def expected(rows):
    return {conv: brute(found) for conv, found in damage(rows).items()}


def result(df):
    got = df.select(*COLUMNS).collect()
    assert len({r.conv_id for r in got}) == len(got)
    return {r.conv_id: tuple(r)[1:] for r in got}


ROLES = ["user", "assistant", "system", "tool", "", None]
TEXTS = ["Yes.", "No!", "why?", "cut", "", " \n", None, "end. \n", "é。"]


def invented(rng, conversations, most):
    out = []
    for conv in range(conversations):
        for turn in range(rng.randrange(1, most)):
            role = ROLES[turn % 2] if rng.random() < 0.7 else rng.choice(ROLES)
            text = f"{rng.randrange(9**6)}." if rng.random() < 0.6 else rng.choice(TEXTS)
            out.append((conv, turn if rng.random() < 0.95 else None, role, text))
    # an order among rows of one turn would have to be guessed by the brute force: one null turn per conversation
    seen, kept = set(), []
    for r in out:
        if (r[0], r[1]) not in seen:
            kept.append(r)
        seen.add((r[0], r[1]))
    return kept


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


@settings(max_examples=150, deadline=None)
@given(symbols=st.text("BDsuaxSUAX", max_size=9))
def test_least_audit_of_the_least_cost(symbols):
    roles = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    rows, last = [], None
    for i, s in enumerate(symbols):
        if s == "D" and last:
            rows.append((i, *last))
            continue
        text = " " if s == "B" else f"{i}" if s.isupper() and s not in "BD" else f"{i}."
        rows.append((i, roles.get(s.lower(), "user"), text))
        last = (rows[-1][1], text) if s != "B" else last
    piece = turns.Piece(1)
    for t, role, text in rows:
        bare = text.strip(WHITE)
        initial = role[0] if role[0] in "sua" else "x"
        symbol = "B" if not bare else initial if bare[-1] in ".!?" else initial.upper()
        piece.add((1, t, role, text, False, initial, symbol, f"{role}:{text}".encode()))
    row = piece.row(0, True)
    assert tuple(row[c] for c in COLUMNS[1:]) == brute(rows)


@settings(max_examples=60, deadline=None)
@given(symbols=st.text("BDsuaxSUAX", max_size=40), length=st.integers(0, 300))
def test_powers_equal_single_steps(symbols, length):
    for text in (symbols, "U" * length + "a" * (length // 2)):
        single = turns.UNIT
        for s in text:
            single = turns.product(single, turns.power(s, 0))
        assert turns.transition(text) == single
        audit, state = turns.walked(turns.unrolled(text, turns.END), 0)
        assert len(audit.replace("I", "")) == len(text) and state in (0, 1, 2, 3)


@pytest.mark.parametrize("size", [1, 3, turns.PIECE_TURNS])
def test_pieces_of_any_size(spark, size, monkeypatch):
    monkeypatch.setattr(turns, "PIECE_TURNS", size)
    rng = random.Random(size)
    rows = invented(rng, 60, 12)
    rows += [(None, t, rng.choice(ROLES), rng.choice(TEXTS)) for t in range(9)]
    rows += [(900, t, "user" if t % 2 else "assistant", f"{t % 50} same.") for t in range(400)]  # one hot conversation
    rows += [(901, t, "user", "over and over") for t in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert result(turns.repair(df)) == expected(rows)


def test_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert result(turns.repair(df)) == expected(rows)


def test_odd_rows(spark):
    schema = SCHEMA + ", gaps bigint, at bigint, symbols string, key string, tie bigint, whole boolean"
    zero = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    rows = [(5, zero, "user", "gone."), (6, None, None, None), (7, -(10**12), "user", "Far.\n"), (7, 10**12, "assistant", "x" * 100_000 + "."), (None, None, "user", "a.")]
    df = spark.createDataFrame([(*r, 1, 2, "x", "k", 3, True) for r in rows], schema)
    got = result(turns.repair(df))
    assert got == expected(rows)
    assert got[5] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert turns.repair(df.limit(0)).collect() == []


def test_equal_rows_of_one_turn(spark):
    """Rows repeated in the input are duplicates, whatever tasks they lie in."""
    df = spark.createDataFrame([(1, 3, "user", "Hi.")] * 500 + [(1, 4, "assistant", "Yes.")], SCHEMA).repartition(6)
    got = result(turns.repair(df))[1]
    assert got == brute([(3, "user", "Hi.")] * 500 * (2 if zlib.crc32(b"1:3") % 20 == 3 else 1) + [(4, "assistant", "Yes.")])
