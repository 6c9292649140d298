"""Repair of damaged conversations at the least cost, by a dynamic programme over runs of equal turns.

A turn is a symbol: the initial of its role and its fault. What an edit of it does to a conversation's state (nothing yet,
after a system turn, after a user's, after an assistant's) is a 4 x 4 min-plus matrix per symbol. Equal consecutive symbols
are one run, which is passed by binary powers of that matrix, kept for all conversations; the choices of each turn are then
unrolled from the cost that is left after it.

All turns are range-sorted by conversation and turn, so a long conversation lies in many tasks, as pieces of bounded size.
A conversation inside one task and piece is finished there. Min-plus products are associative: the others exchange one
matrix per piece, backwards for the cost that is left after each piece, forwards for the state in which it begins, and every
piece is unrolled by itself. Only the digest of a conversation's repaired text is taken in one task, as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.session import materialise

#: Turns and characters of a piece.
PIECE_TURNS = 1024
PIECE_CHARS = 1 << 20
#: Costs of the edits; keeping a turn is free.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

#: States: nothing yet, after s, after u, after a. Which state an initial leads to; no entry: not allowed there.
NEXT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
#: The only role that may be inserted, or given to a turn, in each state, and where it leads.
NEW = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
#: Cost of closing a conversation in each state: insertions until it ends after an assistant's turn.
END = (0, 2 * INSERT, INSERT, 0)
#: Symbols of a turn: its initial (x: any other), in capitals if truncated; blank and duplicate ones must go.
MUST_GO = "BD"
NEVER = 1 << 40

Vector = tuple[int, int, int, int]
Matrix = tuple[Vector, Vector, Vector, Vector]


def edits(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) for a turn that is met in a state, insertions before it apart."""
    out = [("D", DELETE, state)]
    if symbol not in MUST_GO:
        extra = TRUNCATED if symbol.isupper() else 0
        if state in NEXT.get(symbol.lower(), {}):
            out.append(("K", extra, NEXT[symbol.lower()][state]))
        out.append(("R", REROLE + extra, NEW[state][1]))
    return out


def product(m: Matrix, n: Matrix) -> Matrix:
    return tuple(tuple(min(m[p][k] + n[k][q] for k in range(4)) for q in range(4)) for p in range(4))


def applied(m: Matrix, after: Vector) -> Vector:
    """Least cost from each state before to the end, with the costs ``after``."""
    return tuple(min(m[p][q] + after[q] for q in range(4)) for p in range(4))


UNIT: Matrix = tuple(tuple(0 if p == q else NEVER for q in range(4)) for p in range(4))
_ONCE: Matrix = tuple(tuple(0 if p == q else INSERT if NEW[p][1] == q else NEVER for q in range(4)) for p in range(4))
#: Any number of insertions; two lead to every state that can be reached.
INSERTED = product(_ONCE, _ONCE)


@lru_cache(maxsize=None)
def power(symbol: str, k: int) -> Matrix:
    """Transition of 2^k turns of one symbol."""
    if k:
        return product(power(symbol, k - 1), power(symbol, k - 1))
    rows = [[NEVER] * 4 for _ in range(4)]
    for p in range(4):
        for _, cost, q in edits(symbol, p):
            rows[p][q] = min(rows[p][q], cost)
    return product(INSERTED, tuple(map(tuple, rows)))


def powers(symbol: str, length: int) -> list[Matrix]:
    return [power(symbol, k) for k in range(length.bit_length()) if length >> k & 1]


def runs(symbols: str) -> list[tuple[str, int]]:
    return [(s, sum(1 for _ in same)) for s, same in groupby(symbols)]


def transition(symbols: str) -> Matrix:
    out = UNIT
    for symbol, length in runs(symbols):
        for m in powers(symbol, length):
            out = product(out, m)
    return out


@lru_cache(maxsize=1 << 16)
def choices(symbol: str, after: Vector) -> tuple[Vector, tuple[tuple[str, int], ...]]:
    """Costs before a turn, and per state the edits up to and with this turn and the state they lead to.

    Of several cheapest ones those whose initials come first. ``after`` is relative to its least entry.
    """
    before = applied(power(symbol, 0), after)
    found = []
    for state in range(4):
        text = ""
        while True:
            options = [(e, cost + after[q], q) for e, cost, q in edits(symbol, state)]
            options.append(("I", INSERT + before[NEW[state][1]], NEW[state][1]))
            edit, _, state = min(o for o in options if o[1] == before[state])
            text += edit
            if edit != "I":
                break
        found.append((text, state))
    return before, tuple(found)


def unrolled(symbols: str, after: Vector) -> list[tuple[tuple[str, int], ...]]:
    """The choices at every turn, given the costs that are left after the last one."""
    cut = runs(symbols)
    ends = []
    for symbol, length in reversed(cut):
        ends.append(after)
        for m in powers(symbol, length):
            after = applied(m, after)
    out = []
    for (symbol, length), left in zip(reversed(cut), ends, strict=True):
        for _ in range(length):
            low = min(left)
            left, choice = choices(symbol, tuple(x - low for x in left))
            out.append(choice)
    return out[::-1]


def walked(options: list[tuple[tuple[str, int], ...]], state: int) -> tuple[str, int]:
    """(audit, state at the end) of a way through the choices from a state."""
    audit = []
    for choice in options:
        text, state = choice[state]
        audit.append(text)
    return "".join(audit), state


def closing(state: int) -> int:
    """Number of insertions that end a conversation."""
    return END[state] // INSERT


def lines(audit: str, state: int, roles: list[str], texts: list[str]) -> Iterator[str]:
    """``role:text`` of the turns that are left, with the edits carried out."""
    at = 0
    for edit in audit:
        if edit == "I":
            role, state = NEW[state]
            yield f"{role}:"
            continue
        if edit == "K":
            yield f"{roles[at]}:{texts[at]}"
            state = NEXT[roles[at][0]][state]
        elif edit == "R":
            role, state = NEW[state]
            yield f"{role}:{texts[at]}"
        at += 1


LEGAL = {"su", "ua", "au"}


def illegal(initials: str) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, dropped, initial, symbol, key) of the turns after the damage by their hash.

    A null counts as one space in the hash, the role and the text. Dropped turns stay, marked, so that their conversation is
    known. ``key`` is a digest of conversation, role and text.
    """
    ident, turn = F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint")
    space = F.lit(" ")
    named = F.concat(F.coalesce(ident.cast("string"), space), F.lit(":"), F.coalesce(turn.cast("string"), space))
    rows = turns.select(
        ident.alias("conv_id"), turn.alias("turn"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
        (F.crc32(named) % 20).alias("damage"),
    )
    text = F.when(F.col("damage") == 1, "").when(F.col("damage") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("damage") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("damage") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("damage") == 0).alias("dropped"), F.explode(copies).alias("copy"))
    white = " \t\n\x0b\f\r"
    last = F.right(F.rtrim("text", F.lit(white)), F.lit(1))
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    symbol = F.when(last == "", "B").when(last.isin(".", "!", "?"), initial).otherwise(F.upper(initial))
    digest = F.md5(F.concat_ws(":", F.coalesce(ident.cast("string"), space), F.length("role"), "role", "text"))
    return rows.select("conv_id", "turn", "role", "text", "dropped", initial.alias("initial"), symbol.alias("symbol"), F.unhex(digest).alias("key"))


RESULT = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired_sha256 string"
)
PIECES = RESULT + (
    ", whole boolean, at bigint, first_turn bigint, last_turn bigint, n_turns bigint, initials string, symbols string, "
    "keys array<binary>, roles array<string>, texts array<string>"
)
_RESULT_NAMES = [c.split()[0] for c in RESULT.split(", ")]


def _batch(rows: list[dict], ddl: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<binary>": pa.list_(pa.binary()), "array<string>": pa.list_(pa.string()), "array<bigint>": pa.list_(pa.int64())}
    fields = [c.rsplit(" ", 1) for c in ddl.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], kinds[t]) for n, t in fields], names=[n for n, _ in fields])


def _batches(rows: Iterable[dict], ddl: str, size: int = 256) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(map(len, row.get("texts") or ())) + len(row.get("part") or "")
        if len(held) >= size or chars > 4 * PIECE_CHARS:
            yield _batch(held, ddl)
            held, chars = [], 0
    if held:
        yield _batch(held, ddl)


def counts(symbols: str) -> dict[str, int]:
    return {"blank": symbols.count("B"), "duplicate": symbols.count("D"), "truncated": sum(map(symbols.count, "SUAX"))}


class Piece:
    """Consecutive turns of one conversation."""

    def __init__(self, conv: int | None):
        self.conv, self.turns, self.initials, self.symbols = conv, [], [], []
        self.roles, self.texts, self.keys, self.size = [], [], [], 0
        self.seen: set[bytes] = set()

    def add(self, row: tuple) -> None:
        _, turn, role, text, dropped, initial, symbol, key = row
        if dropped:
            return
        self.turns.append(turn)
        self.initials.append(initial)
        self.symbols.append("D" if symbol != "B" and key in self.seen else symbol)
        if symbol != "B" and key not in self.seen:
            self.seen.add(key)
        self.keys.append(key)
        self.roles.append(role)
        self.texts.append(text)
        self.size += len(text)

    def full(self) -> bool:
        return len(self.turns) >= PIECE_TURNS or self.size >= PIECE_CHARS

    def row(self, at: int, whole: bool) -> dict:
        symbols, initials = "".join(self.symbols), "".join(self.initials)
        named = [t for t in self.turns if t is not None]
        first, last, n = (named[0], named[-1], len(set(named))) if named else (None, None, 0)
        if not whole:
            return {
                "conv_id": self.conv, "whole": False, "at": at, "first_turn": first, "last_turn": last, "n_turns": n, "initials": initials,
                "symbols": symbols, "keys": self.keys, "roles": self.roles, "texts": self.texts,
            }
        audit, state = walked(unrolled(symbols, END), 0)
        audit += "I" * closing(state)
        text = "\n".join(lines(audit, 0, self.roles, self.texts))
        return {
            "conv_id": self.conv, "whole": True, "gaps": last - first + 1 - n if n else 0, **counts(symbols), "illegal": illegal(initials),
            "cost": applied(transition(symbols), END)[0], "audit": audit, "repaired_sha256": hashlib.sha256(text.encode()).hexdigest(),
        }


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Finished conversations and pieces of the others; the first and last one of a task may go on elsewhere."""
    part, number, now, alone = TaskContext.get().partitionId(), 0, None, False
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or row[0] != now.conv or now.full():
                same = now is not None and row[0] == now.conv
                if now is not None:
                    yield now.row((part << 32) + number, alone and not same)
                    number += 1
                alone = now is not None and not same
                now = Piece(row[0])
            now.add(row)
    if now is not None:
        yield now.row((part << 32) + number, False)


def _mapped(df: DataFrame, rows: Callable[[Iterator[dict]], Iterator[dict]], ddl: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(rows(r for b in batches for r in b.to_pylist()), ddl)

    return df.mapInArrow(run, ddl)


def _in_order(df: DataFrame, backwards: bool = False) -> DataFrame:
    """A conversation's pieces in one task, in order: one row per piece, read as a stream."""
    at = F.desc("at") if backwards else F.asc("at")
    return df.repartition("conv_id").sortWithinPartitions("conv_id", at)


def _marked(rows: Iterator[dict]) -> Iterator[dict]:
    """Symbols with the duplicates of turns in earlier pieces, and the piece's transition."""
    for r in rows:
        late = set(r["late"] or ())
        symbols = "".join("D" if s != "B" and k in late else s for s, k in zip(r["symbols"], r["keys"], strict=True))
        yield {"conv_id": r["conv_id"], "at": r["at"], "symbols": symbols, "matrix": [x for v in transition(symbols) for x in v]}


def _left_after(rows: Iterator[dict]) -> Iterator[dict]:
    """The least costs after each piece, relative to their least; pieces come last first."""
    for _, pieces in groupby(rows, key=lambda r: (r["conv_id"],)):
        after = END
        for r in pieces:
            yield {"at": r["at"], "after": list(after)}
            m = r["matrix"]
            after = applied(tuple(tuple(m[4 * p : 4 * p + 4]) for p in range(4)), after)


def _exits(rows: Iterator[dict]) -> Iterator[dict]:
    for r in rows:
        options = unrolled(r["symbols"], tuple(r["after"]))
        yield {"conv_id": r["conv_id"], "at": r["at"], "exits": [walked(options, s)[1] for s in range(4)], "after": r["after"], "symbols": r["symbols"]}


def _entries(rows: Iterator[dict]) -> Iterator[dict]:
    """The state in which each piece begins, and whether it is its conversation's last."""
    for _, pieces in groupby(rows, key=lambda r: (r["conv_id"],)):
        state, held = 0, None
        for r in pieces:
            if held:
                yield held
            held = {"at": r["at"], "entry": state, "closes": 0, "after": r["after"], "faults": r["symbols"]}
            state = r["exits"][state]
        yield held | {"closes": closing(state)}


def _written(rows: Iterator[dict]) -> Iterator[dict]:
    for r in rows:
        options = unrolled(r["faults"], tuple(r["after"]))
        audit = walked(options, r["entry"])[0] + "I" * r["closes"]
        out = {c: r[c] for c in ("conv_id", "at", "first_turn", "last_turn", "n_turns")}
        cost = sum({"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}[e] for e in audit)
        kept = [s for s, e in zip(r["faults"], audit.replace("I", ""), strict=True) if e != "D"]
        yield out | counts(r["faults"]) | {
            "first_initial": r["initials"][:1], "last_initial": r["initials"][-1:], "illegal": illegal(r["initials"]),
            "cost": cost + TRUNCATED * sum(s.isupper() for s in kept), "audit": audit,
            "part": "\n".join(lines(audit, r["entry"], r["roles"], r["texts"])),
        }


def _assembled(rows: Iterator[dict]) -> Iterator[dict]:
    for (conv,), pieces in groupby(rows, key=lambda r: (r["conv_id"],)):
        total = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0)
        first = last = None
        n, initial, audit, digest, begun = 0, "", [], hashlib.sha256(), False
        for r in pieces:
            for c in total:
                total[c] += r[c]
            if r["n_turns"]:
                n += r["n_turns"] - (last == r["first_turn"])
                first, last = r["first_turn"] if first is None else first, r["last_turn"]
            if r["first_initial"]:
                total["illegal"] += initial != "" and initial + r["first_initial"] not in LEGAL
                initial = r["last_initial"]
            audit.append(r["audit"])
            if r["part"]:
                digest.update((("\n" if begun else "") + r["part"]).encode())
                begun = True
        yield total | {"conv_id": conv, "gaps": last - first + 1 - n if n else 0, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}


def joined(pieces: DataFrame) -> DataFrame:
    """Results of conversations that lie in several pieces, or may do so."""
    seen = pieces.select("at", F.explode(F.array_distinct("keys")).alias("key"))
    several = seen.groupBy("key").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    late = seen.join(several, "key").where("at > first").groupBy("at").agg(F.collect_list("key").alias("late"))
    marked = pieces.select("conv_id", "at", "symbols", "keys").join(late, "at", "left")
    marked = materialise(_mapped(marked, _marked, "conv_id bigint, at bigint, symbols string, matrix array<bigint>"), "marked-turns")
    after = _mapped(_in_order(marked.select("conv_id", "at", "matrix"), backwards=True), _left_after, "at bigint, after array<bigint>")
    exits = _mapped(marked.join(after, "at"), _exits, "conv_id bigint, at bigint, exits array<bigint>, after array<bigint>, symbols string")
    entries = _mapped(_in_order(exits), _entries, "at bigint, entry bigint, closes bigint, after array<bigint>, faults string")
    parts = _mapped(
        pieces.drop("symbols", "keys").join(entries, "at"), _written,
        "conv_id bigint, at bigint, first_turn bigint, last_turn bigint, n_turns bigint, blank bigint, duplicate bigint, truncated bigint, "
        "first_initial string, last_initial string, illegal bigint, cost bigint, audit string, part string",
    )
    return _mapped(_in_order(parts), _assembled, RESULT)


def repaired(rows: DataFrame) -> DataFrame:
    """One row per conversation: counts of gaps, faults and illegal neighbours, cost and audit of the cheapest repair, and
    the digest of the repaired text. ``rows`` are those of ``damaged``.

    Turns go by number, nulls first, those of one number by role and then by a hash of the text. A null conv_id is one
    conversation; repeated rows are duplicates; an empty table gives no rows; other columns are ignored.
    """
    order = ["conv_id", F.asc_nulls_first("turn"), "role", F.xxhash64("text"), "tie"]
    # equal rows differ in nothing but the tie, which lets a third of all rows be dealt to many tasks
    rows = rows.withColumn("tie", F.monotonically_increasing_id()).orderBy(*order).drop("tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(_pieces(batches), PIECES)

    found = materialise(rows.mapInArrow(run, PIECES), "turns")
    whole = found.where("whole").select(*_RESULT_NAMES)
    return whole.unionByName(joined(found.where("NOT whole").drop("whole", *_RESULT_NAMES[1:])))


def repair(turns: DataFrame) -> DataFrame:
    """The turns of ``turns`` damaged by their hash, then ``repaired``."""
    return repaired(damaged(turns))
