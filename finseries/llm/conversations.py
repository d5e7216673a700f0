"""Conversation structure repair by weighted CYK interval parsing.

Legal conversations are ``(s?(ua)+)?`` over role initials.  In Chomsky normal
form the repair grammar's nonterminals are pairs of positions in that
expression, N[p, r] -> N[p, q] N[q, r]: a span of turns may be repaired so that
it leads from p to r.  A cell holds, for each nonterminal, the smallest
(cost, audit) of all repairs of its span; ``audit`` spells the edits in order
(Keep, Rerole, Delete, Insert).  One turn's cell follows from its role and
fault, and is closed under insertions; longer spans are combined from two
neighbours, bottom-up by span length.  Every split of a span gives the same
cell, as a repair passes some position at any split, so only spans of doubling
length are filled.  (Two different repairs of a span with one cost never have
audits of which one begins with the other, so smaller audits stay smaller when
spans are joined.)

Nothing is gathered by conversation: turns are ordered by one range sort, a
cell covers ``SPAN`` neighbouring turns at most, and the cells of a
conversation are streamed in order, which gives the cost, the audit and the
position at which each span is entered; the spans then write their own
repaired turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finseries.llm.common import release, save, ship_package

#: Fixed value: white space of the contract, for trimming.
BLANKS = " \t\n\x0b\x0c\r"
#: Costs of the edits, and of a truncated turn that stays.
REROLE, DELETE, INSERT, STAYS = 1, 2, 5, 5
#: Turns of a cell at most.
SPAN = 512
#: Rows handed to Arrow at once.
OUT_ROWS = 2_000

FAULTS = ("", "blank", "duplicate", "truncated")
#: Positions in the expression: nothing yet, after s, after u, after a; the first and last are ends.
STATES, ENDS = 4, (0, 3)
#: role initial -> (from, to) positions
MOVES = {"s": ((0, 1),), "u": ((0, 2), (1, 2), (3, 2)), "a": ((2, 3),)}
#: Fixed value: legal neighbours.
PAIRS = ("su", "ua", "au")

Cell = dict[tuple[int, int], tuple[int, str]]


def join(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans."""
    out: Cell = {}
    for (p, q), (c1, a1) in left.items():
        for (q2, r), (c2, a2) in right.items():
            if q == q2:
                best = (c1 + c2, a1 + a2)
                if (p, r) not in out or best < out[p, r]:
                    out[p, r] = best
    return out


@lru_cache
def insertions() -> tuple[tuple[tuple[int, int], tuple[int, str]], ...]:
    """The closure of the empty span: every move by inserted turns alone."""
    cell: Cell = {(p, p): (0, "") for p in range(STATES)}
    step: Cell = cell | {m: (INSERT, "I") for i in "ua" for m in MOVES[i]}
    while (wider := join(cell, step)) != cell:
        cell = wider
    return tuple(cell.items())


@lru_cache(maxsize=1024)
def _turn(initial: str, fault: int) -> tuple[tuple[tuple[int, int], tuple[int, str]], ...]:
    cell: Cell = {(p, p): (DELETE, "D") for p in range(STATES)}
    if FAULTS[fault] not in ("blank", "duplicate"):
        stays = STAYS if FAULTS[fault] == "truncated" else 0
        edits = [(stays, "K", initial)] + [(stays + REROLE, "R", i) for i in "ua"]
        for cost, edit, i in edits:
            for move in MOVES.get(i, ()):
                cell[move] = min(cell.get(move, (cost, edit)), (cost, edit))
    return tuple(join(cell, dict(insertions())).items())


def parse(turns: list[tuple[str, int]]) -> Cell:
    """The cell of a span of (role initial, fault number) turns."""
    cells = [dict(_turn(i, f)) for i, f in turns]
    while len(cells) > 1:
        joined = [join(a, b) for a, b in zip(cells[::2], cells[1::2])]
        cells = joined + cells[len(joined) * 2:]
    return cells[0]


def rewrite(audit: str, state: int, roles: list[str], texts: list[str]) -> list[tuple[str, str]]:
    """The repaired (role, text) turns of a span that is entered at position ``state``."""
    out, k = [], 0
    for edit in audit:
        if edit == "D":
            k += 1
            continue
        if edit == "K" and roles[k][:1] == "s":
            state, role = 1, roles[k]
        else:
            state = 3 if state == 2 else 2
            role = roles[k] if edit == "K" else "user" if state == 2 else "assistant"
        out.append((role, "" if edit == "I" else texts[k]))
        k += edit != "I"
    return out


def _groups(batches: Iterator[pd.DataFrame], columns: list[str]) -> Iterator[tuple[str, list[tuple]]]:
    """(key, rows as tuples of ``columns``) of one span after the other, from rows in which
    (chunk, key) stand together; a span may cross batches."""
    own, held = None, []
    for b in batches:
        for at, row in zip(zip(b["chunk"].tolist(), b["key"].tolist(), strict=True), zip(*(b[c].tolist() for c in columns), strict=True), strict=True):
            if at != own:
                if held:
                    yield own[1], held
                own, held = at, []
            held.append(row)
    if held:
        yield own[1], held


def _frames(columns: list[str], rows: Iterator[tuple]) -> Iterator[pd.DataFrame]:
    """Tuples as frames of bounded size."""
    while held := list(islice(rows, OUT_ROWS)):
        yield pd.DataFrame(held, columns=columns)


def _span_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def rows() -> Iterator[tuple]:
        for key, g in _groups(batches, ["seq", "initial", "fault"]):
            initials = [r[1] for r in g]
            cell = parse([(r[1], r[2]) for r in g])
            illegal = sum(a + b not in PAIRS for a, b in zip(initials, initials[1:]))
            yield (key, g[0][0], illegal, initials[0], initials[-1],
                   [p * STATES + q for p, q in cell], [c for c, _ in cell.values()], [a for _, a in cell.values()])

    return _frames(["key", "span", "illegal", "first", "last", "moves", "costs", "audits"], rows())


_CELLS = "key string, span long, illegal long, first string, last string, moves array<int>, costs array<long>, audits array<string>"
_PATHS = "key string, span long, state int, piece string, ends boolean, cost long, audit string, illegal long"


def _follow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The best way through each conversation's cells, read one after the other."""
    lead = {q: v for (p, q), v in insertions() if p == 0}  # turns may be inserted in front of the first one

    def done(key: str, illegal: int, best: Cell, way: list) -> Iterator[tuple]:
        state = min((q for q in ENDS if q in best), key=lambda q: best[q])
        ends = (True, *best[state], illegal)
        for span, back in reversed(way):
            entered, piece = back[state]
            yield (key, span, entered, piece, *ends)
            state, ends = entered, (False, -1, "", -1)

    def rows() -> Iterator[tuple]:
        key, last, illegal, best, way = None, None, 0, {}, []
        for b in batches:
            for k, span, bad, first, end, moves, costs, audits in zip(*(b[c].tolist() for c in ("key", "span", "illegal", "first", "last", "moves", "costs", "audits")), strict=True):
                if k != key:
                    if key is not None:
                        yield from done(key, illegal, best, way)
                    key, last, illegal, best, way = k, None, 0, lead, []
                illegal += bad + (last is not None and last + first not in PAIRS)
                last = end
                into: dict[int, tuple[int, str]] = {}
                back: dict[int, tuple[int, str]] = {}
                for m, c, a in zip(moves.tolist(), costs.tolist(), audits, strict=True):
                    p, q = divmod(m, STATES)
                    if p in best:
                        new = (best[p][0] + c, best[p][1] + a)
                        if q not in into or new < into[q]:
                            into[q] = new
                            # the first span's piece begins with what was inserted in front of it
                            back[q] = (0, lead[p][1] + a) if not way else (p, a)
                way.append((span, back))
                best = into
        if key is not None:
            yield from done(key, illegal, best, way)

    return _frames(["key", "span", "state", "piece", "ends", "cost", "audit", "illegal"], rows())


def _rewritten(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def rows() -> Iterator[tuple]:
        for key, g in _groups(batches, ["seq", "role", "text", "state", "piece"]):
            span, _, _, state, piece = g[0]
            for i, (role, text) in enumerate(rewrite(piece, state, [r[1] for r in g], [r[2] for r in g])):
                yield key, span, i, role, text

    return _frames(["key", "span", "at", "role", "text"], rows())


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def rows() -> Iterator[tuple]:
        key, digest = None, None
        for b in batches:
            for k, role, text in zip(b["key"].tolist(), b["role"].tolist(), b["text"].tolist(), strict=True):
                line = f"{role}:{text}".encode("utf-8", "surrogatepass")
                if k == key:
                    digest.update(b"\n" + line)
                    continue
                if key is not None:
                    yield key, digest.hexdigest()
                key, digest = k, hashlib.sha256(line)
        if key is not None:
            yield key, digest.hexdigest()

    return _frames(["key", "sha"], rows())


@dataclass
class Repaired:
    """What ``repair`` returns: one row per conversation, and the repaired turns in order."""

    conversations: DataFrame  # conv_id, n_turns, gaps, blank, duplicate, truncated, illegal, cost, audit
    turns: DataFrame  # conv_id, span, at, role, text: in the order of (span, at)
    kind: str

    def digests(self) -> DataFrame:
        """conv_id, sha256 of the repaired ``role:text`` lines; a conversation is streamed, not gathered."""
        keyed = self.turns.select(_key(F.col("conv_id")).alias("key"), "span", "at", "role", "text")
        hashed = keyed.repartition("key").sortWithinPartitions("key", "span", "at").select("key", "role", "text")
        return hashed.mapInPandas(_hashed, "key string, sha string").select(_of(self.kind), "sha")


def _key(conv_id):
    """conv_id as a string that is never null: a null id, or a long one, passes Python unharmed."""
    return F.when(conv_id.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), conv_id.cast("string")))


def _of(kind: str):
    return F.when(F.col("key") != "", F.substring("key", 2, 1 << 30)).cast(kind).alias("conv_id")


def damage(convs: DataFrame) -> DataFrame:
    """``convs`` (conv_id, turn, role, text) with planted faults, by crc32 of ``conv_id:turn`` modulo 20:
    0 drops the row, 1 empties its text, 2 removes its ``[.!?]``, 3 repeats it, 4 makes it the user's.
    Nulls count as one space, in the crc32 too; turn and conv_id stay null."""
    def name(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.concat_ws(":", name("conv_id"), name("turn")).cast("binary")) % 20
    rows = convs.select("conv_id", "turn", name("role").alias("role"), name("text").alias("text"), h.alias("h")).where("h <> 0")
    text = F.when(F.col("h") == 1, F.lit("")).when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (rows.select("conv_id", "turn", F.when(F.col("h") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copies"))
            .select("conv_id", "turn", "role", "text", F.explode("copies").alias("copy")).drop("copy"))


def repair(convs: DataFrame, span: int = SPAN) -> Repaired:
    """Repairs every conversation at the least cost; ties go to the ASCII-least audit.

    Turns stand in the order of turn (nulls first), then role, then SHA-256 of
    the text.  Null roles and texts count as one space, a null conv_id is a
    conversation of its own, repeated rows are duplicates of the first.  Only
    conv_id, turn, role and text are read; an empty table gives empty results.
    A gap count beyond a long is null.
    """
    spark = convs.sparkSession
    ship_package(spark)
    kind = convs.schema["conv_id"].dataType.simpleString()
    one_space = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text")}
    rows = convs.select(_key(F.col("conv_id")).alias("key"), F.col("turn").cast("long").alias("turn"), *(v.alias(c) for c, v in one_space.items()))
    order = ["key", F.asc_nulls_first("turn"), "role", "mark", "row"]
    ordered = (rows.select("key", "turn", "role", "text", F.sha2("text", 256).alias("mark"), F.monotonically_increasing_id().alias("row"))
               .repartitionByRange(*order).sortWithinPartitions(*order).withColumn("seq", F.monotonically_increasing_id()).drop("row"))
    ordered = save(ordered, "conv_turns")
    # the first of equal turns, joined by the unique row number: no conversation is a join key
    first = ordered.groupBy("key", "role", "mark").agg(F.min("seq").alias("seq")).select("seq", F.lit(True).alias("first"))
    shown = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = (F.when(shown == "", 1).when(F.col("first").isNull(), 2).when(~F.right(shown, F.lit(1)).isin(".", "!", "?"), 3).otherwise(0))
    chunk = F.expr(f"seq div {span}")
    judged = save(ordered.join(first, "seq", "left").select("key", "turn", chunk.alias("chunk"), "seq", F.substring("role", 1, 1).alias("initial"), fault.alias("fault")), "conv_judged")
    counts = {name: F.sum((F.col("fault") == i).cast("long")).alias(name) for i, name in enumerate(FAULTS) if i}
    by_turn = judged.groupBy("key", "turn").agg(F.count("*").alias("n"), *counts.values())
    width = F.max("turn").cast("decimal(20,0)") - F.min("turn").cast("decimal(20,0)") + 1 - F.count("turn")
    totals = by_turn.groupBy("key").agg(F.sum("n").alias("n_turns"), F.coalesce(width, F.lit(0)).try_cast("long").alias("gaps"), *(F.sum(n).alias(n) for n in counts))
    # numbered by row, a chunk holds neighbours; its conversations are its spans
    cells = judged.select("key", "chunk", "seq", "initial", "fault").repartition("chunk").sortWithinPartitions("seq").mapInPandas(_span_cells, _CELLS)
    paths = save(save(cells, "conv_cells").repartition("key").sortWithinPartitions("key", "span").mapInPandas(_follow, _PATHS), "conv_paths")
    release(spark)
    result = totals.join(paths.where("ends").select("key", "illegal", "cost", "audit"), "key")
    entered = paths.select(F.col("span").alias("seq"), "state", "piece")
    led = (ordered.join(entered, "seq", "left").select("key", chunk.alias("chunk"), "seq", "role", "text", F.coalesce("state", F.lit(0)).alias("state"), F.coalesce("piece", F.lit("")).alias("piece"))
           .repartition("chunk").sortWithinPartitions("seq"))
    turns = led.mapInPandas(_rewritten, "key string, span long, at int, role string, text string")
    return Repaired(result.select(_of(kind), "n_turns", "gaps", *counts, "illegal", "cost", "audit"),
                    turns.select(_of(kind), "span", "at", "role", "text"), kind)
