"""SentencePiece encoding and decoding over a relational lattice.

A text (spaces as U+2581, one in front) falls into *units*: a run of U+2581
and what follows up to the next one.  No piece of a model that splits at white
space crosses a unit, so a text's ids are its units' ids in a row.

The lattice of the ``common`` most frequent units is built relationally:
bounded-length substrings are exploded, equi-joined with the piece table (a
model's vocabulary, so a bounded broadcast) and grouped by unit; a Spark
higher-order ``aggregate`` then folds each unit's edges into ids:

* ``viterbi``: the path with the best sum of scores (unigram models);
* ``merge``: adjacent spans are joined in order of score as long as the joined
  span is an edge (BPE models, whose scores are merge ranks: their own
  encoder's result, which the best sum would not give).

Their ids go to the tasks as a bounded dictionary of ``common`` units.  Units
beyond it are folded by the same rules inside the task that reads the document
(all of a batch at once, as arrays; very long ones by a heap), so nothing but
the unit counts is ever shuffled.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finseries.llm.common import let, map_texts, ship_package

SPACE = "▁"
UNIT = re.compile(f"{SPACE}+[^{SPACE}]*")
#: Units in the broadcast dictionary (about 10 MB in a Python worker).
COMMON = 50_000
#: Longer units are folded inside the task, by a heap.
LATTICE_CHARS = 48
#: Units remembered by a task beyond the dictionary, and units folded at once.
MEMO = 100_000
FOLD_UNITS = 20_000
#: Documents turned into an Arrow batch at once.
OUT_ROWS = 500
_NONE = np.int32(0x7FFFFFFF)


@dataclass
class PieceModel:
    pieces: list[str]  # by id
    scores: list[float]
    kind: str  # "viterbi" or "merge"
    unk: int
    byte_ids: list[int]  # 256 ids, or none
    plain: dict[str, int] = field(default_factory=dict)  # pieces that text can match

    @cached_property
    def costs(self) -> dict[str, float]:
        return {p: -self.scores[i] for p, i in self.plain.items()}

    @cached_property
    def spelling(self) -> list[bytes]:
        """The bytes of each id."""
        byte = {i: bytes([b]) for b, i in enumerate(self.byte_ids)}
        return [byte.get(i, p.encode()) for i, p in enumerate(self.pieces)]

    @cached_property
    def chars(self) -> np.ndarray:
        """The piece of each code point; the number of pieces where there is none."""
        out = np.full(0x110000, len(self.pieces), dtype=np.int32)
        for p, i in self.plain.items():
            if len(p) == 1:
                out[ord(p)] = i
        return out

    @cached_property
    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(left and right piece as one sorted key, their joined piece, its place in the order of scores)."""
        place = {c: i for i, c in enumerate(sorted({self.costs[p] for p in self.plain}))}
        base = len(self.pieces) + 1
        rows = sorted((self.plain[p[:k]] * base + self.plain[p[k:]], i, place[self.costs[p]])
                      for p, i in self.plain.items() for k in range(1, len(p)) if p[:k] in self.plain and p[k:] in self.plain)
        table = np.array(rows, dtype=np.int64).reshape(-1, 3)
        return table[:, 0], table[:, 1].astype(np.int32), table[:, 2].astype(np.int32)

    @property
    def longest(self) -> int:
        return max(map(len, self.plain), default=1)

    @property
    def floor(self) -> float:
        """Score of a character without a piece: below every piece."""
        return min((self.scores[i] for i in self.plain.values()), default=0.0) - 10.0


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = data[at]
        value, at, shift = value | (b & 0x7F) << shift, at + 1, shift + 7
        if b < 0x80:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message's fields."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        if key & 7 == 0:
            value, at = _varint(data, at)
        else:
            size, at = (8, at) if key & 7 == 1 else (4, at) if key & 7 == 5 else _varint(data, at)
            value, at = data[at:at + size], at + size
        yield key >> 3, value


def load_model(path: str) -> PieceModel:
    """Vocabulary and algorithm of a SentencePiece ``.model`` file (read on the driver)."""
    import sentencepiece
    with open(path, "rb") as f:
        data = f.read()
    trainer = dict(_fields(next((v for k, v in _fields(data) if k == 2), b"")))
    sp = sentencepiece.SentencePieceProcessor(model_proto=data)
    ids = range(sp.vocab_size())
    model = PieceModel([sp.id_to_piece(i) for i in ids], [sp.get_score(i) for i in ids],
                       "merge" if trainer.get(3) == 2 else "viterbi", sp.unk_id(), [])
    byte_of = {int(p[3:5], 16): i for i, p in enumerate(model.pieces) if sp.is_byte(i)}
    model.byte_ids = [byte_of[b] for b in range(256)] if len(byte_of) == 256 else []
    model.plain = {p: i for i, p in enumerate(model.pieces)
                   if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
    return model


# --- the fold, inside a task ---------------------------------------------------------------


def _fallback(model: PieceModel, char: str) -> list[int]:
    return [model.byte_ids[b] for b in char.encode("utf-8", "surrogatepass")] if model.byte_ids else [model.unk]


def fold_unit(model: PieceModel, unit: str) -> list[int]:
    """Ids of one unit: the same rules as the relational folds."""
    if model.kind != "merge":
        parts = [unit[i:j] for i, j in _viterbi(model, unit)]
    else:
        parts = [unit[i:j] for i, j in _merge(model, unit)]
    out: list[int] = []
    for part in parts:
        at = model.plain.get(part)
        if at is None:
            out.extend(_fallback(model, part))
        else:
            out.append(at)
    return out


def _joined(model: PieceModel, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in the order of scores, piece) of adjacent parts joined; ``_NONE`` where that is no piece."""
    keys, pieces, places = model.pairs
    if not len(keys):
        return np.full(len(left), _NONE), np.zeros(len(left), dtype=np.int32)
    key = left.astype(np.int64) * (len(model.pieces) + 1) + right
    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    hit = keys[at] == key
    return np.where(hit, places[at], _NONE), pieces[at]


def fold_units(model: PieceModel, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all units in a row, ids of each): in every unit the best adjacent pair is joined,
    leftmost first, one per round, until none is a piece."""
    size = np.fromiter(map(len, units), dtype=np.int64, count=len(units))
    code = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    part, place = model.chars[code], np.arange(len(code))
    no = np.arange(len(units))
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # of finished units: (unit, part, place) by part
    first = np.cumsum(size) - size
    order, piece = _joined(model, part, np.append(part[1:], 0))
    order[first + size - 1] = _NONE  # the last part of a unit has no neighbour
    while len(no):
        best = np.minimum.reduceat(order.astype(np.int64) << 32 | np.arange(len(part)), first)
        open_ = best >> 32 != _NONE
        if not open_.all():
            ends = np.repeat(~open_, size)
            done.append((np.repeat(no[~open_], size[~open_]), part[ends], place[ends]))
            part, place, order, piece = part[~ends], place[~ends], order[~ends], piece[~ends]
            gone = np.cumsum(np.where(open_, 0, size))[open_]
            no, size, best = no[open_], size[open_], best[open_]
            at = (best & 0xFFFFFFFF) - gone
        else:
            at = best & 0xFFFFFFFF
        if not len(no):
            break
        part[at] = piece[at]
        order[at] = order[at + 1]  # _NONE if the joined part is now the last
        stays = np.ones(len(part), dtype=bool)
        stays[at + 1] = False
        part, place, order, piece = part[stays], place[stays], order[stays], piece[stays]
        at -= np.arange(len(at))
        size = size - 1
        first = np.cumsum(size) - size
        last = first + size - 1
        right = at[at < last]
        order[right], piece[right] = _joined(model, part[right], part[right + 1])
        left = at[at > first] - 1
        order[left], piece[left] = _joined(model, part[left], part[left + 1])
    unit, part, place = (np.concatenate(x) for x in zip(*done, strict=True))
    by = np.argsort(unit, kind="stable")
    unit, part, place = unit[by], part[by], place[by]
    strange = np.flatnonzero(part == len(model.pieces))
    if len(strange):
        kinds, kind = np.unique(code[place[strange]], return_inverse=True)
        of = [_fallback(model, chr(c)) for c in kinds.tolist()]
        spelled = [of[k] for k in kind.tolist()]
        times = np.ones(len(part), dtype=np.int64)
        times[strange] = [len(x) for x in spelled]
        unit, part = np.repeat(unit, times), np.repeat(part, times)
        part[np.repeat(np.isin(np.arange(len(times)), strange), times)] = [i for x in spelled for i in x]
    return part.astype(np.int32), np.bincount(unit, minlength=len(units))


def _viterbi(model: PieceModel, unit: str) -> list[tuple[int, int]]:
    best, back, longest = [0.0], [0], model.longest
    for end in range(1, len(unit) + 1):
        score, start = best[end - 1] + model.floor, end - 1
        found = False
        for i in range(max(0, end - longest), end):  # the earliest start wins a tie
            at = model.plain.get(unit[i:end])
            if at is not None and (not found and i == end - 1 or best[i] + model.scores[at] > score):
                score, start, found = best[i] + model.scores[at], i, True
        best.append(score)
        back.append(start)
    spans, end = [], len(unit)
    while end:
        spans.append((back[end], end))
        end = back[end]
    return spans[::-1]


def _merge(model: PieceModel, unit: str) -> list[tuple[int, int]]:
    n = len(unit)
    end = list(range(1, n + 1))  # of the span that starts here; 0 once it was joined to its left
    left = list(range(-1, n - 1))
    heap: list[tuple[float, int, int]] = []

    def offer(i: int) -> None:
        if i >= 0 and end[i] < n:
            at = model.plain.get(unit[i:end[end[i]]])
            if at is not None:
                heapq.heappush(heap, (-model.scores[at], i, end[end[i]]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, j = heapq.heappop(heap)
        if not end[i] or end[i] >= n or end[end[i]] != j:
            continue
        mid, end[i] = end[i], j
        end[mid] = 0
        if j < n:
            left[j] = i
        offer(i)
        offer(left[i])
    spans, i = [], 0
    while i < n:
        spans.append((i, end[i]))
        i = end[i]
    return spans


# --- the lattice and its folds, relational -------------------------------------------------


def unit_counts(docs: DataFrame) -> DataFrame:
    """(unit, n) over all whole texts."""
    marked = F.concat(F.lit(SPACE), F.replace("text", F.lit(" "), F.lit(SPACE)))
    units = docs.where(F.length("text") > 0).select(F.explode(F.regexp_extract_all(marked, F.lit(UNIT.pattern), F.lit(0))).alias("unit"))
    return units.groupBy("unit").agg(F.count("*").alias("n"))


def lattice(units: DataFrame, model: PieceModel) -> DataFrame:
    """(unit, edges): for each unit the (start, end, score, id) of its substrings that are pieces."""
    spark = units.sparkSession
    rows = [(p, float(model.scores[i]), i) for p, i in model.plain.items()]
    table = F.broadcast(spark.createDataFrame(rows, "piece string, score double, id int"))  # the vocabulary: bounded by the model
    parts = (units.select("unit", F.explode(F.sequence(F.lit(0), F.length("unit") - 1)).alias("start"))
             .select("unit", "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(model.longest), F.length("unit") - F.col("start")))).alias("size"))
             .select("unit", "start", (F.col("start") + F.col("size")).alias("end"), F.substring("unit", F.col("start") + 1, F.col("size")).alias("piece")))
    edges = parts.join(table, "piece").groupBy("unit").agg(F.collect_list(F.struct("start", "end", "score", "id")).alias("edges"))
    return units.select("unit").join(edges, "unit", "left").select("unit", F.coalesce("edges", F.array().cast(edges.schema["edges"].dataType)).alias("edges"))


def _key(start: Column, end: Column) -> Column:
    return start * 4096 + end


def fold_viterbi(edges: Column, n: Column, floor: float) -> Column:
    """(start, end) spans of the best-scored path; ties go to the earliest start."""
    state = "array<struct<score:double,back:int>>"

    def step(acc: Column, end: Column) -> Column:
        into = F.transform(F.filter(edges, lambda e: e["end"] == end), lambda e: F.struct(
            (acc[e["start"]]["score"] + e["score"]).alias("score"), (-e["start"]).alias("back")))
        gap = F.struct((acc[end - 1]["score"] + floor).alias("score"), (1 - end).alias("back"))
        best = F.array_max(F.concat(into, F.array(gap)))
        return F.concat(acc, F.array(F.struct(best["score"].alias("score"), (-best["back"]).alias("back"))).cast(state))

    ends = F.sequence(F.lit(1), n)
    table = F.aggregate(ends, F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("back"))).cast(state), step)
    span = "array<struct<start:int,end:int>>"
    walked = let(table, lambda t: F.aggregate(
        ends, F.struct(n.alias("at"), F.array().cast(span).alias("spans")),
        lambda acc, _: F.when(acc["at"] == 0, acc).otherwise(F.struct(
            t[acc["at"]]["back"].alias("at"),
            F.concat(F.array(F.struct(t[acc["at"]]["back"].alias("start"), acc["at"].alias("end"))).cast(span), acc["spans"]).alias("spans"))),
        lambda acc: acc["spans"]))
    return walked


def fold_merge(edges: Column, n: Column) -> Column:
    """(start, end) spans after joining adjacent spans in order of score, leftmost first."""
    score = F.map_from_entries(F.transform(edges, lambda e: F.struct(_key(e["start"], e["end"]), e["score"])))

    def step(by: Column):
        def join(cuts: Column, _: Column) -> Column:
            inner = F.when(F.size(cuts) > 2, F.sequence(F.lit(1), F.size(cuts) - 2)).otherwise(F.array().cast("array<int>"))
            best = F.array_max(F.filter(
                F.transform(inner, lambda k: F.struct(F.try_element_at(by, _key(cuts[k - 1], cuts[k + 1])).alias("score"), (-k).alias("at"))),
                lambda x: x["score"].isNotNull()))
            return let(best, lambda b: F.when(b.isNull(), cuts).otherwise(F.filter(cuts, lambda _, i: i != -b["at"])))
        return join

    cuts = let(score, lambda by: F.aggregate(F.sequence(F.lit(1), n), F.sequence(F.lit(0), n), step(by)))
    return let(cuts, lambda c: F.transform(F.sequence(F.lit(0), F.size(c) - 2), lambda i: F.struct(c[i].alias("start"), c[i + 1].alias("end"))))


def unit_ids(units: DataFrame, model: PieceModel) -> DataFrame:
    """(unit, ids) of distinct units by the relational lattice."""
    n = F.length("unit")
    spans = fold_merge(F.col("edges"), n) if model.kind == "merge" else fold_viterbi(F.col("edges"), n, model.floor)
    rows = lattice(units, model).select("unit", "edges", spans.alias("spans"))

    def ids_of(s: Column) -> Column:
        hit = F.filter("edges", lambda e: (e["start"] == s["start"]) & (e["end"] == s["end"]))
        raw = F.hex(F.encode(F.substring(F.col("unit"), s["start"] + 1, s["end"] - s["start"]), "UTF-8"))
        if model.byte_ids:
            table = F.array(*map(F.lit, model.byte_ids))
            other = F.transform(F.sequence(F.lit(1), F.length(raw), F.lit(2)),
                                lambda i: F.element_at(table, F.conv(F.substring(raw, i, F.lit(2)), 16, 10).cast("int") + 1))
        else:
            other = F.array(F.lit(model.unk))
        return F.when(F.size(hit) > 0, F.array(hit[0]["id"])).otherwise(other)

    return rows.select("unit", F.flatten(F.transform("spans", ids_of)).alias("ids"))


# --- documents ------------------------------------------------------------------------------


class Encoder:
    """Ids of texts inside a task: the dictionary, then a bounded memory, then the fold."""

    def __init__(self, model: PieceModel, common: dict[str, tuple[int, ...]]):
        self.model, self.common = model, common
        self._reset()

    def _reset(self) -> None:
        self.number = {u: i for i, u in enumerate(self.common)}
        self.size = np.fromiter(map(len, self.common.values()), dtype=np.int64, count=len(self.common))
        self.ids = np.fromiter((i for x in self.common.values() for i in x), dtype=np.int32, count=int(self.size.sum()))

    def _learn(self, units: list[str]) -> None:
        sizes, ids = [self.size], [self.ids]
        quick = [u for u in units if len(u) <= LATTICE_CHARS] if self.model.kind == "merge" else []
        slow = [u for u in units if len(u) > LATTICE_CHARS] if quick else units
        for i in range(0, len(quick), FOLD_UNITS):
            got, n = fold_units(self.model, quick[i:i + FOLD_UNITS])
            ids.append(got)
            sizes.append(n)
        for u in slow:
            got = fold_unit(self.model, u)
            ids.append(np.array(got, dtype=np.int32))
            sizes.append(np.array([len(got)]))
        for u in quick + slow:
            self.number[u] = len(self.number)
        self.size, self.ids = np.concatenate(sizes), np.concatenate(ids)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, place behind each text's ids, from 0)."""
        units = [UNIT.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        flat = [u for x in units for u in x]
        distinct = set(flat)
        if len(self.number) > len(self.common) + MEMO:
            self._reset()
        if new := distinct.difference(self.number):
            self._learn(list(new))
        no = np.fromiter(map(self.number.__getitem__, flat), dtype=np.int64, count=len(flat))
        start = np.cumsum(self.size) - self.size
        n = self.size[no]
        behind = np.cumsum(n)
        at = np.repeat(start[no] - (behind - n), n) + np.arange(int(n.sum()))
        ends = np.cumsum(np.fromiter(map(len, units), dtype=np.int64, count=len(units)))
        return self.ids[at], np.append(0, behind)[np.append(0, ends)]


def decode_ids(model: PieceModel, ids) -> str:
    """The text of ids: pieces and bytes in a row, U+2581 as space, without the one in front."""
    spelling = model.spelling
    raw = b"".join([spelling[i] for i in ids])
    text = raw.decode("utf-8", "replace").replace(SPACE, " ")
    return text[1:] if text.startswith(" ") else text


def common_ids(docs: DataFrame, model: PieceModel, common: int = COMMON) -> dict[str, tuple[int, ...]]:
    """Ids of the ``common`` most frequent units: at most so many rows reach the driver."""
    top = (unit_counts(docs).where(F.length("unit") <= LATTICE_CHARS)
           .orderBy(F.desc("n"), "unit").limit(common))
    rows = unit_ids(top.repartition(docs.sparkSession.sparkContext.defaultParallelism, "unit"), model).collect()
    return {r["unit"]: tuple(r["ids"]) for r in rows}


def encode_documents(docs: DataFrame, model_path: str, common: int = COMMON) -> DataFrame:
    """doc_id, n_ids, ids, round_trip for every row of ``docs``.

    ``round_trip`` tells whether decoding the ids gives the text back (a text
    that itself holds U+2581 does not).  Null and empty texts have no ids.
    Only doc_id and text are read; repeated rows each get their result.
    """
    spark: SparkSession = docs.sparkSession
    ship_package(spark)
    rows = docs.select("doc_id", "text")
    model = load_model(model_path)
    shared = spark.sparkContext.broadcast((model, common_ids(rows, model, common)))

    def make():
        encoder = Encoder(*shared.value)

        def compute(texts: list[str | None]) -> dict:
            ids, ends = encoder.encode(texts)
            back = [decode_ids(encoder.model, ids[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            return {"n_ids": np.diff(ends), "ids": pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)),
                    "round_trip": [x == (t or "") for x, t in zip(back, texts, strict=True)]}

        return compute

    return map_texts(rows, make, "n_ids long, ids array<int>, round_trip boolean", at_once=OUT_ROWS)
