"""Periodic runs of words by grammar-compressed run detection.

A run is a stretch of words with smallest period q, at least ``LEAST_WORDS``
words and ``LEAST_PERIODS`` periods long, that no neighbour extends.

1. Re-Pair.  The word ids of a block of documents are compressed by one
   grammar: pairs that occur twice are replaced by nonterminals, in each round
   all pairs that are more frequent than the pairs they overlap, until no pair
   repeats.  What is left of each document is halved into a balanced tree, so
   every stretch of a document crosses the boundary of some nonterminal that
   holds it whole.
2. Boundaries.  For each nonterminal, once, the periods whose square begins or
   ends at its boundary are looked for (a run of four periods that crosses a
   boundary has two of them on one side), and each is extended to both sides
   within the nonterminal.  Multiples of a period lie in that period's stretch
   and are passed over.
3. Positions.  The stretches are moved to every place where the nonterminal is
   derived, and those inside a longer one of the same period are dropped.

Blocks only decide which documents share a grammar, never the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finseries.llm.common import let, map_texts, ship_package

#: Fixed values of the contract.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Words compressed by one grammar (a longer document is a block of its own).
BLOCK = 100_000
#: Squares looked at at once.
SQUARES = 1 << 20

#: Nonterminals: places low <= mid < high in the block's words, and all starts of its derivations.
Nodes = list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def _mixed(values: np.ndarray) -> np.ndarray:
    h = values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ h >> np.uint64(29)


def grammar(words: np.ndarray, doc: np.ndarray) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, np.ndarray]]:
    """Re-Pair over word ids; no pair crosses documents.

    Returns (low, mid, high, spots, of): a nonterminal's first place in the
    words, the place of its boundary and its end; its derivations start at
    ``spots`` where ``of`` is its number.  And (start, document) of the symbols left.
    """
    sym, pos, own = words.astype(np.int64), np.arange(len(words)), doc
    size = np.ones(int(words.max(initial=-1)) + 1, dtype=np.int64)
    lows, mids, highs, spots, numbers, rules = [], [], [], [], [], 0
    live = np.append(own[:-1] == own[1:], False)[:len(own)]
    while True:
        at = np.flatnonzero(live)
        pairs, inverse, n = np.unique(sym[at] * len(size) + sym[np.minimum(at + 1, len(sym) - 1)], return_inverse=True, return_counts=True)
        twice = n[inverse] > 1  # a pair that occurs once never occurs twice again
        at, inverse = at[twice], inverse[twice]
        if not len(at):
            break
        rank = np.empty(len(pairs), dtype=np.int64)
        rank[np.lexsort((_mixed(pairs), n))] = np.arange(1, len(pairs) + 1)
        weight = np.zeros(len(sym) + 2, dtype=np.int64)  # of the pair that starts at i, at i + 1
        weight[at + 1] = rank[inverse]
        top = (weight[at + 1] >= weight[at]) & (weight[at + 1] >= weight[at + 2])
        at_top, pair = at[top], inverse[top]
        # neighbours on top are one symbol in a row: every second pair of such a row
        head = np.diff(at_top, prepend=-2) != 1
        turn = np.arange(len(at_top)) - np.maximum.accumulate(np.where(head, np.arange(len(at_top)), 0))
        take, pair = at_top[turn % 2 == 0], pair[turn % 2 == 0]
        _, first, number = np.unique(pair, return_index=True, return_inverse=True)
        start, mid = pos[take], pos[take] + size[sym[take]]
        high = mid + size[sym[take + 1]]
        lows.append(start[first])
        mids.append(mid[first])
        highs.append(high[first])
        spots.append(start)
        numbers.append(rules + number)
        live = np.zeros(len(sym), dtype=bool)
        live[at] = live[take] = live[np.maximum(take - 1, 0)] = True
        sym[take] = len(size) + number
        size = np.append(size, (high - start)[first])
        rules += len(first)
        stays = np.ones(len(sym), dtype=bool)
        stays[take + 1] = False
        sym, pos, own, live = sym[stays], pos[stays], own[stays], live[stays]
        live[:-1] &= own[:-1] == own[1:]
        live[-1] = False

    def all_of(parts: list[np.ndarray]) -> np.ndarray:
        return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)

    return tuple(map(all_of, (lows, mids, highs, spots, numbers))), (pos, own)


def halved(start: np.ndarray, own: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(low, mid, high) of a balanced tree over each document's remaining symbols."""
    end = np.append(start[1:], words)
    lows, mids, highs = [], [], []
    while len(start):
        fresh = np.diff(own, prepend=-1) != 0
        nth = np.arange(len(own)) - np.maximum.accumulate(np.where(fresh, np.arange(len(own)), 0))
        left = np.flatnonzero((nth[:-1] % 2 == 0) & (own[:-1] == own[1:]))
        if not len(left):
            break
        lows.append(start[left])
        mids.append(end[left])
        highs.append(end[left + 1])
        end[left] = end[left + 1]
        stays = np.ones(len(own), dtype=bool)
        stays[left + 1] = False
        start, end, own = start[stays], end[stays], own[stays]
    empty = np.zeros(0, dtype=np.int64)
    return tuple(np.concatenate(x) if x else empty for x in (lows, mids, highs))


def _extent(w: np.ndarray, low: int, at: int, high: int, q: int) -> tuple[int, int]:
    """The longest stretch of period ``q`` within [low, high) around the words from ``at`` on."""
    i, step = at, 64
    while i < high - q:
        j = min(i + step, high - q)
        differs = w[i:j] != w[i + q:j + q]
        if differs.any():
            i += int(differs.argmax())
            break
        i, step = j, 2 * step
    end = min(i, high - q) + q
    i, step = at, 64
    while i > low:
        j = max(i - step, low)
        differs = (w[j:i] != w[j + q:i + q])[::-1]
        if differs.any():
            i -= int(differs.argmax())
            break
        i, step = j, 2 * step
    return i, end


def _squares(w: np.ndarray, node: np.ndarray, at: np.ndarray, most: np.ndarray, sign: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(node, start, period) of likely squares that begin at (sign 1) or end at (sign -1) each place, by rising period."""
    upto = np.cumsum(most)
    k = 0
    while k < len(node):
        base = upto[k - 1] if k else 0
        j = max(k + 1, int(np.searchsorted(upto, base + SQUARES, side="right")))
        n = most[k:j]
        row = np.repeat(np.arange(k, j), n)
        q = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + 1
        start = at[row] if sign > 0 else at[row] - 2 * q
        for part in (lambda q: 0, lambda q: q - 1, lambda q: q // 2):  # first, last and middle words
            i = start + part(q)
            same = w[i] == w[i + q]
            row, q, start = row[same], q[same], start[same]
        yield node[row], start, q
        k = j


def crossing(w: np.ndarray, low: np.ndarray, mid: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(node, start, end, period) of the periodic stretches around each node's boundary, within the node."""
    out: list[tuple[int, int, int, int]] = []
    large = np.flatnonzero(high - low >= LEAST_WORDS)
    for sign in (1, -1):
        side = high[large] - mid[large] if sign > 0 else mid[large] - low[large]
        most = np.minimum((high - low)[large] // LEAST_PERIODS, side // 2)
        for nodes, starts, periods in _squares(w, large, mid[large], most, sign):
            last, known = -1, []
            for x, s, q in zip(nodes.tolist(), starts.tolist(), periods.tolist(), strict=True):
                if x != last:
                    last, known = x, []
                if any(a <= s and s + 2 * q <= b for a, b in known):
                    continue  # a multiple of a smaller period
                a, b = _extent(w, int(low[x]), s, int(high[x]), q)
                if b - s >= 2 * q:
                    known.append((a, b))
                    if b - a >= max(LEAST_WORDS, LEAST_PERIODS * q):
                        out.append((x, a, b, q))
    table = np.array(out, dtype=np.int64).reshape(-1, 4)
    return table[:, 0], table[:, 1], table[:, 2], table[:, 3]


def runs_of_block(words: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of a block of documents, sorted by start and period."""
    (low, mid, high, spots, of), (start, own) = grammar(words, doc)
    tree = halved(start, own, len(words))
    rules = len(low)
    node, a, b, q = crossing(words, *(np.concatenate(x) for x in zip((low, mid, high), tree, strict=True)))
    order = np.argsort(of, kind="stable")
    spots, first = spots[order], np.searchsorted(of[order], np.arange(rules + 1))
    found = []
    for x, s, e, p in zip(node.tolist(), a.tolist(), b.tolist(), q.tolist(), strict=True):
        shift = spots[first[x]:first[x + 1]] - low[x] if x < rules else np.zeros(1, dtype=np.int64)
        found.append(np.stack([s + shift, e + shift, np.full(len(shift), p)], axis=1))
    every = np.concatenate(found) if found else np.zeros((0, 3), dtype=np.int64)
    every = every[np.lexsort((-every[:, 1], every[:, 0], every[:, 2]))]
    reach, kept, period = -1, [], -1
    for s, e, p in every.tolist():
        if p != period:
            reach, period = -1, p
        if e > reach:
            kept.append((s, e, p))
            reach = e
    kept.sort(key=lambda r: (r[0], r[2]))
    table = np.array(kept, dtype=np.int64).reshape(-1, 3)
    return table[:, 0], table[:, 1], table[:, 2]


def _block(texts: list[list[bytes]]) -> tuple[list[list[list[int]]], list[bytes]]:
    """Runs (start, length, period) and collapsed text of each document of a block."""
    flat = [x for t in texts for x in t]
    number = {x: i for i, x in enumerate(dict.fromkeys(flat))}
    words = np.fromiter(map(number.__getitem__, flat), dtype=np.int64, count=len(flat))
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    first = np.cumsum(sizes) - sizes
    start, end, period = runs_of_block(words, np.repeat(np.arange(len(texts)), sizes))
    of = np.searchsorted(first + sizes, start, side="right")
    runs: list[list[list[int]]] = [[] for _ in texts]
    for d, s, e, q in zip(of.tolist(), (start - first[of]).tolist(), (end - first[of]).tolist(), period.tolist(), strict=True):
        runs[d].append([s, e - s, q])
    collapsed = []
    for t, own in zip(texts, runs, strict=True):
        if own:
            gone = np.zeros(len(t), dtype=bool)
            for s, n, q in own:
                gone[s + q:s + n] = True
            t = [x for x, g in zip(t, gone.tolist(), strict=True) if not g]
        collapsed.append(b" ".join(t))
    return runs, collapsed


def _found(texts: list[str | None]) -> dict[str, list]:
    """Columns n_words, runs and collapsed of a list of texts, block by block."""
    out: dict[str, list] = {"n_words": [], "runs": [], "collapsed": []}
    held: list[list[bytes]] = []

    def flush() -> None:
        runs, collapsed = _block(held)
        out["runs"] += runs
        out["collapsed"] += [c.decode("utf-8", "surrogatepass") for c in collapsed]
        held.clear()

    size = 0
    for text in texts:
        words = (text or "").encode("utf-8", "surrogatepass").split()  # bytes: ASCII white space only
        out["n_words"].append(len(words))
        if held and size + len(words) > BLOCK:
            flush()
            size = 0
        held.append(words)
        size += len(words)
    if held:
        flush()
    return out


def find(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs, collapsed.

    ``runs`` are (start, length, period) by start, then period, in words from
    0; ``collapsed`` is the text without the words that a run repeats, words
    joined by one space.  A null or empty text has no words, no runs and an
    empty ``collapsed``.  Rows do not depend on each other; only doc_id and
    text are read.
    """
    ship_package(docs.sparkSession)
    found = map_texts(docs.select("doc_id", "text"), lambda: _found, "n_words long, runs array<array<long>>, collapsed string")
    runs = F.transform("runs", lambda r: F.struct(r[0].alias("start"), r[1].alias("length"), r[2].alias("period")))
    return found.select("doc_id", "n_words", runs.alias("runs"), "collapsed")


def plant(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) where every tenth text, by crc32 of its doc_id, ends in a run.

    With h that crc32, g = h div 10 and n words: if h is divisible by 10, each
    word i >= a = g mod n becomes word a + (i - a) mod p, with
    p = 1 + (n - a) div (3 + g mod 8).  Null ids and texts without words stay.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def changed(w: Column) -> Column:
        n, g = F.size(w), F.expr("crc32(cast(cast(doc_id as string) as binary)) div 10")
        return let(F.struct(w.alias("w"), (g % n).cast("int").alias("a"), g.alias("g"), n.alias("n")), lambda x: let(
            F.struct(x["w"].alias("w"), x["a"].alias("a"), (1 + F.floor((x["n"] - x["a"]) / (3 + x["g"] % 8))).cast("int").alias("p")),
            lambda y: F.array_join(F.transform(y["w"], lambda v, i: F.when(i < y["a"], v).otherwise(y["w"][y["a"] + (i - y["a"]) % y["p"]])), " ")))

    hit = F.coalesce(h % 10 == 0, F.lit(False))
    return docs.select("doc_id", F.when(hit, let(words, lambda w: F.when(F.size(w) > 0, changed(w)).otherwise(F.lit("")))).otherwise(F.col("text")).alias("text"))
