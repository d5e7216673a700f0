"""SimHash near-duplicates by anchor-point covering.

Fingerprints: 64 bits, one vote per word shingle (XXH64, seed 42).

Links: the anchors are the code words of the perfect binary Golay code
[23,12] (covering radius 3) on bits 0-22, times the same code on bits 23-45.
Each fingerprint has one *home* anchor, the only one within the covering
radius in both halves.  A fingerprint is also replicated to every anchor that
is the home of some word within ``max_bits`` of it (these lie within covering
radius plus ``max_bits``).  Two fingerprints within ``max_bits`` therefore meet
at the home of either of them, and the equi-join on the anchor with the exact
bit distance as join condition finds each such pair once.  There are 2^24
anchors and about 61 replicas for two bits, whatever the size of the corpus.

Only distinct fingerprints are joined; copies share one node.  A fingerprint
has at most 2,080 others within two bits, so links cannot grow with the
square of a group of near copies.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finseries.llm.common import map_texts, release, save, ship_package, spare
from finseries.llm.components import components

HASH_SEED = 42
#: Shingles voted on at once: bounds memory on very long texts.
VOTE_BLOCK = 1 << 16

#: Fixed value: generator polynomial of the binary Golay code [23,12].
GOLAY = 0b110001110101
BLOCK_BITS = 23


def text_fingerprint(text: str | None, shingle: int) -> int:
    """SimHash of one text as an unsigned 64-bit number; no words give 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=HASH_SEED), grams), dtype="<u8", count=n)
    votes = np.zeros(64, dtype=np.int64)
    for i in range(0, n, VOTE_BLOCK):
        block = hashes[i:i + VOTE_BLOCK]
        votes += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, thash, fp) per row; ``thash`` is XXH64 of the text, ``fp`` the fingerprint as a signed long."""
    ship_package(docs.sparkSession)

    def compute(texts: list[str | None]) -> dict[str, np.ndarray]:
        return {"fp": np.array([text_fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)}

    return map_texts(docs.select("doc_id", F.xxhash64("text").alias("thash"), "text"), lambda: compute, "fp long")


def _syndrome(v: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit polynomials by the Golay generator: 11 bits."""
    v = v.astype(np.int64)
    for bit in range(BLOCK_BITS - 1, 10, -1):
        v = np.where(v >> bit & 1, v ^ (GOLAY << (bit - 11)), v)
    return v


@lru_cache
def _patterns(weight: int) -> np.ndarray:
    return np.array([sum(1 << i for i in c) for c in combinations(range(BLOCK_BITS), weight)], dtype=np.int64)


@lru_cache
def _leaders() -> np.ndarray:
    """The error pattern of weight 3 at most for each of the 2,048 syndromes."""
    out = np.zeros(1 << 11, dtype=np.int64)
    for weight in range(4):
        out[_syndrome(_patterns(weight))] = _patterns(weight)
    return out


@lru_cache
def _offsets(max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per level d: (first, values) of the offsets from a word to the anchors that
    are homes of words at distance d but of none nearer, by the word's syndrome."""
    seen: list[set[int]] = [set() for _ in range(1 << 11)]
    levels = []
    for d in range(max_bits + 1):
        e = _patterns(d)
        reach = e[None, :] ^ _leaders()[np.arange(1 << 11)[:, None] ^ _syndrome(e)[None, :]]
        new = [sorted(set(row) - s) for row, s in zip(reach.tolist(), seen, strict=True)]
        for row, s in zip(new, seen, strict=True):
            s.update(row)
        first = np.cumsum([0, *map(len, new)])
        levels.append((first, np.array([x for row in new for x in row], dtype=np.int64)))
    return levels


def _halves(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = (1 << BLOCK_BITS) - 1
    return fp & mask, (fp >> BLOCK_BITS) & mask


def home_anchor(fp: np.ndarray) -> np.ndarray:
    low, high = _halves(fp)
    low, high = low ^ _leaders()[_syndrome(low)], high ^ _leaders()[_syndrome(high)]
    return low | high << BLOCK_BITS


def replica_anchors(fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row number, anchor): the homes of all words within ``max_bits`` of each fingerprint."""
    low, high = _halves(fp)
    s_low, s_high = _syndrome(low), _syndrome(high)
    levels = _offsets(max_bits)
    rows, anchors = [], []
    for d1 in range(max_bits + 1):
        for d2 in range(max_bits + 1 - d1):
            (f1, v1), (f2, v2) = levels[d1], levels[d2]
            n1, n2 = np.diff(f1)[s_low], np.diff(f2)[s_high]
            row = np.repeat(np.arange(len(fp)), n1 * n2)
            k = np.arange(len(row)) - np.repeat(np.cumsum(n1 * n2) - n1 * n2, n1 * n2)
            a1 = low[row] ^ v1[f1[s_low[row]] + k // n2[row]]
            a2 = high[row] ^ v2[f2[s_high[row]] + k % n2[row]]
            rows.append(row)
            anchors.append(a1 | a2 << BLOCK_BITS)
    return np.concatenate(rows), np.concatenate(anchors)


#: Fingerprints replicated at once inside a task.
REPLICA_BLOCK = 20_000


def links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints (column ``fp``) within ``max_bits`` bits, each once, a < b."""
    ship_package(fps.sparkSession)

    def homes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = b["fp"].to_numpy()
            yield pd.DataFrame({"anchor": home_anchor(fp), "a": fp})

    def replicas(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(0, len(b), REPLICA_BLOCK):
                fp = b["fp"].to_numpy()[i:i + REPLICA_BLOCK]
                row, anchor = replica_anchors(fp, max_bits)
                yield pd.DataFrame({"anchor": anchor, "b": fp[row]})

    h = fps.select("fp").mapInPandas(homes, "anchor long, a long")
    r = fps.select("fp").mapInPandas(replicas, "anchor long, b long")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    # the replicas are many times the table they come from: never a broadcast
    return h.join(r.hint("merge"), (h.anchor == r.anchor) & (F.col("a") < F.col("b")) & near).select("a", "b")


def simhash_groups(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per row of ``docs``: doc_id, thash, fp, root, component_id.

    ``component_id`` is the smallest doc_id reachable over links of at most
    ``max_bits`` differing bits (itself included); ``root`` is the component's
    smallest fingerprint.  Texts without words, null included, have
    fingerprint zero and link like any other.  Null doc_ids take part but are
    never a component_id unless the component has no other.  Repeated rows
    share a component.  Only doc_id and text are read, so other columns may
    have any name; an empty table gives an empty result.
    """
    rows = save(fingerprints(docs, shingle), "fingerprints")
    nodes = save(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    comp = components(links(nodes, max_bits))
    release(docs.sparkSession)
    rooted = nodes.join(comp, nodes.fp == comp.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of = rooted.join(least, "root").select("fp", "root", "component_id")
    return rows.join(of, "fp").select("doc_id", "thash", "fp", "root", "component_id")


def keep_first(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with one document of each near-duplicate group, the one with the smallest doc_id.

    A repeated row (same doc_id and text) is kept once.  All columns of ``docs`` are returned, whatever their names.
    """
    # a null-safe key of plain columns: rows that the join brings together need no second shuffle to be told apart
    names = spare(docs, "key_id", "key_null", "key_hash")
    key = [F.coalesce("doc_id", F.lit(0).cast(docs.schema["doc_id"].dataType)), F.col("doc_id").isNull(), F.xxhash64("text")]
    groups = simhash_groups(docs.select("doc_id", "text"), shingle, max_bits)
    kept = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(F.min(F.struct("doc_id", "thash")).alias("k"))
    kept = kept.select(F.coalesce("k.doc_id", F.lit(0).cast(docs.schema["doc_id"].dataType)).alias(names[0]), F.col("k.doc_id").isNull().alias(names[1]), F.col("k.thash").alias(names[2]))
    keyed = docs.withColumns(dict(zip(names, key, strict=True)))
    return keyed.join(kept, names, "left_semi").dropDuplicates(names).select(*docs.columns)
