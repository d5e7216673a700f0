"""Substring dedup by fixed-block anchors: repeated word windows across documents.

A window of ``window`` words that occurs in a document with a smaller doc_id is
a repeat; every word that a repeat covers goes.  A window's anchors are its
blocks of ``(window + 1) // 2`` words with the smallest hash.  They depend on
the window's words alone, so equal windows have equal anchors at the same
places (winnowing).  So:

1. Anchors: the hash of every block that is an anchor of some window, about one
   block in four.
2. Spots: every place of a hash that stands under two doc_ids at least.
3. Extend: around spots the full windows are compared by a 128-bit hash; the smallest doc_id of each decides.  Runs of repeats merge
   into maximal exact repeats.

Hashes are pre-aggregated (smallest and largest doc_id of each block, smallest
of each window), so a passage in very many documents costs its occurrences,
never its pairs.  Hash space is compared in ``SLICES`` parts, one after the
other, which bounds shuffle space to a part of the anchors whatever the corpus
size.  Words are hashed where they stand in the texts' bytes, without being cut
out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finseries.llm.common import discard, map_texts, release, save, ship_package

#: Passes over the hash space.
SLICES = 2
#: Texts taken out of an Arrow batch at once, and bytes whose words are hashed at once.
TEXTS = 200
BLOCK_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def split_words(text: str | None) -> list[bytes]:
    """``[^\\x20\\x09-\\x0D]+`` words, unchanged, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").split()


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random 64-bit number per byte, and an odd base's powers with their inverses modulo 2^64."""
    up = np.full(BLOCK_BYTES, _BASE, dtype=np.uint64)
    down = np.full(BLOCK_BYTES, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.random.default_rng(20240601).integers(1, 1 << 63, size=256, dtype=np.uint64), np.multiply.accumulate(up), np.multiply.accumulate(down)


def _hashed_words(data: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """A mixed 64-bit hash of the bytes of each word [low, high)."""
    table, up, down = _tables()
    base, n = int(low[0]), int(high[-1] - low[0])
    prefix = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(table[data[base:base + n]] * up[:n], out=prefix[1:])
    h = (prefix[high - base] - prefix[low - base]) * down[low - base]
    h ^= h >> np.uint64(32)
    h *= _MIX[0]
    return h ^ h >> np.uint64(29)


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words of texts in a row, number of words up to each text's end).

    ``data`` holds the texts' bytes, ``ends`` the places behind them.  Words are
    the runs of bytes other than 0x20 and 0x09 to 0x0D; they are hashed in
    blocks of ``BLOCK_BYTES`` at most (a longer word by itself).
    """
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = (data != 0x20) & ((data < 0x09) | (data > 0x0D))
    first = np.zeros(len(data) + 1, dtype=bool)
    first[ends[ends < len(data)]] = True
    first[0] = True
    low = np.flatnonzero(inside[1:-1] & (~inside[:-2] | first[:-1]))
    high = np.flatnonzero(inside[1:-1] & (~inside[2:] | first[1:])) + 1
    out, k = [], 0
    while k < len(low):
        j = int(np.searchsorted(high, low[k] + BLOCK_BYTES, side="right"))
        if j == k:  # a word longer than a block
            word = data[low[k]:high[k]].tobytes()
            out.append(np.array([xxhash.xxh3_64_intdigest(word)], dtype=np.uint64))
            j = k + 1
        else:
            out.append(_hashed_words(data, low[k:j], high[k:j]))
        k = j
    return (np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)), np.searchsorted(low, ends)


def gram_hashes(hashes: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """A mixed 64-bit hash of each run of ``n`` words (a polynomial in their hashes)."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = hashes[:size] ^ np.uint64(seed)
    for j in range(1, n):
        out *= _MIX[seed]
        out += hashes[j:j + size]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    return out ^ out >> np.uint64(29)


def text_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, word hashes of their texts in a row, number of words up to each text's end) for ``TEXTS`` rows at a time."""
    for whole in batches:
        for i in range(0, whole.num_rows, TEXTS):
            b = whole.slice(i, TEXTS)
            column = pc.fill_null(b.column("text"), "")
            column = column.cast(pa.large_binary())
            ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
            data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[ends[0]:ends[-1]]
            yield b, *word_hashes(data, ends[1:] - ends[0])


def anchors(h: np.ndarray, fits: np.ndarray, reach: int) -> np.ndarray:
    """Whether each block (of hashes ``h``) has the smallest hash of the ``reach`` blocks of some window;
    ``fits`` tells at which places windows start."""
    least = h[:len(fits)].copy()
    for j in range(1, reach):
        np.minimum(least, h[j:j + len(fits)], out=least)
    hit = np.zeros(len(h), dtype=bool)
    for j in range(reach):
        hit[j:j + len(fits)] |= fits & (h[j:j + len(fits)] == least)
    return hit


def _anchor_rows(texts: DataFrame, window: int, block: int) -> DataFrame:
    """(h, doc, pos) of every anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, words, ends in text_slices(batches):
            size = len(words) - window + 1
            if size <= 0:
                continue
            h = gram_hashes(words, block)
            of = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
            fits = np.arange(size) + window <= ends[of[:size]]
            at = np.flatnonzero(anchors(h, fits, window - block + 1))
            of = of[at]
            if len(at):
                doc = b.column("doc_id").to_numpy()[of]
                yield pa.RecordBatch.from_arrays([pa.array(h[at].view(np.int64)), pa.array(doc), pa.array((at - np.append(0, ends)[of]).astype(np.int32))],
                                                 names=["h", "doc", "pos"])

    return texts.select("doc_id", "text").mapInArrow(run, "h long, doc long, pos int")


def _spots(found: DataFrame, slice_no: int) -> DataFrame:
    """(doc, pos) of the anchors of one slice of the hash space whose hash stands under several doc_ids."""
    part = found.where(F.pmod("h", F.lit(SLICES)) == slice_no)
    several = part.groupBy("h").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last").select("h")
    return save(part.join(several.hint("SHUFFLE_HASH"), "h", "left_semi").select("doc", "pos"), "substring_spots")


def _windows(docs: DataFrame, spots: DataFrame, window: int, block: int) -> DataFrame:
    """(h1, h2, doc, at) of every full window that holds a spot's block; ``at`` is its place
    behind 32 bits of the text's hash, which tells texts with one doc_id apart."""
    lists = spots.groupBy("doc").agg(F.collect_set("pos").alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, words, ends in text_slices(batches):
            size = len(words) - window + 1
            if size <= 0:
                continue
            starts = np.append(0, ends)
            column = b.column("at")
            edges = column.offsets.to_numpy()
            spot = column.values.to_numpy()[edges[0]:edges[-1]]
            of = np.repeat(np.arange(len(ends)), np.diff(edges))
            near = np.zeros(size + 1, dtype=np.int32)
            np.add.at(near, np.clip(np.maximum(starts[of] + spot - (window - block), starts[of]), 0, size), 1)
            np.add.at(near, np.clip(starts[of] + spot + 1, 0, size), -1)
            doc = np.repeat(np.arange(len(ends)), np.diff(starts))[:size]
            pos = np.flatnonzero((np.cumsum(near[:-1]) > 0) & (np.arange(size) + window <= ends[doc]))
            if len(pos):
                doc = doc[pos]
                mark = np.array([_mark(words[i:j]) for i, j in zip(starts[:-1], starts[1:], strict=True)], dtype=np.int64)
                h1, h2 = (gram_hashes(words, window, s)[pos].view(np.int64) for s in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(h1), pa.array(h2), pa.array(b.column("doc_id").to_numpy()[doc]), pa.array(pos - starts[doc] | mark[doc])],
                                                 names=["h1", "h2", "doc", "at"])

    near = docs.join(lists, docs.doc_id == lists.doc).select("doc_id", "text", "at")
    return near.mapInArrow(run, "h1 long, h2 long, doc long, at long")


def _mark(hashes: np.ndarray) -> int:
    """31 bits of a hash of a text's words, above the 32 bits of a place."""
    return (xxhash.xxh3_64_intdigest(hashes.tobytes()) & 0x7FFFFFFF) << 32


def kept_text(words: list[bytes], starts, window: int) -> tuple[int, bytes]:
    """(words removed, kept words joined by a space) when windows start at ``starts``."""
    cover = np.zeros(len(words) + 1, dtype=np.int32)
    starts = np.asarray(starts, dtype=np.int64)
    starts = starts[starts <= len(words) - window]
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + window, -1)
    gone = np.cumsum(cover[:-1]) > 0
    return int(gone.sum()), b" ".join(w for w, g in zip(words, gone, strict=True) if not g)


def _summary(rows: DataFrame) -> DataFrame:
    """(doc_id, k1, k2, n_words, sha) per row; ``sha`` is the digest of all words joined by a space."""

    def compute(texts: list[str | None]) -> dict[str, list]:
        out: dict[str, list] = {"n_words": [], "sha": []}
        for t in texts:
            words = split_words(t)
            out["n_words"].append(len(words))
            out["sha"].append(hashlib.sha256(b" ".join(words)).hexdigest())
        return out

    return map_texts(rows, lambda: compute, "n_words long, sha string")


def remove_repeats(docs: DataFrame, window: int = 13) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept (text), kept_sha256.

    ``kept`` is null for a document from which nothing goes.  Documents with a
    null doc_id are never compared (they lose nothing and remove nothing), a
    null text has no words, and rows with equal doc_ids do not count as
    smaller than each other.  Only doc_id and text are read.

    Of equal texts only the one with the smallest doc_id is looked at; the
    others lose all their words if these make a window.
    """
    spark = docs.sparkSession
    ship_package(spark)
    block = (window + 1) // 2
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("k1"), F.hash("text").alias("k2"), "text")
    base = save(_summary(rows), "substring_base")
    texts = save(rows.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).groupBy("k1", "k2")
                 .agg(F.min("doc_id").alias("doc_id"), F.first("text").alias("text")), "substring_texts")
    release(spark)
    found = save(_anchor_rows(texts, window, block), "substring_anchors")
    discard(texts)
    release(spark)
    parts = []
    for slice_no in range(SLICES):
        parts.append(_spots(found, slice_no))
        release(spark)
    discard(found)
    spots = reduce(DataFrame.unionByName, parts)
    named = rows.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    windows = save(_windows(named, spots, window, block), "substring_windows")
    discard(*parts)
    release(spark)
    least = windows.groupBy("h1", "h2").agg(F.min("doc").alias("first"))
    repeats = save(windows.join(least, ["h1", "h2"]).where("doc > first").groupBy("doc").agg(F.collect_set("at").alias("starts")), "substring_repeats")
    discard(windows)
    release(spark)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, hashes, ends in text_slices(batches):
            done = []
            for t, at, i, j in zip(b.column("text").to_pylist(), b.column("starts").to_pylist(), np.append(0, ends[:-1]), ends, strict=True):
                at = np.array(at, dtype=np.int64)
                done.append(kept_text(split_words(t), (at & 0xFFFFFFFF)[at >> 32 == _mark(hashes[i:j]) >> 32], window))
            made = [pa.array([n for n, _ in done], pa.int64()), pa.array([k.decode("utf-8", "surrogatepass") for _, k in done]),
                    pa.array([hashlib.sha256(k).hexdigest() for _, k in done])]
            yield pa.RecordBatch.from_arrays([b.column("k1"), b.column("k2"), b.column("doc_id"), *made], names=["k1", "k2", "of", "gone", "kept", "digest"])

    some = (named.join(repeats, named.doc_id == repeats.doc).select("k1", "k2", "doc_id", "text", "starts")
            .mapInArrow(cut, "k1 long, k2 int, of long, gone long, kept string, digest string").where("gone > 0")
            .dropDuplicates(["k1", "k2", "of"]))
    firsts = base.groupBy("k1", "k2").agg(F.min("doc_id").alias("first"))
    out = base.join(firsts, ["k1", "k2"], "left").join(
        some.withColumnRenamed("of", "first"), ["k1", "k2", "first"], "left")
    copy = F.coalesce((F.col("doc_id") > F.col("first")) & (F.col("n_words") >= window), F.lit(False))
    lost = F.coalesce((F.col("doc_id") == F.col("first")) & F.col("gone").isNotNull(), F.lit(False))
    return out.select(
        "doc_id", "n_words", F.when(copy, F.col("n_words")).when(lost, F.col("gone")).otherwise(0).cast("long").alias("n_removed"),
        F.when(copy, F.lit("")).when(lost, F.col("kept")).alias("kept"),
        F.when(copy, F.sha2(F.lit("").cast("binary"), 256)).when(lost, F.col("digest")).otherwise(F.col("sha")).alias("kept_sha256"))
