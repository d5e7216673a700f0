"""Suffix-array dedup of bytes: remove every ``length``-byte string that also starts elsewhere.

1. Anchors.  A position whose ``gram``-byte hash is the smallest of a window of
   ``length - gram + 1`` positions is an anchor.  That depends on the window's
   bytes alone, so two equal ``length``-byte strings hold an anchor at the same
   place.  Only anchors whose gram occurs twice can lie in a repeat.
2. Contexts.  Such an anchor's surroundings (all bytes that a ``length``-byte
   string around it can reach) are one row; equal contexts are one class with
   a count, aggregated map-side, so copies and hot passages cost one row each.
3. Suffix sort.  The classes of a gram are sorted twice by a mergesort whose
   comparison is a binary search over prefix polynomial hashes (Karp, Miller
   and Rosenberg's idea): by the bytes from the anchor on, and by the bytes
   before it, read backwards.  Common extensions of neighbours, found the same
   way and verified byte for byte, tell for every offset of the string around
   the anchor which classes share it.
4. Strings shared by two occurrences are spans of their texts; spans merge per
   text, and the bytes outside them stay.

Grams with more classes than fit a task (``HOT_CLASSES``) take the exact
distributed way instead: one row per class and offset with the string's
128-bit hash, counted by a plain aggregate.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cmp_to_key, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finseries.llm.common import discard, release, save, ship_package

#: Bytes hashed at once on very long texts.
BLOCK = 1 << 20
#: Classes sorted in one task at most (about 6 kB of hashes each); a gram with more goes the distributed way.
HOT_CLASSES = 10_000
#: Texts taken out of an Arrow batch at once.
TEXTS = 200
#: Classes per task aimed at.
TASK_CLASSES = 4_000

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_TABLE = np.random.default_rng(20240229).integers(1, 1 << 63, size=256, dtype=np.uint64)


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers and their inverses modulo 2^64, 0 to n - 1."""
    out = []
    for b in (_BASE, pow(_BASE, -1, 1 << 64)):
        a = np.full(n, b, dtype=np.uint64)
        a[0] = 1
        out.append(np.multiply.accumulate(a))
    return out[0], out[1]


def prefix_hashes(rows: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes of each row of a byte matrix (0 to its width)."""
    up, _ = _powers(max(1, rows.shape[1]))
    out = np.zeros((rows.shape[0], rows.shape[1] + 1), dtype=np.uint64)
    np.cumsum(_TABLE[rows] * up[:rows.shape[1]], axis=1, out=out[:, 1:])
    return out


def rolling_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A mixed 64-bit hash of each run of ``gram`` bytes."""
    size = len(data) - gram + 1
    if size <= 0:
        return np.zeros(0, dtype=np.uint64)
    up, down = _powers(1 << max(10, int(len(data) - 1).bit_length()))
    p = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_TABLE[data] * up[:len(data)], out=p[1:])
    h = (p[gram:] - p[:size]) * down[:size]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ h >> np.uint64(32)


def _sliding(values: np.ndarray, w: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over each ``w`` consecutive values."""
    n = len(values)
    pad = np.pad(values, (0, -n % w), mode="edge").reshape(-1, w)
    ahead = pick.accumulate(pad, axis=1).ravel()
    behind = pick.accumulate(pad[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(behind[:n - w + 1], ahead[w - 1:n])


def anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, gram hashes): every position that has the smallest hash of some window."""
    w = length - gram + 1
    at, values = [], []
    for i in range(0, max(1, len(data) - length + 1), BLOCK):
        h = rolling_hashes(data[i:i + BLOCK + length - 1], gram)
        if len(h) < w:
            break
        least = np.pad(_sliding(h, w, np.minimum), w - 1, mode="constant")  # by window start
        top = _sliding(least, w, np.maximum)  # the largest minimum of the windows around each position
        hit = np.flatnonzero(h == top)
        at.append(hit + i)
        values.append(h[hit])
    if not at:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    pos, first = np.unique(np.concatenate(at), return_index=True)
    return pos, np.concatenate(values)[first]


# --- suffix sort of one task's classes -------------------------------------------------------


def common_extension(hashes: np.ndarray, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of rows i and j (at most ``most``), by binary search over prefix hashes."""
    low, high = np.zeros(len(i), dtype=np.int64), most.astype(np.int64)
    while (low < high).any():
        mid = (low + high + 1) // 2
        same = hashes[i, mid] == hashes[j, mid]
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    return low


def suffix_order(group: np.ndarray, data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, lcp) of rows by (group, bytes): lcp[k] is the common prefix of order[k - 1] and order[k], -1 across groups.

    Python's sort is a mergesort; each comparison takes a logarithmic number of
    prefix-hash comparisons.  Neighbours' extensions are verified on the bytes;
    after a hash collision the rows are compared byte by byte instead.
    """
    hashes = prefix_hashes(data)
    n = size.tolist()

    def compare(i: int, j: int) -> int:
        low, high = 0, min(n[i], n[j])
        a, b = hashes[i], hashes[j]
        while low < high:
            mid = (low + high + 1) // 2
            if a[mid] == b[mid]:
                low = mid
            else:
                high = mid - 1
        if low < n[i] and low < n[j]:
            return int(data[i, low]) - int(data[j, low])
        return n[i] - n[j]

    order: list[int] = []
    bounds = np.flatnonzero(np.diff(group, prepend=group[:1] - 1, append=group[-1:] + 1)) if len(group) else np.zeros(1, dtype=int)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        order.extend(sorted(range(a, b), key=cmp_to_key(compare)))
    at = np.array(order, dtype=np.int64)
    lcp = np.full(len(at), -1, dtype=np.int64)
    i, j = at[:-1], at[1:]
    most = np.minimum(size[i], size[j])
    lcp[1:] = common_extension(hashes, i, j, most)
    differs = data[i] != data[j]
    true = np.minimum(np.where(differs.any(axis=1), differs.argmax(axis=1), data.shape[1]), most)
    if (true != lcp[1:]).any():  # a collision: sort by the bytes themselves
        order = sorted(range(len(size)), key=lambda r: (group[r], data[r, :n[r]].tobytes()))
        at = np.array(order, dtype=np.int64)
        i, j = at[:-1], at[1:]
        differs, most = data[i] != data[j], np.minimum(size[i], size[j])
        lcp[1:] = np.minimum(np.where(differs.any(axis=1), differs.argmax(axis=1), data.shape[1]), most)
    lcp[1:][group[at[:-1]] != group[at[1:]]] = -1
    return at, lcp


def _matrix(parts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    out = np.zeros((len(parts), width), dtype=np.uint8)
    for r, p in enumerate(parts):
        out[r, :len(p)] = np.frombuffer(p, dtype=np.uint8)
    return out, np.array([len(p) for p in parts], dtype=np.int64)


def shared_offsets(gram_no: np.ndarray, before: list[bytes], after: list[bytes], count: np.ndarray, length: int, gram: int) -> np.ndarray:
    """(classes x offsets) of whether the ``length``-byte string that starts ``offset`` bytes before
    the anchor occurs twice; rows of one gram stand together."""
    reach = length - gram
    right, n_right = _matrix(after, length)
    left, n_left = _matrix([b[::-1] for b in before], reach)
    by_right, lcp_right = suffix_order(gram_no, right, n_right)
    by_left, lcp_left = suffix_order(gram_no, left, n_left)
    rows = len(gram_no)
    out = np.zeros((rows, reach + 1), dtype=bool)
    r_class, l_class = np.empty(rows, dtype=np.int64), np.empty(rows, dtype=np.int64)
    for o in range(reach + 1):
        ok = (n_right >= length - o) & (n_left >= o)
        if not ok.any():
            continue
        r_class[by_right] = np.cumsum(lcp_right < length - o)
        l_class[by_left] = np.cumsum(lcp_left < o)
        _, inverse = np.unique((r_class * (rows + 1) + l_class)[ok], return_inverse=True)
        out[ok, o] = np.bincount(inverse, weights=count[ok])[inverse] > 1
    return out


def _spans(shared: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, from, to) of the bytes that shared strings cover, relative to the anchor, one per run of offsets."""
    edge = np.diff(np.pad(shared.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, low = np.nonzero(edge == 1)
    _, high = np.nonzero(edge == -1)  # same runs in the same order
    return row, -(high - 1), length - low


# --- the operator -----------------------------------------------------------------------------


def _raw(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for i in range(0, whole.num_rows, rows):
            yield whole.slice(i, rows)


def _lists(column: pa.ListArray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """(places between the lists, fields of all their structs in a row) of an array of structs."""
    at = column.offsets.to_numpy()
    inner = column.values.slice(at[0], at[-1] - at[0])
    return at - at[0], {f.name: inner.field(f.name).to_numpy(zero_copy_only=False) for f in inner.type}


def _anchor_rows(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """(g, k, pos) of every anchor of the distinct texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches, TEXTS):
            held = []
            for k, text in zip(b.column("k").to_pylist(), b.column("text").to_pylist(), strict=True):
                raw = _raw(text)
                if len(raw) >= length:
                    pos, g = anchors(np.frombuffer(raw, dtype=np.uint8), length, gram)
                    held.append((g.view(np.int64), np.full(len(pos), k), pos))
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*held, strict=True)], names=["g", "k", "pos"])

    return texts.select("k", "text").mapInArrow(run, "g long, k long, pos long")


def _contexts(texts: DataFrame, spots: DataFrame, length: int, gram: int) -> DataFrame:
    """(g, c1, c2, k, pos, n, rest): a 128-bit hash of each repeated anchor's surroundings; ``n`` counts equal
    texts, ``rest`` the bytes from the anchor on (``length`` at most)."""
    reach = length - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches, TEXTS):
            ends, spot = _lists(b.column("at"))
            pos, digests, rest = spot["pos"], [], []
            for text, i, j in zip(b.column("text").to_pylist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                raw = _raw(text)
                for p in pos[i:j].tolist():
                    low = max(0, p - reach)
                    digests.append(xxhash.xxh3_128_digest((p - low).to_bytes(4, "little") + raw[low:p + length]))
                    rest.append(min(length, len(raw) - p))
            c = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            times = np.diff(ends)
            columns = [spot["g"], c[:, 0].copy(), c[:, 1].copy(), np.repeat(b.column("k").to_numpy(), times), pos, np.repeat(b.column("n").to_numpy(), times),
                       np.array(rest, dtype=np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["g", "c1", "c2", "k", "pos", "n", "rest"])

    lists = spots.groupBy("k").agg(F.collect_list(F.struct("pos", "g")).alias("at"))
    return texts.join(lists, "k").mapInArrow(run, "g long, c1 long, c2 long, k long, pos long, n long, rest int")


def _with_bytes(texts: DataFrame, classes: DataFrame, length: int, gram: int) -> DataFrame:
    """(g, classes, c1, c2, n, before, after): the surroundings of each class, read from its representative (k, pos)."""
    reach = length - gram
    names = ["g", "classes", "c1", "c2", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches, TEXTS):
            ends, spot = _lists(b.column("at"))
            before, after = [], []
            for text, i, j in zip(b.column("text").to_pylist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                raw = _raw(text)
                for p in spot["pos"][i:j].tolist():
                    before.append(raw[max(0, p - reach):p])
                    after.append(raw[p:p + length])
            yield pa.RecordBatch.from_arrays([*(pa.array(spot[c]) for c in names), pa.array(before, pa.binary()), pa.array(after, pa.binary())],
                                             names=[*names, "before", "after"])

    lists = classes.groupBy("k").agg(F.collect_list(F.struct("pos", *names)).alias("at"))
    return texts.select("k", "text").join(lists, "k").mapInArrow(run, "g long, classes long, c1 long, c2 long, n long, before binary, after binary")


_SPAN = "g long, c1 long, c2 long, lo long, hi long"


def _lone_spans(classes: DataFrame, length: int, gram: int) -> DataFrame:
    """Spans of classes that occur twice and share their gram with no other: every string that fits."""
    low = F.greatest(F.lit(length) - F.col("rest"), F.lit(0)).cast("long")
    high = F.least(F.col("pos"), F.lit(length - gram)).cast("long")
    return classes.select("g", "c1", "c2", (-high).alias("lo"), (F.lit(length) - low).alias("hi"), (low <= high).alias("fits")).where("fits").drop("fits")


def _sorted_spans(classes: DataFrame, length: int, gram: int, tasks: int) -> DataFrame:
    """Shared spans of classes, whole grams per task."""

    def run(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("g", kind="stable")
        shared = shared_offsets(b["g"].to_numpy(), b["before"].tolist(), b["after"].tolist(), b["n"].to_numpy().astype(float), length, gram)
        row, lo, hi = _spans(shared, length)
        return pd.DataFrame({c: b[c].to_numpy()[row] for c in ("g", "c1", "c2")} | {"lo": lo, "hi": hi})

    part = F.pmod(F.xxhash64("g"), F.lit(tasks)).cast("int")
    return classes.withColumn("part", part).groupBy("part").applyInPandas(lambda b: run(b.drop(columns="part")), _SPAN)


def _counted_spans(classes: DataFrame, length: int, gram: int) -> DataFrame:
    """The same for grams with very many classes: strings counted by their 128-bit hash, nothing gathered."""
    reach = length - gram

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for g, c1, c2, n, before, after in zip(*(b[c] for c in ("g", "c1", "c2", "n", "before", "after")), strict=True):
                raw, at = before + after, len(before)
                offsets = [o for o in range(reach + 1) if o <= at and at - o + length <= len(raw)]
                digest = [xxhash.xxh3_128_intdigest(raw[at - o:at - o + length]) for o in offsets]
                yield pd.DataFrame({"g": g, "c1": c1, "c2": c2, "n": n, "o": offsets, "w1": [(d >> 64) - (1 << 63) for d in digest],
                                    "w2": [(d & 0xFFFFFFFFFFFFFFFF) - (1 << 63) for d in digest]}).astype("int64")

    rows = classes.mapInPandas(run, "g long, c1 long, c2 long, n long, o long, w1 long, w2 long")
    twice = rows.groupBy("g", "o", "w1", "w2").agg(F.sum("n").alias("all")).where("all > 1")
    offsets = rows.join(twice, ["g", "o", "w1", "w2"]).groupBy("g", "c1", "c2").agg(F.array_sort(F.collect_set("o")).alias("at"))  # reach + 1 at most
    first = F.filter("at", lambda o, i: (i == 0) | (F.get("at", i - 1) != o - 1))
    last = F.filter("at", lambda o, i: F.coalesce(F.get("at", i + 1) != o + 1, F.lit(True)))
    runs = offsets.select("g", "c1", "c2", F.explode(F.arrays_zip(first.alias("low"), last.alias("high"))).alias("run"))
    return runs.select("g", "c1", "c2", (-F.col("run.high")).alias("lo"), (F.lit(length) - F.col("run.low")).alias("hi"))


def cut_spans(raw: bytes, lo: np.ndarray, hi: np.ndarray) -> tuple[int, int, bytes]:
    """(bytes removed, maximal removed runs, rest) without the spans [lo, hi)."""
    gone = np.zeros(len(raw) + 1, dtype=np.int32)
    np.add.at(gone, lo, 1)
    np.add.at(gone, hi, -1)
    cover = np.cumsum(gone[:-1]) > 0
    runs = int(np.count_nonzero(np.diff(cover.astype(np.int8), prepend=0) == 1))
    return int(cover.sum()), runs, np.frombuffer(raw, dtype=np.uint8)[~cover].tobytes()


def _cut(texts: DataFrame, lists: DataFrame) -> DataFrame:
    """(k1, k2, n_removed, n_spans, kept_sha256, kept) of distinct texts with spans."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches, TEXTS):
            ends, span = _lists(b.column("spans"))
            done = [cut_spans(_raw(t), span["lo"][i:j], span["hi"][i:j]) for t, i, j in zip(b.column("text").to_pylist(), ends[:-1], ends[1:], strict=True)]
            made = [pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.int64()),
                    pa.array([hashlib.sha256(d[2]).hexdigest() for d in done]), pa.array([d[2] for d in done], pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column("k1"), b.column("k2"), *made], names=["k1", "k2", "n_removed", "n_spans", "kept_sha256", "kept"])

    return (texts.select("k", "k1", "k2", "text").join(lists, "k")
            .mapInArrow(run, "k1 long, k2 long, n_removed long, n_spans long, kept_sha256 string, kept binary"))


def remove_repeats(docs: DataFrame, length: int = 400, gram: int = 200) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept.

    ``kept`` holds the remaining bytes of texts that lose some but not all, else
    null.  Null and empty texts have no bytes.  Repeated rows and rows with
    equal or null doc_ids are documents of their own, so equal texts of
    ``length`` bytes or more lose everything.  Only doc_id and text are read.

    Texts that a 128-bit hash and their length tell apart are numbered once;
    copies are looked at once and counted.
    """
    spark = docs.sparkSession
    ship_package(spark)
    text, zero = F.col("text"), F.lit(0).cast("long")
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(length), "text").alias("k2"))
    base = rows.select("doc_id", "k1", "k2", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                       F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256).alias("sha"))
    texts = save(rows.where(F.octet_length("text") >= length).groupBy("k1", "k2", F.octet_length("text")).agg(F.first("text").alias("text"), F.count("*").alias("n"))
                 .select(F.monotonically_increasing_id().alias("k"), "k1", "k2", "n", "text"), "suffix_texts")
    release(spark)
    found = save(_anchor_rows(texts, length, gram), "suffix_anchors")
    # a gram that stands once, and in one text's only copy, lies in no repeat
    often = found.join(texts.where("n > 1").select("k"), "k", "left_semi").select("g")
    twice = found.groupBy("g").agg(F.count("*").alias("n")).where("n > 1").select("g").unionByName(often).distinct()
    spots = save(found.join(twice, "g", "left_semi"), "suffix_spots")
    release(spark)
    discard(found)
    contexts = save(_contexts(texts, spots, length, gram), "suffix_contexts")
    discard(spots)
    release(spark)
    # any member stands for its class: (k, pos) is picked by the smallest hash of both
    pick = F.min_by(F.struct("k", "pos", "rest"), F.xxhash64("k", "pos"))
    classes = save(contexts.groupBy("g", "c1", "c2").agg(F.sum("n").alias("n"), pick.alias("at"))
                   .select("g", "c1", "c2", "n", "at.k", "at.pos", "at.rest"), "suffix_classes")
    sizes = save(classes.groupBy("g").agg(F.count("*").alias("classes")), "suffix_grams")
    release(spark)
    # a gram's only class: its strings are shared if the class occurs twice, whatever its bytes
    lone = classes.join(sizes.where("classes = 1"), "g", "left_semi").where("n > 1")
    several = save(_with_bytes(texts, classes.join(sizes.where("classes > 1"), "g"), length, gram), "suffix_bytes")
    release(spark)
    tasks = int(sizes.where(f"classes BETWEEN 2 AND {HOT_CLASSES}").agg(F.coalesce(F.sum("classes"), zero)).first()[0] // TASK_CLASSES) + 1
    spans = save(_lone_spans(lone, length, gram)
                 .unionByName(_sorted_spans(several.where(f"classes <= {HOT_CLASSES}").drop("classes"), length, gram, tasks))
                 .unionByName(_counted_spans(several.where(f"classes > {HOT_CLASSES}").drop("classes"), length, gram)), "suffix_class_spans")
    discard(several)
    release(spark)
    # copies lose all they have, so only single texts are cut
    single = texts.where("n = 1")
    placed = (contexts.where("n = 1").select("g", "c1", "c2", "k", "pos").join(spans, ["g", "c1", "c2"])
              .select("k", (F.col("pos") + F.col("lo")).alias("lo"), (F.col("pos") + F.col("hi")).alias("hi")))
    lists = save(placed.groupBy("k").agg(F.collect_set(F.struct("lo", "hi")).alias("spans")), "suffix_spans")
    release(spark)
    empty = F.sha2(F.lit("").cast("binary"), 256)
    whole = texts.where("n > 1").select("k1", "k2", F.octet_length("text").cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
                                        empty.alias("kept_sha256"), F.lit(None).cast("binary").alias("kept"))
    lost = _cut(single, lists).unionByName(whole)
    out = base.join(lost, ["k1", "k2"], "left")
    return out.select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
                      F.coalesce("kept_sha256", "sha").alias("kept_sha256"), "kept")
