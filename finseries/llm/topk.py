"""Exact top-k search by distributed histogram selection.

Every query is scored against every candidate by the integer inner product of
``floor(scale * x)``.  No score is kept: candidates are dealt to *lanes* of
about ``LANE`` rows, the queries are sent to every lane in blocks, and a task
multiplies one block with one lane at a time.

1. Locate.  Each query has a window of scores that holds its k-th highest one.
   A round counts the window's scores in ``BINS`` bins over all lanes (a lane
   sends its bins from the top down until they hold as many scores as are
   still wanted: lower ones cannot hold the k-th), sums them, and narrows the
   window to the bin where the running count from the top reaches k.  Rounds
   end when the window is one score wide or holds few scores; they grow with
   the logarithm of the score range only.
2. Filter.  A last scoring keeps the scores from the window's lower edge on,
   of one lane the k best by (score, smaller vec_id), so thousands of ties at
   the k-th score never meet; a rank per query breaks the rest of the ties.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finseries.llm.common import discard, release, save, ship_package

#: Candidates per lane aimed at, queries multiplied at once, and bins per round.
LANE = 8_192
BLOCK = 128
BINS = 1_024
#: A window that holds so many scores at most (or 2 k) is filtered without another round.
FEW = 64
#: Components held in a lane at most, and the limit at which scores are held.
LANE_VALUES = 1 << 22
LIMIT = (1 << 62) - 1
#: Stands for a null vec_id inside tasks (with a flag), so that ids stay whole numbers there.
_LAST = (1 << 63) - 1


def scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of integer-valued rows as int64 (held at +-LIMIT beyond it)."""
    if not queries.size or not rows.size:
        return np.zeros((len(queries), len(rows)), dtype=np.int64)
    most = float(np.abs(queries).max()) * float(np.abs(rows).max()) * rows.shape[1]
    if most < 2.0 ** 53:
        return (queries @ rows.T).astype(np.int64)
    exact = np.vectorize(int, otypes=[object])
    return np.clip(exact(queries) @ exact(rows).T, -LIMIT, LIMIT).astype(np.int64)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in column])


def _tiles(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray, pd.DataFrame]]:
    """(queries, scores, candidates) of each lane, block by block, from rows sorted by lane, length, kind (candidates first)."""
    key, held, lane, x = None, [], None, None
    for whole in batches:
        for k, part in whole.groupby(["lane", "dim"], sort=False):
            if k != key:
                key, held, lane = k, [], None
            if not part["asks"].all():
                held.append(part[~part["asks"]])
            asking = part[part["asks"]]
            if len(asking) and held:
                if lane is None:
                    lane = pd.concat(held)
                    x = _matrix(lane["v"])
                for i in range(0, len(asking), BLOCK):
                    block = asking.iloc[i:i + BLOCK]
                    s = scores(_matrix(block["v"]), x)
                    yield block, s, lane


def _own(block: pd.DataFrame, lane: pd.DataFrame) -> np.ndarray:
    return block["rid"].to_numpy()[:, None] == lane["rid"].to_numpy()[None, :]


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for block, s, lane in _tiles(batches):
        low, width, need = (block[c].to_numpy()[:, None] for c in ("low", "width", "need"))
        at = (s - low) // width
        inside = (at >= 0) & (at < BINS) & ~_own(block, lane)
        row, col = np.nonzero(inside)
        n = np.bincount(row * BINS + at[row, col], minlength=len(block) * BINS).reshape(-1, BINS)
        above = n[:, ::-1].cumsum(axis=1)[:, ::-1] - n
        row, b = np.nonzero((n > 0) & (above < need))
        yield pd.DataFrame({"rid": block["rid"].to_numpy()[row], "bin": b, "n": n[row, b]})


def _best(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block, s, lane in _tiles(batches):
            inside = (s >= block["low"].to_numpy()[:, None]) & ~_own(block, lane)
            row, col = np.nonzero(inside)
            got = pd.DataFrame({"rid": block["rid"].to_numpy()[row], "score": s[row, col]}
                               | {c: lane[c].to_numpy()[col] for c in ("vec_id", "unnamed")} | {"of": lane["rid"].to_numpy()[col]})
            got = got.sort_values(["rid", "score", "unnamed", "vec_id", "of"], ascending=[True, False, True, True, True])
            yield got[got.groupby("rid").cumcount() < k]
    return run


def integer_vectors(vectors: DataFrame, asks: Column, scale: float = 1024.0) -> DataFrame:
    """(rid, vec_id, v, dim, asks) of the rows that take part; ``v`` holds floor(scale * x) in double precision."""
    most = float(np.finfo(np.float64).max)
    x = F.transform("embedding", lambda c: F.least(F.greatest(F.lit(scale) * c.cast("double"), F.lit(-most)), F.lit(most)))
    whole = F.transform(x, lambda c: F.when(F.abs(c) < 2.0 ** 53, F.floor(c).cast("double")).otherwise(c))  # from 2^53 on all doubles are whole
    fine = F.col("embedding").isNotNull() & F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.coalesce(asks, F.lit(False)).alias("asks"))
            .where(fine).select(F.monotonically_increasing_id().alias("rid"), "vec_id", whole.alias("v"), F.size("embedding").alias("dim"), "asks"))


def top_k(vectors: DataFrame, asks: Column, k: int = 10, scale: float = 1024.0, lane_rows: int = LANE) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best candidates (all, if fewer) of each row where ``asks`` holds.

    Candidates are all rows but the query's own; a repeated row is a candidate
    (and a query) of its own.  Ties go to the smaller vec_id, a null one last.
    Vectors that are null or hold null or non-finite components take no part;
    vectors are scored against those of equal length.  Only vec_id and
    embedding are read; an empty table, or none that asks, gives an empty
    result.  Scores beyond +-``LIMIT`` are held there.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = save(integer_vectors(vectors, asks, scale), "topk_vectors")
    most = F.array_max(F.transform("v", F.abs))
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.max(most), F.lit(0.0)).alias("most"), F.coalesce(F.max("dim"), F.lit(0)).alias("dim")).first()
    lanes = int(size["n"] // max(1, min(lane_rows, LANE_VALUES // max(size["dim"], 1)))) + 1
    # no score leaves [-bound, bound]
    bound = int(min(size["most"] * size["most"] * max(size["dim"], 1), float(LIMIT))) + 1
    width = -(-(2 * bound + 1) // BINS)
    name = [F.coalesce("vec_id", F.lit(_LAST)).alias("vec_id"), F.col("vec_id").isNull().alias("unnamed")]
    candidates = rows.select(F.pmod(F.xxhash64("rid"), F.lit(lanes)).alias("lane"), "dim", F.lit(False).alias("asks"), "rid", *name, "v",
                             *(F.lit(0).cast("long").alias(c) for c in ("low", "width", "need")))
    windows = rows.where("asks").select("rid", F.lit(-bound).cast("long").alias("low"), F.lit(width).cast("long").alias("width"),
                                        F.lit(k).cast("long").alias("need"), F.lit(width > 1).alias("open"))

    def dealt(state: DataFrame) -> DataFrame:
        own = rows.where("asks").select("rid", "dim", *name, "v").join(state, "rid")
        sent = own.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long"))).alias("lane"), "dim", F.lit(True).alias("asks"),
                          "rid", "vec_id", "unnamed", "v", "low", "width", "need")
        return candidates.unionByName(sent).repartition("lane").sortWithinPartitions("lane", "dim", "asks", "rid")

    running = Window.partitionBy("rid").orderBy(F.desc("bin"))
    state = save(windows, "topk_windows")
    while width > 1 and not state.where("open").isEmpty():
        counts = dealt(state.where("open")).mapInPandas(_count, "rid long, bin int, n long").groupBy("rid", "bin").agg(F.sum("n").alias("n"))
        at = (counts.withColumn("upto", F.sum("n").over(running)).join(state.select("rid", "need"), "rid")
              .where("upto >= need AND upto - n < need").select("rid", "bin", "n", "upto"))
        width = -(-width // BINS)
        few = F.col("upto") - F.col("need") + F.lit(k) <= max(FEW, 2 * k)  # scores at or above the bin's lower edge
        # a query with fewer candidates than wanted has no such bin: its window stays, and all are returned
        narrow = state.where("open").join(at, "rid", "left").select(
            "rid", F.when(F.col("bin").isNull(), F.col("low")).otherwise(F.col("low") + F.col("bin") * F.col("width")).alias("low"),
            F.lit(width).cast("long").alias("width"),
            F.when(F.col("bin").isNull(), F.col("need")).otherwise(F.col("need") - (F.col("upto") - F.col("n"))).alias("need"),
            F.coalesce(~few & F.lit(width > 1), F.lit(False)).alias("open"))
        old, state = state, save(narrow.unionByName(state.where("NOT open")), "topk_windows")
        discard(old)
        release(spark)
    best = dealt(state).mapInPandas(_best(k), "rid long, score long, vec_id long, unnamed boolean, of long")
    order = Window.partitionBy("rid").orderBy(F.desc("score"), "unnamed", "vec_id", "of")
    ranked = (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
              .select("rid", "rank", F.when(~F.col("unnamed"), F.col("vec_id")).alias("vec_id"), "score"))
    return ranked.join(rows.where("asks").select("rid", F.col("vec_id").alias("query_id")), "rid").select("query_id", "rank", "vec_id", "score")
