"""Embedding near-duplicates: iterative quantisation, multi-index Hamming tables, exact rerank.

A rotation of the centred principal components is learned on a bounded sample
(Gong and Lazebnik's ITQ, 2011) so that the signs of the rotated components
are balanced bits that keep angles.  Every vector gets ``BITS`` such bits, cut
into ``TABLES`` chunks (Norouzi, Punjani and Fleet, 2012).  Two vectors of one
label whose codes differ in fewer than ``2 * TABLES`` bits agree in some chunk
but for one bit at most, so each distinct vector is looked up under its chunk
values and all values one bit away; more bits are found with a probability that
the tests measure.  Where vectors share a direction, near pairs differ in more
bits: pairs at the threshold are planted around the sample, and tables are added
until ``RECALL`` of these meet (``MOST_TABLES`` at most).  A pair is taken from
the first table in which it meets, its whole codes must be within ``RADIUS``
bits (more if the planted pairs' are), and it is reranked with the original
vectors in double precision.

Equal vectors of a label are one node with a count, so a vector repeated
thousands of times costs one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finseries.llm.common import release, save, ship_package
from finseries.llm.components import components

#: Vectors the rotation is learned on, at most (chosen by hash).
SAMPLE = 10_000
ITERATIONS = 50
#: Code bits and Hamming tables; chunks hold BITS // TABLES bits.
BITS = 96
TABLES = 6
CHUNK = BITS // TABLES
#: Candidates differ in this many bits at most (a cosine of 0.98 gives about 6 of 96).
RADIUS = 24
#: Share of planted pairs that must meet, and the most tables that are made for it.
RECALL = 0.99
MOST_TABLES = 96
#: Rows reranked at once inside a task.
RERANK_ROWS = 4_000


def learn_rotation(sample: np.ndarray, bits: int = BITS, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection) of ITQ; more bits than dimensions take further random rotations."""
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    mean = unit.mean(axis=0)
    x, dim = unit - mean, unit.shape[1]
    rng, parts = np.random.default_rng(seed), []
    axes = np.linalg.eigh(x.T @ x)[1][:, ::-1].T  # principal axes, widest first
    while sum(p.shape[1] for p in parts) < bits:
        k = min(dim, bits - sum(p.shape[1] for p in parts))
        v = x @ axes[:k].T
        r, _ = np.linalg.qr(rng.standard_normal((k, k)))
        for _ in range(ITERATIONS):
            u, _, w = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
            r = (u @ w).T
        parts.append(axes[:k].T @ r)
    return mean, np.concatenate(parts, axis=1)


def codes(vectors: np.ndarray, mean: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """(vectors x tables) of chunk values, 16 columns of the projection each."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    bits = np.packbits((unit - mean) @ projection >= 0, axis=1, bitorder="little")
    return np.ascontiguousarray(bits).view("<u2").astype(np.int32)


def planted(sample: np.ndarray, threshold: float, seed: int = 5) -> np.ndarray:
    """One vector per vector of ``sample``, at a cosine of just ``threshold`` in a random direction."""
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    side = np.random.default_rng(seed).standard_normal(unit.shape)
    side -= (side * unit).sum(axis=1, keepdims=True) * unit
    return threshold * unit + np.sqrt(1 - threshold ** 2) * side / np.linalg.norm(side, axis=1, keepdims=True)


def choose_tables(sample: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, int]:
    """(mean, projection, radius): the fewest tables in which ``RECALL`` of the planted pairs meet, doubled from ``TABLES``."""
    tables = TABLES
    while True:
        mean, projection = learn_rotation(sample, CHUNK * tables)
        radius = RADIUS * tables // TABLES
        if sample.shape[1] < 2 or not 0 < threshold < 1:
            return mean, projection, radius
        apart = np.bitwise_count(codes(sample, mean, projection) ^ codes(planted(sample, threshold), mean, projection))
        if (apart.min(axis=1) <= 1).mean() >= RECALL or 2 * tables > MOST_TABLES:
            return mean, projection, max(radius, int(np.quantile(apart.sum(axis=1), 0.999)))
        tables *= 2


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()).astype(np.float64)


def _pairs(nodes: DataFrame, dim: int, threshold: float) -> DataFrame:
    """(a, b): distinct vectors of one label and ``dim`` dimensions with close codes, each pair once, a < b."""
    some = nodes.orderBy(F.xxhash64("node")).limit(SAMPLE).select("embedding").toPandas()
    mean, projection, radius = choose_tables(_matrix(some["embedding"]), threshold)
    kind = nodes.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                yield pd.DataFrame({"label": b["label"], "node": b["node"], "code": list(codes(_matrix(b["embedding"]), mean, projection))})

    coded = save(nodes.select("label", "node", "embedding").mapInPandas(run, f"label {kind}, node long, code array<int>"), "itq_codes")
    home = coded.select("label", F.col("node").alias("a"), F.col("code").alias("ca"), F.posexplode("code").alias("t", "v"))
    flips = F.transform(F.sequence(F.lit(-1), F.lit(CHUNK - 1)), lambda i: F.when(i < 0, 0).otherwise(F.call_function("shiftleft", F.lit(1), i)))
    probe = (coded.select("label", F.col("node").alias("b"), F.col("code").alias("cb"), F.posexplode("code").alias("t", "w"))
             .select("label", "b", "cb", "t", F.explode(F.transform(flips, lambda m: F.col("w").bitwiseXOR(m))).alias("v")))
    apart = [F.bit_count(F.col("ca")[i].bitwiseXOR(F.col("cb")[i])) for i in range(projection.shape[1] // CHUNK)]
    first = F.coalesce(*(F.when(d <= 1, i) for i, d in enumerate(apart)))
    near = (first == F.col("t")) & (sum(apart[1:], apart[0]) <= radius)
    # both sides grow far beyond the table they are exploded from: never a broadcast
    return home.join(probe.hint("merge"), ["label", "t", "v"]).where((F.col("a") < F.col("b")) & near).select("a", "b")


def _rerank(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for i in range(0, len(whole), RERANK_ROWS):
                b = whole.iloc[i:i + RERANK_ROWS]
                x, y = _matrix(b["va"]), _matrix(b["vb"])
                cos = (x * y).sum(axis=1) / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1))
                keep = cos >= threshold
                yield pd.DataFrame({"a": b["a"][keep], "b": b["b"][keep]})

    va = nodes.select(F.col("node").alias("a"), F.col("embedding").alias("va"))
    vb = nodes.select(F.col("node").alias("b"), F.col("embedding").alias("vb"))
    return pairs.join(va, "a").join(vb, "b").select("a", "b", "va", "vb").mapInPandas(run, "a long, b long")


def near_duplicates(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Only vectors of equal non-null labels and equal length are compared.
    Vectors that are null, empty, all zero or hold a null or non-finite
    component, rows without a label and rows without a vec_id link with
    nothing (component_id is the own vec_id).  vec_id is the key: the smallest
    one of equal vectors stands for them, and n_links counts other vec_ids, so
    a repeated row links neither with itself nor twice with another (each
    repeat gets the same result).  Only vec_id, embedding and label are read.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    valid = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & fine)
    nodes = save(valid.groupBy("label", "embedding").agg(F.min("vec_id").alias("node"), F.count_distinct("vec_id").alias("n")), "itq_nodes")
    links = spark.createDataFrame([], "a long, b long")
    for (dim,) in nodes.select(F.size("embedding")).distinct().collect():  # vector lengths: one, as a rule
        own = nodes.where(F.size("embedding") == dim)
        links = links.unionByName(save(_rerank(_pairs(own, dim, threshold), own, threshold), "itq_links"))
    release(spark)
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sizes = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"))
    linked = both.join(sizes, "b").groupBy("a").agg(F.sum("nb").alias("more"))
    comp = components(links)
    per_node = (nodes.join(linked, nodes.node == linked.a, "left").join(comp.withColumnRenamed("node", "c"), F.col("node") == F.col("c"), "left")
                .select("label", "embedding", (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"), F.coalesce("root", "node").alias("component_id")))
    own = valid.join(per_node, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & fine, F.lit(False)))
    out = own.unionByName(alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
