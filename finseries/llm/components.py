"""Connected components of a link table by alternating stars.

Large-star and small-star passes (Kiveris et al., "Connected Components in
MapReduce and Beyond", 2014) shorten every path to its smallest node.  Each
pass is a partial-aggregated minimum per node and an equi-join back, so a node
with very many links is pre-aggregated map-side and its join partition can be
split; no neighbour list is ever gathered.  Every round is written to the
shared scratch folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finseries.llm.common import save


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    to_low = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return to_low.unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (two long columns a, b).

    ``root`` is the smallest node of the component.  Null ends and self-links
    are ignored; an empty table gives an empty result.
    """
    e = save(links.select(F.col("a").cast("long"), F.col("b").cast("long"))
             .where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
             "links")
    seen = None
    while True:
        state = e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen or state[0] == 0:
            break
        seen = state
        e = save(_small_star(_large_star(e)), "stars")
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
