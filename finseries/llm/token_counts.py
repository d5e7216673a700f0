"""Token counts as delta-maintained rollups.

A batch is a table of signed changes: a document inserted (+1), deleted (-1) or
recounted (a deletion of the old count and an insertion of the new one).  Its
totals by source, language and tokenizer version are additive, so a rollup is
the sum of all committed batches' totals; no document is looked at twice.

A batch commits by writing its totals to ``<ledger>/batch=<id>``.  The folder
counts once Spark's ``_SUCCESS`` marker is in it; a batch id that has one is
never applied again, and an unfinished write (a lost driver) is simply written
over.  ``compact`` folds committed batches into ``<ledger>/compacted=<digest>``;
their ids, however many, are the rows of ``<ledger>/ids=<digest>``, which is
complete before the totals are written.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finseries.llm.common import save

GROUP = ["source", "lang", "tokenizer"]
TOTALS = "source string, lang string, tokenizer string, n_docs long, n_tokens long"

#: Tokenizer versions that are plain expressions (a count column may come from any other tokenizer).
COUNTERS = {
    "white-space-v1": lambda text: F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")),
    "word-mark-v2": lambda text: F.size(F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]"), F.lit(0))),
}


def count_tokens(text: Column, tokenizer: str) -> Column:
    """Tokens of a text (null has none) by one of ``COUNTERS``."""
    return F.when(text.isNull(), 0).otherwise(COUNTERS[tokenizer](text)).cast("long")


def inserts(counts: DataFrame, tokenizer: str, n_tokens: str) -> DataFrame:
    """One change per row of ``counts``: the document enters with the count in column ``n_tokens``."""
    return counts.select("source", "lang", F.lit(tokenizer).alias("tokenizer"), F.lit(1).cast("long").alias("sign"),
                         F.col(n_tokens).cast("long").alias("n_tokens"))


def deletes(counts: DataFrame, tokenizer: str, n_tokens: str) -> DataFrame:
    return inserts(counts, tokenizer, n_tokens).withColumn("sign", -F.col("sign"))


def recounts(counts: DataFrame, old: tuple[str, str], new: tuple[str, str]) -> DataFrame:
    """The documents leave one tokenizer's totals and enter another's (or the same one's with a revised
    count); ``old`` and ``new`` are (tokenizer version, count column)."""
    return deletes(counts, *old).unionByName(inserts(counts, *new))


def batch_totals(changes: DataFrame) -> DataFrame:
    """Signed totals of a batch; a hot source is summed map-side first.  Null source or language is a group of its own."""
    return changes.groupBy(*GROUP).agg(F.sum("sign").alias("n_docs"), F.sum(F.col("sign") * F.col("n_tokens")).alias("n_tokens"))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm.org.apache.hadoop.fs.Path, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def committed(spark: SparkSession, ledger: str) -> list[str]:
    """Ids of the committed batches (a compacted batch is named by all of its ids)."""
    return sorted("+".join(sorted(ids)) for ids in _folders(spark, ledger).values())


def _folders(spark: SparkSession, ledger: str) -> dict[str, set[str]]:
    """Ids of the committed batches in each complete folder."""
    path, fs, root = _fs(spark, ledger)
    if not fs.exists(root):
        return {}
    out = {}
    for p in (s.getPath() for s in fs.listStatus(root) if s.isDirectory()):
        kind, _, name = p.getName().partition("=")
        if kind in ("batch", "compacted") and fs.exists(path(p, "_SUCCESS")):
            out[p.getName()] = set(name.split("+")) if kind == "batch" else {
                r.id for r in spark.read.schema("id string").parquet(f"{ledger}/ids={name}").collect()}  # one per batch
    return out


def commit(spark: SparkSession, ledger: str, batch_id: str, changes: DataFrame) -> bool:
    """Apply a batch once; False if this id was committed before."""
    if not re.fullmatch(r"[A-Za-z0-9_-]+", batch_id):
        raise ValueError(f"batch id {batch_id!r}: letters, digits, _ and - only")
    if any(batch_id in ids for ids in _folders(spark, ledger).values()):
        return False
    batch_totals(changes).write.mode("overwrite").parquet(f"{ledger}/batch={batch_id}")
    return True


def _live(spark: SparkSession, ledger: str) -> dict[str, set[str]]:
    """Folders of committed batches, with their ids, without those that a compacted one covers."""
    parts = _folders(spark, ledger)
    return {n: ids for n, ids in parts.items() if not any(ids < other or (ids == other and m < n) for m, other in parts.items())}


def rollup(spark: SparkSession, ledger: str) -> DataFrame:
    """source, lang, tokenizer, n_docs, n_tokens over all committed batches; groups whose documents all left are gone."""
    names = sorted(_live(spark, ledger))
    if not names:
        return spark.createDataFrame([], TOTALS)
    rows = spark.read.schema(TOTALS).parquet(*(f"{ledger}/{n}" for n in names))
    totals = rows.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    return totals.where("n_docs <> 0 OR n_tokens <> 0")


def compact(spark: SparkSession, ledger: str) -> None:
    """Fold the committed batches into one; readers switch when it is complete, then the parts are deleted."""
    live = _live(spark, ledger)
    if len(live) < 2:
        return
    ids = sorted(set().union(*live.values()))
    digest = hashlib.sha256("+".join(ids).encode()).hexdigest()[:32]
    rows = save(rollup(spark, ledger), "rollup")
    spark.createDataFrame([(i,) for i in ids], "id string").coalesce(1).write.mode("overwrite").parquet(f"{ledger}/ids={digest}")
    rows.write.mode("overwrite").parquet(f"{ledger}/compacted={digest}")
    path, fs, _ = _fs(spark, ledger)
    for n in live:
        fs.delete(path(f"{ledger}/{n}"), True)
        if n.startswith("compacted="):
            fs.delete(path(f"{ledger}/ids={n.partition('=')[2]}"), True)
