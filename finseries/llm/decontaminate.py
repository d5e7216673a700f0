"""Benchmark decontamination by winnowed fingerprints, DataFrame functions only.

A benchmark window is ``window`` consecutive words of an item (the whole item
if it has fewer).  Of every ``window`` words a document or an item keeps the
smallest of their word k-gram hashes (Schleimer, Wilkerson and Aiken, 2003).
A document span equal to a benchmark window has the same smallest hash, so the
equi-join of the kept hashes finds every such span: none is lost, whatever its
place.  Each hit is extended to the windows around it, and these are compared
word for word with the benchmark's windows.

Benchmark items shorter than a window are fingerprinted whole: their words'
hash is joined with the hashes of document spans of the same length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finseries.llm.common import let, save, spare, word_array

#: Kept benchmark hashes up to this many rows (16 bytes each) are sent to every task; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def _grams(words: Column, k: int) -> Column:
    """XXH64 of each run of ``k`` words."""
    return F.transform(F.sequence(F.lit(1), F.size(words) - (k - 1)), lambda i: F.xxhash64(F.slice(words, i, k)))


def _winnow(hashes: Column, w: int) -> Column:
    """The smallest of each ``w`` consecutive hashes, without repeats."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(hashes) - (w - 1)),
                                        lambda i: F.array_min(F.slice(hashes, i, w))))


def _none(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def _fits(df: DataFrame, rows: int) -> bool:
    """Whether the table, counted, is within the bound."""
    return df.limit(BROADCAST_ROWS + 1).count() <= rows


def _small(df: DataFrame, rows: int) -> DataFrame:
    """A broadcast hint if the table, counted, is within the bound; else as it is (shuffle join)."""
    return F.broadcast(df) if _fits(df, rows) else df


def _with_words(base: DataFrame, met: DataFrame, item: Column) -> DataFrame:
    """(doc_id, thash, words, of): the texts that ``met`` names, each once per row of ``base``, with the set of their items."""
    one = met.groupBy(F.col("doc_id").alias("met_id"), F.col("thash").alias("met_hash")).agg(F.collect_set(item).alias("of"))
    return base.join(one, F.col("doc_id").eqNullSafe(F.col("met_id")) & (F.col("thash") == F.col("met_hash"))).select("doc_id", "thash", "words", "of")


def covered(spans: Column) -> Column:
    """Words covered by the union of (start, length) spans."""
    first = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    return F.aggregate(
        F.array_sort(spans), first,
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(s["start"] + s["len"] - F.greatest(acc["end"], s["start"]), F.lit(0))).cast("long").alias("n"),
            F.greatest(acc["end"], s["start"] + s["len"]).alias("end")),
        lambda acc: acc["n"])


def item_windows(bench: DataFrame, window: int) -> DataFrame:
    """Distinct (item_id, len, phrase): the item's windows, words joined by a space."""
    words = bench.select("item_id", word_array(F.col("text")).alias("words")).where(F.size("words") > 0)
    span = F.least(F.size("words"), F.lit(window))
    return (words.select("item_id", span.alias("len"),
                         F.explode(F.transform(F.sequence(F.lit(1), F.size("words") - span + 1),
                                               lambda i: F.array_join(F.slice("words", i, span), " "))).alias("phrase"))
            .distinct())


def _hits(docs: DataFrame, windows: DataFrame, window: int, k: int) -> DataFrame:
    """Distinct (doc_id, thash, start, len, phrase) of benchmark windows in documents; starts count from 1."""
    w = window - k + 1
    base = docs.select("doc_id", F.xxhash64("text").alias("thash"), word_array(F.col("text")).alias("words"))
    parts = F.split("phrase", " ")
    full = windows.where(F.col("len") == window).select("phrase").distinct()
    kept = full.select(F.array_min(_grams(parts, k)).alias("h")).distinct()
    kept_of = F.when(F.size("words") >= window, let(_grams(F.col("words"), k), lambda h: _winnow(h, w)))
    places = F.sequence(F.lit(1), F.size("words") - (k - 1))
    if _fits(kept, BROADCAST_ROWS):
        met = base.select("doc_id", "thash", "words", F.explode(kept_of).alias("h")).join(F.broadcast(kept), "h")
        at = met.select("doc_id", "thash", "words", F.explode(F.filter(
            places, lambda i: F.xxhash64(F.slice("words", i, k)) == F.col("h"))).alias("at"))
    else:  # only hashes travel to the join; the words of a text that is hit follow once
        met = base.select("doc_id", "thash", F.explode(kept_of).alias("h")).join(kept, "h")
        at = _with_words(base, met, F.col("h")).select("doc_id", "thash", "words", F.explode(F.filter(
            places, lambda i: F.array_contains("of", F.xxhash64(F.slice("words", i, k))))).alias("at"))
    around = at.select("doc_id", "thash", "words", F.explode(F.sequence(
        F.greatest(F.col("at") - (w - 1), F.lit(1)), F.least(F.col("at"), F.size("words") - (window - 1)))).alias("start"))
    spans = around.select("doc_id", "thash", "start", F.lit(window).alias("len"),
                          F.array_join(F.slice("words", F.col("start"), window), " ").alias("phrase"))
    found = spans.distinct().join(_small(full, BROADCAST_ROWS // 10), "phrase", "left_semi").select("doc_id", "thash", "start", "len", "phrase")
    short = windows.where(F.col("len") < window)
    for n in sorted(r[0] for r in short.select("len").distinct().collect()):  # window - 1 lengths at most
        own = short.where(F.col("len") == n).select("phrase").distinct()
        probe = own.select(F.xxhash64(parts).alias("h")).distinct()
        grams = F.posexplode(F.when(F.size("words") >= n, _grams(F.col("words"), n))).alias("at", "h")
        if _fits(probe, BROADCAST_ROWS):
            spots = base.select("doc_id", "thash", "words", grams).join(F.broadcast(probe), "h")
        else:
            met = base.select("doc_id", "thash", grams).join(probe, "h")
            spots = _with_words(base, met, F.col("at")).select("doc_id", "thash", "words", F.explode("of").alias("at"))
        spots = spots.select("doc_id", "thash", (F.col("at") + 1).alias("start"), F.lit(n).alias("len"),
                             F.array_join(F.slice("words", F.col("at") + 1, n), " ").alias("phrase"))
        found = found.unionByName(spots.join(_small(own, BROADCAST_ROWS // 10), "phrase", "left_semi").distinct())
    return found


def decontaminate(docs: DataFrame, bench: DataFrame, window: int = 10, k: int = 6) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, spans, item_ids, contaminated.

    ``spans`` are the hit (start, len) word spans, starts from 1; ``item_ids``
    the distinct benchmark items with a window in the document, sorted as
    strings (an item without an id hits words but is not listed).  Null or
    empty texts have no words; an empty benchmark hits nothing.  Repeated rows
    each get their result.  Only doc_id, item_id and text are read.
    """
    bench = bench.select("item_id", "text")
    windows = save(item_windows(bench, window), "bench_windows")
    hits = save(_hits(docs.select("doc_id", "text"), windows, window, k), "bench_hits")
    spans = (hits.groupBy("doc_id", "thash")
             .agg(F.collect_set(F.struct("start", "len")).alias("spans")))
    ids = (hits.select("doc_id", "thash", "phrase").distinct().join(windows, "phrase")
           .groupBy("doc_id", "thash").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids")))
    found = (spans.withColumnRenamed("doc_id", "_id").join(
        ids.select(F.col("doc_id").alias("_id2"), F.col("thash").alias("_th2"), "item_ids"),
        F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("thash") == F.col("_th2")))
        .select("_id", F.col("thash").alias("_th"), "spans", "item_ids"))
    base = docs.select("doc_id", F.xxhash64("text").alias("thash"), F.size(word_array(F.col("text"))).cast("long").alias("n_words"))
    out = base.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("thash") == F.col("_th")), "left")
    none = _none("struct<start:int,len:int>")
    return out.select(
        "doc_id", "n_words", F.coalesce(covered(F.col("spans")), F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("spans", none).alias("spans"), F.coalesce("item_ids", _none("string")).alias("item_ids"),
        F.col("spans").isNotNull().alias("contaminated"))


def clean(docs: DataFrame, bench: DataFrame, window: int = 10, k: int = 6) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window; all columns stay, whatever their names.

    Null and empty texts stay; a repeated row stays or goes as the other does.
    """
    of, of_hash = spare(docs, "hit_id", "hit_hash")
    windows = save(item_windows(bench.select("item_id", "text"), window), "bench_windows")
    bad = _hits(docs.select("doc_id", "text"), windows, window, k).select(F.col("doc_id").alias(of), F.col("thash").alias(of_hash)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(of)) & (F.xxhash64("text") == F.col(of_hash))
    return docs.join(save(bad, "bench_docs"), same, "left_anti")
