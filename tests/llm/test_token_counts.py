import re

import cases
from finseries.llm import token_counts as tc
from finseries.session import scratch_path


def counts(spark, rows, n):
    return spark.createDataFrame([(s, g, k) for s, g, k in rows], "source string, lang string, n long").withColumnRenamed("n", n)


def totals(spark, ledger):
    return {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in tc.rollup(spark, ledger).collect()}


def test_deltas_are_additive_and_batches_idempotent(spark):
    ledger = scratch_path(spark, "ledger")
    assert totals(spark, ledger) == {}
    rows = counts(spark, [("a", "en", 5), ("a", "en", 7), ("b", None, 1), (None, "en", 2)], "n")
    assert tc.commit(spark, ledger, "one", tc.inserts(rows, "v1", "n"))
    assert not tc.commit(spark, ledger, "one", tc.inserts(rows, "v1", "n"))
    want = {("a", "en", "v1"): (2, 12), ("b", None, "v1"): (1, 1), (None, "en", "v1"): (1, 2)}
    assert totals(spark, ledger) == want
    gone = counts(spark, [("b", None, 1)], "n")
    assert tc.commit(spark, ledger, "two", tc.deletes(gone, "v1", "n"))
    moved = counts(spark, [("a", "en", 5)], "n").selectExpr("*", "9 AS m")
    assert tc.commit(spark, ledger, "three", tc.recounts(moved, ("v1", "n"), ("v2", "m")))
    want = {("a", "en", "v1"): (1, 7), ("a", "en", "v2"): (1, 9), (None, "en", "v1"): (1, 2)}
    assert totals(spark, ledger) == want
    tc.compact(spark, ledger)
    assert len(tc.committed(spark, ledger)) == 1 and totals(spark, ledger) == want
    assert not tc.commit(spark, ledger, "two", tc.deletes(gone, "v1", "n")) and totals(spark, ledger) == want


def test_unfinished_batches_do_not_count(spark):
    ledger = scratch_path(spark, "ledger")
    rows = counts(spark, [("a", "en", 5)], "n")
    tc.commit(spark, ledger, "one", tc.inserts(rows, "v1", "n"))
    path, fs, _ = tc._fs(spark, ledger)
    fs.delete(path(f"{ledger}/batch=one/_SUCCESS"), False)
    assert totals(spark, ledger) == {}
    assert tc.commit(spark, ledger, "one", tc.inserts(rows, "v1", "n")) and totals(spark, ledger) == {("a", "en", "v1"): (1, 5)}


def test_compaction_that_stopped_before_its_cleanup(spark):
    ledger = scratch_path(spark, "ledger")
    rows = counts(spark, [("a", "en", 5)], "n")
    for name in ("x", "y"):
        tc.commit(spark, ledger, name, tc.inserts(rows, "v1", "n"))
    tc.rollup(spark, ledger).write.parquet(f"{ledger}/batch=x+y")
    assert totals(spark, ledger) == {("a", "en", "v1"): (2, 10)}


def test_many_batches_fold_into_a_short_name(spark):
    ledger = scratch_path(spark, "ledger")
    rows = counts(spark, [("a", "en", 5)], "n").coalesce(1)
    days = [f"2024-01-{i:02d}-{'x' * 60}" for i in range(1, 7)]
    for d in days[:5]:
        tc.commit(spark, ledger, d, tc.inserts(rows, "v1", "n"))
    tc.compact(spark, ledger)
    assert tc.committed(spark, ledger) == ["+".join(days[:5])] and totals(spark, ledger) == {("a", "en", "v1"): (5, 25)}
    assert not tc.commit(spark, ledger, days[2], tc.inserts(rows, "v1", "n"))
    assert tc.commit(spark, ledger, days[5], tc.inserts(rows, "v1", "n"))
    tc.compact(spark, ledger)
    assert tc.committed(spark, ledger) == ["+".join(days)] and totals(spark, ledger) == {("a", "en", "v1"): (6, 30)}
    path, fs, root = tc._fs(spark, ledger)
    assert sorted(s.getPath().getName().split("=")[0] for s in fs.listStatus(root)) == ["compacted", "ids"]


def test_counters(spark):
    from pyspark.sql import functions as F
    for doc_id, text, *_ in cases.corpus():
        if text is not None and len(text) > 2500:
            continue
        r = spark.createDataFrame([(text,)], "t string").select(*(tc.count_tokens(F.col("t"), k).alias(str(i)) for i, k in enumerate(tc.COUNTERS))).first()
        assert r[0] == len([w for w in re.split("[\\x20\\x09-\\x0D]+", text or "") if w])
        assert r[1] == len(re.findall(r"[^\W_]+|[^\w\x20\x09-\x0D]|_", text or ""))
        if doc_id and doc_id > 8 and text and doc_id < 60:
            break


def test_empty_batch(spark):
    ledger = scratch_path(spark, "ledger")
    tc.commit(spark, ledger, "none", tc.inserts(counts(spark, [], "n"), "v1", "n"))
    assert totals(spark, ledger) == {}
