import zlib

import numpy as np

import cases
from finseries.llm import langid


def test_held_out_accuracy_and_contract_columns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.predict(docs, langid.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    assert got.score.between(0, 1).all()
    held = got[got.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97


def test_lang_source_and_id_are_no_inputs(spark):
    docs = spark.read.parquet(cases.SF + "/documents.parquet")
    model = langid.fit(docs)
    other = docs.selectExpr("-doc_id AS doc_id", "text", "'zz' AS lang", "'zz' AS source", "n_chars")
    a = sorted((r.doc_id, r.lang_pred, r.score) for r in langid.predict(docs, model).collect())
    b = sorted((-r.doc_id, r.lang_pred, r.score) for r in langid.predict(other, model).collect())
    assert a == b


def test_odd_texts_are_undetermined(spark):
    docs = spark.read.parquet(cases.SF + "/documents.parquet")
    model = langid.fit(docs)
    odd = cases.frame(spark, [(1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, "12 !! 34", "en", "s", 0), (None, "the thing", "en", "s", 0), (4, "日本", "en", "s", 0), (4, "日本", "en", "s", 0)])
    got = sorted(((r.doc_id, r.held_out, r.lang_pred) for r in langid.predict(cases.with_clashes(odd), model).collect()), key=str)
    assert [x for x in got if x[0] in (1, 2, 3)] == [(1, False, "und"), (2, False, "und"), (3, False, "und")] or all(x[2] == "und" for x in got if x[0] in (1, 2, 3))
    assert (None, False) in [(x[0], x[1]) for x in got] and len(got) == 6
    kept = langid.accepted(odd, model)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} <= {None, 4}


def test_clean_documents_stay(spark):
    docs = spark.read.parquet(cases.SF + "/documents.parquet")
    assert langid.accepted(docs, langid.fit(docs)).count() >= 0.99 * docs.count()


def test_long_texts_are_counted_in_blocks(monkeypatch):
    text = "".join(chr(97 + i % 26) + (" " if i % 7 == 0 else "") for i in range(5000))
    whole = langid.gram_counts(text)
    monkeypatch.setattr(langid, "BLOCK", 64)
    assert (langid.gram_counts(text) == whole).all()


def test_codewords_are_apart():
    for n in (2, 3, 4, 5, 9, 40):
        code = langid.codewords(n)
        apart = (code[:, None] != code[None]).sum(axis=2)
        assert code.shape[0] == n and apart[~np.eye(n, dtype=bool)].min() >= (1 if n == 2 else 2)
        assert all(0 < c.sum() < n for c in code.T)


def test_nothing_to_learn_from(spark):
    empty = cases.frame(spark, [])
    assert langid.fit(empty) is None and langid.predict(empty, None).count() == 0
    assert langid.predict(cases.frame(spark, [(1, "text", None, "s", 4)]), None).first().lang_pred == "und"
    only = cases.frame(spark, [(i, "some text here", "en", "s", 4) for i in range(9)])
    assert {r.lang_pred for r in langid.predict(only, langid.fit(only)).collect()} == {"en"}


def test_numbers_that_look_like_letters_are_none(spark):
    docs = spark.read.parquet(cases.SF + "/documents.parquet")
    rows = [(1, "² ½ ①", "en", "s", 0), (2, "Ⅷ ¾", "en", "s", 0), (3, "² the ½ thing", "en", "s", 0)]
    got = {r.doc_id: r.lang_pred for r in langid.predict(cases.frame(spark, rows), langid.fit(docs)).collect()}
    assert got[1] == got[2] == "und" and got[3] != "und"
