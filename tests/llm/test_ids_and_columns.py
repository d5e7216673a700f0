"""Ids above 2^53 beside a null, and columns of any name, through every operator and stage."""

import pytest

import cases
import corpus_pipeline
from finseries.llm import decontaminate, langid, licenses, pii, runs, sentencepiece, simhash, substring, suffix
from finseries.llm.registry import PIECE_MODEL

IDS = {cases.BIG + 1, cases.BIG + 3, cases.BIG + 5, cases.BIG + 7, None}


@pytest.fixture
def docs(spark):
    return cases.with_clashes(cases.frame(spark, cases.big_ids()).coalesce(1))


@pytest.fixture
def bench(spark):
    return spark.createDataFrame([(cases.BIG + 9, "nothing of this stands in any of the documents at all"), (None, None)], "item_id long, text string")


def test_operators_keep_every_id(spark, docs, bench):
    model = langid.fit(docs)
    results = {
        "1": sentencepiece.encode_documents(docs, PIECE_MODEL), "2": simhash.simhash_groups(docs), "3": substring.remove_repeats(docs),
        "4": decontaminate.decontaminate(docs, bench), "6": langid.predict(docs, model), "8": licenses.scan(docs), "9": suffix.remove_repeats(docs),
        "10": pii.find(docs), "11": runs.find(docs)}
    for name, df in results.items():
        got = [r.doc_id for r in df.collect()]
        assert len(got) == 5 and set(got) == IDS, name


def test_groups_keep_every_id(docs):
    got = {r.doc_id: r.component_id for r in simhash.simhash_groups(docs).collect()}
    assert got[cases.BIG + 1] == got[cases.BIG + 7] == cases.BIG + 1


def test_stages_keep_ids_and_columns(spark, docs, tmp_path):
    spark.createDataFrame([(cases.BIG + 9, "no such words here")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = {"language_id": IDS - {cases.BIG + 5}, "simhash_near_dedup": IDS - {cases.BIG + 5, cases.BIG + 7}}
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, str(tmp_path))
        rows = left.collect()
        assert left.columns == docs.columns
        assert {r.doc_id for r in rows} == want.get(name, want["simhash_near_dedup"]) and len({r.doc_id for r in rows}) == len(rows)
        assert all(r[c] == "clash" for r in rows for c in docs.columns[5:])
    assert "[PHONE]" in next(r.text for r in rows if r.doc_id == cases.BIG + 3)
    last = corpus_pipeline.STAGES[-1][1](spark, left, str(tmp_path)).collect()
    assert {r.doc_id for r in last} == want["simhash_near_dedup"]
