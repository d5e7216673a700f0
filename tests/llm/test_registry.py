"""Registered queries against their DuckDB twins, and the pipeline stage by stage."""

import duckdb
import pytest

import __spark_entry__ as E
import cases
import corpus_pipeline
from finseries.llm import decontaminate, langid, pii, registry, sentencepiece, simhash
from finseries.llm.common import load


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{cases.SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_matches_duckdb(spark, duck, name):
    df = registry.QUERIES[name](spark, cases.SF)
    rel = duck.execute(registry.ORACLE[name])
    columns, rows = [c[0] for c in rel.description], rel.fetchall()
    assert sorted(columns) == sorted(df.columns)
    order = sorted(df.columns)
    assert sorted(repr([r[c] for c in order]) for r in df.collect()) == sorted(repr([dict(zip(columns, r))[c] for c in order]) for r in rows)


def test_each_operator_has_one_query():
    names = sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES)
    assert names == list(range(1, 14)) and set(registry.QUERIES) | {"pipeline"} <= set(E.queries())


def test_pipeline_stages_in_order(spark):
    docs = load(spark, cases.SF, "documents")
    one = docs.count()
    kept = langid.accepted(docs, langid.fit(docs))
    lang = {r.doc_id for r in kept.select("doc_id").collect()}
    groups = {r.doc_id: r.component_id for r in simhash.simhash_groups(kept).collect()}
    first = {d for d, c in groups.items() if d == c}
    bad = {r.doc_id for r in decontaminate.decontaminate(docs, load(spark, cases.SF, "benchmark")).where("contaminated").collect()}
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, cases.SF).collect()}
    assert len(lang) <= one and set(out) == first - bad and bad
    left = docs.where(docs.doc_id.isin(sorted(out)))
    model = sentencepiece.load_model(corpus_pipeline.PIECE_MODEL)
    clean = {r.doc_id: r.text for r in pii.redact(left).collect()}
    for d, r in out.items():
        assert r.round_trip and r.n_ids == len(r.ids)
        text = sentencepiece.decode_ids(model, r.ids)
        if "@" not in (clean[d] or "") and not any(c.isdigit() for c in clean[d] or ""):
            assert text == clean[d]


def test_stages_keep_the_columns_of_documents(spark):
    docs = load(spark, cases.SF, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, cases.SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_pipeline_on_odd_rows(spark, tmp_path):
    rows = cases.corpus()
    cases.frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    cases.frame(spark, [], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert 0 < len(out) < len(rows)
