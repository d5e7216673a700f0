import pytest
import sentencepiece as library

import cases
from finseries.llm import sentencepiece as sp
from finseries.llm.registry import PIECE_MODEL


@pytest.fixture(scope="module")
def model():
    return sp.load_model(PIECE_MODEL)


def test_ids_equal_the_models_own_encoder_and_round_trip(spark):
    own = library.SentencePieceProcessor(model_file=PIECE_MODEL)
    rows = cases.corpus() + [(900, "a  b\t\n  c   ", "en", "s", 1), (901, "\x00 ́é ﬁ①", "en", "s", 1), (902, "x▁y", "en", "s", 1)]
    got = sp.encode_documents(cases.with_clashes(cases.frame(spark, rows)), PIECE_MODEL, common=300).collect()
    assert len(got) == len(rows)
    texts = {}
    for r in rows:
        texts.setdefault(r[0], []).append(r[1])
    for r in got:
        assert any(own.encode(t or "") == list(r.ids) for t in texts[r.doc_id]) and r.n_ids == len(r.ids)
        assert r.round_trip == (r.doc_id != 902)


@pytest.mark.parametrize("kind", ["merge", "viterbi"])
def test_relational_folds_equal_the_in_task_fold(spark, model, kind):
    model = sp.PieceModel(model.pieces, model.scores, kind, model.unk, model.byte_ids, model.plain)
    units = ["▁the", "▁▁▁x", "▁", "▁ñandú", "▁日本語😀", "▁thaterhedingou", "▁" + "ab" * 15, "▁\x00z", "▁3.14159265"]
    got = {r.unit: list(r.ids) for r in sp.unit_ids(spark.createDataFrame([(u,) for u in units], "unit string"), model).collect()}
    assert got == {u: sp.fold_unit(model, u) for u in units}


def test_viterbi_finds_the_best_path(model):
    pieces = ["a", "b", "ab", "ba", "aba", "bab"]
    toy = sp.PieceModel(pieces, [-3.0, -2.5, -4.0, -4.6, -7.1, -6.0], "viterbi", 0, [], {p: i for i, p in enumerate(pieces)})

    def best(text):
        if not text:
            return 0.0
        return max(toy.scores[i] + best(text[len(p):]) for i, p in enumerate(pieces) if text.startswith(p)) if text else 0.0
    for text in ["abab", "babaab", "aabbab", "abaabab"]:
        assert abs(sum(toy.scores[i] for i in sp.fold_unit(toy, text)) - best(text)) < 1e-9


def test_very_long_unit(model):
    own = library.SentencePieceProcessor(model_file=PIECE_MODEL)
    for text in ("a" * 5000, "ab" * 4000, "日本" * 2000):
        assert sp.Encoder(model, {}).encode([text])[0].tolist() == own.encode(text)


def test_empty_table(spark):
    assert sp.encode_documents(cases.frame(spark, []), PIECE_MODEL).count() == 0


def test_units_folded_together_equal_the_fold_of_one(model):
    import random
    rng = random.Random(2)
    units = ["▁" + "".join(rng.choice("abcdeéñ日本😀1.,\x00") for _ in range(rng.randrange(0, 40))) for _ in range(800)] + ["▁", "▁▁▁▁", "▁aaaaaaaa"]
    ids, n = sp.fold_units(model, units)
    assert [list(x) for x in __import__("numpy").split(ids, n.cumsum()[:-1])] == [sp.fold_unit(model, u) for u in units]


def test_a_full_memory_is_cleared(model, monkeypatch):
    monkeypatch.setattr(sp, "MEMO", 5)
    own, encoder = library.SentencePieceProcessor(model_file=PIECE_MODEL), sp.Encoder(model, {})
    texts = [" ".join(f"word{i * j}" for j in range(9)) for i in range(20)] + [None, ""]
    for i in range(0, len(texts), 3):
        ids, ends = encoder.encode(texts[i:i + 3])
        assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == [own.encode(t or "") for t in texts[i:i + 3]]
