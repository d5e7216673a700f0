import hashlib
import re

import numpy as np
import pytest

import cases
from finseries.llm import substring


def brute(rows, window=13):
    texts = [[w for w in re.split("[\\x20\\x09-\\x0D]+", t or "") if w] for _, t, *_ in rows]
    first = {}
    for (doc, *_), ws in zip(rows, texts):
        for i in range(len(ws) - window + 1):
            if doc is not None:
                k = tuple(ws[i:i + window])
                first[k] = min(first.get(k, doc), doc)
    out = []
    for (doc, *_), ws in zip(rows, texts):
        gone = set()
        for i in range(len(ws) - window + 1):
            if doc is not None and first[tuple(ws[i:i + window])] < doc:
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
        out.append((doc, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("clash", [False, True])
def test_equals_brute_force(spark, clash):
    rows = cases.corpus()
    rows += [(5, rows[1][1] + " " + rows[2][1], "en", "s", 1)]  # two texts under one doc_id
    df = cases.frame(spark, rows)
    got = substring.remove_repeats(cases.with_clashes(df) if clash else df).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == brute(rows)


def test_kept_text_hashes_to_its_digest(spark):
    for r in substring.remove_repeats(cases.frame(spark, cases.corpus())).collect():
        if r.kept is not None:
            assert hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256


def test_repeats_longer_than_fifty_words_go_from_all_but_the_first(spark):
    passage = " ".join(f"p{i}" for i in range(55))
    rows = [(i, f"own{i} " + passage + f" end{i}", "en", "s", 1) for i in range(5)]
    got = {r.doc_id: r for r in substring.remove_repeats(cases.frame(spark, rows)).collect()}
    assert got[0].n_removed == 0 and [got[i].n_removed for i in range(1, 5)] == [55] * 4
    assert got[3].kept == "own3 end3"


def test_texts_of_one_doc_id_with_a_block_at_different_places(spark):
    p, q, r, w = (" ".join(f"{c}{i}" for i in range(n)) for c, n in (("p", 7), ("q", 6), ("r", 6), ("w", 7)))
    rows = [(1, f"{p} {r}", "en", "s", 1), (1, f"{w} {p} {q}", "en", "s", 1), (2, f"x y {p} {q} z", "en", "s", 1), (3, f"x {p} {r} z", "en", "s", 1)]
    got = substring.remove_repeats(cases.frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == brute(rows)
    assert {r.doc_id: r.n_removed for r in got if r.doc_id > 1} == {2: 13, 3: 13}


def test_empty_table(spark):
    assert substring.remove_repeats(cases.frame(spark, [])).count() == 0


def test_words_hash_alike_wherever_blocks_are_cut(monkeypatch):
    import numpy as np
    texts = ["a bb  ccc\x0b" + "d" * 90, "", "bb", " \t", "x" + "y" * 40 + " bb a", "é ñandú 日本 a"]

    def hashed():
        substring._tables.cache_clear()
        raw = [t.encode() for t in texts]
        return substring.word_hashes(np.frombuffer(b"".join(raw), dtype=np.uint8), np.cumsum([len(r) for r in raw]))

    words = [w for t in texts for w in substring.split_words(t)]
    h, ends = hashed()
    assert ends.tolist() == np.cumsum([len(substring.split_words(t)) for t in texts]).tolist()
    assert len(set(zip(words, h.tolist()))) == len(set(words)) == len(set(h.tolist()))
    monkeypatch.setattr(substring, "BLOCK_BYTES", 16)
    short, _ = hashed()
    assert [x for x, w in zip(short.tolist(), words) if len(w) <= 16] == [x for x, w in zip(h.tolist(), words) if len(w) <= 16]
    assert len(set(zip(words, short.tolist()))) == len(set(short.tolist())) == len(set(words))
    substring._tables.cache_clear()


def test_anchors_of_equal_windows_stand_at_equal_places():
    rng = np.random.default_rng(8)
    window, block = 13, 7
    words = rng.integers(0, 3, 400).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = substring.gram_hashes(words, block)
    size = len(words) - window + 1
    every = substring.anchors(h, np.ones(size, dtype=bool), window - block + 1)
    for i in range(size):
        one = np.flatnonzero(substring.anchors(h[i:i + window - block + 1], np.ones(1, dtype=bool), window - block + 1))
        assert len(one) and every[i + one].all()


def test_far_fewer_rows_than_words_travel(spark):
    rng = np.random.default_rng(9)
    rows = [(i, " ".join(f"w{k}" for k in rng.integers(0, 5_000, 1_000))) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = substring._anchor_rows(df, 13, 7).count()
    assert 20 * 1_000 / 8 < found < 20 * 1_000 / 3
