import hashlib
from collections import Counter

import numpy as np
import pytest

import cases
from finseries.llm import suffix


def brute(rows, length):
    texts = [(r[1] or "").encode() for r in rows]
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc, *_), t in zip(rows, texts):
        gone = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((doc, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("length,gram,hot", [(60, 30, 10_000), (60, 30, 2), (100, 40, 10_000)])
def test_equals_brute_force(spark, monkeypatch, length, gram, hot):
    monkeypatch.setattr(suffix, "HOT_CLASSES", hot)
    rows = cases.corpus()
    df = cases.with_clashes(cases.frame(spark, rows))
    got = suffix.remove_repeats(df, length, gram).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=str) == brute(rows, length)


def test_anchors_depend_on_the_window_alone():
    rng = np.random.default_rng(5)
    a, b = (rng.integers(0, 4, 500).astype(np.uint8) for _ in range(2))
    shared = rng.integers(0, 4, 80).astype(np.uint8)
    x, y = np.concatenate([a, shared, b]), np.concatenate([b[:123], shared, a])
    px, py = set(suffix.anchors(x, 80, 30)[0].tolist()), set(suffix.anchors(y, 80, 30)[0].tolist())
    assert {p - 500 for p in px if 500 <= p <= 550} & {p - 123 for p in py if 123 <= p <= 173}


def test_long_texts_are_anchored_in_blocks(monkeypatch):
    data = np.random.default_rng(6).integers(0, 3, 5000).astype(np.uint8)
    whole = suffix.anchors(data, 100, 40)[0]
    monkeypatch.setattr(suffix, "BLOCK", 700)
    assert suffix.anchors(data, 100, 40)[0].tolist() == whole.tolist()


def test_suffix_order_is_lexicographic_and_survives_collisions(monkeypatch):
    rng = np.random.default_rng(7)
    parts = [bytes(rng.integers(97, 99, rng.integers(0, 20)).astype(np.uint8)) for _ in range(60)]
    data, size = suffix._matrix(parts, 20)
    group = np.sort(rng.integers(0, 4, 60))
    want = sorted(range(60), key=lambda i: (group[i], parts[i]))
    for broken in (False, True):
        if broken:
            monkeypatch.setattr(suffix, "_TABLE", np.ones(256, dtype=np.uint64))  # every byte hashes alike
        order, lcp = suffix.suffix_order(group, data, size)
        assert [parts[i] for i in order] == [parts[i] for i in want] and group[order].tolist() == group.tolist()
        for k in range(1, 60):
            a, b = parts[order[k - 1]], parts[order[k]]
            n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert lcp[k] == (n if group[order[k]] == group[order[k - 1]] else -1)


def test_empty_table(spark):
    assert suffix.remove_repeats(cases.frame(spark, [])).count() == 0
