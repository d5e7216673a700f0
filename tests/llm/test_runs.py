import random
import zlib

import pytest
from pyspark.sql import functions as F

import cases
from finseries.llm import runs as R


def brute(words):
    """Period by period: stretches of words equal to the one a period later, without multiples of smaller periods."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                out.append((i, j - i + q, q))
            i = max(j, i + 1)
    inside = [any(p < q and a <= s and a + m >= s + n for a, m, p in out) for s, n, q in out]
    return sorted((r for r, drop in zip(out, inside) if not drop), key=lambda r: (r[0], r[2]))


def odd_texts(seed, n):
    rng, out = random.Random(seed), []
    for _ in range(n):
        words = [f"{rng.randrange(rng.choice([1, 2, 3, 30]))}é" for _ in range(rng.randrange(0, 80))]
        if words and rng.random() < 0.7:
            a = rng.randrange(len(words))
            p = 1 + (len(words) - a) // rng.randrange(3, 11)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        if rng.random() < 0.3:
            words += words[:rng.randrange(1, 9)] * rng.randrange(1, 9)
        out.append("\t".join(words))
    return out


def check(spark, rows):
    got = {}
    for r in R.find(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, []).append((r.n_words, [tuple(x) for x in r.runs], r.collapsed))
    for doc_id, text in rows:
        words = (text or "").encode().split()
        want = brute(words)
        gone = {i for s, n, q in want for i in range(s + q, s + n)}
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
        assert (len(words), want, kept) in got[doc_id]
    assert sum(map(len, got.values())) == len(rows)


def test_equals_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(odd_texts(1, 400))]
    rows += [((1 << 60) + 1, "x y " * 9), (None, "z " * 7), (None, None), (None, ""), (3, rows[3][1]), (5000, " \n"), (5001, "a a a a a"), (5002, "a b a b a b a b")]
    check(spark, rows)


@pytest.mark.parametrize("block", [1, 50, 10_000])
def test_blocks_do_not_change_the_result(block, monkeypatch):
    monkeypatch.setattr(R, "BLOCK", block)
    texts = odd_texts(2, 60)
    assert [[tuple(x) for x in r] for r in R._found(texts)["runs"]] == [brute(t.encode().split()) for t in texts]


def test_long_texts(spark):
    rng = random.Random(3)
    unit = [f"w{i}" for i in range(700)]
    long = [f"v{rng.randrange(3000)}" for _ in range(12_000)] + unit * 9 + ["a"] * 5_000 + [f"v{rng.randrange(50)}" for _ in range(4_000)]
    (row,) = R.find(spark.createDataFrame([(1, " ".join(long))], "doc_id long, text string")).collect()
    got = [tuple(r) for r in row.runs]
    assert (12_000, 6_300, 700) in got and (18_300, 5_000, 1) in got
    for s, n, q in got:
        assert n >= max(6, 4 * q) and all(long[i] == long[i + q] for i in range(s, s + n - q))
        assert s == 0 or long[s - 1] != long[s - 1 + q]
        assert s + n == len(long) or long[s + n] != long[s + n - q]


def test_a_grammar_spells_its_words():
    """Every derivation of a nonterminal stands for the same words, and boundaries lie inside."""
    import numpy as np
    rng = random.Random(7)
    words = np.array([rng.randrange(4) for _ in range(3_000)])
    doc = np.repeat(np.arange(10), 300)
    (low, mid, high, spots, of), (start, _) = R.grammar(words, doc)
    assert len(low) and (low < mid).all() and (mid < high).all() and len(start) < 1_000
    for s, x in zip(spots.tolist(), of.tolist()):
        assert (words[s:s + high[x] - low[x]] == words[low[x]:high[x]]).all() and doc[s] == doc[s + high[x] - low[x] - 1]


def test_planted_texts(spark):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(i % 97))) for i in range(300)] + [(None, "a b"), (7, None)]
    got = {(r.doc_id, r.text) for r in R.plant(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for doc_id, text in rows:
        h = zlib.crc32(str(doc_id).encode())
        words = (text or "").split()
        if doc_id is not None and h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            text = " ".join(w if i < a else words[a + (i - a) % p] for i, w in enumerate(words))
        assert (doc_id, text) in got or text is None or not words


def test_clashing_columns_and_empty_table(spark):
    df = cases.with_clashes(cases.frame(spark, cases.corpus()).withColumns({c: F.lit("x") for c in ("found", "runs", "n_words", "collapsed")}))
    assert R.find(R.plant(df)).count() == df.count()
    assert R.find(R.plant(df.limit(0))).count() == 0
