import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

import cases
from finseries.llm import simhash


def slow_fingerprint(text):
    ws = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        ws = ws.replace(c, " ")
    ws = [w for w in ws.split(" ") if w]
    if not ws:
        return 0
    grams = [" ".join(ws[i:i + 3]) for i in range(len(ws) - 2)] or [" ".join(ws)]
    hs = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprint_equals_the_definition():
    for _, text, *_ in cases.corpus():
        assert simhash.text_fingerprint(text, 3) == slow_fingerprint(text)


def test_first_bits_are_sparks_xxhash64(spark):
    from pyspark.sql import functions as F
    assert spark.range(1).select(F.xxhash64(F.lit("a b"))).first()[0] % (1 << 64) == simhash.text_fingerprint("A b", 3)


def test_golay_code_covers_every_word_once():
    leaders = simhash._leaders()
    assert leaders[0] == 0 and (leaders[1:] > 0).all()
    v = np.random.default_rng(0).integers(0, 1 << 23, 1000)
    home = v ^ leaders[simhash._syndrome(v)]
    assert (simhash._syndrome(home) == 0).all()
    assert max(bin(x).count("1") for x in (v ^ home).tolist()) <= 3


@settings(max_examples=60, deadline=None)
@given(st.integers(0, (1 << 64) - 1), st.lists(st.integers(0, 63), min_size=0, max_size=2))
def test_words_within_two_bits_meet_at_the_home(x, flips):
    y = x
    for b in set(flips):
        y ^= 1 << b
    a, b = (np.array([v], dtype=np.uint64).view(np.int64) for v in (x, y))
    _, reach = simhash.replica_anchors(b, 2)
    assert simhash.home_anchor(a)[0] in reach
    assert len(reach) == len(set(reach.tolist()))


def brute(rows):
    fps = [slow_fingerprint(t) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 2:
                parent[find(i)] = find(j)
    ids = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            ids[find(i)] = min(ids.get(find(i), r[0]), r[0])
    return sorted(((r[0] is None, r[0] or 0), f"{fps[i]:016x}", ids.get(find(i))) for i, r in enumerate(rows))


@pytest.mark.parametrize("clash", [False, True])
def test_groups_equal_brute_force(spark, clash):
    rows = cases.corpus()
    df = cases.frame(spark, rows)
    got = simhash.simhash_groups(cases.with_clashes(df) if clash else df).collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0), f"{r.fp % (1 << 64):016x}", r.component_id) for r in got) == brute(rows)


def test_chains_of_near_fingerprints_form_one_component(spark):
    fps = [0]
    for b in range(20):
        fps.append(fps[-1] ^ (0b11 << (3 * b)))
    df = spark.createDataFrame([(f,) for f in fps] + [(1 << 62,)], "fp long").distinct()
    found = {(r.a, r.b) for r in simhash.links(df).collect()}
    want = {(a, b) for a in fps + [1 << 62] for b in fps + [1 << 62] if a < b and bin(a ^ b).count("1") <= 2}
    assert found == want
    from finseries.llm.components import components
    roots = {r.node: r.root for r in components(simhash.links(df)).collect()}
    assert {roots[f] for f in fps} == {0}


def test_keep_first_keeps_one_row_of_each_group_and_all_columns(spark):
    rows = cases.corpus()
    kept = simhash.keep_first(cases.frame(spark, rows))
    assert kept.columns == [c.split()[0] for c in cases.SCHEMA.split(", ")]
    groups = {c for _, _, c in brute(rows)}
    got = [r.doc_id for r in kept.collect()]
    assert len(got) == len(set(got)) and set(got) == groups


def test_empty_table(spark):
    empty = cases.frame(spark, [])
    assert simhash.simhash_groups(empty).count() == 0 and simhash.keep_first(empty).count() == 0
