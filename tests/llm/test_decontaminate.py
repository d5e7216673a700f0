import hashlib
import re

import pytest

import cases
from finseries.llm import decontaminate

BENCH = "item_id long, text string"


def tokens(t):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return [w for w in re.split("[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", t) if w]


def brute(rows, items, window=10):
    windows = {}
    for item, t in items:
        ws = tokens(t)
        n = min(window, len(ws))
        for i in range(len(ws) - n + 1 if ws else 0):
            windows.setdefault(tuple(ws[i:i + n]), set()).add(item)
    sizes = {len(k) for k in windows}
    out = []
    for doc, t, *_ in rows:
        ws, hit, ids = tokens(t), set(), set()
        for n in sizes:
            for i in range(len(ws) - n + 1):
                if tuple(ws[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    ids |= {str(x) for x in windows[tuple(ws[i:i + n])] if x is not None}
        out.append((doc, len(ws), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def digest(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, len(r.item_ids), hashlib.sha256(",".join(r.item_ids).encode()).hexdigest(), r.contaminated)
                   for r in df.collect()), key=str)


def items(rows):
    texts = {r[0]: r[1] for r in rows}
    cut = [" ".join(texts[i].split()[3:3 + n]) for i, n in ((8, 25), (9, 10), (10, 9), (11, 3), (66, 40), (12, 11))]
    return [(i, t) for i, t in enumerate(cut)] + [(20, cut[0].upper()), (None, cut[1]), (21, None), (22, ""), (23, "日本語"), (24, "x"), (0, cut[3]), (10, cut[0])]


@pytest.mark.parametrize("rows_bound", [1_000_000, 0])
def test_equals_brute_force(spark, monkeypatch, rows_bound):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", rows_bound)  # 0: every join is a shuffle join
    rows = cases.corpus()
    bench = items(rows)
    got = decontaminate.decontaminate(cases.with_clashes(cases.frame(spark, rows)), cases.frame(spark, bench, BENCH))
    assert digest(got) == brute(rows, bench)


def hits_plan(spark, bench):
    docs = cases.frame(spark, cases.corpus())
    windows = decontaminate.item_windows(cases.frame(spark, bench, BENCH), 10)
    return decontaminate._hits(docs.select("doc_id", "text"), windows, 10, 6)._jdf.queryExecution().executedPlan().toString()


def test_a_large_benchmark_shuffles_hashes_not_texts(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    plan = hits_plan(spark, items(cases.corpus())[:2])  # whole windows only: no join of shorter items
    lines = plan.splitlines()
    sent = [lines[i + 2] for i, line in enumerate(lines) if "Exchange hashpartitioning(h#" in line and "Generate explode" in lines[i + 2]]
    # beside the hash goes the document's id and its text's hash, nothing else
    assert sent and all(re.search(r"\[doc_id#\w+, thash#\w+\], false, \[h#\w+\]$", line) for line in sent)


def test_no_python_in_the_plan(spark):
    plan = hits_plan(spark, items(cases.corpus()))
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_clean_drops_exactly_the_contaminated(spark):
    rows = cases.corpus()
    bench = items(rows)[:3]
    kept = decontaminate.clean(cases.frame(spark, rows), cases.frame(spark, bench, BENCH))
    want = [r[0] for r in brute(rows, bench) if not r[-1]]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(want, key=str)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_empty_tables(spark):
    rows, none = cases.frame(spark, cases.corpus()), cases.frame(spark, [], BENCH)
    assert decontaminate.decontaminate(rows, none).where("contaminated").count() == 0
    assert decontaminate.decontaminate(cases.frame(spark, []), none).count() == 0
    assert decontaminate.clean(rows, none).count() == rows.count()
