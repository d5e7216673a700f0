import re

import cases
from finseries.llm import licenses


def tokens(t):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return [w for w in re.split("[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", t) if w]


def brute(text, templates, threshold):
    ws, places, labels, best = tokens(text), [], set(), 0.0
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        places += [(i, label) for i in range(len(ws) - len(p) + 1) if ws[i:i + len(p)] == p]
    for x in licenses.prepared(templates, threshold):
        for i in range(len(ws)):
            held = set(x.tokens) & set(ws[i:i + x.span])
            if len(held) >= x.need and set(x.marks) <= held:
                labels.add(x.label)
                best = max(best, len(held) / len(x.tokens))
    own = sorted({x for _, x in places})
    return len(ws), sorted(places), own, sorted(set(own) | labels), 1.0 if places else best


TEXTS = ["Released under the MIT License.", "under the mit license under the MIT license", "x\nLicensed under the Apache License, Version 2.0.\ny", "CC-BY-NC cc by nc",
         "Licensed under CC BY-NC 4.0.", "All rights reserved.", "rights\nreserved all", "reserved rights of all kinds", "mit license under the", None, "", "...",
         "This work is licensed under the GNU General Public License, version 3.", "this free and unencumbered software is released into public domain the",
         "under " * 2000 + "the mit license", "ünder the mit license", "under\nthe\nmit\nlicense", "x y\nThis work is\nlicensed under the GNU General\nPublic License, version 3.\nz", "released under the new license",
         "this work is licensed under the gnu general public licence version 2", "Released under the BSD 3 clause licence", "licensed under CC BY SA 4.0",
         "all " + "a b c d e f " * 5 + "rights " + "g h i j " * 5 + "reserved", "gnu " * 300 + "general public license version 3 this work is licensed under the", "the " * 3000,
         "Permission is hereby granted, free of charge, to any person\n * obtaining a copy of this software and associated\n * documentation files (the \"Software\")",
         "you can redistribute this program, it is free software; modify it under the terms of the GNU General Public License as published by the Free Software "
         "Foundation, either version 3 of the License"]


def test_equals_brute_force(spark):
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], "en", "s", 1), (None, TEXTS[3], None, None, None)]
    for threshold in (0.95, 0.8, 0.6):
        got = licenses.scan(cases.with_clashes(cases.frame(spark, rows)), threshold=threshold).collect()
        have = sorted(((r.doc_id, (r.n_words, sorted((p.word, p.label) for p in r.places), list(r.base_labels), list(r.labels), r.score)) for r in got), key=str)
        assert have == sorted(((r[0], brute(r[1], licenses.TEMPLATES, threshold)) for r in rows), key=str)


def test_wrapped_changed_and_scattered_statements(spark):
    texts = {"This work is licensed under\nthe GNU General Public\nLicense, version 3.": "gpl-3", "this work is licensed under the gnu general public licence version 2": "gpl-2",
             "x released under the bsd three clause license y": "bsd-3", "released under the new license": "", "licensed under cc by sa 4.0": "cc-by-sa",
             "all of them " + "and so on " * 20 + "rights were " + "and so on " * 20 + "reserved": ""}
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    got = {r.doc_id: ",".join(r.labels) for r in licenses.scan(cases.frame(spark, rows)).collect()}
    assert [got[i] for i in range(len(texts))] == list(texts.values())


def test_prefix_join_loses_no_match_on_random_sets(spark):
    import random
    rng = random.Random(4)
    vocabulary = [f"t{i}" for i in range(14)]
    templates = [(" ".join(rng.sample(vocabulary, rng.randrange(1, 8))), f"l{i}") for i in range(12)]
    rows = [(i, "\n".join(" ".join(rng.choices(vocabulary, k=rng.randrange(0, 9))) for _ in range(3)), "en", "s", 1) for i in range(60)]
    for threshold in (0.5, 0.8):
        got = {(r.doc_id, r.label): r.containment for r in licenses.set_matches(cases.frame(spark, rows), templates, threshold).collect()}
        want = {}
        for doc, text, *_ in rows:
            ws = tokens(text)
            for x in licenses.prepared(templates, threshold):
                for i in range(len(ws)):
                    held = set(x.tokens) & set(ws[i:i + x.span])
                    if len(held) >= x.need and set(x.marks) <= held:
                        want[doc, x.label] = max(want.get((doc, x.label), 0), len(held) / len(x.tokens))
        assert got == want


def test_empty_table(spark):
    assert licenses.scan(cases.frame(spark, [])).count() == 0
