import random
import re

import cases
from finseries.llm import pii
from pyspark.sql import functions as F


def luhn(s):
    total = 0
    for i, c in enumerate(reversed(s)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base(t):
    t = t or ""

    def digits(m):
        return re.sub("[^0-9]", "", m[0])
    found = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    found += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    found += [("card", m) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    found += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m)) <= 15]
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, m in found)


ODD = ["a@b.c@d.e.f", "x_@y.zz_q@w.ee", "😀 me@ex.com 😀 1.2.3.4.5.6.7.8", "999.1.1.1 0000255.1.2.3 99999999999999999999.1.1.1", "4111 1111 1111 1111",
       "4111-1111-1111-1111 4111111111111112", "+1 (555) 123-4567 +12 +1234567890123456", "1" * 5000, "@" * 50 + "a@b.c", "a" * 4000 + "@", "+1+2+3 555 1212 12",
       'token = "0a1b2c3d4e5f60718293a4b5c6d7e8f9"', "n @ m . com", "1 2 3 4 5 6 7 8 9 0 1 2 3", "-+49 30 123456-"]


def texts():
    rng = random.Random(2)
    parts = ODD + ["word", "Word,", "12", "call", "mail", "\n"]
    out = ODD + [" ".join(rng.choice(parts[:7] + parts[8:]) for _ in range(12)) for _ in range(25)]
    for i in range(40):
        n = "".join(rng.choice("0123456789") for _ in range(16))
        out.append(f"some text {n} more" if i % 2 else f'the token = "{rng.getrandbits(160):040x}" here, not {rng.getrandbits(64):016x}')
    return out


def rows():
    return [(i, t, "en", "s", len(t)) for i, t in enumerate(texts())] + [(500, None, "en", "s", 0), (501, "", "en", "s", 0), (None, "me@here.org", None, None, None), (2, texts()[2], "en", "s", 1)]


def test_base_spans_equal_the_patterns_and_stay(spark):
    got = pii.find(cases.with_clashes(cases.frame(spark, rows()))).select("doc_id", pii.span_text(F.col("base")).alias("b"), pii.span_text(F.col("spans")).alias("s")).collect()
    want = sorted(((r[0], base(r[1])) for r in rows()), key=str)
    assert sorted(((r.doc_id, r.b) for r in got), key=str) == want
    for r in got:
        assert set(r.b.split(",")) <= set(r.s.split(",")) or not r.b


def test_added_spans_are_sorted_and_touch_no_other(spark):
    for r in pii.find(cases.frame(spark, rows())).collect():
        assert list(r.spans) == sorted(r.spans)
        own = [s for s in r.spans if s not in r.base]
        for s in own:
            assert not any(o != s and o["start"] < s["end"] and s["start"] < o["end"] for o in r.spans)


def test_secrets_are_found_and_plain_text_is_left_alone(spark):
    found = pii.find(cases.frame(spark, rows())).select("doc_id", pii.span_text(F.col("spans")).alias("s")).collect()
    by = {r.doc_id: r.s for r in found}
    assert sum("secret" in (by[r[0]] or "") for r in rows() if r[1] and "token = " in r[1]) >= 15
    plain = [(1, "nothing to see here at all", "en", "s", 1), (2, "year 2024, page 12", "en", "s", 1)]
    assert all(not r.spans for r in pii.find(cases.frame(spark, plain)).collect())


def cued():
    """Checked matches with and without cues, cued local phones and ids, and numbers of the same shapes without a cue."""
    rng, out = random.Random(7), []

    def digits(n):
        return "".join(rng.choice("123456789") for _ in range(n))
    for _ in range(60):
        card = digits(15)
        out += [("checked", f"your card number {card}{next(d for d in '0123456789' if luhn(card + d))} is here")]
        out += [("checked", f"please call +49 {digits(2)} {digits(6)} now"), ("checked", f"word +49 {digits(2)} {digits(6)} word"), ("local", f"my phone: 0{digits(2)} {digits(6)} thanks"),
                ("id", f"with passport no {digits(8)} at hand"), ("plain", f"order {digits(8)} was sent"), ("plain", f"part 0{digits(2)} {digits(6)} is here")]
    return out


def test_cued_numbers_are_found_and_uncued_ones_of_their_shape_are_not(spark):
    rows = [(i, t, "en", "s", len(t)) for i, (_, t) in enumerate(cued())]
    by = {r.doc_id: r.spans for r in pii.find(cases.frame(spark, rows)).collect()}
    for i, (kind, t) in enumerate(cued()):
        number = re.search(r"[0-9][0-9 ]*[0-9]", t)
        got = [(s.kind_no, s.start, s.end) for s in by[i]]
        if kind in ("local", "id"):
            assert got == [(pii.KINDS.index("number") + 1, number.start(), number.end())], t
        elif kind == "plain":
            assert not got, t


def test_a_number_shaped_like_checked_ones_is_found_without_its_plus(spark):
    checked = [f"on +1 ({200 + i}) 555-{1000 + 7 * i} and" for i in range(80)] + [f"item {10000000 + 9 * i} and" for i in range(80)]
    texts = [*checked, "on 1 (345) 555-6789 and", "item 87654321 and"]
    by = {r.doc_id: r.s for r in pii.find(cases.frame(spark, [(i, t, "en", "s", 1) for i, t in enumerate(texts)])).select(
        "doc_id", pii.span_text(F.col("spans")).alias("s")).collect()}
    assert by[160] == "number:3:19" and by[161] == "" and by[0] == "phone:3:20"


def test_no_view_sees_what_gives_its_label(spark):
    rows = [(1, "phone 030 1234567", "en", "s", 1), (2, "phone +49 30 1234567", "en", "s", 1), (3, "x 4111.1111.1111.1111", "en", "s", 1)]
    found = pii._labelled(pii.candidates(cases.frame(spark, rows)).where("kind = 'number'")).collect()
    shape, around = ({r.doc_id: r for r in found if r.view == v} for v in (pii.SHAPE, pii.AROUND))
    assert {i: r.label for i, r in shape.items()} == {1: 1, 2: 1, 3: 1} and {i: r.label for i, r in around.items()} == {2: 1, 3: 1}
    assert not any(r.contact or r.account or r.luhn or r.plus or r.before for r in shape.values()) and shape[2].digits == 11
    assert around[2].contact == 1 and not any(r.digits or r.len or r.separators for r in around.values())


def test_redaction_replaces_spans_and_keeps_columns(spark):
    df = cases.frame(spark, rows())
    out = {r.doc_id: r for r in pii.redact(df).collect() if r.doc_id is not None}
    assert pii.redact(df).columns == df.columns
    assert out[2].text.startswith("😀 [EMAIL] 😀 [IP]") and out[2].n_chars == len(out[2].text)
    assert out[500].text is None and out[501].text == ""
    assert out[4].text == "[CARD]"


def test_empty_table_and_no_candidates(spark):
    assert pii.find(cases.frame(spark, [])).count() == 0
    assert pii.redact(cases.frame(spark, [(1, "none", "en", "s", 4)])).first().text == "none"


def test_no_python_in_the_plan(spark):
    plan = pii.find(cases.frame(spark, rows()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
