"""Personal data by candidate spans and gradient-boosted trees, DataFrame functions only.

1. High-recall generators propose spans, which may overlap: everything shaped
   like an e-mail address, an IP address, a card or phone number (the exact
   base patterns among them), long digit groups, and long mixed tokens.
2. Base spans are the matches that pass their format check; they always stay.
3. Boosted trees score every candidate from its format and its context.  The
   training labels are weak: a candidate that passes a format check, or is
   assigned to a credential name, is positive.  Digit groups are learned in two
   views that label each other (Blum and Mitchell, 1998): shapes, without cues,
   from groups that a contact or account cue precedes and from checked matches
   without their ``+`` or separators; and context, without shapes, from checked
   matches alone, so a cue counts once checked matches follow it.  No view sees
   what gives its label.  Training rows are the distinct feature vectors of all
   candidates, weighted by how often each occurs.
4. A threshold per generator (and view) is calibrated on documents that were not trained
   on (the lowest score at which ``precision`` is reached); candidates at or
   above it that touch no base span and no better candidate are added.

All positions are code points, ends exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finseries.llm.common import let, release, save, spare

#: The base kinds in their listed order, then the method's own.
BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = [*BASE_KINDS, "number", "secret"]

#: Generator patterns.  Runs are possessive, so a long run that fails is scanned once.
#: ``email`` and ``ip`` also take runs that end without the required rest; these are dropped at once
#: (no later start inside such a run could match).
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]++(?:@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)?",
    "ip": r"[0-9]++(?:\.[0-9]++\.[0-9]++\.[0-9]++)?",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "number": r"[0-9](?:[\x20().\-/]{0,2}[0-9])++",
    "secret": r"[A-Za-z0-9+/_\-]{16,}+",
}
#: Words before a span that tell what follows.
CUES = {
    "credential": r"(token|secret|password|passwd|api[_ -]?key|credential)[\x22'\x20]*[=:][\x22'\x20]*$",
    "contact": r"(phone|mobile|call|fax|tel|mail|contact)[.:\x20]*$",
    "account": r"(card|account|iban|passport|ssn|insurance)( (no|number))?[.:#\x20]*$",
}
CONTEXT = 32
MIN_NUMBER_DIGITS = 7

FEATURES = ["generator", "len", "digits", "letters", "upper", "separators", "dots", "distinct", "hex", "at", "plus",
            "luhn", "octets", "before", "after", "credential", "contact", "account"]
CONTEXT_FEATURES = ["before", "after", "credential", "contact", "account"]
#: Views (a generator's kind, or one of the two of ``number``), those that share trees together.
SHAPE, AROUND = "number by shape", "number by context"
GROUPS = [[*BASE_KINDS, "secret"], [SHAPE], [AROUND]]
#: Boosting settings (documented parameters).
TREES, DEPTH, STEP = 10, 3, 0.3


def luhn(digits: Column) -> Column:
    """The Luhn check of a digit string."""
    n = F.length(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        return acc + F.when((n - i) % 2 == 1, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _octets(match: Column) -> Column:
    parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, r"^0+(?=[0-9])", ""))
    return F.forall(parts, lambda p: (F.length(p) <= 3) & (p.try_cast("int") <= 255))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _raw(text: Column, kind: str) -> Column:
    """All matches of a generator's pattern, leftmost and non-overlapping, as strings."""
    gate = F.contains(text, F.lit("@")) if kind == "email" else F.contains(text, F.lit("+")) if kind == "phone" else text.rlike("[0-9]")
    found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
    if kind in ("email", "ip"):
        mark = "@" if kind == "email" else "."
        found = F.filter(found, lambda m: F.contains(m, F.lit(mark)))
    return F.when(gate, found)


def _placed(text: Column, matches: Column) -> Column:
    """(start, end, match) of matches given in order.

    A match's string cannot occur earlier in what the previous match left:
    the pattern would have matched there.
    """
    span = "struct<start:int,end:int,match:string>"
    start = F.struct(F.lit(1).alias("at"), F.array().cast(f"array<{span}>").alias("out"))

    def step(acc: Column, m: Column) -> Column:
        return let(F.call_function("locate", m, text, acc["at"]), lambda p: F.struct(
            (p + F.length(m)).alias("at"),
            F.concat(acc["out"], F.array(F.struct((p - 1).alias("start"), (p - 1 + F.length(m)).alias("end"), m.alias("match")).cast(span))).alias("out")))
    return F.aggregate(matches, start, step, lambda acc: acc["out"])


def _valid(kind: Column, match: Column) -> Column:
    n = F.length(_digits(match))
    return (F.when(kind == "email", True)
            .when(kind == "ip", _octets(match))
            .when(kind == "card", n.between(13, 19) & luhn(_digits(match)))
            .when(kind == "phone", n.between(9, 15))
            .otherwise(False))


def _mixed(match: Column) -> Column:
    return match.rlike("[0-9]") & match.rlike("[A-Za-z]")


def _edge(c: Column) -> Column:
    """What stands beside a span: 0 nothing or space, 1 letter or digit, 2 quote, 3 other."""
    return F.when(c.rlike(r"^\s?$"), 0).when(c.rlike(r"[\p{L}0-9]"), 1).when(c.isin('"', "'", "`"), 2).otherwise(3)


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, thash, kind, start, end, base, checked, features) of every proposed span, in documents that have any.

    ``checked`` are digit groups whose digits pass a phone (after a ``+``) or card check.  What
    stands before a digit group is looked up before its ``+``.
    """
    text = F.col("text")
    span = "start:int,end:int,match:string"

    def proposed(kind: str) -> Column:
        placed = F.coalesce(_placed(text, _raw(text, kind)), F.array().cast(f"array<struct<{span}>>"))
        return F.transform(placed, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["match"].alias("match")))

    spans = [proposed(kind) for kind in KINDS]
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("thash")).where(text.rlike("[0-9]") | F.contains(text, F.lit("@")))
    plussed = (F.col("s.kind") == "number") & (F.col("s.start") > 0) & (F.substring("text", F.col("s.start"), F.lit(1)) == "+")
    at = F.col("s.start") - plussed.cast("int")
    out = rows.select("doc_id", "thash", "text", F.explode(F.concat(*spans)).alias("s")).select(
        "doc_id", "thash", F.col("s.kind").alias("kind"), F.col("s.start").alias("start"), F.col("s.end").alias("end"), F.col("s.match").alias("match"),
        F.lower(F.substring("text", F.greatest(at + 1 - CONTEXT, F.lit(1)), F.least(at, F.lit(CONTEXT)))).alias("left"),
        F.when(at > 0, F.substring("text", at, F.lit(1))).otherwise("").alias("prev"),
        F.substring("text", F.col("s.end") + 1, F.lit(1)).alias("next"), plussed.alias("plussed"))
    m = F.col("match")
    out = out.where(F.when(F.col("kind") == "number", F.length(_digits(m)) >= MIN_NUMBER_DIGITS)
                    .when(F.col("kind") == "secret", _mixed(m)).otherwise(True))
    n = F.length(_digits(m))
    number = F.col("kind") == "number"
    card = n.between(13, 19) & luhn(_digits(m))
    kind_no = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("double")

    def flag(c: Column) -> Column:
        return F.coalesce(c, F.lit(False)).cast("double")
    return out.select(
        "doc_id", "thash", "kind", "start", "end", _valid(F.col("kind"), m).alias("base"),
        F.coalesce(number & ((F.col("plussed") & n.between(9, 15)) | card), F.lit(False)).alias("checked"),
        kind_no.alias("generator"), F.least(F.length(m), F.lit(64)).cast("double").alias("len"),
        F.least(n, F.lit(32)).cast("double").alias("digits"),
        F.least(F.length(F.regexp_replace(m, "[^A-Za-z]", "")), F.lit(32)).cast("double").alias("letters"),
        F.least(F.length(F.regexp_replace(m, "[^A-Z]", "")), F.lit(32)).cast("double").alias("upper"),
        F.least(F.length(F.regexp_replace(m, r"[^\x20()/\-]", "")), F.lit(16)).cast("double").alias("separators"),
        F.least(F.length(F.regexp_replace(m, r"[^.]", "")), F.lit(8)).cast("double").alias("dots"),
        F.least(F.size(F.array_distinct(F.split(m, ""))), F.lit(32)).cast("double").alias("distinct"),
        flag(m.rlike("^([0-9a-f]+|[0-9A-F]+)$")).alias("hex"), flag(F.contains(m, F.lit("@"))).alias("at"),
        flag(m.startswith("+")).alias("plus"),
        flag(~number & card).alias("luhn"),
        flag(m.rlike(r"^[0-9]+(\.[0-9]+){3}$") & _octets(m)).alias("octets"),
        _edge(F.col("prev")).cast("double").alias("before"), _edge(F.col("next")).cast("double").alias("after"),
        *(flag(F.col("left").rlike(p)).alias(name) for name, p in CUES.items()))


@dataclass
class PiiModel:
    trees: list[tuple[list[str], GBTClassificationModel]]  # by views that share them; a group without both labels has none
    thresholds: dict[str, float]  # by view; one that is missing adds nothing


def _calibrating(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 0, F.lit(True))


def _assembled(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)


def _views(found: DataFrame) -> DataFrame:
    """The candidates with ``view`` and ``cued``: a digit group once by shape and once by context, each
    without the other's features (zero).  Digit groups that are IP addresses belong to that generator."""
    number = F.col("kind") == "number"
    views = F.when(number, F.array(F.lit(SHAPE), F.lit(AROUND))).otherwise(F.array("kind"))
    rows = found.where(~(number & (F.col("octets") == 1))).withColumn("cued", number & ((F.col("contact") == 1) | (F.col("account") == 1)))
    hidden = {c: F.when(F.col("view") == SHAPE, 0.0).otherwise(F.col(c)) for c in ("contact", "account")}
    hidden |= {c: F.when(F.col("view") == AROUND, 0.0).otherwise(F.col(c)) for c in FEATURES if c not in ("generator", *CONTEXT_FEATURES)}
    return rows.withColumn("view", F.explode(views)).withColumns(hidden)


def _labelled(found: DataFrame) -> DataFrame:
    """Training rows: the candidates' views with their weak label, and ``held``.  By context a cued group that is not checked has no label."""
    shape = (F.col("view") == SHAPE) & F.col("cued")
    label = F.col("base") | ((F.col("kind") == "secret") & (F.col("credential") == 1)) | F.col("checked") | shape
    return _views(found).where(~((F.col("view") == AROUND) & F.col("cued") & ~F.col("checked"))).withColumns(
        {"label": label.cast("double"), "held": _calibrating(F.col("doc_id"))})


def fit(found: DataFrame, precision: float = 0.95) -> PiiModel:
    """Boost trees on the candidates' weak labels and calibrate a threshold per generator."""
    vectors = save(_labelled(found).groupBy("held", "view", "label", *FEATURES).agg(F.count("*").cast("double").alias("weight")), "pii_vectors")
    trees = []
    for views in GROUPS:
        train = vectors.where(~F.col("held") & F.col("view").isin(views))
        if train.select("label").distinct().count() == 2:
            trees.append((views, GBTClassifier(labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=5, cacheNodeIds=False).fit(
                _assembled(train.coalesce(4)))))
    if not trees:
        return PiiModel([], {})
    marks = (_scored(vectors.where("held"), trees).groupBy("view", F.floor(F.col("score") * 100).alias("mark"))
             .agg(F.sum("weight").alias("n"), F.sum(F.col("weight") * F.col("label")).alias("hits")).collect())  # 7 x 101 rows at most
    thresholds = {}
    for view in (v for views in GROUPS for v in views):
        n = hits = 0.0
        for r in sorted((r for r in marks if r["view"] == view), key=lambda r: -r["mark"]):
            n, hits = n + r["n"], hits + r["hits"]
            if hits >= precision * n and r["mark"] >= 50:
                thresholds[view] = r["mark"] / 100
    return PiiModel(trees, thresholds)


def _scored(found: DataFrame, trees: list[tuple[list[str], GBTClassificationModel]]) -> DataFrame:
    """The rows of views that have trees, with their score."""
    return reduce(DataFrame.unionByName, (
        t.transform(_assembled(found.where(F.col("view").isin(views)))).withColumn("score", vector_to_array("probability")[1]).drop(
            "features", "rawPrediction", "probability", "prediction") for views, t in trees))


def spans(found: DataFrame, model: PiiModel) -> DataFrame:
    """(doc_id, thash, base, spans): base spans, and all spans, as arrays of (kind_no, start, end), sorted."""
    base = found.where("base").withColumn("score", F.lit(2.0))
    chosen = base
    if model.thresholds:
        limit = F.create_map(*(x for k, v in model.thresholds.items() for x in (F.lit(k), F.lit(v))))
        more = _views(found.where("not base")).where((F.col("view") != AROUND) | F.col("cued"))
        chosen = base.unionByName(_scored(more, model.trees).where(F.col("score") >= limit[F.col("view")]).drop("view", "cued"))
    # of overlapping spans the best stays: it beats every span that touches it; base spans all stay
    rows = chosen.select("doc_id", "thash", "base", F.struct((-F.col("score")).alias("s"), (F.col("start") - F.col("end")).alias("l"), "generator", "start", "end").alias("x")).distinct()
    lists = rows.groupBy("doc_id", "thash").agg(
        F.array_sort(F.collect_list(F.when(F.col("base"), F.struct(F.col("x.generator").cast("int").alias("kind_no"), "x.start", "x.end")))).alias("base"),
        F.array_sort(F.collect_list(F.when(~F.col("base"), F.col("x")))).alias("more"))
    kind = "array<struct<kind_no:int,start:int,end:int>>"
    added = F.aggregate("more", F.array().cast(kind), lambda acc, c: F.when(
        F.exists(F.concat(acc, F.col("base")), lambda o: (o["start"] < c["end"]) & (c["start"] < o["end"])), acc).otherwise(
        F.concat(acc, F.array(F.struct(c["generator"].cast("int").alias("kind_no"), c["start"].alias("start"), c["end"].alias("end"))))))
    return lists.select("doc_id", "thash", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def find(docs: DataFrame, precision: float = 0.95) -> DataFrame:
    """One row per row of ``docs``: doc_id, base, spans (arrays of kind_no, start, end; kind_no from 1 as in KINDS).

    Null and empty texts have none; repeated rows each get their result; only
    doc_id and text are read; a generator whose trees have no candidates of
    both labels adds nothing to the base spans.
    """
    found = save(candidates(docs), "pii_candidates")
    marked = spans(found, fit(found, precision)).select(F.col("doc_id").alias("_id"), F.col("thash").alias("_th"), "base", "spans")
    release(docs.sparkSession)
    rows = docs.select("doc_id", F.xxhash64("text").alias("thash"))
    none = F.array().cast("array<struct<kind_no:int,start:int,end:int>>")
    return rows.join(marked, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("thash") == F.col("_th")), "left").select(
        "doc_id", F.coalesce("base", none).alias("base"), F.coalesce("spans", none).alias("spans"))


def span_text(items: Column) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    return F.array_join(F.transform(items, lambda s: F.concat_ws(
        ":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind_no"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, items: Column) -> Column:
    """``text`` with each union of overlapping spans replaced by its first span's [KIND]."""
    by_place = F.array_sort(F.transform(items, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind_no"].alias("kind_no"))))
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.aggregate(
        by_place, first,
        lambda acc, s: F.when(s["start"] < acc["at"], F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))).otherwise(
            F.struct(s["end"].alias("at"), F.concat(
                acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("["),
                F.upper(F.element_at(F.array(*map(F.lit, KINDS)), s["kind_no"])), F.lit("]")).alias("out"))),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text) - acc["at"])))


def redact(docs: DataFrame, precision: float = 0.95) -> DataFrame:
    """``docs`` with every found span replaced by [KIND]; all columns stay, whatever their names, and ``n_chars`` (if there) follows the text.

    Null and empty texts stay as they are; repeated rows are redacted alike.
    """
    of, of_hash, own_hash, marks = spare(docs, "span_id", "span_hash", "own_hash", "found_spans")
    found = save(candidates(docs), "pii_candidates")
    marked = save(spans(found, fit(found, precision)).select(F.col("doc_id").alias(of), F.col("thash").alias(of_hash), F.col("spans").alias(marks)), "pii_spans")
    release(docs.sparkSession)
    out = docs.withColumn(own_hash, F.xxhash64("text"))
    out = out.join(marked, F.col("doc_id").eqNullSafe(F.col(of)) & (F.col(own_hash) == F.col(of_hash)), "left")
    hit = F.col(marks).isNotNull()
    new = {"text": F.when(hit, redacted(F.col("text"), F.col(marks))).otherwise(F.col("text"))}
    out = out.withColumns(new)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(hit, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
