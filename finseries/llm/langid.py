"""Language identification by error-correcting output codes.

Features are hashed byte n-grams of the lower-cased letters of the whole text.
Every language gets a codeword; for each code bit a binary n-gram classifier
(a naive Bayes log-odds of the languages whose bit is one against the rest)
gives a margin.  Loss-weighted decoding (Escalera, Pujol and Radeva, 2010)
picks the codeword with the smallest sum of logistic losses, each weighted by
how often that classifier is right on that language's training documents.
A document whose best codeword holds less than half of the likelihood is
flagged ambiguous.

Training is two distributed passes over all training documents (n-gram counts
by language, then hits by language and bit).  What reaches the driver is one
row per language and bucket, and one per language: bounded by the number of
languages, not by the corpus.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finseries.llm.common import map_texts, ship_package

#: n-gram lengths in bytes, and hash buckets.
ORDERS = (2, 3, 4)
BUCKETS = 1 << 14
#: Bytes hashed at once: bounds memory on very long texts.
BLOCK = 1 << 20
#: Documents decoded at once inside a task, and taken out of an Arrow batch at once.
DECODE_ROWS = 128
JUDGED_ROWS = 2_000
#: Additive smoothing of a language's n-gram frequencies (pseudo-counts per bucket).
SMOOTH = 0.5
#: A document is ambiguous if its best language's score is below this.
MAJORITY = 0.5
#: Languages up to this many get every two-way split as a code bit; more get random splits.
EXHAUSTIVE = 5
UNKNOWN = "und"

_KEEP_LETTERS = bytes(b if chr(b).isalpha() or b >= 0x80 else 0x20 for b in range(256))
#: What may be a letter; among these are also characters that are numbers (such as superscripts and fractions).
_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    return text is not None and any(m.group().isalpha() for m in _LETTER.finditer(text))


def gram_counts(text: str) -> np.ndarray:
    """Hashed n-gram counts of the whole text (letters lower-cased, other ASCII as one space)."""
    raw = text.lower().encode("utf-8", "surrogatepass").translate(_KEEP_LETTERS)
    data = np.frombuffer(b" " + b" ".join(raw.split()) + b" ", dtype=np.uint8)
    out = np.zeros(BUCKETS, dtype=np.int64)
    for i in range(0, len(data), BLOCK):
        part = data[i:i + BLOCK + max(ORDERS) - 1].astype(np.uint32)  # grams that start in this block
        for n in ORDERS:
            size = min(BLOCK, len(part) - n + 1)
            if size <= 0:
                continue
            code = np.full(size, n, dtype=np.uint32)
            for j in range(n):
                code = code * np.uint32(0x01000193) + part[j:j + size]
            code ^= code >> np.uint32(15)
            out += np.bincount((code * np.uint32(0x9E3779B1)) >> np.uint32(32 - 14), minlength=BUCKETS)
    return out


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """(languages x bits) of 0/1: all two-way splits for few languages, else balanced random splits."""
    if n <= 1:
        return np.zeros((n, 0), dtype=np.int8)
    if n <= EXHAUSTIVE:
        cols = [[0, *(k >> i & 1 for i in range(n - 1))] for k in range(1, 1 << (n - 1))]
        return np.array(cols, dtype=np.int8).T
    rng, bits, best = np.random.default_rng(seed), int(10 * np.ceil(np.log2(n))) + 5, None
    for _ in range(20):
        code = np.stack([rng.permutation(np.arange(n) % 2) for _ in range(bits)], axis=1).astype(np.int8)
        apart = (code[:, None] != code[None]).sum(axis=2) + bits * np.eye(n, dtype=int)
        if best is None or apart.min() > best[0]:
            best = (apart.min(), code)
    return best[1]


@dataclass
class LanguageModel:
    langs: list[str]
    code: np.ndarray
    weights: np.ndarray  # buckets x bits: log-odds
    trust: np.ndarray = field(default=None)  # languages x bits: rows sum to one

    def margins(self, counts: np.ndarray) -> np.ndarray:
        n = np.maximum(counts.sum(axis=1, keepdims=True), 1)
        return (counts.astype(np.float32) @ self.weights).astype(np.float64) / np.sqrt(n)

    def decode(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language number, score, ambiguous) for rows of n-gram counts."""
        rows = len(counts)
        if len(self.langs) == 1:
            return np.zeros(rows, dtype=int), np.ones(rows), np.zeros(rows, dtype=bool)
        sign = 2.0 * self.code - 1
        loss = np.einsum("lb,rlb->rl", self.trust, np.logaddexp(0, -sign[None] * self.margins(counts)[:, None, :]))
        order = np.argsort(loss, axis=1, kind="stable")
        score = 1 / np.exp(np.take_along_axis(loss, order[:, :1], 1) - loss).sum(axis=1)
        return order[:, 0], score, score < MAJORITY


def _held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the doc_id's text is 1 mod 3; null ids are not held out (nor learned from)."""
    return F.coalesce(_held_out(doc_id), F.lit(False))


def _counts(texts) -> np.ndarray:
    return np.stack([gram_counts(t) for t in texts])


def fit(docs: DataFrame) -> LanguageModel | None:
    """Learn from text and lang of the documents that are not held out; None if there are none."""
    ship_package(docs.sparkSession)
    train = docs.where(~_held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b["lang"], b["text"], strict=True):
                if has_letter(text):
                    c = gram_counts(text)
                    total[lang] = total[lang] + c if lang in total else c
        for lang, c in total.items():
            at = np.flatnonzero(c)
            yield pd.DataFrame({"lang": lang, "bucket": at, "n": c[at]})

    sums = train.mapInPandas(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    if sums.empty:
        return None
    langs = sorted(sums["lang"].unique())
    freq = np.full((len(langs), BUCKETS), SMOOTH)
    freq[sums["lang"].map({x: i for i, x in enumerate(langs)}), sums["bucket"]] += sums["n"]
    freq /= freq.sum(axis=1, keepdims=True)
    code = codewords(len(langs))
    side = [np.log((code == k).T.astype(float) @ freq / (code == k).sum(axis=0)[:, None]) for k in (0, 1)]
    model = LanguageModel(langs, code, (side[1] - side[0]).T.astype(np.float32))
    if len(langs) > 1:
        model.trust = _trust(train, model)
    return model


def _trust(train: DataFrame, model: LanguageModel) -> np.ndarray:
    """How often each bit's classifier is right on each language's training documents, rows summing to one."""
    bits = model.code.shape[1]
    row = {x: i for i, x in enumerate(model.langs)}

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        right, n = np.zeros(model.code.shape), np.zeros(len(row))
        for b in batches:
            b = b[[has_letter(t) for t in b["text"]]]
            for i in range(0, len(b), DECODE_ROWS):
                part = b.iloc[i:i + DECODE_ROWS]
                lang = part["lang"].map(row).to_numpy()
                hit = (model.margins(_counts(part["text"])) > 0) == (model.code[lang] == 1)
                np.add.at(right, lang, hit)
                np.add.at(n, lang, 1)
        yield pd.DataFrame({"lang": np.arange(len(row)), "n": n} | {f"r{j}": right[:, j] for j in range(bits)})

    shape = "lang int, n double" + "".join(f", r{j} double" for j in range(bits))
    got = train.mapInPandas(judge, shape).groupBy("lang").agg(F.sum("n").alias("n"), *(F.sum(f"r{j}").alias(f"r{j}") for j in range(bits))).toPandas().sort_values("lang")
    share = (got[[f"r{j}" for j in range(bits)]].to_numpy() + 1) / (got["n"].to_numpy()[:, None] + 2)
    return share / share.sum(axis=1, keepdims=True)


def _judge(model: LanguageModel | None, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    lang, score, level = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), dtype=bool)
    known = [i for i, t in enumerate(texts) if model is not None and has_letter(t)]
    for i in range(0, len(known), DECODE_ROWS):
        at = known[i:i + DECODE_ROWS]
        best, score[at], level[at] = model.decode(_counts(texts[k] for k in at))
        for k, x in zip(at, best, strict=True):
            lang[k] = model.langs[x]
    return lang, score, level


def predict(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous: one row per row of ``docs``.

    Only doc_id and text are read.  Null texts, texts without a letter, and
    all texts when no language was learned, give ``und`` with score 0.
    ``score`` is the share of exp(-loss) of the chosen language.
    """
    ship_package(docs.sparkSession)

    def compute(texts: list[str | None]) -> dict[str, list | np.ndarray]:
        return dict(zip(("lang_pred", "score", "ambiguous"), _judge(model, texts), strict=True))

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return map_texts(rows, lambda: compute, "lang_pred string, score double, ambiguous boolean")


def accepted(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has one clear language (neither ``und`` nor ambiguous).

    Null, empty and letterless texts go; a repeated row stays or goes as the
    other does.  Rows pass as Arrow arrays, so ids stay as they are.
    """
    ship_package(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, JUDGED_ROWS):
                b = whole.slice(i, JUDGED_ROWS)
                lang, _, level = _judge(model, b.column(at).to_pylist())
                yield b.filter(pa.array((np.array(lang) != UNKNOWN) & ~level))

    return docs.mapInArrow(run, docs.schema)
