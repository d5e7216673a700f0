"""Small inputs shared by the tests of the training-data operators."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


def words(rng, n, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def corpus(seed=1, n=60):
    """Rows with copies, near copies, shared passages, nulls, empty and odd texts, repeated rows and a long text."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["the", "of", "é", "ñandú", "MIT"]
    passage = words(rng, 60, vocabulary)
    texts = [words(rng, rng.randrange(1, 160), vocabulary) for _ in range(n)]
    texts += [texts[0], texts[0], texts[1] + " tail", "head " + texts[1]]
    texts += [words(rng, 30, vocabulary) + "\n" + passage + " " + words(rng, 20, vocabulary) for _ in range(6)]
    texts += [None, None, "", "   ", "\t\n", "...", "x", "x y", "日本語 テキスト 😀", "a" * 3000, "ab " * 1500, words(rng, 6000, vocabulary)]
    rows = [(i, t, "en", f"src{0 if i % 3 else i % 5}", len(t or "")) for i, t in enumerate(texts)]
    rows += [(3, texts[3], "en", "src0", len(texts[3]))]  # a repeated row
    rows += [(None, texts[5], None, None, None), (None, None, None, None, None)]
    return rows


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def with_clashes(df):
    """The same rows with extra columns named like the operators' own."""
    from pyspark.sql import functions as F
    names = ["fp", "root", "component_id", "h", "k", "g", "pos", "words", "spans", "label", "score", "thash", "node", "tokens", "ids", "text2",
             "_id", "_th", "_thash", "_spans", "_w", "_k", "first_id", "own_hash", "hit_id", "span_id", "found_spans", "n_words", "lang_pred", "sha"]
    return df.withColumns({n: F.lit("clash") for n in names if n not in df.columns})


BIG = 1 << 60


def big_ids():
    """Ids above 2^53 beside a null one, in one batch, with texts of every kind a stage looks at."""
    base = "the thing that was there and the other thing of the house with a word or two more for good measure"
    return [(BIG + 1, base + " alpha beta gamma", "en", "s", 1), (BIG + 3, "call the office at +1 (555) 010-9999 today and the other thing that was there", "en", "s", 2),
            (None, "another thing of the that and was in the house and then there was no one", "en", "s", 3), (BIG + 5, None, "en", "s", 0),
            (BIG + 7, base + " alpha beta gamma", "en", "s", 1)]
