"""Registered queries of the training-data operators, and their DuckDB SQL twins.

Each ``opN_<name>`` applies one operator, with production parameters, to its
whole table and derives the contract's columns from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finseries.llm import (
    conversations, decontaminate, embeddings, langid, licenses, pii, runs, sentencepiece, simhash, substring, suffix, token_counts, topk,
)
from finseries.llm.common import load, save
from finseries.session import scratch_path


#: SentencePiece model of the registered query (a parameter of the operator).
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.encode_documents(load(spark, sf_dir, "documents"), PIECE_MODEL)


def op2_simhash_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(load(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(load(spark, sf_dir, "documents"), window=13).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"), window=10, k=6)
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def op5_embedding_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(load(spark, sf_dir, "embeddings"), threshold=0.98)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents enter; later copies of a text leave; texts with letters beyond ASCII are recounted by the
    Unicode-aware tokenizer; every batch is sent twice, and the ledger is compacted in between."""
    v1, v2 = token_counts.COUNTERS
    docs = load(spark, sf_dir, "documents")
    counts = save(docs.select("doc_id", "source", "lang", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"),
                              F.coalesce(F.col("text").rlike(r"[^\x00-\x7F]"), F.lit(False)).alias("wide"),
                              token_counts.count_tokens(F.col("text"), v1).alias("n1"), token_counts.count_tokens(F.col("text"), v2).alias("n2")), "token_counts")
    first = counts.groupBy("sha").agg(F.min("doc_id").alias("first"))
    marked = save(counts.join(first, "sha").withColumn("later", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))), "token_copies")
    ledger = scratch_path(spark, "llm", "ledger")
    batches = [("load", token_counts.inserts(counts, v1, "n1")),
               ("copies-leave", token_counts.deletes(marked.where("later"), v1, "n1")),
               ("wide-recount", token_counts.recounts(marked.where("wide and not later"), (v1, "n1"), (v2, "n2")))]
    for name, changes in batches:
        token_counts.commit(spark, ledger, name, changes)
        token_counts.commit(spark, ledger, name, changes)
    token_counts.compact(spark, ledger)
    token_counts.commit(spark, ledger, *batches[0])
    return token_counts.rollup(spark, ledger)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(load(spark, sf_dir, "documents"))
    word = F.transform("places", lambda p: p["word"])
    return found.select("doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
                        F.array_min(word).cast("long").alias("first_word"), F.array_max(word).cast("long").alias("last_word"),
                        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(load(spark, sf_dir, "documents"), length=400).drop("kept")


def _is_kind(kind_no: int):
    return lambda s: s["kind_no"] == kind_no


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(load(spark, sf_dir, "documents"))
    count = {k: F.size(F.filter("base", _is_kind(i))).cast("long") for i, k in enumerate(pii.BASE_KINDS, 1)}
    return found.select("doc_id", *(n.alias(f"n_{k}") for k, n in count.items()),
                        F.sha2(pii.span_text(F.col("base")), 256).alias("base_sha256"), pii.span_text(F.col("spans")).alias("spans"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of the documents after every tenth text was given one."""
    found = runs.find(runs.plant(load(spark, sf_dir, "documents")))
    top = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), top.alias("top"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                       F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))
    return out.select("doc_id", "n_runs", (-F.col("top.start")).alias("start"), F.col("top.length").alias("length"), (-F.col("top.period")).alias("period"),
                      F.expr("1000 * top.length div -top.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op12_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries are the rows whose vec_id is divisible by 100; candidates are all rows but the query's own."""
    return topk.top_k(load(spark, sf_dir, "embeddings"), asks=F.col("vec_id") % 100 == 0, k=10, scale=1024.0)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation of the table, also one that loses all its rows to the damage."""
    convs = load(spark, sf_dir, "conversations")
    found = conversations.repair(conversations.damage(convs))
    of, digest = found.conversations.withColumnRenamed("conv_id", "of"), found.digests().withColumnRenamed("conv_id", "by")
    out = (convs.select("conv_id").distinct()
           .join(of, F.col("conv_id").eqNullSafe(F.col("of")), "left").join(digest, F.col("conv_id").eqNullSafe(F.col("by")), "left"))
    zero = F.lit(0).cast("long")
    counts = [F.when(F.col("n_turns").isNull(), zero).otherwise(F.col(c)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_simhash_near_dups": op2_simhash_near_dups,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_embedding_near_dups": op5_embedding_near_dups,
    "op6_language_id": op6_language_id,
    "op7_token_counts": op7_token_counts,
    "op8_license_scan": op8_license_scan,
    "op9_suffix_array_dedup": op9_suffix_array_dedup,
    "op10_pii": op10_pii,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_exact_top_k": op12_exact_top_k,
    "op13_conversation_repair": op13_conversation_repair,
}

#: DuckDB: the words of a text, A-Z lower-cased.
_WORDS = r"""list_filter(string_split_regex(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

#: DuckDB: rows (number, label, tokens, tokens needed, words of a block, marks) of the license templates, and rows (label, phrase words) of the base phrases.
_TEMPLATE_ROWS = ", ".join(f"({i}, '{x.label}', {list(x.tokens)}, {x.need}, {x.span}, {list(x.marks)}::VARCHAR[])"
                           for i, x in enumerate(licenses.prepared(licenses.TEMPLATES, licenses.THRESHOLD)))
_PHRASE_ROWS = ", ".join(f"('{label}', {phrase.split(' ')})" for phrase, label in licenses.PHRASES)

#: DuckDB: crc32 of an ASCII string, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, c: list_reduce(list_prepend(xor(a, c), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""

#: DuckDB: the cheapest (cost, audit) of several ways; a way that is not open costs ``_NEVER``.
_NEVER = 1_000_000_000


def _way(state: str, cost: str, edit: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}'}}"


def _kept(states: list[str], initial: str, rerole: bool) -> str:
    """The ways into a position by keeping or reroling a turn, from each position in ``states``."""
    ways = []
    for state in states:
        ways.append(f"{{'c': {state}.c + CASE WHEN f IN (1, 2) OR i <> '{initial}' THEN {_NEVER} WHEN f = 3 THEN 5 ELSE 0 END, 'a': {state}.a || 'K'}}")
        if rerole:
            ways.append(f"{{'c': {state}.c + CASE WHEN f IN (1, 2) THEN {_NEVER} WHEN f = 3 THEN 6 ELSE 1 END, 'a': {state}.a || 'R'}}")
    return ", ".join(ways)


ORACLE: dict[str, str] = {
    "op11_periodic_runs": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_CRC32.format("coalesce(doc_id::VARCHAR, '')")} AS h,
                  list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
planted AS (SELECT r, doc_id, w, len(w) AS n, doc_id IS NOT NULL AND h % 10 = 0 AND len(w) > 0 AS hit,
                   CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a, 3 + (h // 10) % 8 AS m FROM d),
changed AS (SELECT r, doc_id, n, CASE WHEN hit THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // m) END])
                                      ELSE w END AS w FROM planted),
words AS (SELECT r, n, unnest(range(n)) AS i, unnest(w) AS word FROM changed),
same AS (SELECT x.r, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.r = y.r AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
stretches AS (SELECT r, q, min(i) AS s, count(*) + q AS len FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS g FROM same)
              GROUP BY r, q, g HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT * FROM stretches x WHERE NOT EXISTS (SELECT 1 FROM stretches y WHERE y.r = x.r AND y.q < x.q AND y.s <= x.s AND y.s + y.len >= x.s + x.len)),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY len DESC, s, q) AS k FROM runs) WHERE k = 1),
digest AS (SELECT r, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM runs GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(s + q, s + len)) AS i FROM runs),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(s AS BIGINT) AS start, CAST(len AS BIGINT) AS length, CAST(q AS BIGINT) AS period,
       CAST(1000 * len // q AS BIGINT) AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM changed LEFT JOIN top USING (r) LEFT JOIN digest USING (r) LEFT JOIN kept USING (r)""",
    "op12_exact_top_k": r"""
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda c: floor(1024 * CAST(c AS DOUBLE))) AS x FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
      FROM v q JOIN v c ON q.r <> c.r AND len(q.x) = len(c.x) WHERE q.vec_id % 100 = 0),
k AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM k WHERE n <= 10""",
    "op13_conversation_repair": f"""
WITH RECURSIVE base AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
              {_CRC32.format("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS h FROM conversations),
damaged AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
                   CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
            FROM base, LATERAL (SELECT unnest(CASE WHEN h = 3 THEN [0, 1] ELSE [0] END)) WHERE h <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS p FROM damaged),
judged AS (SELECT *, left(role, 1) AS i, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 1
                  WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 THEN 2
                  WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 3 ELSE 0 END AS f,
                  lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY p) AS before FROM placed),
counts AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (f = 1) AS blank,
                  count(*) FILTER (f = 2) AS duplicate, count(*) FILTER (f = 3) AS truncated,
                  count(*) FILTER (before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id),
edited(conv_id, p, n0, n1, n2, n3) AS (
    SELECT conv_id, 0::BIGINT, {{'c': 0::BIGINT, 'a': ''}}, {{'c': {_NEVER}::BIGINT, 'a': ''}}, {{'c': 5::BIGINT, 'a': 'I'}}, {{'c': 10::BIGINT, 'a': 'II'}} FROM counts
    UNION ALL
    SELECT conv_id, p, e0, e1, list_min([e2, {_way('e0', '5', 'I')}, {_way('e1', '5', 'I')}, {_way('e3', '5', 'I')}]),
           list_min([e3, {_way('e2', '5', 'I')}, {_way('e0', '10', 'II')}, {_way('e1', '10', 'II')}])
    FROM (SELECT e.conv_id, j.p, {_way('n0', '2', 'D')} AS e0, list_min([{_way('n1', '2', 'D')}, {_kept(['n0'], 's', False)}]) AS e1,
                 list_min([{_way('n2', '2', 'D')}, {_kept(['n0', 'n1', 'n3'], 'u', True)}]) AS e2,
                 list_min([{_way('n3', '2', 'D')}, {_kept(['n2'], 'a', True)}]) AS e3
          FROM edited e JOIN judged j ON j.conv_id IS NOT DISTINCT FROM e.conv_id AND j.p = e.p + 1)),
best AS (SELECT c.conv_id, list_min([e.n0, e.n3]) AS b FROM counts c JOIN edited e ON e.conv_id IS NOT DISTINCT FROM c.conv_id AND e.p = c.n),
marks AS (SELECT conv_id, k, b.a[k] AS edit FROM best, LATERAL (SELECT unnest(range(1, len(b.a) + 1)) AS k)),
numbered AS (SELECT *, count(*) FILTER (edit <> 'I') OVER (PARTITION BY conv_id ORDER BY k) AS p FROM marks),
kept AS (SELECT m.*, j.role, j.text, row_number() OVER (PARTITION BY m.conv_id ORDER BY k) AS o FROM numbered m
         LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM m.conv_id AND j.p = m.p WHERE edit <> 'D'),
headed AS (SELECT *, max(CASE WHEN o = 1 AND edit = 'K' AND left(role, 1) = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS s FROM kept),
lines AS (SELECT conv_id, k, CASE WHEN edit = 'K' THEN role WHEN (o - s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
                 CASE WHEN edit = 'I' THEN '' ELSE text END AS line FROM headed),
repaired AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY k) AS text FROM lines GROUP BY conv_id)
SELECT a.conv_id, CAST(coalesce(c.gaps, 0) AS BIGINT) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
       coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, coalesce(b.b.c, 0) AS cost, coalesce(b.b.a, '') AS audit,
       sha256(coalesce(r.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM a.conv_id""",
    "op5_embedding_near_dups": r"""
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
fine AS (SELECT * FROM v WHERE label IS NOT NULL AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0
         AND len(list_filter(x, lambda c: c <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b ON a.label = b.label AND a.vec_id <> b.vec_id
          WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
comp AS (SELECT a, min(b) AS c FROM reach GROUP BY a),
n AS (SELECT a, count(DISTINCT b) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, c AS component_id, vec_id = c AS kept
FROM v JOIN comp ON comp.a = vec_id LEFT JOIN n ON n.a = vec_id""",
    "op7_token_counts": r"""
WITH d AS (SELECT doc_id, source, lang, coalesce(text, '') AS text, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first FROM documents),
c AS (SELECT source, lang, regexp_matches(text, '[^\x00-\x7F]') AS wide,
             len(list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS n1,
             len(regexp_extract_all(text, '[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]')) AS n2
      FROM d WHERE NOT coalesce(doc_id > first, false))
SELECT source, lang, CASE WHEN wide THEN 'word-mark-v2' ELSE 'white-space-v1' END AS tokenizer,
       count(*) AS n_docs, CAST(sum(CASE WHEN wide THEN n2 ELSE n1 END) AS BIGINT) AS n_tokens
FROM c GROUP BY ALL""",
    "op8_license_scan": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text, {_WORDS.format('text')} AS w FROM documents),
phrases(label, p) AS (VALUES {_PHRASE_ROWS}),
templates(no, label, t, k, span, marks) AS (VALUES {_TEMPLATE_ROWS}),
spots AS (SELECT r, i, label FROM (SELECT r, w, label, p, unnest(range(1, len(w) - len(p) + 2)) AS i
          FROM d, phrases WHERE len(w) >= len(p)) WHERE w[i:i + len(p) - 1] = p),
tokens AS (SELECT no, label, len(t) AS n, k, span, marks, unnest(t) AS x FROM templates),
hits AS (SELECT r, i, no, label, n, k, span, marks, x FROM (SELECT r, unnest(w) AS x, unnest(range(len(w))) AS i FROM d) JOIN tokens USING (x)),
blocks AS (SELECT r, no, label, n, k, marks, array_agg(x) OVER (PARTITION BY r, no ORDER BY i RANGE BETWEEN CURRENT ROW AND span - 1 FOLLOWING) AS s FROM hits),
met AS (SELECT r, label, CAST(len(list_distinct(s)) AS DOUBLE) / n AS c FROM blocks WHERE len(list_distinct(s)) >= k AND len(list_intersect(marks, s)) = len(marks)),
b AS (SELECT r, count(*) AS n, min(i) - 1 AS f, max(i) - 1 AS l, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM spots GROUP BY r),
a AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM
      (SELECT r, label FROM spots UNION SELECT r, label FROM met) GROUP BY r),
m AS (SELECT r, max(c) AS c FROM met GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(b.n, 0) AS BIGINT) AS n_base, CAST(b.f AS BIGINT) AS first_word,
       CAST(b.l AS BIGINT) AS last_word, coalesce(b.labels, '') AS base_labels, coalesce(a.labels, '') AS labels,
       CASE WHEN b.n > 0 THEN 1.0::DOUBLE ELSE coalesce(m.c, 0.0::DOUBLE) END AS score
FROM d LEFT JOIN b USING (r) LEFT JOIN a USING (r) LEFT JOIN m USING (r)""",
    "op3_substring_dedup": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS (SELECT r, doc_id, i, array_to_string(w[i:i + 12], ' ') AS phrase
        FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
least_id AS (SELECT phrase, min(doc_id) AS first FROM win GROUP BY phrase),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 13)) AS p FROM win JOIN least_id USING (phrase) WHERE doc_id > first),
words AS (SELECT r, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM d),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM words ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)""",
    "op4_benchmark_decontamination": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format('text')} AS w FROM documents),
b AS (SELECT item_id, {_WORDS.format('text')} AS w FROM benchmark),
bs AS (SELECT item_id, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
        FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM bs)),
spans AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase
          FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
                FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hits AS (SELECT r, i, spans.n, item_id FROM spans JOIN win USING (n, phrase)),
hit_words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (r) LEFT JOIN items USING (r)""",
}
