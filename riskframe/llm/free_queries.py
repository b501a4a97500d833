"""Queries of the operators that run Arrow batches in tasks, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import collocations, decontaminate, filter_audit, language_model, packing, quality, simhash, token_counts, topk, toxicity
from riskframe.llm.registry import query, table

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def remainder(key: str, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``; a missing key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % parts


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), remainder("_key", 5) != 0)
    return toxicity.scored(docs, model).select(
        "doc_id",
        (remainder("doc_id", 5) == 0).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= 0.5).cast("int").alias("predicted"),
        F.array_join(F.transform("_spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias("spans"),
    )


_OP2_SQL = f"""
WITH items AS (SELECT coalesce(item_id::VARCHAR, '') AS id, regexp_extract_all({_LOWER}, '{_WORD}') AS ws FROM benchmark),
windows AS (
  SELECT DISTINCT id, array_to_string(ws[i + 1:i + least({decontaminate.WINDOW}, len(ws))], ' ') AS w, least({decontaminate.WINDOW}, len(ws)) AS n
  FROM (SELECT id, ws, unnest(range(0, len(ws) - least({decontaminate.WINDOW}, len(ws)) + 1)) AS i FROM items WHERE len(ws) > 0)),
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS ws FROM documents),
places AS (
  SELECT rid, i, n, array_to_string(ws[i + 1:i + n], ' ') AS w
  FROM (SELECT rid, ws, n, unnest(range(0, len(ws) - n + 1)) AS i FROM d, (SELECT DISTINCT n FROM windows) WHERE len(ws) >= n)),
hits AS (SELECT rid, i, n, id FROM places JOIN windows USING (w, n)),
hit_words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hits) GROUP BY rid),
found AS (SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT rid, id FROM hits) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (rid) LEFT JOIN found USING (rid)
"""


@query("op2_decontamination", _OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_OP3_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.rid, a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.rid <> b.rid),
ranked AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id)::INT AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query("op3_top_k", _OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op4_token_counts")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count(table(spark, sf_dir, "documents"))


@query("op7_simhash")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.group(table(spark, sf_dir, "documents"))


@query("op8_language_model")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder("doc_id", 10) == 0
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (~held_out).alias("train"))
    scores = language_model.score(docs)
    return scores.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op9_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


_OP11_SQL = f"""
WITH pieces AS (
  SELECT lang, unnest(string_split(translate(t, '.,;:!?' || chr(11) || chr(12) || chr(13), repeat(chr(10), 9)), chr(10))) AS piece
  FROM (SELECT coalesce(lang, '{collocations.UNKNOWN}') AS lang, {_LOWER} AS t FROM documents)),
numbered AS (SELECT row_number() OVER () AS pid, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
w AS (SELECT pid, lang, unnest(ws) AS w1, unnest(range(len(ws))) AS i FROM numbered),
places AS (SELECT lang, w1, lead(w1, 1) OVER piece AS w2, lead(w1, 2) OVER piece AS w3 FROM w WINDOW piece AS (PARTITION BY pid ORDER BY i)),
totals AS (SELECT lang, count(*) AS n FROM w GROUP BY lang),
f AS (
  SELECT lang, w1 AS p, count(*) AS n FROM places GROUP BY ALL UNION ALL
  SELECT lang, w1 || ' ' || w2, count(*) FROM places WHERE w2 IS NOT NULL GROUP BY ALL UNION ALL
  SELECT lang, w1 || ' ' || w2 || ' ' || w3, count(*) FROM places WHERE w3 IS NOT NULL GROUP BY ALL),
cand AS (SELECT lang, p, n AS a, string_split(p, ' ') AS ws FROM f WHERE n >= {collocations.LEAST} AND contains(p, ' ')),
halves AS (
  SELECT *, array_to_string(ws[1:cut], ' ') AS lp, array_to_string(ws[cut + 1:len(ws)], ' ') AS rp
  FROM (SELECT lang, p, a, ws, unnest(range(1, len(ws))) AS cut FROM cand)),
cuts AS (
  SELECT h.lang, h.p, a, cut, l.n AS l, r.n AS r, (1000000::HUGEINT * a * a // (l.n::HUGEINT * r.n))::BIGINT AS score
  FROM halves h JOIN f l ON l.lang = h.lang AND l.p = lp JOIN f r ON r.lang = h.lang AND r.p = rp),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, q, max(a) AS longer FROM (
    SELECT lang, unnest([ws[1] || ' ' || ws[2], ws[2] || ' ' || ws[3]]) AS q, a FROM cand WHERE len(ws) = 3) GROUP BY ALL),
shown AS (
  SELECT best.* FROM best LEFT JOIN inside ON inside.lang = best.lang AND q = p WHERE longer IS NULL OR longer * 100 < a * {collocations.HIDES}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank FROM shown)
SELECT lang, rank, p AS phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {collocations.TOP}
"""


@query("op11_collocations", _OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


_SPACED = r"[^\x20\x09-\x0D]+"
_OP12_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{_SPACED}') AS ws, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
fails AS (
  SELECT doc_id, part,
    [len(ws) < {filter_audit.LEAST_WORDS}, 100 * len(list_distinct(ws)) < {filter_audit.LEAST_DISTINCT} * len(ws),
     100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > {filter_audit.MOST_CAPITALS} * length(t),
     regexp_matches(t, '{filter_audit.SYMBOLS}'), coalesce(first < doc_id, FALSE)] AS x
  FROM w),
said AS (SELECT doc_id, coalesce(bool_or(quality = 1), FALSE) AS good, coalesce(bool_or(toxic = 1), FALSE) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
counted AS (
  SELECT part, x, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM fails LEFT JOIN said USING (doc_id) GROUP BY part, x),
letters(c) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
perms AS (
  SELECT a.c || b.c || c.c || d.c || e.c AS filter_order
  FROM letters a JOIN letters b ON b.c <> a.c JOIN letters c ON c.c NOT IN (a.c, b.c) JOIN letters d ON d.c NOT IN (a.c, b.c, c.c)
  JOIN letters e ON e.c NOT IN (a.c, b.c, c.c, d.c)),
steps AS (
  SELECT filter_order, step, strpos('ABCDE', filter_order[step]) AS own,
    list_transform(range(1, step), lambda i: strpos('ABCDE', filter_order[i])) AS before
  FROM (SELECT filter_order, unnest(range(1, 6))::INT AS step FROM perms)),
judged AS (
  SELECT part, filter_order, step, own, x[own] AS fails, len(list_filter(before, lambda i: x[i])) > 0 AS gone,
    len(list_filter(x, lambda v: v)) AS k, n, good, toxic
  FROM counted, steps),
told AS (
  SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (fails AND NOT gone), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (fails AND gone), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (fails AND k = 1), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (fails AND NOT gone), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (fails AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM judged GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM told
"""


@query("op12_filter_audit", _OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op13_quality")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))
