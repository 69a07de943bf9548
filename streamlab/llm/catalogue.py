"""The registered queries of the text operators, with SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlab.llm import (
    collocations, decontaminate, hard_negatives, html_text, jaccard_join, packing, quality, secrets, sharding, substring_dedup, suffix_dedup, toxicity,
)
from streamlab.llm.bpe import BpeCodec
from streamlab.llm.session import documents

RANKS = "byte_bpe_multi_50k.tiktoken"


def codec(spark: SparkSession) -> BpeCodec:
    return BpeCodec(spark, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def digests(encoded: DataFrame) -> DataFrame:
    """Token count and digests of ``ids`` and ``decoded``."""
    return encoded.withColumns(
        {
            "n_tokens": F.size("ids").cast("long"),
            "ids_sha256": F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256),
            "decoded_sha256": F.sha2(F.col("decoded"), 256),
        }
    )


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return digests(codec(spark).round_trip(docs)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "class_id")


OP2_SQL = r"""
  WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
  shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
    FROM words, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i) WHERE len(w) > 0),
  sizes AS (SELECT doc_id, count(*) AS n, min(md5(s)) || max(md5(s)) AS x FROM shingles GROUP BY 1),
  sets AS (SELECT doc_id, n, md5(string_agg(s, chr(10) ORDER BY s)) AS d FROM shingles JOIN sizes USING (doc_id) GROUP BY 1, 2),
  classes AS (SELECT doc_id, n, min(doc_id) OVER (PARTITION BY d) AS c FROM sets),
  own AS (SELECT doc_id, s, n FROM shingles JOIN classes USING (doc_id) WHERE doc_id = c),
  pairs AS (
    SELECT x.doc_id AS a, y.doc_id AS b FROM own x JOIN own y USING (s)
    WHERE x.doc_id < y.doc_id AND 100 * least(x.n, y.n) >= 75 * greatest(x.n, y.n)
    GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
  edges AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
  reach AS (
    SELECT a AS node, a AS root FROM edges UNION SELECT e.b, r.root FROM reach r JOIN edges e ON e.a = r.node),
  roots AS (SELECT node, min(root) AS root FROM reach GROUP BY 1)
  SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(root, c, doc_id) AS component_id,
         coalesce(c, doc_id) AS class_id
  FROM documents LEFT JOIN classes USING (doc_id) LEFT JOIN roots ON node = c"""


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    machine = toxicity.fit(docs, toxicity.training_labels(documents(spark, sf_dir, "labels")))
    scored = toxicity.score(docs, machine)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = packing.dealt(documents(spark, sf_dir).select("doc_id", "text"))
    return packing.pack(packing.tokenized(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(documents(spark, sf_dir))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(documents(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    starts, ends = F.col("span_starts"), F.col("span_ends")
    removed = F.aggregate(F.zip_with(starts, ends, lambda a, b: b - a), F.lit(0).cast("long"), lambda total, n: total + n)
    return suffix_dedup.dedup(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size(starts).cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*secrets.BASE_KINDS))
    found = secrets.scan(documents(spark, sf_dir).select("doc_id", "text")).drop("text")
    counts = {f"n_{k}": secrets.count_of(spans, k) for k in secrets.BASE_KINDS}
    return found.withColumns(
        counts | {"base_sha256": F.sha2(secrets.joined(base).cast("binary"), 256), "spans": secrets.joined(spans)}
    ).select("doc_id", *counts, "base_sha256", "spans")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "source")
    judged = quality.judge(docs, documents(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


OP9_SQL = r"""
  WITH texts AS (
    SELECT doc_id, coalesce(source, '') AS s, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
    FROM documents),
  windows AS (SELECT doc_id, i, w[i : i + 4] AS g FROM texts, unnest(range(1, len(w) - 3)) AS u(i)),
  repeats AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
  steps AS (SELECT doc_id, least(5, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i), 5)) AS d FROM repeats),
  repeated AS (SELECT doc_id, sum(d)::BIGINT AS n FROM steps GROUP BY 1),
  m AS (
    SELECT doc_id, s, len(w)::BIGINT AS n_words, len(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
           (len(t) - len(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
           (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
    FROM texts LEFT JOIN repeated USING (doc_id)),
  judged AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, @LEVEL AS lev FROM m),
  good AS (
    SELECT s, lev FROM judged SEMI JOIN (SELECT * FROM labels WHERE quality = 1) USING (doc_id) WHERE NOT base_failed),
  strata AS (SELECT s, count(*) >= @LEAST AS own, CASE WHEN count(*) >= @LEAST THEN s ELSE '' END AS g FROM good GROUP BY 1),
  holdout AS (
    SELECT own, g, t, count(*) AS n, count_if(lev <= t)::BIGINT AS k
    FROM good JOIN strata USING (s), unnest(range(@LEVELS)) AS u(t) GROUP BY 1, 2, 3),
  terms AS (
    SELECT own, g, t, sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(@ALPHA) + (n - i) * ln(1 - @ALPHA))) AS p
    FROM holdout, unnest(range(k + 1)) AS u(i) WHERE k <= n * @ALPHA GROUP BY 1, 2, 3),
  strict AS (
    SELECT own, g, max(t) AS t FROM terms
    WHERE p <= @DELTA / greatest(1, (SELECT count(*) FROM (SELECT DISTINCT own, g FROM holdout))) GROUP BY 1, 2)
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
         NOT (base_failed OR coalesce(lev <= strict.t, false)) AS kept
  FROM judged LEFT JOIN strata USING (s) LEFT JOIN strict USING (own, g)"""
_SQL_VALUES = {
    "symbols": "n_symbols / nullif(n_words, 0)",
    "dup_lines": "n_dup_lines / nullif(n_words, 0)",
    "repeats": "n_repeat_words / nullif(n_words, 0)",
    "long_words": "word_chars / nullif(n_words, 0)",
    "short_words": "1 / (word_chars / nullif(n_words, 0))",
}


def _op9_sql() -> str:
    """The cut-offs and bounds of the operator put into the SQL."""
    rules = [
        "CASE " + " ".join(f"WHEN {v} > {c} THEN {t}" for t, c in enumerate(quality.RULES[r])) + f" ELSE {quality.LEVELS} END"
        for r, v in _SQL_VALUES.items()
    ]
    values = {"@LEVELS": quality.LEVELS, "@LEVEL": f"least({', '.join(rules)})", "@ALPHA": quality.ALPHA, "@DELTA": quality.DELTA, "@LEAST": quality.LEAST_HOLDOUT}
    sql = OP9_SQL
    for name, value in values.items():
        sql = sql.replace(name, str(value))
    return sql


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


OP11_SQL = r"""
  WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
  words AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
  totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY 1),
  f AS (
    SELECT lang, k, w[i : i + k - 1] AS g, count(*) AS f
    FROM words, unnest([1, 2, 3]) AS u(k), unnest(range(1, len(w) - k + 2)) AS t(i) GROUP BY ALL),
  longer AS (
    SELECT lang, g, max(f) AS f
    FROM (SELECT lang, g[1:2] AS g, f FROM f WHERE k = 3 UNION ALL SELECT lang, g[2:3], f FROM f WHERE k = 3) GROUP BY 1, 2),
  candidates AS (
    SELECT c.lang, c.k, c.g, c.f AS a FROM f c LEFT JOIN longer b ON c.k = 2 AND b.lang = c.lang AND b.g = c.g AND b.f >= 10
    WHERE c.k > 1 AND c.f >= 10 AND NOT coalesce(100 * b.f >= 50 * c.f, false)),
  cuts AS (
    SELECT c.lang, c.g, a, cut, l.f AS l, r.f AS r,
           ((1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f))::BIGINT AS score
    FROM candidates c JOIN (SELECT unnest([1, 2]) AS cut) ON cut < c.k
    JOIN f l ON l.lang = c.lang AND l.g = c.g[1:cut] JOIN f r ON r.lang = c.lang AND r.g = c.g[cut + 1 :]),
  lowest AS (
    SELECT *, array_to_string(g, ' ') AS phrase FROM cuts
    QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1)
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
  FROM lowest JOIN totals USING (lang) QUALIFY rank <= 2000"""


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hard_negatives.mine(documents(spark, sf_dir, "embeddings"))
    return found.withColumns({c: F.col(c).try_cast("long") for c in ("positive_score", "negative_score")})


OP12_SQL = """
  WITH taken AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
  scores AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
    FROM taken a JOIN taken b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
  positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
  SELECT anchor_id, positive_id,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
         id AS negative_id, positive_score, score AS negative_score
  FROM positives JOIN scores USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
  QUALIFY rank <= 10"""


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    starts, ends = F.col("span_starts"), F.col("span_ends")
    removed = F.aggregate(F.zip_with(starts, ends, lambda a, b: b - a), F.lit(0).cast("long"), lambda total, n: total + n)
    return substring_dedup.dedup(documents(spark, sf_dir)).select(
        "doc_id", "n_words", removed.alias("n_removed"), F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


OP13_SQL = r"""
  WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
  windows AS (
    SELECT doc_id, i, array_to_string(w[i : i + 34], ' ') AS g FROM texts, unnest(range(1, len(w) - 33)) AS t(i)),
  repeated AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY g) > 1),
  gone AS (SELECT DISTINCT doc_id, i + k AS p FROM repeated, unnest(range(35)) AS t(k)),
  words AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM texts),
  kept AS (
    SELECT doc_id, count(g.p) AS n, coalesce(string_agg(x, ' ' ORDER BY p) FILTER (WHERE g.p IS NULL), '') AS t
    FROM words LEFT JOIN gone g USING (doc_id, p) GROUP BY 1)
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
  FROM texts LEFT JOIN kept USING (doc_id)"""


QUERIES = {
    f.__name__: f
    for f in (
        op1_byte_bpe, op2_jaccard_join, op3_toxicity, op4_packing, op5_sharding, op6_main_text,
        op7_suffix_dedup, op8_secrets, op9_quality, op10_decontaminate, op11_collocations,
        op12_hard_negatives, op13_substring_dedup,
    )
}
ORACLES = {"op2_jaccard_join": OP2_SQL, "op9_quality": _op9_sql(), "op11_collocations": OP11_SQL, "op12_hard_negatives": OP12_SQL, "op13_substring_dedup": OP13_SQL}
