"""The operators' queries by name, and SQL for those that SQL can express."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm import collinear_chains, decontamination, grid_order_join, kd_sharding, language_id, packing, periodic_runs, quality_cascade, signature_tree, token_alignment, toxicity, url_filter, warc
from ebbtide.llm.common import fresh_dir, table

QUERIES = {}
ORACLES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def remainder(divisor: int):
    """crc32 of the document's number as text, modulo the divisor: which fold it is in."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


# --- 1 ---------------------------------------------------------------------------------


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(documents, table(spark, sf_dir, "labels").where(remainder(5) != 0))
    scored = toxicity.score_toxicity(documents, model)
    return scored.select("doc_id", (remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


# --- 2 ---------------------------------------------------------------------------------


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    return warc.read_warc(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op2_warc"] = """
WITH p AS (
  SELECT page_id, COALESCE(html, '') AS payload, octet_length(encode(COALESCE(html, ''))) AS n FROM pages),
d AS (SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT *, MIN(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to
FROM f
"""


# --- 3 ---------------------------------------------------------------------------------


@query
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = language_id.fit_language_model(documents.where(remainder(3) != 1))
    found = language_id.identify_language(documents, model)
    return found.select("doc_id", (remainder(3) == 1).alias("held_out"), "lang_pred", "score", "ambiguous")


# --- 4 ---------------------------------------------------------------------------------


@query
def op4_grid_order_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_order_join.near_vectors(table(spark, sf_dir, "embeddings"))


# --- 5 ---------------------------------------------------------------------------------


@query
def op5_collinear_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collinear_chains.shared_passages(table(spark, sf_dir, "documents")).withColumnsRenamed({"doc": "doc_id", "partner": "partner_id"})


# --- 6 ---------------------------------------------------------------------------------


@query
def op6_signature_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signature_tree.near_documents(table(spark, sf_dir, "documents"))


# --- 7 ---------------------------------------------------------------------------------


@query
def op7_edit_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# --- 8 ---------------------------------------------------------------------------------


@query
def op8_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = kd_sharding.shard_by_kd_tree(table(spark, sf_dir, "documents"), 24)
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


# --- 9 ---------------------------------------------------------------------------------

URL_RULES = (
    url_filter.Rule(url_filter.ALLOW, "org", "/"),
    url_filter.Rule(url_filter.BLOCK, "example.org", "/es/"),
    url_filter.Rule(url_filter.BLOCK, "example.org", "/en/1"),
    url_filter.Rule(url_filter.ALLOW, "com", "/fr/"),
    url_filter.Rule(url_filter.BLOCK, "com", "/de/"),
)


@query
def op9_url_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge_urls(table(spark, sf_dir, "pages"), url_filter.UrlPolicy(URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def _term_count(terms) -> str:
    return " + ".join(f"CAST(regexp_matches(u, '(^|[^a-z0-9]){t}([^a-z0-9]|$)') AS INT)" for t in terms)


_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_FITS = " ".join(
    f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{{{i}}}'"
    for i, r in sorted(enumerate(URL_RULES), key=lambda x: -len(x[1].name))
)
ORACLES["op9_url_vocabulary"] = f"""
WITH r AS (
  SELECT page_id, translate(COALESCE(url, ''), {_AZ}) AS u,
    CASE WHEN contains(COALESCE(url, ''), '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id, u, translate(regexp_extract(rest, '^[^/?#]*'), {_AZ}) AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
j AS (
  SELECT page_id, host, path, {_term_count(url_filter.STRICT_TERMS)} AS strict, {_term_count(url_filter.SOFT_TERMS)} AS soft,
    CASE {_FITS.format(*[r.name for r in URL_RULES])} END AS rule,
    CASE {_FITS.format(*[r.verdict for r in URL_RULES])} END AS ruled
  FROM p)
SELECT page_id, host, path, rule,
  COALESCE(ruled, CASE WHEN strict >= 1 OR soft >= 2 THEN 'block' ELSE 'allow' END) AS verdict FROM j
"""


# --- 10 --------------------------------------------------------------------------------


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


# --- 11 --------------------------------------------------------------------------------


@query
def op11_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    judged = quality_cascade.judge_quality(table(spark, sf_dir, "documents"), report=base)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return judged.select("doc_id", *base, failed.alias("base_failed"), "kept")


ORACLES["op11_quality_cascade"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, COALESCE(text, '') AS t,
    regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(COALESCE(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
places AS (SELECT r, unnest(generate_series(1, len(w) - 7)) AS i FROM d WHERE len(w) >= 8),
windows AS (SELECT p.r, p.i, array_to_string(d.w[p.i:p.i + 7], ' ') AS win FROM places p JOIN d USING (r)),
twice AS (SELECT r, i FROM (SELECT r, i, COUNT(*) OVER (PARTITION BY r, win) AS n FROM windows) WHERE n > 1),
inside AS (SELECT DISTINCT r, i + k AS word FROM twice, (SELECT unnest(generate_series(0, 7)) AS k)),
repeated AS (SELECT r, COUNT(*) AS n FROM inside GROUP BY r),
m AS (
  SELECT doc_id, len(w) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, length(t) - length(replace(t, '!', '')) AS marks,
    len(lines) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(COALESCE(n, 0) AS BIGINT) AS n_repeat_words,
    len(list_filter(w, lambda x: NOT regexp_matches(x, '[A-Za-z\x{80}-\x{10FFFF}]'))) AS letterless
  FROM d LEFT JOIN repeated USING (r)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 10 * marks > 3 * n_words OR 2 * n_dup_lines > n_lines
    OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 5 * letterless > 2 * n_words) AS kept
FROM b
"""


# --- 12 --------------------------------------------------------------------------------


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = token_alignment.score_alignment(table(spark, sf_dir, "documents"), groups=token_alignment.DIGEST)
    return scored.withColumnRenamed("groups", "groups_sha256")


# --- 13 --------------------------------------------------------------------------------


def with_planted_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a tenth of the documents, by their number, go over into a period."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), rewrite=with_planted_period)
    by_exponent = F.array_sort("runs", lambda x, y: F.coalesce(
        F.nullif(F.signum(y["length"] * x["period"] - x["length"] * y["period"]), F.lit(0.0)),
        F.nullif(F.signum(x["start"] - y["start"]), F.lit(0.0)),
        F.signum(x["period"] - y["period"]),
    ).cast("int"))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    top = F.col("top")
    return found.withColumn("top", F.get(by_exponent, F.lit(0))).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        top["start"].alias("start"),
        top["length"].alias("length"),
        top["period"].alias("period"),
        F.expr("1000 * top.length DIV top.period").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
