"""Registered queries of the corpus operators: thin calls with production
parameters over whole tables, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe_codec, chat_tree, hard_negatives, license_scan, minmax_dedup, packing, periodic_runs, pii, rp_forest,
               token_counts, topk_search, toxicity, url_filter)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_pii_sanitisation(spark, sf_dir):
    return pii.pii_report(read(spark, sf_dir, "documents"))


def op2_toxic_segments(spark, sf_dir):
    out = toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted", "n_segments")


def op3_minmax_dedup(spark, sf_dir):
    return minmax_dedup.near_duplicates(read(spark, sf_dir, "documents"), width=4)


def op4_bpe_codec(spark, sf_dir):
    return bpe_codec.codec_digests(read(spark, sf_dir, "documents"),
                                   public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op5_rp_forest(spark, sf_dir):
    return rp_forest.forest_search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op6_packing(spark, sf_dir):
    return packing.pack_documents(read(spark, sf_dir, "documents"),
                                  public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0)


def _number(text):
    """A number below 2^24 from the text, the same in Spark and DuckDB."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 6), 16, 10).cast("long")


def url_captures(pages: DataFrame) -> DataFrame:
    """Pages with a fetch date derived from the URL (the table has none)."""
    n = _number(F.coalesce(F.col("url"), F.lit("")))
    return pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), (n % 365).cast("int"))
                        .alias("fetch_date"))


def url_entries(pages: DataFrame) -> DataFrame:
    """A dated list derived from the hosts of all pages: hosts and the hosts
    above them are blocked, released and blocked again; some are allowed.  Of hosts
    with the first step of a path, written with the scheme, some are blocked or allowed."""
    host = pages.select(url_filter.host_of(F.col("url")).alias("host")).where("host <> ''").distinct()
    above = host.select(F.regexp_replace("host", r"^[^.]*\.", "").alias("above")).where(
        F.col("above").contains(".") & F.col("above").rlike(r"\..*\.")).distinct()
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), n.cast("int"))
    first = F.get(url_filter.steps_of(F.col("url")), 0)
    path = (pages.select(url_filter.host_of(F.col("url")).alias("host"), first.alias("step"))
            .where("host <> '' and step is not null and not contains(step, ' ')").distinct()
            .select(F.concat_ws("/", "host", "step").alias("path"), F.concat(F.lit("https://WWW."), "host", F.lit("/"), "step",
                                                                             F.lit("/")).alias("written")))
    n = _number(F.col("host"))
    u = _number(F.col("above"))
    v = _number(F.col("path"))
    entry = lambda df, p, kind, action, at: df.select(
        F.col(p).alias("pattern"), F.lit(kind).alias("kind"), F.lit(action).alias("action"), at.alias("entry_date"))
    out = entry(host.where(n % 3 == 0), "host", "block", "add", day(n % 200))
    out = out.unionByName(entry(host.where(n % 6 == 0), "host", "block", "remove", day(n % 200 + 60)))
    out = out.unionByName(entry(host.where(n % 30 == 0), "host", "block", "add", day(n % 200 + 120)))
    out = out.unionByName(entry(host.where(n % 7 == 0), "host", "allow", "add", day(n % 100 + 50)))
    out = out.unionByName(entry(above.where(u % 4 == 1), "above", "block", "add", day(u % 150)))
    out = out.unionByName(entry(path.where(v % 5 == 0), "written", "block", "add", day(v % 300)))
    return out.unionByName(entry(path.where(v % 5 == 1), "path", "allow", "add", day(v % 300)))


def op7_url_filter(spark, sf_dir):
    pages = read(spark, sf_dir, "pages")
    return url_filter.judge(url_captures(pages), url_entries(pages))


def op8_token_counts(spark, sf_dir):
    return token_counts.token_counts(read(spark, sf_dir, "documents"),
                                     public_tokenizers.path("byte_bpe_50k.json"), limit=512)


def op9_exact_topk(spark, sf_dir):
    return topk_search.exact_top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op10_license_scan(spark, sf_dir):
    return license_scan.license_scan(read(spark, sf_dir, "documents"))


def op11_periodic_runs(spark, sf_dir):
    """Runs of all documents, some of which get words that repeat."""
    return periodic_runs.digests(periodic_runs.periodic_runs(periodic_runs.planted(read(spark, sf_dir, "documents"))))


def op12_hard_negatives(spark, sf_dir):
    """Hard negatives of all anchors; some rows get the next label first."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0)


def op13_chat_tree(spark, sf_dir):
    """All conversations, and one (-1) whose texts are control strings, read back from the tree's output."""
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    bad = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", bad), (-1, 1, "assistant", bad)], rows.schema)
    tree = chat_tree.chat_tree(rows.unionByName(more), public_tokenizers.path("byte_bpe_50k.json"))
    return chat_tree.read_back(tree.conversations)


QUERIES = {f.__name__: f for f in (
    op1_pii_sanitisation, op2_toxic_segments, op3_minmax_dedup, op4_bpe_codec, op5_rp_forest, op6_packing,
    op7_url_filter, op8_token_counts, op9_exact_topk, op10_license_scan, op11_periodic_runs,
    op12_hard_negatives, op13_chat_tree)}

_N = "CAST('0x' || substr(md5({}), 1, 6) AS BIGINT)"

URL_SQL = rf"""
WITH p AS (
  SELECT page_id, url, (DATE '2024-01-01' + CAST({_N.format("coalesce(url, '')")} % 365 AS INTEGER)) AS fetch_date,
         translate(coalesce(url, ''), '{url_filter._UPPER}', '{url_filter._LOWER}') AS low FROM pages),
c AS (
  SELECT page_id, url, fetch_date, regexp_extract(low, '{url_filter.PATH}', 1) AS path,
         regexp_replace(regexp_replace(regexp_extract(low, '{url_filter.HOST}', 1), '\.+$', ''), '^www\.', '') AS host
  FROM p),
h AS (SELECT DISTINCT host, {_N.format("host")} AS n FROM c WHERE host <> ''),
a AS (SELECT DISTINCT above, {_N.format("above")} AS n FROM (
        SELECT regexp_replace(host, '^[^.]*\.', '') AS above FROM h) WHERE regexp_matches(above, '\..*\.')),
q AS (SELECT DISTINCT host || '/' || step AS path, {_N.format("host || '/' || step")} AS n FROM (
        SELECT host, [s for s in string_split(path, '/') if s <> ''][1] AS step FROM c)
      WHERE host <> '' AND step IS NOT NULL AND NOT contains(step, ' ')),
e AS (
  SELECT host AS pattern, 'block' AS kind, TRUE AS added, DATE '2024-01-01' + CAST(n % 200 AS INTEGER) AS d FROM h WHERE n % 3 = 0
  UNION ALL SELECT host, 'block', FALSE, DATE '2024-01-01' + CAST(n % 200 + 60 AS INTEGER) FROM h WHERE n % 6 = 0
  UNION ALL SELECT host, 'block', TRUE, DATE '2024-01-01' + CAST(n % 200 + 120 AS INTEGER) FROM h WHERE n % 30 = 0
  UNION ALL SELECT host, 'allow', TRUE, DATE '2024-01-01' + CAST(n % 100 + 50 AS INTEGER) FROM h WHERE n % 7 = 0
  UNION ALL SELECT above, 'block', TRUE, DATE '2024-01-01' + CAST(n % 150 AS INTEGER) FROM a WHERE n % 4 = 1
  UNION ALL SELECT path, CASE n % 5 WHEN 0 THEN 'block' ELSE 'allow' END, TRUE,
    DATE '2024-01-01' + CAST(n % 300 AS INTEGER) FROM q WHERE n % 5 < 2),
daily AS (SELECT pattern, kind, d, bool_and(added) AS added FROM e GROUP BY ALL),
iv AS (SELECT * FROM (SELECT pattern, kind, added, d AS valid_from,
         lead(d) OVER (PARTITION BY pattern, kind ORDER BY d) AS valid_to FROM daily) WHERE added),
u AS (SELECT DISTINCT url, fetch_date, host, path FROM c WHERE url IS NOT NULL AND host <> ''),
u2 AS (SELECT url, fetch_date, host, string_split(host, '.') AS labels,
         [s for s in string_split(path, '/') if s <> ''] AS steps FROM u),
k AS (
  SELECT DISTINCT url, fetch_date, unnest(list_concat(
    [array_to_string(list_slice(labels, i, len(labels)), '.')
      for i in range(1, len(labels) + 1)],
    [host || '/' || array_to_string(list_slice(steps, 1, i), '/') for i in range(1, len(steps) + 1)])) AS key
  FROM u2),
v AS (
  SELECT k.url, k.fetch_date, count(*) AS n_active,
         max({{'n': length(pattern), 'allow': CAST(kind = 'allow' AS INTEGER), 'pattern': pattern}}) AS top
  FROM k JOIN iv ON k.key = iv.pattern AND valid_from <= k.fetch_date AND (valid_to IS NULL OR k.fetch_date < valid_to)
  GROUP BY ALL)
SELECT c.page_id, c.url, c.fetch_date, c.host, coalesce(v.top.allow = 0, FALSE) AS blocked, v.top.pattern AS rule,
       CASE v.top.allow WHEN 1 THEN 'allow' WHEN 0 THEN 'block' END AS rule_kind,
       CAST(coalesce(v.n_active, 0) AS BIGINT) AS n_active
FROM c LEFT JOIN v ON c.url = v.url AND c.fetch_date = v.fetch_date"""

TOPK_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND vec_id IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum([q.x[i] * c.x[i] for i in range(1, len(q.x) + 1)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5"""

NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND vec_id IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(list_sum([a.x[i] * c.x[i] for i in range(1, len(a.x) + 1)]) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS n
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(n AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE n <= 3"""

ORACLE_SQL = {
    "op7_url_filter": URL_SQL,
    "op9_exact_topk": TOPK_SQL,
    "op10_license_scan": license_scan.oracle_sql(),
    "op12_hard_negatives": NEGATIVES_SQL,
}
