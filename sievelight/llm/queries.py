"""The registered queries of this package: one per operator, over its whole table, and the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sievelight.llm import language, line_dedup, media, merkle, mixing, ngram_jaccard, packing, personal_data, secret_scan, templates, token_alignment, url_filter, vector_codes

QUERIES, ORACLES = {}, {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


@query
def op1_ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_jaccard.near_duplicates(_documents(spark, sf))


@query
def op2_merkle_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.compare_edits(_documents(spark, sf))


@query
def op3_webp_media(spark: SparkSession, sf: str) -> DataFrame:
    stored = media.to_media(_documents(spark, sf), keep=["doc_id"])
    read = media.read_media(stored.select(F.struct("row.doc_id", "n_bytes").alias("row"), "media"))
    size = F.octet_length("samples")
    return read.select(
        "row.doc_id", "row.n_bytes", size.cast("long").alias("payload_bytes"), F.sha2("samples", 256).alias("payload_sha256"),
        F.crc32(F.substring("samples", size - 63, F.lit(64))).alias("tail_crc32"), F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"), "feature")


@query
def op4_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(_documents(spark, sf), keep=["doc_id"]).select(
        "row.doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "certified")


@query
def op5_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    found = personal_data.spans(_documents(spark, sf))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(F.array_join("base", ","), 256).alias("base_sha256"),
        F.array_join("spans", ",").alias("spans"))


@query
def op6_html_templates(spark: SparkSession, sf: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    return templates.extract(pages, keep=["page_id", "url"]).select(
        "row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op7_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return language.identify(_documents(spark, sf), keep=["doc_id"]).select(
        "row.doc_id", language.is_held_out("row.doc_id").alias("held_out"), "lang_pred", "score")


@query
def op8_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return line_dedup.drop_lines(_documents(spark, sf)).select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op9_source_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf)).select(
        "row.doc_id", "size", "source_size", "target", "taken", F.size("shards").alias("n_shards"))


@query
def op11_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    return vector_codes.compress(spark.read.parquet(f"{sf}/embeddings.parquet")).select(
        "row.vec_id", "code", "error", "label_error", "codebooks_sha256")


@query
def op12_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secret_scan.scan(_documents(spark, sf), keep=["doc_id"]).select(
        "row.doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.array_join("base", ","), 256).alias("base_sha256"),
        F.array_join("spans", ",").alias("spans"))


@query
def op13_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return token_alignment.align(_documents(spark, sf), keep=["doc_id"]).select(
        "row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


#: The rules that the query judges by.
RULES = [
    url_filter.Rule("com", "/en/", "block"), url_filter.Rule("example.com", "/en/7", "allow"),
    url_filter.Rule("net", "/de/", "allow"), url_filter.Rule("example.net", "/de/8", "block"),
    url_filter.Rule("org", "/es/", "block"),
]


@query
def op10_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.judge(spark.read.parquet(f"{sf}/pages.parquet"), RULES).select("row.page_id", "host", "path", "rule", "verdict")


_RULE_ROWS = ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in RULES)
ORACLES["op10_url_filter"] = f"""
WITH r(rh, rp, v) AS (VALUES {_RULE_ROWS}),
a AS (SELECT row_number() OVER () AS n, page_id,
  CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT n, page_id, rest, regexp_extract(rest, '^[^/?#]*') AS h FROM a),
c AS (SELECT n, page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM b),
m AS (SELECT n, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(v, length(rh || rp)) AS v FROM c, r
  WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY n)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM c LEFT JOIN m USING (n)"""

# White space is stripped and A-Z lower-cased as in the operator.
_KEY = r"""translate(trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""
ORACLES["op8_line_dedup"] = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, r, unnest(ls) AS l, generate_subscripts(ls, 1) AS i FROM d),
k AS (SELECT doc_id, r, i, l, {_KEY} AS k FROM l),
f AS (SELECT k FROM k WHERE k <> '' GROUP BY k HAVING count(DISTINCT r) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (f.k IS NOT NULL) AS n_dropped,
  sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (f.k IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.k = f.k GROUP BY doc_id, r"""


def _lloyd_sql() -> str:
    """Rounds unrolled: assignments ``a{r}`` of all parts to the entries ``c{r}``, which start as those of the smallest ids."""
    nearest = """SELECT vec_id, p, arg_min(e, d * 100 + e) AS e, min(d) AS d FROM (
  SELECT x.vec_id, x.p, c.e, list_sum(list_transform(range(1, len(c.v) + 1), lambda i: (x.v[i] - c.v[i]) * (x.v[i] - c.v[i])))::BIGINT AS d
  FROM x JOIN c{r} c ON x.p = c.p) GROUP BY vec_id, p"""
    steps = []
    for r in range(vector_codes.ROUNDS):
        steps.append(f"a{r} AS MATERIALIZED ({nearest.format(r=r)})")
        steps.append(f"""m{r} AS MATERIALIZED (SELECT p, e, i, floor_div(sum(v), count(*)) AS v FROM (
  SELECT a.p, a.e, generate_subscripts(x.v, 1) AS i, unnest(x.v) AS v FROM a{r} a JOIN x ON a.vec_id = x.vec_id AND a.p = x.p) GROUP BY p, e, i),
c{r + 1} AS MATERIALIZED (SELECT c.p, c.e, coalesce(n.v, c.v) AS v FROM c{r} c
  LEFT JOIN (SELECT p, e, list(v ORDER BY i) AS v FROM m{r} GROUP BY p, e) n ON c.p = n.p AND c.e = n.e)""")
    last, parts = vector_codes.ROUNDS, vector_codes.PARTS
    steps.append(f"z AS MATERIALIZED ({nearest.format(r=last)})")
    return f"""
WITH k AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda t: floor(t::DOUBLE * {vector_codes.SCALE})::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda t: t IS NULL OR NOT isfinite(t))) = 0),
x AS MATERIALIZED (SELECT vec_id, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS v
  FROM k, (SELECT unnest(range({parts})) AS p)),
s AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k ORDER BY vec_id LIMIT {vector_codes.ENTRIES}),
c0 AS MATERIALIZED (SELECT x.p, s.e, x.v FROM x JOIN s ON x.vec_id = s.vec_id),
{", ".join(steps)},
h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{last}),
r AS (SELECT vec_id, string_agg(printf('%02x', e::INTEGER), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM z GROUP BY vec_id)
SELECT r.vec_id, code, error, sum(error) OVER (PARTITION BY k.label)::BIGINT AS label_error, codebooks_sha256
FROM r JOIN k ON r.vec_id = k.vec_id, h""".replace("floor_div(sum(v), count(*))", "((sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT")


ORACLES["op11_vector_codes"] = _lloyd_sql()
