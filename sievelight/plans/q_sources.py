"""Queries for landing, pages, filters (operators A1-A15)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sievelight.functions.text import pin
from sievelight.plans.common import SQL_K, element, k_of, run_folder, struct, table
from sievelight.session import cut_lineage
from sievelight.sources import filters, landing, pages as pg

QUERIES, ORACLES = {}, {}


def query(oracle: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return fn

    return add


_BAD = ["", "[1,2]", "not json", "\"text\"", "null"]


def _landed(spark: SparkSession, sf: str) -> DataFrame:
    """Events as landed payload text, some of it no object."""
    df = table(spark, sf, "events")
    text = F.when(k_of() < 90, F.col("props")).otherwise(element(_BAD, k_of()))
    return landing.with_payload(df.select("event_id", "event_type", text.alias("payload")))


@query(f"""
WITH e AS (SELECT event_type, {SQL_K} AS k FROM events)
SELECT event_type, CASE WHEN k < 90 THEN 'kept' WHEN k % 5 IN (1, 3, 4) THEN 'payload_not_object'
       ELSE 'unparseable' END AS outcome, count(*) AS n
FROM e GROUP BY ALL""")
def landing_split(spark, sf):
    good, bad = landing.split_payloads(_landed(spark, sf))
    rows = good.select("event_type", F.lit("kept").alias("outcome")).unionByName(
        bad.select("event_type", F.col("reason").alias("outcome")))
    return rows.groupBy("event_type", "outcome").agg(F.count("*").alias("n"))


@query("""
SELECT source, count(*) AS n, CAST(sum(strlen(text)) AS BIGINT) AS n_bytes
FROM documents WHERE strlen(text) <= 20000 GROUP BY source""")
def body_cap(spark, sf):
    docs = table(spark, sf, "documents").withColumn("body", F.col("text").cast("binary"))
    kept = landing.cap_bodies(docs, limit=20000)
    return kept.groupBy("source").agg(F.count("*").alias("n"), F.sum(F.octet_length("body")).alias("n_bytes"))


def _run_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as poll runs, their line numbers as pages; each line is an item of its page."""
    li = table(spark, sf, "lineitem")
    grouped = li.groupBy("l_orderkey", "l_linenumber").agg(
        F.count("*").alias("n_items"),
        F.array_sort(F.collect_list(struct(part=F.col("l_partkey"), qty=F.col("l_quantity").cast("int")))).alias("items"),
    )
    bad = (F.col("l_orderkey") % 7 == 3) & (F.col("l_linenumber") == 4)
    return grouped.select(
        F.col("l_orderkey").alias("run_id"), F.lit("devin").alias("provider"),
        F.col("l_linenumber").alias("page_no"), "n_items",
        F.when(bad, F.lit(500)).otherwise(F.lit(200)).alias("status"),
        F.concat(F.lit("https://api.example.com/v1/sessions?after=c"), F.col("l_linenumber").cast("string")).alias("url"),
        F.to_json(struct(
            items=F.col("items"), has_next_page=F.col("l_linenumber") < 7,
            end_cursor=F.concat(F.lit("c"), (F.col("l_linenumber") + 1).cast("string")))).alias("body"),
    )


@query("""
WITH p AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL),
bad AS (SELECT DISTINCT l_orderkey FROM p WHERE l_orderkey % 7 = 3 AND l_linenumber = 4)
SELECT l.l_orderkey AS run_id, l.l_linenumber AS page_no, CAST(count(*) AS BIGINT) AS n_items,
       CAST(sum(l_partkey) AS BIGINT) AS part_sum, CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS qty_sum
FROM lineitem l LEFT JOIN bad USING (l_orderkey) WHERE bad.l_orderkey IS NULL GROUP BY ALL""")
def gated_page_items(spark, sf):
    ok, _ = pg.gate_runs(_run_pages(spark, sf))
    items = pg.unwrap_pages(ok)
    v = F.col("payload_v")
    return items.groupBy("run_id", "page_no").agg(
        F.count("*").alias("n_items"), F.sum(F.try_variant_get(v, "$.part", "bigint")).alias("part_sum"),
        F.sum(F.try_variant_get(v, "$.qty", "bigint")).alias("qty_sum"))


@query("""
WITH p AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
SELECT l_orderkey AS run_id, 'unexpected_status_expected_200' AS reason, min(l_linenumber) AS page_no
FROM p WHERE l_orderkey % 7 = 3 AND l_linenumber = 4 GROUP BY l_orderkey""")
def rejected_runs(spark, sf):
    return pg.gate_runs(_run_pages(spark, sf))[1].select("run_id", "reason", "page_no")


@query("""
WITH p AS (SELECT l_orderkey // 2 AS run_id, (l_linenumber - 1) * (1 + (l_orderkey // 2) % 3 * 40) + 8 * (l_orderkey % 2) AS page_no,
                  count(*) AS items, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS bytes FROM lineitem GROUP BY ALL),
w AS (SELECT *, row_number() OVER r AS rk, sum(bytes) OVER r AS tb, sum(items) OVER r AS ti FROM p
      WINDOW r AS (PARTITION BY run_id ORDER BY page_no)),
b AS (SELECT *, CASE WHEN rk > 5 THEN 'max_pages_exceeded' WHEN bytes > 90 THEN 'oversized_body'
        WHEN tb > 150 THEN 'aggregate_bytes_exceeded' WHEN ti > 6 THEN 'aggregate_items_exceeded' END AS reason FROM w)
SELECT run_id, min(page_no) AS page_no, arg_min(reason, page_no) AS reason FROM b
WHERE reason IS NOT NULL GROUP BY run_id""")
def run_caps(spark, sf):
    """Runs of two orders: page numbers from zero, with gaps of 1, 41 or 81."""
    run = F.floor(F.col("l_orderkey") / 2)
    page = (F.col("l_linenumber") - 1) * (1 + run % 3 * 40) + 8 * (F.col("l_orderkey") % 2)
    p = table(spark, sf, "lineitem").groupBy(run.alias("run_id"), page.alias("page_no")).agg(
        F.count("*").alias("n_items"), F.sum(F.col("l_quantity").cast("bigint")).alias("n_bytes"))
    return pg.audit_run_caps(p, max_pages=5, max_items=6, max_bytes=150, max_page_bytes=90)


@query("""
WITH p AS (SELECT DISTINCT l_orderkey AS run_id, l_linenumber AS page_no FROM lineitem),
j AS (SELECT a.run_id, a.page_no, b.page_no AS nxt FROM p a LEFT JOIN p b ON a.run_id = b.run_id
      AND b.page_no = a.page_no + 1)
SELECT run_id, page_no, 'missing_page' AS problem FROM j WHERE page_no < 7 AND nxt IS NULL""")
def page_token_chain(spark, sf):
    return pg.check_page_chain(_run_pages(spark, sf), "token", "after", "$.end_cursor", "$.has_next_page")


@query("""
WITH p AS (SELECT l_orderkey AS run_id, l_linenumber AS page_no, count(*) AS n FROM lineitem GROUP BY ALL),
j AS (SELECT a.*, b.page_no AS nxt, a.page_no * 2 + CASE WHEN a.run_id % 11 = 0 THEN 1 ELSE 0 END AS off FROM p a
      LEFT JOIN p b ON a.run_id = b.run_id AND b.page_no = a.page_no + 1),
w AS (SELECT run_id, page_no, CASE WHEN n < 2 AND nxt IS NOT NULL THEN 'page_after_end'
   WHEN n >= 2 AND nxt IS NULL THEN 'missing_page' END AS problem FROM j)
SELECT * FROM w WHERE problem IS NOT NULL""")
def page_offset_chain(spark, sf):
    p = table(spark, sf, "lineitem").groupBy(
        F.col("l_orderkey").alias("run_id"), F.col("l_linenumber").alias("page_no")).agg(F.count("*").alias("n_items"))
    p = p.withColumn("url", F.concat(
        F.lit("https://api.example.com/t?limit=2&offset="),
        (F.col("page_no") * 2 + F.when(F.col("run_id") % 11 == 0, 1).otherwise(0)).cast("string")))
    return pg.check_page_chain(p, "offset", "offset", limit=2)


def _graphql_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Users as query runs, their event days as pages."""
    e = table(spark, sf, "events").withColumn("day", F.dayofmonth("ts"))
    grouped = e.groupBy("user_id", "day").agg(
        F.array_sort(F.collect_list(struct(id=F.col("event_id"), title=F.col("event_type")))).alias("nodes"))
    r = F.col("user_id") * 31 + F.col("day")
    limited, broken = r % 97 == 5, r % 89 == 7
    body = F.when(limited, F.lit('{"errors":[{"code":"RATELIMITED"}]}')).when(
        broken, F.lit('{"errors":[{"code":"X"}],"data":{}}')).otherwise(
        F.to_json(struct(data=struct(issues=struct(nodes=F.col("nodes"))))))
    return grouped.select(
        F.col("user_id").alias("run_id"), F.col("day").alias("page_no"),
        F.when(limited, F.lit(400)).otherwise(F.lit(200)).alias("status"), body.alias("body"))


_GQL = """
WITH p AS (SELECT user_id AS run_id, CAST(day(ts) AS INTEGER) AS page_no, count(*) AS n, sum(event_id) AS s FROM events GROUP BY ALL),
w AS (SELECT *, CASE WHEN (run_id * 31 + page_no) % 97 = 5 THEN 'rate_limited'
                     WHEN (run_id * 31 + page_no) % 89 = 7 THEN 'graphql_errors' END AS reason FROM p),
rej AS (SELECT run_id, arg_min(reason, page_no) AS reason, min(page_no) AS page_no FROM w WHERE reason IS NOT NULL GROUP BY 1)
"""


@query(_GQL + """SELECT w.run_id, CAST(sum(n) AS BIGINT) AS n_nodes, CAST(sum(s) AS BIGINT) AS id_sum
FROM w LEFT JOIN rej USING (run_id) WHERE rej.run_id IS NULL GROUP BY w.run_id""")
def graphql_nodes(spark, sf):
    nodes, _ = pg.unwrap_graphql(_graphql_pages(spark, sf), "$.data.issues.nodes")
    return nodes.groupBy("run_id").agg(
        F.count("*").alias("n_nodes"), F.sum(F.try_variant_get("payload_v", "$.id", "bigint")).alias("id_sum"))


@query(_GQL + "SELECT * FROM rej")
def graphql_rejected_runs(spark, sf):
    return pg.unwrap_graphql(_graphql_pages(spark, sf), "$.data.issues.nodes")[1].select("run_id", "reason", "page_no")


@query("""
WITH p AS (SELECT l_orderkey AS run_id, l_linenumber AS page_no, count(*) AS n FROM lineitem GROUP BY ALL),
c AS (SELECT run_id, page_no, 'c' || CAST(n AS VARCHAR) AS cur FROM p WHERE page_no < 6),
f AS (SELECT run_id, page_no, row_number() OVER (PARTITION BY run_id, cur ORDER BY page_no) AS rn FROM c)
SELECT run_id, min(page_no) AS page_no, 'circular_cursor' AS problem FROM f WHERE rn > 1 GROUP BY run_id""")
def relay_cycles(spark, sf):
    p = table(spark, sf, "lineitem").groupBy(
        F.col("l_orderkey").alias("run_id"), F.col("l_linenumber").alias("page_no")).agg(F.count("*").alias("n"))
    body = F.to_json(struct(data=struct(issues=struct(pageInfo=struct(
        hasNextPage=F.col("page_no") < 6, endCursor=F.concat(F.lit("c"), F.col("n").cast("string")))))))
    rows = pin(pin(p, {"page_v": F.try_parse_json(body)}), {
        "end_cursor": pg.relay_cursor(F.col("page_v"), "$.data.issues.pageInfo")})
    return pg.check_relay_chain(rows.select("run_id", "page_no", "end_cursor"))


@query(f"""
WITH e AS (SELECT event_type, {SQL_K} AS k FROM events)
SELECT event_type, CASE WHEN k % 4 = 1 THEN 'http_error' WHEN k % 4 = 2 THEN 'non_object_body'
   WHEN k % 4 = 3 THEN 'unparseable_body' ELSE 'document' END AS outcome, count(*) AS n FROM e GROUP BY ALL""")
def document_responses(spark, sf):
    k = k_of()
    body = F.when(k % 4 == 2, F.lit("[1]")).when(k % 4 == 3, F.lit("{broken")).otherwise(F.col("props"))
    responses = table(spark, sf, "events").select(
        "event_type", F.when(k % 4 == 1, F.lit(404)).otherwise(F.lit(200)).alias("status"),
        body.cast("binary").alias("body"))
    docs, rejects = landing.read_documents(responses)
    rows = docs.select("event_type", F.lit("document").alias("outcome")).unionByName(
        rejects.select("event_type", F.col("reason").alias("outcome")))
    return rows.groupBy("event_type", "outcome").agg(F.count("*").alias("n"))


_KIND, _SQL_KIND = r"kind=([^/]+)/", "event_type || '-' || event_id % 16"


def _written(spark: SparkSession, sf: str) -> str:
    """Events as text files, one for some of the events of a type, one line per event, in order."""
    folder = run_folder(spark)
    kind = F.concat_ws("-", "event_type", F.col("event_id") % 16)
    rows = table(spark, sf, "events").select(kind.alias("kind"), F.concat_ws("|", "event_id", F.lit("é"), "props").alias("value"), "event_id")
    rows.repartition("kind").sortWithinPartitions("kind", "event_id").drop("event_id").write.partitionBy("kind").text(folder)
    return folder


@query(f"SELECT {_SQL_KIND} AS kind, sha256(string_agg(event_id || '|é|' || props || chr(10), '' ORDER BY event_id)) AS digest FROM events GROUP BY 1")
def local_files(spark, sf):
    """Whole files as rows, by their content."""
    files = landing.read_files(spark, _written(spark, sf), "*.txt")
    return files.select(F.regexp_extract("path", _KIND, 1).alias("kind"), F.sha2("content", 256).alias("digest"))


@query(f"""
WITH l AS (SELECT {_SQL_KIND} AS kind, event_id || '|é|' || props AS line FROM events)
SELECT kind, count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars, CAST(sum(CAST('0x' || left(md5(line), 12) AS BIGINT)) AS BIGINT) AS digests
FROM l GROUP BY kind""")
def local_file_lines(spark, sf):
    """The same files line by line, in byte ranges that several tasks share."""
    key, folder = "spark.sql.files.maxPartitionBytes", _written(spark, sf)
    before = spark.conf.get(key)
    spark.conf.set(key, "16k")
    try:
        lines = landing.read_file_lines(spark, folder, "*.txt").withColumn("kind", F.regexp_extract("path", _KIND, 1))
        part = F.conv(F.left(F.md5("line"), F.lit(12)), 16, 10).cast("long")
        # Sums of 48-bit numbers pass 2^63 at some 65,000 lines: they are exact decimals, and a bigint as in the SQL while all fit.
        out = cut_lineage(lines.groupBy("kind").agg(
            F.count("*").alias("n_lines"), F.sum(F.char_length("line")).alias("n_chars"),
            F.sum(part.cast("decimal(20,0)")).alias("digests")))
        fits = out.where("digests > 9223372036854775807").isEmpty()
        return out.withColumn("digests", F.col("digests").cast("long")) if fits else out
    finally:
        spark.conf.set(key, before)


@query("""
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(sum(length(text)) AS BIGINT) AS n_chars
FROM conversations GROUP BY conv_id""")
def transcript_lines(spark, sf):
    """Conversations of even id land as one ``{lines: [...]}`` row, the others as one row per line."""
    conv = table(spark, sf, "conversations")
    line = struct(type=F.col("role"), n=F.col("turn"), text=F.col("text"))
    single = conv.where("conv_id % 2 = 1").select("conv_id", F.to_json(line).alias("payload"))
    batch = conv.where("conv_id % 2 = 0").groupBy("conv_id").agg(F.collect_list(line).alias("lines")).select(
        "conv_id", F.to_json(struct(lines=F.col("lines"))).alias("payload"))
    rows = landing.explode_lines(landing.with_payload(single.unionByName(batch)))
    return rows.groupBy("conv_id").agg(
        F.count("*").alias("n_lines"),
        F.sum(F.char_length(F.try_variant_get("payload_v", "$.text", "string"))).alias("n_chars"))


@query("""
WITH h AS (SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)) AS host FROM pages),
r AS (SELECT page_id, CASE WHEN page_id % 5 = 0 THEN 'api.github.com' WHEN page_id % 5 = 1 THEN 'github.com.evil.com'
   WHEN page_id % 5 = 2 THEN 'acme.atlassian.net' WHEN page_id % 5 = 3 THEN 'docs.google.com' ELSE host END AS host FROM h)
SELECT page_id, host AS url_host, CASE WHEN page_id % 5 = 3 THEN 'google_drive'
   WHEN host = 'github.com' OR host LIKE '%.github.com' THEN 'github'
   WHEN host LIKE '%.atlassian.net' THEN 'confluence' END AS route,
   CASE WHEN page_id % 5 = 3 THEN 'doc-0123456789-0123456789-' || CAST(page_id AS VARCHAR) END AS document_id FROM r""")
def url_routes(spark, sf):
    p = table(spark, sf, "pages")
    hosts = ["api.github.com", "github.com.evil.com", "acme.atlassian.net"]
    n = F.col("page_id") % 5
    url = F.when(n < 3, F.regexp_replace("url", "://[^/?#]+", F.concat(F.lit("://"), element(hosts, n)))).when(
        n == 3, F.concat(F.lit("https://docs.google.com/document/d/doc-0123456789-0123456789-"),
                         F.col("page_id").cast("string"), F.lit("/edit?x=1"))).otherwise(F.col("url"))
    return filters.route_by_url(p.select("page_id", url.alias("link")), "link").select(
        "page_id", "url_host", "route", "document_id")


@query("""
SELECT doc_id FROM documents WHERE lang IN ('en', 'de') AND source <> 'src3'
AND (contains(lower(text), 'ing') OR contains(lower(text), 'ung')) AND NOT contains(lower(text), 'token')
AND n_chars >= 200 AND n_chars < 9000""")
def declared_filters(spark, sf):
    spec = filters.FilterSpec(include_keywords=["ing", "ung"], exclude_keywords=["Token"],
                              include_authors=["en", "de"], after=200, before=9000)
    docs = filters.apply_filters(table(spark, sf, "documents"), spec, text="text", author="lang", timestamp="n_chars")
    return filters.apply_filters(docs, filters.FilterSpec(exclude_authors=["src3"]), author="source").select("doc_id")


@query("""
SELECT event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn
FROM events WHERE strlen(props) <= 9) WHERE rn <= 50""")
def source_quota(spark, sf):
    spec = filters.QuotaSpec(max_items_per_pull=50, max_payload_bytes=9)
    return filters.apply_quota(table(spark, sf, "events"), spec, "event_type", ["ts", "event_id"], "props").select(
        "event_id", "event_type")


