"""Queries whose inputs vary as the tables' rows do: each is beside SQL that computes the operator's rule over the same rows, from names, places, dates and texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from veriloom.functions import claims as C
from veriloom.operators import coverage, fidelity, health
from veriloom.plans.queries import query
from veriloom.sources import sinks


@query(r"""
WITH p AS (SELECT page_id, html || '<a href="' || url || '">x</a> [y](' || replace(url, 'http', 'HTTP') || ')' AS raw, url FROM pages),
d AS (SELECT doc_id AS page_id, coalesce(text, '') || CASE length(text) % 4 WHEN 0 THEN upper(url) WHEN 1 THEN regexp_extract(url, '^https?://(?:www\.)?([^/]+)', 1) WHEN 2 THEN regexp_replace(url, '^https?://[^.]+\.', '') ELSE '' END AS body FROM documents JOIN pages ON page_id = doc_id),
h AS (SELECT DISTINCT page_id, lower(regexp_extract(unnest(regexp_extract_all(raw, 'href="([^"]+)"', 1)), '^https?://([^/]+)', 1)) AS host FROM p)
SELECT page_id, host FROM h LEFT JOIN d USING (page_id) WHERE host <> '' AND NOT coalesce(contains(lower(body), host) OR contains(lower(body), regexp_replace(host, '^www\.', '')), false)""")
def hosts_of_pages(t):
    """Hosts of the links that pages have, against documents that name some of them in capitals, bare, in part or not at all."""
    c = F.col
    p = t("pages").select("page_id", F.concat("html", F.lit('<a href="'), "url", F.lit('">x</a> [y]('), F.replace("url", F.lit("http"), F.lit("HTTP")), F.lit(")")).alias("raw"), "url")
    n = F.length("text") % 4
    said = F.when(n == 0, F.upper("url")).when(n == 1, F.regexp_extract("url", r"^https?://(?:www\.)?([^/]+)", 1)).when(n == 2, F.regexp_replace("url", r"^https?://[^.]+\.", "")).otherwise("")
    d = t("documents").join(p.select(c("page_id").alias("doc_id"), "url"), "doc_id").select(c("doc_id").alias("page_id"), F.concat(F.coalesce("text", F.lit("")), said).alias("body"))
    return fidelity.missing_hosts(p.select("page_id", "raw"), d, "page_id").withColumnRenamed("value", "host")


@query(r"""
WITH c AS (SELECT c_nationkey AS slug, c_custkey AS k, (c_custkey % 70 + 1) || ' ' || c_mktsegment || ' Road' AS a, c_acctbal AS b FROM customer),
e AS (SELECT slug, CASE k % 3 WHEN 0 THEN '' WHEN 1 THEN '1' ELSE 'Hall ' END || CASE WHEN k % 2 = 0 THEN a || ' Town' ELSE replace(a, ' ', '') || '  Town' END AS body FROM c WHERE b < 2000),
said AS (SELECT DISTINCT slug, lower(a) AS value FROM c)
SELECT slug, value FROM said WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.slug = said.slug AND ((NOT contains(replace(value, ' ', ''), ' ') AND length(replace(value, ' ', '')) >= 12 AND regexp_matches(lower(replace(body, ' ', '')), '(^|[^0-9])' || replace(value, ' ', '')))
OR regexp_matches(lower(body), '(^|[^0-9])' || value || '([^a-z]|$)')))""")
def addresses_of_customers(t):
    """Postal addresses of a nation's customers, against evidence that states some as they are, run together or as part of a longer number."""
    k = F.col("c_custkey")
    c = t("customer").select(F.col("c_nationkey").alias("slug"), k, F.concat((k % 70 + 1).cast("string"), F.lit(" "), "c_mktsegment", F.lit(" Road")).alias("a"), "c_acctbal")
    stated = F.when(k % 2 == 0, F.concat("a", F.lit(" Town"))).otherwise(F.concat(F.replace("a", F.lit(" "), F.lit("")), F.lit("  Town")))
    e = c.where("c_acctbal < 2000").select("slug", F.concat(F.when(k % 3 == 0, "").when(k % 3 == 1, "1").otherwise("Hall "), stated).alias("body"))
    return fidelity.missing_addresses(c.select("slug", F.concat(F.lit("Write to "), "a", F.lit(".")).alias("raw")), e)


_FILE = "lower(c_mktsegment) || c_nationkey || CASE WHEN c_acctbal < 0 THEN '-packet' WHEN c_acctbal < 3000 THEN '-packet-es' WHEN c_acctbal < 6000 THEN '-packet-' || lower(left(c_name, 4)) || c_custkey % 5 WHEN c_acctbal < 9000 THEN '-packet-a-packet-b' ELSE '-notes' END || '.txt'"


@query(rf"""
WITH f AS (SELECT DISTINCT 'p/' || {_FILE} AS path FROM customer), b AS (SELECT path, regexp_extract(path, '([^/]+)\.txt$', 1) AS base FROM f),
s AS (SELECT path, regexp_extract(base, '^(.+?)-packet(?:-.+)?$', 1) AS slug, coalesce(nullif(regexp_extract(base, '-packet-(.+)$', 1), ''), 'main') AS kind FROM b)
SELECT 'en' AS lang, * FROM s WHERE slug <> '' AND kind <> 'es' UNION ALL SELECT 'es', * FROM s WHERE slug <> '' AND kind = 'es'""")
def packet_files(t):
    """Packet files of many names by slug and kind, in either language."""
    f = t("customer").select(F.expr(f"'p/' || {_FILE}").alias("path")).distinct()
    return health.packet_set(f, "en").withColumn("lang", F.lit("en")).unionByName(health.packet_set(f, "es").withColumn("lang", F.lit("es")))


@query("""
WITH l AS (SELECT c_custkey AS slug, max(CAST(o_orderdate AS DATE)) AS d FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1),
a AS (SELECT date_diff('day', max(d), DATE '2001-08-20') AS newest, min(d) AS oldest, count(*) FILTER (date_diff('day', d, DATE '2001-08-20') > 25) AS stale FROM l),
s AS (SELECT c_custkey, c_acctbal < 0 AS archival, 'k' || c_custkey AS stem, CAST(date_trunc('day', DATE '2000-01-01' + CAST(abs(c_acctbal) / 17 AS INT)) AS DATE) AS made FROM customer),
r AS (SELECT DISTINCT 'k' || o_custkey AS stem FROM orders WHERE o_totalprice > 400000)
SELECT 'severe' AS severity, 'no pass recorded for ' || newest || ' days' AS message FROM a WHERE newest > 2
UNION ALL SELECT 'note', stale || ' not reviewed within a lap, oldest at ' || oldest FROM a WHERE stale > 0
UNION ALL SELECT 'note', 'no recipe for ' || stem FROM s WHERE NOT archival AND stem NOT IN (SELECT stem FROM r)
UNION ALL SELECT 'note', 'old supplement ' || stem FROM s WHERE NOT archival AND date_diff('day', made, DATE '2001-08-20') > {days}
UNION ALL SELECT 'severe', count(*) || ' sources rest on an account fault' FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' HAVING count(*) > 0""".format(days=health.SUPPLEMENT_DAYS))
def rotation_of_customers(t):
    """Everything that is wrong with a rotation over all customers, whose passes are their orders and whose cursor is one of them."""
    c = F.col
    o, k = t("orders"), t("customer")
    last = k.join(o, c("c_custkey") == c("o_custkey")).groupBy(c("c_custkey").cast("string").alias("slug")).agg(F.max(F.to_date("o_orderdate")).cast("string").alias("date"))
    made = F.date_add(F.lit("2000-01-01").cast("date"), F.rint(F.abs("c_acctbal") / 17).cast("int")).cast("string")
    head = F.concat(F.when(c("c_acctbal") < 0, "CLASS: archival\n").otherwise("Captured.\n"), F.when(c("c_custkey") % 2 == 0, "ASSEMBLED: ").otherwise("Assembly date "), made, F.lit("\n"))
    stem = F.concat(F.lit("k"), c("c_custkey").cast("string"))
    recipes = o.where("o_totalprice > 400000").select(F.concat(F.lit("k"), c("o_custkey").cast("string")).alias("stem"))
    detail = F.when(c("o_orderpriority") == "1-URGENT", "submit-401").when(c("o_orderpriority") == "2-HIGH", "404").otherwise(c("o_orderpriority"))
    led = o.select(c("o_orderkey").cast("string").alias("url"), detail.alias("last_detail"), F.when(c("o_orderstatus") == "F", "FAILED").otherwise("SKIPPED").alias("last_result"))
    slugs = k.select(c("c_custkey").cast("string").alias("slug"))
    return health.report(last, F.lit("2001-08-20").cast("date"), slugs, "7", True, k.select(stem.alias("path"), stem.alias("stem"), head.alias("head")), recipes, led, list(health.ACCOUNT_FAULTS))


@query("""
WITH d AS (SELECT doc_id, coalesce(source, '') AS s, regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}') AS bad, length(text) % 3 = 0 AS free FROM documents),
k AS (SELECT s, doc_id, coalesce(bad, false) AS bad, coalesce(free, false) AS free FROM d)
SELECT s AS source, count(*) AS pages, count(*) FILTER (NOT bad) AS clean, count(*) FILTER (bad AND free) AS soft, count(*) FILTER (bad AND NOT free) AS hard FROM k GROUP BY 1
UNION ALL SELECT 'all', count(*), count(*) FILTER (NOT bad), count(*) FILTER (bad AND free), count(*) FILTER (bad AND NOT free) FROM k""")
def check_totals(t):
    """How many documents of each source, and of all, state an address by e-mail, which some may."""
    d = t("documents").select("doc_id", F.coalesce("source", F.lit("")).alias("source"), "text")
    bad = d.where(F.size(C.emails("text")) > 0).select("doc_id")
    free = d.where("length(text) % 3 = 0").select("doc_id")
    whole = coverage.run_totals(d, bad, free, "doc_id").select(F.lit("all").alias("source"), "pages", "clean", "soft", "hard")
    judged = d.select("doc_id", "source").join(coverage.soft_or_hard(bad, free, "doc_id"), "doc_id", "left")
    by = judged.groupBy("source").agg(F.count("*").alias("pages"), F.count_if(F.col("soft").isNull()).alias("clean"), F.count_if("soft").alias("soft"), F.count_if(~F.col("soft")).alias("hard"))
    return by.unionByName(whole)


@query("""
WITH s AS (SELECT conv_id, turn, coalesce(text, '') AS x, role, 'c' || conv_id || ':law:' || turn // 2 AS id FROM conversations),
l AS (SELECT id, 'c' || conv_id AS state, length(x) % 2 = 0 AS in_scope, x AS text, row_number() OVER (PARTITION BY id ORDER BY turn DESC) AS r FROM s)
SELECT id, state, in_scope, left(sha256(text), 16) AS hash FROM l WHERE r = 1""")
def index_of_turns(t):
    """An index of all turns as JSON lines, among blank ones; of lines that repeat an id the last one counts, whatever characters its text has."""
    c = F.col
    x = F.coalesce("text", F.lit(""))
    # A line's order is that of its text: the turn comes first in it.
    line = F.to_json(F.struct(F.lpad(c("turn").cast("string"), 9, "0").alias("at"), F.concat(F.lit("c"), c("conv_id").cast("string"), F.lit(":law:"), F.floor(c("turn") / 2).cast("string")).alias("id"), F.concat(F.lit("c"), c("conv_id").cast("string")).alias("state"), (F.length(x) % 2 == 0).alias("in_scope"), x.alias("text")))
    lines = t("conversations").select(F.explode(F.array(line, F.repeat(F.lit(" "), (c("turn") % 4).cast("int")))).alias("value"))
    return fidelity.quote_index(lines).select("id", "state", "in_scope", F.substring(F.sha2("text", 256), 1, 16).alias("hash"))


@query(r"""
WITH p AS (SELECT page_id, regexp_replace(url, '^https?://[^/]+/', '') AS path FROM pages),
q AS (SELECT DISTINCT regexp_replace(path, '/?([?#].*)?$', '') || CASE length(path) % 3 WHEN 0 THEN '.html' WHEN 1 THEN '/index.html' ELSE '.htm.html' END AS path FROM p)
SELECT line FROM (SELECT '/' || path || ' /' || replace(path || '$', 'index.html$', '') || ' 301' AS line FROM q WHERE path LIKE '%/index.html'
UNION ALL SELECT '/' || path || ' /' || left(path, length(path) - 5) || '/ 301' FROM q WHERE path NOT LIKE '%/index.html'
UNION ALL SELECT '/' || left(path, length(path) - 5) || ' /' || left(path, length(path) - 5) || '/ 301' FROM q WHERE path NOT LIKE '%/index.html')""")
def redirects_of_pages(t):
    """Redirections of every other address of pages at the paths that their addresses have."""
    path = F.regexp_replace("url", "^https?://[^/]+/", "")
    end = F.when(F.length(path) % 3 == 0, ".html").when(F.length(path) % 3 == 1, "/index.html").otherwise(".htm.html")
    return sinks.redirects(t("pages").select(F.concat(F.regexp_replace(path, "/?([?#].*)?$", ""), end).alias("path")).distinct())
