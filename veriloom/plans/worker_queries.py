"""Queries of a capture worker's passes, each beside DuckDB SQL: orders are captures asked for, their lines and customers what came of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriloom.functions import text as T
from veriloom.operators import worker
from veriloom.plans.queries import _ENTITIES, _LEDGER, NOW, ledger, query

_STAMP, _SQL_STAMP = "yyyy-MM-dd'T'HHmmss'Z'", "%Y-%m-%dT%H%M%SZ"
_SITE = "https://web.archive.org/web/"


def full_ledger(t) -> DataFrame:
    """The ledger of the log with all its fields."""
    tries = t("events").groupBy(F.col("user_id").cast("string").alias("url")).agg(F.count("*").cast("int").alias("attempts"))
    led = ledger(t).join(tries, "url").withColumn("last_attempt", F.date_format("last_attempt", _STAMP)).withColumn("consecutive_hard_failures", F.col("consecutive_hard_failures").cast("int"))
    said = {"page": F.lit("old"), "last_detail": F.concat(F.lit("was "), F.lower("last_result")), "last_message": F.lit(None).cast("string"), "capture_submitted": F.when(F.col("capture").isNotNull(), F.col("last_attempt"))}
    return led.withColumns(said)


def candidates(t) -> DataFrame:
    return t("customer").select(F.col("c_nationkey").alias("slug"), F.col("c_custkey").cast("string").alias("url"))


_RESULT = "CASE WHEN o IN ('hard', 'soft') THEN 'FAILED' ELSE o END"
_PLAN = f""", q AS (SELECT *, CASE WHEN state IN ('fresh', 'due') THEN row_number() OVER (PARTITION BY state IN ('fresh', 'due') ORDER BY state = 'due', slug, url) END AS place FROM st),
f AS (SELECT CAST(user_id AS VARCHAR) AS url, {_RESULT} AS result, 'was ' || lower({_RESULT}) AS detail, strftime(ts, '{_SQL_STAMP}') AS noted_at, streak, CASE WHEN o IN ('OK', 'PENDING') THEN 'c' || event_id END AS capture,
(SELECT count(*) FROM events e WHERE e.user_id = led.user_id) AS tries FROM led) """


@query(_LEDGER + _PLAN + "SELECT slug, url, place, CASE WHEN place <= 120 THEN 'attempt' WHEN place IS NOT NULL THEN 'beyond' ELSE state END AS part, detail AS last_detail FROM q LEFT JOIN f USING (url)")
def archive_plan(t):
    """What a run would attempt for forty captures, in which order, and what is held back and why."""
    return worker.plan(candidates(t), full_ledger(t), F.lit(NOW).cast("timestamp"), 40)


def answers(t) -> DataFrame:
    """What the far side said of customers: one answer an order."""
    c = F.col
    fault, stored = c("o_totalprice") > 499000, c("o_orderstatus") == "F"
    detail = F.when(fault, "submit-401").when(stored, "stored").otherwise(F.element_at(F.create_map(*[F.lit(x) for x in ("1-URGENT", "http-403", "2-HIGH", "error:blocked", "3-MEDIUM", "timeout", "4-NOT SPECIFIED", "http-500", "5-LOW", "")]), c("o_orderpriority")))
    return t("orders").select(
        c("o_custkey").cast("string").alias("url"), F.date_format("o_orderdate", _STAMP).alias("at"), F.when(stored & ~fault, "PENDING").otherwise("FAILED").alias("result"), detail.alias("detail"),
        F.repeat("o_orderpriority", (c("o_orderkey") % 60).cast("int")).alias("message"), F.when(stored & ~fault, F.concat(F.lit("w"), c("o_orderkey").cast("string"))).alias("capture"),
    )


@query(
    _LEDGER
    + _PLAN
    + f""", said AS (SELECT CAST(o_custkey AS VARCHAR) AS url, strftime(o_orderdate, '{_SQL_STAMP}') AS n_at, CASE WHEN o_orderstatus = 'F' AND o_totalprice <= 499000 THEN 'PENDING' ELSE 'FAILED' END AS n_result,
CASE WHEN o_totalprice > 499000 THEN 'submit-401' WHEN o_orderstatus = 'F' THEN 'stored' ELSE CASE o_orderpriority WHEN '1-URGENT' THEN 'http-403' WHEN '2-HIGH' THEN 'error:blocked' WHEN '3-MEDIUM' THEN 'timeout' WHEN '4-NOT SPECIFIED' THEN 'http-500' ELSE '' END END AS n_detail,
repeat(o_orderpriority, CAST(o_orderkey % 60 AS BIGINT)) AS message, CASE WHEN o_orderstatus = 'F' AND o_totalprice <= 499000 THEN 'w' || o_orderkey END AS n_capture FROM orders),
last AS (SELECT * FROM said QUALIFY row_number() OVER (PARTITION BY url ORDER BY n_at DESC, n_result DESC, n_detail DESC, message DESC, n_capture DESC NULLS LAST) = 1),
w AS (SELECT *, row_number() OVER p AS made, coalesce(sum(CAST(n_result = 'PENDING' AS INT)) OVER b, 0) AS won, coalesce(sum(CAST(n_detail = 'submit-401' AS INT)) OVER b, 0) AS lost FROM q JOIN last USING (url) WHERE place IS NOT NULL
WINDOW p AS (ORDER BY place), b AS (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
r AS (SELECT * FROM w WHERE won < 200 AND lost = 0 AND made <= 600)
SELECT coalesce(r.url, f.url) AS url, CASE WHEN r.url IS NULL THEN 'old' ELSE CAST(slug AS VARCHAR) END AS page, CASE WHEN r.url IS NULL THEN noted_at ELSE n_at END AS last_attempt,
CASE WHEN r.url IS NULL THEN result WHEN n_detail = 'submit-401' THEN 'SKIPPED' ELSE n_result END AS last_result, CASE WHEN coalesce(n_detail, '') = '' THEN detail ELSE n_detail END AS last_detail, CAST(length(left(nullif(message, ''), 500)) AS BIGINT) AS said,
CAST(coalesce(tries, 0) + CASE WHEN r.url IS NULL THEN 0 ELSE 1 END AS BIGINT) AS attempts,
CAST(CASE WHEN r.url IS NULL THEN streak WHEN n_result = 'PENDING' THEN 0 ELSE coalesce(streak, 0) + CASE WHEN n_detail IN ('http-403', 'error:blocked') THEN 1 ELSE 0 END END AS BIGINT) AS failures, coalesce(n_capture, f.capture) AS capture
FROM r FULL JOIN f ON r.url = f.url"""
)
def archive_run(t):
    """The ledger after a run for two hundred captures over recorded answers, which an account fault may end."""
    led = full_ledger(t)
    plan = worker.plan(candidates(t), led, F.lit(NOW).cast("timestamp"), 200).withColumn("slug", F.col("slug").cast("string"))
    after = worker.noted(led, worker.run(plan, answers(t), 200))
    return after.select("url", "page", "last_attempt", "last_result", "last_detail", F.length("last_message").cast("long").alias("said"), F.col("attempts").cast("long").alias("attempts"), F.col("consecutive_hard_failures").cast("long").alias("failures"), "capture")


_WAITING = "o_orderstatus = 'P'"


@query(f"""
WITH l AS (SELECT l_orderkey, max(CASE WHEN l_quantity = 50 AND l_orderkey % 10 > 0 AND l_shipdate >= TIMESTAMP '1999-01-01' THEN 'playback-429' ELSE CASE l_returnflag WHEN 'R' THEN 'played' WHEN 'A' THEN 'no-playback' ELSE 'inconclusive' END END) AS seen FROM lineitem WHERE l_linenumber <= 2 GROUP BY 1),
p AS (SELECT CAST(o_orderkey AS VARCHAR) AS url, o_custkey, o_orderkey, o_orderstatus, seen, CASE WHEN o_orderkey % 10 > 0 THEN strftime(o_orderdate, '{_SQL_STAMP}') END AS since, o_orderdate AS d FROM orders LEFT JOIN l ON l_orderkey = o_orderkey),
stop AS (SELECT coalesce(since, '') AS s, url AS u FROM p WHERE {_WAITING} AND seen = 'playback-429' ORDER BY 1, 2 LIMIT 1),
o AS (SELECT p.*, CASE WHEN o_orderstatus <> 'P' THEN NULL WHEN (coalesce(since, ''), url) >= (SELECT (s, u) FROM stop) THEN 'left' WHEN seen = 'played' THEN 'confirmed' WHEN seen = 'no-playback' THEN 'unplayable'
WHEN seen = 'inconclusive' AND epoch(TIMESTAMP '1998-06-01 00:00:00') - epoch(d) > 2592000 THEN 'expired' ELSE 'left' END AS outcome FROM p)
SELECT url, outcome, CASE WHEN outcome = 'confirmed' THEN 'OK' WHEN outcome IN ('unplayable', 'expired') THEN 'FAILED' WHEN o_orderstatus = 'P' THEN 'PENDING' ELSE 'FAILED' END AS last_result,
CASE outcome WHEN 'confirmed' THEN 'ok' WHEN 'unplayable' THEN 'no-playback' WHEN 'expired' THEN 'pending-expired' ELSE 'before' END AS last_detail,
CASE WHEN outcome IN ('confirmed', 'unplayable', 'expired') THEN '1998-06-01T000000Z' ELSE strftime(d, '{_SQL_STAMP}') END AS last_attempt, CAST(3 AS BIGINT) AS attempts, CAST(CASE WHEN outcome = 'confirmed' THEN 0 ELSE 2 END AS BIGINT) AS failures, since AS submitted FROM o""")
def archive_confirm(t):
    """The ledger after pending captures were read back, oldest first, until a read is throttled."""
    c = F.col
    at = F.date_format("o_orderdate", _STAMP)
    o = t("orders")
    led = o.select(
        c("o_orderkey").cast("string").alias("url"), c("o_custkey").cast("string").alias("page"), at.alias("last_attempt"), F.when(F.expr(_WAITING), "PENDING").otherwise("FAILED").alias("last_result"), F.lit("before").alias("last_detail"),
        F.lit(None).cast("string").alias("last_message"), F.lit(3).alias("attempts"), F.lit(2).alias("consecutive_hard_failures"), F.lit("c").alias("capture"), F.when(c("o_orderkey") % 10 > 0, at).alias("capture_submitted"),
    )
    flag = F.when(c("l_returnflag") == "R", "played").when(c("l_returnflag") == "A", "no-playback").otherwise("inconclusive")
    late = (c("l_quantity") == 50) & (c("l_orderkey") % 10 > 0) & (c("l_shipdate") >= F.lit("1999-01-01").cast("timestamp"))
    looks = t("lineitem").where("l_linenumber <= 2").select(c("l_orderkey").cast("string").alias("url"), F.when(late, "playback-429").otherwise(flag).alias("seen"))
    found = worker.looked(led, looks, F.lit("1998-06-01 00:00:00").cast("timestamp"))
    after = worker.confirmed(led, found, F.lit("1998-06-01T000000Z")).join(found.select("url", "outcome"), "url", "left")
    return after.select("url", "outcome", "last_result", "last_detail", "last_attempt", c("attempts").cast("long").alias("attempts"), c("consecutive_hard_failures").cast("long").alias("failures"), c("capture_submitted").alias("submitted"))


_TITLE = _ENTITIES.format(x="regexp_extract(html, '<title>([^<]*)</title>', 1)")
_BARE = r"regexp_replace(url, '^https?://(www\.)?', '')"


@query(rf"""
WITH p AS (SELECT page_id, url, length(url) AS n, length(html) AS m, regexp_replace({_TITLE}, '^\s+|\s+$', '', 'g') AS title, '{_SITE}' || CAST(2020 + page_id % 5 AS VARCHAR) || '/' FROM pages),
c AS (SELECT page_id, CASE WHEN n % 3 = 0 THEN '2026-01-0' || (1 + page_id % 2) ELSE '2026-01-05' END AS asked, url, url AS u, CASE WHEN title = '' OR starts_with(title, split_part({_BARE}, '/', 1) || ' ') THEN {_BARE} ELSE title END AS name FROM p WHERE n % 4 <> 1 AND m % 3 <> 0
UNION ALL SELECT page_id, '2026-01-05', url, url || '&more=1', regexp_replace(url || '&more=1', '^https?://(www\.)?', '') FROM p WHERE n % 2 = 0),
g AS (SELECT page_id, count(*) AS captures, min(asked) AS lo, max(asked) AS hi, string_agg(name || ' → [{_SITE}2026/' || u || '](' || '{_SITE}2026/' || u || ')', '; ' ORDER BY asked, u) AS items FROM c GROUP BY 1)
SELECT page_id, captures, CASE WHEN n % 7 = 0 THEN 'no Markdown source' WHEN n % 5 = 0 THEN 'the heading doesn''t occur once' END AS reason,
CASE WHEN n % 7 > 0 AND n % 5 > 0 THEN left(sha256('# ' || title || chr(10) || '## Log' || chr(10) || '2026-01-05 asked ' || CASE WHEN lo = hi AND lo = '2026-01-05' THEN 'this date' WHEN lo = hi THEN 'on ' || lo ELSE 'between ' || lo || ' and ' || hi END || ': ' || items || '.' || chr(10) || chr(10) || 'older' || chr(10)), 16) END AS md
FROM g JOIN p USING (page_id)""")
def archive_record(t):
    """Markdown of pages after confirmed captures of what they link were entered in their logs, by the names that pages give their sources."""
    c = F.col
    title = T.strip(T.html_unescape(F.regexp_extract("html", "<title>([^<]*)</title>", 1)))
    p = t("pages").select("page_id", "url", c("html").alias("raw"), title.alias("title"), F.length("url").alias("n"), F.length("html").alias("m"))
    link = lambda u, text: F.concat(F.lit('<a href="'), T.html_escape(u), F.lit('">'), text, F.lit("</a>"))
    more = F.concat("url", F.lit("&more=1"))
    caught = F.when(c("m") % 3 == 0, link(F.concat(F.lit(f"{_SITE}2019/"), "url"), F.lit("kept"))).otherwise("")
    page = F.concat("raw", link(c("url"), F.concat(F.lit("<b>"), T.html_escape(c("title")), F.lit("</b>"))), link(more, F.lit("")), caught)
    md = F.when(c("n") % 7 > 0, F.concat(F.lit("# "), "title", F.lit("\n## Log\n"), F.when(c("n") % 5 == 0, F.lit("old\n## Log\n")).otherwise(""), F.lit("older\n")))
    pages = p.select(c("page_id").cast("string").alias("slug"), page.alias("html"), md.alias("md"))
    day = F.when(c("n") % 3 == 0, F.concat(F.lit("2026-01-0"), (c("page_id") % 2 + 1).cast("string"))).otherwise("2026-01-05")
    row = lambda u, submitted, ok: p.where(ok).select(c("page_id").cast("string").alias("page"), u.alias("url"), F.lit("OK").alias("last_result"), F.lit("2026-01-05T000000Z").alias("last_attempt"), submitted.alias("capture_submitted"), F.concat(F.lit(f"{_SITE}2026/"), u).alias("capture"))
    led = row(c("url"), F.concat(day, F.lit("T010203Z")), c("n") % 4 != 1).unionByName(row(more, F.lit(None).cast("string"), c("n") % 2 == 0))
    out = worker.recorded(pages, led, "2026-01-05", "## Log\n", "{today} asked {when}: {items}.")
    return out.select(c("slug").cast("long").alias("page_id"), "captures", "reason", T.body_hash("md").alias("md"))
