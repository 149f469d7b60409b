"""Named queries over the driver's tables, each beside DuckDB SQL for the same rows where SQL can express it.

The tables stand in for evidence: documents are captured bodies, benchmark passages are claims, pages are
published pages, conversations are packets whose turns are sources, events are an append-only log
whose event_id is file order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from veriloom.functions import claims as C
from veriloom.functions import dates as D
from veriloom.functions import text as T
from veriloom.operators import compare, coverage, fidelity, gates, gramindex, history, patience, queue
from veriloom.session import long_rows, scratch, ship
from veriloom.sources import files, html, packets

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

NOW = "2024-01-31 00:00:00"
#: Text of different windows that one task holds.
WINDOW_BYTES = 16 << 20


def query(sql: str | None = None):
    """Register a function of (tables) under its name; tables(name) reads a table."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        QUERIES[f.__name__] = run
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return run

    return add


# ---- claims and evidence


@query("""
SELECT b.item_id, d.doc_id FROM benchmark b JOIN documents d
ON contains(regexp_replace(d.text, '\\s+', ' ', 'g'), regexp_replace(b.text, '\\s+', ' ', 'g'))""")
def verbatim_in_evidence(t):
    """Which passages occur word for word in which documents."""
    b = t("benchmark").select("item_id", F.col("text").alias("claim"))
    return fidelity.contained(b, t("documents").select("doc_id", "text"), "claim", "text").select("item_id", "doc_id")


@query("""
SELECT b.item_id FROM benchmark b WHERE NOT EXISTS (SELECT 1 FROM documents d
WHERE contains(regexp_replace(d.text, '\\s+', ' ', 'g'), regexp_replace(b.text, '\\s+', ' ', 'g')))""")
def unsupported_claims(t):
    """Passages that no document supports."""
    b = t("benchmark").select("item_id", F.col("text").alias("claim"))
    found = fidelity.contained(b, t("documents").select("doc_id", "text"), "claim", "text", once=True)
    return b.join(found.select("item_id").distinct(), "item_id", "left_anti").select("item_id")


@query(r"""
WITH t AS MATERIALIZED (SELECT doc_id, regexp_replace(text, '\s+', ' ', 'g') AS x FROM documents WHERE text IS NOT NULL),
c AS (SELECT 'passage' AS kind, item_id AS id, regexp_replace(text, '\s+', ' ', 'g') AS x FROM benchmark UNION ALL SELECT 'document', doc_id, x FROM t)
SELECT kind, id, count(t.doc_id) AS texts, min(t.doc_id) AS first FROM c LEFT JOIN t ON contains(t.x, c.x) GROUP BY kind, id""")
def claims_by_rarest_gram(t):
    """How many documents hold each passage, and each document, word for word, and the first that does: by an index of grams, neither side broadcast."""
    docs = t("documents").where("text is not null").select("doc_id", "text")
    claims = t("benchmark").select(F.struct(F.lit("passage").alias("kind"), F.col("item_id").cast("long").alias("id")).alias("claim"), "text")
    claims = claims.unionByName(docs.select(F.struct(F.lit("document").alias("kind"), F.col("doc_id").cast("long").alias("id")).alias("claim"), "text"))
    return gramindex.support(claims, docs, "claim", "text", "doc_id", "text").select("claim.kind", "claim.id", "texts", "first")


@query("""
WITH p AS (SELECT conv_id, turn, 'It says "' || text || '" here' AS raw, text FROM conversations WHERE role = 'user'),
e AS (SELECT conv_id, string_agg(text, chr(10) ORDER BY turn, text) AS body FROM conversations WHERE turn % 4 <> 2 GROUP BY conv_id)
SELECT p.conv_id, p.turn, length(p.text) AS n_chars FROM p LEFT JOIN e USING (conv_id)
WHERE length(p.text) >= 15 AND NOT coalesce(contains(regexp_replace(e.body, '\\s+', ' ', 'g'), regexp_replace(p.text, '\\s+', ' ', 'g')), false)""")
def unsupported_quotes(t):
    """Quotations of user turns that the other turns' evidence doesn't hold."""
    c = t("conversations")
    p = c.where("role = 'user'").select("conv_id", "turn", F.concat(F.lit('It says "'), "text", F.lit('" here')).alias("raw"))
    q = p.select("conv_id", "turn", F.explode(C.quotes("raw")).alias("q")).select("conv_id", "turn", F.col("q.text").alias("text"))
    ev = fidelity.evidence(c.where("turn % 4 <> 2").select("conv_id", "turn", F.col("text").alias("body")), "conv_id", "turn")
    return fidelity.unsupported_quotes(q, ev, "conv_id").select("conv_id", "turn", F.length("text").cast("long").alias("n_chars"))


# The shapes of contact facts, as above.
_EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
_PHONE = r"(?:\+?1[-.\s]?)?\(?\d{3}\)?[-.\s]\d{3}[-.\s]?\d{4}"
# End of fixed values.


def _phones_of(key: str, src: str) -> str:
    return rf"""
SELECT {key}, CASE WHEN length(d) = 11 AND d LIKE '1%' THEN substr(d, 2) ELSE d END AS value
FROM (SELECT {key}, regexp_replace(unnest(regexp_extract_all(text, '{_PHONE}')), '\D', '', 'g') AS d FROM {src})
WHERE length(d) = 10 OR (length(d) = 11 AND d LIKE '1%')"""


@query(rf"SELECT DISTINCT doc_id, regexp_replace(lower(unnest(regexp_extract_all(text, '{_EMAIL}'))), '\.+$', '') AS email FROM documents")
def contact_emails(t):
    return t("documents").select("doc_id", F.explode(C.emails("text")).alias("email"))


@query(f"SELECT DISTINCT doc_id, value AS phone FROM ({_phones_of('doc_id', 'documents')})")
def contact_phones(t):
    return t("documents").select("doc_id", F.explode(C.phones("text")).alias("phone"))


@query(
    f"""
WITH a AS ({_phones_of("source", "(SELECT * FROM documents WHERE doc_id % 2 = 1)")}),
b AS ({_phones_of("source", "(SELECT * FROM documents WHERE doc_id % 2 = 0)")})
SELECT DISTINCT source, value FROM a EXCEPT SELECT source, value FROM b"""
)
def missing_contacts(t):
    """Phones that a source's odd documents state and its even ones don't."""
    d = t("documents")
    of = lambda k: fidelity.explode_values(d.where(f"doc_id % 2 = {k}"), "source", C.phones("text"))
    return fidelity.missing_values(of(1), of(0), "source")


_PHRASES = "['you should', 'we recommend', 'your deadline', 'be sure to', 'you qualify', 'we advise', 'you have grounds', 'file by']"


@query(f"""
WITH x AS (SELECT conv_id, 'Note: ' || upper({_PHRASES}[CAST(1 + conv_id % 8 AS INT)]) || ' x. "' || {_PHRASES}[CAST(1 + turn % 8 AS INT)] || '" ' || replace(text, '"', '') AS x FROM conversations)
SELECT DISTINCT conv_id, p AS phrase FROM (SELECT conv_id, lower(regexp_replace(regexp_replace(x, '\\s+', ' ', 'g'), '"[^"]*"', ' ', 'g')) AS x, unnest({_PHRASES}) AS p FROM x) WHERE contains(x, p)""")
def advisory_phrases(t):
    """Advice outside quotation marks; a phrase between them doesn't count."""
    at = lambda k: F.get(F.array(*[F.lit(p) for p in C.ADVISORY]), (F.col(k) % 8).cast("int"))
    x = F.concat(F.lit("Note: "), F.upper(at("conv_id")), F.lit(' x. "'), at("turn"), F.lit('" '), F.replace("text", F.lit('"'), F.lit("")))
    return fidelity.advisory(t("conversations").select("conv_id", x.alias("text")), "conv_id", "text").distinct()


# ---- bodies and lines


@query(r"SELECT doc_id, left(sha256(trim(regexp_replace(text, '\s+', ' ', 'g'))), 16) AS hash FROM documents")
def body_fingerprint(t):
    return t("documents").select("doc_id", T.body_hash(T.strip(T.one_space("text"))).alias("hash"))


@query(r"""
SELECT left(sha256(regexp_replace(lower(text), '[^a-z0-9]+', '', 'g')), 16) AS hash, count(*) AS documents, min(doc_id) AS first_doc FROM documents
GROUP BY 1 HAVING count(*) > 1""")
def squash_duplicates(t):
    """Documents alike but for spacing, punctuation and case."""
    g = t("documents").groupBy(T.body_hash(T.squash("text")).alias("hash"))
    return g.agg(F.count("*").alias("documents"), F.min("doc_id").alias("first_doc")).where("documents > 1")


@query(r"""
WITH l AS (SELECT doc_id, list_sort(list_transform(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> ''), lambda x: length(rtrim(x)))) AS l FROM documents)
SELECT doc_id, CAST(CASE WHEN len(l) = 0 THEN 40 ELSE greatest(40, 5 * round_even((l[least(len(l), CAST(floor(len(l) * 0.9) AS INT) + 1)] - 12) / 5, 0)) END AS INT) AS width FROM l""")
def column_width(t):
    return t("documents").select("doc_id", T.width_of("text").alias("width"))


@query(r"""
WITH l AS (SELECT doc_id, string_split(CASE WHEN text LIKE '%' || chr(10) THEN left(text, length(text) - 1) ELSE text END, chr(10)) AS l FROM documents),
o AS (SELECT doc_id, l, list_transform(l, lambda x: trim(x)) AS k FROM l)
SELECT doc_id, left(sha256(array_to_string(list_filter(l, lambda x: trim(x) = '' OR len(list_filter(k, lambda y: y = trim(x))) < 3), chr(10))), 16) AS hash FROM o""")
def repeated_lines(t):
    """Texts without lines that recur three times or more."""
    return t("documents").select("doc_id", T.body_hash(T.strip_repeats("text")).alias("hash"))


@query(r"""
SELECT doc_id, trim(line) AS line, count(*) AS times FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
WHERE trim(line) <> '' GROUP BY 1, 2 HAVING count(*) >= 3""")
def line_histogram(t):
    return T.repeated_lines(t("documents"), "doc_id")


@query(r"""
SELECT doc_id, count(*) AS numbered FROM (SELECT doc_id, unnest(string_split(replace(text, '. ', chr(10)), chr(10))) AS line FROM documents)
WHERE regexp_matches(line, '(?i)^\s*(?:page\s+)?(?:[ivxlcdm]+|\d{1,4})\s*(?:of\s+\d{1,4})?\s*$') GROUP BY 1""")
def page_number_lines(t):
    """Sentences that look like page numbers: how many lines the page-number filter would drop."""
    broken = F.replace(F.col("text"), F.lit(". "), F.lit("\n"))
    lost = F.size(T.lines(broken)) - F.size(F.when(T.strip_page_numbers(broken) == "", F.array(F.lit(""))).otherwise(T.lines(T.strip_page_numbers(broken))))
    return t("documents").select("doc_id", lost.cast("long").alias("numbered")).where("numbered > 0")


#: Glyphs, bullets, blank runs, split words, cells and form feeds put into a text, in order.
_PUT = [("a ", "a’ "), (", ", " — "), (". ", ".\n\n\n\n• "), ("e ", "e\u200b "), ("n ", "n-\n"), ("o ", "o \t\n"), ("s ", "s |"), ("r ", "r\f"), ("i ", "i “ﬁ” "), ("u ", "u\u00a0")]


def _carrying(c):
    for a, b in _PUT:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


_CARRYING = "text"
for _a, _b in _PUT:
    _CARRYING = "replace(" + _CARRYING + ", '" + _a + "', '" + _b + "')"
_FILTERED = r'''
SELECT doc_id, left(sha256(x), 16) AS hash FROM (SELECT doc_id, replace(regexp_replace(regexp_replace(regexp_replace(
  array_to_string(list_transform(string_split(regexp_replace(translate(replace(CARRYING, '—', '--'), '‘’‚“”„–− ​﻿⁠', repeat(chr(39), 3) || repeat(chr(34), 3) || '-- '), '(?m)^[ \t]*[•▪●◦·⁃∙o*–]\s+', '- ', 'g'), chr(10)), lambda l: regexp_replace(l, '\s+$', '')), chr(10)),
  '-\n([a-z])', '-\1', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '\s*\|\s*', ' | ', 'g'), chr(12), chr(10)) AS x FROM documents)'''.replace("CARRYING", _CARRYING)


@query(_FILTERED)
def text_filters(t):
    """A chain of filters over texts that carry what they look for: glyphs, zero-width characters, bullets, line ends, wrapped hyphens, blank runs, table cells, form feeds."""
    names = ["normalize-apostrophes", "strip-zero-width", "normalize-bullets", "trim-lines", "join-wrap-hyphens", "collapse-blank-runs", "pipe-table-cells"]
    return t("documents").select("doc_id", T.body_hash(T.apply_filters(_carrying(F.col("text")), names)).alias("hash"))


@query(f"""
SELECT doc_id, left(sha256(regexp_replace(translate(replace(replace({_CARRYING}, 'ﬁ', 'fi'), 'ﬀ', 'ff'), '‘’ʼ', repeat(chr(39), 3)), '[\\s ]+', ' ', 'g')), 16) AS normal,
left(sha256(replace({_CARRYING}, 'ﬁ', 'fi') || 'x (A) B office'), 16) AS folded, left(sha256('retrieved: X and RETRIEVED:' || chr(10) || 'X, not retrieved 2026-01-02 ' || text), 16) AS undated FROM documents""")
def folded_texts(t):
    """Comparison form, compatibility characters by their letters (beyond the basic plane too), and retrieval dates as X."""
    c = _carrying(F.col("text"))
    dated = F.concat(F.lit("retrieved: 2026-01-02 and RETRIEVED:\n2025-12-31, not retrieved 2026-01-02 "), "text")
    folded = T.normalize_ligatures(F.concat(c, F.lit("x \U0001f110 B oﬃce")))
    return t("documents").select("doc_id", T.body_hash(T.norm(c)).alias("normal"), T.body_hash(folded).alias("folded"), T.body_hash(T.flatten_retrieved(dated)).alias("undated"))


@query(r"""
WITH d AS (SELECT doc_id, string_split(regexp_replace(text, '(.{50,70}) ', '\1' || chr(10), 'g'), chr(10)) AS s FROM documents WHERE text IS NOT NULL),
n AS (SELECT doc_id, list_sort(list_transform(list_filter(s, lambda x: trim(x) <> ''), lambda x: length(rtrim(x)))) AS n FROM d),
w AS (SELECT doc_id, CASE WHEN len(n) = 0 THEN 40 ELSE greatest(40, 5 * round_even((n[least(len(n), CAST(floor(len(n) * 0.9) AS INT) + 1)] - 12) / 5, 0)) END AS width FROM n),
r AS (SELECT doc_id, i, regexp_replace(s[i], '\s+$', '') AS x FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM d)),
p AS (SELECT *, lag(x) OVER (PARTITION BY doc_id ORDER BY i) AS prev FROM r JOIN w USING (doc_id)),
k AS (SELECT *, coalesce(prev <> '' AND x <> '' AND NOT regexp_matches(prev, '[.:;?!]["'')\]]?\s*$') AND NOT regexp_matches(x, '^\s*(?:[-•]|\(?[a-zA-Z0-9]{1,3}[.)])\s') AND NOT contains(prev, '|') AND NOT contains(x, '|'), false) AS ok, length(prev) >= width AS long FROM p),
u AS (SELECT *, sum(CASE WHEN ok THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM k),
j AS (SELECT *, ok AND max(CASE WHEN ok AND long THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, run ORDER BY i) = 1 AS joined FROM u),
g AS (SELECT *, sum(CASE WHEN joined THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS line FROM j),
o AS (SELECT doc_id, line, string_agg(CASE WHEN joined THEN trim(x) ELSE x END, ' ' ORDER BY i) AS x FROM g GROUP BY 1, 2)
SELECT doc_id, left(sha256(string_agg(x, chr(10) ORDER BY line)), 16) AS hash FROM o GROUP BY 1""")
def unwrapped_lines(t):
    """Lines that were wrapped at fifty to seventy characters joined again, at each text's own width."""
    wrapped = F.regexp_replace("text", "(.{50,70}) ", "$1\n")
    return t("documents").where("text is not null").select("doc_id", T.body_hash(T.unwrap_hard_wraps(wrapped)).alias("hash"))


@query()
def running_headers(t):
    """Conversations as documents of one page a turn, page heads dropped."""
    head = F.concat(F.lit("Conversation "), F.col("conv_id").cast("string"), F.lit(" page "), F.col("turn").cast("string"), F.lit("\n"), F.col("text"))
    doc = fidelity.evidence(t("conversations").select("conv_id", "turn", head.alias("body")), "conv_id", "turn").withColumn("body", F.regexp_replace("body", r"\n(?=Conversation \d+ page )", "\f"))
    return doc.select("conv_id", T.body_hash(T.strip_running_headers(F.col("body"))).alias("hash"))


@query("""
WITH s AS (SELECT doc_id, string_split(text, ' the ') AS s FROM documents)
SELECT doc_id, length(array_to_string(s[1:3], ' the ')) AS start FROM s WHERE len(s) >= 4""")
def nth_occurrence(t):
    """Where " the " occurs for the third time."""
    span = T.nth_span("text", "\\Q the \\E", 3)
    return t("documents").select("doc_id", span["start"].cast("long").alias("start")).where("start is not null")


@query("""
SELECT page_id, left(sha256(substr(html, position('<article>' IN html), position('</article>' IN html) - position('<article>' IN html))), 16) AS hash
FROM pages WHERE contains(html, '<article>') AND position('</article>' IN html) > position('<article>' IN html)""")
def sliced_articles(t):
    p = t("pages").where("html rlike '(?s)<article>.*</article>'")
    return p.select("page_id", T.body_hash(T.slice_between("html", "<article>", "</article>")).alias("hash"))


@query(r"""
SELECT doc_id, CASE WHEN length(f) <= 157 THEN f ELSE rtrim(regexp_extract(f, '^(.{0,157})\s', 1)) || '…' END AS description FROM (
  SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(text, '\[([^\]]*)\]\([^)]*\)', '\1', 'g'), '[*_`#>]', '', 'g'), '\s+', ' ', 'g')) AS f FROM documents)""")
def descriptions(t):
    return t("documents").select("doc_id", T.describe("text").alias("description"))


@query("""
SELECT doc_id, left(sha256(array_to_string(list_transform(string_split(replace(text, ',', '"'), '"'), lambda x, i: CASE WHEN i % 2 = 1 THEN replace(x, 'the', 'THE') ELSE x END), '"')), 16) AS hash FROM documents""")
def outside_quotes(t):
    """A spelling changed outside quotation marks only."""
    c = F.replace(F.col("text"), F.lit(","), F.lit('"'))
    return t("documents").select("doc_id", T.body_hash(T.outside_quotes(c, lambda x: F.replace(x, F.lit("the"), F.lit("THE")))).alias("hash"))


# ---- pages


_SPEAKS = "url LIKE 'http://%' OR url LIKE 'https://%'"


@query("SELECT page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]+)\"', 1)) AS href FROM pages")
def page_links(t):
    return t("pages").select("page_id", F.explode(C.hrefs("html")).alias("href")).where("href is not null")


@query("SELECT lower(regexp_extract(url, '^https?://([^/]+)', 1)) AS host, count(*) AS pages FROM pages GROUP BY 1")
def link_hosts(t):
    return t("pages").groupBy(C.host("url").alias("host")).agg(F.count("*").alias("pages"))


@query("""
SELECT DISTINCT p.page_id, l.href FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS href FROM pages) p JOIN
(SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS href FROM pages) l USING (page_id) WHERE length(l.href) > 8""")
def long_links(t):
    """Distinct links of pages, in order of first use, longer than eight characters."""
    return t("pages").select("page_id", F.explode(F.array_distinct(F.filter(C.hrefs("html"), lambda h: F.length(h) > 8))).alias("href"))


#: What is put before a page, by its key: loads, advice, placeholders and links that gates look for.
_BROKEN = """concat('<p>"you should" is quoted</p>', case when page_id % 5 = 0 then '<p>You need to file.</p>' when page_id % 5 = 1 then '<p>Be sure to ask.</p>' else '' end, case when page_id % 11 = 0 then '[reviewer name]' else '' end,
case when page_id % 13 = 0 then '<i>Review-pending</i>' else '' end, case when page_id % 7 = 0 then '<img alt="" src="https://cdn' || (page_id % 3) || '.example.net:8443/x.png"><script src="//own.js"></script>' else '' end,
case when page_id % 7 = 1 then '<style>@import "http://css.example.org/a.css"; b{background:url(data:x)}</style><link rel="canonical" href="https://nav.example.org/">' else '' end,
case when page_id % 9 = 0 then '<a href="docs/x.html">' else '<a href="/docs/x.html">' end, case when page_id % 17 = 0 then '<b>[text](page.md)</b><script>[not](this)</script>' else '' end, case when page_id % 4 = 0 then '<p>licence</p>"licence"' else '""' end)"""


def broken(t) -> DataFrame:
    return t("pages").withColumn("html", F.concat(F.expr(_BROKEN), "html"))


_BROKEN_PAGES = f"p AS (SELECT page_id, url, {_BROKEN} || html AS html FROM pages)"


@query(f"""
WITH {_BROKEN_PAGES} SELECT DISTINCT page_id, split_part(lower(regexp_extract(r, '^[A-Za-z]+://([^/]+)', 1)), ':', 1) AS host FROM (
  SELECT page_id, unnest(list_concat(regexp_extract_all(replace(html, '<link rel="canonical" href="https://nav.example.org/">', ''), '(?i)<(?:script|link|img|iframe|source|video|audio|embed|object)\\b[^>]*?\\b(?:src|href|data)\\s*=\\s*"([^"]+)"', 1),
  regexp_extract_all(html, '(?i)(?:@import\\s+|url\\()\\s*["'']?(https?://[^"'')\\s]+)', 1))) AS r FROM p)
WHERE regexp_matches(r, '^[A-Za-z]+://')""")
def third_party_loads(t):
    return broken(t).select("page_id", F.explode(gates.loads(F.col("html"), [])).alias("r")).select("page_id", C.bare_host("r").alias("host")).distinct()


@query(r"""
SELECT page_id, CASE WHEN rel = 'index.html' THEN '/' ELSE '/' || regexp_replace(rel, '\.html$', '/') END AS path, CASE WHEN rel = 'index.html' THEN 1 ELSE 2 END AS forms
FROM (SELECT page_id, CASE WHEN p = '' THEN 'index.html' ELSE p || '.html' END AS rel FROM (SELECT page_id, trim(regexp_replace(regexp_extract(url, '^https?://[^/]+/?([^?#]*)', 1), '/+$', ''), '/') AS p FROM pages))""")
def canonical_paths(t):
    p = F.regexp_replace(F.regexp_replace(F.regexp_extract("url", r"^https?://[^/]+/?([^?#]*)", 1), "/+$", ""), "^/+", "")
    rel = F.when(p == "", "index.html").otherwise(F.concat(p, F.lit(".html")))
    r = t("pages").select("page_id", rel.alias("rel"))
    return r.select("page_id", coverage.canonical_path(F.col("rel")).alias("path"), F.size(coverage.other_paths(F.col("rel"))).alias("forms"))


_ENTITIES = "replace(replace(replace(replace(replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&#x27;', ''''), '&nbsp;', ' '), '&amp;', '&')"


@query("SELECT page_id, left(sha256(" + _ENTITIES.format(x="regexp_replace(html, '<[^>]+>', ' ', 'g')") + "), 16) AS hash FROM pages")
def masked_pages(t):
    """Pages with tags masked and entities read, as quotations are sought in them."""
    return t("pages").select("page_id", T.body_hash(T.mask_tags("html")).alias("hash"))


@query(r"""
SELECT page_id, left(sha256(regexp_replace(regexp_replace(regexp_replace(
  regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script\s*>', '', 'g'), '(?is)<style\b.*?</style\s*>', '', 'g'), '(?s)<!--.*?-->', '', 'g'),
  '(?i)</?(?:p|div|br|li|h[1-6]|section|article|header|footer|table|ul|ol|tr)\b[^>]*>', chr(10), 'g'), '<[^>]+>', '', 'g'), '[ \t]+', ' ', 'g')), 16) AS hash FROM pages""")
def page_text(t):
    return t("pages").select("page_id", T.body_hash(html.visible_text(F.col("html"))).alias("hash"))


@query()
def page_text_dom(t):
    """Visible text of articles by structure: hidden parts dropped, table rows as cells."""
    return t("pages").select("page_id", T.body_hash(html.html_text(F.col("html"), "article")).alias("hash"))


@query(r"""
SELECT page_id, len(regexp_extract_all(html, '(?is)<script\b.*?</script\s*>')) AS scripts, len(regexp_extract_all(html, '(?s)<!--.*?-->')) AS comments FROM pages""")
def hidden_blocks(t):
    n = lambda p: F.regexp_count("html", F.lit(p)).cast("long")
    return t("pages").select("page_id", n(r"(?is)<script\b.*?</script\s*>").alias("scripts"), n(r"(?s)<!--.*?-->").alias("comments"))


@query(rf"""
WITH {_BROKEN_PAGES}, r AS (SELECT page_id, unnest(regexp_extract_all(html, '\b(?:href|src)="([^"]*)"', 1)) AS x FROM p)
SELECT 'relative' AS gate, page_id AS page, x AS detail FROM r WHERE x <> '' AND NOT regexp_matches(x, '^(https?://|/|#|mailto:|tel:|data:|javascript:)')
UNION ALL SELECT 'leaked', page_id, unnest(regexp_extract_all(regexp_replace(html, '(?s)<script.*?</script>', ' ', 'g'), '\[[^\]\n]{{2,80}}\]\([^)\n]{{1,80}}\)')) FROM p
UNION ALL SELECT 'description', page_id, 'missing' FROM p WHERE NOT contains(html, 'name="description"')
UNION ALL SELECT 'placeholder', page_id, 'reviewer placeholder' FROM p WHERE regexp_matches(html, '\[named human reviewer|\[pending review before publication|\[reviewer')
UNION ALL SELECT 'pending', page_id, 'review pending' FROM p WHERE regexp_matches(html, '(?i)review[- ]pending')
UNION ALL SELECT 'external', page_id, 'https://cdn' || (page_id % 3) || '.example.net:8443/x.png' FROM p WHERE page_id % 7 = 0
UNION ALL SELECT 'external', page_id, 'http://css.example.org/a.css' FROM p WHERE page_id % 7 = 1
UNION ALL SELECT 'advice', page_id, CASE page_id % 5 WHEN 0 THEN 'you need to file' ELSE 'be sure to' END FROM p WHERE page_id % 5 < 2
UNION ALL SELECT 'spelling', page_id, 'licence' FROM p WHERE page_id % 4 = 0""")
def gate_violations(t):
    """All gates over pages that break each of them by a rule."""
    return gates.violations(broken(t), ["example.com"], {"description": 'name="description"'}, {"licence": "license"}, page="page_id")


@query(f"""
WITH {_BROKEN_PAGES}, n AS (SELECT 'placeholder' AS gate, count(*) AS n FROM p WHERE contains(html, '[reviewer') UNION ALL SELECT 'pending', count(*) FROM p WHERE regexp_matches(html, '(?i)review[- ]pending')
UNION ALL SELECT 'viewport', count(*) FROM p WHERE NOT contains(html, 'viewport') UNION ALL SELECT 'quoted', count(*) FROM p WHERE NOT contains(html, 'is quoted'))
SELECT gate, n AS violations, n = 0 AS passed FROM n""")
def gate_summary(t):
    found = gates.violations(broken(t), [], {"viewport": "viewport", "quoted": "is quoted"}, page="page_id")
    return gates.passed(found, ["placeholder", "pending", "viewport", "quoted"])


@query("SELECT page_id, CASE WHEN page_id = 50 THEN 'excluded by name' WHEN page_id % 7 = 0 THEN 'recorded as drift, awaiting rebuild' WHEN page_id % 3 = 0 THEN 'declares noindex' END AS reason FROM pages")
def sitemap_reasons(t):
    tag = F.expr("""if(page_id % 3 = 0, '<meta name="robots" content="noindex,follow">', '<meta name="robots" content="noindexed">')""")
    p = t("pages").select(F.col("page_id").cast("string").alias("path"), F.concat(tag, "html").alias("html"), "page_id")
    return coverage.sitemap(p, ["50"], p.where("page_id % 7 = 0")).select(F.col("path").cast("long").alias("page_id"), "reason")


# ---- the log


def log(t) -> DataFrame:
    """Events as log rows."""
    return t("events").select(
        F.col("user_id").alias("slug"), F.col("event_type").alias("kind"), F.col("event_id").alias("seq"), F.to_date("ts").cast("string").alias("date"), "ts", "value",
        F.when(F.col("value") < 5, "drift").when(F.col("value") < 12, "confirmed").when(F.col("value") < 25, "rebuild").alias("result"),
        T.body_hash(F.floor(F.col("value") / 10).cast("string")).alias("hash"),
        F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("c"), F.col("event_id").cast("string"))).alias("capture"),
    )


_LOG = """WITH log AS (SELECT user_id AS slug, event_type AS kind, event_id AS seq, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, ts, value,
CASE WHEN value < 5 THEN 'drift' WHEN value < 12 THEN 'confirmed' WHEN value < 25 THEN 'rebuild' END AS result,
left(sha256(CAST(CAST(floor(value / 10) AS BIGINT) AS VARCHAR)), 16) AS hash, CASE WHEN event_id % 3 <> 0 THEN 'c' || event_id END AS capture FROM events) """
_OUTCOME = "CASE event_type WHEN 'view' THEN 'OK' WHEN 'click' THEN 'PENDING' WHEN 'error' THEN 'hard' WHEN 'purchase' THEN 'soft' ELSE 'SKIPPED' END"


def attempts(t) -> DataFrame:
    said = F.create_map(*[F.lit(x) for x in ("view", "OK", "click", "PENDING", "error", "hard", "purchase", "soft", "signup", "SKIPPED")])
    return t("events").select("user_id", "event_id", "ts", F.element_at(said, F.col("event_type")).alias("outcome"))


@query(_LOG + "SELECT slug, kind, seq, date FROM log QUALIFY row_number() OVER (PARTITION BY slug, kind ORDER BY seq DESC) = 1")
def latest_by_key(t):
    return history.latest(log(t), ["slug", "kind"]).select("slug", "kind", "seq", "date")


@query(_LOG + "SELECT slug, kind, capture, hash FROM log WHERE capture IS NOT NULL QUALIFY row_number() OVER (PARTITION BY slug, kind ORDER BY seq DESC) = 1")
def newest_stored(t):
    return history.newest_stored(log(t)).select("slug", "kind", "capture", "hash")


@query(
    _LOG
    + """, last AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY slug, kind ORDER BY seq DESC) = 1)
SELECT slug, result, string_agg(kind, ',' ORDER BY kind) AS kinds FROM last WHERE result IN ('drift', 'accepted') GROUP BY 1, 2"""
)
def exempt_kinds(t):
    return history.exempt(log(t)).withColumn("kinds", F.array_join("kinds", ","))


@query(_LOG + "SELECT coalesce(result, 'unknown') AS result, count(*) AS passes FROM log WHERE date BETWEEN '2024-01-05' AND '2024-01-20' GROUP BY 1")
def attendance_window(t):
    return history.attendance(log(t), "2024-01-05", "2024-01-20")


@query("SELECT date_trunc('month', ts) AS month, event_type AS result, count(*) AS passes FROM events GROUP BY 1, 2")
def attendance_by_month(t):
    from veriloom.streaming.logs import monthly

    return monthly(t("events"), "ts", "event_type").withColumnRenamed("event_type", "result").withColumn("month", F.col("month").cast("timestamp_ntz"))


@query(_LOG + "SELECT slug, count(DISTINCT capture) AS captures, min(date) AS first_date, max(date) AS last_date FROM log GROUP BY 1")
def captures_by_slug(t):
    return history.captures(log(t))


@query(
    _LOG
    + """, last AS (SELECT slug, max_by(date, seq) AS date FROM log GROUP BY slug)
SELECT slug, date, date_diff('day', CAST(date AS DATE), DATE '2024-03-01') AS age, date_diff('day', CAST(date AS DATE), DATE '2024-03-01') > 35 AS late FROM last"""
)
def freshness(t):
    last = history.latest(log(t), ["slug"]).select("slug", "date")
    return coverage.ages(last, F.lit("2024-03-01").cast("date")).select("slug", "date", F.col("age").cast("long").alias("age"), (F.col("age") > 35).alias("late"))


@query(f"""
WITH a AS (SELECT user_id, event_id, {_OUTCOME} AS o FROM events),
i AS (SELECT *, sum(CASE WHEN o IN ('OK', 'PENDING') THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM a)
SELECT user_id, event_id, CAST(sum(CASE WHEN o = 'hard' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, i ORDER BY event_id) AS BIGINT) AS streak FROM i""")
def failure_streaks(t):
    return queue.streaks(attempts(t), ["user_id"], "event_id").select("user_id", "event_id", F.col("streak").cast("long").alias("streak"))


def ledger(t) -> DataFrame:
    last = history.latest(queue.streaks(attempts(t), ["user_id"], "event_id"), ["user_id"], "event_id")
    result = F.when(F.col("outcome").isin("hard", "soft"), "FAILED").otherwise(F.col("outcome"))
    return last.select(
        F.col("user_id").cast("string").alias("url"), result.alias("last_result"), F.col("ts").alias("last_attempt"),
        F.when(F.col("outcome").isin("OK", "PENDING"), F.concat(F.lit("c"), F.col("event_id").cast("string"))).alias("capture"), F.col("streak").alias("consecutive_hard_failures"),
    )


_LEDGER = f"""WITH a AS (SELECT user_id, event_id, ts, {_OUTCOME} AS o FROM events),
i AS (SELECT *, sum(CASE WHEN o IN ('OK', 'PENDING') THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM a),
s AS (SELECT *, sum(CASE WHEN o = 'hard' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, i ORDER BY event_id) AS streak FROM i),
led AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1),
cand AS (SELECT c_custkey AS u, c_nationkey AS slug FROM customer),
st AS (SELECT slug, CAST(u AS VARCHAR) AS url, CASE WHEN o = 'PENDING' THEN 'pending' WHEN coalesce(streak, 0) >= 3 THEN 'blocked'
WHEN o IN ('hard', 'soft') AND epoch(TIMESTAMP '{NOW}') - floor(epoch(ts)) < 604800 THEN 'cooling' WHEN ts IS NOT NULL THEN 'due' ELSE 'fresh' END AS state FROM cand LEFT JOIN led ON u = user_id) """


def queued(t) -> DataFrame:
    c = t("customer").select(F.col("c_nationkey").alias("slug"), F.col("c_custkey").cast("string").alias("url"))
    return queue.queue(c, ledger(t), F.lit(NOW).cast("timestamp"))


@query(_LEDGER + "SELECT slug, url, state, CASE WHEN state IN ('fresh', 'due') THEN row_number() OVER (PARTITION BY state IN ('fresh', 'due') ORDER BY state = 'due', slug, url) END AS place FROM st")
def retry_queue(t):
    """Candidates by state, and the order in which a run takes them."""
    return queued(t).withColumn("place", F.col("place").cast("long"))


@query(_LEDGER + "SELECT slug, count(*) AS needed, count(*) FILTER (state = 'pending') AS pending, count(*) FILTER (state = 'blocked') AS blocked, count(*) FILTER (state = 'cooling') AS cooling, count(*) FILTER (state = 'due') AS due, count(*) FILTER (state = 'fresh') AS fresh FROM st GROUP BY 1")
def queue_totals(t):
    return queue.totals(queued(t), ["slug"])


@query(f"""
WITH a AS (SELECT user_id, event_id, {_OUTCOME} AS o FROM events),
w AS (SELECT *, coalesce(sum(CASE WHEN o = 'OK' THEN 1 ELSE 0 END) OVER p, 0) AS won, coalesce(sum(CASE WHEN o = 'SKIPPED' AND event_id % 5 = 0 THEN 1 ELSE 0 END) OVER p, 0) AS lost,
row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM a WINDOW p AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT user_id, event_id, o AS outcome FROM w WHERE won < 4 AND lost = 0 AND n <= 12""")
def budgeted_attempts(t):
    """Attempts until four successes, twelve attempts or an account fault."""
    fault = (F.col("outcome") == "SKIPPED") & (F.col("event_id") % 5 == 0)
    return queue.budgeted(attempts(t), ["user_id"], "event_id", 4, F.col("outcome") == "OK", fault).select("user_id", "event_id", "outcome")


@query("""
WITH h AS (SELECT user_id, event_id, left(sha256(CAST(event_id AS VARCHAR)), 16) AS h FROM events),
c AS (SELECT *, CASE WHEN event_id % 97 = 0 THEN 'broken' ELSE lag(h) OVER (PARTITION BY user_id ORDER BY event_id) END AS p FROM h)
SELECT user_id, event_id, p AS prev, lag(h) OVER (PARTITION BY user_id ORDER BY event_id) AS expected FROM c QUALIFY p IS DISTINCT FROM lag(h) OVER (PARTITION BY user_id ORDER BY event_id)""")
def chain_links(t):
    """Links of hash chains that don't name the entry before."""
    h = t("events").select("user_id", "event_id", T.body_hash(F.col("event_id").cast("string")).alias("h"))
    link = F.lag("h").over(Window.partitionBy("user_id").orderBy("event_id"))
    e = h.withColumn("prev", F.when(F.col("event_id") % 97 == 0, "broken").otherwise(link))
    return history.chain_breaks(e, "event_id", "h", "prev", ["user_id"]).select("user_id", "event_id", "prev", "expected")


@query(
    _LOG
    + """, ord AS (SELECT *, row_number() OVER (PARTITION BY slug, kind ORDER BY seq DESC) AS r FROM log WHERE capture IS NOT NULL)
SELECT n.slug, n.kind, n.hash, p.hash IS NULL OR p.hash <> n.hash OR coalesce(n.result = 'drift', false) AS stored, CASE WHEN p.hash IS NULL OR p.hash <> n.hash OR coalesce(n.result = 'drift', false) THEN p.capture END AS supersedes
FROM ord n LEFT JOIN ord p ON p.slug = n.slug AND p.kind = n.kind AND p.r = 2 WHERE n.r = 1"""
)
def retained_captures(t):
    """The newest capture of each key, retained against the history before it."""
    rows = log(t).where("capture is not null").withColumn("headers", F.array(F.col("kind")))
    new = history.latest(rows, ["slug", "kind"])
    before = rows.join(new.select("slug", "kind", F.col("seq").alias("last")), ["slug", "kind"]).where("seq < last").drop("last")
    return history.retain(new, before).select("slug", "kind", "hash", F.coalesce("stored", F.lit(False)).alias("stored"), "supersedes")


@query(
    _LOG
    + """, m AS (SELECT DISTINCT slug, capture, hash FROM log WHERE capture IS NOT NULL),
f AS (SELECT slug, CASE WHEN seq % 31 = 0 THEN 'x' || capture ELSE capture END AS capture, CASE WHEN seq % 17 = 0 THEN 'bad' ELSE hash END AS hash FROM log WHERE capture IS NOT NULL)
SELECT slug, capture, CASE WHEN f.hash IS NULL THEN 'missing' WHEN m.hash IS NULL THEN 'orphan' ELSE 'hash mismatch' END AS status FROM m FULL JOIN f USING (slug, capture) WHERE m.hash IS DISTINCT FROM f.hash"""
)
def store_verification(t):
    rows = log(t).withColumn("stored", F.lit(True))
    c = rows.where("capture is not null")
    f = c.select("slug", F.when(F.col("seq") % 31 == 0, F.concat(F.lit("x"), "capture")).otherwise(F.col("capture")).alias("capture"), F.when(F.col("seq") % 17 == 0, "bad").otherwise(F.col("hash")).alias("hash"))
    return history.verify_store(rows, f)


@query("""
SELECT o_custkey AS id, string_agg(CAST(l_orderkey AS VARCHAR) || '/' || l_linenumber, ',' ORDER BY l_shipdate, l_orderkey, l_linenumber) AS within FROM
(SELECT o_custkey, min(o_orderdate) AS a, min(o_orderdate) + INTERVAL 30 DAY AS b FROM orders GROUP BY 1) p JOIN lineitem ON l_shipdate BETWEEN a AND b GROUP BY 1""")
def commits_in_window(t):
    """Rows of a log within each key's window of days: a day's rows are listed once, and each different window joins the lists of its days."""
    spark = t("orders").sparkSession
    o = t("orders").groupBy(F.col("o_custkey").alias("id")).agg(F.min("o_orderdate").alias("a")).withColumn("b", F.expr("a + interval 30 days"))
    line = lambda x: F.concat(x["l_orderkey"].cast("string"), F.lit("/"), x["l_linenumber"].cast("string"))
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_orderkey", "l_linenumber"))), line), ",")
    days = t("lineitem").groupBy("l_shipdate").agg(lines.alias("lines")).withColumn("day", F.to_date("l_shipdate")).withColumn("size", F.length("lines"))
    path = scratch(spark, "days")
    days.write.parquet(path)
    days = spark.read.schema(days.schema).parquet(path)
    windows = o.select("a", "b").distinct().withColumn("day", F.explode(F.sequence(F.to_date("a"), F.to_date("b"))))
    j = windows.join(days, "day").where(F.col("l_shipdate").between(F.col("a"), F.col("b")))
    # A task lists and holds texts of WINDOW_BYTES, or one that is longer.
    parts = -(-(j.agg(F.sum("size")).first()[0] or 1) // WINDOW_BYTES)
    said = F.array_sort(F.collect_list(F.struct("l_shipdate", "lines")))
    within = j.select("a", "l_shipdate", "lines").repartition(parts, "a").groupBy("a").agg(F.array_join(F.transform(said, lambda x: x["lines"]), ",").alias("within"))
    long_rows(spark)
    # Keys stream past the texts in no order. Sorted by text, a writer of columns takes the repeats for small rows, keeps them by number, and has all of them to write out once it gives that up.
    return o.join(within.hint("shuffle_hash"), "a").select("id", "within")


# ---- comparison of captures


def halves(t) -> tuple[DataFrame, DataFrame]:
    """Two captures (n, body) of every document; the second has some respaced, longer or shorter, and each lacks a few that the other has."""
    d = t("documents").withColumn("n", F.col("doc_id"))
    k = F.col("n")
    old = d.where("n % 26 <> 0").select("n", F.col("text").alias("body"))
    new = d.where("n % 34 <> 0 or n % 26 = 0").select(
        "n",
        F.when(k % 6 == 0, F.replace("text", F.lit(" "), F.lit("  "))).when(k % 10 == 0, F.concat(F.col("text"), F.lit(" more"))).when(k % 14 == 0, F.substr("text", F.lit(1), F.length("text") - 2)).otherwise(F.col("text")).alias("body"),
    )
    return old, new


_HALVES = """WITH a AS (SELECT doc_id AS n, text AS body FROM documents WHERE doc_id % 26 <> 0),
b AS (SELECT doc_id AS n, CASE WHEN doc_id % 6 = 0 THEN replace(text, ' ', '  ') WHEN doc_id % 10 = 0 THEN text || ' more' WHEN doc_id % 14 = 0 THEN left(text, greatest(length(text) - 2, 0)) ELSE text END AS body FROM documents WHERE doc_id % 34 <> 0 OR doc_id % 26 = 0),
j AS (SELECT n, a.body AS x, b.body AS y, regexp_replace(a.body, '\\s+', '', 'g') AS p, regexp_replace(b.body, '\\s+', '', 'g') AS q FROM a FULL JOIN b USING (n)),
s AS (SELECT n, x, y, CASE WHEN y IS NULL THEN 'gone' WHEN x IS NULL THEN 'new' WHEN x = y THEN 'same' WHEN p = q THEN 'respaced' WHEN length(q) >= length(p) THEN 'grew' ELSE 'shrank' END AS state, length(p) AS lp, length(q) AS lq FROM j) """


@query(_HALVES + "SELECT n, state, CASE WHEN state IN ('grew', 'shrank') THEN lp END AS was, CASE WHEN state IN ('grew', 'shrank') THEN lq END AS now FROM s")
def source_compare(t):
    a, b = halves(t)
    return compare.compare(a, b, ["n"]).withColumns({"was": F.col("was").cast("long"), "now": F.col("now").cast("long")})


@query(
    _HALVES
    + """SELECT n, CASE WHEN state = 'gone' THEN 'source dropped' WHEN state = 'new' THEN 'source added' WHEN state IN ('grew', 'shrank') AND regexp_replace(lower(x), '[^a-z0-9]+', '', 'g') <> regexp_replace(lower(y), '[^a-z0-9]+', '', 'g') THEN 'text changed'
WHEN n % 11 = 0 THEN 'document moved' WHEN n % 4 = 0 THEN 'revision date changed' WHEN state IN ('grew', 'shrank') THEN 'recipe filter changed' ELSE 'extractor respacing' END AS verdict FROM s
WHERE state <> 'same' OR n % 11 = 0 OR n % 4 = 0"""
)
def verdict_ladder(t):
    """Why sources differ: headers move for every eleventh source and change their date for every fourth."""
    a, b = halves(t)
    head = lambda moved, dated: F.concat(F.lit("SOURCE 1: t | https://x.org/"), F.when(moved, "b").otherwise("a"), F.lit(" | source date: "), F.when(dated, "June").otherwise("May"), F.lit(" | retrieved: 2026-01-01"))
    no = F.lit(False)
    out = compare.classify(a.withColumn("header", head(no, no)), b.withColumn("header", head(F.col("n") % 11 == 0, F.col("n") % 4 == 0)), ["n"])
    return out.select("n", "verdict")


@query(
    """
WITH d AS (SELECT user_id, list(DISTINCT event_type) FILTER (event_id % 2 = 0) AS a, list(DISTINCT event_type) FILTER (event_id % 2 = 1) AS b FROM events GROUP BY 1)
SELECT user_id, array_to_string(list_sort(list_filter(coalesce(a, []), lambda x: NOT list_contains(coalesce(b, []), x))), ',') AS gone, array_to_string(list_sort(list_filter(coalesce(b, []), lambda x: NOT list_contains(coalesce(a, []), x))), ',') AS new,
array_to_string(list_sort(list_intersect(coalesce(a, []), coalesce(b, []))), ',') AS kept, len(list_distinct(list_concat(coalesce(a, []), coalesce(b, [])))) AS all_kinds FROM d"""
)
def header_changes(t):
    """Differences of two sets both ways, their intersection and union."""
    e = t("events")
    side = lambda k: F.collect_set(F.when(F.col("event_id") % 2 == k, F.col("event_type")))
    d = e.groupBy("user_id").agg(side(0).alias("a"), side(1).alias("b")).withColumn("c", compare.lost_and_new(F.col("a"), F.col("b")))
    text = lambda c: F.array_join(F.array_sort(c), ",")
    return d.select("user_id", text(F.col("c.gone")).alias("gone"), text(F.col("c.new")).alias("new"), text(F.array_intersect("a", "b")).alias("kept"), F.size(F.array_union("a", "b")).cast("long").alias("all_kinds"))


@query()
def similar_bodies(t):
    """Similarity of a document to its capture with words dropped, and the first four stretches of paragraphs that changed."""
    d = t("documents").select("doc_id", "text", F.regexp_replace("text", r"\bthe\b", "").alias("other"))
    pairs = d.where("text <> other").select("doc_id", patience.paragraphs("text").alias("old"), patience.paragraphs("other").alias("new"))
    changed = patience.stretches(pairs, "doc_id", "old", "new").groupBy("doc_id").agg(F.least(F.count("*"), F.lit(4)).cast("int").alias("n"))
    alike = d.select("doc_id", compare.similarity(T.squash("text"), T.squash("other")).alias("similarity"))
    return alike.join(changed, "doc_id", "left").select("doc_id", "similarity", F.coalesce("n", F.lit(0)).alias("segments"))


# ---- packets


_PACKET = """WITH p AS (SELECT conv_id, 'Captured text follows.' || chr(10) || 'STATE: ' || conv_id || chr(10) || 'ASSEMBLED: 2026-01-01' || chr(10) || 'CAPTURE NOTES:' || chr(10) ||
string_agg('SOURCE ' || turn || ': ' || role || ' | https://x.org/' || conv_id || ' | source date: none published | retrieved: 2026-01-01' || chr(10) || text || chr(10) || 'END SOURCE ' || turn || chr(10), '' ORDER BY turn) AS packet FROM conversations GROUP BY 1) """


def rendered(t) -> DataFrame:
    rows = t("conversations").select("conv_id", F.col("turn").alias("n"), F.col("role").alias("title"), F.concat(F.lit("https://x.org/"), F.col("conv_id").cast("string")).alias("url"), F.lit(None).cast("string").alias("source_date"), F.lit("2026-01-01").alias("retrieved"), F.col("text").alias("body"))
    return packets.render(rows, "conv_id", "2026-01-01")


@query(_PACKET + "SELECT conv_id, left(sha256(packet), 16) AS hash FROM p")
def packet_render(t):
    return rendered(t).select("conv_id", T.body_hash("packet").alias("hash"))


@query("SELECT conv_id, turn AS n, left(sha256(trim(text, chr(10))), 16) AS hash, role AS title, 'https://x.org/' || conv_id AS url FROM conversations")
def packet_parse_roundtrip(t):
    """Packets rendered from turns and read back, source by source."""
    s = packets.sources(rendered(t), "packet")
    f = compare.header_fields("header")
    return s.select("conv_id", F.col("n").cast("long").alias("n"), T.body_hash("body").alias("hash"), f["title"].alias("title"), f["url"].alias("url"))


@query("""SELECT conv_id, left(sha256(trim(regexp_replace(string_agg(chr(10) || text || chr(10) || 'END SOURCE ' || turn || chr(10), '' ORDER BY turn), '\\s+', ' ', 'g'))), 16) AS hash FROM conversations GROUP BY 1""")
def packet_hashes(t):
    """The hash of each packet's sources without header lines."""
    return rendered(t).select("conv_id", packets.packet_hash("packet").alias("hash"))


@query("SELECT conv_id, count(*) AS sources, 'https://x.org/' || conv_id AS first_url FROM conversations GROUP BY 1")
def packet_headers(t):
    return rendered(t).select("conv_id", F.size(packets.headers("packet")).cast("long").alias("sources"), F.get(packets.urls("packet"), 0).alias("first_url"))


@query(r"""
SELECT conv_id, left(sha256(string_agg('--- ' || turn || ' ---' || chr(10) || text, chr(10) ORDER BY turn)), 16) AS hash FROM conversations GROUP BY 1""")
def joined_pages(t):
    c = t("conversations").select("conv_id", "turn", F.col("turn").cast("string").alias("url"), "text")
    return packets.joined_pages(c, "conv_id", "turn", "url", "text").select("conv_id", T.body_hash("body").alias("hash"))


# ---- coverage


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def coverage_gaps(t):
    """Documents without labels."""
    return coverage.required_but_missing(t("documents").select("doc_id"), t("labels"), "doc_id")


@query("""
WITH s AS (SELECT user_id, event_type, max_by(CAST(floor(value / 20) AS BIGINT), event_id) AS v FROM events GROUP BY 1, 2)
SELECT user_id, string_agg(event_type || '=' || v, ',' ORDER BY event_type) AS said FROM s GROUP BY 1 HAVING count(DISTINCT v) > 1""")
def surface_disagreements(t):
    """Keys whose surfaces state different values."""
    s = t("events").groupBy("user_id", "event_type").agg(F.max_by(F.floor(F.col("value") / 20), "event_id").alias("v"))
    d = coverage.disagreements(s, "user_id", "event_type", "v")
    return d.select("user_id", F.array_join(F.transform("values", lambda x: F.concat(x["surface"], F.lit("="), x["value"].cast("string"))), ",").alias("said"))


@query("""
WITH h AS (SELECT DISTINCT user_id, event_id // 1000 AS part, event_type FROM events), k AS (SELECT DISTINCT user_id, part FROM h), n AS (SELECT unnest(['click', 'error', 'purchase', 'signup', 'view']) AS missing)
SELECT k.user_id, k.part, n.missing FROM k CROSS JOIN n WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.user_id = k.user_id AND h.part = k.part AND h.event_type = n.missing)""")
def surface_gaps(t):
    """Kinds that a key lacks in a stretch of the log in which it has another."""
    e = t("events").withColumn("key", F.struct("user_id", F.floor(F.col("event_id") / 1000).alias("part")))
    return coverage.gaps(e, "key", "event_type", ["click", "error", "purchase", "signup", "view"]).select("key.user_id", "key.part", "missing")


@query("""
SELECT r_name AS region, count(*) AS nations, count(*) FILTER (n > 0) AS covered, coalesce(CAST(sum(n) AS BIGINT), 0) AS suppliers FROM region JOIN nation ON n_regionkey = r_regionkey
LEFT JOIN (SELECT s_nationkey, count(*) AS n FROM supplier WHERE s_acctbal > 0 GROUP BY 1) s ON s_nationkey = n_nationkey GROUP BY 1""")
def status_rollup(t):
    """Every jurisdiction of the dimension, with or without facts."""
    s = t("supplier").where("s_acctbal > 0").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n"))
    d = coverage.keep_all(t("nation"), s, "n_nationkey").join(t("region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
    return d.groupBy(F.col("r_name").alias("region")).agg(F.count("*").alias("nations"), F.count_if(F.col("n") > 0).alias("covered"), F.coalesce(F.sum("n"), F.lit(0)).alias("suppliers"))


@query("""
SELECT source, count(*) AS required, count(l.doc_id) AS present, count(l.doc_id) / count(*) AS share FROM documents LEFT JOIN labels l USING (doc_id) GROUP BY 1""")
def coverage_ratio(t):
    return coverage.ratio(t("documents"), t("labels"), "doc_id", "source")


@query("""
WITH f AS (SELECT doc_id, CASE WHEN lower(text) LIKE '%the the%' THEN 'doubled' ELSE 'junk' END AS why FROM documents WHERE lower(text) LIKE '%the the%' OR text LIKE '%!!%')
SELECT count(*) FILTER (toxic = 1) AS soft, count(*) FILTER (coalesce(toxic, 0) <> 1) AS hard FROM f LEFT JOIN labels USING (doc_id)""")
def soft_and_hard(t):
    """Failures of exempt documents are soft."""
    low = F.lower("text")
    f = t("documents").where(F.contains(low, F.lit("the the")) | F.contains("text", F.lit("!!"))).select("doc_id")
    return coverage.totals(coverage.soft_or_hard(f, t("labels").where("toxic = 1"), "doc_id"))


# ---- JSON and dates


@query("SELECT CAST(json_extract_string(props, '$.k') AS INT) AS k, count(*) AS n FROM events GROUP BY 1")
def json_paths(t):
    return t("events").select(files.json_texts(F.col("props"), ["k"]).cast("int").alias("k")).groupBy("k").agg(F.count("*").alias("n"))


@query("SELECT event_id, unnest(json_keys(props)) AS name FROM events")
def json_map(t):
    m = F.from_json("props", "map<string,string>")
    return t("events").select("event_id", F.explode(F.map_keys(m)).alias("name"))


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%b ') || CAST(day(o_orderdate) AS VARCHAR) || strftime(o_orderdate, ', %Y') AS shown, CAST(CAST(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS first_day,
CAST(CAST(date_trunc('month', o_orderdate) - INTERVAL 1 DAY AS DATE) AS VARCHAR) AS last_day FROM orders""")
def dates_shown(t):
    first, last = D.previous_month(F.to_date("o_orderdate"))
    return t("orders").select("o_orderkey", D.display(F.to_date("o_orderdate").cast("string")).alias("shown"), first.cast("string").alias("first_day"), last.cast("string").alias("last_day"))


@query("SELECT (SELECT count(*) FROM pages) AS pages, (SELECT count(*) FROM documents) AS documents, (SELECT left(sha256(string_agg(r_name, '' ORDER BY r_name)), 12) FROM region) AS digest")
def code_digest(t):
    f = t("region").select(F.col("r_name").alias("path"), F.col("r_name").cast("binary").alias("content"))
    d = history.code_digest(f)
    return d.crossJoin(t("pages").agg(F.count("*").alias("pages"))).crossJoin(t("documents").agg(F.count("*").alias("documents"))).select("pages", "documents", "digest")


# ---- more of the log and of pairing


@query("""
WITH q AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n, CASE turn % 6 WHEN 0 THEN 'a' || conv_id || ':law:' || turn WHEN 1 THEN NULL WHEN 2 THEN 'Bad Id' WHEN 3 THEN 'b' || conv_id || ':law:1' WHEN 4 THEN 'a' || conv_id || ':law:999' ELSE 'a' || conv_id || ':law:0' END AS id
FROM (SELECT conv_id, 2 * turn + k AS turn, text FROM conversations, (SELECT unnest([0, 1]) AS k)) WHERE length(text) >= 15),
u AS (SELECT *, row_number() OVER (PARTITION BY conv_id, id ORDER BY n) AS uses FROM q)
SELECT conv_id, n, CASE WHEN id IS NULL THEN 'UNPAIRED' WHEN id = 'Bad Id' THEN 'MALFORMED' WHEN id LIKE 'b%' THEN 'CROSS-STATE' WHEN id LIKE '%:999' THEN 'UNKNOWN' WHEN uses > 1 THEN 'DUPLICATE' END AS verdict, id AS qid FROM u""")
def quote_pairs(t):
    """Pages that quote each turn of a conversation twice: the id that follows each quotation, and what is wrong with the pairing."""
    c = t("conversations").select("conv_id", F.explode(F.array(F.col("turn") * 2, F.col("turn") * 2 + 1)).alias("turn"), F.replace("text", F.lit('"'), F.lit("'")).alias("text"))
    c = c.withColumn("s", F.concat(F.lit("a"), F.col("conv_id").cast("string")))
    said = F.expr("case turn % 6 when 0 then concat('[[', s, ':law:', turn, ']]') when 1 then '' when 2 then '<i data-quote-id=\"Bad Id\">' when 3 then concat('[[b', substr(s, 2), ':law:1]]') when 4 then concat('[[', s, ':law:999]]') else concat('[[', s, ':law:0]]') end")
    said = F.when(F.length("text") >= 15, said).otherwise("")
    one = F.concat(F.lit('"'), "text", F.lit('" '), F.replace(said, F.lit('"'), F.lit("\u0001")), F.repeat(F.lit(" ."), F.lit(110)))
    pages = c.groupBy("conv_id", "s").agg(F.array_sort(F.collect_list(F.struct("turn", one.alias("x")))).alias("o")).withColumn("raw", F.array_join(F.transform("o", lambda x: x["x"]), "\n"))
    q = pages.select("conv_id", "s", "raw", F.explode(C.quotes("raw")).alias("q")).select("conv_id", "s", F.replace("raw", F.lit("\u0001"), F.lit('"')).alias("raw"), "q.pos", "q.text")
    index = c.where("turn % 6 in (0, 5)").select(F.when(F.col("turn") % 6 == 0, F.concat("s", F.lit(":law:"), F.col("turn").cast("string"))).otherwise(F.concat("s", F.lit(":law:0"))).alias("id"))
    n = F.row_number().over(Window.partitionBy("conv_id").orderBy("pos"))
    return fidelity.pair_quotes(q, index, "raw", "s").select("conv_id", n.cast("long").alias("n"), "verdict", "qid")


@query(
    _LOG
    + """, s AS (SELECT slug, seq % 4 AS n, seq, CAST(floor(value / 15) AS BIGINT) AS artifact, seq % 9 AS lines FROM log),
o AS (SELECT * FROM s WHERE seq % 8 < 4 QUALIFY row_number() OVER (PARTITION BY slug, n ORDER BY seq DESC) = 1), w AS (SELECT * FROM s WHERE seq % 8 >= 4 QUALIFY row_number() OVER (PARTITION BY slug, n ORDER BY seq DESC) = 1)
SELECT slug, n, o.lines AS was, w.lines AS now FROM o JOIN w USING (slug, n, artifact) WHERE w.lines < o.lines"""
)
def shrunk_sources(t):
    """Sources of the same artifact whose text got shorter between two captures."""
    s = log(t).select("slug", (F.col("seq") % 4).alias("n"), "seq", F.floor(F.col("value") / 15).alias("artifact"), (F.col("seq") % 9).alias("lines"))
    last = lambda w: history.latest(s.where(w), ["slug", "n"])
    return history.shorter_sources(last("seq % 8 < 4"), last("seq % 8 >= 4")).select("slug", "n", "was", "now")


@query("""
SELECT CAST(doc_id AS VARCHAR) AS path, CASE WHEN doc_id % 13 = 0 THEN 'missing' ELSE 'changed' END AS status FROM documents WHERE doc_id % 13 = 0 OR doc_id % 7 = 0""")
def manifest_changes(t):
    """Files of a manifest that are missing or differ in a tree."""
    d = t("documents").select("doc_id", F.col("doc_id").cast("string").alias("path"), F.sha2(F.col("text"), 256).alias("sha256"))
    lines = d.select(F.concat("sha256", F.lit("  "), "path").alias("value"))
    tree = d.where("doc_id % 13 <> 0").select("path", F.when(F.col("doc_id") % 7 == 0, F.sha2(F.col("path"), 256)).otherwise(F.col("sha256")).alias("sha256"))
    return history.manifest_status(history.manifest_lines(lines), tree)


@query("""
WITH l AS (SELECT user_id, event_id, 'curl, recipe ' || left(sha256(CAST(CAST(floor(value / 12) AS BIGINT) AS VARCHAR)), 12) || CASE WHEN event_id % 2 = 0 THEN ' by hand' ELSE '' END AS t, CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END AS bare FROM events),
p AS (SELECT *, CASE WHEN bare = 1 THEN 'by hand' ELSE t END AS x, lag(CASE WHEN bare = 1 THEN 'by hand' ELSE t END) OVER (PARTITION BY user_id ORDER BY event_id) AS y FROM l)
SELECT user_id, event_id, CASE WHEN x = y THEN true WHEN y IS NULL THEN false ELSE coalesce(nullif(regexp_extract(x, 'recipe ([0-9a-f]{12})', 1), '') = nullif(regexp_extract(y, 'recipe ([0-9a-f]{12})', 1), ''), false) END AS held FROM p""")
def methods_held(t):
    """Whether the capture method held since the key's row before: equal notes, or equal recipe digests."""
    note = F.concat(F.lit("curl, recipe "), F.substring(F.sha2(F.floor(F.col("value") / 12).cast("string"), 256), 1, 12), F.when(F.col("event_id") % 2 == 0, " by hand").otherwise(""))
    e = t("events").select("user_id", "event_id", F.when(F.col("event_id") % 11 == 0, "by hand").otherwise(note).alias("x"))
    e = e.withColumn("y", F.lag("x").over(Window.partitionBy("user_id").orderBy("event_id")))
    return e.select("user_id", "event_id", compare.method_held(F.col("y"), F.col("x")).alias("held"))


@query("""
SELECT event_type AS kind, user_id, n FROM (SELECT event_type, user_id, count(*) AS n, row_number() OVER (PARTITION BY event_type ORDER BY count(*) DESC, user_id) AS r FROM events GROUP BY 1, 2) WHERE r <= 3""")
def busiest_keys(t):
    """The three busiest keys of each kind: a top-k report."""
    return coverage.busiest(t("events"), "event_type", "user_id", 3).withColumnRenamed("event_type", "kind")


@query("""
WITH p AS (SELECT n_nationkey, n_name, row_number() OVER (ORDER BY n_name) - 1 AS place FROM nation) SELECT n_name, place FROM p WHERE (place - 23 + 25) % 25 < 4""")
def night_rotation(t):
    """A round robin's next four of the dimension, from its cursor around the end."""
    from veriloom.streaming.logs import night

    return night(t("nation").select("n_name"), "n_name", 4, 23).withColumn("place", F.col("place").cast("long"))


@query("""
SELECT page_id, 'www.h' || (page_id % 9) || '.org' AS host FROM pages WHERE page_id % 4 > 1 UNION ALL SELECT page_id, 'b.example:80' FROM pages WHERE page_id % 3 = 0""")
def hosts_unsupported(t):
    """Hosts that a page links to and its evidence names neither as they are nor without www; some are allowed."""
    link = F.expr("""concat('<a href="https://WWW.h', page_id % 9, '.org/x">[y](http://allowed.org/z) <a href="/local">', if(page_id % 3 = 0, '<a href="http://b.example:80">', ''))""")
    said = F.expr("case page_id % 4 when 0 then concat('at https://www.H', page_id % 9, '.org') when 1 then concat('see h', page_id % 9, '.org') else concat('h', page_id % 9, ' org') end")
    p = t("pages").select("page_id", link.alias("raw"), said.alias("body"))
    return fidelity.missing_hosts(p.select("page_id", "raw"), p.select("page_id", "body"), "page_id", allow=["allowed.org"]).withColumnRenamed("value", "host")


@query("""
SELECT slug, coalesce(a, 0) AS needed, coalesce(b, 0) AS recorded FROM (SELECT c_nationkey AS slug, count(*) AS a FROM customer GROUP BY 1) LEFT JOIN
(SELECT c_nationkey AS slug, count(*) AS b FROM customer WHERE c_custkey IN (SELECT user_id FROM events WHERE event_type = 'view') GROUP BY 1) USING (slug)""")
def recorded_links(t):
    """Links needed per key, and those that an attempt has captured."""
    c = t("customer").select(F.col("c_nationkey").alias("slug"), F.col("c_custkey").cast("string").alias("url"))
    led = t("events").where("event_type = 'view'").select(F.col("user_id").cast("string").alias("url"), F.lit("OK").alias("last_result"), F.lit("c").alias("capture")).distinct()
    done = queue.recordable(led, c).join(c, "url").groupBy("slug").agg(F.count("*").alias("b"))
    return c.groupBy("slug").agg(F.count("*").alias("needed")).join(done, "slug", "left").select("slug", "needed", F.coalesce("b", F.lit(0)).alias("recorded"))


# ---- the log as a stream


def retention_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log read as a file stream and retained with keyed state, in one run over what is there."""
    from veriloom.streaming.stateful import retained, rocksdb

    ship(spark)
    at = scratch(spark, "retention")
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    source = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    rows = log(lambda _: source).where("capture is not null")
    events = rows.select(F.col("slug").cast("string").alias("slug"), "kind", "seq", "hash", "result", "capture")
    with rocksdb(spark):
        retained(events).writeStream.outputMode("append").format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/log").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{at}/out").select(F.col("slug").cast("long").alias("slug"), "kind", "seq", "stored", "supersedes")


QUERIES["retention_stream"] = retention_stream
ORACLE_SQL["retention_stream"] = (
    _LOG
    + """, c AS (SELECT *, coalesce(hash <> lag(hash) OVER w OR result = 'drift', lag(hash) OVER w IS NULL OR coalesce(hash <> lag(hash) OVER w, false)) AS stored FROM log WHERE capture IS NOT NULL WINDOW w AS (PARTITION BY slug, kind ORDER BY seq))
SELECT slug, kind, seq, stored, CASE WHEN stored THEN last_value(CASE WHEN stored THEN capture END IGNORE NULLS) OVER (PARTITION BY slug, kind ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS supersedes FROM c"""
)
