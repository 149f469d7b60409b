"""More named queries: packets, recipes, gates, page writers and the whole-page verdict, each beside DuckDB SQL.

The tables hold few of the shapes that these operators look for, so each query first writes them into its input by a rule over
the keys; the SQL states what must come out, over all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from veriloom.functions import claims as C
from veriloom.functions import dates as D
from veriloom.functions import text as T
from veriloom.operators import compare, coverage, fidelity, gates, health, history, queue, ordered
from veriloom.plans.queries import _ENTITIES, _HALVES, _LEDGER, _LOG, ORACLE_SQL, QUERIES, halves, ledger, log, query, rendered
from veriloom.session import scratch
from veriloom.sources import files, html, packets, sinks

# ---- packets

_TOP = "'Captured text follows.' || chr(10) || 'STATE: ' || conv_id || chr(10) || 'ASSEMBLED: 2026-01-01' || chr(10) || 'CAPTURE NOTES:' || chr(10)"


@query(rf"""
SELECT conv_id, left(sha256({_TOP}), 16) AS header,
left(sha256(string_agg('SOURCE ' || turn || ': ' || role || ' | https://x.org/' || conv_id || ' | source date: none published | retrieved: 2026-01-01' || chr(10) || text || chr(10) || 'END SOURCE ' || turn || chr(10), '' ORDER BY turn)), 16) AS region,
left(sha256(string_agg(chr(10) || text || chr(10) || 'END SOURCE ' || turn || chr(10), '' ORDER BY turn)), 16) AS bodies FROM conversations GROUP BY 1""")
def packet_regions(t):
    """What is description, what is source, and what is source without header lines."""
    part = {"header": packets.header_part("packet"), "region": packets.source_region("packet"), "bodies": packets.source_bodies("packet")}
    return rendered(t).select("conv_id", *[T.body_hash(c).alias(k) for k, c in part.items()])


@query("SELECT conv_id, turn AS n, left(sha256(text || chr(10)), 16) AS hash FROM conversations")
def lenient_sources(t):
    return rendered(t).select("conv_id", F.explode(packets.lenient_bodies("packet")).alias("n", "body")).select("conv_id", F.col("n").cast("long").alias("n"), T.body_hash("body").alias("hash"))


@query("SELECT user_id, event_id % 5 AS n, 'sha256:' || left(sha256(CAST(max(event_id) AS VARCHAR)), 16) AS artifact FROM events GROUP BY 1, 2")
def packet_artifacts(t):
    """The artifact of each source by the capture notes; of notes that repeat a source the last counts."""
    note = F.concat(F.lit("- SOURCE "), (F.col("event_id") % 5).cast("string"), F.lit(": fetched, artifact sha256:"), T.body_hash(F.col("event_id").cast("string")))
    notes = t("events").groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", note.alias("x")))).alias("o"))
    raw = F.concat(F.lit("CAPTURE NOTES:\n"), F.array_join(F.transform("o", lambda x: x["x"]), "\n"), F.lit("\nSOURCE 1: a\nbody\n"))
    return notes.select("user_id", F.explode(packets.artifacts(raw)).alias("n", "artifact")).select("user_id", F.col("n").cast("long").alias("n"), "artifact")


_MARKED = "list_transform(string_split(text, '. '), lambda x, i: CASE WHEN i % 4 = 2 THEN '## ' || x ELSE x END)"


@query(rf"""
WITH l AS (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos FROM (SELECT doc_id, string_split(array_to_string({_MARKED}, chr(10)), chr(10)) AS l FROM documents)),
s AS (SELECT *, sum(CASE WHEN starts_with(line, '## ') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS section FROM l)
SELECT doc_id, CAST(section AS BIGINT) AS section, coalesce(max(substr(line, 4)) FILTER (starts_with(line, '## ')), '') AS heading, count(*) AS lines, min(pos) AS first_pos, left(sha256(string_agg(line, chr(10) ORDER BY pos)), 16) AS hash FROM s GROUP BY 1, 2""")
def page_sections(t):
    """Lines of Markdown pages by section."""
    md = F.expr("array_join(transform(split(text, '[.] ', -1), (x, i) -> if(i % 4 = 1, concat('## ', x), x)), '\\n')")
    s = packets.page_sections(t("documents").select("doc_id", md.alias("raw")), "doc_id")
    said = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "\n")
    g = s.groupBy("doc_id", F.col("section").cast("long").alias("section"), "heading")
    return g.agg(F.count("*").alias("lines"), F.min("pos").cast("long").alias("first_pos"), T.body_hash(said).alias("hash"))


@query("SELECT c_custkey, unnest(['Segment', 'Nation code']) AS field, unnest([c_mktsegment, CAST(c_nationkey AS VARCHAR) || ' *of* 25']) AS value FROM customer")
def docket_fields(t):
    md = F.concat(F.lit("# "), "c_name", F.lit("\n**Segment.** "), "c_mktsegment", F.lit("\ntext **Not. this**\n**Nation code.** "), F.col("c_nationkey").cast("string"), F.lit(" *of* 25\n"))
    return packets.docket(t("customer").select("c_custkey", md.alias("raw")), "c_custkey")


@query(r"""
SELECT conv_id, turn AS n, role AS title, 'https://x.org/' || conv_id || CASE turn % 3 WHEN 0 THEN '/a.PDF' WHEN 1 THEN '/b.docx' ELSE '/c' END AS url, CASE WHEN turn % 2 = 0 THEN 'June 2026' ELSE '' END AS source_date,
CASE turn % 3 WHEN 0 THEN 'pdftotext-layout' WHEN 1 THEN 'docx' ELSE 'html-text' END AS extractor FROM conversations""")
def drafted_sources(t):
    """Sources drafted from header lines."""
    url = F.expr("concat('https://x.org/', conv_id, case turn % 3 when 0 then '/a.PDF' when 1 then '/b.docx' else '/c' end)")
    head = F.concat(F.lit("SOURCE "), F.col("turn").cast("string"), F.lit(": "), "role", F.lit(" | "), url, F.when(F.col("turn") % 2 == 0, " | Source date: June 2026 | retrieved: 2026-01-01").otherwise(""))
    c = t("conversations").select("conv_id", head.alias("header"))
    return files.draft(c, keep=("conv_id",)).withColumn("n", F.col("n").cast("long"))


@query("""
SELECT lower(replace(n_name, '_', '-')) AS slug, k AS kind FROM nation, (SELECT unnest(['main', 'forms', 'es']) AS k) WHERE (k = 'main' OR (k = 'forms' AND n_nationkey % 2 = 0)) AND k <> 'es'""")
def packet_set(t):
    """Packet files by slug and kind: supplements belong to the set, another language doesn't."""
    s = F.lower(F.replace("n_name", F.lit("_"), F.lit("-")))
    names = F.expr("case when n_nationkey % 2 = 0 then array('-packet.txt', '-packet-forms.txt', '-packet-es.txt') else array('-packet.txt', '-packet-es.txt') end")
    n = t("nation").select(s.alias("s"), F.explode(names).alias("name"))
    f = n.select(F.concat(F.lit("packets/"), "s", "name").alias("path")).unionByName(t("region").select(F.lit("packets/TEMPLATE-packet.txt").alias("path")).distinct())
    return health.packet_set(f).select("slug", "kind")


@query("""
SELECT 'n' || n_nationkey AS slug, CASE n_nationkey % 4 WHEN 0 THEN 'a standing packet' ELSE 'a supplement' END AS error FROM nation WHERE n_nationkey % 4 IN (0, 1)""")
def review_errors(t):
    path = F.expr("case n_nationkey % 4 when 0 then concat('packets/n', n_nationkey, '-packet.txt') when 1 then concat('review/n', n_nationkey, '-packet-forms.txt') else concat('review/n', n_nationkey, '-packet.txt') end")
    return health.review_errors(t("nation").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("slug"), path.alias("path")), "packets").select("slug", "error")


@query("""
SELECT c_custkey, c_custkey % 3 = 0 AS archival, CASE WHEN c_custkey % 2 = 0 THEN 'north' ELSE chr(CAST(97 + c_custkey % 20 AS INT)) || 'b-c' END AS slug,
CASE WHEN c_custkey % 5 = 0 THEN '2020-01-01' ELSE '2026-01-' || lpad(CAST(1 + c_custkey % 28 AS VARCHAR), 2, '0') END AS assembled,
CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE left(sha256(CAST(c_custkey AS VARCHAR)), 12) END AS recipe FROM customer""")
def packet_facts(t):
    """Class, slug, assembly date and recipe digest of packets, from their heads and names."""
    raw = F.expr(r"""concat('Captured.\n', if(c_custkey % 2 = 0, 'slug: north \n', 'STATE: Two Words\n'), case c_custkey % 5 when 0 then '' when 1 then ' Assembly date 2026-01-' else 'ASSEMBLED: 2026-01-' end,
        if(c_custkey % 5 = 0, '', lpad(1 + c_custkey % 28, 2, '0')), '\n', if(c_custkey % 3 = 0, 'Class: Archival copy\n', 'class: live\n'), 'SOURCE 1: t\nslug: south\nASSEMBLED: 2020-01-01\n')""")
    path = F.expr("concat('h/', char(97 + c_custkey % 20), 'b-c-2026-01-02-x.txt')")
    noted = F.when(F.col("c_custkey") % 4 == 0, "curl by hand").otherwise(F.concat(F.lit("curl, recipe "), F.substring(F.sha2(F.col("c_custkey").cast("string"), 256), 1, 12)))
    c = t("customer").select("c_custkey", raw.alias("raw"), path.alias("path"), noted.alias("noted"))
    return c.select("c_custkey", packets.archival("raw").alias("archival"), packets.slug("raw", "path").alias("slug"), D.assembled("raw").alias("assembled"), packets.recipe_digest("noted").alias("recipe"))


# ---- sources


@query(r"""
SELECT doc_id, regexp_matches(text, '[\x{80}-\x{FF}]') AS lossy, left(sha256(text), 16) AS hash FROM (SELECT doc_id, regexp_replace(text, '[^\x{00}-\x{FF}]', '?', 'g') AS text FROM documents)""")
def decoded_texts(t):
    """Latin-1 bytes read as UTF-8 lose characters, read as Latin-1 they don't."""
    c = F.encode(F.regexp_replace("text", r"[^\x{00}-\x{FF}]", "?"), "ISO-8859-1")
    return t("documents").select("doc_id", files.decode(c)["lossy"].alias("lossy"), T.body_hash(files.decode(c, "ISO-8859-1")["text"]).alias("hash"))


@query("SELECT doc_id, left(sha256(source || chr(10) || chr(10) || text), 16) AS hash FROM documents")
def next_data(t):
    """Texts at paths of a page's data island."""
    data = F.to_json(F.struct(F.struct(F.col("source").alias("title"), F.array(F.lit("no"), F.col("text")).alias("parts")).alias("props")))
    page = F.concat(F.lit('<html><script>var x = 1;</script><script type="application/json" id="__NEXT_DATA__">'), F.replace(data, F.lit("</"), F.lit("<\\/")), F.lit("</script></html>"))
    return t("documents").select("doc_id", T.body_hash(files.next_data(page, ["props.title", "props.parts[1]"])).alias("hash"))


@query("SELECT event_id, 'a:' || chr(10) || '  [0]: ' || event_type || chr(10) || '  [1]: ' || (event_id % 3) || chr(10) || 'k: ' || json_extract_string(props, '$.k') AS lines FROM events")
def json_flattened(t):
    """JSON as indented lines, nulls and empty values left out."""
    doc = F.concat(F.lit('{"none": null, "a": ["'), "event_type", F.lit('", '), (F.col("event_id") % 3).cast("string"), F.lit('], "e": {}, "k": '), F.get_json_object("props", "$.k"), F.lit("}"))
    return t("events").select("event_id", html.flatten_json(doc).alias("lines"))


@query("SELECT event_id, sha256('{\"a\":\"' || event_type || '\",\"k\":' || json_extract_string(props, '$.k') || '}') AS digest FROM events")
def canonical_digests(t):
    """Digests of JSON that don't depend on blanks and the order of keys."""
    doc = F.concat(F.lit('{ "k" : '), F.get_json_object("props", "$.k"), F.lit(', "a": "'), "event_type", F.lit('"}'))
    return t("events").select("event_id", html.canonical_digest(doc).alias("digest"))


@query("SELECT doc_id, doc_id % 9 = 0 AS legacy, doc_id % 4 = 1 AS verified, 'sha256:' || left(sha256(coalesce(text, '')), 16) AS artifact FROM documents")
def artifact_bytes(t):
    """Old word processor files by their first bytes, PDF bytes against their digest, and artifact ids."""
    body = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    start, end = F.expr("if(doc_id % 9 = 0, X'D0CF11E0A1B11AE1', cast('%PDF-1.7' as binary))"), F.expr("if(doc_id % 4 = 2, cast('' as binary), cast('%%EOF' as binary))")
    pdf = F.concat(F.encode(F.lit("%PDF-1.4\n"), "UTF-8"), body, end)
    told = F.when(F.col("doc_id") % 4 == 3, F.sha2(body, 256)).when(F.col("doc_id") % 4 == 0, "").otherwise(F.upper(F.sha2(pdf, 256)))
    d = t("documents")
    return d.select("doc_id", files.legacy_doc(F.concat(start, body)).alias("legacy"), files.verified_bytes(pdf, told, pdf=True).alias("verified"), T.artifact_id(body).alias("artifact"))


_RULES = ["", "no sources", "no recipe_version", "source without n", "source without title", "neither url nor urls", "both url and urls", "url is not http", "unknown transport", "unknown extractor", "html-text without scope", "unknown filter", "pages begin at 1", "pages is a pair", "pages end before they begin", "pages without a PDF", "slice without from", "occurrences begin at 1", "urls can't be attended", "n occurs twice", "a url of urls is not http"]


@query(f"SELECT 's' || c_custkey AS state, ({_RULES!r})[CAST(1 + c_custkey % 21 AS INT)] AS error FROM customer WHERE c_custkey % 21 > 0".replace('"urls can\'t be attended"', "'urls can''t be attended'"))
def recipe_lint(t):
    """Recipes with one fault each, or none."""
    s = lambda **more: dict({"n": "1", "title": '"t"', "url": '"https://x.org"', "transport": '"curl"', "extractor": '"pdftotext-raw"'}, **more)
    pdf, page = s(), s(extractor='"html-text"', scope='"main"')
    faults = [
        pdf, None, pdf, s(n="null"), s(title='""'), s(url="null"), s(urls='["https://y.org"]'), s(url='"ftp://x"'), s(transport='"post"'), s(extractor='"ocr"'), s(extractor='"html-text"'),
        s(filters='["trim-lines", "shout"]'), s(pages="[0, 2]"), s(pages="[3]"), s(pages="[5, 2]"), page | {"pages": "[1, 2]"}, s(slice='{"to": "x"}'), s(slice='{"from": "a", "from_occurrence": 0}'), s(url="null", urls='["https://y.org", "https://z.org"]', attended="true"), None, s(url="null", urls='["https://y.org", "y.org"]'),
    ]
    text = lambda d: "{" + ", ".join(f'"{k}": {v}' for k, v in d.items() if v != "null") + "}"
    whole = ["" if d is None else text(d) for d in faults]
    whole[19] = text(pdf) + ", " + text(pdf)
    version = lambda k: "" if k == 2 else '"recipe_version": 1, '
    docs = F.array(*[F.lit(f'{{{version(k)}"sources": [{x}]}}') for k, x in enumerate(whole)])
    r = t("customer").select(F.concat(F.lit("s"), F.col("c_custkey").cast("string")).alias("state"), F.from_json(F.get(docs, (F.col("c_custkey") % 21).cast("int")), files.RECIPE).alias("r"))
    return files.lint(r.select("state", "r.recipe_version", "r.sources")).select("state", "error")


@query("SELECT n_name AS url, CASE WHEN n_nationkey % 3 = 0 THEN 'PENDING' ELSE 'OK' END AS last_result, n_nationkey AS attempts, CASE WHEN n_nationkey % 2 = 0 THEN 'c\"' || n_nationkey END AS capture FROM nation")
def ledger_round_trip(t):
    """A ledger of a few links written as one JSON text and read back."""
    n = t("nation").select(
        F.col("n_name").alias("url"), F.when(F.col("n_nationkey") % 3 == 0, "PENDING").otherwise("OK").alias("last_result"), F.col("n_nationkey").alias("attempts"),
        F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit('c"'), F.col("n_nationkey").cast("string"))).alias("capture"),
    )
    return files.ledger(sinks.ledger_json(n), "json").select("url", "last_result", "attempts", "capture")


@query("SELECT 'n' || n_nationkey AS slug, n_name AS name, CASE WHEN n_regionkey > 1 THEN n_regionkey END AS region FROM nation")
def appended_rows(t):
    """Rows appended in two goes as JSON lines by slug, nulls left out, and read back."""
    n = t("nation").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("slug"), F.col("n_name").alias("name"), F.when(F.col("n_regionkey") > 1, F.col("n_regionkey")).alias("region"))
    path = scratch(n.sparkSession, "appended")
    for part in (n.where("name < 'NATION_2'"), n.where("name >= 'NATION_2'")):
        sinks.append_rows(part, path)
    return n.sparkSession.read.schema("name string, region int, slug string").json(path).select("slug", "name", "region")


# ---- history


@query(_LOG + "SELECT slug, kind, capture, hash FROM log WHERE result IN ('confirmed', 'rebuild', 'accepted') QUALIFY row_number() OVER (PARTITION BY slug, kind ORDER BY seq DESC) = 1")
def promoted_captures(t):
    return history.promote(log(t)).select("slug", "kind", "capture", "hash")


@query("SELECT c_custkey AS slug FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)")
def backfilled(t):
    """Standing packets without a history."""
    return history.backfill(t("customer").select(F.col("c_custkey").alias("slug")), log(t)).select("slug")


@query(
    _LOG
    + """, c AS (SELECT *, lag(capture) OVER (PARTITION BY slug, kind ORDER BY seq) AS supersedes, CASE WHEN seq % 4 > 0 THEN 'by ' || (seq % 5) ELSE '' END AS transport FROM log WHERE capture IS NOT NULL),
f AS (SELECT slug, capture, max_by(transport, seq) AS t, min_by(date, seq) AS d FROM c GROUP BY 1, 2)
SELECT c.slug, c.date, c.kind, c.capture, c.supersedes, n.t AS now, w.t AS was, w.d AS old_date FROM c LEFT JOIN f n ON n.slug = c.slug AND n.capture = c.capture LEFT JOIN f w ON w.slug = c.slug AND w.capture = c.supersedes
WHERE c.result = 'drift' AND c.date BETWEEN '2024-01-04' AND '2024-01-25'"""
)
def drift_pairs(t):
    """Drifts of a window beside what they superseded."""
    w = Window.partitionBy("slug", "kind").orderBy("seq")
    rows = log(t).where("capture is not null").withColumn("supersedes", F.lag("capture").over(w)).withColumn("transport", F.when(F.col("seq") % 4 > 0, F.concat(F.lit("by "), (F.col("seq") % 5).cast("string"))))
    return history.drift_pairs(rows, "2024-01-04", "2024-01-25")


@query(_LOG + "SELECT slug, seq, result FROM log WHERE result IS NULL")
def unknown_results(t):
    return history.unknown_results(log(t))


@query("""
SELECT c_custkey AS slug, '2026-01-02' || CASE WHEN c_custkey % 30 = 0 THEN '' ELSE '-' || chr(CAST(97 + c_custkey % 30 AS INT)) END || '.txt' AS capture FROM customer""")
def free_names(t):
    """Names of new captures on days that have some already, beyond the alphabet too."""
    c = t("customer").select(F.col("c_custkey").alias("slug"), F.lit("main").alias("kind"), F.lit("2026-01-02").alias("date"), F.lit("drift").alias("result"), F.lit("h").alias("hash"), F.array(F.lit("x")).alias("headers"))
    taken = F.transform(F.sequence(F.lit(0), F.col("slug") % 30), lambda i: F.struct(i.alias("seq"), F.when(i == 1, "2026-01-02.txt").otherwise(F.concat(F.lit("2026-01-02-"), F.chr(i + 96), F.lit(".txt"))).alias("capture")))
    old = c.where("slug % 30 > 0").select("slug", "kind", "hash", "headers", "result", F.explode(F.filter(taken, lambda x: x["seq"] > 0)).alias("o")).select("slug", "kind", "hash", "headers", "result", "o.seq", "o.capture")
    return history.retain(c, old).select("slug", "capture")


@query("""
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders), p AS (SELECT c_custkey AS id, DATE '1995-01-01' + CAST(c_custkey % 900 AS INT) AS a, DATE '1995-01-01' + CAST(c_custkey % 900 + c_custkey % 7 - 1 AS INT) AS b FROM customer),
j AS (SELECT id, list(left(sha256(CAST(d AS VARCHAR)), 7) ORDER BY d) FILTER (d IS NOT NULL) AS h FROM p LEFT JOIN d ON d BETWEEN a AND b GROUP BY 1)
SELECT id, CASE id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'changed: ' || left(sha256('a'), 12) || ' -> ' || left(sha256('b'), 12) ELSE
CASE WHEN len(coalesce(h, [])) > 0 THEN 'committed: ' || array_to_string(h[1:4], ', ') || CASE WHEN len(h) > 4 THEN ' and ' || (len(h) - 4) || ' more' ELSE '' END END END AS code_changed FROM j""")
def code_changes(t):
    """Whether the capture code changed between two captures: by their stamps, else by commits between their days."""
    stamp = lambda x: F.concat(F.lit("- Capture code "), F.substring(F.sha2(F.lit(x), 256), 1, 12), F.lit(" of today\nSOURCE 1: t\n- Capture code ffffffffffff x"))
    k, none = F.col("id") % 4, F.lit("no notes\nSOURCE 1: t")
    p = t("customer").select(F.col("c_custkey").alias("id")).select(
        "id", F.when(k < 2, stamp("a")).otherwise(none).alias("old_raw"), F.when(k == 0, stamp("a")).when(k == 1, stamp("b")).otherwise(none).alias("new_raw"),
        F.expr("date_add(date'1995-01-01', cast(id % 900 as int))").alias("since"), F.expr("date_add(date'1995-01-01', cast(id % 900 + id % 7 - 1 as int))").alias("until"),
    )
    commits = t("orders").select(F.to_date("o_orderdate").alias("date")).distinct().withColumn("hash", F.substring(F.sha2(F.col("date").cast("string"), 256), 1, 7))
    return compare.code_change(p, commits)


@query("""
SELECT 'e' || row_number() OVER (ORDER BY r_name) AS place, sha256(m) AS manifest_sha256, sha256('{"file_count":5,"id":"r1","manifest_file":"manifests/r1.txt","manifest_sha256":"' || sha256(m) || '","note":"n","paths":["region"],"prev_entry_sha256":null,"repo":"veriloom","utc":"2026-01-01T00:00:00Z"}') AS entry_sha256
FROM (SELECT min(r_name) AS r_name, string_agg(sha256('region ' || r_name) || '  ' || r_name || chr(10), '' ORDER BY r_name) AS m FROM region)""")
def anchor_entry(t):
    """The entry of a hash chain over a few files."""
    f = t("region").select(F.col("r_name").alias("path"), F.encode(F.concat(F.lit("region "), "r_name"), "UTF-8").alias("content"))
    e = sinks.anchor_entry(f, None, "r1", "2026-01-01T00:00:00Z", "veriloom", ["region"], "n")
    return e.select(F.lit("e1").alias("place"), F.sha2("manifest", 256).alias("manifest_sha256"), "entry_sha256")


# ---- comparison


@query(_HALVES + "SELECT n // 3 AS key, bool_or(state IN ('gone', 'shrank')) AS needs_review FROM s GROUP BY 1")
def review_needed(t):
    """Groups of three sources of which any is gone or shrank."""
    return compare.needs_review(compare.compare(*halves(t), ["n"]).withColumn("key", F.floor(F.col("n") / 3)), "key")


_VERDICT = """CASE WHEN state = 'gone' THEN 'source dropped' WHEN state = 'new' THEN 'source added' WHEN state IN ('grew', 'shrank') AND regexp_replace(lower(x), '[^a-z0-9]+', '', 'g') <> regexp_replace(lower(y), '[^a-z0-9]+', '', 'g') THEN 'text changed'
WHEN n % 11 = 0 THEN 'document moved' WHEN n % 4 = 0 THEN 'revision date changed' WHEN state IN ('grew', 'shrank') THEN 'recipe filter changed' ELSE 'extractor respacing' END"""
_ORDERED = "['document moved', 'revision date changed', 'text changed', 'source dropped', 'source added', 'recipe filter changed', 'extractor respacing']"


@query(_HALVES + f""", v AS (SELECT n % 50 AS key, {_VERDICT} AS v FROM s WHERE state <> 'same' OR n % 11 = 0 OR n % 4 = 0)
SELECT key, array_to_string(list_filter({_ORDERED}, lambda x: list_contains(l, x)), '|') AS verdicts, len(list_filter(l, lambda x: x NOT IN ('recipe filter changed', 'extractor respacing'))) > 0 AS publishable FROM (SELECT key, list(DISTINCT v) AS l FROM v GROUP BY 1)""")
def verdict_sets(t):
    """The verdicts of groups of sources, in their order, and whether any is to be published."""
    a, b = halves(t)
    head = lambda moved, dated: F.concat(F.lit("SOURCE 1: t | https://x.org/"), F.when(moved, "b").otherwise("a"), F.lit(" | source date: "), F.when(dated, "June").otherwise("May"))
    no = F.lit(False)
    out = compare.classify(a.withColumn("header", head(no, no)), b.withColumn("header", head(F.col("n") % 11 == 0, F.col("n") % 4 == 0)), ["n"])
    return compare.verdict_sets(out.withColumn("key", F.col("n") % 50), "key").withColumn("verdicts", F.array_join("verdicts", "|"))


# ---- claims


@query("""
WITH a AS (SELECT DISTINCT source, 'user' || (doc_id % 37) || '@mail.org' AS value FROM documents WHERE doc_id % 2 = 1), b AS (SELECT DISTINCT source, 'user' || (doc_id % 50) || '@mail.org' AS value FROM documents WHERE doc_id % 2 = 0),
p AS (SELECT source, regexp_replace(lower(unnest(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}'))), '\\.+$', '') AS value, doc_id % 2 AS k FROM documents)
SELECT * FROM (SELECT * FROM a UNION SELECT source, value FROM p WHERE k = 1) WHERE value <> 'user7@mail.org' EXCEPT (SELECT * FROM b UNION SELECT source, value FROM p WHERE k = 0)""")
def missing_emails(t):
    """Addresses that a source's odd documents state and its even ones don't; one is allowed."""
    d = t("documents")
    of = lambda k, n: fidelity.explode_values(d.where(f"doc_id % 2 = {k}"), "source", C.emails(F.concat(F.coalesce("text", F.lit("")), F.lit("\nUser"), (F.col("doc_id") % n).cast("string"), F.lit("@Mail.org."))))
    return fidelity.missing_values(of(1, 37), of(0, 50), "source", allow=["user7@mail.org"])


@query("SELECT s_suppkey AS slug, (s_suppkey + 100) || ' old mill road' AS value FROM supplier WHERE s_suppkey % 4 > 1 UNION ALL SELECT s_suppkey, 'p.o. box ' || s_suppkey FROM supplier WHERE s_suppkey % 4 > 0")
def missing_addresses(t):
    """Postal addresses that evidence states neither as they are nor run together; part of a longer number doesn't count."""
    n, k = (F.col("s_suppkey") + 100).cast("string"), F.col("s_suppkey") % 4
    page = F.concat(F.lit("Write to "), n, F.lit(" Old Mill Road, or P.O. Box "), F.col("s_suppkey").cast("string"), F.lit("."))
    said = F.when(k == 0, page).when(k == 1, F.concat(F.lit("Hall"), n, F.lit("Old MillRoadTown"))).when(k == 2, F.concat(F.lit("at 9"), n, F.lit(" Old Mill Road"))).otherwise(F.lit("nothing"))
    p = t("supplier").select(F.col("s_suppkey").alias("slug"), page.alias("raw"), said.alias("body"))
    return fidelity.missing_addresses(p.select("slug", "raw"), p.select("slug", "body"))


@query("""
SELECT doc_id, CASE WHEN doc_id % 5 = 4 THEN length(text) + 3 ELSE length(text) + 1 END AS live FROM documents WHERE text IS NOT NULL""")
def live_parts(t):
    """How much of a page stands before its change log, in each way of heading one."""
    log_ = F.expr(r"""case doc_id % 5 when 0 then '\n<div class="section-no">04</div> log <h2>Change log</h2>' when 1 then '\n## 04 · Change log\nold' when 2 then '\n## Revision history of this page\n' when 3 then '\n<h2> Change log </h2>' else '\n##' end""")
    return t("documents").where("text is not null").select("doc_id", F.length(C.live_part(F.concat("text", log_))).cast("long").alias("live"))


@query("""
SELECT page_id, href FROM (SELECT DISTINCT page_id, """ + _ENTITIES.format(x="unnest(regexp_extract_all(html || '<a href=\"https://web.archive.org/web/2026/http://gone.example/' || page_id || '\">', 'href=\"([^\"]+)\"', 1))") + """ AS href FROM pages
UNION SELECT page_id, 'http://gone.example/' || page_id FROM pages WHERE page_id % 2 = 0 UNION SELECT page_id, 'https://kept.example/' || page_id FROM pages)
WHERE regexp_matches(href, '^https?://') AND NOT contains(href, 'web.archive.org') AND href <> 'http://gone.example/' || page_id""")
def links_to_capture(t):
    """External links of pages that have no capture on the page."""
    more = F.expr("""concat('<a href="https://web.archive.org/web/2026/http://gone.example/', page_id, '">', if(page_id % 2 = 0, concat('<a href="http://gone.example/', page_id, '">'), ''), '[x](https://kept.example/', page_id, ')')""")
    p = t("pages").select("page_id", F.concat("html", more).alias("html"))
    return sinks.needed_links(p, key="page_id").withColumnRenamed("url", "href")


_SAID = "conv_id, turn, coalesce(replace(text, '\"', ''''), '') AS x"


@query(rf"""
WITH c AS (SELECT {_SAID}, 's' || conv_id AS slug FROM conversations), es AS (SELECT *, conv_id % 2 = 1 AS es FROM c),
e AS (SELECT conv_id, string_agg(x, chr(10) ORDER BY turn) AS body FROM c WHERE turn % 4 <> 2 GROUP BY 1),
first AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn % 6 ORDER BY turn) AS r FROM es WHERE length(x) >= 15),
k AS (SELECT DISTINCT conv_id, slug, es FROM es)
SELECT DISTINCT slug, 'QUOTE' AS tag, left(x, 80) AS detail FROM es LEFT JOIN e USING (conv_id) WHERE length(x) >= 15 AND NOT coalesce(contains(regexp_replace(body, '\s+', ' ', 'g'), trim(regexp_replace(x, '\s+', ' ', 'g'))), false)
UNION ALL SELECT slug, 'PHONE', '555010' || lpad(CAST(conv_id % 10000 AS VARCHAR), 4, '0') FROM k WHERE conv_id % 3 = 0
UNION ALL SELECT slug, 'PHONE', '5550201234' FROM k WHERE conv_id % 5 = 1
UNION ALL SELECT slug, 'EMAIL', 'a' || conv_id || '@x.org' FROM k WHERE conv_id % 3 = 1
UNION ALL SELECT slug, 'EMAIL', 'm@x.org' FROM k WHERE conv_id % 5 = 2
UNION ALL SELECT slug, 'ADDRESS', (conv_id + 10) || ' elm street' FROM k WHERE conv_id % 3 = 2
UNION ALL SELECT slug, 'HOSTNAME', 'www.other' || (conv_id % 4) || '.org' FROM k WHERE conv_id % 4 > 0
UNION ALL SELECT slug, 'PACKET', 'page ' || conv_id || ' was not captured' FROM k WHERE conv_id % 7 = 0
UNION ALL SELECT slug, 'ADVISORY', 'we advise' FROM k WHERE NOT es AND conv_id % 3 = 0
UNION ALL SELECT DISTINCT slug, 'UNPAIRED', left(x, 70) FROM first WHERE es AND turn % 6 = 1
UNION ALL SELECT DISTINCT slug, 'MALFORMED', 'Bad Id' FROM first WHERE es AND turn % 6 = 2
UNION ALL SELECT DISTINCT slug, 'CROSS-STATE', 'other:law:1' FROM first WHERE es AND turn % 6 = 3
UNION ALL SELECT DISTINCT slug, 'UNKNOWN', slug || ':law:999' FROM first WHERE es AND turn % 6 = 4
UNION ALL SELECT DISTINCT slug, 'DUPLICATE', slug || ':law:0' FROM first WHERE es AND turn % 6 IN (0, 5) AND (SELECT count(*) FROM first f WHERE f.conv_id = first.conv_id AND f.turn % 6 IN (0, 5)) > 1""")
def fidelity_verdicts(t):
    """Everything that is unsupported on pages of conversations: quotations, contact facts, hosts, advice, captured notes and, on every second page, quote ids."""
    return fidelity.check(*_fidelity(t))


@query("SELECT DISTINCT 's' || conv_id AS slug, 'INDEX' AS tag, 'there is no quote index' AS detail FROM conversations WHERE conv_id % 2 = 1")
def fidelity_without_index(t):
    """Pages of another language, checked where there is no quote index: no id of theirs is unknown, and each page says that the index is missing."""
    pages, known, _ = _fidelity(t)
    return fidelity.check(pages, known).where("tag in ('INDEX', 'UNKNOWN')")


def _fidelity(t) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pages that quote all turns and state facts by a rule, packets of three turns in four, and a quote index of one id a page."""
    c = t("conversations").select("conv_id", "turn", F.coalesce(F.replace("text", F.lit('"'), F.lit("'")), F.lit("")).alias("x")).withColumn("slug", F.concat(F.lit("s"), F.col("conv_id").cast("string")))
    mark = F.expr("case turn % 6 when 1 then '' when 2 then '[data-quote-id=\"Bad Id\"]' when 3 then '[[other:law:1]]' when 4 then concat('[[', slug, ':law:999]]') else concat('[[', slug, ':law:0]]') end")
    said = F.concat(F.lit('It says "'), "x", F.lit('" '), F.when((F.col("conv_id") % 2 == 1) & (F.length("x") >= 15), mark).otherwise(""), F.repeat(F.lit(" ."), F.lit(110)))
    facts = F.expr(r"""concat('<p>', if(conv_id % 3 = 0, concat('Call 555-010-', lpad(conv_id % 10000, 4, '0'), '. We advise it. '), ''), if(conv_id % 5 = 1, '<a href="tel:1-555-020-1234">call</a> ', ''), 'Call 555-999-0000. ',
        if(conv_id % 3 = 1, concat('Mail A', conv_id, '@x.org. '), ''), if(conv_id % 5 = 2, '<a href="mailto:m@x.org?subject=s">mail</a> ', ''), if(conv_id % 3 = 2, concat('At ', conv_id + 10, ' Elm Street. '), ''),
        '<a href="https://www.other', conv_id % 4, '.org/555-030-9999.pdf">x</a><!-- search-head --><b>"a quotation that no packet holds, ever"</b><!-- /search-head --></p>')""")
    rows = c.groupBy("conv_id", "slug").agg(F.array_sort(F.collect_list(F.struct("turn", said.alias("s")))).alias("q"))
    tail = F.lit('\n## 04 Change log\nIt said "something that no source says any more".')
    # Text of the facts comes first, so that quotation marks pair up.
    pages = rows.select("slug", F.when(F.col("conv_id") % 2 == 1, "es").alias("lang"), F.concat(facts, F.array_join(F.transform("q", lambda q: q["s"]), "\n"), tail).alias("raw"))
    src = c.where("turn % 4 <> 2").groupBy("conv_id", "slug").agg(F.array_sort(F.collect_list(F.struct("turn", "x"))).alias("b"))
    note = F.when(F.col("conv_id") % 7 == 0, F.concat(F.lit("[page "), F.col("conv_id").cast("string"), F.lit(" was not captured]\n"))).otherwise("")
    body = F.concat(
        F.lit("Notes say: 555-010-0000 [this note was not captured]\nSOURCE 1: t | https://other0.org/ | source date: none\n"), note, F.lit("Phone (555) 999 0000\n"), F.array_join(F.transform("b", lambda b: b["x"]), "\n"), F.lit("\nEND SOURCE 1\n")
    )
    # A page's packet stands even where no turn is in it.
    every = rows.select("conv_id", "slug").join(src, ["conv_id", "slug"], "left").withColumn("b", F.coalesce("b", F.array()))
    return pages, every.select("slug", F.lit("p").alias("path"), body.alias("body")), c.select(F.concat("slug", F.lit(":law:0")).alias("id"), F.col("slug").alias("state"), F.lit(True).alias("in_scope")).distinct()


@query(rf"""
WITH c AS (SELECT {_SAID} FROM conversations) SELECT 's' || conv_id AS slug, CAST(max(CASE WHEN length(x) >= 15 AND turn % 6 IN (0, 5) THEN 1 ELSE 0 END) AS BIGINT) AS paired, 1 AS in_scope FROM c WHERE conv_id % 2 = 1 GROUP BY 1""")
def fidelity_coverage(t):
    """How many of the index's spans pages of another language carry."""
    pages, _, index = _fidelity(t)
    return fidelity.coverage(pages, index).withColumn("paired", F.col("paired").cast("long"))


@query("SELECT 'n' || n_nationkey || ':law:1' AS id, 'n' || n_nationkey AS state, n_nationkey % 2 = 0 AS in_scope FROM nation")
def quote_index(t):
    """An index of JSON lines, some blank, some repeated."""
    line = F.expr("""concat('{"id": "n', n_nationkey, ':law:1", "state": "n', n_nationkey, '", "in_scope": ', if(n_nationkey % 2 = 0, 'true', 'false'), '}')""")
    n = t("nation").select(F.explode(F.array(line, F.lit("  "), line)).alias("value"))
    return fidelity.quote_index(n).select("id", "state", "in_scope")


# ---- gates


@query("""
SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'no skip link' WHEN 1 THEN 'no id="main"' WHEN 2 THEN 'the skip link leads nowhere' END AS detail FROM pages WHERE page_id % 5 < 3""")
def skip_links(t):
    head = F.expr("""case page_id % 5 when 0 then '<main id="main">' when 1 then '<a class="skip-link" href="#x">' when 2 then '<a class="skip-link" href="#other"><i id="main">' else '<a href="#main" class="a skip-link"><main id="main">' end""")
    p = t("pages").select("page_id", F.concat(head, F.replace("html", F.lit('id="'), F.lit('ref="'))).alias("html"))
    return gates.skip_links(p, "page_id").select(F.col("page").alias("page_id"), "detail")


@query("""
SELECT doc_id, ext FROM (SELECT doc_id, ['tmp', 'html', 'orig', 'PDF', '', 'toml', 'bak', 'swp'][CAST(1 + doc_id % 8 AS INT)] AS ext FROM documents) WHERE ext IN ('tmp', 'orig', 'PDF', '', 'bak', 'swp') AND NOT (ext = 'bak' AND doc_id % 3 = 0) AND NOT (ext = 'swp' AND doc_id % 3 = 0)""")
def stray_files(t):
    """Files of a kind that isn't published, but for what is named or lies in folders that are left out."""
    k = (F.col("doc_id") % 8).cast("int")
    ext = F.get(F.array(*[F.lit(x) for x in ("tmp", "html", "orig", "PDF", "", "toml", "bak", "swp")]), k)
    name = F.expr("case cast(doc_id % 8 as int) when 4 then concat('LICENSES', doc_id) when 5 then 'wrangler.toml' when 6 then if(doc_id % 3 = 0, 'a/kept.bak', concat('a/', doc_id, '.bak')) when 7 then concat(if(doc_id % 3 = 0, 'x/node_modules/', 'x/modules/'), doc_id, '.swp') else null end")
    f = t("documents").select("doc_id", ext.alias("ext"), F.coalesce(name, F.concat(F.lit("./p/"), F.col("doc_id").cast("string"), F.lit("."), ext)).alias("path"))
    found = gates.stray_files(f.select(F.concat("path", F.lit("")).alias("path")).distinct(), ["a/kept.bak"])
    return f.join(found.select(F.col("page").alias("path")), "path").select("doc_id", "ext")


@query("""
SELECT page_id, m AS detail FROM pages, (SELECT unnest(['<!-- A:BEGIN -->', '<!-- A:END -->']) AS m) WHERE page_id % 3 = 0 OR (page_id % 3 = 1 AND m = '<!-- A:END -->')""")
def missing_markers(t):
    tail = F.expr("case page_id % 3 when 0 then '' when 1 then '<!-- A:BEGIN -->' else '<!-- A:BEGIN --><!-- A:END -->' end")
    p = t("pages").select("page_id", F.concat("html", tail).alias("html"))
    return gates.missing_markers(p, ["<!-- A:BEGIN -->", "<!-- A:END -->"], "page_id").select(F.col("page").alias("page_id"), "detail")


@query("SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'not committed' WHEN 1 THEN 'no longer derived' ELSE 'differs' END AS detail, page_id % 6 < 3 AND page_id % 6 <> 1 AS stale FROM pages WHERE page_id % 6 < 3")
def current_files(t):
    """Generated files against committed ones, and pages against a fresh rendering."""
    p = t("pages").select(F.col("page_id").alias("path"), "html")
    old = p.where("path % 6 <> 0").select("path", F.when(F.col("path") % 6 == 2, "old").otherwise(F.col("html")).alias("content"))
    new = p.where("path % 6 <> 1").select("path", F.col("html").alias("content"))
    found = gates.not_current(old, new, "picker").select(F.col("page").alias("page_id"), "detail")
    rendered_ = gates.stale_renders(new.withColumnRenamed("content", "html"), old.withColumnRenamed("content", "html"))
    return found.join(rendered_.select(F.col("page").alias("page_id"), F.lit(True).alias("stale")), "page_id", "left").withColumn("stale", F.coalesce("stale", F.lit(False)))


@query("SELECT 'ignored' AS gate, unnest(['wrangler.toml', '.wrangler']) AS detail")
def ignore_gaps(t):
    lines = t("region").select(F.when(F.col("r_regionkey") == 0, ".assetsignore").when(F.col("r_regionkey") == 1, "predeploy-check.sh").otherwise("*.tmp").alias("value"))
    return gates.ignore_gaps(lines).select("gate", "detail")


_HEX = "lpad(hex((CAST({k} AS BIGINT) * 7919 + 4242) * 104729 % 16777216), 6, '0')"
_LUM = "list_sum(list_transform([[1, 0.2126], [3, 0.7152], [5, 0.0722]], lambda p: p[2] * (CASE WHEN CAST('0x' || substr({h}, CAST(p[1] AS INT), 2) AS INT) / 255 <= 0.03928 THEN CAST('0x' || substr({h}, CAST(p[1] AS INT), 2) AS INT) / 255 / 12.92 ELSE pow((CAST('0x' || substr({h}, CAST(p[1] AS INT), 2) AS INT) / 255 + 0.055) / 1.055, 2.4) END)))"


@query(f"""
WITH a AS (SELECT 't' || n_nationkey AS token, {_HEX.format(k="n_nationkey")} AS h, CASE WHEN n_nationkey % 3 = 0 THEN 3.0 ELSE 4.5 END AS floor FROM nation), b AS (SELECT 'g' || r_regionkey AS ground, {_HEX.format(k="(r_regionkey + 50)")} AS h FROM region),
l AS (SELECT token, ground, floor, {_LUM.format(h="a.h")} AS x, {_LUM.format(h="b.h")} AS y FROM a, b)
SELECT token, ground, round((greatest(x, y) + 0.05) / (least(x, y) + 0.05), 3) AS ratio FROM l WHERE (greatest(x, y) + 0.05) / (least(x, y) + 0.05) < floor""")
def contrast_failures(t):
    """Colours of a style sheet whose contrast with a ground is below the floor."""
    hexed = lambda k: F.lpad(F.hex((F.expr(k) * 7919 + 4242) * 104729 % 16777216), 6, "0")
    css = t("nation").agg(F.array_join(F.collect_list(F.concat(F.lit("--t"), F.col("n_nationkey").cast("string"), F.lit(": #"), hexed("cast(n_nationkey as bigint)"), F.lit("; color: red;"))), "\n").alias("css"))
    tokens = css.select(F.explode(gates.css_tokens(F.col("css"))).alias("x")).select(F.col("x.name").alias("token"), F.col("x.hex").alias("colour"))
    tokens = tokens.withColumn("role", F.when(F.substr("token", F.lit(2)).cast("int") % 3 == 0, "edge").otherwise("text"))
    grounds = t("region").select(F.concat(F.lit("g"), F.col("r_regionkey").cast("string")).alias("ground"), hexed("cast(r_regionkey + 50 as bigint)").alias("ground_colour"))
    return gates.contrast_failures(tokens, grounds).select("token", "ground", F.round("ratio", 3).alias("ratio"))


@query(r"""
SELECT page_id, left(sha256(x), 16) AS masked, left(sha256(y), 16) AS unlinked FROM (SELECT page_id, regexp_replace('<script>a' || html || '<script>b</script>', '(?s)<script.*?</script>', ' ', 'g') AS x,
'<p>' || html || '<link rel="stylesheet" href="a.css"><LINK>' AS y FROM pages)""")
def masked_blocks(t):
    """Blocks masked between two marks, and tags of navigation dropped."""
    x = T.mask_block(F.concat(F.lit("<script>a"), "html", F.lit("<script>b</script>")), "<script", "</script>")
    y = T.drop_navigation_links(F.concat(F.lit('<p><link href="x" rel="canonical">'), "html", F.lit('<link rel="stylesheet" href="a.css"><LINK title="t" REL = "next"><LINK>')))
    return t("pages").select("page_id", T.body_hash(x).alias("masked"), T.body_hash(y).alias("unlinked"))


@query(r"""
SELECT doc_id, left(sha256('<b title="licence">' || array_to_string(list_transform(string_split(x, '"'), lambda x, i: CASE WHEN i % 2 = 1 THEN replace(x, 'licence', 'license') ELSE x END), '"') || '<i>'), 16) AS hash FROM (SELECT doc_id, replace(replace(replace(translate(text, '<>"', '   '), ',', '"'), ' ', ' licence '), '  ', ' ') AS x FROM documents WHERE text IS NOT NULL)""")
def spelling_outside_quotes(t):
    """A spelling changed outside tags and quotations of a page."""
    x = F.expr("""concat('<b title="licence">', replace(replace(replace(translate(text, '<>"', '   '), ',', '"'), ' ', ' licence '), '  ', ' '), '<i>')""")
    return t("documents").where("text is not null").select("doc_id", T.body_hash(T.outside_quotes_html(x, "licence", "license")).alias("hash"))


# ---- pages as surfaces

_PATHS = "CASE WHEN page_id = 0 THEN 'index.html' WHEN page_id % 4 = 0 THEN 'd' || page_id || '/index.html' ELSE 'd' || page_id || '/p.html' END"


def _paths(t) -> DataFrame:
    return t("pages").select("page_id", F.expr("case when page_id = 0 then 'index.html' when page_id % 4 = 0 then concat('d', page_id, '/index.html') else concat('d', page_id, '/p.html') end").alias("path"), "html")


@query(f"""
WITH p AS (SELECT {_PATHS} AS path FROM pages)
SELECT '/index.html / 301' AS line FROM p WHERE path = 'index.html' UNION ALL SELECT '/' || path || ' /' || replace(path, 'index.html', '') || ' 301' FROM p WHERE path LIKE '%/index.html'
UNION ALL SELECT '/' || path || ' /' || replace(path, '.html', '/') || ' 301' FROM p WHERE path LIKE '%/p.html' UNION ALL SELECT '/' || replace(path, '.html', '') || ' /' || replace(path, '.html', '/') || ' 301' FROM p WHERE path LIKE '%/p.html'""")
def redirect_lines(t):
    return sinks.redirects(_paths(t))


@query(f"""
WITH p AS (SELECT page_id, {_PATHS} AS path FROM pages)
SELECT page_id, CASE WHEN path = 'index.html' THEN '1.0' WHEN path LIKE '%/index.html' THEN '0.8' ELSE '0.6' END AS priority, row_number() OVER (ORDER BY path <> 'index.html', path NOT LIKE '%/index.html', path) AS place FROM p""")
def sitemap_order(t):
    """Home first, then section indexes, then the rest: the order of a site's pages."""
    p = _paths(t)
    return ordered.placed(p.select("page_id", "path"), coverage.page_order(F.col("path"))).select("page_id", coverage.priority(F.col("path")).alias("priority"), "place")


@query("""
SELECT sha256('<?xml version="1.0" encoding="UTF-8"?>' || chr(10) || '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">' || chr(10) || string_agg('  <url><loc>https://x.org/' || CASE WHEN n_nationkey = 0 THEN '' WHEN n_nationkey % 2 = 0 THEN 'n' || n_nationkey || '/' ELSE 'p' || n_nationkey || '/' END || '</loc><lastmod>2026-01-0' || (1 + n_nationkey % 9) || '</lastmod></url>', chr(10)
ORDER BY n_nationkey <> 0, n_nationkey % 2, CASE WHEN n_nationkey % 2 = 0 THEN 'n' || n_nationkey || '/index.html' ELSE 'p' || n_nationkey || '.html' END) || chr(10) || '</urlset>' || chr(10)) AS digest FROM nation""")
def sitemap_text(t):
    path = F.expr("case when n_nationkey = 0 then 'index.html' when n_nationkey % 2 = 0 then concat('n', n_nationkey, '/index.html') else concat('p', n_nationkey, '.html') end")
    n = t("nation").select(path.alias("path"), F.concat(F.lit("2026-01-0"), (1 + F.col("n_nationkey") % 9).cast("string")).alias("lastmod"))
    return coverage.sitemap_xml(n, "https://x.org").select(F.sha2("xml", 256).alias("digest"))


@query("SELECT page_id, page_id % 4 IN (0, 3) AS noindex FROM pages")
def noindex_pages(t):
    """Pages that ask not to be indexed, however they write it."""
    tag = F.expr("""case page_id % 4 when 0 then '<META NAME="Robots" CONTENT="noindex, nofollow">' when 1 then '<meta name="robots" content="index, noindexed">' when 2 then '<meta name="keywords" content="noindex">' else "<meta content='follow,NOINDEX' name=googlebot>" end""")
    return t("pages").select("page_id", coverage.noindex(F.concat(F.regexp_replace("html", "(?i)<meta", "<m"), tag)).alias("noindex"))


@query("""
SELECT page_id, left(sha256('a<!-- N:BEGIN -->' || chr(10) || url || chr(10) || '<!-- N:END -->' || html), 16) AS injected,
CASE WHEN page_id % 2 = 0 THEN left(sha256('## Log' || chr(10) || '- ' || url || chr(10) || chr(10) || 'old'), 16) END AS inserted FROM pages""")
def edited_pages(t):
    """Pages with a generated block put between its marks, and with an entry under a heading that occurs once."""
    page = F.concat(F.lit("a<!-- N:BEGIN -->old\nolder<!-- N:END -->"), "html")
    notes = F.when(F.col("page_id") % 2 == 0, "## Log\nold").otherwise("## Log\nold\n## Log\n")
    return t("pages").select("page_id", T.body_hash(sinks.inject(page, "N", F.col("url"))).alias("injected"), T.body_hash(sinks.insert_after(notes, "## Log\n", F.concat(F.lit("- "), "url"))).alias("inserted"))


@query("""
SELECT 'n' || chr(CAST(97 + n_nationkey AS INT)) AS slug, s AS surface, 'Nov ' || CASE s WHEN 'page' THEN 1 + n_nationkey WHEN 'table' THEN 2 + n_nationkey ELSE 3 + n_nationkey END || ', 2026' AS was, 'Nov ' || (1 + n_nationkey) || ', 2026' AS now
FROM nation, (SELECT unnest(['page', 'table', 'json']) AS s) WHERE (s = 'table' AND n_nationkey % 4 = 1) OR (s = 'json' AND n_nationkey % 5 = 2)""")
def date_corrections(t):
    """Dates that surfaces derive from a page's own and have wrong."""
    k = F.col("n_nationkey")
    n = t("nation").select("n_nationkey", F.concat(F.lit("n"), F.chr(k + 97)).alias("slug"), F.concat(F.lit("2026-11-"), F.lpad((k + 1).cast("string"), 2, "0")).alias("day"))
    shown = lambda more: F.concat(F.lit("Nov "), (k + 1 + more).cast("string"), F.lit(", 2026"))
    pages = n.select("slug", F.concat(F.lit("# x\n**Sources last checked.** "), "day", F.lit(" \n")).alias("md"), F.concat(F.lit('<dd class="docket-checked">'), shown(0), F.lit("</dd>")).alias("html"))
    row = F.concat(F.lit('<tr><td><a href="/states/'), "slug", F.lit('/">x</a></td><td>y</td><td>'), shown(F.when(k % 4 == 1, 1).otherwise(0)), F.lit("</td></tr>"))
    record = F.to_json(F.struct("slug", shown(F.when(k % 5 == 2, 2).otherwise(0)).alias("checked")))
    index = n.agg(F.array_join(F.collect_list(row), "\n").alias("html"))
    home = n.agg(F.concat(F.lit('<script type="application/json" id="state-index">['), F.array_join(F.collect_list(record), ","), F.lit("]</script>")).alias("html"))
    found = sinks.checked_dates(pages, index, home)
    return sinks.corrections(found.where("surface = 'source'"), found.where("surface <> 'source'"))


@query("""
SELECT page_id, CASE WHEN page_id % 3 = 0 THEN regexp_replace(u, '^https?://(www\\.)?', '') WHEN page_id % 3 = 1 THEN 'Rule & Act ' || page_id ELSE regexp_replace(u, '^https?://(www\\.)?', '') END AS name FROM (SELECT page_id, 'https://www.x' || page_id || '.org/a?b=1&c=2' AS u FROM pages)""")
def source_names(t):
    """What a page calls a source: descriptive text of a link to it if there is any."""
    url = F.expr("concat('https://www.x', page_id, '.org/a?b=1&c=2')")
    link = lambda text: F.concat(F.lit('<a href="'), T.html_escape(F.col("u")), F.lit('" rel="x">'), text, F.lit("</a>"))
    bare = T.html_escape(F.regexp_replace("u", r"^https?://(www\.)?", ""))
    page = F.when(F.col("page_id") % 3 == 0, link(bare)).when(F.col("page_id") % 3 == 1, F.concat(link(bare), link(F.concat(F.lit("<b>Rule</b> &amp; Act "), F.col("page_id").cast("string"))))).otherwise("none")
    return t("pages").select("page_id", url.alias("u")).select("page_id", sinks.source_name(page, F.col("u")).alias("name"))


# ---- words of reports


@query("""
SELECT c_custkey, 'slice from ''' || c_mktsegment || '''' || CASE WHEN c_custkey % 3 > 1 THEN ' (occurrence 2)' ELSE '' END || ' to ' || CASE WHEN c_custkey % 2 = 0 THEN 'the end of the document' ELSE '''stop''' || CASE WHEN c_custkey % 5 = 0 THEN ' (occurrence 3)' ELSE '' END END AS note FROM customer""")
def slice_notes(t):
    k = F.col("c_custkey")
    spec = F.struct(F.col("c_mktsegment").alias("from"), F.when(k % 2 == 1, "stop").alias("to"), F.when(k % 3 > 1, 2).when(k % 3 == 1, 1).alias("from_occurrence"), F.when(k % 5 == 0, 3).alias("to_occurrence"))
    return t("customer").select("c_custkey", spec.alias("s")).select("c_custkey", sinks.slice_note(F.col("s")).alias("note"))


@query("""
SELECT user_id, part, CASE WHEN a = b AND a = '2024-01-15' THEN 'this date' WHEN a = b THEN 'on ' || a ELSE 'between ' || a || ' and ' || b END AS said FROM (SELECT user_id, event_id // 500 AS part, CAST(CAST(min(ts) AS DATE) AS VARCHAR) AS a, CAST(CAST(max(ts) AS DATE) AS VARCHAR) AS b FROM events GROUP BY 1, 2)""")
def request_dates(t):
    """When captures were requested, in words."""
    e = t("events").groupBy("user_id", F.floor(F.col("event_id") / 500).alias("part")).agg(F.collect_set(F.to_date("ts").cast("string")).alias("d"))
    return e.select("user_id", "part", sinks.range_text(F.col("d"), F.lit("2024-01-15")).alias("said"))


@query(
    _LOG
    + """, a AS (SELECT coalesce(result, 'unknown') AS r, count(*) AS n FROM log WHERE date BETWEEN '2024-01-05' AND '2024-01-20' GROUP BY 1), f AS (SELECT r_name, r_regionkey FROM region)
SELECT sha256('{"window":{"from":"2024-01-05","to":"2024-01-20"},"attendance":{' || (SELECT string_agg('"' || r || '":' || n, ',' ORDER BY r) FROM a) || '},"passes":' || (SELECT CAST(sum(n) AS BIGINT) FROM a) || ',"findings":[' || (SELECT string_agg('{"r_name":"' || r_name || '","r_regionkey":' || r_regionkey || '}', ',' ORDER BY r_name) FROM f) || ']}') AS digest"""
)
def window_report(t):
    """A window's digest as one JSON text."""
    return sinks.report(t("region").select("r_name", "r_regionkey"), history.attendance(log(t), "2024-01-05", "2024-01-20"), "2024-01-05", "2024-01-20").select(F.sha2("json", 256).alias("digest"))


@query("""
SELECT c_custkey, left(sha256('{"sources":[{' || CASE WHEN c_custkey % 5 = 0 THEN '"compressed":false,' ELSE '' END || '"extractor":"docx","filters":[' || CASE WHEN c_custkey % 3 = 0 THEN '"trim-lines"' ELSE '' END || '],"n":1,' || CASE WHEN c_custkey % 2 = 0 THEN '"pages":[1,2],' ELSE '' END || '"scope":null,"transport":"curl","url":"https://x.org/' || c_nationkey || '"}],"v":1}'), 12) AS digest FROM customer""")
def method_digests(t):
    """Digests of what a recipe's captured text depends on: titles and notes don't count."""
    recipe = F.expr("""concat('{"state": "s", "sources": [{"title": "', c_name, '", "n": 1, "user_agent": "none", "transport": "curl", "url": "https://x.org/', c_nationkey, '", "extractor": "docx", "attended": true, "notes": "x"',
        if(c_custkey % 5 = 0, ', "compressed": false', ', "compressed": true'), if(c_custkey % 3 = 0, ', "filters": ["trim-lines"]', ', "filters": []'), if(c_custkey % 2 = 0, ', "pages": [1, 2]', ', "pages": null'), '}]}')""")
    return t("customer").select("c_custkey", sinks.method_digest(recipe).alias("digest"))


@query("""
SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'recipe ' || d WHEN 1 THEN 'curl, recipe ' || d WHEN 2 THEN 'curl, recipe ' || d WHEN 4 THEN 'by hand' END AS transport,
CASE event_id % 6 WHEN 3 THEN 'names digest 000000000000 but the capture declares ' || d WHEN 5 THEN 'claims a recipe that the capture doesn''t declare' END AS error FROM (SELECT event_id, left(sha256(CAST(event_id AS VARCHAR)), 12) AS d FROM events)""")
def recorded_transports(t):
    """What is recorded of how a capture was made, and which notes are refused."""
    d, k = F.substring(F.sha2(F.col("event_id").cast("string"), 256), 1, 12), F.col("event_id") % 6
    given = F.when(k == 1, "curl").when(k == 2, F.concat(F.lit("curl, recipe "), d)).when(k == 3, "recipe 000000000000").when(k == 4, "by hand").when(k == 5, "by Recipe")
    return t("events").select("event_id", sinks.transport(F.when(k < 4, d), given).alias("x")).select("event_id", "x.transport", "x.error")


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CAST(CAST(ts AS DATE) AS VARCHAR) END AS day, CASE WHEN event_id % 4 = 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS stamp FROM events")
def tolerant_dates(t):
    """Dates and stamps that are read if they are whole, else null."""
    day = F.date_format("ts", "yyyy-MM-dd")
    said = F.when(F.col("event_id") % 3 == 0, day).when(F.col("event_id") % 3 == 1, F.concat(day, F.lit("T0"))).otherwise("2024-13-40")
    stamp = F.concat(day, F.lit("T"), F.date_format("ts", "HHmmss"), F.when(F.col("event_id") % 4 == 1, "Z").otherwise(""))
    return t("events").select("event_id", D.tolerant_date(said).cast("string").alias("day"), F.date_format(D.stamp(stamp), "yyyy-MM-dd HH:mm:ss").alias("stamp"))


@query(r"SELECT doc_id, len(list_filter(regexp_split_to_array(replace(replace(text, ' ', chr(10)), ',', chr(13) || chr(10) || '  ' || chr(13)), '\r\n|\n|\r'), lambda x: trim(x) <> '')) AS lines FROM documents WHERE text IS NOT NULL")
def filled_lines(t):
    """Lines that hold something, whatever ends them."""
    x = F.replace(F.replace("text", F.lit(" "), F.lit("\n")), F.lit(","), F.lit("\r\n  \r"))
    return t("documents").where("text is not null").select("doc_id", T.non_blank(x).cast("long").alias("lines"))


@query("""
WITH s AS (SELECT doc_id, text, list_filter(range(45, 201), lambda n: length(substr(text, 11, n)) >= n AND length(text) - length(replace(text, substr(text, 11, n), '')) = n) AS ok FROM documents WHERE text IS NOT NULL)
SELECT doc_id, CASE WHEN len(ok) > 0 THEN substr(text, 11, ok[1]) END AS anchor FROM s""")
def grown_anchors(t):
    """The shortest text from a place on that occurs once, 45 to 200 characters long."""
    return t("documents").where("text is not null").select("doc_id", T.shortest_unique("text", F.lit(10)).alias("anchor"))


# ---- queues and health


@query("""
WITH f AS (SELECT min(event_id) AS stop FROM events WHERE value > 95 AND event_id > 300) SELECT event_id FROM events, f WHERE stop IS NULL OR event_id <= stop""")
def attempts_until_fault(t):
    """A run's attempts before and with the first account fault."""
    from veriloom.streaming.logs import until_fault

    return until_fault(t("events").withColumn("fault", (F.col("value") > 95) & (F.col("event_id") > 300)), "event_id", "fault").select("event_id")


@query(_LEDGER + f"""SELECT url, CASE WHEN epoch(TIMESTAMP '2024-02-20 00:00:00') - floor(epoch(ts)) > 2592000 THEN true ELSE false END AS expired FROM (SELECT CAST(user_id AS VARCHAR) AS url, ts, o FROM led) WHERE o = 'PENDING'""")
def pending_captures(t):
    """Captures that wait to be confirmed, and those whose term is over."""
    led = ledger(t).withColumn("capture_submitted", F.date_format("last_attempt", "yyyy-MM-dd HH:mm:ss"))
    p = queue.pending(led)
    return p.select("url", queue.expired(F.lit("2024-02-20 00:00:00").cast("timestamp"), F.col("last_attempt"), F.col("last_attempt")).alias("expired"))


@query("""
WITH a AS (SELECT max(CAST(ts AS DATE)) AS newest, min(d) AS oldest, count(*) FILTER (DATE '2024-03-01' - d > 25) AS stale FROM (SELECT user_id, max_by(CAST(ts AS DATE), event_id) AS d, max_by(ts, event_id) AS ts FROM events GROUP BY 1))
SELECT 'severe' AS severity, 'no pass recorded for ' || (DATE '2024-03-01' - newest) || ' days' AS message FROM a WHERE DATE '2024-03-01' - newest > 2
UNION ALL SELECT 'note', stale || ' not reviewed within a lap, oldest at ' || oldest FROM a WHERE stale > 0
UNION ALL SELECT 'severe', 'the cursor names ''nowhere'', which is not in the rotation'
UNION ALL SELECT 'note', 'no recipe for n' || n_nationkey FROM nation WHERE n_nationkey % 3 = 1 AND n_nationkey % 5 > 0
UNION ALL SELECT 'note', 'old supplement n' || n_nationkey FROM nation WHERE n_nationkey % 3 > 0 AND n_nationkey % 2 = 0
UNION ALL SELECT 'severe', 'undeclared account faults: playback-429'
UNION ALL SELECT 'severe', (SELECT count(*) FROM customer WHERE c_custkey % 100 = 0) || ' sources rest on an account fault'""")
def rotation_health(t):
    """Everything that is wrong with a nightly rotation."""
    last = history.latest(log(t), ["slug"]).select("slug", "date")
    k = F.col("n_nationkey")
    head = F.concat(F.when(k % 3 == 0, "CLASS: archival\n").otherwise("x\n"), F.lit("ASSEMBLED: "), F.when(k % 2 == 0, "2023-01-01").otherwise("2024-02-20"))
    sup = t("nation").select("n_nationkey", F.concat(F.lit("n"), k.cast("string")).alias("stem"), head.alias("head"), F.lit("p").alias("path"))
    led = t("customer").select(F.col("c_custkey").cast("string").alias("url"), F.when(F.col("c_custkey") % 100 == 0, "submit-401").otherwise("404").alias("last_detail"), F.lit("FAILED").alias("last_result"))
    day = F.lit("2024-03-01").cast("date")
    return health.report(last, day, last.select(F.col("slug").cast("string").alias("slug")), "nowhere", True, sup.select("path", "stem", "head"), sup.where("n_nationkey % 3 <> 1 or n_nationkey % 5 = 0").select("stem"), led, ["submit-401"])


# ---- extraction and reports


@query(r"""
SELECT doc_id, left(sha256(CASE doc_id % 6 WHEN 0 THEN x WHEN 1 THEN source || chr(10) || chr(10) || x WHEN 2 THEN 'part: ' || source || chr(10) || 'text: ' || x WHEN 3 THEN 'from  here on ' || x || ' ' WHEN 4 THEN replace(x, ',', chr(39)) ELSE ' A ' || doc_id || ' . ' || chr(10) || source || ' | b' || chr(10) END), 16) AS hash
FROM (SELECT doc_id, source, regexp_replace(translate(coalesce(text, ''), '|"\<>&', '      '), '[^\x{21}-\x{7E}]+', ' ', 'g') AS x FROM documents)""")
def extracted_sources(t):
    """Bytes of six kinds of sources by the extractor, slice and filters that each recipe names."""
    from veriloom.sources.extract import extract

    d = t("documents").select("doc_id", "source", F.regexp_replace(F.translate(F.coalesce("text", F.lit("")), '|"\\<>&', "      "), r"[^\x{21}-\x{7E}]+", " ").alias("x"))
    k = F.col("doc_id") % 6
    doc = F.to_json(F.struct(F.lit(None).cast("string").alias("no"), F.struct(F.col("source").alias("part"), F.col("x").alias("text")).alias("a")))
    island = F.concat(F.lit('<p>x</p><script id="__NEXT_DATA__" type="application/json">'), doc, F.lit("</script>"))
    page = F.concat(F.lit('<body><nav>no</nav><main><p> A <b hidden>no</b>'), F.col("doc_id").cast("string"), F.lit(' <span class="sr-only">no</span>. </p><table><tr><td>'), "source", F.lit("</td><td><i>b</i></td></tr></table></main></body>"))
    raw = F.when(k == 0, F.col("x")).when(k == 1, island).when(k == 2, doc).when(k == 3, F.concat(F.lit("before from  here on "), "x", F.lit(" to  this end of it"))).when(k == 4, F.replace("x", F.lit(","), F.lit("\x92"))).otherwise(page)
    scope = F.when(k == 1, '["a.part", "a.text"]').when(k == 2, "a").when(k == 5, "main")
    kind = F.when(k == 1, "next-data").when(k == 2, "json-doc").when(k == 5, "html-text").otherwise("none")
    cut = F.when(k == 3, F.struct(F.lit("from here on").alias("from"), F.lit("to this end").alias("to"), F.lit(1).alias("from_occurrence"), F.lit(None).cast("int").alias("to_occurrence")))
    names = F.when(k == 3, F.array(F.lit("collapse-blank-runs"))).when(k == 4, F.array(F.lit("normalize-apostrophes"))).when(k == 5, F.array(F.lit("collapse-blank-runs")))
    s = F.struct(kind.alias("extractor"), scope.alias("scope"), F.when(k == 4, "cp1252").alias("encoding"), F.lit(None).cast("boolean").alias("drop_icon_space"), F.lit(True).alias("drop_sr_only"), cut.alias("slice"), names.alias("filters"))
    bytes_ = F.when(k == 4, F.encode(raw, "ISO-8859-1")).otherwise(F.encode(raw, "UTF-8"))
    out = extract(d.select("doc_id", s.alias("s"), bytes_.alias("content")))
    tidy = F.when(F.col("doc_id") % 6 == 5, F.regexp_replace("body", r"\n\n?", "\n")).otherwise(F.col("body"))
    return out.select("doc_id", T.body_hash(F.when(F.col("doc_id") % 6 == 5, F.regexp_replace(tidy, r"^\n", "")).otherwise(tidy)).alias("hash"))


@query("""
SELECT page_id, 'Write to user' || page_id || '@x.org now' AS mail, 'in <https://x.org/' || page_id || '> | m@x.org | b' AS cells, 'Yes, no.' AS joined FROM pages""")
def dom_texts(t):
    """Coded addresses shown, hidden and read-aloud parts dropped, targets of links in cells, no blank where an icon stood."""
    code = F.expr("concat('42', array_join(transform(split(concat('user', page_id, '@x.org'), ''), c -> lpad(lower(hex(ascii(c) ^ 66)), 2, '0')), ''))")
    mail = F.concat(F.lit('<main>Write to <a data-cfemail="'), code, F.lit('">[email]</a><i style="display: none">x</i> <svg>x</svg><b hidden>no</b><!-- c -->now<div role="region" hidden></div></main>'))
    cells = F.concat(F.lit('<main><table><tr><td>in <a href="https://x.org/'), F.col("page_id").cast("string"), F.lit('"></a></td><td><a href="mailto:m@x.org?s=1">m@x.org</a></td><td>b</td></tr></table></main>'))
    joined = F.lit("<main>Yes <i class='icon'></i>, no<span class='sr-only'>!</span>.</main>")
    p = t("pages").select("page_id", mail.alias("m"), cells.alias("c"), joined.alias("j"))
    return p.select(
        "page_id", T.strip(html.html_text(F.col("m"), "main")).alias("mail"), T.strip(html.html_text(F.col("c"), "main", links=True)).alias("cells"), T.strip(html.html_text(F.col("j"), "main", icon_space=True, sr_only=True)).alias("joined")
    )


@query("""
SELECT count(*) AS pages, count(*) FILTER (doc_id % 5 > 1) AS clean, count(*) FILTER (doc_id % 5 < 2 AND doc_id % 3 = 0) AS soft, count(*) FILTER (doc_id % 5 < 2 AND doc_id % 3 > 0) AS hard, false AS passed FROM (SELECT DISTINCT doc_id FROM documents)
UNION ALL SELECT count(*), count(*) FILTER (doc_id % 5 > 1), count(*) FILTER (doc_id % 5 < 2), 0, true FROM (SELECT DISTINCT doc_id FROM documents)
UNION ALL SELECT count(*), count(*) FILTER (doc_id % 5 > 1), count(*) FILTER (doc_id % 5 < 2), 0, false FROM (SELECT DISTINCT doc_id FROM documents)""")
def run_totals(t):
    """Totals of a check: what exempt keys fail is soft, and counts under strict only."""
    d = t("documents").select("doc_id")
    bad, some = d.where("doc_id % 5 < 2"), d.where("doc_id % 3 = 0")
    runs = [coverage.run_totals(d, bad, some, "doc_id"), coverage.run_totals(d, bad, d, "doc_id"), coverage.run_totals(d, bad, d, "doc_id", strict=True)]
    return coverage.union(runs)


@query("""
SELECT sha256('**Baseline: ' || count(*) FILTER (n_nationkey % 2 = 0) || ' of 25 · Full: ' || count(*) FILTER (n_nationkey % 3 = 0) || ' of 25**' || chr(10) || chr(10) || '| Name | Baseline | Full | Last checked |' || chr(10) || '|---|:---:|:---:|---|' || chr(10) ||
string_agg('| ' || n_name || ' | ' || CASE WHEN n_nationkey % 2 = 0 THEN '[x]' ELSE '[ ]' END || ' | ' || CASE WHEN n_nationkey % 3 = 0 THEN '[x]' ELSE '[ ]' END || ' | ' || CASE WHEN n_nationkey % 4 = 0 THEN 'May 1' ELSE '' END || ' |', chr(10) ORDER BY n_name) || chr(10)) AS status,
sha256('<ul>' || chr(10) || string_agg(CASE WHEN n_nationkey % 2 = 0 THEN '<li><a href="/of/s' || n_nationkey || '" title="' || n_name || CASE WHEN n_nationkey % 4 = 0 THEN ', seen May 1' ELSE '' END || '">N&' || n_nationkey || ' ' || n_name || '</a></li>'
ELSE '<li>N&' || n_nationkey || ' ' || n_name || '</li>' END, chr(10) ORDER BY n_name) || chr(10) || '</ul>') AS picker FROM nation""")
def status_and_picker(t):
    """The status table and the block of links of a dimension's members."""
    forms = ("<ul>\n{links}\n</ul>", '<li><a href="/of/{slug}" title="{title}">{abbr} {name}</a></li>', "<li>{abbr} {name}</li>", ", seen {checked}")
    k = F.col("n_nationkey")
    n = t("nation").select(
        F.col("n_name").alias("name"), F.concat(F.lit("s"), k.cast("string")).alias("slug"), F.concat(F.lit("N&"), k.cast("string")).alias("abbr"), (k % 2 == 0).alias("base"), (k % 3 == 0).alias("full"), (k % 2 == 0).alias("published"), F.when(k % 4 == 0, "May 1").alias("checked")
    )
    return sinks.status_table(n).select(F.sha2("text", 256).alias("status")).crossJoin(sinks.picker(n, *forms).select(F.sha2("html", 256).alias("picker")))


_NOTED = "'2026-0' || (1 + n_nationkey % 9) || '-01'"


@query(f"""
WITH f AS (SELECT n_nationkey % 2 = 0 AS pub, {_NOTED} AS date, n_name AS slug, CASE WHEN n_nationkey % 4 > 0 THEN 'old' || n_nationkey ELSE 'none' END AS old FROM nation), a AS (SELECT string_agg(r || ' ' || n, ', ' ORDER BY r) AS by, CAST(sum(n) AS BIGINT) AS n, coalesce(sum(n) FILTER (r = 'confirmed'), 0) AS same FROM (SELECT event_type AS r, count(*) AS n FROM events GROUP BY 1))
SELECT sha256('Changes from x to y' || chr(10) || a.n || ' pass(es): ' || a.by || chr(10) || chr(10) || 'Candidates (' || count(*) FILTER (pub) || ')' || chr(10) || string_agg('  ' || date || '  ' || slug || ' (main)  ' || old || ' -> new' || chr(10) || '    text changed; source added', chr(10) ORDER BY date, slug) FILTER (pub) ||
chr(10) || chr(10) || 'Tooling, not news (' || count(*) FILTER (NOT pub) || ')' || chr(10) || string_agg('  ' || date || '  ' || slug || ' (main)  extractor respacing', chr(10) ORDER BY date, slug) FILTER (NOT pub) || chr(10)) AS report,
sha256('# Change record, x to y' || chr(10) || chr(10) || '## What moved' || chr(10) || chr(10) || string_agg('- **' || slug || '** (' || date || ') — text changed; source added. TODO: what changed, in the words of ' || old || ' and new.', chr(10) ORDER BY date, slug) FILTER (pub) ||
chr(10) || chr(10) || '## Corrections' || chr(10) || chr(10) || 'TODO' || chr(10) || chr(10) || '## Tooling notes' || chr(10) || chr(10) || count(*) FILTER (NOT pub) || ' drift(s) came from extraction or filters: ' || string_agg(slug, ', ' ORDER BY slug) FILTER (NOT pub) || '.' || chr(10)) AS draft FROM f, a GROUP BY a.n, a.by""")
def change_reports(t):
    """A window's digest as a text and as a draft."""
    k = F.col("n_nationkey")
    verdicts = F.when(k % 2 == 0, F.array(F.lit("text changed"), F.lit("source added"))).otherwise(F.array(F.lit("extractor respacing")))
    f = t("nation").select(
        F.col("n_name").alias("slug"), F.lit("main").alias("kind"), F.concat(F.lit("2026-0"), (k % 9 + 1).cast("string"), F.lit("-01")).alias("date"), F.when(k % 4 > 0, F.concat(F.lit("old"), k.cast("string"))).alias("supersedes"), F.lit("new").alias("capture"), verdicts.alias("verdicts"), (k % 2 == 0).alias("publishable")
    )
    seen = t("events").groupBy(F.col("event_type").alias("result")).agg(F.count("*").alias("passes"))
    return sinks.report_text(f, seen, "x", "y").select(F.sha2("text", 256).alias("report")).crossJoin(sinks.report_draft(f, seen, "x", "y").select(F.sha2("text", 256).alias("draft")))


@query("""
SELECT o_custkey AS path, CASE WHEN o_custkey % 3 = 0 THEN '2025-05-05' WHEN count(*) FILTER (o_custkey % 3 = 1) > 0 THEN CAST(CAST(min(o_orderdate) AS DATE) AS VARCHAR) ELSE '2026-07-08' END AS assembled, CASE o_custkey % 3 WHEN 0 THEN 'header' WHEN 1 THEN 'git' ELSE 'mtime' END AS date_source FROM orders GROUP BY 1""")
def assembly_dates(t):
    """When captures were assembled: by their heads, else by their first commits, else by the files' own times."""
    o = t("orders").select(F.col("o_custkey").cast("string").alias("path"), F.to_date("o_orderdate").alias("date"), F.lit("h").alias("hash"))
    c = o.select("path").distinct().select("path", F.when(F.col("path") % 3 == 0, "x\nAssembly date 2025-05-05").otherwise("x").alias("head"), F.lit("2026-07-08 01:00:00").cast("timestamp").alias("modified"))
    return files.assembly_dates(c, o.where("path % 3 < 2")).select(F.col("path").cast("long").alias("path"), "assembled", "date_source")


@query("SELECT c_custkey, 'd' || c_custkey || '/x' AS path FROM customer WHERE c_custkey % 3 > 0")
def listed_paths(t):
    """Paths of a list, without its comments and blank lines."""
    line = F.expr("case c_custkey % 3 when 0 then if(c_custkey % 2 = 0, concat('# d', c_custkey), ' ') when 1 then concat(' d', c_custkey, '/x/ # why') else concat('d', c_custkey, '/x') end")
    p = files.path_list(t("customer").select(line.alias("value")))
    return p.select(F.regexp_extract("path", r"^d(\d+)/", 1).cast("long").alias("c_custkey"), "path")


def confirmation_stream(spark, sf_dir: str) -> DataFrame:
    """Submissions and what is heard of them, as a file stream over the log, in one run over what is there."""
    from veriloom.session import ship
    from veriloom.streaming.stateful import confirmations, rocksdb

    ship(spark)
    at = scratch(spark, "confirmations")
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    source = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    said = F.create_map(*[F.lit(x) for x in ("view", "submit", "click", "inconclusive", "error", "hard", "purchase", "soft", "signup", "confirmed")])
    events = source.select(F.col("user_id").cast("string").alias("url"), F.col("event_id").alias("seq"), (F.col("event_id") * 3600).alias("at"), F.element_at(said, F.col("event_type")).alias("event"))
    with rocksdb(spark):
        confirmations(events).writeStream.outputMode("append").format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/log").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{at}/out").select(F.col("url").cast("long").alias("url"), "seq", "outcome", F.col("failures").cast("long").alias("failures"), "status")


QUERIES["confirmation_stream"] = confirmation_stream
# A state machine over a key's rows, as a recursive walk: (since, failures) after each row.
ORACLE_SQL["confirmation_stream"] = """
WITH RECURSIVE e AS (SELECT user_id AS url, event_id AS seq, event_id * 3600 AS heard, CASE event_type WHEN 'view' THEN 'submit' WHEN 'click' THEN 'inconclusive' WHEN 'error' THEN 'hard' WHEN 'purchase' THEN 'soft' ELSE 'confirmed' END AS event, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events),
w AS (
  SELECT url, CAST(0 AS BIGINT) AS k, CAST(NULL AS BIGINT) AS since, CAST(0 AS BIGINT) AS failures, CAST(NULL AS BIGINT) AS seq, '' AS outcome FROM (SELECT DISTINCT url FROM e)
  UNION ALL
  SELECT e.url, e.k, CASE WHEN event = 'submit' THEN heard WHEN event = 'confirmed' OR (event = 'inconclusive' AND heard - since > 2592000) THEN NULL ELSE since END,
    CASE WHEN event = 'submit' THEN 0 WHEN event = 'hard' THEN failures + 1 ELSE failures END, e.seq,
    CASE WHEN event = 'submit' THEN 'pending' WHEN event = 'confirmed' AND since IS NOT NULL THEN 'confirmed' WHEN event = 'inconclusive' AND heard - since > 2592000 THEN 'expired' WHEN event IN ('hard', 'soft') THEN 'failed' ELSE 'left' END
  FROM w JOIN e ON e.url = w.url AND e.k = w.k + 1
)
SELECT url, seq, outcome, failures, CASE WHEN failures >= 3 THEN 'blocked' WHEN since IS NOT NULL THEN 'pending' ELSE 'open' END AS status FROM w WHERE k > 0"""


@query(r"""
WITH f AS (SELECT doc_id, regexp_replace('Intro  words ' || text, '[\s\xA0]+', ' ', 'g') AS f, regexp_replace(text, '[\s\xA0]+', ' ', 'g') AS b FROM documents WHERE text IS NOT NULL),
l AS (SELECT *, position(left(b, 120) IN f) - 1 AS i FROM f), w AS (SELECT *, string_split(substr(f, i + 1, 400), ' ') AS w FROM l),
c AS (SELECT *, list_transform(range(1, len(w) + 1), lambda n: trim(array_to_string(w[1:n], ' '))) AS c FROM w),
e AS (SELECT *, list_filter(c, lambda x, k: length(x) >= 45 AND (k = 1 OR length(c[k - 1]) <= 200)) AS e FROM c)
SELECT doc_id, CASE WHEN b <> '' AND i >= 0 THEN i END AS start, CASE WHEN b <> '' AND i >= 0 THEN i + length(b) END AS stop, CASE WHEN b <> '' AND i >= 0 THEN coalesce(list_filter(e, lambda x: length(f) - length(replace(f, x, '')) = length(x))[1], e[-1], c[-1]) END AS anchor FROM e""")
def slice_proposals(t):
    """Where a body lies in a text, and the words that a slice may begin with."""
    full = F.concat(F.lit("Intro  words "), "text")
    d = t("documents").where("text is not null").select("doc_id", T.norm(full).alias("f"), T.locate(full, "text").alias("span"))
    return d.select("doc_id", F.col("span.start").cast("long").alias("start"), F.col("span.end").cast("long").alias("stop"), F.when(F.col("span").isNotNull(), T.grow("f", F.col("span.start"))).alias("anchor"))


@query("""
SELECT 'n' || n_nationkey AS slug, k AS kind, CASE WHEN k = 'main' AND n_nationkey % 3 = 0 THEN 'review/n' || n_nationkey || '-2026.txt' WHEN k = 'main' THEN 'packets/n' || n_nationkey || '-packet.txt' ELSE 'packets/n' || n_nationkey || '-packet-forms.txt' END AS path FROM nation, (SELECT unnest(['main', 'forms']) AS k)""")
def reviewed_set(t):
    """Packet sets in which review captures stand for main packets."""
    s = F.concat(F.lit("n"), F.col("n_nationkey").cast("string"))
    n = t("nation").select("n_nationkey", s.alias("slug"))
    f = n.select(F.explode(F.array(F.concat(F.lit("packets/"), "slug", F.lit("-packet.txt")), F.concat(F.lit("packets/"), "slug", F.lit("-packet-forms.txt")))).alias("path"))
    return health.with_reviews(health.packet_set(f), n.where("n_nationkey % 3 = 0").select("slug", F.concat(F.lit("review/"), "slug", F.lit("-2026.txt")).alias("path")), "packets")
