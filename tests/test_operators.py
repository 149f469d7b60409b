import datetime as dt
import difflib
import random
import time
import hashlib
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from veriloom.operators import compare, coverage, fidelity, gates, history, queue, patience
from veriloom.sources import files, html, packets
from veriloom.streaming import logs, stateful

HEAD = "Captured text.\nSTATE: ohio\nASSEMBLED: 2026-01-02\nCAPTURE NOTES:\n- SOURCE 1: transport curl; artifact sha256:0123456789abcdef.\n- Capture code 0123456789ab clean\n"


def src(n, body, url="https://x.org/a", date="May 2025", sep=":"):
    return f"SOURCE {n}{sep} Title | {url} | source date: {date} | retrieved: 2026-01-02\n{body}\n"


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def verdicts(spark, old, new):
    a, b = (packets.sources(spark.createDataFrame([("s", t)], "slug string, raw string")) for t in (old, new))
    return {r.n: r.verdict for r in compare.classify(a, b, ["slug", "n"]).collect()}


def test_packet_dialects(spark):
    mixed = HEAD + src(1, "one\nEND SOURCE 1\nleft out") + "SOURCE 2 | B | http://y\ntwo\n" + "SOURCE 3\nthree\n" + src(2, "again")
    df = spark.createDataFrame([("s", mixed)], "slug string, raw string")
    assert rows(packets.sources(df), "n", "body") == [(1, "one"), (2, "again"), (3, "three")]
    got = df.select(packets.header_part("raw").alias("h"), packets.headers("raw").alias("l"), packets.urls("raw").alias("u"), packets.artifacts("raw").alias("a"), packets.strict_blocks("raw").alias("b"), packets.lenient_bodies("raw").alias("m")).first()
    assert got.h == HEAD and len(got.l) == 2 and got.u == ["https://x.org/a"] * 2 and got.a == {1: "sha256:0123456789abcdef"}
    assert [b.n for b in got.b] == [1, 2] and "END SOURCE 1" in got.b[0].body and got.m[1] == "one\n"
    plain = spark.createDataFrame([("no header at all",)], "raw string").select(packets.source_region("raw"), packets.source_bodies("raw"), packets.header_part("raw"), F.size(packets.blocks("raw"))).first()
    assert tuple(plain) == ("no header at all",) * 3 + (0,)
    assert df.select(packets.source_bodies("raw")).first()[0].startswith("\none")
    assert df.select(packets.slug("raw", F.lit("/p/texas-2026-01-01.txt"))).first()[0] == "ohio"
    # The end mark belongs to the body that hashes are made of, not to the one that is compared.
    two = spark.createDataFrame([(HEAD + src(1, "a  b"),), (HEAD.replace("curl", "chrome") + src(1, "a\nb", url="https://moved"),), (HEAD + src(1, "a b\nEND SOURCE 1"),)], "raw string")
    h = [r[0] for r in two.select(packets.packet_hash("raw")).collect()]
    assert h[0] == h[1] == hashlib.sha256(b"a b").hexdigest()[:16] and h[2] != h[0]


def test_verdicts(spark):
    base = HEAD + src(1, "The rule says this.\n\nAnd that.")
    repeat = "\nRunning head"
    cases = [
        (base, base, {}),
        (base, base.replace("2026-01-02\n", "2026-05-05\n").replace("retrieved: 2026-01-02", "retrieved: 2026-05-05"), {}),
        (base, HEAD + src(1, "The  rule says\nthis.\n\nAnd that."), {1: "extractor respacing"}),
        (base, HEAD + src(1, "The rule says those.\n\nAnd that."), {1: "text changed"}),
        (base, HEAD + src(1, "The rule says this.\n\nAnd that.", url="https://x.org/b"), {1: "document moved"}),
        (base, HEAD + src(1, "The rule says this.\n\nAnd that.", date="June 2025"), {1: "revision date changed"}),
        (base, HEAD + src(1, "The rule says this." + repeat * 3 + "\n\nAnd that."), {1: "recipe filter changed"}),
        (base, HEAD + src(1, "The  rule says this.\n\nAnd that.", url="https://x.org/b"), {1: "document moved"}),
        (base, HEAD + src(1, "The rule says more.\n\nAnd that.", url="https://x.org/b"), {1: "text changed"}),
        (base + src(2, "two"), base, {2: "source dropped"}),
        (base, base + src(2, "two"), {2: "source added"}),
        (base.replace("that.\n", "that.\nEND SOURCE 1\n") + src(2, "two"), base + src(2, "two, changed"), {2: "text changed"}),
    ]
    for old, new, want in cases:
        assert verdicts(spark, old, new) == want
    both = spark.createDataFrame([("k", "extractor respacing"), ("k", "document moved"), ("j", "recipe filter changed")], "slug string, verdict string")
    assert rows(compare.verdict_sets(both, "slug"), "slug", "verdicts", "publishable") == [("j", ["recipe filter changed"], False), ("k", ["document moved", "extractor respacing"], True)]


def test_compare_states_and_review(spark):
    a = spark.createDataFrame([("s", 1, "x"), ("s", 2, "a b"), ("s", 3, "abc"), ("s", 4, "abc"), ("s", 5, "q"), ("s", 7, "ab")], "slug string, n int, body string")
    b = spark.createDataFrame([("s", 2, "a\nb"), ("s", 3, "abcd"), ("s", 4, "ab"), ("s", 5, "q"), ("s", 6, "n"), ("s", 7, "cd")], "slug string, n int, body string")
    c = compare.compare(a, b, ["slug", "n"])
    assert rows(c, "n", "state", "was", "now") == [(1, "gone", None, None), (2, "respaced", None, None), (3, "grew", 3, 4), (4, "shrank", 3, 2), (5, "same", None, None), (6, "new", None, None), (7, "grew", 2, 2)]
    assert compare.needs_review(c, "slug").first().needs_review
    d = spark.createDataFrame([(["a", "a", "b"], ["b", "c"])], "o array<string>, n array<string>").select(compare.lost_and_new(F.col("o"), F.col("n")).alias("x")).first().x
    assert d.gone == ["a", "a"] and d.new == ["c"]


def test_method_code_similarity(spark):
    df = spark.createDataFrame([("x", "x"), ("curl, recipe 0123456789ab", "curl recipe 0123456789ab (y)"), ("recipe 0123456789ab", "recipe ba9876543210"), ("a", None), (None, None)], "a string, b string")
    assert [r[0] for r in df.select(compare.method_held(F.col("a"), F.col("b"))).collect()] == [True, True, False, False, True]
    day = dt.date(2026, 1, 1)
    p = spark.createDataFrame([(1, HEAD, HEAD, day, day), (2, HEAD, HEAD.replace("0123456789ab c", "aaaaaaaaaaaa c"), day, day), (3, "x", HEAD, day, dt.date(2026, 1, 9)), (4, "x", "y", dt.date(2025, 1, 1), dt.date(2025, 1, 2))], "id int, old_raw string, new_raw string, since date, until date")
    c = spark.createDataFrame([(f"h{i}", dt.date(2026, 1, 1 + i)) for i in range(6)] + [("late", dt.date(2026, 2, 1))], "hash string, date date")
    assert dict(rows(compare.code_change(p, c), "id", "code_changed")) == {1: None, 2: "changed: 0123456789ab -> aaaaaaaaaaaa", 3: "committed: h0, h1, h2, h3 and 2 more", 4: None}
    assert dict(rows(compare.code_change(p, None), "id", "code_changed"))[3] == "unrecorded"
    t = spark.createDataFrame([("one\n\ntwo", "one\n\n2!\n\nthree"), (None, "x")], "a string, b string")
    got = t.select(compare.similarity(F.col("a"), F.col("b"))).collect()
    assert 0 < got[0][0] < 1 and got[1][0] is None
    pairs = t.select(F.lit(1).alias("k"), patience.paragraphs("a").alias("o"), patience.paragraphs("b").alias("n")).where("o is not null")
    (block,) = patience.blocks(pairs, "k", "o", "n").collect()
    assert (block.tag, block.removed, block.added) == ("replace", ["two"], ["2!", "three"])


def test_similarity_is_the_sequence_matchers(spark):
    rng = random.Random(5)
    rows = [("", ""), ("", "x"), ("abxcd", "abcd"), ("x" * 300, "x" * 299)]
    for _ in range(400):
        letters = [chr(97 + i) for i in range(rng.choice([1, 2, 5, 26, 300]))]
        rare = [1 / (i + 1) ** rng.choice([0, 1, 2]) for i in range(len(letters))]
        a = "".join(rng.choices(letters, rare, k=rng.choice([9, 199, 200, 500])))
        b = "".join(rng.choice([c, c + rng.choice(letters), ""]) if rng.random() < rng.choice([0.01, 0.1, 0.5]) else c for c in a)
        rows.append(rng.choice([(a, b), (b, a), (a, b[len(b) // 2 :] + b), (a, b * 2)]))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, a string, b string")
    got = {r.id: r.s for r in df.select("id", compare.similarity(F.col("a"), F.col("b")).alias("s")).collect()}
    assert got == {i: round(difflib.SequenceMatcher(a=a, b=b).ratio(), 4) for i, (a, b) in enumerate(rows)}


def test_similarity_of_a_long_text_with_many_changes_takes_seconds(spark):
    rng = random.Random(6)
    words = ["".join(rng.choices("etaoinshrdlukvjxqz0123456789", [9] * 12 + [1] * 6 + [0.5] * 10, k=6)) for _ in range(60_000)]
    df = spark.createDataFrame([("".join(words), "".join(w for i, w in enumerate(words) if i % 7))], "a string, b string")
    began = time.monotonic()
    assert 0 < df.select(compare.similarity(F.col("a"), F.col("b"))).first()[0] < 1  # 360,000 characters, of which all pairs of equal rare ones were looked at for every block
    assert time.monotonic() - began < 30


LOG = "slug string, kind string, seq long, date string, result string, hash string, capture string, headers array<string>, transport string, supersedes string"


def log(spark, *r):
    return spark.createDataFrame([(s, k, i, d, x, h, c, ["A"], t, sup) for i, (s, k, d, x, h, c, t, sup) in enumerate(r)], LOG)


def test_history(spark):
    df = log(
        spark, ("a", None, "2026-02-01", "drift", "h1", "2026-02-01.txt", "t1", None), ("a", "main", "2026-01-01", "confirmed", "h1", None, None, None), ("a", "es", "2026-01-05", "drift", "h2", "2026-01-05-es.txt", "t2", "gone.txt"),
        ("b", "main", None, None, "h3", "x.txt", None, None),
    )
    assert rows(history.latest(df.withColumn("kind", history.kind()), ["slug", "kind"]), "slug", "kind", "seq") == [("a", "es", 2), ("a", "main", 1), ("b", "main", 3)]
    assert rows(history.exempt(df), "slug", "result", "kinds") == [("a", "drift", ["es"])]
    assert rows(history.newest_stored(df), "slug", "kind", "capture") == [("a", "es", "2026-01-05-es.txt"), ("a", "main", "2026-02-01.txt"), ("b", "main", "x.txt")]
    assert dict(rows(history.attendance(df, "", "2026-01-31"), "result", "passes")) == {"confirmed": 1, "drift": 1, "unknown": 1}
    assert rows(history.promote(df), "slug", "kind", "seq") == [("a", "main", 1)]
    new = spark.createDataFrame(
        [("a", None, "2026-02-01", "confirmed", "h1", ["A"]), ("a", "es", "2026-01-05", "drift", "h2", ["B"]), ("c", "main", "2026-03-01", "baseline", "h9", ["A"])], "slug string, kind string, date string, result string, hash string, headers array<string>"
    )
    got = {(r.slug, r.kind): r for r in history.retain(new, df).collect()}
    assert (got["a", "main"].stored, got["a", "main"].capture, got["a", "main"].supersedes) == (False, "2026-02-01.txt", None)
    es = got["a", "es"]
    assert (es.stored, es.capture, es.supersedes, es.headers_gone, es.headers_new) == (True, "2026-01-05-es-b.txt", "2026-01-05-es.txt", ["A"], ["B"])
    assert got["c", "main"].stored and got["c", "main"].capture == "2026-03-01.txt"
    assert rows(history.drift_pairs(df, "2026-01-01", "2026-12-31"), "slug", "capture", "now", "was") == [("a", "2026-01-05-es.txt", "t2", None), ("a", "2026-02-01.txt", "t1", None)]
    shrink = "slug string, n int, artifact string, lines int"
    o, n = spark.createDataFrame([("a", 1, "x", 9), ("a", 2, "x", 9)], shrink), spark.createDataFrame([("a", 1, "x", 8), ("a", 2, "y", 1)], shrink)
    assert rows(history.shorter_sources(o, n), "slug", "n", "was", "now") == [("a", 1, 9, 8)]
    assert rows(history.backfill(spark.createDataFrame([("a",), ("z",)], "slug string"), df), "slug") == [("z",)]


def test_chain(spark):
    entries, prev = [], None
    for i in range(6):
        body = json.dumps({"id": i, "prev": prev, "é": 1}, sort_keys=True, separators=(",", ":"))
        digest = hashlib.sha256(body.encode()).hexdigest()
        entries.append((i, body, digest, prev))
        prev = digest
    cols = "id int, entry string, entry_sha256 string, prev_entry_sha256 string"
    df = spark.createDataFrame(entries, cols)
    assert history.chain_breaks(df).count() == 0
    assert df.where(html.canonical_digest(F.col("entry")) != F.col("entry_sha256")).count() == 0
    bad = [e if e[0] != 3 else (*e[:3], "x") for e in entries if e[0] != 5] + [(7, "", "", None)]
    assert rows(history.chain_breaks(spark.createDataFrame(bad, cols)), "id") == [(3,), (7,)]
    m = history.manifest_lines(spark.createDataFrame([("aa  p/q  r",), ("bb  s",), ("",)], "value string"))
    f = spark.createDataFrame([("p/q  r", "aa")], "path string, sha256 string")
    assert rows(history.manifest_status(m, f), "path", "status") == [("s", "missing")]


def test_queue(spark):
    now = dt.datetime(2026, 6, 30)
    ago = lambda d, s=0: now - dt.timedelta(days=d, seconds=s)
    led = spark.createDataFrame(
        [("p", "PENDING", ago(1), "c", 9), ("b", "FAILED", ago(1), None, 3), ("c", "FAILED", ago(6), None, 1), ("d", "FAILED", ago(7), None, 1), ("o", "OK", ago(1), "c", 0), ("q", "PENDING", ago(1), None, 0)],
        "url string, last_result string, last_attempt timestamp, capture string, consecutive_hard_failures int",
    )
    cand = spark.createDataFrame([("s", u) for u in "pbcdoqn"], "slug string, url string")
    q = queue.queue(cand, led, F.lit(now))
    assert {r.url: (r.state, r.place) for r in q.collect()} == {"p": ("pending", None), "b": ("blocked", None), "c": ("cooling", None), "n": ("fresh", 1), "d": ("due", 2), "o": ("due", 3), "q": ("due", 4)}
    again = {r.url: r.state for r in queue.queue(cand, led, F.lit(now), retry_blocked=True).collect()}
    assert again["p"] == "pending" and again["b"] == again["c"] == "due"
    e = spark.createDataFrame([(ago(30), ago(0)), (ago(30, 1), ago(0)), (None, None)], "s timestamp, a timestamp")
    assert [r[0] for r in e.select(queue.expired(F.lit(now), F.col("s"), F.col("a"))).collect()] == [False, True, False]
    a = spark.createDataFrame([("u", i, o) for i, o in enumerate(["OK", "hard", "hard", "soft", "hard", "SKIPPED", "PENDING"])], "url string, i int, outcome string")
    assert [r.streak for r in queue.streaks(a, ["url"], "i").orderBy("i").collect()] == [0, 1, 2, 2, 3, 3, 0]
    made = queue.budgeted(spark.createDataFrame([("u", i, o) for i, o in enumerate("xOxOOO")], "k string, i int, o string"), ["k"], "i", 2, F.col("o") == "O")
    assert made.count() == 4
    assert queue.totals(q, ["slug"]).first().fresh == 1
    assert queue.recordable(led, cand).count() == 1 and queue.recordable(led, cand.limit(0)).count() == 0


def test_coverage_and_sitemap(spark):
    s = spark.createDataFrame([("a", "page", "1"), ("a", "table", "1"), ("b", "page", "1"), ("b", "table", None), ("c", "page", "2")], "slug string, surface string, checked string")
    assert rows(coverage.gaps(s, "slug", "surface", ["page", "table"]), "slug", "missing") == [("c", "table")]
    assert rows(coverage.disagreements(s, "slug", "surface", "checked"), "slug") == [("b",)]
    f = coverage.soft_or_hard(s, spark.createDataFrame([("a",)], "slug string"), "slug")
    assert tuple(coverage.totals(f).first()) == (2, 3)
    meta = ['<meta name="robots" content="noindex, nofollow">', "<META CONTENT='x,noindex' name=googlebot>", '<meta name="robots" content="noindexx">', '<meta name="description" content="noindex">', "noindex", '<meta name="robots"']
    got = spark.createDataFrame([(i, m) for i, m in enumerate(meta)], "i int, h string").select("i", coverage.noindex(F.col("h")).alias("n")).orderBy("i").collect()
    assert [r.n for r in got] == [True, True, False, False, False, False]
    pages = spark.createDataFrame([("index.html", ""), ("404.html", ""), ("states/ohio.html", ""), ("a/index.html", meta[0])], "path string, html string")
    drifted = spark.createDataFrame([("states/ohio.html",)], "path string")
    assert dict(rows(coverage.sitemap(pages, ["404.html"], drifted), "path", "reason")) == {"index.html": None, "404.html": "excluded by name", "states/ohio.html": "recorded as drift, awaiting rebuild", "a/index.html": "declares noindex"}
    p = pages.select("path", coverage.canonical_path(F.col("path")).alias("c"), coverage.other_paths(F.col("path")).alias("o"))
    assert {r.path: (r.c, r.o) for r in p.collect()}["states/ohio.html"] == ("/states/ohio/", ["/states/ohio.html", "/states/ohio"])
    assert {r.path: (r.c, r.o) for r in p.collect()}["a/index.html"] == ("/a/", ["/a/index.html"])
    xml = coverage.sitemap_xml(pages.withColumn("lastmod", F.lit("2026-01-01")), "https://x.org").first().xml
    assert xml.index("org/</loc>") < xml.index("/a/</loc>") < xml.index("/404/")
    ages = coverage.ages(spark.createDataFrame([("a", "2026-01-01"), ("b", None), ("c", "2026-01-30")], "slug string, date string"), F.lit("2026-01-31").cast("date")).collect()
    assert [(r.slug, r.stale) for r in ages] == [("b", True), ("a", True), ("c", False)]


def test_gates(spark):
    page = '<p>You should file by noon. The state said "we recommend"</p><a href="rel.html">x</a><a href="/abs">[leak](y)</a><script src="https://cdn.z/x.js"></script><link rel="canonical" href="https://me.org/"><p>review pending</p>'
    df = spark.createDataFrame([("p", page), ("q", '<p id="main">"you should"</p>')], "path string, html string")
    found = gates.violations(df, ["me.org"], {"main": 'id="main"'}, {"licence": "license"})
    assert rows(found, "gate", "page", "detail") == sorted([
        ("pending", "p", "review pending"), ("external", "p", "https://cdn.z/x.js"), ("advice", "p", "you should"), ("relative", "p", "rel.html"), ("leaked", "p", "[leak](y)"), ("main", "p", "missing"),
    ], key=str)
    assert rows(gates.passed(found, ["advice", "placeholder"]), "gate", "violations", "passed") == [("advice", 1, False), ("placeholder", 0, True)]
    stray = gates.stray_files(spark.createDataFrame([("a/x.html",), ("a/run.sh",), ("LICENSE",), ("Makefile",)], "path string"), [])
    assert rows(stray, "page") == [("Makefile",), ("a/run.sh",)]
    c = spark.createDataFrame([("000000", "ffffff"), ("777777", "ffffff")], "a string, b string").select(F.round(gates.contrast(F.col("a"), F.col("b")), 2)).collect()
    assert [r[0] for r in c] == [21.0, 4.48]


def test_fidelity(spark):
    ev = HEAD + src(1, "The parent may ask for a hearing ofﬁce review. Call 202-555-0123. Write to 12 Main\nStreet, x@y.org")
    ok = '<p>It says "may ask for a hearing office" and call (202) 555-0123. <a href="https://x.org/b">x</a></p>'
    bad = '<p>It says "may demand a hearing office" and 202-555-9999, z@y.org, 99 Elm Street. You should call. <a href="https://other.net/">x</a></p>\n## 04 Change log\n"an old quotation long since gone"'
    pages = spark.createDataFrame([("a", ok), ("b", bad), ("c", '"capture notes are no evidence"')], "slug string, raw string")
    note = HEAD.replace("CAPTURE NOTES:", "CAPTURE NOTES:\ncapture notes are no evidence")
    packs = spark.createDataFrame([("a", "1", ev), ("b", "1", ev), ("c", "1", note + src(1, "[text truncated by the extractor] body"))], "slug string, path string, body string")
    got = rows(fidelity.check(pages, packs), "slug", "tag", "detail")
    assert [(s, t) for s, t, _ in got] == [("b", t) for t in ("ADDRESS", "ADVISORY", "EMAIL", "HOSTNAME", "PHONE", "QUOTE")] + [("c", "PACKET"), ("c", "QUOTE")]


def test_quote_in_second_packet_and_keyless_containment(spark):
    q = spark.createDataFrame([("a", "words of the second packet")], "slug string, text string")
    p = spark.createDataFrame([("a", "1", "first"), ("a", "2", "the words of  the\nsecond packet")], "slug string, path string, body string")
    assert fidelity.unsupported_quotes(q, fidelity.evidence(p)).count() == 0
    assert fidelity.unsupported_quotes(q, fidelity.evidence(p.where("path = '1'"))).count() == 1
    c = spark.createDataFrame([(1, "ords of the sec"), (2, "two words"), (3, "t"), (4, "absent")], "i int, claim string")
    assert rows(fidelity.contained(c, spark.createDataFrame([(9, "the words of the second two words")], "d int, t string"), "claim", "t"), "i") == [(1,), (2,), (3,)]


def test_pairing(spark):
    raw = 'Q1 "xxxxxxxxxxxxxxxx" [[ohio:law:1]] ' + "." * 300 + ' Q2 "yyyyyyyyyyyyyyyy" ' + "." * 300 + ' Q3 "zzzzzzzzzzzzzzzz" <i data-quote-id="Bad Id"> ' + "." * 300 + ' Q4 "wwwwwwwwwwwwwwww" [[texas:law:1]] ' + "." * 300 + ' Q5 "vvvvvvvvvvvvvvvv" [[ohio:law:9]] ' + "." * 300 + ' Q6 "uuuuuuuuuuuuuuuu" [[ohio:law:1]]'
    from veriloom.functions.claims import quotes

    q = spark.createDataFrame([("ohio", raw)], "slug string, raw string").select("slug", "raw", F.explode(quotes("raw")).alias("q")).select("slug", "raw", "q.pos", "q.text").where("length(text) = 16")
    idx = spark.createDataFrame([("ohio:law:1",), ("texas:law:1",)], "id string")
    assert [r.verdict for r in fidelity.pair_quotes(q, idx).orderBy("pos").collect()] == [None, "UNPAIRED", "MALFORMED", "CROSS-STATE", "UNKNOWN", "DUPLICATE"]


def test_pages_by_structure():
    page = """<html><body style="visibility:hidden"><nav>n</nav><main id="m" class="a b"><!-- c --><p>Hi <b>there </b><span> <i class="icon"></i></span>, you</p>
      <script>x</script><div style="display: none">no</div><div hidden class="accordion-body">panel</div><span class="sr-only">sr</span>
      <table><tr><th>h</th><td>a <a href="mailto:q@x.org?s=1">mail</a></td></tr></table><a data-cfemail="%s">[protected]</a><a data-cfemail="zz">[kept]</a></main></body></html>""" % ("21" + "".join(f"{ord(c) ^ 0x21:02x}" for c in "me@x.org"))
    t = html.page_text(page, "main.a", icon_space=True, sr_only=True, links=True)
    assert [x.strip() for x in t.split("\n") if x.strip()] == ["Hi there, you", "panel", "h | a mail <q@x.org>", "me@x.org[kept]"]
    assert "sr" in html.page_text(page, "#m") and "n" not in html.page_text("<body><nav>n</nav><p>x</p></body>", "body p").strip()
    with pytest.raises(ValueError):
        html.page_text(page, "#absent")
    assert html.json_lines({"a": 1, "b": {"c": None, "d": [1, {"e": "f"}]}, "g": "", "h": False}) == ["a: 1", "b:", "  d:", "    [0]: 1", "    [1]", "      e: f", "h: False"]


def test_docx(spark):
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    p = lambda t: f"<w:p><w:r><w:t>{t}</w:t></w:r></w:p>"
    sect = '<w:sectPr><w:headerReference w:type="default" r:id="r1"/></w:sectPr>'
    body = f"<w:document {w}><w:body>{p('one')}<w:tbl><w:tr><w:tc>{p('a')}</w:tc><w:tc>{p('b')}</w:tc></w:tr></w:tbl>{p('two')}<w:p><w:pPr>{sect}</w:pPr></w:p>{sect}</w:body></w:document>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", body)
        z.writestr("word/header1.xml", f"<w:hdr {w}>{p('Head')}</w:hdr>")
        z.writestr("word/_rels/document.xml.rels", '<R><Relationship Id="r1" Target="header1.xml"/></R>')
    df = spark.createDataFrame([("f", bytearray(out.getvalue()))], "path string, content binary")
    r = html.docx_text(df, headers=True).first()
    assert r.body == "one\ntwo\n\na | b" and r.headers == "Head"


def test_files(spark, tmp_path):
    (tmp_path / "ohio").mkdir()
    (tmp_path / "texas").mkdir()
    (tmp_path / "ohio/manifest.jsonl").write_text('{"date":"2026-02-01","result":"drift"}\n\n{"date":"2026-01-01","result":"confirmed","shorter_sources":[{"n":1,"was":3,"now":2}]}\n')
    (tmp_path / "texas/manifest.jsonl").write_text('{"kind":"es"}')
    m = files.manifest(spark, str(tmp_path))
    assert rows(m, "slug", "seq", "result") == [("ohio", 0, "drift"), ("ohio", 2, "confirmed"), ("texas", 0, None)]
    assert files.manifest(spark, str(tmp_path), "texas").count() == 1
    rec = {"recipe_version": 1, "state": "x", "sources": [{"n": 1, "title": "t", "url": "https://a", "transport": "curl", "extractor": "docx"}, {"n": 1, "title": "", "url": "ftp://a", "urls": ["http://b"], "transport": "fax", "extractor": "html-text", "filters": ["nope"], "pages": [3, 2]}]}
    (tmp_path / "x.json").write_text(json.dumps(rec, indent=1))
    errors = [e for _, e in rows(files.lint(files.recipes(spark, str(tmp_path / "x.json"))), "n", "error")]
    assert sorted(errors) == sorted(["source without title", "both url and urls", "url is not http", "unknown transport", "html-text without scope", "unknown filter", "pages end before they begin", "pages without a PDF", "n occurs twice"])
    led = spark.createDataFrame([('{"sources":{"u":{"attempts":2},"v":{}}}',), ("no json",), (None,)], "value string")
    assert rows(files.ledger(led), "url", "attempts") == [("u", 2), ("v", None)]
    page = '<script id="__NEXT_DATA__" type="x">{"a":{"b":["one","two"]},"n":null}</script><script id="S">[{"slug":"o"}]</script>'
    df = spark.createDataFrame([(page,)], "html string")
    assert df.select(files.next_data(F.col("html"), ["a.b[1]", "a.b[0]"])).first()[0] == "two\n\none"
    with pytest.raises(Exception, match="nothing at n"):
        df.select(files.next_data(F.col("html"), ["n"])).collect()
    assert rows(files.island_records(df, "S", "slug string"), "slug") == [("o",)] and files.island_records(df, "absent", "slug string").count() == 0
    b = spark.createDataFrame([(bytearray(b"ok \xc3\xa9"),), (bytearray(b"bad \xff x"),)], "c binary").select(files.decode(F.col("c")).alias("d"))
    assert [(r.d.text, r.d.lossy) for r in b.collect()] == [("ok é", False), ("bad � x", True)]
    with pytest.raises(Exception, match="undecodable"):
        b.select(files.refuse_lossy(F.col("d"), F.col("d.text"))).collect()
    assert [r[0] for r in b.select(files.refuse_lossy(F.col("d"), F.lit("clean"))).collect()] == ["clean"] * 2
    pdf = b"%PDF-1.7 ... %%EOF"
    v = spark.createDataFrame([(bytearray(pdf), hashlib.sha256(pdf).hexdigest()), (bytearray(pdf[:-5]), hashlib.sha256(pdf[:-5]).hexdigest()), (bytearray(pdf), "0")], "c binary, h string")
    assert [r[0] for r in v.select(files.verified_bytes(F.col("c"), F.col("h"), pdf=True)).collect()] == [True, False, False]
    d = files.draft(spark.createDataFrame([("SOURCE 2: A title | https://x.org/f.pdf | source date: May | retrieved: x",)], "header string")).first()
    assert tuple(d) == (2, "A title", "https://x.org/f.pdf", "May", "pdftotext-layout")


def test_packet_files_are_whole(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d/ohio-2026-01-01.txt").write_text(HEAD + src(1, "a\nb"))
    (tmp_path / "d/x.json").write_text("{}")
    df = packets.files(spark, str(tmp_path))
    assert rows(packets.sources(df), "n", "body") == [(1, "a\nb")]
    assert files.walk(spark, str(tmp_path), skip=r"\.json$").count() == 1


def test_sections_and_docket(spark):
    df = spark.createDataFrame([("o", "# T\n**Checked.** 2026-01-01\n## One\na\n## Two\nb\n**Kind.** x y")], "slug string, raw string")
    assert rows(packets.page_sections(df).where("line in ('a', 'b')"), "section", "heading") == [(1, "One"), (2, "Two")]
    assert rows(packets.docket(df), "field", "value") == [("Checked", "2026-01-01"), ("Kind", "x y")]


def stream(spark, tmp_path, schema, batches, f, mode="append"):
    src_, out = tmp_path / "in", tmp_path / "out"
    src_.mkdir()
    got = []
    for i, b in enumerate(batches):
        (src_ / f"{i}.json").write_text("\n".join(map(json.dumps, b)))
        with stateful.rocksdb(spark):
            q = f(spark.readStream.schema(schema).json(str(src_))).writeStream.outputMode(mode).foreachBatch(lambda d, _: got.extend(d.collect())).option("checkpointLocation", str(out)).trigger(availableNow=True).start()
            q.awaitTermination(120)
    return got


def test_retention_as_a_stream(spark, tmp_path):
    ev = lambda *x: dict(zip(("slug", "kind", "seq", "hash", "result", "capture"), x, strict=True))
    got = stream(spark, tmp_path, "slug string, kind string, seq long, hash string, result string, capture string", [
        [ev("a", None, 1, "h", "baseline", "c1"), ev("a", "main", 2, "h", "confirmed", "c2"), ev("b", "es", 1, "k", "baseline", "d1")],
        [ev("a", "main", 3, "h", "drift", "c3"), ev("a", "main", 4, "g", "rebuild", "c4"), ev("b", "es", 2, "k", "confirmed", "d2")],
    ], stateful.retained)
    assert sorted((r.slug, r.seq, r.stored, r.supersedes) for r in got) == [("a", 1, True, None), ("a", 2, False, None), ("a", 3, True, "c1"), ("a", 4, True, "c3"), ("b", 1, True, None), ("b", 2, False, None)]


def test_confirmation_as_a_stream(spark, tmp_path):
    day = 86_400
    ev = lambda u, s, at, e: {"url": u, "seq": s, "at": at * day, "event": e}
    got = stream(spark, tmp_path, "url string, seq long, at long, event string", [
        [ev("a", 1, 0, "submit"), ev("a", 2, 20, "inconclusive"), ev("b", 1, 0, "hard"), ev("b", 2, 1, "fault"), ev("b", 3, 2, "hard"), ev("b", 4, 3, "soft"), ev("c", 1, 0, "submit")],
        [ev("a", 3, 30, "inconclusive"), ev("a", 4, 31, "inconclusive"), ev("b", 5, 4, "hard"), ev("c", 2, 40, "throttled"), ev("c", 3, 41, "confirmed")],
    ], stateful.confirmations)
    assert sorted((r.url, r.seq, r.outcome, r.failures, r.status) for r in got) == [
        ("a", 1, "pending", 0, "pending"), ("a", 2, "left", 0, "pending"), ("a", 3, "left", 0, "pending"), ("a", 4, "expired", 0, "open"),
        ("b", 1, "failed", 1, "open"), ("b", 2, "skipped", 1, "open"), ("b", 3, "failed", 2, "open"), ("b", 4, "failed", 2, "open"), ("b", 5, "failed", 3, "blocked"),
        ("c", 1, "pending", 0, "pending"), ("c", 2, "left", 0, "pending"), ("c", 3, "confirmed", 0, "open"),
    ]


def test_current_table_and_round_robin(spark, tmp_path):
    (tmp_path / "in").mkdir()
    schema = "k string, seq long, v string"
    for i, b in enumerate(([("a", 1, "x"), ("b", 2, "y")], [("a", 3, "z")])):
        (tmp_path / f"in/{i}.json").write_text("\n".join(json.dumps(dict(zip(("k", "seq", "v"), r, strict=True))) for r in b))
        logs.current_by_key(spark, spark.readStream.schema(schema).json(str(tmp_path / "in")), str(tmp_path / "t"), ["k"]).awaitTermination(120)
    assert rows(spark.read.parquet(str(tmp_path / "t/v=1")), "k", "v") == [("a", "z"), ("b", "y")]
    items = spark.createDataFrame([(x,) for x in "edcba"], "k string")
    assert rows(logs.night(items, "k", 3, 4), "k") == [("a",), ("b",), ("e",)]
    t = spark.createDataFrame([(1, False), (2, True), (3, False), (4, True)], "i int, bad boolean")
    assert logs.until_fault(t, "i", "bad").count() == 2 and logs.until_fault(t.where("not bad"), "i", "bad").count() == 2


@pytest.mark.parametrize("pipeline_stays", [False, True])
def test_entry_survives_without_the_subpackage(tmp_path, pipeline_stays):
    import os
    import shutil
    import subprocess
    import sys

    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(top, tmp_path / "r", ignore=lambda d, n: [x for x in n if x in ("llm", ".git", "tests", "__pycache__") or (x == "corpus_pipeline.py" and not pipeline_stays)])
    code = "import __spark_entry__ as e; q = e.queries(); assert 'verbatim_in_evidence' in q and not [k for k in q if k.startswith('op') or k == 'pipeline']; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path / "r", check=True)
