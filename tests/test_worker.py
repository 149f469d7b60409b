"""A capture worker's passes, against a plain walk over the same answers, and as commands."""

import json
import random

from pyspark.sql import functions as F

from tests.test_cli import tree
from veriloom.cli import main
from veriloom.operators import worker
from veriloom.sources import files

LEDGER = f"url string, {files.LEDGER}"


def now():
    return F.lit("2026-10-20 00:00:00").cast("timestamp")


def ledger(spark, **records):
    names = [x.split()[0] for x in files.LEDGER.split(", ")]
    return spark.createDataFrame([(u, *[r.get(n) for n in names]) for u, r in records.items()], LEDGER)


def walk(records, attempts, bump=True):
    """A ledger, attempt after attempt."""
    out = {u: dict(r) for u, r in records.items()}
    for url, page, _, at, result, detail, message, capture in sorted(attempts, key=lambda a: a[2]):
        r = out.setdefault(url, {})
        r["page"], r["last_attempt"], r["last_result"] = page, at, result
        r["attempts"] = (r.get("attempts") or 0) + bump
        if detail:
            r["last_detail"] = detail
        if message:
            r["last_message"] = message[:500]
        r.setdefault("consecutive_hard_failures", 0)
        if detail in worker.ACCOUNT:
            r["last_result"] = "SKIPPED"
            continue
        if result in ("OK", "PENDING"):
            r["consecutive_hard_failures"] = 0
            r["capture"] = capture or r.get("capture")
            if result == "PENDING":
                r["capture_submitted"] = at
        elif detail in worker.HARD:
            r["consecutive_hard_failures"] += 1
    return out


def test_a_ledger_after_attempts_equals_a_walk(spark):
    rnd = random.Random(5)
    known = {f"u{i}": {"page": "p", "last_result": "FAILED", "attempts": rnd.randrange(4), "consecutive_hard_failures": rnd.randrange(3), "capture": rnd.choice([None, "old"]), "last_detail": "x"} for i in range(8)}
    details = ["", None, "stored", "timeout", *worker.HARD, *worker.ACCOUNT]
    # One url has a third of all attempts.
    attempts = [(rnd.choice([f"u{rnd.randrange(16)}", f"u{rnd.randrange(16)}", "u3"]), rnd.choice("pq"), i, f"2026-10-{1 + i % 28:02d}T0{i % 10}0000Z", rnd.choice(["PENDING", "FAILED", "FAILED", "OK"]), rnd.choice(details), rnd.choice([None, "", "m" * rnd.randrange(900)]), rnd.choice([None, f"c{i}"])) for i in range(400)]
    rows = spark.createDataFrame(attempts, "url string, page string, seq int, at string, result string, detail string, message string, capture string")
    for bump in (True, False):
        want = walk(known, attempts, bump)
        got = {r.url: r.asDict() for r in worker.noted(ledger(spark, **known), rows, bump).collect()}
        assert got.keys() == want.keys()
        for u, r in want.items():
            assert {k: got[u][k] for k in got[u] if k != "url"} == {k: r.get(k) for k in got[u] if k != "url"}, u
    same = worker.noted(ledger(spark, **known), rows.limit(0))
    assert sorted(map(str, same.collect())) == sorted(map(str, ledger(spark, **known).collect()))
    assert worker.noted(ledger(spark), rows.limit(0)).isEmpty()


def test_a_run_ends_by_budget_ceiling_or_fault(spark):
    wanted = spark.createDataFrame([("s", f"u{i:02d}") for i in range(30)], "slug string, url string")
    said = lambda faults, stored: spark.createDataFrame([(f"u{i:02d}", "t", "PENDING" if i in stored else "FAILED", "submit-401" if i in faults else "", None, "c") for i in range(30) if i != 4], "url string, at string, result string, detail string, message string, capture string")
    made = lambda budget, faults=(), stored=(), most=None: [r.url for r in worker.run(worker.plan(wanted, ledger(spark), now(), budget, most), said(faults, stored), budget, most).orderBy("seq").collect()]
    reached = [f"u{i:02d}" for i in range(30) if i != 4]
    assert made(2, stored={1, 3, 5}) == reached[:4]
    assert made(2) == reached[:6] and made(2, most=9) == reached[:9]
    assert made(50, faults={7, 9}) == reached[:7]
    assert made(50) == reached and made(0) == []
    # A fault that says PENDING is no capture.
    assert len(made(1, faults={0}, stored={0})) == 1


def test_what_is_held_back(spark):
    led = ledger(
        spark, fresh_no={}, pending={"last_result": "PENDING", "capture": "c", "last_attempt": "2026-10-19T000000Z"}, blocked={"last_result": "FAILED", "consecutive_hard_failures": 3, "last_detail": "http-403", "last_attempt": "2026-01-01T000000Z"},
        cooling={"last_result": "FAILED", "last_attempt": "2026-10-15T000000Z"}, due={"last_result": "FAILED", "last_attempt": "2026-10-01T000000Z"}, unread={"last_result": "FAILED", "last_attempt": "some day"},
    )
    wanted = spark.createDataFrame([("s", u) for u in ("new", "fresh_no", "pending", "blocked", "cooling", "due", "unread")], "slug string, url string")
    parts = lambda **k: {r.url: (r.part, r.place) for r in worker.plan(wanted, led, now(), 1, **k).collect()}
    got = parts()
    assert got["pending"] == ("pending", None) and got["blocked"] == ("blocked", None) and got["cooling"] == ("cooling", None)
    assert [u for u, p in sorted(got.items(), key=lambda x: x[1][1] or 99)][:4] == ["fresh_no", "new", "unread", "due"]
    assert got["unread"][0] == "attempt" and got["due"] == ("beyond", 4)
    again = parts(retry_blocked=True)
    assert again["pending"] == ("pending", None) and again["blocked"][1] and again["cooling"][1]


def test_reading_back(spark):
    p = lambda submitted, **k: {"page": "s", "last_result": "PENDING", "capture": "c", "capture_submitted": submitted, "attempts": 1, "consecutive_hard_failures": 2} | k
    led = ledger(
        spark, old=p("2026-09-01T000000Z"), older=p("2026-08-01T000000Z"), young=p("2026-10-19T000000Z"), dark=p("2026-07-01T000000Z"), none=p(None, last_attempt="2026-01-01T000000Z"), stop=p("2026-10-19T000001Z"), after=p("2026-10-19T000002Z"),
        done=p("2026-01-01T000000Z", last_result="OK"), bare=p("2026-01-01T000000Z", capture=None),
    )
    seen = {"old": "inconclusive", "older": "no-playback", "young": "inconclusive", "none": "played", "stop": worker.THROTTLED, "after": "played", "done": "played", "bare": "played"}
    looks = spark.createDataFrame(list(seen.items()), "url string, seen string")
    found = worker.looked(led, looks, now())
    assert {r.url: r.outcome for r in found.collect()} == {"old": "expired", "older": "unplayable", "young": "left", "dark": "left", "none": "confirmed", "stop": "left", "after": "left"}
    after = {r.url: r for r in worker.confirmed(led, found, F.lit("2026-10-20T000000Z")).collect()}
    assert (after["none"].last_result, after["none"].consecutive_hard_failures, after["none"].attempts, after["none"].capture) == ("OK", 0, 1, "c")
    assert (after["old"].last_result, after["old"].last_detail, after["old"].capture_submitted) == ("FAILED", "pending-expired", "2026-09-01T000000Z")
    assert after["older"].last_detail == "no-playback" and after["after"].last_result == "PENDING" and len(after) == 9
    assert {r.outcome for r in worker.looked(led, looks.limit(0), now()).collect()} == {"left"}


def test_the_worker_as_commands(spark, tmp_path):
    said = []

    def run(*args):
        said.clear()
        return main([str(a) for a in args], spark, said.append)

    page = '<p><a href="https://s.org/a?b=1&amp;c=2">Policy &amp; A</a> <a href="https://s.org/b">s.org/b</a></p>'
    tree(tmp_path, site__ohio_DOT_html=page, md__ohio_DOT_md="# x\n\n## Change log\n\nolder\n", site__utah_DOT_html='<a href="https://s.org/u">u</a>')
    led = tmp_path / "ledger.json"
    assert run("plan", tmp_path / "site", led, "2026-10-01 00:00:00", 1) == 0
    assert said == ["attempt  ohio  https://s.org/a?b=1&c=2", "attempt  ohio  https://s.org/b", "attempt  utah  https://s.org/u"]
    answers = [{"url": "https://s.org/a?b=1&c=2", "at": "2026-10-01T000000Z", "result": "PENDING", "detail": "stored", "capture": "https://web.archive.org/web/2026/https://s.org/a?b=1&c=2"}, {"url": "https://s.org/b", "at": "2026-10-01T000100Z", "result": "FAILED", "detail": "submit-401"}]
    (tmp_path / "answers.jsonl").write_text("\n".join(map(json.dumps, answers)))
    assert run("run", tmp_path / "site", led, tmp_path / "answers.jsonl", "2026-10-01 00:00:00", 5) == 1 and said[-1] == "1 stored, 2 attempted"
    assert {u: r["last_result"] for u, r in json.loads(led.read_text())["sources"].items()} == {"https://s.org/a?b=1&c=2": "PENDING", "https://s.org/b": "SKIPPED"}
    assert run("record", tmp_path / "site", tmp_path / "md", led, "2026-10-03") == 0 and said == []
    (tmp_path / "looks.jsonl").write_text(json.dumps({"url": "https://s.org/a?b=1&c=2", "seen": "played"}))
    assert run("confirm", led, tmp_path / "looks.jsonl", "2026-10-02 00:00:00") == 0 and said == ["confirmed  ohio  https://s.org/a?b=1&c=2"]
    assert run("record", tmp_path / "site", tmp_path / "md", led, "2026-10-03", "--dry-run") == 0 and said == ["would record  ohio  1 capture(s)"]
    assert run("record", tmp_path / "site", tmp_path / "md", led, "2026-10-03") == 0
    capture = answers[0]["capture"]
    text = f"# x\n\n## Change log\n\n2026-10-03 — Captures recorded, requested on 2026-10-01: Policy & A → [{capture}]({capture}).\n\nolder\n"
    assert (tmp_path / "md/ohio.md").read_text() == text
    assert run("record", tmp_path / "site", tmp_path / "md", led, "2026-10-04") == 0 and said == [] and (tmp_path / "md/ohio.md").read_text() == text
    (tmp_path / "md/ohio.md").write_text("no log")
    assert run("record", tmp_path / "site", tmp_path / "md", led, "2026-10-04") == 1 and said == ["skipped  ohio  the heading doesn't occur once"]
    tree(tmp_path, live__a_DOT_html='<script src="https://cdn.test/x.js"></script><img src="/own.png"><img src="https://me.org/i.png">', live__b_DOT_html='<a href="https://s.org">x</a>')
    assert run("live", tmp_path / "live", "--own", "me.org") == 1 and len(said) == 1 and "cdn.test" in said[0]
