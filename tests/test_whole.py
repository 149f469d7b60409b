"""Registered queries on small tables of which no row may be left out, against plain Python."""

import datetime as dt
import difflib
import re

import pytest

from veriloom.plans.queries import QUERIES


@pytest.fixture
def run(spark, tmp_path):
    """The rows of a query over tables of (schema, rows) by name."""

    def go(name, **tables):
        for t, (schema, rows) in tables.items():
            spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{tmp_path}/{t}.parquet")
        return QUERIES[name](spark, str(tmp_path)).collect()

    return go


def test_every_key_and_row_is_met_by_its_window(run):
    day = lambda n, hour=0: dt.datetime(2020, 1, 1, hour) + dt.timedelta(days=n)
    orders = [(k, day(k % 7 + 20 * j, 6 * (k % 2))) for k in range(1, 60) for j in range(2)]
    lines = [(k, 1 + k % 3, k % 9, day(k % 50, 6 * (k % 3))) for k in range(1, 200)]
    got = run("commits_in_window", orders=("o_custkey long, o_orderdate timestamp_ntz", orders), lineitem=("l_orderkey long, l_linenumber int, l_suppkey long, l_shipdate timestamp_ntz", lines))
    want = {}
    for k in {k for k, _ in orders}:
        a = min(d for c, d in orders if c == k)
        want[k] = ",".join(f"{o}/{n}" for _, o, n in sorted((d, o, n) for o, n, _, d in lines if a <= d <= a + dt.timedelta(days=30)))
    assert {r.id: r.within for r in got} == want and len(got) == len(want)


def test_long_documents_and_those_of_unknown_length_have_a_similarity(run):
    long = "\n\n".join(f"Of the {i} parts the {i * 7 % 13}th is the last" for i in range(200))
    rows = [(1, "the short one", 13), (2, long, len(long)), (3, "of the unknown length", None), (4, None, None)]
    got = {r.doc_id: (r.similarity, r.segments) for r in run("similar_bodies", documents=("doc_id long, text string, n_chars long", rows))}
    squash = lambda t: re.sub("[^a-z0-9]+", "", t.lower())
    want = {i: round(difflib.SequenceMatcher(a=squash(t), b=squash(re.sub(r"\bthe\b", "", t))).ratio(), 4) for i, t, _ in rows if t}
    assert {i: x for i, (x, _) in got.items()} == want | {4: None} and {i: n for i, (_, n) in got.items()} == {1: 1, 2: 1, 3: 1, 4: 0}


CUSTOMER = "c_custkey long, c_nationkey long"
EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def event(i, user, kind="view", props="{}"):
    return (i, dt.datetime(2024, 1, 30), user, kind, 1.0, props)


def test_all_customers_are_candidates(run):
    customer = (CUSTOMER, [(k, k % 3) for k in range(1, 1001)])
    events = (EVENTS, [event(k, k) for k in range(1, 1001, 4)])
    queued = run("retry_queue", customer=customer, events=events)
    assert {int(r.url) for r in queued} == set(range(1, 1001))
    places = [r.place for r in sorted((r for r in queued if r.place), key=lambda r: (r.state == "due", r.slug, r.url))]
    assert places == list(range(1, len(places) + 1))
    assert {r.slug: r.needed for r in run("queue_totals")} == {k: len(range(k or 3, 1001, 3)) for k in range(3)}
    assert {r.slug: (r.needed, r.recorded) for r in run("recorded_links")} == {k: (len(range(k or 3, 1001, 3)), sum(x % 3 == k for x in range(1, 1001, 4))) for k in range(3)}


def test_all_events_are_read(run):
    kinds = ["click", "error", "purchase", "signup", "view"]
    # Key 0 has every kind, key 1 none but clicks on odd ids, key 2 a kind on each side.
    rows = [event(i, 0, kinds[i % 5]) for i in range(1, 40)] + [event(i, 1, "click") for i in range(41, 80, 2)] + [event(83, 2, "view"), event(84, 2, "error"), event(88, 2, "view")]
    rows = [(*r[:5], f'{{"k": {r[0]}, "p{r[0]}": 1}}') for r in rows]
    gaps = {(r.user_id, r.missing) for r in run("surface_gaps", events=(EVENTS, rows))}
    assert gaps == {(1, k) for k in kinds[1:]} | {(2, k) for k in ("click", "purchase", "signup")}
    changes = {r.user_id: (r.gone, r.new, r.kept, r.all_kinds) for r in run("header_changes")}
    assert changes == {0: ("", "", ",".join(kinds), 5), 1: ("", "click", "", 1), 2: ("error", "", "view", 2)}
    names = sorted((r.event_id, r.name) for r in run("json_map"))
    assert names == sorted((r[0], n) for r in rows for n in ("k", f"p{r[0]}"))


def test_every_document_is_in_a_capture(run):
    big = 2_000_000_000
    ids = [*range(1, 121), 442, big, big + 1, big + 25]
    docs = [(i, f"Text {i} is here") for i in ids]
    state = {r.n: r.state for r in run("source_compare", documents=("doc_id long, text string", docs))}
    want = {i: "new" if i % 26 == 0 else "gone" if i % 34 == 0 else "respaced" if i % 6 == 0 else "grew" if i % 10 == 0 else "shrank" if i % 14 == 0 else "same" for i in ids}
    assert state == want and {s for s in want.values()} == {"new", "gone", "respaced", "grew", "shrank", "same"}

    def verdict(i):
        if want[i] in ("gone", "new", "grew", "shrank"):
            return {"gone": "source dropped", "new": "source added"}.get(want[i], "text changed")
        return "document moved" if i % 11 == 0 else "revision date changed" if i % 4 == 0 else "extractor respacing" if want[i] == "respaced" else None

    assert {r.n: r.verdict for r in run("verdict_ladder")} == {i: v for i in ids if (v := verdict(i))}
