import math
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from veriloom.llm import secretscan as s


def plain_base(text):
    out = []
    for m in re.finditer(r"""(?a:(?i:(password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["token", "Token=", "api_key: ", "APIKEY", "'", '"', "=", " ", "AKIA", "ABCD1234", "deadbeef", "é", "ſecret=12345678", "x9_/", "passwd"]), max_size=25).map("".join))
def test_base_is_the_plain_reading(text):
    assert s.base_spans(text) == plain_base(text)


def plain_windows(x, width, floor):
    hit = [False] * len(x)
    for i in range(len(x) - width + 1):
        w = x[i : i + width]
        h = -sum(w.count(c) / width * math.log2(w.count(c) / width) for c in set(w))
        if h >= floor - 1e-9:
            hit[i : i + width] = [True] * width
    return hit


def test_incremental_counts_equal_recounting():
    rng = random.Random(7)
    for n in (5, 20, 60, 200):
        for letters in ("ab", "0123456789abcdef", "abcdefghijklmnopqrstuvwxyzABCDEF0123456789"):
            x = "".join(rng.choice(letters) for _ in range(n))
            for width, floor in ((20, 3.7), (24, 3.0), (8, 1.5)):
                hit = [False] * n
                for a, b in s.hot_windows(x, width, floor):
                    hit[a:b] = [True] * (b - a)
                assert hit == plain_windows(x, width, floor)


def test_allow_list_and_real_secrets():
    assert not s.entropy_spans("id 123e4567-e89b-12d3-a456-426614174000 and Donaudampfschifffahrtsgesellschaft some/path/to/a/file")
    assert s.entropy_spans("key Zx8Qp1Lm9Rt4Vb7Nc2Ks5Wd3Yf6Hg0Ja end")


def test_operator(spark):
    rows = [(1, "token=abcdefgh12", 1), (2, None, 1), (3, "", 1), (1, "token=abcdefgh12", 2), (4, "🔑 password: hunter2hunter", 1)]
    got = s.scan(spark.createDataFrame(rows, "doc_id long, text string, spans int")).collect()
    assert [(r.doc_id, r.base) for r in got] == [(1, "assign:0:16"), (2, ""), (3, ""), (1, "assign:0:16"), (4, "assign:2:25")]
    red = s.redact(spark.createDataFrame(rows, "doc_id long, text string, spans int")).collect()
    assert [r.text for r in red] == ["[SECRET]", None, "", "[SECRET]", "🔑 [SECRET]"]
    assert s.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def plain_spans(text):
    """All spans of a text by plain loops over whole windows."""
    out = [(a, s.KINDS[k], b) for a, k, b in plain_base(text)]
    allowed = lambda x: any(re.fullmatch(p, x) for p in s.ALLOW)
    for m in re.finditer("[A-Za-z0-9+/_=-]+", text):
        if len(m[0]) < 20 or allowed(m[0]):
            continue
        for w in s.WINDOWS:
            for part in re.finditer(w.chars, m[0]):
                hit = [*plain_windows(part[0], w.width, w.floor), False]
                at = None
                for i, h in enumerate(hit):
                    if h and at is None:
                        at = i
                    elif not h and at is not None:
                        if not allowed(part[0][at:i]):
                            out.append((m.start() + part.start() + at, w.kind, m.start() + part.start() + i))
                        at = None
    out.sort(key=lambda x: (x[0], s.KINDS.index(x[1]), x[2]))
    return ",".join(f"{k}:{a}:{b}" for a, k, b in out)


def test_all_spans_equal_plain_loops(spark):
    rng = random.Random(11)
    pick = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    hexes, base, low = "0123456789abcdef", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", "abcdefghij"
    parts = [
        lambda: pick(hexes, rng.choice((8, 24, 31, 32, 60))), lambda: pick(base, rng.choice((10, 20, 24, 50))), lambda: pick(low, 30), lambda: "123e4567-e89b-12d3-a456-426614174000", lambda: "a" * 40,
        lambda: "token=" + pick(base, rng.choice((4, 12))), lambda: "AKIA" + pick("ABCDEFG0123", rng.choice((5, 16))), lambda: pick("0123456789", 25), lambda: "word é", lambda: pick(base, 22) + "x" * 30 + pick(base, 22),
    ]
    rows = [(i, " ".join(rng.choice(parts)() for _ in range(rng.randrange(8)))) for i in range(150)] + [(900, "lorem ipsum " * 40_000 + pick(base, 40))]
    got = {r.doc_id: r.spans for r in s.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: plain_spans(t) for i, t in rows} and sum("entropy" in x for x in got.values()) > 40
