import hashlib

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from veriloom.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def both():
    ranks = bpe.read_ranks(open(PATH, "rb").read())
    theirs = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return bpe.Tokenizer(ranks, P.PATTERN), theirs


def test_every_code_point_between_letters_digits_and_spaces(both):
    ours, theirs = both
    points = [chr(c) for c in range(0x3200) if not 0xD800 <= c < 0xE000] + [chr(c) for c in range(0xF900, 0x10000, 7)] + [chr(c) for c in range(0x10000, 0x20000, 97)]
    for c in points:
        t = f"a{c}b 1{c} {c}{c} x"
        assert ours.encode([t])[0].tolist() == theirs.encode_ordinary(t), hex(ord(c))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80) | st.text(alphabet="abcdeé \n'st", max_size=200))
def test_same_ids_as_the_library_and_exact_round_trip(both, t):
    ours, theirs = both
    t = t.encode("utf-8", "ignore").decode()
    ids = ours.encode([t])[0].tolist()
    assert ids == theirs.encode_ordinary(t)
    assert ours.decode(ids) == t.encode()


@pytest.mark.parametrize("t", ["a" * 30_000, "ab" * 9_000, "é" * 5_000, "=" * 20_000, " " * 9_000 + "x", "the" * 4_000])
def test_very_long_pretokens(both, t):
    ours, theirs = both
    assert ours.encode([t])[0].tolist() == theirs.encode_ordinary(t)


def test_queue_gives_ranks_in_order_and_is_reusable():
    q = bpe.RankQueue(300_000)
    for r, at in [(9, 4), (70, 1), (9, 2), (299_999, 0), (4096, 7), (9, 3)]:
        q.put(r, [at])
    assert [q.next() for _ in range(5)] == [(9, [2, 3, 4]), (70, [1]), (4096, [7]), (299_999, [0]), None]
    assert not q.top and not any(q.mid) and not any(q.low) and not q.bucket


def test_a_pair_of_smaller_rank_goes_first():
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 300, b"abc": 260, b"bc": 400, b"abab": 270, b"cd": 280}
    ours = bpe.Tokenizer(ranks, P.PATTERN)
    theirs = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for t in ("abcdabab ababcd", "abababcab", "xabcabcdabab"):
        assert ours.encode([t])[0].tolist() == theirs.encode_ordinary(t)


def test_operator_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, "Hello  world", "x"), (1, "Hello  world", "y"), (2, None, "z"), (None, "", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = {(r[0], r[1], r[2], r[3]) for r in bpe.round_trip(docs, PATH, P.PATTERN).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert (2, 0, empty, empty) in out and (None, 0, empty, empty) in out and len(out) == 3
    coded = bpe.encode(docs, PATH, P.PATTERN)
    back = bpe.decode(coded, PATH, P.PATTERN).collect()
    assert sorted(bytes(r[1]) for r in back) == [b"", b"", b"Hello  world", b"Hello  world"]
    assert bpe.encode(docs.limit(0), PATH, P.PATTERN).count() == 0
