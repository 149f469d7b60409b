import base64
import gzip
import hashlib

from veriloom.llm import warc


def digest(t):
    return base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()


def write(spark, rows, path):
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string, payload string, digest string"), path)


def test_round_trip_with_revisits(spark, tmp_path):
    texts = ["<p>é</p>", "", None, "same", "same", "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n", "same", "a" * 100_000]
    rows = [(10 - i, f"http://h/{i} \r\nX: y", t, "p", "d") for i, t in enumerate(texts)]
    write(spark, rows, f"{tmp_path}/a")
    got = {r.record_id: r for r in warc.read(spark, f"{tmp_path}/a", payload=True).collect()}
    assert len(got) == len(rows) and all(r.gap is None for r in got.values())
    first: dict = {}
    for i, _, t, _, _ in sorted(rows):
        first.setdefault(t or "", i)
    for i, _, t, _, _ in rows:
        r = got[f"<urn:x-page:{i}>"]
        f = first[t or ""]
        assert (r.payload_bytes, r.payload_digest, r.type) == (len((t or "").encode()), digest(t), "response" if f == i else "revisit")
        assert r.refers_to == (None if f == i else f"<urn:x-page:{f}>")
        assert r.payload is None if f != i else bytes(r.payload) == (t or "").encode()


def record(n, body=b"hello"):
    return b"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:%d>\r\nWARC-Block-Digest: sha1:%s\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (
        n, base64.b32encode(hashlib.sha1(body).digest()), len(body), body)


def found(data):
    out = list(warc.salvage(data))
    return [int(r["warc-record-id"][5:-1]) for _, _, r, _ in out if r], [(a, b, w) for a, b, r, w in out if not r]


def test_salvage_recovers_later_records_and_logs_gaps():
    a, b, c = record(1), record(2, b"WARC/1.1\r\ntext"), record(3)
    assert found(a + b + c) == ([1, 2, 3], [])
    assert found(b"junk" + a + c) == ([1, 3], [(0, 4, "no version line")])
    damaged = b.replace(b"text", b"tExt")
    ids, gaps = found(a + damaged + c)
    assert ids == [1, 3] and gaps == [(len(a), len(a) + len(damaged), "block digest differs")]
    ids, gaps = found(a + b[:-9] + c)
    assert ids == [1, 3] and gaps[0][:2] == (len(a), len(a) + len(b) - 9)
    ids, gaps = found(a + c[:-6])
    assert ids == [1] and gaps == [(len(a), len(a) + len(c) - 6, "cut off")]
    short = b.replace(b"Content-Length: 14", b"Content-Length: 3")
    assert found(a + short + c)[0] == [1, 3]
    assert found(b"") == ([], [])


def test_salvage_reads_gzip_members():
    m = [gzip.compress(record(i)) for i in (1, 2, 3)]
    assert found(b"".join(m)) == ([1, 2, 3], [])
    bad = m[1][:20] + bytes([m[1][20] ^ 255]) + m[1][21:]
    ids, gaps = found(m[0] + bad + m[2] + record(4))
    assert ids == [1, 3, 4] and gaps[0][:2] == (len(m[0]), len(m[0]) + len(bad))
    assert found(m[0] + m[2][:-5])[0] == [1]


def test_null_ids_repeats_and_empty_tables(spark, tmp_path):
    write(spark, [(None, None, "t", "", ""), (5, None, "t", "", ""), (5, None, "t", "", "")], f"{tmp_path}/b")
    got = sorted((r.record_id, r.type, r.refers_to) for r in warc.read(spark, f"{tmp_path}/b").collect())
    assert got == [("<urn:x-page:5>", "response", None), ("<urn:x-page:5>", "response", None), ("<urn:x-page:null>", "revisit", "<urn:x-page:5>")]
    write(spark, [], f"{tmp_path}/c")
    assert warc.read(spark, f"{tmp_path}/c").count() == 0


def test_salvage_recovers_records_inside_a_gzip_member():
    a, b, c = record(1), record(2, b"text"), record(3)
    ids, gaps = found(gzip.compress(a + b.replace(b"text", b"tExt") + c) + record(4))
    assert ids == [1, 3, 4] and [w for _, _, w in gaps] == [f"block digest differs: bytes {len(a)} to {len(a) + len(b)} of the member's content"]
    noise = [record(i, hashlib.sha512(b"%d" % i).hexdigest().encode() * 9) for i in range(400)]
    whole = gzip.compress(b"".join(noise))
    ids, gaps = found(whole[: len(whole) // 2] + record(900))
    assert ids[-1] == 900 and 100 < len(ids) < 400 and ids[:-1] == list(range(len(ids) - 1)) and "gzip" in gaps[-1][2]
    ids, gaps = found(whole[:-5])
    assert ids == list(range(400)) and [w for _, _, w in gaps] == ["gzip member cut off"]
    ids, gaps = found(whole[:-8] + bytes([whole[-8] ^ 1]) + whole[-7:] + gzip.compress(record(901)))
    assert ids == [*range(400), 901] and len(gaps) == 1


def test_members_of_any_size_stream_by(monkeypatch):
    import tracemalloc

    body = bytes(range(256)) * 40
    n = 12_000
    z = gzip.compress(b"".join(record(i, body) for i in range(n)), 1)  # 125 MB of content
    data = z + record(n)
    tracemalloc.start()
    ids = [int(r["warc-record-id"][5:-1]) for _, _, r, why in warc.salvage(data) if not why]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert ids == list(range(n + 1)) and peak < 30 << 20


def test_streamed_members_salvage_as_kept_ones(monkeypatch):
    a, b, c = record(1, b"x" * 5000), record(2, b"text" * 1000), record(3, b"y" * 70_000)
    lies = b"WARC/1.1\r\nContent-Length: 90000\r\n\r\n"
    inner = a + b.replace(b"text", b"tExt", 1) + c + lies + b"junk" * 300 + record(4) + b"z" * 100_000 + record(5) + b"WARC/1.1\r\nContent-Length: 999999999\r\n\r\n" + record(6) + b"WARC/1.1\r\nnever"
    noise = b"".join(record(i, hashlib.sha512(b"%d" % i).hexdigest().encode() * 9) for i in range(10, 400))
    cases = [gzip.compress(inner), gzip.compress(inner + noise)[:-6] + record(9), gzip.compress(noise)[:20_000] + gzip.compress(a), gzip.compress(b"0" * (1 << 20)), gzip.compress(a)[:-3] + b]
    want = [found(x) for x in cases]
    assert want[0][0] == [1, 3, 4, 5, 6]
    monkeypatch.setattr(warc, "KEPT", 1000)
    monkeypatch.setattr(warc, "LARGE", 2000)
    assert [found(x) for x in cases] == want


def test_a_huge_payload_leaves_the_files_of_small_ones(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES_MOST", 1 << 20)
    rows = [(i, "u", f"text {i}", "", "") for i in range(200)] + [(900, "u", "z" * (3 << 20), "", ""), (901, "u", "y" * 100_000, "", ""), (902, "u", "y" * 100_000, "", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, payload string, digest string").coalesce(1)
    warc.write(df, f"{tmp_path}/h")
    got = warc.read(spark, f"{tmp_path}/h").collect()
    assert sorted(int(r.record_id[12:-1]) for r in got) == sorted(r[0] for r in rows) and not any(r.gap for r in got)
    assert {r.record_id: r.refers_to for r in got}["<urn:x-page:902>"] == "<urn:x-page:901>"
    assert len({r.archive for r in got if int(r.record_id[12:-1]) < 200}) == 1
