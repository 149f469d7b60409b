import random
import time

import pandas as pd
import pytest

from veriloom.streaming import stateful


def plain(events):
    """Retention by a plain loop in order of seq."""
    held, out = (None, None), []
    for seq, h, result, capture in sorted(events):
        stored = h != held[0] or result == "drift"
        out.append((seq, stored, held[1] if stored else None))
        if stored:
            held = (h, capture)
    return out


def write(spark, path, rows, schema, files=1):
    spark.createDataFrame(rows, schema).repartition(files).write.mode("append").parquet(path)


def run(spark, path, schema, f, out, log, **options):
    with stateful.rocksdb(spark):
        s = spark.readStream.schema(schema).options(**options).parquet(path)
        q = f(s).writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", log).trigger(availableNow=True).start()
        q.awaitTermination()


EVENTS = "slug string, kind string, seq long, hash string, result string, capture string"


def test_a_hot_key_in_any_order_and_in_chunks(spark, tmp_path, monkeypatch):
    rng = random.Random(1)
    n = 60_000
    hot = [(i, rng.choice("abc"), rng.choice(["drift", "confirmed", None]), f"c{i}") for i in range(n)]
    rows = [("hot", None, *e) for e in hot] + [(f"k{i}", "main", i, "h", "x", f"d{i}") for i in range(50)]
    rng.shuffle(rows)
    path, out, log = (str(tmp_path / x) for x in ("in", "out", "log"))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5000")
    try:
        write(spark, path, rows, EVENTS, 5)
        run(spark, path, EVENTS, stateful.retained, out, log)
        more = [(n + i, rng.choice("abc"), "confirmed", f"c{n + i}") for i in range(100)]
        write(spark, path, [("hot", "main", *e) for e in more], EVENTS)
        run(spark, path, EVENTS, stateful.retained, out, log)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    got = sorted((r["seq"], r["stored"], r["supersedes"]) for r in spark.read.parquet(out).where("slug = 'hot'").collect())
    assert got == plain([(a, b, c, d) for a, b, c, d in hot + more])
    assert spark.read.parquet(out).count() == n + 150


class Blocks:
    """Map state that iterates in order of its keys, and counts what is held of it at once."""

    def __init__(self):
        self.kept: dict = {}

    def updateValue(self, key, value):
        self.kept[key] = value

    def iterator(self):
        yield from sorted(self.kept.items())

    def clear(self):
        self.kept = {}


class Plain(stateful.InOrder):
    def handleInputRows(self, key, rows, timerValues):
        return self.in_order(rows)


def test_pieces_hold_no_more_than_blocks_that_overlap():
    p = Plain()
    p.blocks = Blocks()
    rng = random.Random(2)
    seqs = list(range(-5000, 295_000))
    near = [x for at in range(0, len(seqs), 30_000) for x in rng.sample(seqs[at : at + 30_000], 30_000)]  # disorder of 30,000 events
    chunks = (pd.DataFrame({"seq": near[at : at + 7_000]}) for at in range(0, len(near), 7_000))
    sizes, out = [], []
    for df in p.in_order(chunks):
        sizes.append(len(df))
        out += df["seq"].tolist()
    assert out == seqs and max(sizes) < 70_000 and not p.blocks.kept
    assert [d["seq"].tolist() for d in p.in_order(iter([pd.DataFrame({"seq": [3, 1, 2]})]))] == [[1, 2, 3]] and list(p.in_order(iter([]))) == []


def test_the_store_must_iterate_in_order():
    p = Plain()
    p.blocks = Blocks()
    p.blocks.iterator = lambda: iter(sorted(p.blocks.kept.items(), reverse=True))
    with pytest.raises(ValueError, match="RocksDB"):
        list(p.in_order(iter([pd.DataFrame({"seq": [1]}), pd.DataFrame({"seq": [2]})])))


SAID = "url string, seq long, at long, event string"


def test_submissions_expire_by_the_clock_and_repeats_count_once(spark, tmp_path):
    path, out, log = (str(tmp_path / x) for x in ("in", "out", "log"))
    spark.createDataFrame([], SAID).write.parquet(path)
    with stateful.rocksdb(spark):
        s = stateful.confirmations(spark.readStream.schema(SAID).parquet(path), timers=True, term=15_000)
        q = s.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", log).trigger(processingTime="1 second").start()
        seen = []

        def until(n):
            """Wait for n rows in all; a minute at most."""
            end = time.time() + 60
            while time.time() < end:
                try:
                    seen[:] = [(r["url"], r["seq"], r["outcome"], r["failures"], r["status"]) for r in spark.read.parquet(out).collect()]
                except Exception:  # noqa: BLE001  nothing is written yet
                    pass
                if len(seen) >= n:
                    return
                time.sleep(1)
            raise AssertionError(seen)

        try:
            write(spark, path, [("a", 1, 0, "submit"), ("b", 1, 0, "submit"), ("b", 2, 1, "hard"), ("b", 2, 1, "hard")], SAID)
            until(3)
            write(spark, path, [("b", 3, 2, "confirmed"), ("b", 2, 1, "hard")], SAID)
            until(5)  # and the submission of which nothing more was heard
        finally:
            q.stop()
    assert sorted(seen, key=str) == sorted([("a", 1, "pending", 0, "pending"), ("a", None, "expired", 0, "open"), ("b", 1, "pending", 0, "pending"), ("b", 2, "failed", 1, "pending"), ("b", 3, "confirmed", 1, "open")], key=str)


def test_keys_share_calls_and_keep_apart(spark, tmp_path):
    rng = random.Random(4)
    path, out, log = (str(tmp_path / x) for x in ("in", "out", "log"))
    keys = [(s, k) for s in [None, *map(str, range(30))] for k in (None, "a", "b")]
    events = {k: [] for k in keys}
    calls = []
    for turn in range(2):  # the second run goes on from what the first holds
        rows = []
        for k in keys:
            for i in rng.sample(range(1000), rng.randrange(4)):
                events[k].append((1000 * turn + i, rng.choice(["x", "y", None]), rng.choice(["drift", None, None]), rng.choice([f"c{i}", None])))
                rows.append((*k, *events[k][-1]))
        write(spark, path, rows, EVENTS, 3)
        with stateful.rocksdb(spark):
            q = stateful.retained(spark.readStream.schema(EVENTS).parquet(path), 4).writeStream.format("parquet").option("path", out).option("checkpointLocation", log).trigger(availableNow=True).start()
            q.awaitTermination()
            calls += [p["stateOperators"][0]["numRowsUpdated"] for p in q.recentProgress if p["stateOperators"]]
    got = {}
    for r in spark.read.parquet(out).collect():
        got.setdefault((r["slug"], r["kind"]), []).append((r["seq"], r["stored"], r["supersedes"]))
    assert {k: sorted(v) for k, v in got.items()} == {(s, k or "main"): plain(v) for (s, k), v in events.items() if v}
    assert calls and max(calls) <= 4  # 93 keys
