import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from veriloom.functions import suffixes
from veriloom.sources import capture_log, packets, parts


def write_logs(root, seed=1, lines=200):
    rng = random.Random(seed)
    want = []
    for slug in ("north", "south", "east"):
        os.makedirs(f"{root}/{slug}", exist_ok=True)
        text, at = "", 0
        for i in range(lines):
            line = json.dumps({"i": i, "x": "é" * rng.randrange(30)}, ensure_ascii=False) if i % 17 else ""
            want.append((slug, at, line))
            text += line + "\n"
            at += len(line.encode()) + 1
        with open(f"{root}/{slug}/manifest.jsonl", "w") as f:
            f.write(text)
    return sorted(want)


def seen(df):
    return sorted((r["key"], r["at"], r["text"]) for r in df.collect())


def test_lines_by_ranges_and_keys(spark, tmp_path):
    want = write_logs(str(tmp_path))
    with open(tmp_path / "north" / "other.txt", "w") as f:
        f.write("not asked for")
    for size in ("17", "1000", "1000000"):
        df = capture_log.captures(spark, str(tmp_path), glob="*.jsonl", range=size)
        assert seen(df) == want
    one = capture_log.captures(spark, f"file://{tmp_path}", glob="*.jsonl").where("key = 'south' and at > 10")
    assert seen(one) == [r for r in want if r[0] == "south" and r[1] > 10]
    reader = capture_log.CaptureReader(capture_log.Folder({"path": str(tmp_path), "glob": "*.jsonl"}))
    assert list(reader.pushFilters([capture_log.EqualTo(("key",), "east"), capture_log.EqualTo(("at",), 3)])) == [capture_log.EqualTo(("at",), 3)]
    assert {p.key for p in reader.partitions()} == {"east"}
    with open(tmp_path / "east" / "manifest.jsonl", "a") as f:
        f.write("no end")
    assert seen(capture_log.captures(spark, str(tmp_path), glob="*.jsonl").where("key = 'east'"))[-1][2] == "no end"


def test_whole_files_are_packets(spark, tmp_path):
    for name, n in (("north-packet.txt", 2), ("south-packet.txt", 3)):
        (tmp_path / name).write_text("Head\n" + "".join(f"SOURCE {i}: t{i} | https://x.org/{i}\nbody {i}\nEND SOURCE {i}\n" for i in range(1, n + 1)))
    (tmp_path / "empty-packet.txt").write_text("")
    options = {"glob": "*.txt", "key": r"([^/]+)-packet\.txt\Z", "whole": "true"}
    got = packets.sources(capture_log.captures(spark, str(tmp_path), **options).withColumnRenamed("text", "raw"))
    told = packets.sources(packets.files(spark, str(tmp_path)))
    assert sorted((r["n"], r["header"], r["body"]) for r in got.collect()) == sorted((r["n"], r["header"], r["body"]) for r in told.collect())
    assert {r["key"] for r in capture_log.captures(spark, str(tmp_path), **options).collect()} == {"north", "south", "empty"}
    stream = packets.sources(capture_log.captures_stream(spark, str(tmp_path), **options).withColumnRenamed("text", "raw"))
    out = str(tmp_path / "out")
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert sorted((r["key"], r["n"], r["body"]) for r in spark.read.parquet(out).collect()) == sorted((r["key"], r["n"], r["body"]) for r in got.collect())


def test_a_stream_goes_on_inside_files(spark, tmp_path):
    logs, out = tmp_path / "logs", str(tmp_path / "out")
    want = write_logs(str(logs), lines=50)

    def run():
        df = capture_log.captures_stream(spark, str(logs), glob="*.jsonl", range="300")
        df.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
        return seen(spark.read.parquet(out))

    with open(logs / "north" / "manifest.jsonl", "a") as f:
        f.write('{"half": ')
    assert run() == want  # a line that is being written waits
    with open(logs / "north" / "manifest.jsonl", "a") as f:
        f.write("1}\nlast\n")
    os.makedirs(logs / "west")
    (logs / "west" / "manifest.jsonl").write_text("first\n")
    got = run()
    assert [r for r in got if r not in want and r[2]] == [r for r in got if r[2] in ('{"half": 1}', "last", "first")] and len(got) == len(want) + 3
    assert run() == got
    (logs / "west" / "manifest.jsonl").write_text("f\n")
    with pytest.raises(Exception, match="is not what it was"):
        run()


def test_a_batch_is_committed_once(spark, tmp_path):
    store = str(tmp_path / "store")
    df = spark.range(100).withColumn("x", F.concat(F.lit("v"), F.col("id").cast("string"))).repartition(4)
    capture_log.commit_rows(df, store, "b-1")
    capture_log.commit_rows(df.where("id < 5"), store, "b-1")  # the same batch again writes nothing
    schema = "id long, x string"
    read = lambda: sorted(r["id"] for r in capture_log.committed(spark, store, schema).collect())
    assert read() == list(range(100))
    files = len(os.listdir(f"{store}/data"))

    fails = F.udf(lambda i: 1 // (i - 150), "long")
    with pytest.raises(Exception, match="ZeroDivision"):  # a task dies in the midst of its rows
        capture_log.commit_rows(spark.range(100, 200).select(F.col("id"), fails("id").cast("string").alias("x")), store, "b-2")
    assert read() == list(range(100)) and capture_log.committed(spark, str(tmp_path / "none"), schema).count() == 0
    capture_log.commit_rows(spark.range(100, 200).select("id", F.lit("x").alias("x")), store, "b-2")
    assert read() == list(range(200)) and files == 4
    with pytest.raises(Exception, match="batch"):
        df.write.format("committed_captures").mode("append").options(path=store).save()
    capture_log.commit_rows(df.limit(0), store, "b-3")
    assert read() == list(range(200)) and "b-3.json" in os.listdir(f"{store}/commits")


def test_a_stream_commits_its_batches_by_number(spark, tmp_path):
    capture_log.register(spark)
    store, src = str(tmp_path / "store"), str(tmp_path / "src")
    spark.range(10).write.parquet(src)

    def run(name, checkpoint):
        s = spark.readStream.schema("id long").parquet(src)
        s.writeStream.format("committed_captures").options(path=store, stream=name).option("checkpointLocation", str(tmp_path / checkpoint)).trigger(availableNow=True).start().awaitTermination()

    run("a", "c1")
    run("a", "c2")  # a lost checkpoint replays batch 0, which is there
    ids = lambda: sorted(r["id"] for r in capture_log.committed(spark, store, "id long").collect())
    assert ids() == list(range(10))
    spark.range(10, 15).write.mode("append").parquet(src)
    run("a", "c1")
    assert ids() == list(range(15))


def test_parts_of_files_and_errors_as_rows(spark):
    good = parts.build_docx(["one", "", "two & <three>"], [["a", "b"], ["c", "d"]], ["Head", "Head", "Other"])
    df = spark.createDataFrame([("g", good, 1), ("cut", good[:200], 2), ("null", None, 3), ("what", b"hello", 4), ("pdf", b"%PDF-1.4 nothing", 5)], "name string, content binary, n int")
    got = parts.parts(df).collect()
    of = lambda n: [(r["kind"], r["position"], r["text"]) for r in got if r["name"] == n]
    assert of("g") == [("paragraph", 0, "one"), ("paragraph", 1, ""), ("paragraph", 2, "two & <three>"), ("row", 0, "a | b"), ("row", 1, "c | d"), ("header", 0, "Head"), ("header", 1, "Other")]
    errors = {r["name"]: r["error"] for r in got if r["error"]}
    assert set(errors) == {"cut", "null", "what", "pdf"} and "empty file" in errors["null"] and len(got) == 7 + 4
    assert {r["kind"] for r in parts.parts(df.where("name = 'g'"), kinds=("header",)).collect()} == {"header"}


def shortest(text, at, least, most):
    for n in range(least, most + 1):
        p = text[at : at + n]
        if len(p) == n and sum(text.startswith(p, i) for i in range(len(text))) == 1:
            return n
    return None


def test_anchors_equal_brute_force(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice(["ab", "c ", ". ", "é. ", "😀", "ab. c"]) for _ in range(rng.randrange(60))) for _ in range(25)] + ["", None, "aaaa. aaaa. aaaa", "x"]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "id int, text string, length int")
    got = {(r["id"], r["at"]): (r["length"], r["anchor"]) for r in suffixes.anchors(df, "id", "text", 3, 12).collect()}
    want = {}
    for i, t in enumerate(texts):
        if t:
            for at in [0] + [k + 2 for k in range(len(t) - 2) if t[k] in ".?!" and t[k + 1] == " "]:
                n = shortest(t, at, 3, 12)
                want[i, at] = (n, t[at : at + n] if n else None)
    assert got == want


def test_suffix_ranks_are_near_linear():
    import numpy as np

    took = []
    for n in (1 << 15, 1 << 17):
        began = time.time()
        u = suffixes.unique_lengths(np.tile(np.arange(64, dtype=np.uint32), n // 64))  # as repetitive as can be
        took.append(time.time() - began)
        assert u[0] == n - 64 + 1
    assert took[1] < 12 * max(took[0], 0.02)
