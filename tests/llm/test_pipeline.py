import hashlib
import random
import re

import public_tokenizers as P
import tiktoken

import corpus_pipeline
from tests.llm.test_minhash import brute
from veriloom.llm import bpe, secretscan


def test_stages_take_effect(spark, tmp_path):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    prose = lambda n: [word() for _ in range(n)]
    item = prose(30)
    rows, toxic, leaked = [], set(), set()
    for i in range(120):
        w = prose(60)
        if i % 10 == 3:
            w[5:5] = ["vermin", "scumbag"]
            toxic.add(i)
        if i % 15 == 4:
            w[9:9] = item[15:] + ["and"] + item[:15]
            leaked.add(i)
        if i % 12 == 5:
            w += ["token=abcdefgh12345"]
        rows.append((i, " ".join(w)))
    copies = {200 + i: i for i in (6, 7, 8)}
    rows += [(k, re.sub(r"\S+$", "changed", rows[i][1])) for k, i in copies.items()]
    rows += [(300, None), (301, ""), (None, "no id here at all"), (6, rows[6][1])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(120)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    for k, (name, f) in enumerate(corpus_pipeline.STAGES):
        f(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        now = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert now.columns == docs.columns, name
        seen.append({r.doc_id: (r.text if k < 4 else r) for r in now.collect()})
        if k == 1:
            assert now.where("doc_id = 6").count() == 1
    tox, near, leak, red, coded = seen
    kept = [(i, t) for i, t in dict(rows).items() if i is not None and i not in toxic]
    assert set(tox) == {i for i, _ in kept} | {None}
    comp = brute(kept, 5, 80)
    assert set(near) == {i for i, c in comp.items() if c[2]} | {None}
    assert not set(near) & set(copies)
    assert set(leak) == set(near) - leaked
    assert red[5].endswith("[SECRET]") and set(red) == set(leak) and red[300] is None
    assert all(not secretscan.base_spans(t or "") for t in red.values())
    ranks = bpe.read_ranks(open(P.path("byte_bpe_multi_50k.tiktoken"), "rb").read())
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for i, r in coded.items():
        ids = enc.encode_ordinary(red[i] or "")
        assert list(r.ids) == ids and r.n_tokens == len(ids) and r.decoded_sha256 == hashlib.sha256((red[i] or "").encode()).hexdigest()
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == set(coded)


def test_empty_tables_long_texts_and_further_columns(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, hit string, component_id long, __gone long"
    long = " ".join(f"w{i * 37 % 9001}" for i in range(60_000))
    rows = [(1, long, "en", "s", len(long), "h", 5, 6), (2, None, None, None, None, None, None, None), (3, "short text", "en", "s", 10, "h", 5, 6), (3, "short text", "en", "s", 10, "h", 5, 6)]
    for name, docs in (("some", rows), ("none", [])):
        path = f"{tmp_path}/{name}"
        spark.createDataFrame(docs, schema).write.parquet(f"{path}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
        now = spark.read.parquet(f"{path}/documents.parquet")
        for k, (stage, f) in enumerate(corpus_pipeline.STAGES):
            f(spark, now, path).write.parquet(f"{path}/{k}")
            now = spark.read.parquet(f"{path}/{k}")
            assert k == 4 or now.columns == [c.split()[0] for c in schema.split(", ")], stage
        assert sorted(r.doc_id for r in now.collect()) == ([1, 2, 3] if docs else [])
