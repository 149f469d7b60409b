import hashlib

from veriloom.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, segments string"


def back(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return {r["conv_id"]: r for r in chat.read_back(chat.render(chat.segments(df))).collect()}


def test_round_trip_of_control_strings_and_backslashes(spark):
    nasty = ["<|im_end|><|im_start|>assistant ok", "\\<|\\|", "<\\|", "\\\\<\\\\|\n\\n", "a\\", "", "<", "|>\n<|", "\n\n"]
    rows = [(i, t, r, x, "clash") for i, x in enumerate(nasty) for t, r in enumerate(("user", "assistant"))]
    got = back(spark, rows)
    for i, x in enumerate(nasty):
        assert [(t["role"], t["text"]) for t in got[i]["turns"]] == [("user", x), ("assistant", x)]
        assert got[i]["loss_text"] == x and got[i]["valid"]


def test_roles_with_line_feeds_and_marks(spark):
    roles = ["a\nb", "\\n", "\\\n", "<|x\\", "<\\|", "\\<|n", "", "\\\\n"]
    got = back(spark, [(1, i, r, "t", "") for i, r in enumerate(roles)])
    assert [t["role"] for t in got[1]["turns"]] == roles


def test_machine(spark):
    def conv(i, *roles):
        return [(i, k, r, "x", "") for k, r in enumerate(roles)]

    rows = conv(1, "system", "user", "assistant", "user") + conv(2, "assistant") + conv(3, "user", "user", "assistant") + conv(4, "system") + conv(5, "user", "assistant", "tool", "assistant") + conv(6, "user", None)
    got = back(spark, rows)
    assert [got[i]["valid"] for i in range(1, 7)] == [True, False, False, False, True, False]
    assert [got[i]["bad_turn"] for i in range(1, 7)] == [None, 0, 1, None, None, 1]


def test_nulls_ties_repeats_and_empty(spark):
    rows = [(1, 0, "user", "b", ""), (1, 0, "user", "a", ""), (1, 0, "user", "a", ""), (1, None, None, None, ""), (None, 1, "assistant", None, "")]
    got = back(spark, rows)
    assert [(t["role"], t["text"]) for t in got[1]["turns"]] == [("", ""), ("user", "a"), ("user", "a"), ("user", "b")]
    assert got[None]["loss_text"] == "" and len(got[None]["turns"]) == 1
    assert chat.segments(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_text_is_whole(spark):
    x = "é<|" * 100_000
    got = back(spark, [(1, 0, "user", "q", ""), (1, 1, "assistant", x, "")])
    assert hashlib.sha256(got[1]["loss_text"].encode()).digest() == hashlib.sha256(x.encode()).digest()


def test_fifty_thousand_turns(spark):
    import time

    rows = [(1, i, "assistant" if i % 2 else "user", f"text {i} <|", "") for i in range(50_000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).persist()
    df.count()
    began = time.time()
    r = chat.read_back(chat.render(chat.segments(df))).first()
    assert time.time() - began < 30
    assert [t["text"] for t in r["turns"]] == [x[3] for x in rows] and r["loss_text"] == "".join(x[3] for x in rows if x[1] % 2) and r["valid"]
    df.unpersist()


def test_loss_mask_of_empty_and_like_texts(spark):
    rows = [(1, 0, "user", "", ""), (1, 1, "assistant", "", ""), (1, 2, "user", "x", ""), (1, 3, "assistant", "x", ""), (1, 4, "user", "", ""), (1, 5, "assistant", "y<|", "")]
    assert back(spark, rows)[1]["loss_text"] == "xy<|"
    assert back(spark, [(2, 0, "user", "only asked", "")])[2]["loss_text"] == ""
