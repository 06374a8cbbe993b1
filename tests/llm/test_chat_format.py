"""Round trips through the chat template."""

from __future__ import annotations

import hashlib
import itertools
import json

from pyspark.sql import functions as F

from pricelake.llm import chat_format as chat

NASTY = ["", "\\", "\\\\", "<|", "<|end|>", "<\\|", "\\<|end|>", "</s>[INST] ok [/INST]", "[\\INST]", "<<SYS>>x<</SYS>>", "<start_of_turn>", "é😀\n<|start|>user<|sep|>", "a\tb\r\n", "$1 \\1"]


def run(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, payload string")
    return chat.formatted(chat.canonical(chat.conversation_records(frame)))


def test_round_trip_of_every_pair_of_nasty_texts(spark):
    rows, want = [], {}
    for conv, (a, b) in enumerate(itertools.product(NASTY, NASTY)):
        turns = [("user", a + b), ("assistant", b + a)] if conv % 2 else [("system", b), ("user", a), ("assistant", a + b), ("tool<|", b)]
        want[conv] = turns
        rows += [(conv, i, r, t, "p") for i, (r, t) in enumerate(turns)]
    got = chat.digests(run(spark, rows))
    for r in got.collect():
        turns = want[r["conv_id"]]
        text = "".join(f"{a}\n{b}\n" for a, b in turns)
        loss = "".join(b for a, b in turns if a == "assistant")
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_no_text_forges_a_marker(spark):
    out = run(spark, [(1, 0, "user", "".join(NASTY), None), (1, 1, "assistant", "<|end|><|start|>", None)]).select("formatted").first()[0]
    assert out.count("<|start|>") == out.count("<|sep|>") == out.count("<|end|>") == 2


def test_layouts_and_unmapped_records(spark):
    records = [
        (1, {"prompt": "p", "response": "r"}), (2, {"response": "r", "prompt": "p", "system": "s"}), (3, {"instruction": "i", "input": "x", "output": "o"}),
        (4, {"messages": [{"role": "user", "content": "u"}, {"content": None, "role": "assistant"}]}),
        (5, {"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]}), (6, {"other": {"deep": [1]}}), (7, None),
    ]
    frame = spark.createDataFrame([(i, None if p is None else json.dumps(p)) for i, p in records], "conv_id long, payload string")
    told = chat.canonical(frame)
    got = {r["conv_id"]: (r["layout"], [tuple(t) for t in r["turns"] or ()]) for r in told.collect()}
    assert got[1] == ("prompt", [("user", "p"), ("assistant", "r")])
    assert got[2] == ("guided", [("system", "s"), ("user", "p"), ("assistant", "r")])
    assert got[3] == ("instruction", [("user", "i\n\nx"), ("assistant", "o")])
    assert got[4] == ("messages", [("user", "u"), ("assistant", "")])
    assert got[5] == ("dialogue", [("user", "h"), ("assistant", "g")])
    assert {r["conv_id"] for r in chat.unmapped(told).collect()} == {6, 7}
    assert told.filter("conv_id in (1, 2)").select(F.count_distinct("fingerprint")).first()[0] == 2


def test_edge_cases(spark):
    rows = [(1, 1, None, None, None), (1, None, "user", "first", None), (1, 1, None, None, None), (None, 0, "assistant", "x", None)]
    got = {r["conv_id"]: r for r in chat.digests(run(spark, rows)).collect()}
    assert got[1]["n_turns"] == 3 and got[1]["loss_chars"] == 0 and got[None]["loss_chars"] == 1
    assert got[1]["turns_sha256"] == hashlib.sha256(b"user\nfirst\n\n\n\n\n").hexdigest()
    assert chat.digests(run(spark, [])).collect() == []


def test_records_beyond_a_variant_value_keep_their_turns(spark):
    rows = [(conv, i, r, t, None) for conv, roles in ((1, ("user", "assistant")), (2, ("user", "assistant", "tool")), (3, ("user", "assistant", "user")))
            for i, (r, t) in enumerate(zip(roles, NASTY[7:10] if conv == 1 else ["a\\\"b: {", "\"", "é\n"]))]
    records = chat.conversation_records(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, payload string"))
    small, large = (sorted(map(tuple, chat.canonical(records, variant_bytes=n).select("conv_id", "layout", "turns").collect())) for n in (1 << 20, 1))
    assert small == large and {r[1] for r in small} == {"prompt", "messages", "dialogue"}
    frame = spark.createDataFrame([(1, 0, "user", "x\\"), (1, 1, "assistant", "yes")], "conv_id long, turn int, role string, text string")
    frame = frame.withColumn("text", F.when(F.col("turn") == 0, F.repeat("text", 45 << 20)).otherwise(F.col("text")))
    got = chat.canonical(chat.conversation_records(frame)).select("layout", F.char_length(F.col("turns")[0]["text"]).alias("n"), F.col("turns")[1]["text"].alias("b"))
    assert tuple(got.first()) == ("prompt", 90 << 20, "yes")
