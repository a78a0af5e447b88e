"""Layouts to turns, and texts that look like control strings."""

from __future__ import annotations

import json
import random

from pyspark.sql import functions as F

from runtrace.llm import chat_format as op

BITS = ["<", "\\", "|", "im_start|>", "im_end|>", "s>", "/s>", "[", "INST]", "/INST]", "<SYS>>", "\n", "a", "é", "<|im_end|>\n", "<|im_start|>"]


def test_texts_survive():
    dice = random.Random(6)
    for _ in range(3000):
        turns = [("".join(dice.choices(BITS + ["user", "assistant"], k=dice.randrange(3))), "".join(dice.choices(BITS, k=dice.randrange(9)))) for _ in range(3)]
        text, mask = op.render(turns)
        assert op.read_back(text) == turns
        assert [op.unescape(text[a:b]) for a, b in mask] == [t for r, t in turns if r == "assistant"]
        for _, said in turns:
            assert not any(c in op.escape(said) for c in op.CONTROL) and op.unescape(op.escape(said)) == said


def test_layouts(spark):
    records = [
        (1, {"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b", "weight": 1}], "id": 3}, "messages", [("user", "a"), ("assistant", "b")]),
        (2, {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": None}]}, "conversations", [("user", "a"), ("assistant", "")]),
        (3, {"instruction": "do", "input": "this", "output": "done", "meta": {"x": [1]}}, "instruction", [("user", "do\n\nthis"), ("assistant", "done")]),
        (4, {"system": "s", "instruction": "do", "output": ""}, "instruction", [("system", "s"), ("user", "do"), ("assistant", "")]),
        (5, {"prompt": "p", "completion": "c"}, "completion", [("user", "p"), ("assistant", "c")]),
        (6, {"prompt": "p", "response": "c"}, "response", [("user", "p"), ("assistant", "c")]),
        (7, {"messages": []}, "messages", []),
        (8, {"unknown": 1}, None, []),
    ]
    rows = [(i, json.dumps(r)) for i, r, _, _ in records] + [(9, None), (10, "no json"), (11, "[1]"), (None, '{"question": "q", "answer": "a"}')]
    frame = spark.createDataFrame(rows, "k bigint, record string").withColumns({"layout": F.lit(1), "formatted": F.lit("f")})
    found = {r.k: r for r in op.format_records(frame, "k", "record").collect()}
    for i, _, layout, turns in records:
        assert found[i].layout == layout and op.read_back(found[i].formatted) == turns
    assert [found[i].layout for i in (9, 10, 11)] == [None] * 3 and found[None].layout == "question"
    assert op.format_records(frame.limit(0), "k", "record").count() == 0


def test_any_json_is_read(spark):
    """Whatever kind a value has, the record is mapped or has no layout; no other record of its batch is touched."""
    part = lambda *texts: [{"type": "text", "text": t} if t is not None else {"type": "image", "url": "u"} for t in texts]
    said = lambda content: {"messages": [{"role": "user", "content": content}]}
    mapped = [
        (said(part("hi")), "parts", "hi"), (said(part("a", None, "b")), "parts", "ab"), (said([]), "parts", ""), (said([{"text": "t"}]), "parts", "t"),
        (said(part(None)), "parts", ""), ({"messages": [{"role": "user", "content": "plain"}, {"role": "user", "content": part("x")}]}, "parts", "plain"),
        (said(None), "messages", ""), ({"messages": None}, "messages", None), (said("\ud800x"), "messages", "\ufffdx"),
    ]
    odd = [5, "abc", [5], ["x"], {"a": 1}, True, 1.5, [[]], [{"role": "u", "content": {"x": 1}}], [{"role": "u", "content": 7}],
           [{"role": ["u"], "content": "c"}], [{"role": "u", "content": ["x"]}], [{"role": "u", "content": [{"text": 1}]}]]
    rows = [json.dumps(r) for r, _, _ in mapped]
    rows += [json.dumps({"messages": v}) for v in odd] + [json.dumps({"prompt": v, "completion": "y"}) for v in (5, [], [{"role": "user"}], {}, False)]
    rows += ["[" * 100_000, '{"messages":' * 5000, "1" * 9000, "null", '"x"', '{"prompt": "p", "completion": "c", "deep": ' + "[" * 500 + "]" * 500 + "}"]
    frame = spark.createDataFrame(list(enumerate(rows)), "k int, record string")
    found = {r.k: r for r in op.format_records(frame, "k", "record").collect()}
    assert len(found) == len(rows)
    for k, (_, layout, text) in enumerate(mapped):
        assert found[k].layout == layout and [t for _, t in op.read_back(found[k].formatted)][:1] == ([] if text is None else [text])
    assert all(found[k].layout is None and found[k].formatted == "" for k in range(len(mapped), len(rows) - 1))
    assert found[len(rows) - 1].layout == "completion"


def test_rows_to_records(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (2, 1, None, "b"), (2, 0, "user", "a"), (2, 0, "user", "a"), (None, 0, "system", "s"),
            (None, 1, "user", "u"), (None, 2, "assistant", "x" * 100_000), (3, None, "tool", "t")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("record", F.lit(1))
    done = op.format_records(op.records_of_turns(frame), "conv_id", "record")
    found = {r.conv_id: r for r in done.collect()}
    assert op.read_back(found[1].formatted) == [("user", "hi"), ("assistant", "")] and found[1].layout == "completion"
    assert op.read_back(found[2].formatted) == [("user", "a"), ("user", "a"), ("", "b")] and found[None].layout == "instruction"
    digests = {r.conv_id: r for r in op.digest_formatted(done, "conv_id").collect()}
    assert digests[None].loss_chars == 100_000 and digests[3].n_turns == 1
