import json
import random

import pytest
from pyspark.sql import functions as F

from marketlake.llm import chat


def test_layouts_become_turns(spark):
    records = [
        (1, {"prompt": "p", "response": "r"}),
        (2, {"output": "o", "instruction": "i", "system": "s"}),
        (3, {"instruction": "i", "input": "", "output": "o"}),
        (4, {"instruction": "i", "input": "n", "output": "o"}),
        (5, {"messages": [{"role": "user", "content": "a"}, {"content": "b", "role": "assistant"}]}),
        (6, {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}),
        (7, {"prompt": 12, "response": None}),
        (8, {"unheard": {"of": 1}}),
    ]
    frame = spark.createDataFrame([(i, json.dumps(r)) for i, r in records] + [(9, "no json"), (10, None)], "id long, record string")
    found = {r["id"]: (r["layout"], r["turns"] and [tuple(t) for t in r["turns"]]) for r in chat.canonical(frame).collect()}
    assert found == {
        1: ("prompt", [("user", "p"), ("assistant", "r")]),
        2: ("instruction", [("system", "s"), ("user", "i"), ("assistant", "o")]),
        3: ("instruction_input", [("user", "i"), ("assistant", "o")]),
        4: ("instruction_input", [("user", "i"), ("user", "n"), ("assistant", "o")]),
        5: ("messages", [("user", "a"), ("assistant", "b")]),
        6: ("from_value", [("user", "a"), ("assistant", "b")]),
        7: ("prompt", [("user", "12"), ("assistant", "")]),
        8: (None, None),
        9: (None, None),
        10: (None, None),
    }


def test_values_do_not_change_the_shape(spark):
    texts = ['{"a": 1, "b": [{"c": "x: OBJECT<", "d": null}]}', '{"b": [{"d": 1.5, "c": true}], "a": "2020-01-01"}']
    frame = spark.createDataFrame([(t,) for t in texts], "record string")
    shapes = {r[0] for r in frame.select(chat.shape(F.col("record"))).collect()}
    assert shapes == {chat.declared_shape(("a", "b", "b[].c", "b[].d"))}


@pytest.fixture(scope="module")
def odd_rows():
    draw = random.Random(3)
    parts = [*chat.CONTROL_STRINGS, "<", "[", "\\", "\\\\", "|im_end|>", "/s>", "INST]", "a", "\n", "é", "𝄞", " ", "\x00", '"']
    rows = []
    for conversation in range(60):
        for turn in range(draw.randint(1, 6)):
            text = "".join(draw.choices(parts, k=draw.randint(0, 8)))
            rows.append((conversation, turn, draw.choice(["user", "assistant", "system", "", "a<|im_sep|>b"]), text))
    rows += [(100, 0, None, None), (None, 0, "user", "x"), (101, 0, "user", "s"), (101, 0, "user", "s"), (102, None, "assistant", "y" * 50_000)]
    return rows


def test_reading_gives_back_what_was_written(spark, odd_rows):
    frame = spark.createDataFrame(odd_rows, "conv_id long, turn long, role string, text string")
    frame = frame.withColumn("id", F.lit("clash")).withColumn("record", F.lit(0))
    output = chat.formatted(chat.canonical(chat.records_of_rows(frame, "conv_id")))
    read = {r["id"]: r for r in chat.read_back(output).collect()}
    expected = {}
    for c, turn, role, text in sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode())):
        expected.setdefault(c, []).append((role or "", text or ""))
    assert {i: [tuple(t) for t in r["turns"]] for i, r in read.items()} == expected
    for i, r in read.items():
        assert list(r["learned"]) == [text for role, text in expected[i] if role == "assistant"]


def test_spans_mark_the_texts(spark, odd_rows):
    frame = spark.createDataFrame(odd_rows, "conv_id long, turn long, role string, text string")
    output = chat.formatted(chat.canonical(chat.records_of_rows(frame, "conv_id")))
    for r in output.collect():
        end = 0
        for span in r["spans"]:
            assert r["formatted"][end : span["start"]].endswith(chat.SEPARATOR)
            end = span["start"] + span["length"]
            assert not any(c in r["formatted"][span["start"] : end] for c in chat.CONTROL_STRINGS)
            assert r["formatted"][end:].startswith(chat.END + "\n")


def test_texts_beyond_the_parsers_limits(spark):
    roles = F.when(F.col("id") % 2 == 0, "user").otherwise("assistant")
    text = F.when(F.col("id") == 1, F.repeat(F.lit('a"b\\'), 5_250_000)).otherwise("xxx")
    rows = spark.range(5).select(F.floor(F.col("id") / 2).alias("conv_id"), F.col("id").alias("turn"), roles.alias("role"), text.alias("text"))
    output = chat.formatted(chat.canonical(chat.records_of_rows(rows, "conv_id")))
    found = {r["id"]: (r["n"], r["chars"]) for r in chat.read_back(output).select("id", F.size("turns").alias("n"), F.length(F.array_join("learned", "")).alias("chars")).collect()}
    assert found == {0: (2, 21_000_000), 1: (2, 3), 2: (1, 0)}


def test_equal_elements_do_not_change_the_shape(spark):
    texts = [json.dumps({"messages": [{"role": "r", "content": f'{i} \\ " {{}}'} for i in range(n)]}, separators=s) for n in (1, 500) for s in ((",", ":"), (", ", ": "))]
    frame = spark.createDataFrame([(t,) for t in texts], "record string")
    assert {r[0] for r in frame.select(chat.shape(F.col("record"))).collect()} == {chat.declared_shape(chat.LAYOUTS[3].paths)}


@pytest.mark.parametrize("record", ('{"unheard": 1}', "no json", '{"prompt": "\\q", "response": ""}', None))
def test_records_without_layout_are_not_dropped(spark, record):
    frame = spark.createDataFrame([(1, record), (2, '{"prompt": "a", "response": "b"}')], "id long, record string")
    known = chat.canonical(frame)
    assert {r["id"]: r["layout"] for r in known.collect()} == {1: None, 2: "prompt"}
    with pytest.raises(Exception, match="record of conversation 1"):
        chat.formatted(known).collect()


def test_empty_table(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.formatted(chat.canonical(chat.records_of_rows(frame, "conv_id")))).count() == 0
