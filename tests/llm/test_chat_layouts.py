"""Records in every known layout, records whose elements disagree, and lists where texts belong."""

import json

import pytest

pytest.importorskip("indipanel.llm")

from pyspark.sql import functions as F  # noqa: E402

from indipanel.llm import chat  # noqa: E402

Q, A, S = ("user", "q"), ("assistant", "a"), ("system", "s")

CASES = [
    # elements that disagree, whichever comes first: no turn is emptied
    ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "value": "LOST"}]}, None, None),
    ({"messages": [{"content": "q"}, {"role": "assistant", "content": "a"}]}, None, None),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt"}]}, None, None),
    # lists of parts
    ({"messages": [{"role": "user", "content": [{"type": "text", "text": "q"}, "r"]}, {"role": "assistant", "content": "a"}]},
     "messages", [("user", "q\nr"), A]),
    ({"messages": [{"role": "user", "content": [{"type": "image", "url": "u"}]}]}, None, None),
    ({"messages": [{"role": "user", "content": {"text": "q"}}]}, None, None),
    ({"prompt": ["q", "r"], "completion": "a"}, "prompt_completion", [("user", "q\nr"), A]),
    # a prompt that is a list of messages
    ({"prompt": [{"role": "system", "content": "s"}, {"role": "user", "content": "q"}], "completion": "a"},
     "prompt_messages_completion", [S, Q, A]),
    ({"prompt": [{"role": "user", "content": "q"}], "response": "a"}, "prompt_messages_response", [Q, A]),
    ({"prompt": [{"role": "user", "content": "q"}], "completion": [{"role": "assistant", "content": "a"}]},
     "prompt_completion_messages", [Q, A]),
    # system fields
    ({"system": "s", "instruction": "q", "output": "a"}, "system_instruction", [S, Q, A]),
    ({"system": "s", "instruction": "q", "input": "", "output": "a"}, "system_instruction_input", [S, Q, A]),
    ({"system": "s", "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, "system_from_value", [S, Q, A]),
    ({"system": "s", "messages": [{"role": "user", "content": "q"}]}, "system_messages", [S, Q]),
    ({"system": "s", "prompt": "q", "completion": "a"}, "system_prompt_completion", [S, Q, A]),
    ({"system": "s", "prompt": "q", "response": "a", "extra": {"x": 1}}, "system_prompt_response", [S, Q, A]),
    # two answers
    ({"prompt": "q", "response": "a", "completion": "b"}, None, None),
    # nulls, numbers, odd roles
    ({"messages": [{"role": "user", "content": None}, {"role": None, "content": 7}]}, "messages", [("user", ""), ("", "7")]),
    ({"messages": "q"}, None, None), ({"messages": ["q"]}, None, None), ({"messages": []}, None, None), ([1], None, None),
    ({"question": "q", "answer": "a" * 200_000}, "question_answer", [Q, ("assistant", "a" * 200_000)]),
]


def test_records(spark):
    records = [(k, json.dumps(r)) for k, (r, _, _) in enumerate(CASES)] + [(-1, None), (-2, "{"), (None, '{"question":"q","answer":"a"}')]
    df = spark.createDataFrame(records, "conv_id long, record string")
    got = {r["conv_id"]: (r["layout"], r["turns"] and [tuple(t) for t in r["turns"]]) for r in chat.canonical_records(df).collect()}
    assert len(got) == len(records)
    for k, (record, layout, turns) in enumerate(CASES):
        assert got[k] == (layout, turns), str(record)[:200]
    assert got[-1] == got[-2] == (None, None) and got[None] == ("question_answer", [Q, A])
    done = chat.format_turns(chat.canonical_records(df))
    back = {r["conv_id"]: r["turns"] for r in done.filter("layout is not null").select("conv_id", chat.read_turns(F.col("formatted")).alias("turns")).collect()}
    for k, (_, layout, turns) in enumerate(CASES):
        assert layout is None or [tuple(t) for t in back[k]] == turns


def test_every_layout_has_a_fingerprint_of_its_own(spark):
    layouts = [x for x in chat.LAYOUTS if x.name != "rows"]
    assert len({frozenset(x.paths) for x in layouts}) == len(layouts) == len({x.name for x in layouts})


def test_tables_with_lists(spark):
    nested = spark.createDataFrame([(1, [("user", [("text", "q"), ("text", "r")])])],
                                   "conv_id long, messages array<struct<role:string,content:array<struct<type:string,text:string>>>>")
    assert [tuple(t) for t in chat.canonical(nested).first()["turns"]] == [("user", "q\nr")]
    both = spark.createDataFrame([(1, "s", "q", "a", 5)], "conv_id long, system string, prompt string, completion string, layout int")
    assert [tuple(t) for t in chat.canonical(both).first()["turns"]] == [S, Q, A]
    assert chat.format_chat(both.limit(0)).count() == 0
