"""Layouts, reversible escapes, loss masks, and the query against its SQL."""

import json
import os
import subprocess
import sys

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm import chat_format as c

LAYOUTS = [
    ("messages", {"messages": [{"role": "user", "content": "a"}, {"content": "b", "role": "assistant"}]}, [("user", "a"), ("assistant", "b")]),
    ("messages", {"messages": []}, []),
    ("messages", {"messages": [{"role": None, "content": None}]}, [("", "")]),
    ("turns", {"turns": [{"text": "x", "role": "system"}]}, [("system", "x")]),
    ("conversations", {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "r"}]}, [("user", "q"), ("assistant", "r")]),
    ("prompt_response", {"response": "r", "prompt": "p"}, [("user", "p"), ("assistant", "r")]),
    ("prompt_completion", {"prompt": "p", "completion": 3}, [("user", "p"), ("assistant", "3")]),
    ("instruction", {"instruction": "i", "output": "o"}, [("user", "i"), ("assistant", "o")]),
    ("instruction_input", {"instruction": "i", "input": "n", "output": "o"}, [("user", "i"), ("user", "n"), ("assistant", "o")]),
    ("question_answer", {"question": "q", "answer": "a"}, [("user", "q"), ("assistant", "a")]),
    (None, {"something": "else"}, None),
    (None, {"messages": [{"role": "user", "content": {"parts": ["x"]}}]}, None),
]


def test_layouts_by_fingerprint(rows):
    data = [(i, json.dumps(p), "old") for i, (_, p, _) in enumerate(LAYOUTS)] + [(90, None, "old"), (91, "{no json", "old"), (92, "7", "old")]
    df = rows("id long, payload string, layout string", data)
    for r in c.canonical_turns(df).collect():
        layout, _, turns = LAYOUTS[r.id] if r.id < 90 else (None, None, None)
        assert r.layout == layout, (r.id, layout)
        assert (r.turns and [tuple(t) for t in r.turns]) == turns or turns == [] == r.turns
    assert c.canonical_turns(df.limit(0)).count() == 0


TEXT = st.text(alphabet=st.sampled_from(list("ab \\[]<>/sINT:\n]é🎉") ), max_size=25)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a] b", "<s>", ""]), TEXT), max_size=4), min_size=1, max_size=4))
def test_any_turns_come_back(spark, conversations):
    data = [(i, [{"role": r, "text": t} for r, t in turns]) for i, turns in enumerate(conversations)]
    df = spark.createDataFrame(data, "id long, turns array<struct<role string, text string>>")
    out = c.format_turns(df, "id").select(
        "id", "formatted", c.parse_turns(F.col("formatted")).alias("back"), c.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"), "loss_spans"
    )
    for r in out.collect():
        turns = conversations[r.id]
        assert [tuple(t) for t in r.back] == turns
        assert r.loss == "".join(t for role, t in turns if role == "assistant")
        assert len(r.loss_spans) == sum(role == "assistant" for role, _ in turns)
        bodies = r.formatted
        for span in reversed(r.loss_spans):
            bodies = bodies[: span.start] + bodies[span.end :]
        # only the template's own control strings stand in the text
        assert r.formatted.count("[/INST]") == sum(role != "assistant" for role, _ in turns)
        assert r.formatted.count("</s>") == sum(role == "assistant" for role, _ in turns)


def test_records_of_rows_nulls_ties_and_empty(rows):
    data = [(1, 0, "user", None), (1, 1, "assistant", "b"), (2, 1, "z", "late"), (2, 0, "user", "a"), (2, 0, None, "a"), (3, None, "user", "x" * 50_000)]
    df = rows("conv long, turn long, role string, text string, payload string", [(*d, "old") for d in data])
    got = {r.conv: json.loads(r.payload) for r in c.as_records(df, "conv", "turn").collect()}
    assert got[1] == {"prompt": "", "response": "b"}
    assert got[2] == {"messages": [{"role": "", "content": "a"}, {"role": "user", "content": "a"}, {"role": "z", "content": "late"}]}
    assert len(got[3]["messages"][0]["content"]) == 50_000
    assert c.as_records(df.limit(0), "conv", "turn").count() == 0


def test_rows_without_a_key_are_one_conversation(rows):
    df = rows("conv long, turn long, role string, text string", [(None, 1, "assistant", "b"), (None, 0, "user", "a"), (1, 0, "user", None)])
    turns = c.canonical_turns(c.as_records(df, "conv", "turn"), strict=True)
    got = {r["conv"]: [tuple(t) for t in r["turns"]] for r in turns.collect()}
    assert got == {None: [("user", "a"), ("assistant", "b")], 1: [("user", "")]}
    empty = c.format_turns(c.canonical_turns(rows("id long, payload string", [(1, None), (2, '{"messages": []}')])), "id")
    assert {(r.id, r.formatted, tuple(r.loss_spans)) for r in empty.collect()} == {(1, "<s>", ()), (2, "<s>", ())}


def test_skeleton_keeps_the_paths(rows):
    texts = ['a "b" \\', "\n\t,:{}[]", "\\\\", '","x":"', "é🎉" * 300, ""]
    payloads = [json.dumps(p) for _, p, _ in LAYOUTS]
    payloads += [json.dumps({"messages": [{"role": t, "content": t} for t in texts * 3]}), json.dumps({t: t for t in texts})]
    payloads += [json.dumps([{"a": [{"b": t}, {"b": 1}, {"c": t}]} for t in texts], indent=2), "{no json", '{"prompt": "x', "7"]
    df = rows("id long, payload string", list(enumerate(payloads)))
    short = F.col("payload")
    for r in df.select("payload", c.schema_paths(short).alias("whole"), c.schema_paths(c.skeleton(short)).alias("bare")).collect():
        assert r.whole == r.bare, r.payload


LONG = """
import hashlib, sys
from pyspark.sql import functions as F
from ledgerloom.llm.queries import op6_chat_format
from ledgerloom.session import build_session, scratch_path

spark = build_session("local[2]", app_name="long-chat", shuffle_partitions=4)
rows = [(1, 0, "user", 1), (1, 1, "assistant", 2_400_000), (2, 0, "user", 3)]
rows += [(3, i, "user" if i % 2 else "assistant", 1_150_000) for i in range(14)]
said = lambda n: '<"' + "abc, [d] " * n
path = scratch_path(spark, "long-chat")
table = spark.createDataFrame(rows, "conv_id long, turn long, role string, n int").repartition(4)
text = F.concat(F.lit(said(0)), F.repeat(F.lit("abc, [d] "), F.col("n")))
table.withColumn("text", text).drop("n").write.parquet(f"{path}/conversations.parquet")
got = {r.conv_id: r for r in op6_chat_format(spark, path).collect()}
assert sorted(got) == [-7, 1, 2, 3], got
digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
for conv in (1, 2, 3):
    turns = [(role, said(n)) for i, _, role, n in rows if i == conv]
    loss = "".join(text for role, text in turns if role == "assistant")
    spoken = "".join(f"{role}\\n{text}\\n" for role, text in turns)
    assert (got[conv].n_turns, got[conv].loss_chars) == (len(turns), len(loss)), got[conv]
    assert (got[conv].loss_sha256, got[conv].turns_sha256) == (digest(loss), digest(spoken)), conv
"""


def test_long_texts_and_long_conversations_keep_all_turns():
    """A text of more than 20 million characters, and a conversation of more than 128 MiB (in a heap of its own)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = os.environ | {
        "PYSPARK_SUBMIT_ARGS": "--driver-memory 6g --conf spark.ui.enabled=false pyspark-shell",
        "PYTHONPATH": os.pathsep.join(x for x in (root, os.environ.get("PYTHONPATH", "")) if x),
    }
    run = subprocess.run([sys.executable, "-c", LONG], env=env, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-3000:]


def test_strict_fails_on_a_record_without_turns(rows):
    df = rows("id long, payload string", [(1, '{"prompt": "p", "response": "r"}'), (2, None), (3, '{"some": "thing"}')])
    assert c.canonical_turns(df.where("id < 3"), strict=True).where("turns IS NULL").count() == 1
    with pytest.raises(Exception, match="a record has no turns"):
        c.canonical_turns(df, strict=True).select("turns").collect()
