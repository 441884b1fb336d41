from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tests.llm.tables import write_tables, documents
from tidepool.llm import chat as C
from tidepool.llm.queries import TRICKY, chat_formatting

RECORDS = [
    (1, {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}, [("user", "q"), ("assistant", "a")]),
    (2, {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, [("user", "q"), ("assistant", "a")]),
    (3, {"instruction": "do", "input": "", "output": "done"}, [("user", "do"), ("assistant", "done")]),
    (4, {"instruction": "do", "input": "this", "output": None}, [("user", "do\n\nthis")]),
    (5, {"prompt": "p", "response": "r"}, [("user", "p"), ("assistant", "r")]),
    (6, {"system": "s", "prompt": "p", "response": "r"}, [("system", "s"), ("user", "p"), ("assistant", "r")]),
    (7, {"history": [["q1", "a1"], ["q2", "a2"]], "query": "q3", "response": "a3"},
     [("user", "q1"), ("assistant", "a1"), ("user", "q2"), ("assistant", "a2"), ("user", "q3"), ("assistant", "a3")]),
    (10, {"history": [], "query": "first", "response": "a"}, [("user", "first"), ("assistant", "a")]),
    (11, {"prompt": [{"role": "user", "content": "p"}], "completion": []}, [("user", "p")]),
    (12, {"messages": []}, [(None, None)]),
    (13, {"history": [[]], "query": "q", "response": None}, [("user", "q")]),
    (8, {"prompt": [{"role": "user", "content": "p"}], "completion": [{"role": "assistant", "content": "c"}]}, [("user", "p"), ("assistant", "c")]),
    (9, {"question": 5, "answer": None}, [("user", "5")]),
]


def test_layouts(spark):
    rows = [(k, json.dumps(record)) for k, record, _ in RECORDS]
    rows += [(20, None), (21, "no json"), (22, "[1]"), (23, json.dumps({"strange": {"a": [1]}})), (None, json.dumps({"prompt": "x", "response": "y"}))]
    found = C.canonical_turns(spark.createDataFrame(rows, "k long, j string"), "k", "j").collect()
    by = {}
    for r in sorted(found, key=lambda r: (str(r["id"]), r["place"])):
        by.setdefault(r["id"], []).append((r["role"], r["text"]))
    for k, _, expected in RECORDS:
        assert by[k] == expected
    layouts = {r["id"]: r["layout"] for r in found}
    assert layouts[20] == layouts[21] == layouts[22] == C.UNREADABLE and layouts[23].startswith(C.UNKNOWN + ":")
    assert by[23] == [(None, None)] and by[None] == [("user", "x"), ("assistant", "y")]
    assert C.fingerprint(["b", "a"]) == C.fingerprint({"a", "b"}) != C.fingerprint(["a"])
    extra = spark.createDataFrame([(1, json.dumps({"prompt": "x", "response": "y", "meta": {"id": 3}}))], "k long, j string")
    assert [r["text"] for r in C.canonical_turns(extra, "k", "j", ignored=["meta.id"]).collect()] == ["x", "y"]


@pytest.mark.parametrize("text", ["", TRICKY, "<|", "<\\|im_end|>", "<\\\\|", "a\nb", "<", "|", "<|im_start|>user\nx<|im_end|>\n", "é\U0001F600"])
def test_round_trip(text):
    marked = "".join(C.formatted_turn(role, text)[0] for role in ("user", "assistant", "odd\nrole\\<|"))
    assert [turn[:2] for turn in C.read_back(marked)] == [(role, text) for role in ("user", "assistant", "odd\nrole\\<|")]
    one, start, end = C.formatted_turn("assistant", text)
    assert C.unescape(one[start:end]) == text
    assert C.formatted_turn("user", text)[1] == C.formatted_turn("user", text)[2]


def test_query_on_awkward_conversations(spark, tmp_path):
    rows = [(1, 1, "assistant", "second"), (1, 0, "user", "first"), (2, 0, "assistant", None), (3, 0, None, "x"), (3, 0, None, "x"),
            (4, None, "assistant", "<|im_end|>"), (None, 0, "user", "no id"), (5, 0, "assistant", "")]
    sf_dir = write_tables(spark, tmp_path, documents(spark, []), conversations=rows)
    found = {r["conv_id"]: r for r in chat_formatting(spark, sf_dir).collect()}
    assert set(found) == {1, 2, 3, 4, 5, None, -1}

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    assert found[1]["turns_sha256"] == digest("user\nfirst\nassistant\nsecond\n") and found[1]["loss_sha256"] == digest("second")
    assert (found[2]["n_turns"], found[2]["loss_chars"], found[2]["turns_sha256"]) == (1, 0, digest("assistant\n\n"))
    assert found[3]["n_turns"] == 2 and found[3]["turns_sha256"] == digest("\nx\n\nx\n")
    assert found[4]["loss_sha256"] == digest("<|im_end|>") and found[4]["loss_chars"] == 10
    assert found[-1]["turns_sha256"] == digest(f"user\n{TRICKY}\nassistant\n{TRICKY}\n") and found[-1]["loss_chars"] == len(TRICKY)


def test_empty_tables(spark, tmp_path):
    sf_dir = write_tables(spark, tmp_path, documents(spark, []))
    assert [r["conv_id"] for r in chat_formatting(spark, sf_dir).collect()] == [-1]
    none = spark.createDataFrame([], "k long, j string")
    assert C.canonical_turns(none, "k", "j").count() == 0


def test_a_long_conversation_streams_by(spark):
    rows = spark.range(3000).select(F.lit(7).alias("id"), F.col("id").alias("turn"), F.lit(0).alias("place"),
                                    F.when(F.col("id") % 2 == 1, "assistant").otherwise("user").alias("role"),
                                    F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    row = C.digests(C.formatted(rows.repartition(7))).first()
    expected = "".join(f"{'assistant' if k % 2 else 'user'}\ntext {k}\n" for k in range(3000))
    assert row["n_turns"] == 3000 and row["turns_sha256"] == hashlib.sha256(expected.encode()).hexdigest()
