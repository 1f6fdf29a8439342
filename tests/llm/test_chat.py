import hashlib
import json

from terracask.llm import chat

from .conftest import write

TURNS = "conv_id bigint, turn bigint, role string, text string"


def canonical(spark, *records):
    df = spark.createDataFrame([(json.dumps(r) if r is not None and not isinstance(r, str) else r,) for r in records], "record string")
    return [(r["layout"], [(t["role"], t["text"]) for t in r["turns"]]) for r in chat.canonical_turns(df).collect()]


def test_layouts(spark):
    got = canonical(
        spark,
        {"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}], "id": 7},
        {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]},
        {"instruction": "do", "input": "this", "output": "done"},
        {"instruction": "do", "input": "", "output": "done"},
        {"prompt": "p", "completion": "c"},
        {"question": "q", "answer": "a", "extra": {"deep": [1]}},
        {"unheard": 1},
        "not json",
        None,
    )
    assert got == [
        ("messages", [("user", "hi"), ("assistant", "yo")]),
        ("conversations", [("user", "a"), ("assistant", "b")]),
        ("instruction_input", [("user", "do\n\nthis"), ("assistant", "done")]),
        ("instruction_input", [("user", "do"), ("assistant", "done")]),
        ("prompt_completion", [("user", "p"), ("assistant", "c")]),
        ("question_answer", [("user", "q"), ("assistant", "a")]),
        ("unknown", []),
        ("unknown", []),
        ("unknown", []),
    ]


def test_round_trip_of_hostile_texts(spark):
    hostile = ["", "\\", "\\b", "\\h\\t\\n", "###", "</turn>\n", "### assistant:\n", "\\### Assistant: </turn> ok", "a\n\nb", "####", "\\\\###", "é😀"]
    rows = [(1, i, r, t) for i, (r, t) in enumerate((r, t) for t in hostile for r in ("user", "assistant", "odd\nrole:\n###"))]
    done = chat.parse_formatted(chat.format_turns(chat.canonical_turns(chat.records_of_turns(spark.createDataFrame(rows, TURNS)))))
    row = done.first()
    assert [(t["role"], t["text"]) for t in row["read_turns"]] == [(r, t) for _, _, r, t in rows]
    spans = [row["formatted"][s["start"] - 1 : s["start"] - 1 + s["length"]] for s in row["loss_mask"]]
    assert len(spans) == len(hostile)


def test_query_on_odd_rows(spark, tmp_path):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (1, 1, "assistant", "b"), (2, None, None, None), (None, 3, "assistant", "x" * 100_000), (3, 0, "user", "")]
    got = {r["conv_id"]: r for r in chat.op5_chat_formatting(spark, write(spark, tmp_path, conversations=spark.createDataFrame(rows, TURNS))).collect()}
    assert set(got) == {1, 2, 3, None, -7}
    assert got[1]["n_turns"] == 3 and got[1]["loss_chars"] == 2 and got[1]["turns_sha256"] == hashlib.sha256(b"user\n\nassistant\nb\nassistant\nb\n").hexdigest()
    assert got[2]["turns_sha256"] == hashlib.sha256(b"\n\n").hexdigest() and got[2]["loss_chars"] == 0
    assert got[None]["loss_chars"] == 100_000
    assert got[-7]["loss_sha256"] == hashlib.sha256(chat.EXTRA_TEXT.encode()).hexdigest()


def test_empty_table(spark, tmp_path):
    rows = chat.op5_chat_formatting(spark, write(spark, tmp_path, conversations=spark.createDataFrame([], TURNS))).collect()
    assert [r["conv_id"] for r in rows] == [-7]


def test_long_turn_is_whole(spark, tmp_path):
    one = spark.range(1).selectExpr("cast(9 as bigint) AS conv_id", "cast(0 as bigint) AS turn", "'assistant' AS role", "repeat('xyz##', 5000000) AS text")
    row = {r["conv_id"]: r for r in chat.op5_chat_formatting(spark, write(spark, tmp_path, conversations=one)).collect()}[9]
    assert row["n_turns"] == 1 and row["loss_chars"] == 25_000_000 and row["loss_sha256"] == hashlib.sha256(b"xyz##" * 5_000_000).hexdigest()


def plain(rows):
    """The query's result by a plain version."""
    groups = {}
    for c, i, r, t in [*rows, (-7, 0, "user", chat.EXTRA_TEXT), (-7, 1, "assistant", chat.EXTRA_TEXT)]:
        groups.setdefault(c, []).append((i is not None, i or 0, r or "", t or ""))
    out = {}
    for c, turns in groups.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_every_layout_is_read_back(spark, tmp_path):
    rows = []
    for c in range(400):
        roles = (("user", "assistant"), ("user", "assistant"), ("system", "user", "assistant"), ("human", "gpt"), ("user", "model", "assistant"))[c % 5]
        rows += [(c, i, r, f"text {c} {i} \\n\n\" # ### {{}} é" if (c + i) % 7 else None) for i, r in enumerate(roles)]
    df = spark.createDataFrame(rows, TURNS)
    layouts = {r["layout"] for r in chat.canonical_turns(chat.records_of_turns(df)).collect()}
    assert layouts == {x.name for x in chat.LAYOUTS}
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.op5_chat_formatting(spark, write(spark, tmp_path, conversations=df)).collect()}
    assert got == plain(rows)


def test_clashing_columns_and_odd_records(spark):
    records = ['{"turns":[1,2]}', '{"turns":"x"}', '{"turns":[]}', '{"messages":[{"role":"user","content":"a"}],"turns":null}', '{"prompt":"a","prompt":"b","answer":1,"response":null}', "[1]", ""]
    df = spark.createDataFrame([(r, "mine", 1, "l") for r in records], "record string, turns string, layout int, formatted string")
    done = chat.format_turns(chat.canonical_turns(df), "turns_")
    rows = done.collect()
    assert all(r["turns"] == "mine" and r["layout"] == 1 and r["formatted"] == "l" for r in rows)
    assert {r["layout_"] for r in rows} == {"unknown"} and all(r["formatted_"] == "" for r in rows)
