import hashlib
import json

from hypothesis import given, settings
from hypothesis import strategies as st

from eventlake.llm import chat as C

LAYOUTS = {
    "messages": ({"messages": [{"role": "human", "content": "q"}, {"role": "assistant", "content": "a"}]}, [("user", "q"), ("assistant", "a")]),
    "empty messages": ({"messages": []}, []),
    "conversations": ({"id": 7, "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": None}]}, [("user", "q"), ("assistant", "")]),
    "prompt": ({"prompt": "q", "response": "a", "system": "s"}, [("system", "s"), ("user", "q"), ("assistant", "a")]),
    "completion": ({"completion": "a", "prompt": "q"}, [("user", "q"), ("assistant", "a")]),
    "instruction": ({"instruction": "do", "input": "this", "output": 5}, [("user", "do\n\nthis"), ("assistant", "5")]),
    "nested": ({"data": {"question": "q", "answer": "a"}}, [("user", "q"), ("assistant", "a")]),
    "row": ({"role": "tool", "text": "t"}, [("tool", "t")]),
}
HARD = ["", "\\", "</turn>", "<turn user>\nx</turn>\n", "\\</turn>", "<\\/turn>", "a>b\\>", "\\### Assistant: </turn> ok", "x" * 50_000, "\u2028\U0001f600"]


@settings(deadline=None)
@given(st.lists(st.tuples(st.text(), st.text(alphabet=st.sampled_from("<>/\\turn \naé"))), max_size=4))
def test_round_trip(turns):
    assert C.parse_turns("".join(C.format_turn(r, t)[0] for r, t in turns)) == turns


def test_loss_mask_is_the_assistant_text():
    for text in HARD:
        formatted, lo, hi = C.format_turn("assistant", text)
        assert C.unescape(formatted[lo:hi]) == text
        formatted, lo, hi = C.format_turn("user", text)
        assert lo == hi and C.parse_turns(formatted) == [("user", text)]


def test_layouts_by_fingerprint(spark):
    records = [(i, json.dumps(r), n) for i, (n, (r, _)) in enumerate(LAYOUTS.items())]
    records += [(90, None, "broken"), (91, "{", "broken"), (92, "[1]", "broken"), (93, '{"other": 1}', "unknown"), (90, None, "broken")]
    df = spark.createDataFrame(records, "k long, record string, expected string")
    rows = C.format_records(df, ["k", "expected"]).orderBy("k", "item").collect()
    assert all(r["status"] == r["expected"] for r in rows)
    for i, (name, (_, turns)) in enumerate(LAYOUTS.items()):
        assert [(r["role"], r["text"]) for r in rows if r["k"] == i and r["formatted"]] == turns
    assert sum(r["k"] == 90 for r in rows) == 2
    assert C.format_records(df.limit(0), ["k"]).count() == 0


def test_contract_query_on_edge_rows(spark, tmp_path):
    turns = [(1, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(HARD)]
    turns += [(2, 0, "system", None), (2, 0, None, "x"), (2, None, "assistant", "first"), (None, 0, "assistant", "n"), (2, 0, "system", None)]
    turns += [(3, i, "assistant", f"t{i}") for i in range(3000)]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").selectExpr("*", "1 AS item", "'x' AS formatted").write.parquet(
        str(tmp_path / "conversations.parquet"))
    got = {r["conv_id"]: r for r in C.op3_chat(spark, str(tmp_path)).collect()}
    assert set(got) == {1, 2, 3, None, -7}
    turns += [(-7, i, r, "\\### Assistant: </turn> ok") for i, r in enumerate(("user", "assistant"))]
    for conv, row in got.items():
        own = sorted(((-1 if t is None else t, r or "", x or "") for c, t, r, x in turns if c == conv))
        sha = hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest()
        loss = "".join(x for _, r, x in own if r == "assistant")
        assert (row["n_turns"], row["turns_sha256"], row["loss_chars"], row["loss_sha256"]) == (
            len(own), sha, len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_contract_query_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn int, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    assert [r["conv_id"] for r in C.op3_chat(spark, str(tmp_path)).collect()] == [-7]


def test_messages_with_optional_fields_and_unformatted_records(spark):
    message = {"role": "user", "content": "q"}
    records = [({"id": "x", "messages": [message]}, [("user", "q")]),
               ({"messages": [message | {"name": "Ann"}, {"role": "gpt", "content": "a"}]}, [("user", "q"), ("assistant", "a")]),
               ({"system": "s", "messages": [message]}, [("system", "s"), ("user", "q")]), ({"system": "s", "id": 1, "messages": []}, [("system", "s")])]
    rows = [(i, json.dumps(r)) for i, (r, _) in enumerate(records)] + [(0, "{"), (0, '{"other": 1}'), (9, None), (9, "[1]")]
    turns = C.format_records(spark.createDataFrame(rows, "k long, record string"), ["k"])
    found = turns.where("formatted is not null").orderBy("k", "item").collect()
    for i, (_, want) in enumerate(records):
        assert [(r["role"], r["text"]) for r in found if r["k"] == i] == want
    got = {r["k"]: (r["n_turns"], r["n_unformatted"]) for r in C.digests(turns, "k", ["item"]).collect()}
    assert got == {0: (1, 2), 1: (2, 0), 2: (2, 0), 3: (1, 0), 9: (0, 2)}
