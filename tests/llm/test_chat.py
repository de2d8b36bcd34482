import hashlib
import json

import pytest

from storelens.llm import chat

TRICKY = ["", "plain", "\\### Assistant: </turn> ok", "### User: a</turn>\n### ", "\\", "\\\\", "a\\</turn>\n", "####", "\\\\###", "</turn>", "</turn>\n", "\n", "é\U0001f600 </turn"]


@pytest.mark.parametrize("roles", [["system", "user", "assistant"], ["", "tool: \"x\"\n", "Assistant"]])
def test_round_trip(roles):
    turns = [(roles[k % 3], t) for k, t in enumerate(TRICKY)]
    text, spans = chat.format_turns(turns)
    assert chat.parse_turns(text) == turns
    assert [chat.unescaped(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
    assert chat.parse_turns("") == [] and chat.format_turns([]) == ("", [])


RECORDS = [
    ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}], "id": 4}, "messages", [("user", "a"), ("assistant", "b")]),
    ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": None}]}, "conversations", [("user", "a"), ("assistant", "")]),
    ({"instruction": "i", "input": "x", "output": "o"}, "instruction", [("user", "i\n\nx"), ("assistant", "o")]),
    ({"instruction": "i", "input": "", "output": "o", "system": "s"}, "instruction", [("system", "s"), ("user", "i"), ("assistant", "o")]),
    ({"instruction": "i", "output": "o"}, "instruction", [("user", "i"), ("assistant", "o")]),
    ({"prompt": "p", "completion": "c"}, "completion", [("user", "p"), ("assistant", "c")]),
    ({"prompt": "p", "response": "c"}, "response", [("user", "p"), ("assistant", "c")]),
    ({"question": "q", "answer": "a"}, "question", [("user", "q"), ("assistant", "a")]),
    ({"prompt": [{"role": "user", "content": "p"}], "completion": [{"role": "assistant", "content": "c"}]}, "prompt messages", [("user", "p"), ("assistant", "c")]),
    ({"turns": [{"role": "user", "text": "t"}]}, "rows", [("user", "t")]),
    ({"prompt": "only"}, None, None), ([1, 2], None, None), ({}, None, None),
]


@pytest.mark.parametrize("record, layout, turns", RECORDS)
def test_layouts_by_fingerprint(record, layout, turns):
    mapping = chat.Layouts().find(record)[1] if isinstance(record, dict) else None
    assert (mapping.name if mapping else None) == layout
    if mapping:
        assert chat.canonical_turns(record, mapping) == turns


def test_fingerprints_tell_layouts_apart():
    assert len({chat.fingerprint(set(m.paths())) for m in chat.LAYOUTS}) == len(chat.LAYOUTS)
    assert chat.field_paths({"a": [{"b": 1}, {"c": [2]}], "d": {}}) == {"a[].b", "a[].c[]"}


def test_records_of_all_layouts(spark):
    rows = [(k, json.dumps(r), "clash", "clash") for k, (r, *_) in enumerate(RECORDS)] + [(90, None, None, None), (91, "{broken", None, None), (0, json.dumps(RECORDS[0][0]), "clash", "clash")]
    records = spark.createDataFrame(rows, "conv_id long, record string, note string, `_row` string")
    found = chat.format_records(records).collect()
    assert len(found) == len(rows)
    for r in found:
        want = RECORDS[r.conv_id][2] if r.conv_id < 90 else None
        assert (chat.parse_turns(r.formatted) if r.formatted is not None else None) == want
    assert chat.format_records(records.limit(0)).count() == 0


def test_conversations_with_nulls_ties_and_repeats(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (1, 1, "assistant", "b"), (1, 1, "assistant", "a"), (2, None, None, "x"), (2, 0, "assistant", None), (None, 0, "user", "u"), (3, 0, "assistant", "y" * 200_000)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, record int")
    got = {r.conv_id: r for r in chat.digests(chat.format_records(chat.conversation_records(frame))).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert (got[1].n_turns, got[1].turns_sha256, got[1].loss_chars, got[1].loss_sha256) == (4, sha("user\n\nassistant\na\nassistant\nb\nassistant\nb\n"), 3, sha("abb"))
    assert (got[2].n_turns, got[2].turns_sha256, got[2].loss_sha256) == (2, sha("\nx\nassistant\n\n"), sha(""))
    assert got[None].n_turns == 1 and got[3].loss_chars == 200_000
    assert chat.digests(chat.format_records(chat.conversation_records(frame.limit(0)))).count() == 0


def test_roles_of_rows_stay_as_they_are(spark):
    """Names that stand for a role elsewhere are roles of their own in the table, as in the SQL."""
    for role in ("human", "gpt", "bot", "ai", "model", "prompter", "User"):
        mapping = chat.Layouts().find({"turns": [{"role": role, "text": "t"}]})[1]
        assert chat.canonical_turns({"turns": [{"role": role, "text": "t"}]}, mapping) == [(role, "t")]
        assert chat.parse_turns(chat.format_turns([(role, "t"), ("assistant", "u")])[0]) == [(role, "t"), ("assistant", "u")]
    shared = {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}
    assert chat.canonical_turns(shared, chat.Layouts().find(shared)[1]) == [("user", "a"), ("assistant", "b")]


def test_reading_back_takes_time_in_proportion():
    import time

    text = "</turn>\n" * 1_300_000 + "\\" * 100_000  # 10 MB of control strings
    start = time.time()
    assert chat.parse_turns(chat.format_turns([("user", text)])[0]) == [("user", text)] and time.time() - start < 20
