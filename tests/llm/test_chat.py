"""Chat formatting: round trips, masks, attachments."""

import hashlib

from hypothesis import given
from hypothesis import strategies as st

from adit.llm import chat

NASTY = ["", "</turn>\n<turn user>", r"\</turn>", "\\", "\\\\<", "<image 0/>", "### Assistant: </turn> ok\n", "a\nb", "🙂 <>"]


@given(st.text(), st.text())
def test_any_turn_reads_back(role, text):
    walk = chat.flatten([{"kind": "text", "text": text}])
    segment = f"<turn {chat.escape(role)}>{''.join(walk.out)}</turn>\n"
    assert chat.parse_segment(segment) == (role, text)


def test_conversations_read_back(spark):
    rows = [(c, t, r, x) for c in (1, None) for t, (r, x) in enumerate([("user", n) for n in NASTY] + [("assistant", n) for n in NASTY] + [(None, None), ("assistant", None)])]
    rows += [(2, 0, "user", "same"), (2, 0, "user", "same"), (2, 0, "assistant", "tie")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    segments = chat.formatted(chat.text_parts(turns))
    found = {r["conv_id"]: r for r in chat.read_back(segments).collect()}
    assert set(found) == {1, None, 2}
    for conv, r in found.items():
        own = sorted(((t, role or "", x or "") for c, t, role, x in rows if c == conv))
        assert r["n_turns"] == len(own)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{role}\n{x}\n" for _, role, x in own).encode()).hexdigest()
        said = "".join(x for _, role, x in own if role == "assistant")
        assert (r["loss_chars"], r["loss_sha256"]) == (len(said), hashlib.sha256(said.encode()).hexdigest())
        text = "".join(s["segment"] for s in sorted((s for s in segments.collect() if s["conv_id"] == conv), key=lambda s: s["position"]))
        assert r["formatted_chars"] == len(text)


def test_parts_become_ordered_placeholders(spark):
    parts = [("text", "see <this>", None, None), ("image", None, "s3://i", None), ("audio", None, "a.wav", 7), ("text", "and", None, None), ("scroll", None, None, 3), (None, "end", None, None)]
    turns = spark.createDataFrame([(1, 0, "assistant", parts), (1, 1, "user", None)], f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    first, second = sorted(chat.formatted(turns).collect(), key=lambda r: r["position"])
    assert first["segment"] == "<turn assistant>see \\<this\\><image 0/><audio 1/>and<document 2/>end</turn>\n"
    assert [(a["kind"], a["number"], a["ref"], a["tokens"]) for a in first["attachments"]] == [("image", 0, "s3://i", 256), ("audio", 1, "a.wav", 7), ("document", 2, "", 3)]
    assert first["expanded_tokens"] == 266
    assert chat.parse_segment(first["segment"]) == ("assistant", "see <this>andend")
    assert first["segment"][first["loss_start"] : first["loss_end"]].startswith("see ")
    assert second["start"] == len(first["segment"]) and second["loss_start"] is None


def test_empty_table(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string, segment string")
    assert chat.read_back(chat.formatted(chat.text_parts(turns))).count() == 0
