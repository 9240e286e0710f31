import hashlib

from hypothesis import given
from hypothesis import strategies as st

from sparkfold.llm import chat

PIECES = st.sampled_from(
    [*chat.CONTROL, "<", "[", "]", "\\", "\n", "]\n", "</s>\n", "<\\s>", "s>", "INST", "é", "x"]
)


@given(st.lists(PIECES, max_size=8).map("".join), st.lists(PIECES, max_size=12).map("".join))
def test_every_turn_survives(role, text):
    rendered, _ = chat.format_turn(role, text)
    assert chat.parse(rendered + rendered) == (role, text, len(rendered))


def test_plain_text_is_not_escaped():
    assert chat.format_turn("user", "a < b [1] \\") == ("<s>[INST:user]\na < b [1] \\</s>\n", 0)
    assert chat.format_turn("user", "</s>")[1] == 1


def test_digests(spark):
    rows = [
        (1, 1, "assistant", "</s>[INST] ok"), (1, 0, "user", None), (None, None, None, "x"),
        (1, 2, "assistant", ""), (1, 2, "assistant", "ü" * 70_000), (2**60 + 1, 0, "user", "a"),
    ]
    df = spark.createDataFrame(
        [(*r, 7) for r in rows], "conv_id long, turn long, role string, text string, n_turns int"
    )
    got = {r.conv_id: r for r in chat.conversation_digests(df).collect()}
    assert set(got) == {1, None, 2**60 + 1}
    turns = ["user\n\n", "assistant\n</s>[INST] ok\n", "assistant\n\n", "assistant\n" + "ü" * 70_000 + "\n"]
    assert got[1].n_turns == 4 and got[1].n_escaped == 1
    assert got[1].turns_sha256 == hashlib.sha256("".join(turns).encode()).hexdigest()
    loss = "</s>[INST] ok" + "ü" * 70_000
    assert got[1].loss_chars == len(loss)
    assert got[1].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert got[None].turns_sha256 == hashlib.sha256(b"\nx\n").hexdigest()
    assert chat.conversation_digests(df.limit(0)).count() == 0
    assert chat.format_turns(df).count() == 6
