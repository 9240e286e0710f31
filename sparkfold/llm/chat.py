"""Chat formatting checked by a grammar round trip.

Every turn is rendered as ``OPEN role MID text CLOSE``. The text is first rendered as it is; the
rendered turn is parsed again by a deterministic parser, and where the parser does not recover
exactly the source turn, the next level of escaping is used: level 1 puts one more backslash
behind the first character of every control string, level 2 does the same with every bracket.
The parser removes one backslash from whatever looks escaped, so it needs no note of the level.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The control strings of the template.
OPEN, MID, CLOSE = "<s>[INST:", "]\n", "</s>\n"
CONTROL = ("<s>", "</s>", "[INST:", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
#: The role whose texts are under the loss mask.
LEARNED = "assistant"

_TAILS = "|".join(re.escape(c[1:]) for c in sorted(CONTROL, key=len, reverse=True))
_CONTROL = re.compile(rf"([<\[])(\\*)(?={_TAILS})")
_BRACKET = re.compile(r"([<\[\]])(\\*)")
_ESCAPED = re.compile(rf"([<\[])\\(\\*)(?={_TAILS})")
_ESCAPED_ALL = re.compile(r"([<\[\]])\\(\\*)")
_BARE = re.compile(rf"[<\[](?={_TAILS})")
#: Marks a text whose brackets are all escaped (level 2).
STRICT = "<s>"


def escape(text: str, level: int) -> str:
    if level == 0:
        return text
    if level == 1:
        return _CONTROL.sub(r"\1\\\2", text)
    return STRICT + _BRACKET.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    strict = text.startswith(STRICT)
    if _BARE.search(text, len(STRICT) if strict else 0):
        raise ValueError("A control string stands inside a text.")
    if strict:
        return _ESCAPED_ALL.sub(r"\1\2", text[len(STRICT) :])
    return _ESCAPED.sub(r"\1\2", text)


def render(role: str, text: str, role_level: int = 0, level: int = 0) -> str:
    return f"{OPEN}{escape(role, role_level)}{MID}{escape(text, level)}{CLOSE}"


def parse(rendered: str, at: int = 0) -> tuple[str, str, int]:
    """One turn from a position: role, text and where the next turn begins."""
    if not rendered.startswith(OPEN, at):
        raise ValueError(f"No turn begins at {at}.")
    start = at + len(OPEN)
    middle = rendered.find(MID, start)
    end = rendered.find(CLOSE, middle + len(MID)) if middle >= 0 else -1
    if end < 0:
        raise ValueError(f"The turn that begins at {at} does not end.")
    return (
        unescape(rendered[start:middle]),
        unescape(rendered[middle + len(MID) : end]),
        end + len(CLOSE),
    )


def format_turn(role: str, text: str) -> tuple[str, int]:
    """The turn at the lowest level of escaping at which it survives the round trip."""
    for level in (0, 1, 2):
        rendered = render(role, text, level if level == 2 else 0, level)
        try:
            if parse(rendered) == (role, text, len(rendered)):
                return rendered, level
        except ValueError:
            pass
    raise ValueError("A turn does not survive the round trip.")


class Digest:
    """What is read back from the formatted turns of one conversation, turn by turn."""

    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted = self.escaped = 0

    def add(self, rendered: str, level: int) -> None:
        role, text, _ = parse(rendered)
        self.n_turns += 1
        self.formatted += len(rendered)
        self.escaped += level > 0
        self.turns.update(f"{role}\n{text}\n".encode())
        if role == LEARNED:
            self.loss_chars += len(text)
            self.loss.update(text.encode())

    def row(self, conv_id) -> tuple:
        return (
            conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars,
            self.loss.hexdigest(), self.formatted, self.escaped,
        )


DIGEST = (
    "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, n_escaped long"
)


def _in_order(conversations: DataFrame) -> DataFrame:
    """Rows of a conversation next to each other in one partition, by turn (NULL first)."""
    rows = conversations.select(
        F.col("conv_id").cast("string").alias("conv_id"),
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def format_turns(conversations: DataFrame) -> DataFrame:
    """Rendered turns: one row (conv_id, turn, role, rendered, level) per row of the input.

    The formatted conversation is the concatenation of its rendered turns by turn. NULL roles and
    texts are empty; nothing is dropped.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = [format_turn(r, t) for r, t in zip(batch["role"], batch["text"])]
            yield batch.drop(columns="text").assign(
                rendered=[x[0] for x in done], level=[x[1] for x in done]
            )

    rows = conversations.select(
        F.col("conv_id").cast("string").alias("conv_id"),
        F.col("turn").cast("string").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return rows.mapInPandas(
        run, "conv_id string, turn string, role string, rendered string, level int"
    ).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        "role", "rendered", "level",
    )


def conversation_digests(conversations: DataFrame) -> DataFrame:
    """Format every conversation, read it back and return one row per conversation.

    Rows of a conversation are ordered by turn, equal turns by role and text; NULL turns come
    first, a NULL conv_id is a conversation of its own, NULL roles and texts are empty, repeated
    rows are turns of their own, an empty table gives an empty result. Turns are streamed through
    running digests, so a conversation of any length needs the memory of one batch.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, digest = None, None
        for batch in batches:
            done = []
            for conv, role, text in zip(batch["conv_id"], batch["role"], batch["text"]):
                if digest is None or conv != current:
                    if digest is not None:
                        done.append(digest.row(current))
                    current, digest = conv, Digest()
                digest.add(*format_turn(role, text))
            yield pd.DataFrame(done, columns=names)
        if digest is not None:
            yield pd.DataFrame([digest.row(current)], columns=names)

    names = [x.split()[0] for x in DIGEST.split(", ")]
    return (
        _in_order(conversations)
        .mapInPandas(run, DIGEST)
        .withColumn("conv_id", F.col("conv_id").cast("long"))
    )
