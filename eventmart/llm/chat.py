r"""Chat formatting by a state machine over roles and a declarative template.

A template names, for each role, the text before and after a turn and whether
the turn's text bears loss. Control strings begin with ``[`` or ``<``; inside
texts those two characters and the backslash are escaped by a backslash, so no
text can be taken for a mark, and unescaping gives the text back. A role that the
template doesn't know is written out as a mark of its own.

The state machine has a state for each role and the start; a conversation is
valid if every turn's role may follow the one before and it ends in an accepted
state. Invalid ones are formatted too and say so.

A conversation's turns are brought together and sorted by Spark and then read
one after the other; a task holds one turn at a time, however long a
conversation is. Escaping is done before that, where the rows are read.

Cases: a null text or role is empty. Rows are ordered by turn, null first; turns
of the same number by role, then escaped text. Repeated rows are turns of their own. Rows
with a null conv_id form one conversation. Other columns are ignored. A
conversation has at least one row; an empty table has none.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPECIAL = re.compile(r"([\\\[<])")
TOKEN = re.compile(r"\\(.)|(<<ROLE>>|<</ROLE>>|<<SYS>>|<</SYS>>|\[INST\]|\[/INST\]|<s>|</s>|<end>)|([^\\\[<]+)", re.S)


@dataclass(frozen=True)
class Turn:
    """How turns of a role are written."""

    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Marks by role, and which roles may follow which; '' is the start."""

    turns: dict[str, Turn] = field(
        default_factory=lambda: {
            "system": Turn("<<SYS>>", "<</SYS>>"),
            "user": Turn("[INST]", "[/INST]"),
            "assistant": Turn("<s>", "</s>", loss=True),
        }
    )
    other: Turn = Turn("<<ROLE>>", "<end>")
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    ends: tuple[str, ...] = ("user", "assistant")

    def segments(self, role: str, escaped: str) -> list[tuple[str, bool]]:
        """The text segments of a turn, each with its loss flag; ``escaped`` is the turn's escaped text."""
        turn = self.turns.get(role)
        if turn:
            return [(turn.before, False), (escaped, turn.loss), (turn.after, False)]
        return [(f"{self.other.before}{escape(role)}<</ROLE>>", False), (escaped, False), (self.other.after, False)]


TEMPLATE = Template()


def escape(text: str) -> str:
    return SPECIAL.sub(r"\\\1", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


SEGMENTS = "conv_id long, n long, role string, valid boolean, segments array<struct<text: string, loss: boolean>>"


def formatted(conversations: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """One row for each turn, in order within a task: conv_id, n (from 0), role, valid (so far), segments.

    The conversation's formatted text is the concatenation of all its segments.
    """
    special = r"([\\\[<])"
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.regexp_replace(F.coalesce("text", F.lit("")), special, r"\\$1").alias("escaped"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "escaped")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, n, valid = object(), "", 0, True
        for rows in batches:
            convs, roles, texts = rows.column(0).to_pylist(), rows.column(2).to_pylist(), rows.column(3).to_pylist()
            out = []
            for conv, role, text in zip(convs, roles, texts, strict=True):
                if conv != current:
                    current, state, n, valid = conv, "", 0, True
                valid = valid and role in template.follows.get(state, ())
                state = role
                parts = [{"text": t, "loss": flag} for t, flag in template.segments(role, text)]
                out.append({"conv_id": conv, "n": n, "role": role, "valid": valid, "segments": parts})
                n += 1
            kind = pa.schema(
                [
                    ("conv_id", pa.int64()), ("n", pa.int64()), ("role", pa.string()), ("valid", pa.bool_()),
                    ("segments", pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))),
                ]
            )
            yield pa.RecordBatch.from_pylist(out, schema=kind)

    conversations.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    return ordered.mapInArrow(run, SEGMENTS)


def parse(text: str, template: Template = TEMPLATE) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted text."""
    before = {turn.before: role for role, turn in template.turns.items()}
    turns, role, held, naming = [], None, [], False
    at = 0
    while at < len(text):
        match = TOKEN.match(text, at)
        if not match:
            raise ValueError(f"not a formatted text at {at}")
        at = match.end()
        escaped, mark, plain = match.groups()
        if mark is None:
            held.append(plain if escaped is None else escaped)
        elif mark in before:
            role, held = before[mark], []
        elif mark == template.other.before:
            naming, held = True, []
        elif naming and mark == "<</ROLE>>":
            role, held, naming = "".join(held), [], False
        else:
            turns.append((role, "".join(held)))
            held = []
    return turns


def digests(turns: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """What can be read back from the output of ``formatted``, a row for each conversation.

    Roles and texts come from parsing the formatted text, loss text from the
    segments' flags. Hashes are fed turn by turn.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]
        current, row, whole, loss = object(), None, None, None

        def close() -> pa.RecordBatch:
            done = {**row, "turns_sha256": whole.hexdigest(), "loss_sha256": loss.hexdigest()}
            done["valid"] = done["valid"] and done.pop("last") in template.ends
            return pa.RecordBatch.from_pylist(
                [done],
                schema=pa.schema(
                    [(n, pa.string() if "sha" in n else pa.bool_() if n == "valid" else pa.int64()) for n in names]
                ),
            )

        for rows in batches:
            for conv, valid, parts in zip(
                rows.column(0).to_pylist(), rows.column(3).to_pylist(), rows.column(4).to_pylist(), strict=True
            ):
                if row is None or conv != current:
                    if row:
                        yield close()
                    current, whole, loss = conv, hashlib.sha256(), hashlib.sha256()
                    row = {"conv_id": conv, "n_turns": 0, "loss_chars": 0, "formatted_chars": 0, "valid": True, "last": ""}
                text = "".join(p["text"] for p in parts)
                for role, said in parse(text, template):
                    row["n_turns"] += 1
                    row["last"] = role
                    whole.update(f"{role}\n{said}\n".encode())
                for part in parts:
                    if part["loss"]:
                        bare = unescape(part["text"])
                        row["loss_chars"] += len(bare)
                        loss.update(bare.encode())
                row["formatted_chars"] += len(text)
                row["valid"] = row["valid"] and valid
        if row:
            yield close()

    return turns.mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, valid boolean",
    )
