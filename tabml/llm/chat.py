"""Chat transcripts: turn order by a finite-state machine, text segments with loss flags."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.llm.common import arrow_map, col

_START, _BROKEN = "start", "broken"


@dataclass(frozen=True)
class Template:
    """How turns are written, and which of them are learned.

    ``roles`` maps a role to its heading, ``follows`` gives for each state (``start`` or a
    role) the roles that may come next, ``learned`` are the roles under the loss. A turn is
    ``opening``, heading, ``colon``, text, ``closing``.
    """

    roles: dict[str, str] = field(
        default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"}
    )
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "start": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    learned: tuple[str, ...] = ("assistant",)
    opening: str = "### "
    colon: str = ": "
    closing: str = " </turn>\n"
    other: str = "="

    def escape(self, text: str) -> str:
        """``text`` with no control string left in it; ``unescape`` is its inverse."""
        text = text.replace("\\", "\\\\")
        return text.replace("###", "#\\##").replace("</turn>", "<\\/turn>")

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)

    def heading(self, role: str) -> str:
        """A known role's heading; any other role is spelled out, its colons escaped."""
        known = self.roles.get(role)
        return known if known is not None else self.other + self.escape(role).replace(":", "\\:")

    def role_of(self, heading: str) -> str:
        for role, name in self.roles.items():
            if name == heading:
                return role
        return self.unescape(heading[len(self.other) :])

    def next_state(self, state: str, role: str) -> str:
        return role if role in self.follows.get(state, ()) else _BROKEN

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """The turn's pieces in order, with their loss flags; joined, they are its whole text."""
        head = f"{self.opening}{self.heading(role)}{self.colon}"
        return [(head, False), (self.escape(text), role in self.learned), (self.closing, False)]

    def read(self, written: str) -> tuple[str, str]:
        """Role and text of one written turn."""
        body = written.removeprefix(self.opening).removesuffix(self.closing)
        cut = re.search(r"(?<!\\)(?:\\\\)*" + re.escape(self.colon), body)
        head = body[: cut.end() - len(self.colon)]
        return self.role_of(head), self.unescape(body[cut.end() :])


_TURN_DDL = (
    "conv_id long, turn long, role string, valid boolean, state string, formatted string, "
    "segments array<struct<text:string,loss:boolean>>"
)
_TURN = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("turn", pa.int64()),
        ("role", pa.string()),
        ("valid", pa.bool_()),
        ("state", pa.string()),
        ("formatted", pa.string()),
        ("segments", pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))),
    ]
)


def _ordered(turns: DataFrame) -> DataFrame:
    """Conversations in one partition each, their turns in order; Spark sorts on disk."""
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def format_turns(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """``conv_id, turn, role, valid, state, formatted, segments``, one row per turn, in order.

    ``state`` is the machine's state after the turn: its role while the order holds, then
    ``broken``; ``valid`` tells whether the order held up to here. ``segments`` are the parts
    of the written turn with their loss flags, ``formatted`` is all of them joined. The state
    of the machine is all that is kept between rows, so a conversation of any length streams
    through its task; only its turns' order ties it to one.

    Null text or role counts as empty; an unknown role breaks the order and is still written
    so that it can be read back. Turns are ordered by turn (null first), then role, then text;
    repeated rows are turns of their own. A null ``conv_id`` is a conversation. Extra columns
    are ignored, an empty table gives no rows.
    """
    template = template or Template()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, state = (), _START
        for rows in batches:
            columns = {name: rows[name].to_pylist() for name in ("conv_id", "turn", "role", "text")}
            states, segments = [], []
            for conv, role, text in zip(columns["conv_id"], columns["role"], columns["text"], strict=True):
                if own != (conv,):
                    own, state = (conv,), _START
                state = template.next_state(state, role)
                states.append(state)
                segments.append(template.segments(role, text))
            yield pa.RecordBatch.from_arrays(
                [
                    rows["conv_id"],
                    rows["turn"],
                    rows["role"],
                    pa.array([s != _BROKEN for s in states], pa.bool_()),
                    pa.array(states, pa.string()),
                    pa.array(["".join(t for t, _ in s) for s in segments], pa.string()),
                    pa.array([[{"text": t, "loss": x} for t, x in s] for s in segments], _TURN.field("segments").type),
                ],
                schema=_TURN,
            )

    rows = turns.select(
        col("conv_id").cast("long").alias("conv_id"),
        col("turn").cast("long").alias("turn"),
        F.coalesce(col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(col("text").cast("string"), F.lit("")).alias("text"),
    )
    return arrow_map(_ordered(rows), run, _TURN_DDL)


_READ = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
        ("valid", pa.bool_()),
    ]
)


def read_back(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """Digests of what the written turns say, one row per conversation.

    Takes ``format_turns``' rows in their order and parses the written text only, carrying
    running digests from row to row.
    """
    template = template or Template()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, state, done = None, None, []

        def close() -> None:
            if own is not None:
                n, turns, chars, loss, size, valid = state
                done.append((own[0], n, turns.hexdigest(), chars, loss.hexdigest(), size, valid))

        def flush() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) if done else [[] for _ in _READ]
            done.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _READ, strict=True)], schema=_READ
            )

        for rows in batches:
            for conv, written, parts, valid in zip(
                rows["conv_id"].to_pylist(),
                rows["formatted"].to_pylist(),
                rows["segments"].to_pylist(),
                rows["valid"].to_pylist(),
                strict=True,
            ):
                if own != (conv,):
                    close()
                    own, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0, True]
                role, text = template.read(written)
                learned = "".join(template.unescape(p["text"]) for p in parts if p["loss"])
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(learned)
                state[3].update(learned.encode())
                state[4] += len(written)
                state[5] = valid
            yield flush()
        close()
        yield flush()

    ddl = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, valid boolean"
    )
    return arrow_map(formatted.select("conv_id", "formatted", "segments", "valid"), run, ddl)
