"""Chat formatting: a finite-state machine over roles and a declarative template.

Each turn becomes three segments (what opens it, its text, what closes it), each with a flag
whether a model is trained on it.  The machine's state after a turn says which roles may
follow.  Control strings inside a text are escaped reversibly, so the formatted text can be
read back.

A conversation's turns are sorted in their partition and streamed: a task holds one turn and
the machine's state, however long a conversation is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Turn:
    """How a role's turns are written: (text, loss flag) before and after, and the flag of the
    turn's own text."""

    opens: str
    closes: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    roles: dict[str, Turn]
    #: state: {role: next state}; a role that is missing is out of turn and leaves the state.
    moves: dict[str, dict[str, str]]
    start: str
    #: states a conversation may end in
    ends: frozenset[str]
    #: further control strings, such as parts of marks that mean something by themselves
    more_controls: tuple[str, ...] = ()
    #: how a role that isn't listed is written; {role} is its escaped name
    other: Turn = field(default=Turn("[ROLE]{role}[:ROLE]", "[/ROLE]"))

    def controls(self) -> list[str]:
        marks = [m for t in self.roles.values() for m in (t.opens, t.closes)] + [*self.more_controls, "[ROLE]", "[:ROLE]", "[/ROLE]"]
        return sorted({m.strip() for m in marks if m.strip()}, key=lambda m: (-len(m), m))


#: Marks in the usual instruction style.
INSTRUCT = Template(
    roles={
        "system": Turn("<<SYS>>\n", "\n<</SYS>>\n"),
        "user": Turn("<s>[INST] ", " [/INST]"),
        "assistant": Turn("[OUT] ", " </s>", loss=True),
    },
    moves={
        "start": {"system": "told", "user": "asked"},
        "told": {"user": "asked"},
        "asked": {"assistant": "answered"},
        "answered": {"user": "asked"},
    },
    start="start",
    ends=frozenset({"answered"}),
    more_controls=("<s>", "[INST]"),
)

SEGMENTS = "conv_id long, turn_no long, part int, text string, loss boolean, state string, in_order boolean"


class Writer:
    """Escapes texts and marks turns by a template."""

    def __init__(self, template: Template):
        self.template = template
        controls = template.controls()
        if any(len(c) < 2 or "\\" in c for c in controls):
            raise ValueError("control strings have two characters at least and no backslash")
        # After the first character of each control string goes a backslash, and each backslash
        # is doubled: no control string is left, whatever stands beside the text.
        self._special = re.compile("(\\\\)|(?=" + "|".join(map(re.escape, controls)) + ")(.)", re.S)
        self.any_control = re.compile("|".join(map(re.escape, controls)))

    def escape(self, text: str) -> str:
        return self._special.sub(lambda m: "\\\\" if m[1] else m[2] + "\\", text)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", lambda m: "\\" if m[1] == "\\" else m[1], text, flags=re.S)

    def turn(self, role: str, text: str) -> list[tuple[str, bool]]:
        how = self.template.roles.get(role, self.template.other)
        return [(how.opens.replace("{role}", self.escape(role)) if role not in self.template.roles else how.opens, False), (self.escape(text), how.loss), (how.closes, False)]


class Machine:
    def __init__(self, template: Template):
        self.template, self.state = template, template.start

    def step(self, role: str) -> bool:
        """Move on; whether the role was in turn."""
        after = self.template.moves.get(self.state, {}).get(role)
        self.state = after or self.state
        return after is not None


class Reader:
    """Reads turns back out of a stream of formatted text.  It keeps what it hasn't understood
    yet: less than a turn."""

    def __init__(self, template: Template):
        self.template = template
        self.opens = {t.opens: (role, t.closes) for role, t in template.roles.items()}
        self.close = template.other.closes
        self.buffer = ""
        self.any_control = Writer(template).any_control

    def feed(self, piece: str) -> Iterator[tuple[str, str]]:
        self.buffer += piece
        while (turn := self._turn()) is not None:
            yield turn

    def _turn(self) -> tuple[str, str] | None:
        for mark, (role, close) in self.opens.items():
            if self.buffer.startswith(mark):
                return self._upto(role, len(mark), close)
        if self.buffer.startswith("[ROLE]") and (at := self.buffer.find("[:ROLE]")) >= 0:
            return self._upto(Writer.unescape(self.buffer[6:at]), at + 7, self.close)
        return None

    def _upto(self, role: str, begin: int, close: str) -> tuple[str, str] | None:
        # The first control string behind the opening mark is the closing one.
        found = self.any_control.search(self.buffer, begin)
        if found is None:
            return None
        lead = len(close) - len(close.lstrip())
        end = found.start() - lead
        if end < begin or len(self.buffer) < end + len(close):
            return None
        if self.buffer[end : end + len(close)] != close:
            raise ValueError("not what the template writes")
        text = Writer.unescape(self.buffer[begin:end])
        self.buffer = self.buffer[end + len(close) :]
        return role, text


def _sorted(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    rows = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _streamed(batches: Iterator[pa.RecordBatch], begin: Callable, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Run a consumer over sorted rows: begin(conv_id) gives (on_row, on_end), each of which
    gives result rows.  Results go out every thousand rows."""
    out: list[tuple] = []
    last, on_row, on_end = object(), None, None

    def flush():
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        out.clear()
        return batch

    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for row in zip(*columns):
            if row[0] != last:
                if on_end is not None:
                    out += on_end()
                last = row[0]
                on_row, on_end = begin(last)
            out += on_row(*row[1:])
            if len(out) >= 1000:
                yield flush()
    if on_end is not None:
        out += on_end()
    if out:
        yield flush()


_SEGMENT = pa.schema([("conv_id", pa.int64()), ("turn_no", pa.int64()), ("part", pa.int32()), ("text", pa.string()), ("loss", pa.bool_()), ("state", pa.string()), ("in_order", pa.bool_())])


def segments(conversations: DataFrame, template: Template = INSTRUCT, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Three rows for each turn: conv_id, turn_no (from 0), part (0 opens, 1 text, 2 closes),
    the text to write, its loss flag, the machine's state after the turn, and whether the role
    was in turn.  The formatted conversation is the texts by (turn_no, part).

    Defined cases: turns are ordered by turn, then role, then text, nulls first; repeated rows
    are turns of their own (and so out of turn).  A null text is empty; a null role is the
    empty name.  A role that the template doesn't list, and one out of turn, is written all the
    same, with in_order false.  Rows with a null conv_id make up one conversation.  Further
    columns are not looked at; an empty table gives no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = Writer(template)

        def begin(conv):
            machine, number = Machine(template), iter(range(1 << 62))

            def on_row(_, role, text):
                ok, n = machine.step(role), next(number)
                return [(conv, n, k, t, loss, machine.state, ok) for k, (t, loss) in enumerate(writer.turn(role, text))]

            return on_row, lambda: []

        yield from _streamed(batches, begin, _SEGMENT)

    return _sorted(conversations, conv_col, turn_col, role_col, text_col).mapInArrow(run, SEGMENTS)


_READ = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("in_order", pa.bool_()), ("complete", pa.bool_())])


def read_back(formatted: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """From segments(): a row for each conversation, read back from the written text.
    turns_sha256 is over role, newline, text, newline of each turn; loss_chars and loss_sha256
    are over the unescaped text under the loss flag; in_order says whether all roles came in
    turn and complete whether the last state may end a conversation as well.

    What segments() gives is sorted by conversation already, so this needs no shuffle; it
    must not be dealt anew in between."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def begin(conv):
            reader, turns, loss = Reader(template), hashlib.sha256(), hashlib.sha256()
            got = {"turns": 0, "loss": 0, "chars": 0, "order": True, "state": template.start}

            def on_row(_, part, text, under, state, ok):
                got["chars"] += len(text)
                got["order"] &= ok
                got["state"] = state
                if under:
                    plain = Writer.unescape(text)
                    got["loss"] += len(plain)
                    loss.update(plain.encode("utf-8", "surrogatepass"))
                for role, said in reader.feed(text):
                    got["turns"] += 1
                    turns.update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                return []

            def on_end():
                if reader.buffer:
                    raise ValueError("formatted text that the template can't have written")
                done = got["order"] and got["state"] in template.ends
                return [(conv, got["turns"], turns.hexdigest(), got["loss"], loss.hexdigest(), got["chars"], got["order"], done)]

            return on_row, on_end

        yield from _streamed(batches, begin, _READ)

    return formatted.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, in_order boolean, complete boolean")
