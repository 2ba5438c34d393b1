"""Chat formatting: a finite-state machine over roles and a declarative template.

A template says for each role which marks stand around its text and whether the text is trained on, and
which role may follow which.  The machine reads the turns of a conversation in order, checks each step and
emits text segments, each with its loss flag; marks are never trained on.  Control strings inside
texts are escaped so that they can't be read as marks; the escape is undone exactly by ``unescape``.

Scale: turns are dealt by conversation and sorted inside the partitions (both spill); the machine streams
over the sorted rows and keeps one state, so a conversation of any length needs the memory of one
Arrow batch.  A conversation is one sequence (its digests are sequential), so one of a third of all rows
is one long task, but never one group in memory.

Defined results: a null text is an empty one; a null or unknown role is written with the template's
general marks, which carry the role's name, isn't trained on, and makes the conversation invalid; all
conversations are formatted, valid or not; a null turn comes first; turns with the same number are ordered
by role and text; rows without conv_id form one conversation; extra columns are ignored.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_rows, col

START, END = "(start)", "(end)"


@dataclass(frozen=True)
class Role:
    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    roles: dict[str, Role]
    other: Role                                        # its ``before`` has a place {} for the role's name
    next: dict[str, tuple[str, ...]]                   # state -> roles that may follow
    last: tuple[str, ...]                              # roles that may end a conversation
    control: tuple[str, ...] = field(default=())       # more strings to keep out of texts

    def controls(self) -> list[str]:
        marks = [m.strip() for r in self.roles.values() for m in (r.before, r.after)]
        marks += [m.strip() for m in (*self.other.before.split("{}"), self.other.after)]
        return sorted({m for m in (*marks, *self.control) if m}, key=lambda m: (-len(m), m))


INSTRUCT = Template(
    roles={"system": Role("<<SYS>>\n", "\n<</SYS>>\n"), "user": Role("[INST] ", " [/INST]"),
           "assistant": Role("<s> ", " </s>", loss=True)},
    other=Role("<|role|>{}<|text|>", "<|end|>"),
    next={START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
    last=("assistant",),
    control=("<|im_start|>", "<|im_end|>"))


class Escape:
    """Inside a control string a backslash and a dash stand after its first character; a backslash of
    the text is doubled.  So no control string is left, and reading back is exact."""

    def __init__(self, template: Template):
        rest = "|".join(re.escape(c) for c in template.controls())
        self.found = re.compile(f"(?=(?:{rest}))(.)", re.S)

    def put(self, text: str) -> str:
        return self.found.sub(r"\1\\-", text.replace("\\", "\\\\"))

    @staticmethod
    def undo(text: str) -> str:
        return re.sub(r"\\([\\-])", lambda m: "\\" if m[1] == "\\" else "", text)


SEGMENT = "struct<text:string,loss:boolean>"
FORMATTED = f"conv_id long, turn long, step int, segments array<{SEGMENT}>, error string"
_SEG = pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))


def _machine(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        escape, conv, state, step = Escape(template), object(), START, 0
        for b in batches:
            steps, segments, errors = [], [], []
            for c, role, text, last in zip(*(b.column(k).to_pylist() for k in ("conv_id", "role", "text", "last"))):
                if c != conv:
                    conv, state, step = c, START, 0
                error = None
                if role not in template.next.get(state, ()):
                    error = f"{role} after {state}"
                elif last and role not in template.last:
                    error = f"{END} after {role}"
                r = template.roles.get(role)
                if r is None:
                    # a missing role has no name; "=" tells it from an empty one
                    name = "" if role is None else "=" + escape.put(role)
                    r = Role(template.other.before.replace("{}", name), template.other.after)
                segments.append([{"text": r.before, "loss": False}, {"text": escape.put(text or ""), "loss": r.loss},
                                 {"text": r.after, "loss": False}])
                steps.append(step)
                errors.append(error)
                state, step = role, step + 1
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), b.column("turn"), pa.array(steps, pa.int32()), pa.array(segments, _SEG),
                 pa.array(errors, pa.string())], names=["conv_id", "turn", "step", "segments", "error"])
    return run


def format_chat(turns: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """One row per turn, conversations together and in order: its segments and the machine's error."""
    t = turns.select(col("conv_id").cast("long").alias("conv_id"), col("turn").cast("long").alias("turn"), col("role"), col("text"))
    order = ("turn", "role", "text")
    # the window deals and sorts the rows as the machine needs them; lead() looks one row ahead only
    ahead = Window.partitionBy("conv_id").orderBy(*order)
    t = t.withColumn("last", F.lead(F.lit(1)).over(ahead).isNull())
    return arrow_rows(t).mapInArrow(_machine(template), FORMATTED)


def _reader(template: Template):
    """Reads roles and texts back from the segments of each turn, as written, mark by mark."""
    marks = [(name, r.before, r.after) for name, r in template.roles.items()]
    head, tail = template.other.before.split("{}")

    def turn(segments) -> tuple[str | None, str]:
        whole = "".join(s["text"] for s in segments)
        for name, before, after in marks:
            if whole.startswith(before) and whole.endswith(after):
                return name, Escape.undo(whole[len(before):len(whole) - len(after)])
        name, text = whole[len(head):len(whole) - len(template.other.after)].split(tail, 1)
        return (Escape.undo(name[1:]) if name else None), Escape.undo(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                            ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                            ("valid", pa.bool_())])
        conv, n, chars, total, valid = None, 0, 0, 0, True
        turns, loss, out = hashlib.sha256(), hashlib.sha256(), []
        for b in batches:
            for c, step, segments, error in zip(*(b.column(k).to_pylist() for k in ("conv_id", "step", "segments", "error"))):
                if step == 0:
                    if n:
                        out.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), total, valid))
                    conv, n, chars, total, valid = c, 0, 0, 0, True
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                role, text = turn(segments)
                n, valid = n + 1, valid and error is None
                turns.update(f"{role or ''}\n{text}\n".encode("utf-8", "surrogatepass"))
                total += sum(len(s["text"]) for s in segments)
                for s in segments:
                    if s["loss"]:
                        plain = Escape.undo(s["text"])
                        chars += len(plain)
                        loss.update(plain.encode("utf-8", "surrogatepass"))
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema)
                out = []
        if n:
            last = (conv, n, turns.hexdigest(), chars, loss.hexdigest(), total, valid)
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, last))], schema)
    return run


def read_back(formatted: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """One row per conversation, read from formatted turns in whatever order and files they come: they are dealt by conversation
    and sorted by step here."""
    dealt = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "step")
    return dealt.mapInArrow(_reader(template), "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                "loss_sha256 string, formatted_chars long, valid boolean")
