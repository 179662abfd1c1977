"""Chat formatting (3): conversations rendered by a compiled template, with a loss mask.

Turns are dealt by conversation and sorted by turn (then role and text, so ties are settled); executors stream
them through the template one turn at a time. A conversation comes out as one row, or, beyond `PART_CHARS`
characters, as several numbered ones cut between two parts of the template; so a conversation with very many
turns needs no more memory than its longest turn. `spans` are the characters inside generation blocks.

Control strings inside texts and roles are broken up by a backslash after their first character, and
backslashes are doubled, so `unescape` gives the very text back and a text can't forge a turn.

Defined results: a null text or role is empty; null turns come first; a null conv_id is a conversation of its
own; repeated rows are repeated turns; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gondola.llm.template import compile_template

PART_CHARS = 1_000_000

TEMPLATE = (
    "{% for m in messages %}<|{{ m.role | escape }}|>"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}{% else %}{{ m.text | escape }}{% endif %}"
    "</s>{% endfor %}"
)
#: Where a control string of the template, or of a common other one, begins: its first character is followed by the rest.
CONTROL = re.compile(r"<(?=s>|/s>|\|)|\[(?=/?INST\])|\|(?=>)")
TURN = re.compile(r"<\|(.*?)\|>(.*?)</s>", re.S)


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: m[0] + "\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, str, str]]:
    for batch in batches:
        for key, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "role", "text"))):
            yield key, role or "", text or ""


def render(conversations: DataFrame, *, template: str = TEMPLATE, key: str = "conv_id", part_chars: int = PART_CHARS) -> DataFrame:
    """(key, part, text, spans) of every conversation, from (key, turn, role, text) rows."""
    compile_template(template, {"escape": escape})  # faults show here, not in a task
    kind = conversations.schema[key].dataType.simpleString()
    rows = conversations.select(F.col(key).alias("conv"), "turn", "role", "text")
    dealt = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text").select("conv", "role", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw = compile_template(template, {"escape": escape})
        out: list[tuple] = []
        held = 0
        arrow = None

        def ready() -> pa.RecordBatch:
            span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            columns = zip(*out)
            kinds = (arrow, pa.int64(), pa.string(), span)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["conv", "part", "text", "spans"])

        def seen(source):
            nonlocal arrow
            for batch in source:
                arrow = batch.schema.field("conv").type
                yield batch

        for conv, turns in groupby(_turns(seen(batches)), key=lambda t: t[0]):
            number, text, size, spans = 0, [], 0, []
            for piece, generated in draw({"messages": ({"role": r, "text": t} for _, r, t in turns)}):
                if size and size + len(piece) > part_chars:
                    out.append((conv, number, "".join(text), spans))
                    held, number, text, size, spans = held + size, number + 1, [], 0, []
                if generated:
                    spans.append({"start": size, "stop": size + len(piece)})
                text.append(piece)
                size += len(piece)
                if held >= part_chars:
                    yield ready()
                    out.clear()
                    held = 0
            out.append((conv, number, "".join(text), spans))
            held += size
        if out:
            yield ready()

    done = dealt.mapInArrow(work, f"conv {kind}, part bigint, text string, spans array<struct<start: bigint, stop: bigint>>")
    return done.withColumnRenamed("conv", key)


def digests(rendered: DataFrame, *, key: str = "conv_id") -> DataFrame:
    """Read back from rows of `render`, which must not be dealt anew: turns, their digest, and that of the loss text."""
    kind = rendered.schema[key].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch], told: list[pa.DataType]) -> Iterator[tuple]:
        for batch in batches:
            told[:] = [batch.schema.field(key).type]
            yield from zip(*(batch.column(c).to_pylist() for c in (key, "part", "text", "spans")))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: list[pa.DataType] = []
        out = []
        for conv, parts in groupby(rows(batches, told), key=lambda r: r[0]):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            count = chars = size = 0
            rest = ""
            for _, _, text, spans in parts:
                size += len(text)
                for span in spans:
                    own = unescape(text[span["start"] : span["stop"]])
                    chars += len(own)
                    loss.update(own.encode())
                rest, at = rest + text, 0
                for m in TURN.finditer(rest):
                    turns.update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
                    count, at = count + 1, m.end()
                rest = rest[at:]
            if rest:
                raise ValueError(f"conversation {conv}: {rest[:100]!r} is no turn")
            out.append((conv, count, turns.hexdigest(), chars, loss.hexdigest(), size))
        if out:
            kinds = (told[0], pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = [key, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return rendered.mapInArrow(work, f"`{key}` {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
