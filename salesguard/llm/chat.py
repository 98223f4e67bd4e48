"""Chat formatting with prefix targets.

Every assistant turn becomes its own training example: all preceding turns are
context and only that reply carries loss. A conversation is rendered once, one
segment per turn; an example is a prefix of that rendering plus the span of
its reply, so storage stays linear in the conversation. ``expand`` writes the
examples out as full texts for consumers that want them.

Template, for each turn: ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside texts
and roles, ``<``, any backslashes, ``|`` gets one more backslash, which no
longer forms a control string and is undone by removing one. Roles also have
backslashes and line feeds escaped, so the first line feed ends the role.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesguard.llm.columns import need

START, END, TARGET = "<|im_start|>", "<|im_end|>\n", "assistant"
SEGMENTS = ("conv_id long, seq long, turn long, segment string, start long, example long, "
            "loss_start long, loss_end long")
_CLOSE, _OPEN = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _CLOSE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _OPEN.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(role: str | None, text: str | None) -> tuple[str, int, int]:
    """The turn's segment and the span of its text in it."""
    head = f"{START}{escape_role(role or '')}\n"
    body = escape(text or "")
    return head + body + END, len(head), len(head) + len(body)


def parse(segment: str) -> tuple[str, str]:
    """The role and text that ``render`` was given (null as empty)."""
    role, _, body = segment[len(START):-len(END)].partition("\n")
    return unescape_role(role), unescape(body)


def _render_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, first, seq, at, n = None, True, 0, 0, 0
    for b in batches:
        out: list[tuple] = []
        for c, turn, role, text in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
            if first or c != conv:
                conv, first, seq, at, n = c, False, 0, 0, 0
            segment, lo, hi = render(role, text)
            reply = role == TARGET
            out.append((c, seq, turn, segment, at, n if reply else None, at + lo if reply else None,
                        at + hi if reply else None))
            seq, at, n = seq + 1, at + len(segment), n + reply
        kinds = [pa.int64()] * 3 + [pa.string()] + [pa.int64()] * 4
        names = [x.split()[0] for x in SEGMENTS.split(", ")]
        columns = list(zip(*out, strict=True)) or [[]] * 8
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names)


def segments(conversations: DataFrame) -> DataFrame:
    """One row per turn, in order within a conversation (columns ``SEGMENTS``).

    ``start`` is where the segment begins in the conversation's rendering;
    assistant turns also have the number of their example and the span of the
    reply that carries loss. Turns go by ``turn`` (null first); equal turns by
    role and text, repeated rows stay. Null text or role is empty, a null
    ``conv_id`` is a conversation of its own, an empty table gives no rows and
    extra columns are not read. A task streams its conversations and holds one
    Arrow batch, however long a conversation is.
    """
    rows = need(conversations, "conv_id", "turn", "role", "text")
    return (rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(_render_all, SEGMENTS))


def examples(segs: DataFrame) -> DataFrame:
    """One row per assistant turn: the example is the rendering's first ``n_chars``
    characters, of which only [loss_start, loss_end) is trained on."""
    return segs.where("example is not null").select(
        "conv_id", "example", "seq", F.col("start").alias("context_chars"),
        (F.col("start") + F.length("segment")).alias("n_chars"), "loss_start", "loss_end")


def expand(segs: DataFrame) -> DataFrame:
    """The examples as full texts: ``conv_id, example, text, loss_start, loss_end``.

    The output is quadratic in a conversation's length by nature, so this is
    for consumers of bounded conversations; ``examples`` is the linear form.
    ``segs`` comes straight from ``segments``, whose order within a task is used.
    """

    def grow(batches):
        conv, first, prefix = None, True, ""
        for b in batches:
            for r in b.to_pylist():
                if first or r["conv_id"] != conv:
                    conv, first, prefix = r["conv_id"], False, ""
                prefix += r["segment"]
                if r["example"] is not None:
                    row = [[r["conv_id"]], [r["example"]], [prefix], [r["loss_start"]], [r["loss_end"]]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, k) for x, k in zip(row, [pa.int64(), pa.int64(), pa.string(), pa.int64(),
                                                              pa.int64()], strict=True)],
                        ["conv_id", "example", "text", "loss_start", "loss_end"])

    return segs.mapInArrow(grow, "conv_id long, example long, text string, loss_start long, loss_end long")


def read_back(segs: DataFrame) -> DataFrame:
    """A digest of each conversation, parsed back from its segments and its examples.

    Every example of ``examples`` meets the segments it is a prefix of, as they
    go by: its context must be all earlier turns and it must end with its own,
    else this raises; what is trained on is read under the example's mask, once
    it is known to be that turn's text and nothing else. So the work is linear,
    though a conversation's examples together are quadratic."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_examples"]
    none = F.lit(None)
    parts = segs.select("conv_id", "seq", F.lit(0).alias("kind"), "segment", "start", none.cast("long").alias("n_chars"),
                        none.cast("long").alias("loss_start"), none.cast("long").alias("loss_end"))
    masks = examples(segs).select("conv_id", "seq", F.lit(1).alias("kind"), none.cast("string").alias("segment"),
                                  F.col("context_chars").alias("start"), "n_chars", "loss_start", "loss_end")
    rows = parts.unionByName(masks).repartition("conv_id").sortWithinPartitions("conv_id", "seq", "kind")

    def digest(batches):
        state = None
        done: list[tuple] = []

        def close():
            if state is not None:
                done.append((state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5],
                             state[6]))

        def flush():
            columns = list(zip(*done, strict=True)) or [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            batch = pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names)
            done.clear()
            return batch

        own = ""
        for b in batches:
            for conv, _, kind, segment, start, n, lo, hi in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if state is None or conv != state[0]:
                    close()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                if kind == 0:                              # a turn; ``state[5]`` characters are before it
                    if start != state[5]:
                        raise AssertionError("a segment does not follow the one before")
                    own = segment
                    role, text = parse(segment)
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                    state[5] += len(segment)
                    continue
                # An example: the prefix up to and with the turn that just went by.
                if (start, n) != (state[5] - len(own), state[5]) or role != TARGET:
                    raise AssertionError("an example's context is not all turns before its reply")
                reply = unescape(own[lo - start:hi - start])
                if reply != text or own[hi - start:] != END:
                    raise AssertionError("an example's mask is not its reply")
                state[3] += len(reply)
                state[4].update(reply.encode())
                state[6] += 1
            yield flush()
        close()
        yield flush()

    return rows.mapInArrow(digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                   "loss_sha256 string, formatted_chars long, n_examples long")
