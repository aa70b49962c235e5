"""Chat formatting by incremental black-box rendering.

A template is any function from a list of turns to a string. For each conversation the
turns so far are rendered again after every turn. What the new output adds is the turn's
span; if the new output does not begin with the old one, the template rewrote history,
and the turn from which outputs differ is reported. A second rendering with a one-letter
stand-in for the turn's text shows where in the span the text lies, so loss masks need no
knowledge of the template.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from burstwatch.llm.shared import with_workers

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

#: Strings that have a meaning in the format below; in texts they are broken by a backslash.
CONTROLS = ("</s>", "<s>", "[/INST]", "[INST]", "[/ROLE]", "[ROLE]")
_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_PART = re.compile(r"<s>(?:\[INST\] (?P<user>.*?) \[/INST\]|\[ROLE\](?P<role>.*?)\[/ROLE\](?P<other>.*?)|(?P<answer>.*?))</s>", re.DOTALL)
_STAND_IN = "\ue000"  # a private-use character: no template treats it in a way of its own


def escape(text: str) -> str:
    """Double every backslash and put one after the first character of every control string."""
    return _CONTROL.sub(lambda m: m.group()[0] + "\\" + m.group()[1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def instruct_template(turns: list[Turn]) -> str:
    """``<s>[INST] user [/INST]</s><s>assistant</s><s>[ROLE]any other[/ROLE]text</s>``, texts escaped."""
    out = []
    for role, text in turns:
        if role == "user":
            out.append(f"<s>[INST] {escape(text)} [/INST]</s>")
        elif role == "assistant":
            out.append(f"<s>{escape(text)}</s>")
        else:
            out.append(f"<s>[ROLE]{escape(role)}[/ROLE]{escape(text)}</s>")
    return "".join(out)


def read_back(formatted: str) -> list[Turn]:
    """The turns in a string that :func:`instruct_template` made."""
    turns = []
    for part in _PART.finditer(formatted):
        if part["user"] is not None:
            turns.append(("user", unescape(part["user"])))
        elif part["role"] is not None:
            turns.append((unescape(part["role"]), unescape(part["other"])))
        else:
            turns.append(("assistant", unescape(part["answer"])))
    return turns


@dataclass
class Rendering:
    """The output, each turn's span in it, its text's span, and the first turn that changed earlier output."""

    formatted: str
    spans: list[tuple[int, int]]
    texts: list[tuple[int, int]]
    rewritten_at: int | None


def render(turns: list[Turn], template: Template) -> Rendering:
    """Render every prefix of the turns and locate what each turn adds.

    Where a prefix's output does not begin with the one before, the turn's span starts at
    their first difference. Earlier spans are then those of the outputs they were found in.
    """
    before, spans, texts, rewritten = template([]), [], [], None
    for i, (role, _) in enumerate(turns):
        after = template(turns[: i + 1])
        start = len(before)
        if not after.startswith(before):
            if rewritten is None:
                rewritten = i
            start = next((k for k, (x, y) in enumerate(zip(before, after)) if x != y), min(len(before), len(after)))
        spans.append((start, len(after)))
        # the stand-in is looked for behind earlier turns, whose texts may hold it too
        probe = template([*turns[:i], (role, _STAND_IN)])
        at = probe.find(_STAND_IN, min(start, len(before)))
        texts.append((at, len(after) - (len(probe) - at - 1)) if at >= 0 else (len(after), len(after)))
        before = after
    return Rendering(before, spans, texts, rewritten)


_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_SPAN_DDL = "array<struct<start:bigint,end:bigint>>"


def format_conversations(
    conversations: DataFrame, template: Template = instruct_template, conv_id: str = "conv_id", turn: str = "turn",
    role: str = "role", text: str = "text", trained_role: str = "assistant",
) -> DataFrame:
    """``conv_id, n_turns, formatted, spans, loss_spans, rewritten_at``: one row per conversation.

    Turns are ordered by ``turn`` (null first), then role, then text, so ties and repeated
    rows have one order; a repeated row is a turn of its own. Null roles and texts count as
    empty. Rows without a conversation id form one conversation. ``loss_spans`` are the
    texts of ``trained_role`` in code points; ``rewritten_at`` is null if every prefix's
    output begins with the one before. Other columns are not read; an empty table gives an
    empty result. Rows stream through a task conversation by conversation; what is held is
    one conversation, as its output is one value.
    """
    rows = with_workers(conversations).select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    kind = rows.schema["conv_id"].dataType
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Turn] = []
        current, begun = None, False
        for batch in batches:
            out = []
            for key, who, said in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if begun and key != current:
                    out.append((current, held))
                    held = []
                current, begun = key, True
                held.append((who, said))
            if out:
                yield _formatted(out, template, trained_role, batch.schema.field(0).type)
            kind = batch.schema.field(0).type
        if begun:
            yield _formatted([(current, held)], template, trained_role, kind)

    return rows.mapInArrow(
        run, f"conv_id {kind.simpleString()}, n_turns bigint, formatted string, spans {_SPAN_DDL}, "
        f"loss_spans {_SPAN_DDL}, rewritten_at bigint",
    )


def _formatted(groups: list, template: Template, trained: str, kind: pa.DataType) -> pa.RecordBatch:
    done = [render(turns, template) for _, turns in groups]
    as_spans = lambda spans: [{"start": a, "end": b} for a, b in spans]
    return pa.RecordBatch.from_arrays([
        pa.array([k for k, _ in groups], kind), pa.array([len(t) for _, t in groups], pa.int64()),
        pa.array([d.formatted for d in done], pa.string()), pa.array([as_spans(d.spans) for d in done], _SPAN),
        pa.array([as_spans(s for s, (who, _) in zip(d.texts, t) if who == trained) for d, (_, t) in zip(done, groups)], _SPAN),
        pa.array([d.rewritten_at for d in done], pa.int64()),
    ], names=["conv_id", "n_turns", "formatted", "spans", "loss_spans", "rewritten_at"])


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted strings hold, read back from them: digests of the turns and of the masked text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            made = []
            for output, mask in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                turns = read_back(output)
                loss = "".join(unescape(output[s["start"] : s["end"]]) for s in mask)
                whole = "".join(f"{role}\n{text}\n" for role, text in turns)
                sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
                made.append((len(turns), sha(whole), len(loss), sha(loss), len(output)))
            columns = list(zip(*made)) or [[]] * 5
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(list(c), k) for c, k in zip(columns, kinds)), batch.column(3)],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewritten_at"],
            )

    kind = formatted.schema["conv_id"].dataType.simpleString()
    return formatted.select("conv_id", "formatted", "loss_spans", "rewritten_at").mapInArrow(
        run, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
        "formatted_chars bigint, rewritten_at bigint",
    )
