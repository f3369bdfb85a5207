"""Chat formatting by incremental black-box rendering.

The renderer is any function from a list of turns to one string. Nothing is known of its markup:
the span of turn k is what the rendering of k turns adds to that of k - 1, and
where a turn's own text lies inside its span shows in two more renderings whose last text is
a probe. A renderer that changes what it wrote before is found by the same comparison.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, functions as F

Turn = tuple[str, str]
Renderer = Callable[[Sequence[Turn]], str]

FORMATTED = (
    "formatted string, turns array<struct<role:string,start:int,end:int>>, "
    "loss array<struct<start:int,end:int>>, rewrites_history boolean, rewritten_from int, "
    "opaque_turns int"
)


@dataclass(frozen=True)
class MarkedTurns:
    """``### role: text</turn>`` per line; control characters inside carry a backslash.

    An unescaped ``#`` or ``<`` occurs in marks alone, so the output parses in one way only and
    every role and text comes back as it was.
    """

    open: str = "### "
    middle: str = ": "
    close: str = "</turn>\n"

    @staticmethod
    def escape(text: str) -> str:
        return text.replace("\\", "\\\\").replace("#", "\\#").replace("<", "\\<")

    @classmethod
    def escape_role(cls, role: str) -> str:
        return cls.escape(role).replace(":", "\\:")

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if "\\" in text else text

    def __call__(self, turns: Sequence[Turn]) -> str:
        return "".join(
            f"{self.open}{self.escape_role(role)}{self.middle}{self.escape(text)}{self.close}"
            for role, text in turns
        )

    def parse(self, output: str) -> list[Turn]:
        """The turns that were rendered."""
        turn = re.compile(
            re.escape(self.open)
            + r"([^\\:]*(?:\\.[^\\:]*)*)"
            + re.escape(self.middle)
            + r"([^\\<]*(?:\\.[^\\<]*)*)"
            + re.escape(self.close),
            re.DOTALL,
        )
        turns, at = [], 0
        while at < len(output):
            found = turn.match(output, at)
            if not found:
                raise ValueError(f"no turn at {at}")
            turns.append((self.unescape(found[1]), self.unescape(found[2])))
            at = found.end()
        return turns


def shared_prefix(a: str, b: str) -> int:
    if a == b[: len(a)]:
        return len(a)
    return len(os.path.commonprefix((a, b)))


def _frame(render: Renderer, before: Sequence[Turn], role: str) -> tuple[str, int]:
    """What stands before the last turn's text, and how many characters follow it."""
    a, b = (render([*before, (role, probe)]) for probe in ("a", "b"))
    head = shared_prefix(a, b)
    tail = shared_prefix(a[head:][::-1], b[head:][::-1])
    return a[:head], tail


def trace(render: Renderer, turns: Sequence[Turn], trained: frozenset[str]) -> dict:
    """Render every prefix of a conversation and locate its turns and the text to train on."""
    spans, loss, previous, rewritten, opaque = [], [], render([]), None, 0
    for k, (role, text) in enumerate(turns, start=1):
        output = render(turns[:k])
        start = shared_prefix(previous, output)
        if start < len(previous):
            rewritten = start if rewritten is None else min(rewritten, start)
        spans.append({"role": role, "start": start, "end": len(output)})
        if role in trained:
            head, tail = _frame(render, turns[: k - 1], role)
            if output.startswith(head) and len(head) + tail <= len(output):
                loss.append({"start": len(head), "end": len(output) - tail})
            else:
                opaque += 1
        previous = output
    stable = rewritten is None
    return {
        "formatted": previous,
        "turns": spans,
        "loss": loss if stable else [],
        "rewrites_history": not stable,
        "rewritten_from": rewritten,
        "opaque_turns": opaque,
    }


def format_chats(
    turns: DataFrame,
    render: Renderer = MarkedTurns(),
    trained_roles: Sequence[str] = ("assistant",),
) -> DataFrame:
    """One row per ``conv_id``: the formatted text, turn spans, and the loss mask as spans.

    Turns go by ``turn``, then role and text (nulls first); a null role or text is empty. Repeated
    rows are turns of their own. A null conv_id is a conversation like any other. An empty
    table gives no rows; other columns are ignored. Spans count code points. For a renderer that
    rewrites history the spans of earlier turns no longer hold: ``rewrites_history`` is true,
    ``rewritten_from`` is the first position that changed and the loss mask is empty. Turns
    whose text can't be told from the markup count as ``opaque_turns`` and bear no loss.

    A conversation is one record of the result and is rendered in one task, once per turn.
    """
    trained = frozenset(trained_roles)
    chats = turns.groupBy("conv_id").agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    "turn",
                    F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"),
                )
            )
        ).alias("said")
    )
    id_type = chats.schema["conv_id"].dataType.simpleString()

    def rendered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            traces = [
                trace(render, [(t["role"], t["text"]) for t in said], trained) for said in batch["said"]
            ]
            out = pd.DataFrame(traces, columns=["formatted", "turns", "loss", "rewrites_history", "rewritten_from", "opaque_turns"])
            out["rewritten_from"] = out["rewritten_from"].astype("Int32")
            out.insert(0, "conv_id", batch["conv_id"].values)
            yield out

    return chats.mapInPandas(rendered, f"conv_id {id_type}, {FORMATTED}")
