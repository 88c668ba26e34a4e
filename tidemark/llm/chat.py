"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) to a string.  Each
prefix of a conversation's turns is rendered; what a prefix adds to the one
before is the new turn's span.  Two probe renderings, whose last turn's text is
a different single letter, show where within the span the text begins and how
much follows it.  A template whose longer rendering does not begin with the
shorter one rewrites history: that is reported, and no mask is given.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship_code

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

# The control strings of the default template.
START, END = "<|im_start|>", "<|im_end|>"

FORMATTED = ("conv_id long, formatted string, rewrites boolean, "
             "turns array<struct<role: string, start: int, end: int, text_start: int, text_end: int, loss: boolean>>")
DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
          "formatted_chars long, rewrites boolean")


def escape(text: str) -> str:
    """Control strings cannot occur in the result: ``<|`` gets a backslash
    between its characters, and one more where there are some already."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text) if "|" in text else text


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text) if "|" in text else text


def _escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def im_template(turns: list[Turn]) -> str:
    """The default template: marked turns, one after another."""
    return "".join([f"{START}{_escape_role(role)}\n{escape(text)}{END}\n" for role, text in turns])


def im_parse(formatted: str) -> list[Turn]:
    """The turns of a rendering by ``im_template``."""
    out = []
    for piece in formatted.split(START)[1:]:
        role, _, text = piece.partition("\n")
        out.append((_unescape_role(role), unescape(text[:text.rindex(END)])))
    return out


def render(template: Template, turns: list[Turn], loss_role: str) -> tuple[str, bool, list[dict]]:
    """The rendering, whether the template rewrites history, and the turns'
    spans (none if it does)."""
    before, spans = template([]), []
    for k, (role, text) in enumerate(turns):
        history = turns[:k]
        now = template([*history, (role, text)])
        x, y = template([*history, (role, "x")]), template([*history, (role, "y")])
        if not now.startswith(before):
            return template(turns), True, []
        # where the probes part, and what follows their single letter
        low, high = len(before), len(x)
        while low < high:
            mid = (low + high) // 2
            low, high = (mid + 1, high) if x[len(before):mid + 1] == y[len(before):mid + 1] else (low, mid)
        if len(x) != len(y) or low == len(x) or x[low + 1:] != y[low + 1:] or not x.startswith(before):
            return template(turns), True, []
        spans.append({"role": role, "start": len(before), "end": len(now), "text_start": low,
                      "text_end": len(now) - (len(x) - low - 1), "loss": role == loss_role})
        before = now
    return before, False, spans


def format_conversations(turns: DataFrame, template: Template = im_template, loss_role: str = "assistant",
                         id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id, formatted, rewrites, turns``.

    ``turns`` gives each turn's span, its text's span (in code points, as
    rendered) and whether it counts for the loss.  Rows are ordered by turn
    (null first), then role and text, so repeated rows stay and stand together.
    A null text or role is empty; rows without a conversation identifier form
    one conversation.  No rows give no conversations; other columns are not
    read.  A conversation is rendered in one task, as prefixes need the whole.
    """
    ship_code(turns.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(3))))
        schema = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("rewrites", pa.bool_()),
                            ("turns", pa.list_(pa.struct([("role", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                                                          ("text_start", pa.int32()), ("text_end", pa.int32()), ("loss", pa.bool_())])))])
        held, size = [], 0
        for conv, group in groupby(rows, key=lambda r: r[0]):
            text, rewrites, spans = render(template, [(r[1], r[2]) for r in group], loss_role)
            held.append({"conv_id": conv, "formatted": text, "rewrites": rewrites, "turns": spans})
            size += len(text)
            if size > 1 << 20:
                yield pa.RecordBatch.from_pylist(held, schema)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    slim = turns.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return (slim.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
            .select("conv_id", "role", "text").mapInArrow(run, FORMATTED))


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Digests read back from renderings by the default template: the turns as
    parsed from the text, the loss text as cut out of it by the mask."""
    ship_code(formatted.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                text = row["formatted"]
                parsed = im_parse(text)
                said = "".join([f"{role}\n{body}\n" for role, body in parsed])
                loss = "".join([unescape(text[t["text_start"]:t["text_end"]]) for t in row["turns"] if t["loss"]])
                out.append({"conv_id": row["conv_id"], "n_turns": len(parsed),
                            "turns_sha256": hashlib.sha256(said.encode()).hexdigest(),
                            "loss_chars": len(loss), "loss_sha256": hashlib.sha256(loss.encode()).hexdigest(),
                            "formatted_chars": len(text), "rewrites": row["rewrites"]})
            if out:
                yield pa.RecordBatch.from_pylist(out, pa.schema([
                    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                    ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                    ("rewrites", pa.bool_())]))

    return formatted.mapInArrow(run, DIGEST)
