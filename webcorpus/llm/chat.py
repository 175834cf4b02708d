"""Chat formatting by incremental black-box rendering.

A template is any function from a list of turns (dicts with ``role`` and
``text``) to a string; nothing else about it is known.  Successive
prefixes of a conversation are rendered and consecutive outputs compared:
what the longer output adds is the turn's span.  If the shorter output is
not a prefix of the longer one, the template rewrites history, and the
conversation is marked.  Inside a span the text's place is found by
rendering the same turn with a probe text.

Turns stream through a task in order.  A turn is rendered after all turns
before it, and the output is carried to the next, so that a turn takes one
rendering and one with the probe; a task holds the turns and the output of
one conversation, and none is gathered into a row.  For a template that is
known to look back over few turns only, ``context`` bounds how many are
rendered, which takes time in proportion to the conversation.  The output has one row per turn, and a conversation's
formatted text is these rows' strings one after the other.

Defined results: null texts and roles are empty; turns are ordered by turn
(nulls first), role and text, repeated turns all count; rows with a null
conversation id form one conversation.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webcorpus.llm import textwords as W

PROBE = "\ue000\ue001\ue000"

# Control strings of common chat formats, kept out of texts by escaping.
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>"]

_ESCAPED = re.compile("|".join([re.escape(c) for c in CONTROL] + [r"\\"]))
_TURN = re.compile(r"<\|im_start\|>((?:\\.|[^\\\n])*)\n(.*?)<\|im_end\|>\n", re.DOTALL)


def escape(text: str) -> str:
    """Text without control strings: backslashes doubled, a backslash after a control string's first character."""
    return _ESCAPED.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def _role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def _unrole(role: str) -> str:
    return re.sub(r"\\(.?)", lambda m: {"\\": "\\", "n": "\n"}.get(m[1], m[1]), role, flags=re.DOTALL)


def template(turns: list[dict]) -> str:
    """The default: a start mark, then per turn its role, its text and an end mark."""
    return "<s>" + "".join(f"<|im_start|>{_role(t['role'])}\n{escape(t['text'])}<|im_end|>\n" for t in turns)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of the turns in formatted text of the default template."""
    return [(_unrole(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def turn_span(render: Callable[[list[dict]], str], before: list[dict], turn: dict, old: str) -> tuple[str, str, int | None, int | None, bool]:
    """The rendering (``old`` before the turn), what the turn adds to it, where its text lies in that, and whether earlier output changed.

    Of a template that rewrites history, the span starts where the outputs
    part.  The text's place is None where the probe cannot tell it.
    """
    new = render([*before, turn])
    rewrites = not new.startswith(old)
    shared = len(old)
    if rewrites:
        shared = next((i for i, (a, b) in enumerate(zip(old, new)) if a != b), min(len(old), len(new)))
    added = new[shared:]
    probed = render([*before, {**turn, "text": PROBE}])[shared:]
    head, found, tail = probed.partition(PROBE)
    if found and added.startswith(head) and added.endswith(tail) and len(added) >= len(head) + len(tail):
        return new, added, len(head), len(added) - len(tail), rewrites
    return new, added, None, None, rewrites


def format_turns(conversations: DataFrame, *, render: Callable[[list[dict]], str] = template, learn: str = "assistant",
                 context: int | None = None, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """One row per turn: id, place, ``formatted``, the loss mask inside it (code points; null: no loss), ``rewrites``.

    Texts of the role ``learn`` are under the mask, exactly.  Rows of a
    conversation are adjacent and in order.  ``context``: turns that the
    template looks back over; None: all.
    """
    src = conversations.select(W.quoted(id_col).alias("id"), W.quoted(turn_col).alias("turn"),
                               F.coalesce(W.quoted(role_col).cast("string"), F.lit("")).alias("role"),
                               F.coalesce(W.quoted(text_col).cast("string"), F.lit("")).alias("text"))
    src = src.repartition("id").sortWithinPartitions("id", "turn", "role", "text")
    out = T.StructType([T.StructField("id", src.schema["id"].dataType), T.StructField("place", T.LongType()),
                        T.StructField("formatted", T.StringType()), T.StructField("loss_start", T.LongType()),
                        T.StructField("loss_end", T.LongType()), T.StructField("rewrites", T.BooleanType())])

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(out)
        current, place, before, old = object(), 0, [], ""
        for batch in W.regroup(batches, 3, 4 << 20):
            rows = []
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if conv != current:
                    current, place, before, old = conv, 0, [], render([])
                turn = {"role": role, "text": text}
                new, added, lo, hi, rewrites = turn_span(render, before, turn, old)
                if not place:  # what the template writes ahead of all turns goes with the first
                    ahead = old if not rewrites else ""
                    added, lo, hi = ahead + added, lo if lo is None else lo + len(ahead), hi if hi is None else hi + len(ahead)
                if role != learn:
                    lo = hi = None
                rows.append((conv, place, added, lo, hi, rewrites))
                place += 1
                before.append(turn)
                old = new
                if context is not None and len(before) > context:
                    before = before[len(before) - context:]
                    old = render(before)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return src.mapInArrow(run, out).withColumnRenamed("id", id_col)


def read_back(formatted: DataFrame, *, id_col: str = "conv_id") -> DataFrame:
    """Digests of what the formatted rows of :func:`format_turns` (default template) say, conversation by conversation."""
    src = formatted.select(W.quoted(id_col).alias("id"), "formatted", "loss_start", "loss_end")
    out = T.StructType([T.StructField("id", src.schema["id"].dataType), T.StructField("n_turns", T.LongType()),
                        T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()),
                        T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())])

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(out)
        open_, state = False, None  # [id, turns, sha of turns, loss chars, sha of loss, chars]

        def row():
            return (state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5])

        for batch in W.regroup(batches, 1, 4 << 20):
            rows = []
            for conv, text, lo, hi in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if not open_ or conv != state[0]:
                    if open_:
                        rows.append(row())
                    open_, state = True, [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in parse(text):
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode())
                if lo is not None:
                    learned = unescape(text[lo:hi])
                    state[3] += len(learned)
                    state[4].update(learned.encode())
                state[5] += len(text)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        if open_:
            yield pa.RecordBatch.from_arrays([pa.array([c], type=f.type) for c, f in zip(row(), schema)], schema=schema)

    return src.mapInArrow(run, out).withColumnRenamed("id", id_col)
