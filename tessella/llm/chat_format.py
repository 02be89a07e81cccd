"""Chat formatting by incremental black-box rendering.

A template is a function from a list of (role, text) to one string. To learn where turn i stands, the turns before it
and the turns up to it are rendered and compared: if the shorter output is a prefix of the longer, what is added is the
turn's span; otherwise the template rewrites history, which is reported. Within a span the text's place
is what differs between two renderings of the turn with different probe texts. Nothing else is known of the template.

A conversation is streamed in turn order and given out in parts of at most `part_turns` turns. Every turn of every template
is rendered and compared after all turns before it, which a task holds; that takes time with the square of a conversation's turns.

The template here marks turns with control strings and puts an escape before each control string or escape that stands
inside a text or role, so the output parses back to the same turns.

Defined results: a null text or role is empty; turns are ordered by number (null first), then role, then text; repeated
rows are turns of their own; a null conversation id is a conversation of its own; an empty table gives no rows; columns
other than the four named are ignored; a part in which history is rewritten has no output and says so.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tessella.shipping import ship
from tessella.storage import written

Turn = tuple[str, str]
Render = Callable[[list[Turn]], str]

OPEN, CLOSE, END, BEGIN, NAMED, NAMED_END = "[INST]", "[/INST]", "</s>", "<s>", "[ROLE]", "[/ROLE]"
_CONTROL = re.compile("|".join(map(re.escape, ("\\", OPEN, CLOSE, END, BEGIN, NAMED, NAMED_END))))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TOKEN = re.compile(r"\\.|" + "|".join(map(re.escape, (OPEN, CLOSE, END, BEGIN, NAMED, NAMED_END))), re.DOTALL)


def escape(text: str) -> str:
    if "\\" not in text and "[" not in text and "<" not in text:  # whole prefixes are escaped again for every turn
        return text
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[Turn]) -> str:
    """User turns between [INST] marks, assistant turns up to </s>, other roles by name."""
    out = [BEGIN]
    for role, text in turns:
        if role == "user":
            out.append(f"{OPEN} {escape(text)} {CLOSE}")
        elif role == "assistant":
            out.append(f" {escape(text)}{END}")
        else:
            out.append(f"{NAMED}{escape(role)}{NAMED_END} {escape(text)} {CLOSE}")
    return "".join(out)


def parse(formatted: str) -> list[Turn]:
    """The turns of an output of `render`, with or without its beginning mark."""
    turns, at, mode, role = [], 0, "assistant", "assistant"
    for m in _TOKEN.finditer(formatted):
        mark = m[0]
        if mark[0] == "\\":
            continue
        body = formatted[at : m.start()]
        if mark == END:
            turns.append(("assistant", unescape(body[1:])))
        elif mark == CLOSE:
            turns.append((role, unescape(body[1:-1])))
        elif mark == OPEN:
            role = "user"
        elif mark == NAMED_END:
            role = unescape(body)
        at = m.end()
    return turns


def locate(render: Render, context: list[Turn], turn: Turn, before: str | None = None) -> tuple[str, int, int] | None:
    """What the turn adds to its context's output, and where its text stands in that; None if history is rewritten."""
    before = render(context) if before is None else before
    after = render([*context, turn])
    if not after.startswith(before):
        return None
    added = after[len(before) :]
    probes = [render([*context, (turn[0], p)])[len(before) :] for p in ("\x01", "\x02")]
    same = next((i for i, (a, b) in enumerate(zip(*probes)) if a != b), 0)
    return added, same, len(added) - (len(probes[0]) - same - 1)


_SPAN = T.StructType([T.StructField("role", T.StringType()), *(T.StructField(c, T.LongType()) for c in ("start", "end", "text_start", "text_end"))])


def format(conversations: DataFrame, template: Render = render, part_turns: int = 256, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", loss_role: str = "assistant") -> DataFrame:  # noqa: A001
    """id, part, formatted, spans (turn and text places in the whole conversation), loss (mask as start, end), rewrites."""
    ship(conversations.sparkSession)
    kind = conversations.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("part", T.LongType()), T.StructField("formatted", T.StringType()), T.StructField("spans", T.ArrayType(_SPAN)), T.StructField("loss", T.ArrayType(T.ArrayType(T.LongType()))), T.StructField("rewrites", T.BooleanType())])
    rows = conversations.select(F.col(id_col).alias("id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches):
        id_type = None
        done: list[tuple] = []
        now, open_, held, part, at = None, False, [], 0, 0
        before: str | None = None
        pieces: list[str] = []
        spans: list[dict] = []
        rewrites = False

        def close_part():
            nonlocal pieces, spans, part, rewrites
            done.append((now, part, None if rewrites else "".join(pieces), [] if rewrites else spans, [] if rewrites else [[s["text_start"], s["text_end"]] for s in spans if s["role"] == loss_role], rewrites))
            pieces, spans, part, rewrites = [], [], part + 1, False

        def given():
            out = pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], id_type), pa.array([d[1] for d in done], pa.int64()), *(pa.array([d[i] for d in done], t) for i, t in ((2, pa.string()), (3, pa.list_(pa.struct([("role", pa.string()), *((c, pa.int64()) for c in ("start", "end", "text_start", "text_end"))]))), (4, pa.list_(pa.list_(pa.int64()))), (5, pa.bool_())))], names=schema.names)
            done.clear()
            return out

        for batch in batches:
            id_type = batch.column(0).type
            for key, role, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if not open_ or key != now:
                    if open_:
                        close_part()
                    now, open_, held, part = key, True, [], 0
                    before = template([])
                    pieces.append(before)
                    at = len(before)
                elif len(spans) >= part_turns:
                    close_part()
                found = locate(template, held, (role, text), before)
                before = None if found is None else (template(held) if before is None else before) + found[0]  # the whole prefix's output
                if found is None:
                    rewrites = True
                    found = ("", 0, 0)
                added, a, b = found
                spans.append({"role": role, "start": at, "end": at + len(added), "text_start": at + a, "text_end": at + b})
                pieces.append(added)
                at += len(added)
                held.append((role, text))
            if len(done) >= 500:
                yield given()
        if open_:
            close_part()
        if done:
            yield given()

    ordered = rows.repartition("id").sortWithinPartitions(F.asc_nulls_first("id"), F.asc_nulls_first("turn"), "role", "text")
    return ordered.mapInArrow(run, schema)


def digests(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Of each formatted conversation, from its output alone: turns, text under the loss mask, length."""
    ship(formatted.sparkSession)
    schema = T.StructType([T.StructField(id_col, formatted.schema[id_col].dataType), T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())])

    def run(batches):
        state = None
        done = []

        def given(id_type):
            out = pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], id_type), *(pa.array([d[i] for d in done], t) for i, t in ((1, pa.int64()), (2, pa.string()), (3, pa.int64()), (4, pa.string()), (5, pa.int64())))], names=schema.names)
            done.clear()
            return out

        id_type = None
        for batch in batches:
            id_type = batch.column(0).type
            for key, text, loss in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if state is None or state[0] != key:
                    if state:
                        done.append((state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]))
                    state = [key, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in parse(text or ""):
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode())
                for a, b in loss:
                    under = unescape(text[a - state[5] : b - state[5]])
                    state[3] += len(under)
                    state[4].update(under.encode())
                state[5] += len(text or "")
            if len(done) >= 5000:
                yield given(id_type)
        if state:
            done.append((state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]))
        if done:
            yield given(id_type)

    ordered = formatted.select(id_col, "part", "formatted", "loss").repartition(id_col).sortWithinPartitions(F.asc_nulls_first(id_col), "part")
    return ordered.mapInArrow(run, schema)


def report(conversations: DataFrame, id_col: str = "conv_id", **options) -> DataFrame:
    """Formats, writes, reads the output back and digests it."""
    return digests(written(format(conversations, id_col=id_col, **options), "chats"), id_col)
