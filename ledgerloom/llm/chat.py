"""Chat formatting from event logs: messages are folded from their events, then rendered.

A message's events (start, streamed deltas, edits, regenerations) are brought together and folded in
the order of their sequence; each final message is rendered by itself. A conversation is the run of
its rendered messages, so one of any length is never held as a whole.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import bounded_batches

# The template: control strings mark turns; inside texts their first signs are escaped by a backslash.
OPEN, COLON, CLOSE = "### ", ": ", "</turn>\n"
LEARNED_ROLE = "assistant"
_UNESCAPE = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"### ((?:[^\\:#<]|\\.)*): ((?:[^\\#<]|\\.)*)</turn>\n", re.DOTALL)


def folded(events: DataFrame) -> DataFrame:
    """(conv_id, message, role, text): the final state of every message.

    ``events`` has conv_id, message and seq (any sortable keys; messages in the order of turns), kind, role, text. By seq,
    ``start`` sets the role, ``delta`` appends its text, ``edit`` replaces the text so far and ``regenerate``
    clears it. Events of one seq are taken by kind and text. Null text counts as empty, a message
    without any role has the empty role, unknown kinds are an error. Null conv_id is a conversation.
    """
    bounded_batches(events.sparkSession)
    kind_of_message = events.schema["message"].dataType
    columns = ["conv_id", "message", "seq", "kind", "role", "text"]
    rank = F.when(F.col("kind") == "start", 0).otherwise(1)
    order = ["conv_id", "message", "seq", "__rank", "kind", "text"]
    placed = events.select(*columns, rank.alias("__rank")).repartition("conv_id", "message").sortWithinPartitions(*order)
    placed = placed.drop("__rank", "seq")

    def task(batches):
        schema, current, role, parts = None, None, None, []
        out = [[], [], [], []]

        def close():
            for column, value in zip(out, (*current, role or "", "".join(parts)), strict=True):
                column.append(value)

        def flush():
            arrays = [pa.array(c, f.type) for c, f in zip(out, schema, strict=True)]
            for column in out:
                column.clear()
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        for batch in batches:
            if schema is None:
                kept = [batch.schema.field(k) for k in ("conv_id", "message", "role", "text")]
                schema = pa.schema([f.with_nullable(True) for f in kept])
            rows = zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True)
            for conv, message, kind, who, text in rows:
                if (conv, message) != current:
                    if current is not None:
                        close()
                    current, role, parts = (conv, message), None, []
                role = role if role is not None else who
                if kind in ("start", "delta"):
                    parts.append(text or "")
                elif kind == "edit":
                    parts = [text or ""]
                elif kind == "regenerate":
                    parts = []
                else:
                    raise ValueError(f"unknown event kind: {kind}")
            if out[0]:
                yield flush()
        if current is not None:
            close()
            yield flush()

    return placed.mapInArrow(task, f"conv_id bigint, message {kind_of_message.simpleString()}, role string, text string")


def rendered(messages: DataFrame) -> DataFrame:
    """``messages`` with ``formatted``, and where loss is taken in it: loss_start and loss_end, else null.

    A turn is ``### role: text</turn>`` and a line end. Backslash, ``#`` and ``<`` inside role and text,
    and a colon inside the role, get a backslash before them, so control strings only occur as marks.
    """
    role = F.regexp_replace(F.coalesce("role", F.lit("")), r"([\\#<:])", r"\\$1")
    text = F.regexp_replace(F.coalesce("text", F.lit("")), r"([\\#<])", r"\\$1")
    learned = F.col("role") == LEARNED_ROLE
    start = F.length(role) + len(OPEN) + len(COLON)
    return messages.select(
        "*",
        F.concat(F.lit(OPEN), role, F.lit(COLON), text, F.lit(CLOSE)).alias("formatted"),
        F.when(learned, start).alias("loss_start"),
        F.when(learned, start + F.length(text)).alias("loss_end"),
    )


def unescaped(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def parsed(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a rendered text; an error if it is not made of turns."""
    out, at = [], 0
    while at < len(formatted):
        turn = _TURN.match(formatted, at)
        if turn is None:
            raise ValueError(f"no turn at {at}")
        out.append((unescaped(turn[1]), unescaped(turn[2])))
        at = turn.end()
    return out


_DIGEST = pa.schema(
    [
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ]
)


def digests(turns: DataFrame) -> DataFrame:
    """Per conversation what reading its rendered turns back gives: counts and digests.

    Rows of a conversation stream through one task in the order of their messages, since a digest
    is a running value; only one row and the digests' states are held.
    """
    bounded_batches(turns.sparkSession)
    placed = turns.select("conv_id", "message", "formatted", "loss_start", "loss_end")
    placed = placed.repartition("conv_id").sortWithinPartitions("conv_id", "message", "formatted").drop("message")

    def task(batches):
        current, state, rows = (), None, []

        def close():
            rows.append((current[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        def flush():
            arrays = [pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), _DIGEST, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, schema=_DIGEST)

        for batch in batches:
            for conv, text, start, end in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if current != (conv,):
                    if current:
                        close()
                    current, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in parsed(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                if start is not None:
                    loss = unescaped(text[start:end])
                    state[2] += len(loss)
                    state[3].update(loss.encode())
                state[4] += len(text)
            if rows:
                yield flush()
        if current:
            close()
            yield flush()

    return placed.mapInArrow(
        task,
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    )


DELTA_CHARS = 512


def events_of(conversations: DataFrame, delta_chars: int = DELTA_CHARS) -> DataFrame:
    """The log a chat service would have kept of the rows: streamed deltas, edits and regenerations.

    A message's key is its turn and, where rows share a turn, their place by role and text. By turn and
    place, every fourth message is streamed as it is; the next is streamed wrongly and regenerated; of
    the next a wrong version is streamed, which an edit replaces after the whole conversation; of the last the
    first half is edited before the rest arrives. ``seq`` orders the events of a conversation: late edits
    last, then turn, place and step. Wrong versions are the text backwards. Deltas have ``delta_chars`` code points.
    """
    from pyspark.sql import Window

    tied = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    rows = conversations.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text")
    rows = rows.withColumn("message", F.struct("turn", F.row_number().over(tied).alias("copy")))
    rows = rows.withColumn("text", F.coalesce("text", F.lit("")))
    half = F.floor(F.length("text") / 2).cast("int")
    none, wrong = F.lit(None).cast("string"), F.reverse("text")

    def event(step, kind: str, text, role=none, late: int = 0):
        fields = [F.lit(late).alias("late"), F.col("message.turn").alias("turn"), F.col("message.copy").alias("copy")]
        seq = F.struct(*fields, step.cast("bigint").alias("step"))
        return F.struct(seq.alias("seq"), F.lit(kind).alias("kind"), role.alias("role"), text.alias("text"))

    def deltas(text, begin: int):
        """Steps from ``begin`` on; long texts have more of them than short ones, never as many as there are between begins."""
        size = F.length(text)
        starts = F.when(size > 0, F.sequence(F.lit(1), size, F.lit(delta_chars))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda b: event(b + F.lit(begin).cast("bigint"), "delta", F.substring(text, b, F.lit(delta_chars))))

    later = 1 << 33
    start = F.array(event(F.lit(0), "start", none, F.col("role")))
    rule = F.pmod(F.coalesce("message.turn", F.lit(0)) + F.col("message.copy"), F.lit(4))
    kinds = [
        F.concat(start, deltas(F.col("text"), 0)),
        F.concat(start, deltas(wrong, 0), F.array(event(F.lit(later), "regenerate", none)), deltas(F.col("text"), later)),
        F.concat(start, deltas(wrong, 0), F.array(event(F.lit(0), "edit", F.col("text"), late=1))),
        F.concat(
            start, deltas(F.substring(wrong, F.lit(1), half), 0), F.array(event(F.lit(later), "edit", F.substring(F.col("text"), F.lit(1), half))),
            deltas(F.substring(F.col("text"), half + 1, F.length("text")), later),
        ),
    ]
    log = F.when(rule == 1, kinds[0]).when(rule == 2, kinds[1]).when(rule == 3, kinds[2]).otherwise(kinds[3])
    events = rows.select("conv_id", "message", F.inline(log))
    return events.select("conv_id", "message", "seq", "kind", "role", "text")
