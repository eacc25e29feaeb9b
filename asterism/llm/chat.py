"""Chat formatting: fold an event log into final messages, render them, read them back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asterism.llm.common import small_batches

#: Kinds of events. ``message`` starts a message with its text; ``delta`` adds to it;
#: ``edit`` replaces it; ``regenerate`` empties it for new deltas.
MESSAGE, DELTA, EDIT, REGENERATE = "message", "delta", "edit", "regenerate"
EVENT_COLS = ["conv_id", "msg", "seq", "kind", "role", "text"]
MESSAGES = "conv_id long, msg long, seq long, role string, text string"

#: The template: what opens a turn names its role, every turn is closed. Control
#: strings start with one of the characters that texts hold only with a backslash
#: after it, so none can stand in a text.
OPEN, CLOSE_ROLE, CLOSE = "<s>[INST:", "[/INST]", "</s>"
ESCAPED = r"([\\<\[])"
#: Roles whose text a model learns from.
LOSS_ROLES = ["assistant"]

#: Sequence numbers that each turn has for its events in the log of :func:`log_of_turns`.
STEPS = 8
#: Turn numbers beyond this count as this, null as the least.
MAX_TURN = 1 << 59


def escape(text: Column) -> Column:
    """A backslash after each backslash, ``<`` and ``[``: reversible, and no control string survives."""
    return F.regexp_replace(text, ESCAPED, r"$1\\")


def unescape(text: str) -> str:
    return re.sub(r"([\\<\[])\\", r"\1", text)


def log_of_turns(turns: DataFrame, streamed_roles: list[str] = LOSS_ROLES) -> DataFrame:
    """The event log (``EVENT_COLS``) that ends in the rows of ``turns`` (``conv_id, turn, role, text``).

    A streamed turn is an empty message, a delta with a draft, a regeneration and two
    deltas; any other turn is a message with a draft, an edit and a delta. Drafts hold
    words and half of the text, so that only a fold that drops them gives the turns.

    Each row is a message of its own, so repeated rows are separate turns. A null turn
    comes first, null texts are empty, null roles aren't streamed.
    """
    text = F.coalesce("text", F.lit(""))
    half = F.floor((F.length(text) + 1) / 2).cast("int")
    first, rest = F.left(text, half), F.substring(text, half + 1, F.length(text))
    draft = F.concat(F.lit("draft "), first)

    def events(*steps: tuple[str, Column]) -> Column:
        return F.array(*[F.struct(F.lit(kind).alias("kind"), part.alias("text")) for kind, part in steps])

    streamed = events((MESSAGE, F.lit("")), (DELTA, draft), (REGENERATE, F.lit("")), (DELTA, first), (DELTA, rest))
    typed = events((MESSAGE, draft), (EDIT, first), (DELTA, rest))
    base = F.least(F.greatest(F.col("turn").cast("long"), F.lit(-MAX_TURN)), F.lit(MAX_TURN)) * STEPS
    log = turns.select(
        "conv_id", F.monotonically_increasing_id().alias("msg"), base.alias("base"), "role",
        F.when(F.col("role").isin(streamed_roles), streamed).otherwise(typed).alias("events"))
    return (log.select("conv_id", "msg", "base", "role", F.posexplode("events").alias("step", "event"))
            .select("conv_id", "msg", (F.col("base") + F.col("step")).alias("seq"), "event.kind", "role", "event.text"))


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages ``(conv_id, msg, seq, role, text)`` of an event log (``EVENT_COLS``).

    The log is partitioned by conversation and message, so that a hot conversation
    is spread, and sorted by sequence, then folded as a stream: memory holds one
    message, however long its conversation. ``seq`` of a
    message is that of its first event, its place in the conversation. A ``message``
    event always starts a new message, so repeated rows stay separate turns; other
    events change the latest message of that ``msg`` and start one if there is none.

    Events of equal sequence are taken by kind (message first), then role and text.
    Null texts are empty, a null kind is a message, a null sequence comes first.
    """
    rank = F.when(F.col("kind") == MESSAGE, 0).when(F.col("kind") == REGENERATE, 1).when(F.col("kind") == EDIT, 2).otherwise(3)
    log = events.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("msg").cast("long").alias("msg"),
        F.col("seq").cast("long").alias("seq"), F.coalesce("kind", F.lit(MESSAGE)).alias("kind"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = (log.withColumn("rank", rank).repartition("conv_id", "msg")
               .sortWithinPartitions("conv_id", "msg", "seq", "rank", "role", "text").select(*EVENT_COLS))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []  # (conv_id, msg, seq, role) of the open message, and its text so far
        for batch in batches:
            out = []
            for conv, msg, seq, kind, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or kind == MESSAGE or now[:2] != (conv, msg):
                    if now is not None:
                        out.append((*now, "".join(parts)))
                    now, parts = (conv, msg, seq, role), []
                if kind in (EDIT, REGENERATE):
                    parts = []
                parts.append(text)
            yield _batch(out, MESSAGES)
        if now is not None:
            yield _batch([(*now, "".join(parts))], MESSAGES)

    small_batches(events.sparkSession)
    return ordered.mapInArrow(fold, MESSAGES)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string()}
    arrays = [pa.array([r[i] for r in rows], kinds[kind]) for i, (_, kind) in enumerate(fields)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def render(messages: DataFrame, loss_roles: list[str] = LOSS_ROLES) -> DataFrame:
    """Each message as its piece of the formatted conversation, with the span that a model learns from.

    ``conv_id, msg, seq, formatted, loss_start, loss_end``: a conversation is its pieces
    in order of (seq, formatted); ``[loss_start, loss_end)`` counts code points within the
    piece and is null where the role is not learned from. Pieces stay rows, so a
    conversation of any length is never one value.
    """
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(CLOSE_ROLE))
    body = escape(F.col("text"))
    learned = F.col("role").isin(loss_roles)
    return messages.select(
        "conv_id", "msg", "seq", F.concat(head, body, F.lit(CLOSE)).alias("formatted"),
        F.when(learned, F.length(head)).alias("loss_start"),
        F.when(learned, F.length(head) + F.length(body)).alias("loss_end"))


def parse_piece(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted piece."""
    role, _, rest = formatted.removeprefix(OPEN).partition(CLOSE_ROLE)
    return unescape(role), unescape(rest.removesuffix(CLOSE))


def format_conversations(events: DataFrame) -> DataFrame:
    """Fold an event log and render it: :func:`fold_events`, then :func:`render`.

    Defined cases: null ids group together; an empty log gives an empty result; other
    columns are ignored; rows that repeat are turns of their own.
    """
    return render(fold_events(events))


SUMMARY = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(pieces: DataFrame) -> DataFrame:
    """Digests of each conversation, from its formatted pieces alone.

    A digest of a conversation is sequential by nature: its pieces go to one task in
    order and are hashed as a stream, so memory holds a batch of rows and the state
    of two digests, whatever the length.
    """
    ordered = (pieces.repartition("conv_id").sortWithinPartitions("conv_id", "seq", "formatted")
               .select("conv_id", "formatted", "loss_start", "loss_end"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None

        def closed():
            return now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5]

        for batch in batches:
            out = []
            for conv, piece, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or now[0] != conv:
                    if now is not None:
                        out.append(closed())
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = parse_piece(piece)
                now[1] += 1
                now[2].update(f"{role}\n{text}\n".encode())
                if start is not None:
                    learned = unescape(piece[start:end])
                    now[3] += len(learned)
                    now[4].update(learned.encode())
                now[5] += len(piece)
            yield _batch(out, SUMMARY)
        if now is not None:
            yield _batch([closed()], SUMMARY)

    small_batches(pieces.sparkSession)
    return ordered.mapInArrow(digest, SUMMARY)
