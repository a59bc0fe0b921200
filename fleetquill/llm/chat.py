"""Chat formatting from event logs.

A log holds each conversation's events: a message starts, text is streamed in deltas, an
edit replaces a message's text, a regeneration empties it to be streamed again. Events are
grouped by message and folded in the order of their sequence numbers: the last event that
sets the text counts, with the deltas after it. The messages of a conversation are then
rendered in the order of their turns.

The template marks a turn as ``<|turn|>role``, a line break, the text, ``<|end|>`` and a line
break. In texts and roles ``&``, ``<`` and ``[`` (in roles also line breaks) are written as
``&amp;``, ``&lt;``, ``&lsqb;`` and ``&nl;``, so that no control string of this or other
templates can come from a text; the marks are undone when the output is read. The loss mask
is a list of code-point spans of the output: the texts of the assistant's turns.

Messages fold in tasks of their own, however long a conversation is. ``render_turns`` gives a
row per turn, in order, with its place in the conversation's output; ``read_back_turns`` takes
these rows one after the other. A task sorts its conversations on disk and holds a block of turns,
so a conversation of any length passes, in one task, as a digest is worked out in order.
``render`` gives a conversation as one row, which has to fit into memory.

Defined results: a null text or role is empty; a null turn comes first; turns that tie are
ordered by role, then text; repeated rows are turns each; a null conv_id is one
conversation; an event of an unknown kind is ignored, and one delivered again counts once; an empty table gives an empty table;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetquill.llm import shared

TURN, END = "<|turn|>", "<|end|>\n"
MARKS = [("&", "&amp;"), ("<", "&lt;"), ("[", "&lsqb;")]
LEARNED = "assistant"
DELTA = 256


def escape(text: str) -> str:
    for plain, mark in MARKS:
        text = text.replace(plain, mark)
    return text


def unescape(text: str) -> str:
    for plain, mark in reversed(MARKS):
        text = text.replace(mark, plain)
    return text


def events(messages: DataFrame) -> DataFrame:
    """A log that the messages (conv_id, turn, role, text) could have come from: every text is
    streamed in deltas; each third one after a draft that is given up, each third one as an
    edit of a draft."""
    text = F.coalesce("text", F.lit(""))
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.length(text) - 1), F.lit(DELTA))
    deltas = F.transform(
        starts, lambda at: F.struct(F.lit("delta").alias("kind"), F.substr(text, at + 1, F.lit(DELTA)).alias("text"))
    )

    def event(kind: str, content: str | None = None) -> list:
        return F.array(F.struct(F.lit(kind).alias("kind"), F.lit(content).cast("string").alias("text")))

    draft = F.concat(event("start"), event("delta", "<|draft|> not this"))
    history = (
        F.when(F.col("turn") % 3 == 1, F.concat(draft, event("regenerate"), deltas))
        .when(F.col("turn") % 3 == 2, F.concat(draft, F.array(F.struct(F.lit("edit").alias("kind"), text.alias("text")))))
        .otherwise(F.concat(event("start"), deltas))
    )
    numbered = messages.select(
        "conv_id", "turn", "role", F.monotonically_increasing_id().alias("message"), history.alias("history")
    )
    return numbered.select("*", F.posexplode("history").alias("seq", "e")).select(
        "conv_id", "message", "turn", "role", "seq", "e.kind", "e.text"
    )


def fold(log: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): every message's final state.

    An event is told by conversation, message and sequence number, and counts once however
    often it was delivered; of different events with one number the first in order of kind
    and text does. Turn and role are the start event's, or those of the first event that has
    them where the start never came.
    """
    ordered = F.array_sort(F.collect_set(F.struct("seq", "kind", "text", "turn", "role")))
    whole = log.groupBy("conv_id", "message").agg(ordered.alias("all"))
    es = F.filter("all", lambda e, at: (at == 0) | ~e["seq"].eqNullSafe(F.get(F.col("all"), at - 1)["seq"]))
    last = F.array_max(
        F.transform("es", lambda e, at: F.when(e["kind"].isin("start", "edit", "regenerate"), at).otherwise(-1))
    )
    tail = F.filter(
        F.slice("es", F.greatest(F.lit(1), last + 1), F.greatest(F.size("es"), F.lit(1))),
        lambda e: e["kind"].isin("delta", "edit"),
    )
    starts = F.filter("es", lambda e: e["kind"] == "start")

    def of_message(name: str) -> Column:
        known = F.filter("es", lambda e: e[name].isNotNull())
        return F.when(F.size(starts) > 0, F.get(starts, F.lit(0))[name]).otherwise(F.get(known, F.lit(0))[name])

    return whole.select("conv_id", "message", es.alias("es")).select(
        "conv_id",
        of_message("turn").alias("turn"),
        F.coalesce(of_message("role"), F.lit("")).alias("role"),
        F.array_join(F.transform(tail, lambda e: F.coalesce(e["text"], F.lit(""))), "").alias("text"),
    )


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss): the text of each conversation and the spans to learn."""
    turns = F.array_sort(F.collect_list(F.struct(F.coalesce(F.col("turn").cast("long"), F.lit(-(2**63))).alias("turn"), "role", "text")))
    whole = messages.groupBy("conv_id").agg(turns.alias("turns"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, masks = [], []
            for turns in batch.column(1):
                parts: list[str] = []
                mask, at = [], 0
                for turn in turns.as_py():
                    role, text = escape(turn["role"]).replace("\n", "&nl;"), escape(turn["text"])
                    opening = f"{TURN}{role}\n"
                    if turn["role"] == LEARNED:
                        mask.append({"start": at + len(opening), "end": at + len(opening) + len(text)})
                    parts += [opening, text, END]
                    at += len(opening) + len(text) + len(END)
                texts.append("".join(parts))
                masks.append(mask)
            spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(masks, spans)],
                names=["conv_id", "formatted", "loss"],
            )

    return whole.mapInArrow(write, "conv_id long, formatted string, loss array<struct<start:long,end:long>>")


def render_turns(messages: DataFrame) -> DataFrame:
    """(conv_id, start, formatted, loss_start, loss_end): the output turn by turn, a
    conversation's turns one after the other in a task; places count from the conversation's
    start, those of the loss are null for turns not to learn."""
    turn = F.coalesce(F.col("turn").cast("long"), F.lit(-(2**63))).alias("turn")
    rows = messages.select(F.col("conv_id").cast("long"), turn, "role", "text")
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, conv, at = True, None, 0
        for batch in batches:
            _, offsets = shared.byte_view(batch.column(3))
            for low, high in shared.blocks(offsets, 4 << 20):
                part = batch.slice(low, high - low)
                starts, texts, loss_starts, loss_ends = [], [], [], []
                for own, role, text in zip(*(part.column(k).to_pylist() for k in (0, 2, 3)), strict=True):
                    if first or own != conv:
                        first, conv, at = False, own, 0
                    learned = role == LEARNED
                    opening, text = f"{TURN}{escape(role).replace('\n', '&nl;')}\n", escape(text)
                    starts.append(at)
                    texts.append(opening + text + END)
                    loss_starts.append(at + len(opening) if learned else None)
                    loss_ends.append(at + len(opening) + len(text) if learned else None)
                    at += len(texts[-1])
                places = [pa.array(x, pa.int64()) for x in (starts, loss_starts, loss_ends)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), places[0], pa.array(texts, pa.string()), *places[1:]],
                    names=["conv_id", "start", "formatted", "loss_start", "loss_end"],
                )

    return ordered.mapInArrow(write, "conv_id long, start long, formatted string, loss_start long, loss_end long")


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of the output."""
    turns = []
    for part in formatted.split(END)[:-1]:
        role, _, text = part.removeprefix(TURN).partition("\n")
        turns.append((unescape(role.replace("&nl;", "\n")), unescape(text)))
    return turns


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the output says, worked out from the output alone."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            for text, mask in zip(batch.column(1), batch.column(2), strict=True):
                whole = text.as_py()
                turns = parse(whole)
                said = "".join(f"{role}\n{own}\n" for role, own in turns)
                loss = "".join(unescape(whole[s["start"] : s["end"]]) for s in mask.as_py())
                row = (
                    len(turns),
                    hashlib.sha256(said.encode()).hexdigest(),
                    len(loss),
                    hashlib.sha256(loss.encode()).hexdigest(),
                    len(whole),
                )
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    return formatted.mapInArrow(
        read,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


def read_back_turns(rendered: DataFrame) -> DataFrame:
    """The digests of ``read_back`` from the rows of ``render_turns``, as they come."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

        def table(done: list[tuple]) -> pa.RecordBatch:
            columns = zip(*done, strict=True) if done else [()] * len(kinds)
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names
            )

        def close() -> tuple:
            return conv, n, said.hexdigest(), loss_chars, loss.hexdigest(), chars

        conv, n, said, loss_chars, loss, chars = None, 0, hashlib.sha256(), 0, hashlib.sha256(), 0
        for batch in batches:
            done = []
            for own, start, text, low, high in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if start == 0:
                    if n:
                        done.append(close())
                    conv, n, said, loss_chars, loss, chars = own, 0, hashlib.sha256(), 0, hashlib.sha256(), 0
                if own != conv or start != chars:
                    raise ValueError(f"conversation {own}: a turn at {start} follows {chars} characters of {conv}")
                for role, turn in parse(text):
                    said.update(f"{role}\n{turn}\n".encode())
                    n += 1
                if low is not None:
                    learned = unescape(text[low - start : high - start])
                    loss_chars += len(learned)
                    loss.update(learned.encode())
                chars += len(text)
            yield table(done)
        if n:
            yield table([close()])

    return rendered.mapInArrow(
        read,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
