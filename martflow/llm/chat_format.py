"""Chat formatting by token-level assembly.

Role and text of every turn are encoded apart with an ordinary tokenizer, which
never gives a reserved id; the reserved ids that mark turns are put between
them as numbers.  The loss mask is the running sum of +1 and -1 at the borders
of the assistants' texts.  Control strings that occur in a text are escaped, so
the text form of the output is unambiguous too.

Turns are encoded where they are read.  Only then do they meet, sorted, by
conversation; the tasks that number them keep one running sum, not the
conversation, so a conversation of any length passes in bounded memory.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packing import TOKENIZER, encode, encoders, read_vocabulary

# The template's marks, in the order of their reserved ids.
MARKS = ("<s>", "<|turn|>", "<|text|>", "</s>")
#: Control strings of common templates, escaped wherever they occur in a text.
CONTROLS = (*MARKS, "[INST]", "[/INST]", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<<SYS>>", "<</SYS>>")
BEGIN, TURN, TEXT, END = range(4)
GUARD = "\\"
_OPEN = re.compile("|".join(f"{re.escape(c[0])}{re.escape(GUARD)}*{re.escape(c[1:])}" for c in CONTROLS))
_SHUT = re.compile("|".join(f"{re.escape(c[0])}{re.escape(GUARD)}+{re.escape(c[1:])}" for c in CONTROLS))


def escape(text: str) -> str:
    """One more guard behind the first character of every control string,
    guarded ones included; so no control string is left and ``unescape`` is exact.
    The second ``<`` of ``<<SYS>>`` begins no other control string."""
    return _OPEN.sub(lambda m: m[0][0] + GUARD + m[0][1:], text)


def unescape(text: str) -> str:
    return _SHUT.sub(lambda m: m[0][0] + m[0][2:], text)


def turn_tokens(role: str, text: str, codes) -> tuple[list[int], int, int]:
    """Ids of one turn, and where its text begins and ends."""
    first = codes[0].n_vocab
    head = [first + TURN, *encode(escape(role), codes), first + TEXT]
    body = encode(escape(text), codes)
    return [*head, *body, first + END], len(head), len(head) + len(body)


def formatted(turns: DataFrame, tokenizer: str = TOKENIZER, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per turn: ``(conv_id, place, start, input_ids, loss_mask)``.

    ``place`` numbers the turns of a conversation from 0, ``start`` is the
    number of ids before the turn's, ``input_ids`` holds little-endian ids
    (four bytes) and ``loss_mask`` one byte for each, 1 under the texts of the
    roles in ``learn``.  The rows of a conversation, put together by ``place``,
    are its formatted sequence; the first carries the begin mark.

    Turns are ordered by number, nulls first, then by role and ids; repeated rows
    are turns of their own.  Null roles and texts are empty; turns without a
    conversation id are one conversation.  Other columns are ignored.  An empty
    table gives an empty result.
    """
    sent = turns.sparkSession.sparkContext.broadcast(read_vocabulary(tokenizer))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = encoders(sent.value)
        for batch in batches:
            ids, masks = [], []
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own, low, high = turn_tokens(role, text, codes)
                step = np.zeros(len(own) + 1, np.int8)
                if role in learn:
                    step[low] += 1
                    step[high] -= 1
                ids.append(np.array(own, "<u4").tobytes())
                masks.append(np.cumsum(step[:-1], dtype=np.int8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), batch.column("role"), pa.array(ids, pa.binary()),
                 pa.array(masks, pa.binary())], ["conv_id", "turn", "role", "input_ids", "loss_mask"])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin = np.array([encoders(sent.value)[0].n_vocab + BEGIN], "<u4").tobytes()
        now, place, start = object(), 0, 0
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [])
            for conv, ids, mask in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "input_ids", "loss_mask")),
                                       strict=True):
                if conv != now:
                    now, place, start = conv, 0, 0
                    ids, mask = begin + ids, b"\0" + mask
                for column, value in zip(out, (place, start, ids, mask), strict=True):
                    column.append(value)
                place, start = place + 1, start + len(mask)
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *map(pa.array, out, kinds)],
                                             ["conv_id", "place", "start", "input_ids", "loss_mask"])

    encoded = rows.mapInArrow(assemble, "conv_id bigint, turn bigint, role string, input_ids binary, loss_mask binary")
    met = encoded.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "input_ids")
    return met.mapInArrow(number, "conv_id bigint, place bigint, start bigint, input_ids binary, loss_mask binary")


class _Digest:
    """What is read back of one conversation; holds hashes and counts only."""

    def __init__(self, conv):
        self.conv, self.turns, self.learned, self.shown = conv, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, ids: np.ndarray, mask: np.ndarray, code) -> None:
        first = code.n_vocab
        marks = np.flatnonzero(ids >= first)
        text = lambda part: code.decode_bytes(part.tolist()).decode()
        at = {int(ids[i]) - first: int(i) for i in marks}
        role, body = text(ids[at[TURN] + 1 : at[TEXT]]), text(ids[at[TEXT] + 1 : at[END]])
        self.turns += 1
        self.shown += len(role) + len(body) + sum(len(MARKS[int(ids[i]) - first]) for i in marks)
        self.all.update(f"{unescape(role)}\n{unescape(body)}\n".encode())
        under = unescape(text(ids[mask.astype(bool)]))
        self.learned += len(under)
        self.loss.update(under.encode())

    def row(self) -> tuple:
        return (self.conv, self.turns, self.all.hexdigest(), self.learned, self.loss.hexdigest(), self.shown)


def read_back(rows: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Digests of every conversation, from the output of ``formatted`` alone:
    ``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)``."""
    sent = rows.sparkSession.sparkContext.broadcast(read_vocabulary(tokenizer))
    schema = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
              "formatted_chars bigint")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoders(sent.value)[0]
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        names = [part.split()[0] for part in schema.split(", ")]

        def batch_of(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)],
                                              names)

        now, done = None, []
        for batch in batches:
            for conv, ids, mask in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "input_ids", "loss_mask")),
                                       strict=True):
                if now is None or now.conv != conv:
                    done += [now.row()] if now else []
                    now = _Digest(conv)
                now.add(np.frombuffer(ids, "<u4"), np.frombuffer(mask, np.int8), code)
            if len(done) >= 1000:
                yield batch_of(done)
                done = []
        done += [now.row()] if now else []
        if done:
            yield batch_of(done)

    met = rows.select("conv_id", "place", "input_ids", "loss_mask").repartition("conv_id").sortWithinPartitions(
        "conv_id", "place")
    return met.mapInArrow(digest, schema)
