"""Token ids packed into fixed-length rows, as binary matrices.

Texts are encoded with a public tokenizer; a document longer than a row is cut
into pieces of a full row each and a rest, so no token is lost.  Pieces are
packed best fit decreasing: longest first, each into the row with the least
room that still holds it.  Free room is a number from 0 to the row length, so a
segment tree over that range finds the row in logarithmic time.

Every task packs its own rows in batches of a bounded number of tokens: memory
is bounded, nothing is shuffled, and a lost task is repeated alone.
"""
from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
ROW_TOKENS, BATCH_TOKENS = 2048, 1 << 21
#: Fixed value: the split pattern that belongs to the tokenizer's vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MEETING = re.compile(r"\s\s")


def read_vocabulary(path: str) -> bytes:
    """The tokenizer file, read on the driver and sent along with the tasks."""
    with open(path, "rb") as f:
        return f.read()


@lru_cache(maxsize=2)
def encoders(vocabulary: bytes):
    """The tokenizer, and a faster one that gives the same ids where no two
    white-space characters meet: only then can its pattern do without looking ahead."""
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines()) if a}
    plain = PATTERN.replace(r"\s+(?!\S)|", "")
    return tuple(tiktoken.Encoding("packing", pat_str=p, mergeable_ranks=ranks, special_tokens={})
                 for p in (PATTERN, plain))


def encode(text: str, codes) -> list[int]:
    full, plain = codes
    return (full if MEETING.search(text) else plain).encode_ordinary(text)


class RoomTree:
    """Rows by free room: a segment tree of counts over 0..``size`` finds the
    least room that is at least a given one."""

    def __init__(self, size: int):
        self.width = 1 << size.bit_length()
        self.count = [0] * (2 * self.width)
        self.rows: list[list[int]] = [[] for _ in range(size + 1)]

    def _change(self, room: int, by: int) -> None:
        node = room + self.width
        while node:
            self.count[node] += by
            node >>= 1

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._change(room, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove and return ``(room, row)`` of the tightest row with room for ``least``."""
        node = least + self.width
        if not self.count[node]:
            while node & (node + 1) and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if not node & (node + 1):
                return None
            node += 1
            while node < self.width:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.width
        row = self.rows[room].pop()
        self._change(room, -1)
        return room, row


def best_fit_decreasing(lengths: list[int], size: int) -> list[list[int]]:
    """Rows as lists of indices into ``lengths`` (each from 1 to ``size``)."""
    tree, rows = RoomTree(size), []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = tree.take(lengths[i])
        if found is None:
            room, row = size, len(rows)
            rows.append([])
        else:
            room, row = found
        rows[row].append(i)
        if room > lengths[i]:
            tree.add(room - lengths[i], row)
    return rows


def _pack(pieces: list[tuple[int | None, int, np.ndarray]], size: int, pad: int, kind: np.dtype) -> pa.RecordBatch:
    rows = best_fit_decreasing([len(p[2]) for p in pieces], size)
    out: dict[str, list] = {k: [] for k in ("input_ids", "cu_seqlens", "position_ids", "doc_ids", "offsets", "n_tokens")}
    for row in rows:
        parts = [pieces[i] for i in row]
        ends = np.cumsum([0] + [len(p[2]) for p in parts])
        ids = np.full(size, pad, kind)
        ids[: ends[-1]] = np.concatenate([p[2] for p in parts])
        where = np.zeros(size, np.uint16 if size <= 1 << 16 else np.uint32)
        for (_, _, tokens), start in zip(parts, ends.tolist(), strict=False):
            where[start : start + len(tokens)] = np.arange(len(tokens))
        out["input_ids"].append(ids.tobytes())
        out["position_ids"].append(where.tobytes())
        out["cu_seqlens"].append(ends.tolist())
        out["doc_ids"].append([p[0] for p in parts])
        out["offsets"].append([p[1] for p in parts])
        out["n_tokens"].append(int(ends[-1]))
    kinds = (pa.binary(), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], list(out))


SCHEMA = ("input_ids binary, cu_seqlens array<int>, position_ids binary, doc_ids array<bigint>, "
          "offsets array<bigint>, n_tokens int")


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER,
           row_tokens: int = ROW_TOKENS, batch_tokens: int = BATCH_TOKENS, numbered: bool = False) -> DataFrame:
    """One row per packed sequence of ``row_tokens`` places.

    ``input_ids`` holds little-endian token ids (two bytes each where the
    vocabulary allows it, else four), the end-of-text id behind every document
    and in the unused places; ``cu_seqlens`` the segment borders;
    ``position_ids`` the places counted from 0 anew in every segment (two bytes
    each up to 65,536 places); ``doc_ids`` and ``offsets`` tell for each segment
    its document and the first token of it that the segment holds; ``n_tokens``
    the used places.  With ``numbered`` a column ``batch`` tells the batch that a
    row was packed in: batches rise with the order of the tasks and, in a task,
    of its rows.

    Null and empty texts are the end-of-text id alone, so every row of ``docs``
    has a segment; repeated rows and null ids keep theirs.  Other columns are
    ignored.  An empty table gives an empty result.
    """
    if row_tokens < 1 or batch_tokens < row_tokens:
        raise ValueError("a batch has to hold a row of at least one token")
    sent = docs.sparkSession.sparkContext.broadcast(read_vocabulary(tokenizer))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(docs, text_col).alias("text"))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = encoders(sent.value)
        end = codes[0].n_vocab
        kind = np.dtype("<u2") if end < 1 << 16 else np.dtype("<u4")
        held, total, place = [], 0, (TaskContext.get().partitionId() << 32) if numbered else 0

        def pack() -> pa.RecordBatch:
            rows = _pack(held, row_tokens, end, kind)
            return rows.append_column("batch", pa.array([place] * rows.num_rows, pa.int64())) if numbered else rows

        for batch in batches:
            for doc, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                ids = np.array(encode(text.as_py(), codes) + [end], kind)
                held += [(doc, at, ids[at : at + row_tokens]) for at in range(0, len(ids), row_tokens)]
                total += len(ids)
                if total >= batch_tokens:
                    yield pack()
                    held, total, place = [], 0, place + 1
        if held:
            yield pack()

    return rows.mapInArrow(kernel, SCHEMA + (", batch bigint" if numbered else ""))


def write_packed(docs: DataFrame, path: str, **options) -> None:
    """Write the packed rows as Parquet, replacing what is there."""
    packed(docs, **options).write.mode("overwrite").parquet(path)
