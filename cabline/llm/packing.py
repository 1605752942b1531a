"""Harmonic packing of tokenised documents into fixed-capacity sequences.

Lengths fall into reciprocal-capacity classes: class j takes pieces of exactly
``capacity // j`` ids, and a sequence of that class takes a fixed number of
them, ``capacity // length``.  A document gives whole sequences first; what
remains is cut greedily to the largest class length that fits, which leaves a
rest that falls about as the square (three or four cuts as a rule).  Each task
fills its own sequences class by class: there is no shuffle, no state is shared
between workers, and a sequence's content depends on its task's input alone.

At the end of a task each class has at most one sequence that isn't full.  The
pieces in these are cut to powers of two and laid end to end, the longest
first, into sequences whose lengths are powers of two: they need no padding.
So only full sequences of classes that don't divide the capacity are padded,
by less than their class number.

Cases: a null or empty text is its end id alone; a null doc_id and repeated
rows are packed as any other; an empty table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from cabline.llm._common import id_and_text
from cabline.llm.tokens import encode_texts

CAPACITY = 2048
#: sequence_id = task's partition * SEQUENCES_PER_TASK + its own count
SEQUENCES_PER_TASK = 1 << 40

PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, "
          "offset long")


def class_length(left: int, capacity: int) -> int:
    """The largest ``capacity // j`` that is at most ``left`` (left >= 1)."""
    return capacity if left >= capacity else capacity // (capacity // (left + 1) + 1)


class HarmonicPacker:
    """Fills the sequences of one task.  ``add`` and ``finish`` return placed
    pieces ``(doc, start, length, sequence, offset)``; ``doc`` is opaque."""

    def __init__(self, capacity: int) -> None:
        if capacity < 1 or capacity & (capacity - 1):
            raise ValueError("capacity must be a power of two")
        self.capacity = capacity
        self.open: dict[int, list] = {}     # class length -> pieces of its open sequence
        self.sequences = 0

    def _close(self, pieces: list) -> list:
        placed, at = [], 0
        for doc, start, length in pieces:
            placed.append((doc, start, length, self.sequences, at))
            at += length
        self.sequences += 1
        return placed

    def add(self, doc, n: int) -> list:
        placed, start = [], 0
        while start < n:
            length = class_length(n - start, self.capacity)
            pieces = self.open.setdefault(length, [])
            pieces.append((doc, start, length))
            start += length
            if len(pieces) == self.capacity // length:
                placed += self._close(pieces)
                self.open[length] = []
        return placed

    def finish(self) -> list:
        rest = []
        for pieces in self.open.values():
            for doc, start, length in pieces:
                while length:
                    part = 1 << (length.bit_length() - 1)
                    rest.append((doc, start, part))
                    start, length = start + part, length - part
        self.open = {}
        rest.sort(key=lambda p: -p[2])      # stable: the same input gives the same sequences
        left, placed, current, room = sum(p[2] for p in rest), [], [], 0
        for piece in rest:
            if not room:
                room = min(self.capacity, 1 << (left.bit_length() - 1))
            current.append(piece)
            room -= piece[2]
            left -= piece[2]
            if not room:
                placed += self._close(current)
                current = []
        return placed


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece (:data:`PIECES`); a sequence is its pieces by offset."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() * SEQUENCES_PER_TASK
        packer = HarmonicPacker(capacity)

        def rows(placed: list) -> pa.RecordBatch:
            def longs(values) -> pa.Array:
                return pa.array(values, pa.int64())

            return pa.RecordBatch.from_arrays(
                [longs([p[0][0] for p in placed]), longs([p[1] for p in placed]),
                 longs([p[2] for p in placed]),
                 pa.array([p[0][1][4 * p[1]:4 * (p[1] + p[2])] for p in placed], pa.binary()),
                 longs([len(p[0][1]) // 4 for p in placed]),
                 longs([first + p[3] for p in placed]), longs([p[4] for p in placed])],
                ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        for b in batches:
            placed = []
            texts = encode_texts(tokenizer, b.column("text").to_pylist(), end_id)
            for doc_id, ids in zip(b.column("doc_id").to_pylist(), texts):
                placed += packer.add((doc_id, ids), len(ids) // 4)
                if len(placed) >= 4000:
                    yield rows(placed)
                    placed = []
            yield rows(placed)
        yield rows(packer.finish())

    return id_and_text(docs, id_col, text_col).mapInArrow(pieces, PIECES)
