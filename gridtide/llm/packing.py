"""Packing token pieces into sequences of a fixed length by bounded-space online best fit."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.llm.common import stored
from gridtide.llm.tokens import chunks, encoder

SEQUENCE = 2048
OPEN_BINS = 1024


class BestFit:
    """At most ``most_open`` open bins, found through a bitset of the free spaces that occur.

    A piece goes to the bin with the least free space that takes it.  Where none does, a new bin is
    opened; if that is one too many, the fullest open bin is closed first.
    """

    def __init__(self, capacity: int, most_open: int, first_bin: int = 0):
        self.capacity, self.most_open, self.next_bin = capacity, most_open, first_bin
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by free space
        self.free = 0  # bit f: some open bin has f tokens free
        self.open = 0

    def _take(self, free: int) -> int:
        held = self.bins[free]
        number = held.pop()
        if not held:
            self.free ^= 1 << free
        self.open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """Bin and offset for a piece of ``length`` tokens."""
        fitting = self.free >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self.capacity, self.next_bin
            self.next_bin += 1
        left = free - length
        if left:
            if self.open == self.most_open:
                self._take((self.free & -self.free).bit_length() - 1)
            self.bins[left].append(number)
            self.free |= 1 << left
            self.open += 1
        return number, self.capacity - free


_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(
    docs: DataFrame,
    vocab_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = SEQUENCE,
    end_id: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """Each document's ids and an end id, cut into pieces of at most ``capacity`` ids.

    A null or empty text is one piece that holds the end id.  ``with_ids`` adds the ids of each piece.
    """
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocab_path)
        end = np.array([end_id], "<u4")
        for batch in chunks(batches, "text"):
            encoded = bpe.encode_array(batch.column("text"))
            values, offsets = encoded.values.to_numpy(), encoded.offsets.to_numpy()
            columns: list[list] = [[] for _ in range(5 + with_ids)]
            for number, first, last in zip(batch.column("doc_id").to_pylist(), offsets[:-1], offsets[1:]):
                ids = np.concatenate([values[first:last].astype("<u4"), end])
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    row = (number, piece, start, len(part), zlib.crc32(part.tobytes()), part.astype(np.int32))
                    for column, value in zip(columns, row):
                        column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=names[: len(arrays)])

    return source.mapInArrow(run, _PIECES + (", ids array<int>" if with_ids else ""))


def pack(pieces: DataFrame, capacity: int = SEQUENCE, most_open: int = OPEN_BINS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to every piece.

    Pieces are dealt to partitions by a hash of document and piece, and packed there one by one, in the
    order of that hash, which mixes lengths.  A task holds ``most_open`` bins and one batch, whatever its
    input.  The order within a task is total, so a repeated task packs alike.  Bins left open at a task's
    end are its only loss against one long run.
    """
    order = [F.xxhash64("doc_id", "piece"), "doc_id", "piece", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = BestFit(capacity, most_open, TaskContext.get().partitionId() << 40)
        for batch in batches:
            placed = [bins.place(length) for length in batch.column("length").to_pylist()]
            added = [pa.array([pair[side] for pair in placed], pa.int64()) for side in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *added], names=[*batch.schema.names, "sequence_id", "offset"]
            )

    schema = ", ".join(f"{name} {kind}" for name, kind in pieces.dtypes)
    dealt = pieces.repartition(F.xxhash64("doc_id", "piece")).sortWithinPartitions(*order)
    return dealt.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocab_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of all documents with their places in sequences of ``SEQUENCE`` ids.

    Tokens are made once and never move: the stored pieces are (document, place, length, checksum).
    Rows that repeat an id or a text are packed like any others; a null id stays null; an empty table
    gives no pieces.  Other columns are not read.
    """
    return pack(stored(token_pieces(docs, vocab_path, doc_id, text), "pieces"))
