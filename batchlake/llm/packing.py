"""Packing of tokenised documents into windows of equal capacity.

A document's ids (an end id included) are cut into full windows and pieces of at most ``piece``
ids. Pieces are gathered, in the order of the rows of a task, into groups that hold a little less
than ``group`` full windows. Each group is dealt out by multiway differencing (Karmarkar and
Karp): every piece starts as a partial partition with one filled window; the two partial
partitions with the largest spread are merged, fullest windows onto emptiest, until one is left.
If a window exceeds the capacity, the group is dealt out again over one window more.

Groups are bounded, so a task's memory does not depend on its input, and nothing is shuffled.
Sequence ids are the task's number times 2**33 plus a running number.

Defined results: null or empty texts are a single end id; repeated rows are packed as often as
they occur; null ids are kept. Only the id and the text are read of other columns.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from batchlake.llm.arrow import STEP_BYTES, filled, ship, steps, with_columns
from batchlake.llm.tokens import encoder, with_end

CAPACITY = 2048
#: Windows of a group, longest piece, and ids left free in a group so that nearly equal windows fit.
GROUP, PIECE, SLACK = 64, 512, 512

SCHEMA = (
    "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Indices of ``sizes`` dealt out over ``windows`` sets of nearly equal sums.

    A merge is kept as its two parts and the order of its windows; which window a piece is in is
    read from the last merge downwards.
    """
    if not sizes:
        return [[] for _ in range(windows)]
    heap = []
    for k, size in enumerate(sizes):
        sums = np.zeros(windows, dtype=np.int64)
        sums[0] = size
        heap.append((-size, k, sums))
    heapq.heapify(heap)
    merges: list[tuple[int, int, np.ndarray]] = []
    n = len(sizes)
    for made in range(n, 2 * n - 1):
        _, ours, high = heapq.heappop(heap)
        _, theirs, low = heap[0]
        # Sums are kept in falling order, so the reverse of one opposes the imbalance of the other.
        sums = high + low[::-1]
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        merges.append((ours, theirs, order))
        heapq.heapreplace(heap, (int(sums[-1] - sums[0]), made, sums))
    place = {2 * n - 2: np.arange(windows)}
    for made in range(2 * n - 2, n - 1, -1):
        ours, theirs, order = merges[made - n]
        slots = place.pop(made)
        for part, at in ((ours, order), (theirs, windows - 1 - order)):
            if part < n:  # a single piece: it is in the first of its windows
                place[part] = slots[at == 0]
            else:
                place[part] = np.empty_like(slots)
                place[part][at] = slots
    sets: list[list[int]] = [[] for _ in range(windows)]
    for k in range(n):
        sets[int(place[k][0])].append(k)
    return sets


def deal(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of at most ``capacity``: as few as the sum allows, one more as long as one is
    exceeded. No size may be above the capacity."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        sets = differencing(sizes, windows)
        if all(sum(sizes[i] for i in s) <= capacity for s in sets):
            return [sorted(s) for s in sets if s]
        windows += 1


class _Packer:
    """Gathers pieces and emits rows (document, start, length, crc, total, sequence, offset)."""

    def __init__(self, capacity: int, group: int, piece: int, slack: int, first: int):
        self.capacity, self.piece = capacity, piece
        self.room = max(capacity, group * capacity - slack)
        self.sequence = first
        self.held: list[tuple] = []
        self.total = 0
        self.rows: list[tuple] = []

    def _emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for key, start, length, crc, total in pieces:
            self.rows.append((key, start, length, crc, total, self.sequence, offset))
            offset += length
        self.sequence += 1

    def close(self) -> None:
        """Deal out what is held."""
        for members in deal([p[2] for p in self.held], self.capacity) if self.held else []:
            self._emit([self.held[i] for i in members])
        self.held, self.total = [], 0

    def add(self, key, ids: np.ndarray) -> None:
        at, n = 0, len(ids)

        def cut(length: int) -> tuple:
            crc = zlib.crc32(ids[at : at + length].astype("<u4", copy=False))
            return key, at, length, crc, n

        while n - at >= self.capacity:
            self._emit([cut(self.capacity)])
            at += self.capacity
        while at < n:
            length = min(self.piece, n - at, self.room - self.total)
            self.held.append(cut(length))
            self.total += length
            at += length
            if self.total == self.room:
                self.close()

    def take(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def pack(
    docs: DataFrame,
    vocabulary: str,
    end: int = 1,
    capacity: int = CAPACITY,
    group: int = GROUP,
    piece: int = PIECE,
    slack: int = SLACK,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: id, ``start`` in its document, ``length``, crc of its ids, the document's
    ids in all, and the window (``sequence_id``) with the piece's ``offset`` there."""
    ship(docs.sparkSession)
    names = [doc_id, *[c.split()[0] for c in SCHEMA.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = encoder(vocabulary)
        task = TaskContext.get()
        packer = _Packer(capacity, group, piece, slack, task.partitionId() << 33 if task else 0)
        kind = None

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            types = [kind, *[pa.int64()] * 6]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in steps(batches, text, 2 * STEP_BYTES):
            kind = batch.schema.field(doc_id).type
            ids, lengths = with_end(*work.encode(filled(batch, text)), end)
            begin = 0
            for key, n in zip(batch.column(doc_id).to_pylist(), lengths.tolist(), strict=True):
                packer.add(key, ids[begin : begin + n])
                begin += n
            if packer.rows:
                yield batch_of(packer.take())
        packer.close()
        if packer.rows:
            yield batch_of(packer.take())

    key = docs.schema[doc_id].dataType.simpleString()
    return with_columns(docs, doc_id, text).mapInArrow(run, f"`{doc_id}` {key}, {SCHEMA}")
