"""Token ids as Arrow files of equal-length sequences.

Texts are read and encoded once. The ids, in bytes of the narrowest kind, are dealt out by ranges of document
ids, whose bounds are quantiles of the ids alone; each task writes the shard of its range as two Arrow
IPC files in the shared folder:

* ``shard-N.arrow``: ``ids``, fixed-size lists of ``length`` entries, and ``mask``, fixed-size lists of
  ``length / 8`` bytes with a bit per entry, so that both are read as views. The ids of
  all documents, each followed by the end id, run through the sequences without gaps; only the
  last sequence of a shard is padded, with mask 0 there.
* ``shard-N.docs.arrow``: each document's id, first position in the shard and number of ids.

Record batches hold the same number of sequences, so sequence i is row ``i % rows`` of batch
``i // rows``: a slice of the mapped file, not a copy. A task writes under a name of its own and
renames when done, so a task that runs again leaves the same files.

Defined results: null or empty texts are a single end id; a null document id comes first; rows
with equal ids are ordered by text hash; an empty table has no shards.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pyarrow.fs
import pyarrow.ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from batchlake.llm.arrow import STEP_BYTES, filled, ragged, ship, steps, text_bytes
from batchlake.llm.tokens import encoder
from batchlake.session import materialize, run_dir

#: Ids in a sequence, and sequences in a record batch.
LENGTH, ROWS = 2048, 256


def _at(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path)


class _Shard:
    """Writes one shard; memory holds one record batch."""

    def __init__(self, path: str, kind: pa.DataType, key: pa.DataType, length: int, rows: int):
        self.path, self.length, self.rows, self.kind = path, length, rows, kind
        self.system, self.name = _at(path)
        self.mark = f".{TaskContext.get().taskAttemptId()}" if TaskContext.get() else ".own"
        lists = [pa.list_(kind, length), pa.list_(pa.uint8(), -(-length // 8))]
        self.schema = pa.schema([("ids", lists[0]), ("mask", lists[1])])
        self.docs_schema = pa.schema([("doc_id", key), ("first", pa.int64()), ("n", pa.int64())])
        self.sinks = [self.system.open_output_stream(n + self.mark) for n in self._names()]
        self.files = [
            pa.ipc.new_file(s, schema)
            for s, schema in zip(self.sinks, (self.schema, self.docs_schema), strict=True)
        ]
        block = length * rows
        self.buffer = np.zeros(block, dtype=kind.to_pandas_dtype())
        self.bits = -(-length // 8)
        self.held = self.total = self.documents = 0

    def _names(self) -> list[str]:
        return [self.name + ".arrow", self.name + ".docs.arrow"]

    def _write(self) -> None:
        """What the buffer holds as whole sequences, the last one padded."""
        size = self.held + -self.held % self.length
        self.buffer[self.held : size] = 0
        mask = (np.arange(size) < self.held).reshape(-1, self.length)
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(self.buffer[:size]), self.length),
            pa.FixedSizeListArray.from_arrays(pa.array(np.packbits(mask, axis=1).ravel()), self.bits),
        ]
        self.files[0].write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.held = 0

    def add(self, keys: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> None:
        first = self.total + np.cumsum(lengths) - lengths
        arrays = [keys, pa.array(first), pa.array(lengths)]
        self.files[1].write_batch(pa.RecordBatch.from_arrays(arrays, schema=self.docs_schema))
        self.documents += len(lengths)
        self.total += len(ids)
        at = 0
        while at < len(ids):
            some = ids[at : at + len(self.buffer) - self.held]
            self.buffer[self.held : self.held + len(some)] = some
            self.held, at = self.held + len(some), at + len(some)
            if self.held == len(self.buffer):
                self._write()

    def close(self) -> None:
        if self.held:
            self._write()
        for file, sink, name in zip(self.files, self.sinks, self._names(), strict=True):
            file.close()
            sink.close()
            self.system.move(name + self.mark, name)


class Sequences:
    """Random access to a shard. Arrays are views of the mapped file where it is a local one."""

    def __init__(self, path: str):
        system, name = _at(path)
        local = isinstance(system, pa.fs.LocalFileSystem)
        opened = pa.memory_map(name + ".arrow") if local else system.open_input_file(name + ".arrow")
        self.file = pa.ipc.open_file(opened)
        self.length = self.file.schema.field("ids").type.list_size
        self.rows = self.file.get_batch(0).num_rows if self.file.num_record_batches else 0
        self.documents = name + ".docs.arrow"
        self.system = system
        self.now, self.views = -1, None

    def _views(self, block: int) -> list[np.ndarray]:
        """Ids and mask of a record batch."""
        if block != self.now:
            batch = self.file.get_batch(block)
            self.now, self.views = block, [batch.column(k).flatten().to_numpy(zero_copy_only=True) for k in (0, 1)]
        return self.views

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of sequence ``i`` and its mask, a bit per id (``np.packbits``); both are views."""
        block, row = divmod(i, self.rows)
        ids, bits = self._views(block)
        size = len(bits) // (len(ids) // self.length)
        return ids[row * self.length : (row + 1) * self.length], bits[row * size : (row + 1) * size]

    def mask(self, i: int) -> np.ndarray:
        """The mask of sequence ``i``, a flag per id."""
        return np.unpackbits(self.sequence(i)[1], count=self.length).view(np.bool_)

    def span(self, first: int, n: int) -> Iterator[np.ndarray]:
        """The ids from position ``first`` on, as views of one record batch each."""
        size = self.rows * self.length
        while n:
            block, at = divmod(first, size)
            part = self._views(block)[0][at : at + n]
            yield part
            first, n = first + len(part), n - len(part)

    def index(self) -> Iterator[pa.RecordBatch]:
        """Document ids, first positions and numbers of ids, in order."""
        with self.system.open_input_file(self.documents) as opened:
            reader = pa.ipc.open_file(opened)
            for k in range(reader.num_record_batches):
                yield reader.get_batch(k)


def _narrow(vocabulary: str, end: int) -> bool:
    """Whether all ids fit 16 bits."""
    return max(encoder(vocabulary).tokenizer.get_vocab_size(), end + 1) <= 1 << 16


def _bounds(docs: DataFrame, doc_id: str, shards: int) -> list[int]:
    """Ids that cut the documents into ``shards`` ranges of like size; a frequent id may be several bounds."""
    if shards < 2:
        return []
    cuts = [k / shards for k in range(1, shards)]
    return docs.agg(F.percentile_approx(docs[doc_id], cuts, 100 * shards).alias("cuts")).first()["cuts"] or []


def _shard_of(ids: pa.Array, ties: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The range of each (id, tie), in their order. An id that is several bounds is spread over their ranges
    by its ties; null ids come first."""
    keys = pa.compute.fill_null(ids, 0).to_numpy()
    low, high = (np.searchsorted(bounds, keys, side) for side in ("left", "right"))
    part = (ties.astype(np.float64) + 2.0**63) / 2.0**64
    inner = np.minimum((part * (high - low)).astype(np.int64), np.maximum(high - low - 1, 0))
    shard = np.where(high - low > 1, low + inner, low)
    shard[ids.is_null().to_numpy(zero_copy_only=False)] = 0
    return shard


def _encoded(
    docs: DataFrame, vocabulary: str, end: int, kind: np.dtype, shards: int, doc_id: str, text: str
) -> DataFrame:
    """Each document's id, a hash of its text to order repeated ids by, its shard and the bytes of its ids."""
    bounds = np.array(_bounds(docs, doc_id, shards), dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = encoder(vocabulary)
        for batch in steps(batches, text, 2 * STEP_BYTES):
            ids, lengths = work.encode(filled(batch, text))
            ends = np.cumsum(lengths + 1)
            out = np.full(ends[-1], end, dtype=kind)
            out[ragged(ends - lengths - 1, lengths)] = ids
            offsets = np.concatenate(([0], ends * kind.itemsize)).astype(np.int32)
            data = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(out)])
            keys, ties = batch.column(doc_id), batch.column("_tie")
            shard = pa.array(_shard_of(keys, ties.to_numpy(), bounds), pa.int32())
            yield pa.RecordBatch.from_arrays([keys, ties, shard, data], [doc_id, "_tie", "_shard", "ids"])

    given = docs.select(docs[doc_id], docs[text], F.xxhash64(docs[text]).alias("_tie"))
    id_kind = docs.schema[doc_id].dataType.simpleString()
    return given.mapInArrow(run, f"`{doc_id}` {id_kind}, _tie bigint, _shard int, ids binary")


def write(
    docs: DataFrame,
    vocabulary: str,
    path: str,
    end: int = 0,
    length: int = LENGTH,
    rows: int = ROWS,
    doc_id: str = "doc_id",
    text: str = "text",
    shards: int | None = None,
) -> DataFrame:
    """Write all shards below ``path``, ``shards`` of them (by default as many as ``docs`` has partitions). One row per shard: ``shard``, ``path``, ``documents``,
    ``n_tokens`` and ``start``, the number of ids in all shards before it."""
    spark = docs.sparkSession
    ship(spark)
    system, name = _at(path)
    system.create_dir(name, recursive=True)
    kinds = (pa.uint16(), np.dtype("<u2")) if _narrow(vocabulary, end) else (pa.uint32(), np.dtype("<u4"))
    shards = shards or max(1, docs.rdd.getNumPartitions())
    encoded = _encoded(docs, vocabulary, end, kinds[1], shards, doc_id, text)
    order = [F.col(doc_id).asc_nulls_first(), F.col("_tie")]
    ranged = encoded.repartitionById(shards, "_shard").sortWithinPartitions(*order).drop("_tie", "_shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number = None, TaskContext.get().partitionId()
        where = f"{path.rstrip('/')}/shard-{number:06d}"
        for batch in steps(batches, "ids", 2 * STEP_BYTES):
            keys = batch.column(doc_id)
            shard = shard or _Shard(where, kinds[0], keys.type, length, rows)
            data, sizes = text_bytes(batch.column("ids"))
            shard.add(keys, data.view(kinds[1]), sizes // kinds[1].itemsize)
        if shard:
            shard.close()
            found = [[number], [where], [shard.documents], [shard.total]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v) for v in found], ["shard", "path", "documents", "n_tokens"]
            )

    # Stored, so that no later action writes the shards again.
    written = materialize(
        ranged.mapInArrow(run, "shard bigint, path string, documents bigint, n_tokens bigint"),
        "shards",
    )
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard
    return written.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_documents(shards: DataFrame, kind: str = "bigint", doc_id: str = "doc_id") -> DataFrame:
    """One row per document from the files: id, ``start`` over all shards, ``n_tokens`` and the
    crc of its ids as unsigned 32-bit integers."""
    ship(shards.sparkSession)
    names = [doc_id, "start", "n_tokens", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Sequences(row["path"])
                for part in shard.index():
                    first, n = part.column("first").to_numpy(), part.column("n").to_numpy()
                    crc = np.zeros(len(n), dtype=np.int64)
                    for k in range(len(n)):
                        value = 0
                        for ids in shard.span(int(first[k]), int(n[k])):
                            value = zlib.crc32(ids.astype("<u4"), value)
                        crc[k] = value
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id"), pa.array(first + row["start"]), pa.array(n), pa.array(crc)],
                        names,
                    )

    count = max(1, shards.count())
    return (
        shards.select("path", "start")
        .repartition(count)
        .mapInArrow(run, f"`{doc_id}` {kind}, start bigint, n_tokens bigint, ids_crc32 bigint")
    )


def round_trip(docs: DataFrame, vocabulary: str, end: int = 0) -> DataFrame:
    """Write ``docs`` to a fresh folder in the shared one and read every document back."""
    path = run_dir(docs.sparkSession, "token-shards")
    return read_documents(
        write(docs, vocabulary, path, end), docs.schema["doc_id"].dataType.simpleString()
    )
